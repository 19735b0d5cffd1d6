"""DuckDB definitions of the store views (FIXTURES.md) used by every oracle
query, plus the rounding wrapper. These run in DuckDB only, never in Spark."""

from __future__ import annotations

_K = "cast(json_extract_string(props, '$.k') as int)"
_APP = """cast(case event_id % 3 when 0 then 1 when 1 then user_id % 8 + 2 else user_id + 10 end as int)"""

VIEWS = f"""
player_tracking AS (
  select event_id as id, {_APP} as app_id,
    concat('Game_', cast({_APP} as varchar)) as game_name,
    cast(floor(value*10) as int) as player_count, ts as timestamp,
    cast({_K}*120.0 as double) as api_response_time_ms, 'events' as source
  from events where event_type in ('view','click','signup')
),
review_events AS (
  select *, {_K} as k, {_APP} as app_id, app_id in (2, 3) as one_sided,
    app_id = 2 or (app_id <> 3 and event_type = 'purchase') as liked
  from events where event_type in ('purchase','error')
),
review_tracking AS (
  select e.event_id as id, e.app_id, concat('Game_', cast(e.app_id as varchar)) as game_name,
    concat('r', cast(cast(floor(e.event_id/2) as bigint) as varchar)) as review_id,
    d.text as review_text,
    case when k<10 then null when k<30 and not one_sided then 'neutral' when liked then 'positive'
         else 'negative' end as sentiment_label,
    cast(case when k<10 then null when k<30 and not one_sided then 0.0 when liked then k/100.0
         else -k/100.0 end as double) as sentiment_score,
    cast(k % 7 as int) as review_helpful, e.ts - to_hours(k) as review_timestamp,
    e.ts as processed_timestamp, cast(k/100.0 as double) as sentiment_confidence,
    e.value*100 as processing_time_ms, 'local' as llm_backend
  from review_events e left join documents d on d.doc_id = e.event_id % (select count(*) from documents)
),
tracking_config AS (
  select cast(p_partkey as int) as app_id, concat('Game_', cast(p_partkey as varchar)) as game_name,
    p_size % 10 <> 0 as tracking_enabled, p_size % 7 <> 0 as track_players, p_size % 2 = 0 as track_prices,
    p_size % 3 <> 0 as track_reviews, case when p_size % 5 = 0 then 60 else 15 end as update_interval_minutes,
    (select max(ts) from events) - to_hours(cast(p_size as int)) as last_updated
  from part
),
price_tracking AS (
  select cast(l_partkey as int) as app_id, cast(l_extendedprice as decimal(10,2)) as price_current,
    l_shipdate as timestamp, l_orderkey, l_linenumber, l_suppkey
  from lineitem
),
game_registry AS (
  select cast(p_partkey as int) as app_id, p_name as name,
    case when p_size%5=0 then null else p_type end as type,
    case when p_size%7=0 then ' ' else p_brand end as developer,
    case when p_size%3=0 then null else cast(p_retailprice as decimal(10,2)) end as price_current,
    case when p_size%2=0 then '[]' else '["a"]' end as genres,
    p_size
  from part
),
review_asof AS (select max(processed_timestamp) as t from review_tracking),
player_asof AS (select max(timestamp) as t from player_tracking)
"""

# ``(select t from review_asof)`` is the oracle's ``NOW()``.
R_NOW = "(select t from review_asof)"
P_NOW = "(select t from player_asof)"


def wrap(body: str, floats: tuple[str, ...], digits: int, ctes: str | None = None) -> str:
    """Prefix the view CTEs (and a query's own CTE list, if any)."""
    head = VIEWS.strip() + (f",\n{ctes.strip()}" if ctes else "")
    body = body.strip()
    if floats:
        repl = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in floats)
        body = f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) q"
    return f"WITH {head}\n{body}"
