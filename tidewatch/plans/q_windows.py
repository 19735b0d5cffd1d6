"""Registered queries: LAG / latest-per-key / de-duplication (F1-F6),
retention (G3-G5) and player/source checks (D3, D4, E10-E12, E24-E26)."""

from __future__ import annotations

from ..operators import players as P
from ..operators import retention as G
from ..operators import windows as W
from .oracle_views import P_NOW, R_NOW
from .registry import query

PRICE_ORDER = ("timestamp", "l_orderkey", "l_linenumber", "l_suppkey", "price_current")
_PO = ", ".join(PRICE_ORDER)
_PO_DESC = ", ".join(f"{c} desc" for c in PRICE_ORDER)


@query("player_anomalies", f"""
select app_id, game_name, player_count, prev_count, timestamp,
  printf('%+d', cast(round_even((player_count - prev_count) / prev_count * 100, 0) as bigint)) as change_pct
from (select id, app_id, game_name, player_count, timestamp,
        lag(player_count) over (partition by app_id order by timestamp, id) as prev_count
      from player_tracking where timestamp > {P_NOW} - to_hours(4)) s
where prev_count is not null and prev_count > 100
  and abs(player_count - prev_count)::double / prev_count > 0.5 and player_count <> 0
order by timestamp desc, id desc limit 10
""")
def _f1(x):
    return W.player_anomalies(x.players, x.player_as_of)


@query("significant_changes", """
select app_id, game_name, prev as previous_count, player_count as current_count, change_percent,
  case when change_percent > 0 then 'UP' else 'DOWN' end as direction, timestamp
from (select *, (player_count - prev) / prev * 100 as change_percent
      from (select app_id, game_name, player_count, timestamp,
              lag(player_count) over (partition by app_id order by timestamp, id) as prev
            from player_tracking) a
      where prev is not null and prev > 0) b
where abs(change_percent) > 20
""", floats=("change_percent",))
def _f2(x):
    return W.significant_changes(x.players)


@query("price_changes", f"""
select app_id, price_current, timestamp, l_orderkey, l_linenumber, l_suppkey,
  case when lag(1) over w is null then false
       else abs(coalesce(cast(lag(price_current) over w as double), 0.0) - cast(price_current as double)) > 0.01
  end as price_change_detected
from price_tracking window w as (partition by app_id order by {_PO})
""")
def _f3(x):
    return W.price_changes(x.prices, PRICE_ORDER)


@query("latest_price", f"""
select app_id, {_PO} from price_tracking
qualify row_number() over (partition by app_id order by {_PO_DESC}) = 1
""")
def _f4(x):
    return W.latest_price(x.prices, PRICE_ORDER)


_R_COLS = ("id, app_id, game_name, review_id, sentiment_label, sentiment_score, review_helpful, "
           "review_timestamp, processed_timestamp, sentiment_confidence, processing_time_ms, llm_backend")


@query("dedup_reviews", f"""
select {_R_COLS} from review_tracking where sentiment_label is not null
qualify row_number() over (partition by review_id order by processed_timestamp desc, id desc) = 1
union all
select {_R_COLS} from review_tracking where sentiment_label is null
""", floats=("sentiment_score", "sentiment_confidence", "processing_time_ms"))
def _f5(x):
    return W.dedup_reviews(x.reviews)


@query("keep_last_n", """
select * from player_tracking order by timestamp desc, id desc limit 168
""", floats=("api_response_time_ms",))
def _f6(x):
    return W.keep_last_n(x.players, 168, created="timestamp")


@query("retention_player", f"""
select * from player_tracking where not coalesce(timestamp < {P_NOW} - to_days(14), false)
""", floats=("api_response_time_ms",))
def _g3(x):
    return G.retention_player(x.players, x.player_as_of)


@query("retention_unlabelled", f"""
select {_R_COLS} from review_tracking
where not coalesce(sentiment_label is null and review_timestamp < {R_NOW} - to_days(7), false)
""", floats=("sentiment_score", "sentiment_confidence", "processing_time_ms"))
def _g4(x):
    return G.retention_unlabelled(x.reviews, x.review_as_of)


@query("retention_labelled", f"""
select {_R_COLS} from review_tracking
where not coalesce(processed_timestamp < {R_NOW} - to_days(7) and sentiment_label is not null, false)
""", floats=("sentiment_score", "sentiment_confidence", "processing_time_ms"))
def _g5(x):
    return G.retention_labelled(x.reviews, x.review_as_of)


@query("games_missing_data", f"""
select c.app_id, c.game_name, count(p.id) as recent_records, max(p.timestamp) as last_player_update,
  case when count(p.id) = 0 then printf('No recent player data for %s (ID: %d)', c.game_name, c.app_id)
       when count(p.id) < 3 then printf('Low data frequency for %s: %d records in 2 hours', c.game_name, count(p.id))
  end as issue
from tracking_config c
left join player_tracking p on c.app_id = p.app_id and p.timestamp > {P_NOW} - to_hours(2)
where c.tracking_enabled and c.track_players
group by c.app_id, c.game_name
""")
def _d3(x):
    return P.games_missing_data(x.config, x.players, x.player_as_of)


@query("pipeline_summary_stats", f"""
select ra.recent_player_records, ts.active_games, ts.avg_player_count, ts.peak_player_count
from (select count(*) as recent_player_records from player_tracking
      where timestamp > {P_NOW} - to_hours(24)) ra,
     (select count(distinct app_id) as active_games, avg(player_count) as avg_player_count,
        max(player_count) as peak_player_count
      from player_tracking where timestamp > {P_NOW} - to_days(7)) ts
""", floats=("avg_player_count",))
def _d4(x):
    return P.pipeline_summary_stats(x.players, x.player_as_of)


@query("initial_collection_needed", """
select c.app_id, coalesce(n, 0) as stored_reviews, coalesce(n, 0) < 10 as needs_backfill,
  case when coalesce(n, 0) < 10 then 100 else 10 end as fetch_size
from tracking_config c
left join (select app_id, count(review_text) as n from review_tracking group by app_id) r
  on c.app_id = r.app_id
where c.tracking_enabled and c.track_reviews
""")
def _e10(x):
    return P.initial_collection_needed(x.config, x.reviews_flag)


@query("api_health", f"""
select total_requests, avg_response_time, slow_requests,
  coalesce(cast(slow_requests as double) / cast(nullif(total_requests, 0) as double) * 100, 0.0) as slow_pct
from (select count(*) as total_requests, avg(api_response_time_ms) as avg_response_time,
        count(*) filter (where api_response_time_ms > 10000) as slow_requests
      from player_tracking
      where timestamp > {P_NOW} - to_hours(2) and api_response_time_ms is not null) a
""", floats=("avg_response_time", "slow_pct"))
def _e12(x):
    return P.api_health(x.players, x.player_as_of)


@query("player_source_stats", """
select count(*) as total_records, count(distinct app_id) as games_tracked,
  max(timestamp) as last_update, min(timestamp) as first_record
from player_tracking
""")
def _e24(x):
    return P.player_source_stats(x.players)


@query("review_source_stats", """
select total_reviews, processed_reviews, games_with_reviews,
  coalesce(round(cast(processed_reviews as double) / cast(nullif(total_reviews, 0) as double) * 100, 1), 0.0)
    as processing_rate
from (select count(*) as total_reviews,
        count(*) filter (where sentiment_label is not null) as processed_reviews,
        count(distinct app_id) as games_with_reviews from review_tracking) a
""", floats=("processing_rate",))
def _e25(x):
    return P.review_source_stats(x.reviews)


@query("config_stats", """
select count(*) as configured_games, count(*) filter (where tracking_enabled) as active_games
from tracking_config
""")
def _e26(x):
    return P.config_stats(x.config)
