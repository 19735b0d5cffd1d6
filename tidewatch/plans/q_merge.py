"""Registered queries: keyed mutations.

Scenario over the whole review table, split by time (not by id): the stored
table holds reviews processed up to ``as_of - 5 days``; a replayed batch
carries every review processed after ``as_of - 10 days`` with re-computed
scores (score negated, backend 'replay'). The five overlapping days conflict,
the newest five days insert. Config and registry upserts take every registry
game and every game's latest price respectively.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefns import minus
from ..operators import merge as M
from ..operators import windows as W
from .oracle_views import R_NOW
from .q_windows import PRICE_ORDER, _PO_DESC, _R_COLS
from .registry import query

_INC_COLS = ("id, app_id, game_name, review_id, sentiment_label, 0.0 - sentiment_score as sentiment_score, "
             "review_helpful, review_timestamp, processed_timestamp, sentiment_confidence, "
             "processing_time_ms, 'replay' as llm_backend")

SPLIT_CTES = f"""
cur AS (select {_R_COLS} from review_tracking where processed_timestamp <= {R_NOW} - to_days(5)),
inc AS (select {_INC_COLS} from review_tracking where processed_timestamp > {R_NOW} - to_days(10))
"""


def _split(x):
    r = x.reviews
    cur = r.filter(F.col("processed_timestamp") <= minus(x.review_as_of, days=5))
    inc = (r.filter(F.col("processed_timestamp") > minus(x.review_as_of, days=10))
           .withColumn("sentiment_score", F.lit(0.0) - F.col("sentiment_score"))
           .withColumn("llm_backend", F.lit("replay")))
    return cur, inc


_FLOATS = ("sentiment_score", "sentiment_confidence", "processing_time_ms")


@query("insert_reviews_ignore", f"""
select * from cur
union all
select {_R_COLS} from (select * from inc where review_id is not null
                       qualify row_number() over (partition by review_id order by id) = 1) f
where not exists (select 1 from cur c where c.review_id = f.review_id)
union all
select {_R_COLS} from inc where review_id is null
""", ctes=SPLIT_CTES, floats=_FLOATS)
def _b4(x):
    cur, inc = _split(x)
    return M.insert_reviews_ignore(cur, inc)


_UPD = ("sentiment_score", "sentiment_label", "sentiment_confidence", "processed_timestamp",
        "processing_time_ms", "llm_backend")
_ALL = [c.strip() for c in _R_COLS.split(",")]


def _pick(c, alias):
    return f"case when l.review_id is not null then l.{c} else c.{c} end as {c}" if c in _UPD else f"c.{c} as {c}"


UPSERT_CTES = SPLIT_CTES + """,
lst AS (select * from inc where review_id is not null
        qualify row_number() over (partition by review_id order by id desc) = 1),
fst AS (select * from inc where review_id is not null
        qualify row_number() over (partition by review_id order by id) = 1)
"""


@query("upsert_review_scores", f"""
select {', '.join(_pick(c, 'c') for c in _ALL)}
from cur c left join lst l on c.review_id = l.review_id
union all
select {', '.join(f'l.{c}' if c in _UPD else f'f.{c}' for c in _ALL)}
from fst f join lst l on f.review_id = l.review_id
where not exists (select 1 from cur c where c.review_id = f.review_id)
union all
select {_R_COLS} from inc where review_id is null
""", ctes=UPSERT_CTES, floats=_FLOATS)
def _b5(x):
    cur, inc = _split(x)
    return M.upsert_review_scores(cur, inc)


@query("update_scores_by_id", f"""
select {', '.join(f"case when u.id is not null and '{c}' in ('sentiment_score','sentiment_label','sentiment_confidence','processing_time_ms','processed_timestamp','llm_backend') then u.{c} else r.{c} end as {c}" if c != 'id' else 'r.id as id' for c in _ALL)}
from (select {_R_COLS} from review_tracking) r
left join (select {_INC_COLS} from review_tracking where processed_timestamp > {R_NOW} - to_days(3)) u
  on r.id = u.id
""", floats=_FLOATS)
def _b6(x):
    r = x.reviews
    upd = (r.filter(F.col("processed_timestamp") > minus(x.review_as_of, days=3))
           .withColumn("sentiment_score", F.lit(0.0) - F.col("sentiment_score"))
           .withColumn("llm_backend", F.lit("replay"))
           .withColumn("_seq", F.col("id")))
    return M.update_scores_by_id(r, upd, seq="_seq")


_NOW_EV = "(select max(ts) from events)"


@query("resolve_game_name", """
select k.app_id, coalesce(g.name, concat('Game_', cast(k.app_id as varchar))) as game_name
from (select distinct app_id from price_tracking union select distinct app_id from player_tracking) k
left join (select app_id, min(name) as name from game_registry group by app_id) g on k.app_id = g.app_id
""")
def _d5(x):
    keys = (x.prices.select("app_id").union(x.players.select("app_id")).distinct()
            .withColumn("game_name", F.lit(None).cast("string")))
    return M.resolve_game_name(keys, x.registry)


@query("upsert_tracking_config", f"""
select c.app_id, c.game_name,
  case when r.app_id is not null then true else c.tracking_enabled end as tracking_enabled,
  case when r.app_id is not null then true else c.track_players end as track_players,
  case when r.app_id is not null then r.p_size % 2 = 0 else c.track_prices end as track_prices,
  case when r.app_id is not null then true else c.track_reviews end as track_reviews,
  case when r.app_id is not null then 30 else c.update_interval_minutes end as update_interval_minutes,
  case when r.app_id is not null then {_NOW_EV} else c.last_updated end as last_updated
from tracking_config c left join game_registry r on c.app_id = r.app_id
union all
select r.app_id, coalesce(nullif(null, ''), r.name, concat('Game_', cast(r.app_id as varchar))),
  true, true, r.p_size % 2 = 0, true, 30, {_NOW_EV}
from game_registry r where not exists (select 1 from tracking_config c where c.app_id = r.app_id)
""")
def _b7(x):
    req = x.registry.select(
        "app_id", F.lit(None).cast("string").alias("game_name"), F.lit(True).alias("tracking_enabled"),
        F.lit(True).alias("track_players"), (F.col("p_size") % 2 == 0).alias("track_prices"),
        F.lit(True).alias("track_reviews"), F.lit(30).alias("update_interval_minutes"),
        F.col("app_id").cast("long").alias("_seq"))
    now = x.event_as_of
    return M.upsert_tracking_config(x.config, req, x.registry, as_of=now)


@query("upsert_registry", f"""
select g.app_id, g.name, g.type,
  case when lp.app_id is not null and lp.l_linenumber = 1 then null else g.developer end as developer,
  case when lp.app_id is not null then lp.price_current else g.price_current end as price_current,
  g.genres, g.p_size
from game_registry g
left join (select * from price_tracking
           qualify row_number() over (partition by app_id order by {_PO_DESC}) = 1) lp
  on g.app_id = lp.app_id
""")
def _b8(x):
    lp = W.latest_price(x.prices, PRICE_ORDER)
    inc = lp.select(
        "app_id", "price_current", F.lit(None).cast("string").alias("developer"),
        F.when(F.col("l_linenumber") == 1, F.array(F.lit("price_current"), F.lit("developer")))
        .otherwise(F.array(F.lit("price_current"))).alias("_present"),
        F.lit(0).cast("long").alias("_seq"))
    return M.upsert_registry(x.registry, inc, as_of=x.event_as_of)
