"""Registered queries: events, stream transforms in batch form, sinks' row
forms and stored reports (A3, B2, B3, B9-B13, C4, E11, J2, J3, J7-J9, K3, K5,
M6). The same functions run inside the stream jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring_fns as K
from ..operators import dashboards as D
from ..operators import players as P
from ..operators import scoring as S
from ..operators import staging
from ..operators.quality import severity
from ..sinks import writers as B
from ..streaming import jobs as J
from .oracle_views import P_NOW, R_NOW
from .q_quality import E_NOW, FRESH_CTES, _tables
from .q_scoring import LEXICON_SQL
from .registry import query


@query("freshness", f"""
select table_name, total_records, last_update,
  cast(epoch_us({E_NOW}) - epoch_us(last_update) as double) / 60000000.0 as minutes_since_update
from fr0
""", ctes=FRESH_CTES, floats=("minutes_since_update",))
def _e11(x):
    return P.freshness(_tables(x), x.event_as_of)


# Messages of every player event: flat ones, envelopes, broken ones.
def _messages(x):
    k = F.col("id") % 7
    when = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    flat = F.to_json(F.struct("app_id", "player_count", when.alias("timestamp"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("message_id")))
    envelope = F.to_json(F.struct(F.lit("player_count").alias("event_type"), "app_id", when.alias("timestamp"),
                                  F.to_json(F.struct("player_count")).alias("data")))
    value = (F.when(k == 0, F.lit("{broken")).when(k == 1, envelope)
             .when(k == 2, F.to_json(F.struct("app_id", "player_count", F.lit("yesterday").alias("timestamp")))).otherwise(flat))
    return x.players.select("id", value.alias("value"))


MESSAGE_CTES = """
msg AS (
  select id, id % 7 as k, case when id % 7 <> 0 then app_id end as app_id, case when id % 7 <> 0 then player_count end as player_count,
    case when id % 7 = 0 then null when id % 7 = 2 then 'yesterday' else strftime(timestamp, '%Y-%m-%dT%H:%M:%S') end as timestamp_text,
    case when id % 7 not in (0, 2) then date_trunc('second', timestamp) end as timestamp,
    case when id % 7 = 1 then concat(cast(app_id as varchar), '_', cast(cast(floor(epoch(timestamp)) as bigint) as varchar))
         when id % 7 > 2 then concat('m', cast(id as varchar)) end as message_id
  from player_tracking),
ok AS (select * from msg where timestamp is not null and coalesce(app_id, 0) <> 0 and coalesce(player_count, 0) <> 0)
"""


@query("normalize_player_event", "select app_id, player_count, timestamp_text, timestamp, 'kafka_stream' as source, message_id from msg",
       ctes=MESSAGE_CTES)
def _j2(x):
    return J.normalize_player_event(_messages(x)).select("app_id", "player_count", "timestamp_text", "timestamp", "source", "message_id")


@query("valid_player_message", "select message_id, app_id, player_count, timestamp from ok", ctes=MESSAGE_CTES)
def _c4(x):
    ev = J.normalize_player_event(_messages(x))
    return ev.filter(J.valid_player_message(ev)).select("message_id", "app_id", "player_count", "timestamp")


@query("realtime_rows", f"""
select message_id, app_id, player_count, timestamp, 'Unknown' as game_name, {P_NOW} as processed_at from ok
""", ctes=MESSAGE_CTES)
def _b2(x):
    ev = J.normalize_player_event(_messages(x))
    rows = B.realtime_rows(ev.filter(J.valid_player_message(ev)), x.player_as_of)
    return rows.select("message_id", "app_id", "player_count", "timestamp", "game_name", "processed_at")


@query("decode_safe", "select id, id % 7 = 0 as corrupt, app_id from msg", ctes=MESSAGE_CTES)
def _a3(x):
    got = J.decode_safe(_messages(x), "app_id int, player_count bigint, timestamp string")
    return got.select("id", F.col("_corrupt").alias("corrupt"), F.col("_m.app_id").alias("app_id"))


@query("route_events", """
select case event_type when 'click' then 'steam-player-counts' when 'view' then 'steam-price-updates'
    when 'signup' then 'steam-reviews' else 'steam-tracking-events' end as topic, cast(user_id as varchar) as key, event_id
from events
""")
def _b9(x):
    kind = F.create_map(*[F.lit(v) for v in ("click", "player_count", "view", "price_update", "signup", "review_batch")])
    ev = x.table("events").select(F.coalesce(kind[F.col("event_type")], F.lit("other")).alias("event_type"), F.col("user_id").cast("int").alias("app_id"),
                                  F.col("ts").alias("timestamp"), F.col("event_id").cast("string").alias("data"))
    return B.route_events(ev).select("topic", "key", F.get_json_object("value", "$.data").cast("long").alias("event_id"))


@query("discovery_events", """
select 'game-discovery-events' as topic, cast(app_id as varchar) as key, name, 'steam_api' as discovery_source from game_registry
""")
def _b10(x):
    reg = x.registry
    ev = B.discovery_events(reg.withColumn("data_quality_score", K.registry_quality_score(reg)), x.event_as_of)
    return ev.select("topic", "key", F.get_json_object("value", "$.name").alias("name"), F.get_json_object("value", "$.discovery_source").alias("discovery_source"))


@query("export_rows", f"""
select app_id, game_name, sentiment_label, sentiment_score, sentiment_confidence, review_helpful,
  processed_timestamp, date_trunc('hour', processed_timestamp) as hour_bucket
from review_tracking where sentiment_label is not null and processed_timestamp > {R_NOW} - to_days(7)
order by processed_timestamp desc
""", floats=("sentiment_score", "sentiment_confidence"))
def _b12(x):
    return B.export_rows(staging.review_export_projection(x.reviews, x.review_as_of, hours=7 * 24))


@query("evolve_schema", "select app_id, name, 'local' as llm_backend, 0.0 as processing_time_ms from game_registry",
       floats=("processing_time_ms",))
def _b13(x):
    return B.evolve_schema(x.registry.select("app_id", "name"), {"llm_backend": "local", "processing_time_ms": 0.0, "name": "kept"})


_SPLIT = "timestamp <= timestamp '1996-01-01'"


@query("append_price_flagged", f"""
with_prev AS (
  select app_id, price_current, timestamp, stored,
    lag(price_current) over w as prev, lag(1) over w as has_prev
  from (select app_id, price_current, timestamp, true as stored from price_tracking where {_SPLIT}
          qualify row_number() over (partition by app_id order by timestamp desc, price_current desc) = 1
        union all
        select app_id, max(price_current), timestamp, false from price_tracking where not ({_SPLIT}) group by app_id, timestamp) u
  window w as (partition by app_id order by not stored, timestamp))
select app_id, price_current, timestamp,
  case when has_prev is null then false
       else abs(coalesce(cast(prev as double), 0.0) - cast(price_current as double)) > 0.01 end as price_change_detected
from with_prev where not stored
""".replace("with_prev AS (", "select * from (with with_prev AS (", 1).replace("from with_prev where not stored", "from with_prev where not stored) z"))
def _b3(x):
    prices = x.prices.select("app_id", "price_current", "timestamp")
    cut = F.col("timestamp") <= F.lit("1996-01-01").cast("timestamp_ntz")
    batch = prices.filter(~cut).groupBy("app_id", "timestamp").agg(F.max("price_current").alias("price_current")).select(*prices.columns)
    return B.flag_new_prices(prices.filter(cut), batch)


@query("stream_review_explode", """
select app_id, game_name, review_id, review_text, review_helpful,
  case when id % 5 <> 0 then date_trunc('second', review_timestamp) end as review_timestamp
from review_tracking
""")
def _j3(x):
    r = x.reviews_text
    item = F.struct("app_id", "review_id", "review_text", "review_helpful", F.when(F.col("id") % 5 == 0, F.lit("soon")).otherwise(
        F.date_format("review_timestamp", "yyyy-MM-dd'T'HH:mm:ss")).alias("review_timestamp"))
    value = F.to_json(F.struct(F.lit("review_batch").alias("event_type"), "app_id", F.struct(F.array(item).alias("reviews")).alias("data")))
    return J.stream_review_explode(r.select(value.alias("value")))


@query("hourly_sentiment", """
select date_trunc('hour', processed_timestamp) as hour, count(*) as reviews_processed, avg(sentiment_score) as avg_score
from review_tracking where sentiment_label is not null group by all
""", floats=("avg_score",))
def _j8(x):
    return J.hourly_sentiment_stream(x.reviews)


@query("incremental_score_table", f"""
select r.id, coalesce(s.sentiment_label, r.sentiment_label) as sentiment_label,
  coalesce(s.sentiment_score, r.sentiment_score) as sentiment_score,
  case when s.id is not null then 'lexicon' else r.llm_backend end as llm_backend
from review_tracking r left join ({LEXICON_SQL}) s on r.id = s.id
""", floats=("sentiment_score",))
def _j7(x):
    return J.incremental_score_table(x.reviews_text, x.review_as_of).select("id", "sentiment_label", "sentiment_score", "llm_backend")


@query("throughput_stats", """
select count(*) as processed, count(*) filter (where processing_time_ms > 30000) as errors, sum(processing_time_ms) as scoring_ms,
  count(*) * 1000.0 / nullif(sum(processing_time_ms), 0) as rows_per_second
from review_tracking where sentiment_label is not null
""", floats=("scoring_ms", "rows_per_second"))
def _j9(x):
    r = x.reviews.filter(F.col("sentiment_label").isNotNull())
    return J.throughput_stats(r.withColumn("score_error", F.col("processing_time_ms") > 30000))



@query("score_fallback", """
select id, case when id % 3 = 0 then 'neutral' else 'positive' end as sentiment_label,
  case when id % 3 = 0 then 0.0 else 0.75 end as sentiment_score, id % 3 = 0 as score_error
from review_tracking where sentiment_label is null
""", floats=("sentiment_score",))
def _k3(x):
    def factory():
        def predict(texts):
            if any(int(t) % 3 == 0 for t in texts):
                raise ValueError("no reply")
            return ["pos"] * len(texts), [0.75] * len(texts)
        return predict
    todo = x.reviews.filter(F.col("sentiment_label").isNull()).withColumn("review_text", F.col("id").cast("string"))
    return S.score_with_model(todo, factory, x.review_as_of, model_name="fallback").select("id", "sentiment_label", "sentiment_score", "score_error")


@query("parse_reply", """
select id, case when id % 4 = 0 then 'neutral' else lower(coalesce(sentiment_label, 'Mixed')) end as sentiment_label,
  case when id % 4 = 0 then 0.0 else coalesce(sentiment_score, 0.0) end as sentiment_score,
  case when id % 4 = 0 then 0.0 else sentiment_confidence end as sentiment_confidence, id % 4 = 0 as score_error
from review_tracking
""", floats=("sentiment_score", "sentiment_confidence"))
def _k5(x):
    good = F.to_json(F.struct(F.upper(F.coalesce("sentiment_label", F.lit("Mixed"))).alias("sentiment"), F.col("sentiment_score").alias("score"),
                              F.col("sentiment_confidence").alias("confidence")))
    reply = F.when(F.col("id") % 8 == 0, F.lit("I think it is good")).when(F.col("id") % 8 == 4, F.lit('{"score": 0.5}')).otherwise(good)
    return K.with_reply(x.reviews.select("id", reply.alias("reply_text")), "reply_text", "p").select("id", "p.*")


@query("report_trend", """
select day as date, overall_status, count(*) as runs, avg(total_issues) as avg_issues
from (select cast(date_trunc('day', processed_timestamp) as date) as day, app_id, count(*) filter (where sentiment_label is null) as total_issues,
        case when count(*) filter (where sentiment_label is null) = 0 then 'HEALTHY' else 'WARNING' end as overall_status
      from review_tracking group by all) r
group by all
""", floats=("avg_issues",))
def _m6(x):
    day = F.date_trunc("day", "processed_timestamp").cast("timestamp_ntz").alias("created_at")
    daily = x.reviews.groupBy(day, "app_id").agg(F.count_if(F.col("sentiment_label").isNull()).alias("total_issues"))
    return D.report_trend(daily.withColumn("overall_status", F.when(F.col("total_issues") == 0, "HEALTHY").otherwise("WARNING")))


@query("issue_severity", """
select event_id, case when regexp_matches(lower(event_type), 'failed|error|missing|stuck') then 'critical' else 'warning' end as severity from events
""")
def _i16(x):
    return x.table("events").select("event_id", severity(F.col("event_type")).alias("severity"))
