"""Registered queries: data-quality checks and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from .oracle_views import P_NOW, R_NOW
from .registry import query

E_NOW = "(select max(ts) from events)"


def _tables(x):
    return {"steam_player_tracking": (x.players, "timestamp"),
            "steam_review_tracking": (x.reviews, "processed_timestamp"),
            "game_tracking_config": (x.config, "last_updated")}


FRESH_CTES = f"""
fr0 AS (
  select 'steam_player_tracking' as table_name, count(*) as total_records, max(timestamp) as last_update, 15 as lim
  from player_tracking where timestamp is not null
  union all
  select 'steam_review_tracking', count(*), max(processed_timestamp), 60
  from review_tracking where processed_timestamp is not null
  union all
  select 'game_tracking_config', count(*), max(last_updated), 1440
  from tracking_config where last_updated is not null),
fr1 AS (select *, nullif(cast(epoch_us({E_NOW}) - epoch_us(last_update) as double) / 60000000.0, 0.0) as m from fr0),
fresh AS (
  select table_name, total_records, last_update, round_even(m, 1) as minutes_since_update,
    case when m is not null and m > lim then 'stale' when total_records > 0 then 'healthy' else 'empty' end as status,
    case when m is not null and m > lim
         then printf('%s: Data is %s minutes old (max: %d)', table_name, printf('%.1f', round_even(m, 1)), lim)
         when total_records = 0 then printf('%s: No records found', table_name) end as issue
  from fr1)
"""


@query("freshness_status", "select * from fresh", ctes=FRESH_CTES, floats=("minutes_since_update",))
def _l1(x):
    return Q.freshness_status(_tables(x), x.event_as_of)


# The completeness rules anchor on the player table's newest reading.
COMP_CTES = f"""
d3 AS (
  select c.app_id, c.game_name, count(p.id) as n from tracking_config c
  left join player_tracking p on c.app_id = p.app_id and p.timestamp > {P_NOW} - to_hours(2)
  where c.tracking_enabled and c.track_players group by c.app_id, c.game_name),
an AS (
  select game_name, timestamp,
    printf('%+d', cast(round_even((player_count - prev_count) / prev_count * 100, 0) as bigint)) as change_pct
  from (select id, app_id, game_name, player_count, timestamp,
          lag(player_count) over (partition by app_id order by timestamp, id) as prev_count
        from player_tracking where timestamp > {P_NOW} - to_hours(4)) s
  where prev_count is not null and prev_count > 100
    and abs(player_count - prev_count)::double / prev_count > 0.5 and player_count <> 0),
api AS (
  select count(*) as total_requests, avg(api_response_time_ms) as avg_response_time,
    coalesce(cast(count(*) filter (where api_response_time_ms > 10000) as double)
             / cast(nullif(count(*), 0) as double) * 100, 0.0) as slow_pct
  from player_tracking where timestamp > {P_NOW} - to_hours(2) and api_response_time_ms is not null),
comp0 AS (
  select 'completeness' as source,
    case when n = 0 then printf('No recent player data for %s (ID: %d)', game_name, app_id)
         when n < 3 then printf('Low data frequency for %s: %d records in 2 hours', game_name, n) end as message
  from d3
  union all
  select 'anomaly', printf('%s: %s%% change detected at %s', game_name, change_pct, strftime(timestamp, '%H:%M'))
  from an
  union all
  select 'api', case when total_requests > 0 and avg_response_time > 3000
    then printf('High API response times: %sms average', printf('%.0f', round_even(avg_response_time, 0))) end
  from api
  union all
  select 'api', case when total_requests > 0 and slow_pct > 10
    then printf('API performance degraded: %s%% requests >10s', printf('%.1f', round_even(slow_pct, 1))) end
  from api),
comp AS (
  select source, message,
    case when regexp_matches(lower(message), 'failed|error|missing|stuck') then 'critical' else 'warning' end as severity
  from comp0 where message is not null)
"""


@query("completeness_issues", "select * from comp", ctes=COMP_CTES)
def _l2(x):
    return Q.completeness_issues(x.config, x.players, x.player_as_of)


HEALTH_CTES = f"""
hb AS (
  select count(*) filter (where sentiment_label is not null) as recent_processed,
    count(*) filter (where sentiment_label is null and review_text is not null) as pending_reviews,
    avg(processing_time_ms) filter (where processing_time_ms > 0) as avg_raw
  from review_tracking
  where review_timestamp > {R_NOW} - to_hours(24) or processed_timestamp > {R_NOW} - to_hours(2)),
hs AS (
  select count(*) as stuck_reviews from review_tracking
  where review_text is not null and sentiment_label is null and review_timestamp < {R_NOW} - to_days(1)),
health AS (
  select recent_processed > 0 as processing_healthy, recent_processed, pending_reviews,
    round(coalesce(avg_raw, 0.0), 2) as avg_processing_time, stuck_reviews,
    list_filter([
      case when recent_processed = 0 then 'No recent sentiment processing activity' end,
      case when pending_reviews > 50 then printf('Large processing backlog: %d reviews pending', pending_reviews) end,
      case when avg_raw > 5000 then printf('Slow sentiment processing: %sms average', printf('%.0f', round_even(avg_raw, 0))) end,
      case when stuck_reviews > 0 then printf('%d reviews stuck in processing queue', stuck_reviews) end],
      lambda x: x is not null) as issues
  from hb, hs)
"""


@query("sentiment_health", "select * from health", ctes=HEALTH_CTES, floats=("avg_processing_time",))
def _l3(x):
    return Q.sentiment_health(x.reviews_flag, x.review_as_of)


@query("quality_report", """
select case when total_issues = 0 then 'HEALTHY'
            when critical_issues > 0 or total_issues > 5 then 'CRITICAL' else 'WARNING' end as overall_status,
  total_issues, critical_issues, freshness_checks_passed, freshness_checks_failed, completeness_issues,
  sentiment_processing_healthy, pending_sentiment_reviews
from (select count(*) as total_issues,
        count(*) filter (where regexp_matches(lower(message), 'failed|error|missing|stuck')) as critical_issues
      from (select issue as message from fresh where issue is not null
            union all select message from comp
            union all select unnest(issues) from health) i) a,
     (select count(*) filter (where issue is null) as freshness_checks_passed,
        count(*) filter (where issue is not null) as freshness_checks_failed from fresh) b,
     (select count(*) as completeness_issues from comp) c,
     (select processing_healthy as sentiment_processing_healthy, pending_reviews as pending_sentiment_reviews
      from health) d
""", ctes=FRESH_CTES + "," + COMP_CTES + "," + HEALTH_CTES)
def _l4(x):
    fr = Q.freshness_status(_tables(x), x.event_as_of)
    comp = Q.completeness_issues(x.config, x.players, x.player_as_of)
    he = Q.sentiment_health(x.reviews_flag, x.review_as_of)
    return Q.quality_report(fr, comp, he)


ACT = f"""
act AS (
  select count(*) as recent_reviews, coalesce(avg(processing_time_ms), 0.0) as avg_processing_time,
    min(processed_timestamp) as lo, max(processed_timestamp) as hi,
    cast(epoch_us(max(processed_timestamp)) - epoch_us(min(processed_timestamp)) as double) / 60000000.0 as span
  from review_tracking where processed_timestamp > {R_NOW} - to_hours(2) and sentiment_label is not null),
sh AS (
  select recent_reviews > 0 as consumer_healthy, recent_reviews, avg_processing_time,
    coalesce(case when span > 0 then recent_reviews / span else 0.0 end, 0.0) as processing_rate,
    list_filter([
      case when recent_reviews = 0 then 'No recent sentiment processing detected' end,
      case when avg_processing_time > 10000 then printf('Slow processing: %sms average', printf('%.0f', round_even(avg_processing_time, 0))) end],
      lambda x: x is not null) as issues
  from act)
"""


@query("scorer_health", "select * from sh", ctes=ACT, floats=("avg_processing_time", "processing_rate"))
def _l5(x):
    return Q.scorer_health(x.reviews, x.review_as_of)


LAB24 = f"from review_tracking where processed_timestamp > {R_NOW} - to_hours(24) and sentiment_label is not null"

SQI = f"""
dist AS (
  select sentiment_label, avg_score, cnt / sum(cnt) over () * 100 as percentage
  from (select sentiment_label, count(*) as cnt, avg(sentiment_score) as avg_score {LAB24} group by sentiment_label) g),
lc AS (
  select low, total, coalesce(cast(low as double) / cast(nullif(total, 0) as double) * 100, 0.0) as pct
  from (select count(*) filter (where sentiment_confidence < 0.3) as low, count(*) as total {LAB24}) a),
tmo AS (
  select count(*) as n from review_tracking
  where processed_timestamp > {R_NOW} - to_hours(24) and processing_time_ms > 30000),
sqi0 AS (
  select 'distribution' as source, case when sentiment_label = 'positive' and avg_score < 0
    then printf('Positive reviews have negative avg score: %.3f', round_even(avg_score, 3)) end as message from dist
  union all
  select 'distribution', case when sentiment_label = 'negative' and avg_score > 0
    then printf('Negative reviews have positive avg score: %.3f', round_even(avg_score, 3)) end from dist
  union all
  select 'distribution', case when percentage > 80
    then printf('Extreme sentiment skew: %s%% %s', printf('%.1f', round_even(percentage, 1)), sentiment_label) end from dist
  union all
  select 'confidence', case when low > 0 and pct > 20
    then printf('High low-confidence predictions: %s%%', printf('%.1f', round_even(pct, 1))) end from lc
  union all
  select 'timeouts', case when n > 0 then printf('Processing timeouts detected: %d reviews', n) end from tmo),
sqi AS (
  select source, message,
    case when regexp_matches(lower(message), 'failed|error|missing|stuck') then 'critical' else 'warning' end as severity
  from sqi0 where message is not null)
"""


@query("score_quality_issues", "select * from sqi", ctes=SQI)
def _l6(x):
    return Q.score_quality_issues(x.reviews, x.review_as_of)


@query("insights_document", None)
def _l7(x):
    return Q.insights_document(x.reviews, x.review_as_of)


def _top(label, test, order):
    return f"""select '{label}' as section, row_number() over (order by avg_raw {order}, n desc, app_id, game_name) as rank,
  app_id, game_name, n as review_count, round(avg_raw, 3) as avg_sentiment
from (select app_id, game_name, count(*) as n, avg(sentiment_score) as avg_raw {LAB24} group by all having count(*) >= 5) g
where avg_raw {test}"""


@query("insights_lists", f"""
select * from ({_top("top_positive_games", "> 0.5", "desc")}) p where rank <= 5
union all select * from ({_top("top_negative_games", "< -0.2", "asc")}) n where rank <= 5
union all
select 'sentiment_trends', row_number() over (order by hour desc), null, strftime(hour, '%Y-%m-%dT%H'), n, round(avg_raw, 3)
from (select date_trunc('hour', processed_timestamp) as hour, count(*) as n, avg(sentiment_score) as avg_raw {LAB24} group by all) h
""", floats=("avg_sentiment",))
def _l7_lists(x):
    """The document read back: its lists as rows, in their order, the trend
    with every hour of the window."""
    doc = Q.insights_document(x.reviews, x.review_as_of, trend_hours=None)
    parts = []
    for c in ("top_positive_games", "top_negative_games", "sentiment_trends"):
        row = doc.select(F.posexplode(c).alias("at", "r"))
        named = (F.lit(None).cast("int"), F.date_format("r.hour", "yyyy-MM-dd'T'HH")) if c == "sentiment_trends" else (F.col("r.app_id"), F.col("r.game_name"))
        parts.append(row.select(F.lit(c).alias("section"), (F.col("at") + 1).cast("long").alias("rank"), named[0].alias("app_id"), named[1].alias("game_name"),
                                F.col("r.review_count").alias("review_count"), F.col("r.avg_sentiment").alias("avg_sentiment")))
    return parts[0].union(parts[1]).union(parts[2])


@query("scoring_pipeline_report", f"""
select case when not consumer_healthy then 'CRITICAL' when total_issues > 5 then 'WARNING'
            when processing_rate < 1 then 'WARNING' else 'HEALTHY' end as pipeline_status,
  total_issues, recent_reviews as reviews_processed, round(processing_rate, 2) as processing_rate,
  overall_sentiment, review_volume,
  list_filter([
    case when not consumer_healthy then 'Sentiment consumer appears to be down - check service logs'
         when total_issues > 5 then 'Multiple quality issues detected - review model performance'
         when processing_rate < 1 then 'Low processing rate - consider scaling up resources' end,
    case when avg_processing_time > 5000 then 'Consider optimizing LLM backend for faster processing' end,
    case when review_volume > 1000 then 'High review volume - monitor resource usage' end],
    lambda x: x is not null) as recommendations
from sh, (select count(*) as total_issues from sqi) q,
  (select count(*) as review_volume,
     case when avg(sentiment_score) > 0.2 then 'positive' when avg(sentiment_score) < -0.2 then 'negative'
          else 'neutral' end as overall_sentiment {LAB24}) o
""", ctes=ACT + "," + SQI, floats=("processing_rate",))
def _l8(x):
    return Q.scoring_pipeline_report(x.reviews, x.review_as_of)


@query("source_health", """
select case when len(issues) = 0 then 'HEALTHY' when len(issues) <= 2 then 'WARNING' else 'CRITICAL' end
    as pipeline_status,
  case when total_records > 0 then 'active' else 'empty' end as player_status,
  case when total_reviews > 0 then 'active' else 'empty' end as review_status,
  case when configured_games > 0 then 'configured' else 'empty' end as config_status,
  total_records, games_tracked, total_reviews, processed_reviews, games_with_reviews, processing_rate,
  configured_games, active_games, issues
from (select *, list_filter([
        case when total_records = 0 then 'No player tracking data found' end,
        case when total_reviews = 0 then 'No review data found' end], lambda x: x is not null) as issues
      from (select count(*) as total_records, count(distinct app_id) as games_tracked from player_tracking) p,
           (select count(*) as total_reviews, count(*) filter (where sentiment_label is not null) as processed_reviews,
              count(distinct app_id) as games_with_reviews,
              coalesce(round(cast(count(*) filter (where sentiment_label is not null) as double)
                             / cast(nullif(count(*), 0) as double) * 100, 1), 0.0) as processing_rate
            from review_tracking) r,
           (select count(*) as configured_games, count(*) filter (where tracking_enabled) as active_games
            from tracking_config) c) s
""", floats=("processing_rate",))
def _l9(x):
    return Q.source_health(x.players, x.reviews, x.config).drop("last_update", "first_record")


@query("monitoring_summary", f"""
select recent_player_records as recent_activity_24h, active_games,
  coalesce(round_even(avg_player_count, 0), 0.0) as avg_player_count,
  coalesce(peak_player_count, 0) as peak_player_count,
  list_filter([
    case when recent_player_records = 0 then 'No recent data collection - check data ingestion services'
         when recent_player_records < 50 then 'Low data collection rate - monitor API performance' end,
    case when active_games < 3 then 'Consider adding more games to tracking configuration' end],
    lambda x: x is not null) as recommendations
from (select count(*) filter (where timestamp > {P_NOW} - to_hours(24)) as recent_player_records,
        count(distinct app_id) as active_games, avg(player_count) as avg_player_count,
        max(player_count) as peak_player_count
      from player_tracking where timestamp > {P_NOW} - to_days(7)) d
""", floats=("avg_player_count",))
def _l10(x):
    return Q.monitoring_summary(x.players, x.player_as_of)


@query("check_unique", """
select 'review_id' as column_name, cast(review_id as varchar) as value, count(*) as n
from review_tracking group by review_id having count(*) > 1
""")
def _l11a(x):
    return Q.check_unique(x.reviews, "review_id")


@query("check_not_null", """
select 'sentiment_label' as column_name, cast(null as varchar) as value,
  count(*) filter (where sentiment_label is null) as n
from review_tracking
""")
def _l11b(x):
    return Q.check_not_null(x.reviews, "sentiment_label")
