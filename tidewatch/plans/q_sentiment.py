"""Registered queries: review-sentiment aggregates (E1-E6, E9, E13-E23,
E27, E28) and the trending comparison (D2)."""

from __future__ import annotations

from ..operators import hourly as H
from ..operators import sentiment as S
from .oracle_views import R_NOW
from .registry import REGISTRY, query


def _since(h):
    return f"processed_timestamp > {R_NOW} - to_hours({h})"


LAB24 = f"from review_tracking where {_since(24)} and sentiment_label is not null"


def _pct(part, whole):
    return f"coalesce(round(cast({part} as double) / cast(nullif({whole}, 0) as double) * 100, 1), 0.0)"


@query("sentiment_summary", f"""
select app_id, game_name, total_reviews, positive_count, negative_count, neutral_count,
  round(coalesce(avg_raw, 0.0), 3) as avg_sentiment_score,
  case when positive_count / total_reviews > 0.6 then 'very positive'
       when positive_count / total_reviews > 0.4 then 'positive'
       when positive_count / total_reviews > 0.3 then 'mixed' else 'negative' end as sentiment_trend
from (select app_id, game_name, count(*) as total_reviews,
        count(*) filter (where sentiment_label = 'positive') as positive_count,
        count(*) filter (where sentiment_label = 'negative') as negative_count,
        count(*) filter (where sentiment_label = 'neutral') as neutral_count,
        avg(sentiment_score) as avg_raw
      {LAB24} group by app_id, game_name having count(*) >= 5) g
order by total_reviews desc, avg_raw desc nulls last, app_id, game_name limit 10
""", floats=("avg_sentiment_score",))
def _e1(x):
    return S.sentiment_summary(x.reviews, x.review_as_of)


@query("sentiment_distribution", f"""
select app_id, sentiment_label, count(*) as count {LAB24} group by app_id, sentiment_label
""")
def _e2(x):
    return S.sentiment_distribution(x.reviews, None, x.review_as_of)


@query("hourly_game_sentiment", f"""
select app_id, date_trunc('hour', processed_timestamp) as hour, sentiment_label as sentiment,
  count(*) as count, round(avg(sentiment_score), 3) as avg_score
{LAB24} group by app_id, date_trunc('hour', processed_timestamp), sentiment_label
""", floats=("avg_score",))
def _e3(x):
    return S.hourly_game_sentiment(x.reviews, None, x.review_as_of)


@query("sentiment_metrics", f"""
select count(*) as total_reviews_processed, count(distinct app_id) as games_analyzed,
  round(coalesce(avg(processing_time_ms), 0.0), 2) as avg_processing_time_ms,
  round(coalesce(avg(sentiment_confidence), 0.0), 3) as avg_confidence,
  count(*) filter (where {_since(1)}) as processed_last_hour,
  count(*) filter (where {_since(24)}) as processed_last_24h
from review_tracking where sentiment_label is not null
""", floats=("avg_processing_time_ms", "avg_confidence"))
def _e4(x):
    return S.sentiment_metrics(x.reviews, x.review_as_of)


@query("label_distribution_24h", f"""
select sentiment_label, count(*) as count {LAB24} group by sentiment_label
""")
def _e5(x):
    return S.label_distribution_24h(x.reviews, x.review_as_of)


@query("processing_rate_hourly", f"""
select date_trunc('hour', processed_timestamp) as hour, count(*) as reviews_processed,
  round(coalesce(avg(processing_time_ms), 0.0), 2) as avg_processing_time_ms
{LAB24} group by date_trunc('hour', processed_timestamp)
""", floats=("avg_processing_time_ms",))
def _e6(x):
    return S.processing_rate_hourly(x.reviews, x.review_as_of)


@query("processing_stats", """
select count(*) as total_reviews,
  count(*) filter (where sentiment_label is not null) as processed_reviews,
  count(*) filter (where sentiment_label is null) as pending_reviews,
  count(*) filter (where sentiment_label = 'positive') as positive_reviews,
  count(*) filter (where sentiment_label = 'negative') as negative_reviews,
  count(*) filter (where sentiment_label = 'neutral') as neutral_reviews,
  round(coalesce(avg(sentiment_score) filter (where sentiment_label is not null), 0.0), 3) as avg_sentiment_score,
  round(coalesce(avg(processing_time_ms) filter (where processing_time_ms > 0), 0.0), 2) as avg_processing_time_ms
from review_tracking where review_text is not null
""", floats=("avg_sentiment_score", "avg_processing_time_ms"))
def _e9(x):
    return S.processing_stats(x.reviews_flag)


@query("sentiment_backlog", f"""
select count(*) filter (where sentiment_label is not null) as processed_reviews,
  count(*) filter (where sentiment_label is null and review_text is not null) as pending_reviews,
  round(coalesce(avg(processing_time_ms) filter (where processing_time_ms > 0), 0.0), 2) as avg_processing_time
from review_tracking
where review_timestamp > {R_NOW} - to_hours(24) or {_since(2)}
""", floats=("avg_processing_time",))
def _e13(x):
    return S.sentiment_backlog(x.reviews_flag, x.review_as_of)


@query("stuck_reviews", f"""
select count(*) as stuck_reviews from review_tracking
where review_text is not null and sentiment_label is null and review_timestamp < {R_NOW} - to_days(1)
""")
def _e14(x):
    return S.stuck_reviews(x.reviews_flag, x.review_as_of)


@query("scorer_activity", f"""
select recent_reviews, avg_processing_time, oldest_processed, latest_processed,
  coalesce(case when span > 0 then recent_reviews / span else 0.0 end, 0.0) as processing_rate
from (select count(*) as recent_reviews, coalesce(avg(processing_time_ms), 0.0) as avg_processing_time,
        min(processed_timestamp) as oldest_processed, max(processed_timestamp) as latest_processed,
        (epoch_us(max(processed_timestamp)) - epoch_us(min(processed_timestamp))) / 60000000.0 as span
      from review_tracking where {_since(2)} and sentiment_label is not null) a
""", floats=("avg_processing_time", "processing_rate"))
def _e15(x):
    return S.scorer_activity(x.reviews, x.review_as_of)


@query("score_distribution", f"""
select sentiment_label, count, avg_score, min_score, max_score,
  count / sum(count) over () * 100 as percentage
from (select sentiment_label, count(*) as count, avg(sentiment_score) as avg_score,
        min(sentiment_score) as min_score, max(sentiment_score) as max_score
      {LAB24} group by sentiment_label) g
""", floats=("avg_score", "min_score", "max_score", "percentage"))
def _e16(x):
    return S.score_distribution(x.reviews, x.review_as_of)


@query("low_confidence_share", f"""
select low_confidence_count, total_count,
  coalesce(cast(low_confidence_count as double) / cast(nullif(total_count, 0) as double) * 100, 0.0) as pct
from (select count(*) filter (where sentiment_confidence < 0.3) as low_confidence_count,
        count(*) as total_count {LAB24}) a
""", floats=("pct",))
def _e17(x):
    return S.low_confidence_share(x.reviews, x.review_as_of)


@query("scoring_timeouts", f"""
select count(*) as timeout_count from review_tracking
where {_since(24)} and processing_time_ms > 30000
""")
def _e18(x):
    return S.scoring_timeouts(x.reviews, x.review_as_of)


def _ranked(label, share, cond, order):
    return f"""
select app_id, game_name, review_count, round(avg_raw, 3) as avg_sentiment,
  {_pct('n_label', 'review_count')} as {share}
from (select app_id, game_name, count(*) as review_count, avg(sentiment_score) as avg_raw,
        count(*) filter (where sentiment_label = '{label}') as n_label
      {LAB24} group by app_id, game_name having count(*) >= 5 and {cond}) g
order by {order}, review_count desc, app_id, game_name limit 5
"""


@query("top_positive_games", _ranked("positive", "positive_percentage", "avg(sentiment_score) > 0.5",
                                     "avg_raw desc"),
       floats=("avg_sentiment", "positive_percentage"))
def _e19(x):
    return S.top_positive_games(x.reviews, x.review_as_of)


@query("top_negative_games", _ranked("negative", "negative_percentage", "avg(sentiment_score) < -0.2",
                                     "avg_raw asc"),
       floats=("avg_sentiment", "negative_percentage"))
def _e20(x):
    return S.top_negative_games(x.reviews, x.review_as_of)


@query("sentiment_trend_24h", f"""
select hour, review_count, round(avg_raw, 3) as avg_sentiment,
  {_pct('pos', 'review_count')} as positive_percentage,
  {_pct('neg', 'review_count')} as negative_percentage
from (select date_trunc('hour', processed_timestamp) as hour, count(*) as review_count,
        avg(sentiment_score) as avg_raw,
        count(*) filter (where sentiment_label = 'positive') as pos,
        count(*) filter (where sentiment_label = 'negative') as neg
      {LAB24} group by date_trunc('hour', processed_timestamp)) g
order by hour desc limit 24
""", floats=("avg_sentiment", "positive_percentage", "negative_percentage"))
def _e21(x):
    return S.sentiment_trend_24h(x.reviews, x.review_as_of)


@query("overall_sentiment", f"""
select review_volume, overall_score,
  case when overall_score > 0.2 then 'positive' when overall_score < -0.2 then 'negative'
       else 'neutral' end as overall_sentiment
from (select count(*) as review_volume, avg(sentiment_score) as overall_score {LAB24}) a
""", floats=("overall_score",))
def _e22(x):
    return S.overall_sentiment(x.reviews, x.review_as_of)


@query("duplicate_reviews", """
select review_id, count(*) as duplicate_count from review_tracking
where sentiment_label is not null group by review_id having count(*) > 1
""")
def _e23(x):
    return S.duplicate_reviews(x.reviews)


@query("daily_sentiment_trend", f"""
select date_trunc('day', processed_timestamp) as date, sentiment_label, count(*) as reviews,
  avg(sentiment_score) as avg_score
from review_tracking where processed_timestamp > {R_NOW} - to_days(30)
group by date_trunc('day', processed_timestamp), sentiment_label
""", floats=("avg_score",))
def _e27(x):
    return S.daily_sentiment_trend(x.reviews, x.review_as_of)


@query("game_sentiment_ranking", f"""
select game_name, count(*) as total_reviews, avg(sentiment_score) as avg_sentiment,
  count(*) filter (where sentiment_label = 'positive') as positive_reviews
from review_tracking where processed_timestamp > {R_NOW} - to_days(7)
group by game_name having count(*) >= 10
""", floats=("avg_sentiment",))
def _e28(x):
    return S.game_sentiment_ranking(x.reviews, x.review_as_of)


TRENDING_CTES = f"""
recent AS (
  select app_id, game_name, avg(sentiment_score) as recent_avg, count(*) as recent_count
  from review_tracking where {_since(4)} and sentiment_label is not null
  group by app_id, game_name having count(*) >= 3),
previous AS (
  select app_id, game_name, avg(sentiment_score) as previous_avg, count(*) as previous_count
  from review_tracking
  where processed_timestamp between {R_NOW} - to_hours(8) and {R_NOW} - to_hours(4)
    and sentiment_label is not null
  group by app_id, game_name having count(*) >= 3)
"""


@query("trending_sentiment", """
select r.app_id, r.game_name, round(r.recent_avg, 3) as recent_sentiment,
  round(p.previous_avg, 3) as previous_sentiment,
  round(r.recent_avg - p.previous_avg, 3) as sentiment_change,
  case when r.recent_avg - p.previous_avg > 0 then 'improving' else 'declining' end as trend_direction,
  r.recent_count + p.previous_count as total_reviews
from recent r join previous p on r.app_id = p.app_id
where abs(r.recent_avg - p.previous_avg) > 0.1
order by abs(r.recent_avg - p.previous_avg) desc, r.app_id, r.game_name limit 10
""", ctes=TRENDING_CTES, floats=("recent_sentiment", "previous_sentiment", "sentiment_change"))
def _d2(x):
    return S.trending_sentiment(x.reviews, x.review_as_of)


# -- the same windows, read from hourly states ---------------------------------

def _window(x, **span):
    return H.window(H.hourly_states(x.reviews), x.reviews, x.review_as_of, **span)


@query("hourly_states", """
select date_trunc('hour', processed_timestamp) as hour, app_id, sentiment_label, count(*) as reviews, count(sentiment_score) as scored,
  coalesce(sum(sentiment_score), 0.0) as score_sum, count(processing_time_ms) as timed, coalesce(sum(processing_time_ms), 0.0) as time_sum
from review_tracking where processed_timestamp is not null group by all
""", floats=("score_sum", "time_sum"))
def _j8_states(x):
    return H.hourly_states(x.reviews)


@query("hourly_game_sentiment_from_states", REGISTRY["hourly_game_sentiment"].sql, floats=("avg_score",))
def _e3_states(x):
    return H.hourly_game_sentiment(_window(x, hours=24))


@query("processing_rate_from_states", REGISTRY["processing_rate_hourly"].sql, floats=("avg_processing_time_ms",))
def _e6_states(x):
    return H.processing_rate_hourly(_window(x, hours=24))


@query("sentiment_trend_from_states", REGISTRY["sentiment_trend_24h"].sql, floats=("avg_sentiment", "positive_percentage", "negative_percentage"))
def _e21_states(x):
    return H.sentiment_trend(_window(x, hours=24))


@query("daily_trend_from_states", REGISTRY["daily_sentiment_trend"].sql, floats=("avg_score",))
def _e27_states(x):
    return H.daily_sentiment_trend(_window(x, days=30))
