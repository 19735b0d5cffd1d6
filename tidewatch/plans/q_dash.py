"""Registered queries: dashboards (M1-M5, M7, M8; M6 is in q_events)."""

from __future__ import annotations

from ..operators import dashboards as M
from ..operators import staging
from .oracle_views import R_NOW
from .registry import query

STG = "(select * from player_tracking where player_count > 0)"


def _lh(zone):
    return f"cast(hour(timezone({zone}, timestamp at time zone 'UTC')) as int)"


@query("peak_hours", f"""
select app_id, game_name, -max(struct_pack(a := avg_players, b := -hour)).b as peak_hour,
  max(struct_pack(a := avg_players, b := -hour)).a as peak_avg_players
from (select app_id, game_name, {_lh("'America/Chicago'")} as hour, avg(player_count) as avg_players
      from {STG} s group by all) h
group by app_id, game_name
""", floats=("peak_avg_players",))
def _m1(x):
    return M.peak_hours(staging.stg_player_tracking(x.players))


@query("activity_heatmap", f"""
select cast(extract(dow from timestamp) as int) as day_of_week, cast(extract(hour from timestamp) as int) as hour_of_day,
  avg(player_count) as avg_players, count(*) as readings
from {STG} s group by all
""", floats=("avg_players",))
def _m2(x):
    return M.activity_heatmap(staging.stg_player_tracking(x.players))


@query("weekend_uplift", f"""
select *, (weekend_avg - weekday_avg) / nullif(weekday_avg, 0) * 100 as uplift_pct
from (select app_id, game_name,
        avg(player_count) filter (where extract(dow from timestamp) not in (0, 6)) as weekday_avg,
        avg(player_count) filter (where extract(dow from timestamp) in (0, 6)) as weekend_avg
      from {STG} s group by app_id, game_name) a
""", floats=("weekday_avg", "weekend_avg", "uplift_pct"))
def _m3(x):
    return M.weekend_uplift(staging.stg_player_tracking(x.players))


@query("player_sentiment_correlation", f"""
select p.app_id, case when not isnan(corr(avg_players, avg_sentiment)) then corr(avg_players, avg_sentiment) end as correlation, count(*) as hours
from (select app_id, date_trunc('hour', timestamp) as hour, avg(player_count) as avg_players
      from {STG} s group by all) p
join (select app_id, date_trunc('hour', processed_timestamp) as hour, avg(sentiment_score) as avg_sentiment
      from review_tracking where sentiment_label is not null group by all) r
  on p.app_id = r.app_id and p.hour = r.hour
group by p.app_id
""", floats=("correlation",))
def _m4(x):
    return M.player_sentiment_correlation(staging.stg_player_tracking(x.players), x.reviews)


@query("executive_kpis", f"""
select count(*) as review_volume, avg(sentiment_score) as avg_sentiment, count(distinct app_id) as games_analyzed,
  coalesce(cast(count(*) filter (where sentiment_label = 'positive') as double)
           / cast(nullif(count(*), 0) as double) * 100, 0.0) as positive_share
from review_tracking
where sentiment_label is not null and processed_timestamp > {R_NOW} - to_hours(24)
""", floats=("avg_sentiment", "positive_share"))
def _m5(x):
    return M.executive_kpis(x.reviews, x.review_as_of)


_ZONES = ", ".join(f"'{z}'" for z in M.DEFAULT_ZONES)


@query("timezone_peaks", f"""
select zone, -max(struct_pack(a := avg_players, b := -hour)).b as peak_hour,
  max(struct_pack(a := avg_players, b := -hour)).a as peak_avg_players
from (select zone, {_lh('zone')} as hour, avg(player_count) as avg_players
      from (select player_count, timestamp, unnest([{_ZONES}]) as zone from {STG} s) z
      group by all) h
group by zone
""", floats=("peak_avg_players",))
def _m7(x):
    return M.timezone_peaks(staging.stg_player_tracking(x.players))


@query("review_volume_quality", """
select app_id, cast(processed_timestamp as date) as date, count(*) as reviews,
  avg(sentiment_confidence) as avg_confidence, avg(review_helpful) as avg_helpful,
  count(*) filter (where sentiment_confidence < 0.3) / count(*) * 100 as low_confidence_pct
from review_tracking where sentiment_label is not null group by all
""", floats=("avg_confidence", "avg_helpful", "low_confidence_pct"))
def _m8(x):
    return M.review_volume_quality(x.reviews)
