"""Registered queries: staging and the per-game mart."""

from __future__ import annotations

from ..operators import marts, staging
from .registry import query


@query("stg_player_tracking", """
select id, app_id, game_name, player_count, timestamp, api_response_time_ms,
  cast(timestamp as date) as date, cast(extract(hour from timestamp) as int) as hour_of_day,
  cast(extract(dow from timestamp) as int) as day_of_week
from player_tracking where player_count > 0
""", floats=("api_response_time_ms",))
def _c1(x):
    return staging.stg_player_tracking(x.players)


@query("tracked_games", """
select app_id, game_name, track_players, track_prices, track_reviews,
  update_interval_minutes as update_interval
from tracking_config where tracking_enabled order by last_updated desc, app_id
""")
def _c2(x):
    return staging.tracked_games(x.config)


_STG = """select * from player_tracking where player_count > 0"""


@query("player_metrics", f"""
select app_id, game_name, avg(player_count) as avg_players, max(player_count) as peak_players
from ({_STG}) s group by app_id, game_name
""", floats=("avg_players",))
def _e7(x):
    return marts.player_metrics(staging.stg_player_tracking(x.players))


@query("game_sentiment_metrics", """
select app_id, game_name, avg(sentiment_score) as avg_sentiment,
  count(*) filter (where sentiment_label = 'positive') as positive_reviews,
  count(*) filter (where sentiment_label = 'negative') as negative_reviews,
  count(*) as total_reviews
from review_tracking where sentiment_label is not null group by app_id, game_name
""", floats=("avg_sentiment",))
def _e8(x):
    return marts.game_sentiment_metrics(x.reviews)


MART_CTES = f"""
p as (
  select app_id, game_name, avg(player_count) as avg_players, max(player_count) as peak_players
  from ({_STG}) s group by app_id, game_name),
s as (
  select app_id, game_name, avg(sentiment_score) as avg_sentiment,
    count(*) filter (where sentiment_label = 'positive') as positive_reviews,
    count(*) filter (where sentiment_label = 'negative') as negative_reviews,
    count(*) as total_reviews
  from review_tracking where sentiment_label is not null group by app_id, game_name)
"""

MART_SQL = """
select p.app_id, p.game_name, p.avg_players, p.peak_players, s.avg_sentiment,
  s.positive_reviews, s.negative_reviews, s.total_reviews,
  cast(round(cast(s.positive_reviews as decimal(20,0)) * 100
             / cast(nullif(s.total_reviews, 0) as decimal(20,0)), 1) as double) as positive_review_pct
from p left join s on p.app_id = s.app_id
"""


@query("mart_game_sentiment", MART_SQL, ctes=MART_CTES,
       floats=("avg_players", "avg_sentiment", "positive_review_pct"))
def _d1(x):
    return marts.mart_game_sentiment(staging.stg_player_tracking(x.players), x.reviews)
