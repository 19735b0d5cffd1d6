"""Fixed table schemas (the relational tables of the tracked-games store).

Ids are carried from ingest, never generated as a contiguous sequence.
Timestamps are naive UTC (``timestamp_ntz``) as the landed Parquet holds them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B, TS = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampNTZType())
PRICE = T.DecimalType(10, 2)


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PLAYER_TRACKING = _st(("id", L), ("app_id", I), ("game_name", S), ("player_count", I),
                      ("timestamp", TS), ("api_response_time_ms", D), ("source", S))

PRICE_TRACKING = _st(("id", L), ("app_id", I), ("game_name", S), ("price_current", PRICE),
                     ("price_original", PRICE), ("discount_percent", I), ("currency", S),
                     ("timestamp", TS), ("price_change_detected", B))

REVIEW_TRACKING = _st(("id", L), ("app_id", I), ("game_name", S), ("review_id", S),
                      ("review_text", S), ("sentiment_score", D), ("sentiment_label", S),
                      ("review_helpful", I), ("review_timestamp", TS),
                      ("processed_timestamp", TS), ("sentiment_confidence", D),
                      ("processing_time_ms", D), ("llm_backend", S), ("processing_method", S))

TRACKING_CONFIG = _st(("app_id", I), ("game_name", S), ("tracking_enabled", B),
                      ("track_players", B), ("track_prices", B), ("track_reviews", B),
                      ("update_interval_minutes", I), ("last_updated", TS), ("added_by", S))

REALTIME_PLAYERS = _st(("id", L), ("app_id", I), ("game_name", S), ("player_count", I),
                       ("timestamp", TS), ("api_response_time_ms", D), ("message_id", S),
                       ("source", S), ("processed_at", TS))

GAME_REGISTRY = _st(
    ("app_id", I), ("name", S), ("type", S), ("is_free", B), ("detailed_description", S),
    ("short_description", S), ("about_the_game", S), ("price_current", PRICE),
    ("price_original", PRICE), ("discount_percent", I), ("currency", S),
    ("release_date", T.DateType()), ("developer", S), ("publisher", S),
    ("platforms", S), ("categories", S), ("genres", S), ("tags", S), ("languages", S),
    ("screenshots", S), ("movies", S), ("pc_requirements", S), ("mac_requirements", S),
    ("linux_requirements", S), ("header_image", S), ("metacritic_score", I),
    ("metacritic_url", S), ("owners_estimate", S), ("players_forever", L),
    ("players_2weeks", L), ("average_playtime_forever", L), ("average_playtime_2weeks", L),
    ("median_playtime_forever", L), ("median_playtime_2weeks", L), ("ccu", L),
    ("last_updated", TS), ("data_quality_score", D), ("tracking_enabled", B))

REPORTS = _st(("id", L), ("report_timestamp", TS), ("overall_status", S), ("total_issues", I),
              ("critical_issues", I), ("report_details", S), ("created_at", TS))

TABLES = {
    "steam_player_tracking": PLAYER_TRACKING,
    "steam_price_tracking": PRICE_TRACKING,
    "steam_review_tracking": REVIEW_TRACKING,
    "game_tracking_config": TRACKING_CONFIG,
    "steam_realtime_players": REALTIME_PLAYERS,
    "steam_game_registry": GAME_REGISTRY,
    "data_quality_reports": REPORTS,
}

# Columns the scorer adds to review rows (defaults when a column is absent).
SCORE_DEFAULTS = {
    "sentiment_confidence": 0.0,
    "processing_time_ms": 0.0,
    "llm_backend": "local",
    "processing_method": "database",
}
