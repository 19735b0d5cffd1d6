"""Sinks (B1-B3, B9-B13): appends, event routing, reports and exports.
Stored tables that batches are merged into are in :mod:`.stored`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefns import anchor
from ..operators import windows as W
from ..schemas import REPORTS
from .stored import append_run, earlier_runs

# Topic routing of tracker events.
TOPICS = {"player_count": "steam-player-counts", "price_update": "steam-price-updates",
          "review_batch": "steam-reviews"}
FALLBACK_TOPIC = "steam-tracking-events"
DISCOVERY_TOPIC = "game-discovery-events"


# -- appends -------------------------------------------------------------

def append_player(df: DataFrame, path: str, run: str | int) -> None:
    """B1: append the readings of a run, partitioned by date (retention drops
    whole dates); a repeated run replaces itself."""
    append_run(df.withColumn("date", F.to_date("timestamp")), path, run, ("date",))


def realtime_rows(valid: DataFrame, as_of=None) -> DataFrame:
    """B2: the stored form of a validated stream message."""
    return (valid.withColumn("game_name", F.coalesce(F.col("game_name"), F.lit("Unknown")))
            .withColumn("processed_at", anchor(as_of)))


def flag_new_prices(stored: DataFrame, batch: DataFrame, eps: float = 0.01) -> DataFrame:
    """Flag each incoming price against the previous price of the game,
    the stored latest one for the first incoming row. Only the stored
    latest row per game (an aggregate) meets the batch."""
    cols = batch.columns
    last = W.latest_price(stored.select("app_id", "timestamp", "price_current"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    both = (last.select("app_id", "price_current", F.lit(True).alias("_stored"), epoch.alias("_order_ts"))
            .unionByName(batch.withColumn("_stored", F.lit(False)).withColumn("_order_ts", F.col("timestamp")),
                         allowMissingColumns=True))
    # The stored latest price sorts first (epoch), then the batch by time.
    flagged = W.price_changes(both, ("_order_ts",), eps)
    return flagged.filter(~F.col("_stored")).select(*cols, "price_change_detected")


def append_prices(spark: SparkSession, batch: DataFrame, path: str, run: int, eps: float = 0.01) -> None:
    """Append a run's prices, each flagged against the previous price;
    stored prices are those of earlier runs, so a repeated run finds the same."""
    stored = earlier_runs(spark, path, run, T.StructType([f for f in batch.schema if f.name in ("app_id", "price_current", "timestamp")]))
    append_run(flag_new_prices(stored, batch, eps), path, run)


# -- events --------------------------------------------------------------

def route_events(events: DataFrame) -> DataFrame:
    """(topic, key, value) rows for a Kafka sink: topic by event type,
    key = app id, value = JSON envelope with the event time."""
    topic = F.coalesce(F.create_map(*[x for k, v in TOPICS.items() for x in (F.lit(k), F.lit(v))])
                       [F.col("event_type")], F.lit(FALLBACK_TOPIC))
    value = F.to_json(F.struct("event_type", "app_id", F.col("timestamp").cast("string").alias("timestamp"),
                               "data"))
    return events.select(topic.alias("topic"), F.col("app_id").cast("string").alias("key"), value.alias("value"))


def discovery_events(registry: DataFrame, as_of=None, source: str = "steam_api") -> DataFrame:
    """One ``game_discovered`` event per stored game."""
    value = F.to_json(F.struct(F.lit("game_discovered").alias("event_type"),
                               anchor(as_of).cast("string").alias("timestamp"), "app_id", "name",
                               "data_quality_score", F.lit(source).alias("discovery_source")))
    return registry.select(F.lit(DISCOVERY_TOPIC).alias("topic"), F.col("app_id").cast("string").alias("key"),
                           value.alias("value"))


def write_events(df: DataFrame, target: str, kafka_servers: str | None = None) -> None:
    """Kafka when servers are given (needs the Kafka connector on the
    classpath), else JSON files partitioned by topic."""
    if kafka_servers:
        df.write.format("kafka").option("kafka.bootstrap.servers", kafka_servers).save()
    else:
        df.write.mode("append").partitionBy("topic").json(target)


# -- reports and exports --------------------------------------------------

def report_row(report: DataFrame, as_of=None) -> DataFrame:
    """The stored form (schema REPORTS) of a one-row report of any kind:
    status, issue counts where it has them, and the whole report as JSON. The
    id is the creation time in microseconds."""
    have = report.columns
    status = next(c for c in ("overall_status", "pipeline_status", "overall_sentiment") if c in have)
    count = lambda c: F.col(c).cast("int") if c in have else F.lit(None).cast("int")
    now = anchor(as_of)
    row = report.select(F.unix_micros(now.cast("timestamp")).alias("id"), now.alias("report_timestamp"),
                        F.col(status).alias("overall_status"), count("total_issues").alias("total_issues"),
                        count("critical_issues").alias("critical_issues"),
                        F.to_json(F.struct(*have)).alias("report_details"), now.alias("created_at"))
    return row.select(*[F.col(f.name).cast(f.dataType) for f in REPORTS])


def append_report(report: DataFrame, path: str, run: str | int, as_of=None) -> None:
    """One stored row per report; a repeated run replaces its row."""
    append_run(report_row(report, as_of), path, run)


def export_rows(projection: DataFrame) -> DataFrame:
    """The labelled rows (C7 projection), newest first."""
    return projection.orderBy(F.desc("processed_timestamp"), "app_id", "sentiment_label", "sentiment_score")


def export_sentiment(projection: DataFrame, path: str, fmt: str = "json") -> None:
    """B12 as files, in order over the files: JSON records or CSV with a
    header."""
    w = export_rows(projection).write.mode("overwrite")
    if fmt.lower() == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)


def evolve_schema(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add missing columns with their default; idempotent."""
    out = df
    for c, v in defaults.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(v))
    return out
