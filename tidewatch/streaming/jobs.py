"""Structured Streaming jobs.

Sources are Kafka topics (``format('kafka')``, needs the Kafka connector on
the classpath), landed logs with offsets (``sources.landed_log``) or folders
of JSON-lines files; all yield a ``value`` string column. Every job is
``readStream -> column transforms -> writeStream`` with a checkpoint in the
shared folder, so a restarted job resumes where its last committed
micro-batch ended. ``foreachBatch`` sinks write each batch to a folder named
by its batch id in overwrite mode: a replayed batch replaces itself instead
of appending twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frames import parse_once
from ..operators import merge as M
from ..operators import scoring as K
from ..operators import windows as W
from ..sinks.stored import StoredTable, exists
from ..sinks.writers import realtime_rows
from ..sources.landed_log import first_offsets, read_log, stream_log
from .ordered import Ordered

PLAYER_TOPIC = "steam-player-counts"
REVIEW_TOPIC = "steam-reviews"

#: A flat message and the tracker's envelope in one: they share app_id and timestamp.
PLAYER_MESSAGE = ("app_id int, player_count bigint, timestamp string, source string, api_response_time_ms double, "
                  "message_id string, game_name string, data string")
ENVELOPE_PLAYER = "app_id int, player_count bigint, timestamp string, api_response_time_ms double, source string"
REVIEW_ENVELOPE = ("event_type string, app_id int, timestamp string, data struct<reviews: array<struct<"
                   "app_id: int, review_id: string, review_text: string, review_helpful: int, "
                   "review_timestamp: string>>>")


# -- sources ---------------------------------------------------------------

def read_stream(spark: SparkSession, topic: str, path: str | None = None, kafka_servers: str | None = None,
                max_per_trigger: int | None = None, log: str | None = None, min_per_trigger: int | None = None, max_delay: str = "30s") -> DataFrame:
    """A2: subscribe from the earliest offset (Kafka), follow a landed log
    (``log``) or watch a folder of JSON-lines files; returns (key, value)
    strings. ``min_per_trigger`` holds a Kafka batch back until so many
    messages are there or ``max_delay`` has passed."""
    key = F.lit(None).cast("string").alias("key")
    if kafka_servers:
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("subscribe", topic).option("startingOffsets", "earliest"))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        if min_per_trigger:
            r = r.option("minOffsetsPerTrigger", min_per_trigger).option("maxTriggerDelay", max_delay)
        return r.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    if log:
        return stream_log(spark, log).select(key, "value")
    r = spark.readStream.format("text")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    return r.load(path).select(key, F.col("value"))


def kafka_ends(topic: str, starts: dict[int, int], n: int) -> str:
    """``endingOffsets`` of at most ``n`` messages of each partition."""
    return json.dumps({topic: {str(p): o + n for p, o in starts.items()}})


def read_topic_bounded(spark: SparkSession, n: int, topic: str = PLAYER_TOPIC, log: str | None = None,
                       kafka_servers: str | None = None, starts: dict[int, int] | None = None) -> DataFrame:
    """A4: the first ``n`` messages as a batch, by partition and offset (the
    bound is the feature). Of a landed log only these are read. Of a Kafka
    topic, whose partitions' first offsets are given, at most ``n`` of each
    partition are read, and the first of them taken."""
    if kafka_servers:
        df = (spark.read.format("kafka").option("kafka.bootstrap.servers", kafka_servers).option("subscribe", topic)
              .option("startingOffsets", json.dumps({topic: {str(p): o for p, o in starts.items()}})).option("endingOffsets", kafka_ends(topic, starts, n)).load())
        return df.orderBy("partition", "offset").limit(n).select(F.col("value").cast("string").alias("value"))
    return read_log(spark, log, ending=first_offsets(log, n)).select("value")


def decode_safe(df: DataFrame, schema: str) -> DataFrame:
    """A3: tolerant decode: a value that is no JSON object of this schema
    gives a record with NULL fields and is flagged ``_corrupt`` for the
    dead-letter sink; the stream never fails on a bad message."""
    parsed = parse_once(df, "value", f"{schema}, _bad string", "_m", {"columnNameOfCorruptRecord": "_bad"})
    return parsed.withColumn("_corrupt", F.col("_m").isNull() | F.col("_m._bad").isNotNull())


def naive_time(text) -> F.Column:
    """ISO text as a naive UTC timestamp; NULL for any other text."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def normalize_player_event(df: DataFrame, accept_envelope: bool = True) -> DataFrame:
    """Accept the flat message and (unless ``accept_envelope=False``,
    the reference consumer's behaviour) the tracker envelope
    ``{event_type, app_id, timestamp, data:{...}}``, whose message id is
    rebuilt as ``<app_id>_<epoch seconds>``."""
    m = parse_once(df.select("value"), "value", PLAYER_MESSAGE, "m")
    if accept_envelope:
        m = parse_once(m.withColumn("data", F.col("m.data")), "data", ENVELOPE_PLAYER, "d")
        use_env = F.col("data").isNotNull()
    else:
        use_env = F.lit(False)

    def pick(field):
        flat = F.col(f"m.{field}")
        if not accept_envelope:
            return flat
        inner = F.col(f"d.{field}")
        return F.when(use_env, F.coalesce(inner, flat) if field in ("app_id", "timestamp") else inner).otherwise(flat)
    # the time is a column of its own below the rest, so that it is read once
    timed = m.select("*", F.explode(F.array(F.struct(pick("app_id").alias("app_id"), pick("timestamp").alias("text"), naive_time(pick("timestamp")).alias("time")))).alias("t"))
    app, time = F.col("t.app_id"), F.col("t.time")
    env_id = F.concat_ws("_", app.cast("string"), F.unix_seconds(time.cast("timestamp")).cast("string"))
    return timed.select(
        app.alias("app_id"), pick("player_count").try_cast("int").alias("player_count"),
        F.col("t.text").alias("timestamp_text"), time.alias("timestamp"),
        pick("api_response_time_ms").alias("api_response_time_ms"),
        F.coalesce(pick("source"), F.lit("kafka_stream")).alias("source"),
        F.when(use_env, F.when(app.isNotNull() & time.isNotNull(), env_id)).otherwise(F.col("m.message_id")).alias("message_id"),
        F.when(use_env, F.lit(None)).otherwise(F.col("m.game_name")).alias("game_name"),
        F.col("value").alias("raw"))


def valid_player_message(df: DataFrame) -> F.Column:
    """C4: app_id, player_count and timestamp must be truthy (0 and '' are
    rejected like NULL), and the timestamp a time."""
    return F.col("timestamp").isNotNull() & (F.coalesce(F.col("app_id"), F.lit(0)) != 0) & (F.coalesce(F.col("player_count"), F.lit(0)) != 0) \
        & (F.coalesce(F.col("timestamp_text"), F.lit("")) != "")


# -- J1: player ingest ---------------------------------------------------------

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def player_ingest_batch(batch: DataFrame, batch_id: int, table: str, dead_letter: str, dedupe: bool = False) -> None:
    """One micro-batch of J1: valid rows to the table (B2) by date, rejects to
    the dead letter; both in folders of the batch, so a replay is idempotent.
    The batch is kept while it is used: each use would read, parse and look up
    its messages again."""
    batch = batch.persist()
    ok = valid_player_message(batch)
    rows = realtime_rows(batch.filter(ok).drop("raw", "timestamp_text")).withColumn("date", F.to_date("timestamp"))
    if dedupe:
        rows = not_stored(rows, batch_id, table)
    (rows.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "batch").parquet(table))
    batch.filter(~F.coalesce(ok, F.lit(False))).select("raw").write.mode("overwrite") \
        .parquet(f"{dead_letter}/batch={batch_id}")
    batch.unpersist()


def stream_player_ingest(spark: SparkSession, source: DataFrame, table: str, dead_letter: str,
                         checkpoint: str, dedupe: bool = False, available_now: bool = True, remember: str = "1 day"):
    """J1 (+J10 when ``dedupe``): decode, validate, store; invalid messages
    go to the dead letter and the stream continues."""
    events = normalize_player_event(source)
    if dedupe:
        events = dedupe_messages(events, remember)
    w = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda b, i: player_ingest_batch(b, i, table, dead_letter, dedupe))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def dedupe_messages(events: DataFrame, remember: str = "1 day") -> DataFrame:
    """J10 (opt-in), in the stream: of valid messages with one id the first,
    if the others arrive within ``remember``. The ids are in Spark's state
    store (RocksDB: on disk, dropped once ``remember`` has passed). The
    watermark is that of arrival, so no message is too late, whatever its own
    time; messages without an id, and invalid ones, are all kept."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    named = valid_player_message(events) & F.col("message_id").isNotNull()
    marked = events.withColumns({"_arrived": F.current_timestamp(), "_id": F.when(named, F.concat(F.lit("m"), F.col("message_id"))).otherwise(F.expr("uuid()"))})
    return marked.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["_id"]).drop("_arrived", "_id")


def not_stored(rows: DataFrame, batch_id: int, table: str) -> DataFrame:
    """J10, behind the stream's memory: rows whose id no earlier batch has
    stored. A repeated message has its first one's time, so only the folders
    of the batch's dates are listed and read."""
    spark = rows.sparkSession
    dates = [r[0] for r in rows.filter(F.col("message_id").isNotNull()).select("date").distinct().collect()]  # of one batch
    folders = [f for f in (f"{table}/date={d}" for d in dates) if exists(spark, f)]
    if not folders:
        return rows
    stored = (spark.read.schema("message_id string, date date, batch long").option("basePath", table).parquet(*folders)
              .filter((F.col("batch") < batch_id) & F.col("message_id").isNotNull()).select("message_id"))
    return rows.join(stored, "message_id", "left_anti").select(*rows.columns)


# -- J4 / J5: change detection in event-time order -----------------------------

READING = T.StructType([T.StructField("app_id", T.IntegerType()), T.StructField("game_name", T.StringType()), T.StructField("player_count", T.IntegerType()),
                        T.StructField("timestamp", T.TimestampNTZType()), T.StructField("message_id", T.StringType())])
PRICE = T.StructType([T.StructField("app_id", T.IntegerType()), T.StructField("price_current", T.DoubleType()), T.StructField("timestamp", T.TimestampNTZType()),
                      T.StructField("_row", T.BooleanType())])
DELAY = timedelta(minutes=10)


def significant_changes(spark: SparkSession, folder: str, pct: float = 20, delay: timedelta = DELAY) -> Ordered:
    """J4's state and results in ``folder``: F2 over the stream's valid
    readings, equal times ordered by message id."""
    return Ordered(spark, folder, READING, "app_id", ("timestamp", "message_id"), ("player_count",), lambda r: W.changes_of(r, pct), delay)


def stream_significant_changes(events: DataFrame, folder: str, checkpoint: str, pct: float = 20, delay: timedelta = DELAY, available_now: bool = True):
    """Readings that changed by more than ``pct`` % against the previous
    one in time; messages up to ``delay`` late count in their place."""
    valid = events.filter(valid_player_message(events)).select(*READING.names)
    return significant_changes(events.sparkSession, folder, pct, delay).start(valid, checkpoint, available_now)


def price_changes(spark: SparkSession, folder: str, eps: float = 0.01, delay: timedelta = DELAY) -> Ordered:
    """J5's state and results in ``folder``: F3 over the stream's prices. A
    missing price is carried like any other; ``_row`` tells it from none."""
    return Ordered(spark, folder, PRICE, "app_id", ("timestamp",), ("price_current", "_row"), lambda r: W.flags_of(r, eps), delay)


def stream_price_changes(prices: DataFrame, folder: str, checkpoint: str, eps: float = 0.01, delay: timedelta = DELAY, available_now: bool = True):
    """Every price with its F3 flag."""
    rows = prices.select("app_id", F.col("price_current").cast("double").alias("price_current"), "timestamp", F.lit(True).alias("_row"))
    return price_changes(prices.sparkSession, folder, eps, delay).start(rows, checkpoint, available_now)


# -- J3 / J6 / J7: reviews -------------------------------------------------------

def stream_review_explode(source: DataFrame) -> DataFrame:
    """Keep ``review_batch`` events, one row per review, parent app id
    stamped and ``Game_<id>`` as default name."""
    ev = parse_once(source.select("value"), "value", REVIEW_ENVELOPE, "e").filter(F.col("e.event_type") == "review_batch")
    r = ev.select(F.col("e.app_id").alias("app_id"), F.explode("e.data.reviews").alias("r"))
    return r.select("app_id", F.concat(F.lit("Game_"), F.col("app_id").cast("string")).alias("game_name"),
                    F.col("r.review_id").alias("review_id"), F.col("r.review_text").alias("review_text"),
                    F.coalesce(F.col("r.review_helpful"), F.lit(0)).alias("review_helpful"),
                    naive_time(F.col("r.review_timestamp")).alias("review_timestamp"))


def score_and_upsert_batch(spark: SparkSession, batch: DataFrame, batch_id: int, path: str, score: Callable[..., DataFrame] = K.score_reviews) -> None:
    """J6 micro-batch: score (K1, by the word list or a learned scorer's
    ``score``) then upsert scores by review id (B5), in the
    order of arrival within the batch; only the folders of the batch's key
    ranges and days are written. A replayed batch gives the same table."""
    order = batch.withColumn("_seq", F.monotonically_increasing_id())
    scored = score(order, method="stream").withColumn("id", F.xxhash64("review_id"))
    stored = T.StructType([f for f in scored.schema if f.name != "_seq"])
    StoredTable(spark, path, "review_id", "review_timestamp").upsert(
        scored, lambda current, new: M.upsert_review_scores(current, new, seq="_seq"), batch_id, stored)


def stream_score_reviews(spark: SparkSession, source: DataFrame, table_root: str, checkpoint: str,
                         available_now: bool = True, score: Callable[..., DataFrame] = K.score_reviews):
    """Stream of review batches -> scored upserts; the trigger and the
    checkpoint replace the reference's flush-on-next-message buffer."""
    rows = stream_review_explode(source)
    w = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda b, i: score_and_upsert_batch(spark, b, i, table_root, score))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def incremental_score_table(reviews: DataFrame, as_of=None) -> DataFrame:
    """One run of the table scorer: every pending review (C3 bulk form),
    scored (K1), applied by id (B6). Returns the new table state."""
    pending = reviews.filter(F.col("sentiment_label").isNull() & F.col("review_text").isNotNull()
                             & (F.col("review_text") != ""))
    scored = K.score_reviews(pending, as_of).withColumn("_seq", F.col("id"))
    return M.update_scores_by_id(reviews, scored, seq="_seq")


# -- J8 / J9: windows and throughput ---------------------------------------------

def hourly_sentiment_stream(scored: DataFrame) -> DataFrame:
    """Tumbling 1-hour windows of labelled reviews: count and mean score.
    Run in ``update`` mode into a sink that replaces hours (or in
    ``complete`` mode): an hour is sent again whenever a review of it
    arrives, however late. State is one row per hour."""
    ev = scored.filter(F.col("sentiment_label").isNotNull())
    return (ev.groupBy(F.window(F.col("processed_timestamp").cast("timestamp"), "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("reviews_processed"), F.avg("sentiment_score").alias("avg_score"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "reviews_processed", "avg_score"))


def throughput_stats(scored: DataFrame) -> DataFrame:
    """Processed rows, scoring errors and rows per second of scoring
    time for one batch of scored rows."""
    err = F.col("score_error") if "score_error" in scored.columns else F.lit(False)
    return scored.agg(F.count(F.lit(1)).alias("processed"), F.count_if(err).alias("errors"),
                      F.sum("processing_time_ms").alias("scoring_ms")).withColumn(
        "rows_per_second", F.try_divide(F.col("processed") * 1000.0, F.col("scoring_ms")))


def progress_summary(query) -> dict:
    """J9 for a running query: rows and rates from ``recentProgress``."""
    p = query.recentProgress
    rows = sum(x.get("numInputRows", 0) for x in p)
    rate = [x.get("processedRowsPerSecond") for x in p if x.get("processedRowsPerSecond")]
    return {"batches": len(p), "rows": rows, "max_rows_per_second": max(rate) if rate else 0.0}

