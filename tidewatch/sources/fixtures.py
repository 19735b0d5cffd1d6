"""Views of the tracked-games tables over the driver's input tables.

The input Parquet (``events``, ``documents``, ``lineitem``, ``part``) is mapped
onto the store's relational schema exactly as FIXTURES.md specifies, so every
operator runs over data whose size grows with the inputs. All mappings are
column expressions (no UDF); predicates on ``timestamp`` /
``processed_timestamp`` map straight onto ``events.ts`` and reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_input

PLAYER_EVENTS = ("view", "click", "signup")
REVIEW_EVENTS = ("purchase", "error")
#: A third of all events belongs to one game, a third to a few, a third to a tail that grows with the users.
HOT_GAME, POPULAR = 1, 8
#: Games whose labelled reviews are all positive, and all negative.
LOVED_GAME, HATED_GAME = 2, 3


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def _game() -> tuple[F.Column, F.Column]:
    third = F.col("event_id") % 3
    app = (F.when(third == 0, F.lit(HOT_GAME)).when(third == 1, F.col("user_id") % POPULAR + 2)
           .otherwise(F.col("user_id") + POPULAR + 2)).cast("int")
    return app, F.concat(F.lit("Game_"), app.cast("string"))


def player_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_input(spark, sf_dir, "events").filter(F.col("event_type").isin(*PLAYER_EVENTS))
    app, name = _game()
    return ev.select(
        F.col("event_id").alias("id"), app.alias("app_id"), name.alias("game_name"),
        F.floor(F.col("value") * 10).cast("int").alias("player_count"),
        F.col("ts").alias("timestamp"),
        (_k() * F.lit(120.0)).cast("double").alias("api_response_time_ms"),
        F.lit("events").alias("source"))


def review_tracking(spark: SparkSession, sf_dir: str, text: str | None = None) -> DataFrame:
    """Reviews. ``text``: None leaves the documents join out (column pruning
    cannot drop an outer join by itself), ``"key"`` adds ``text_key`` (the
    document to fetch later), ``"flag"`` adds ``has_text`` without
    reading the texts, ``"whole"`` adds ``review_text`` as well. Review n has
    the text of document ``n % number of documents``: all documents are used."""
    ev = (read_input(spark, sf_dir, "events")
          .filter(F.col("event_type").isin(*REVIEW_EVENTS))
          .withColumn("k", _k()))
    app, name = _game()
    k = F.col("k")
    positive = (app == LOVED_GAME) | ((app != HATED_GAME) & (F.col("event_type") == "purchase"))
    neutral = (k < 30) & ~app.isin(LOVED_GAME, HATED_GAME)
    label = (F.when(k < 10, F.lit(None).cast("string")).when(neutral, "neutral")
             .when(positive, "positive").otherwise("negative"))
    score = (F.when(k < 10, F.lit(None)).when(neutral, F.lit(0.0))
             .when(positive, k / F.lit(100.0)).otherwise(-k / F.lit(100.0))).cast("double")
    cols = [
        F.col("event_id").alias("id"), app.alias("app_id"), name.alias("game_name"),
        F.concat(F.lit("r"), F.floor(F.col("event_id") / 2).cast("bigint").cast("string")).alias("review_id"),
        label.alias("sentiment_label"), score.alias("sentiment_score"),
        (k % 7).cast("int").alias("review_helpful"),
        (F.col("ts") - F.make_dt_interval(F.lit(0), k)).alias("review_timestamp"),
        F.col("ts").alias("processed_timestamp"),
        (k / F.lit(100.0)).cast("double").alias("sentiment_confidence"),
        (F.col("value") * 100).alias("processing_time_ms"),
        F.lit("local").alias("llm_backend"),
    ]
    if text is None:
        return ev.select(*cols)
    docs = read_input(spark, sf_dir, "documents")
    ev = ev.withColumn("text_key", F.col("event_id") % docs.select(F.count(F.lit(1)).alias("n")).scalar())
    if text == "key":
        return ev.select(*cols, "text_key")
    kept = [F.col("doc_id").alias("text_key"), F.col("n_chars").isNotNull().alias("has_text")]
    if text == "whole":
        kept.append(F.col("text").alias("review_text"))
    joined = ev.join(docs.select(*kept), "text_key", "left").withColumn("has_text", F.coalesce("has_text", F.lit(False)))
    extra = ["review_text"] if text == "whole" else []
    return joined.select(*cols[:4], *extra, *cols[4:], "has_text")


def tracking_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configured game per part; flags and the last change come from its
    columns. Most configured games have no events and some are disabled."""
    anchor = read_input(spark, sf_dir, "events").select(F.max("ts")).scalar()
    size = F.col("p_size")
    return read_input(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("app_id"),
        F.concat(F.lit("Game_"), F.col("p_partkey").cast("string")).alias("game_name"),
        (size % 10 != 0).alias("tracking_enabled"), (size % 7 != 0).alias("track_players"),
        (size % 2 == 0).alias("track_prices"), (size % 3 != 0).alias("track_reviews"),
        F.when(size % 5 == 0, 60).otherwise(15).alias("update_interval_minutes"),
        (anchor - F.make_dt_interval(F.lit(0), size.cast("int"))).alias("last_updated"))


def price_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_input(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").cast("int").alias("app_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price_current"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"))


def game_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_input(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").cast("int").alias("app_id"), F.col("p_name").alias("name"),
        F.when(size % 5 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("type"),
        F.when(size % 7 == 0, F.lit(" ")).otherwise(F.col("p_brand")).alias("developer"),
        F.when(size % 3 == 0, F.lit(None)).otherwise(
            F.col("p_retailprice").cast("decimal(10,2)")).alias("price_current"),
        F.when(size % 2 == 0, F.lit("[]")).otherwise(F.lit('["a"]')).alias("genres"),
        size.alias("p_size"))
