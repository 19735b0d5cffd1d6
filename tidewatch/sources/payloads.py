"""Parsers for landed API payloads (A5-A10).

Collectors land raw response bodies (one JSON document per row, with the
request's app id and fetch metadata); these functions turn them into typed
rows with ``from_json`` and column expressions, so parsing is distributed
with the files and never touches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frames import parse_once

PLAYER_BODY = "response struct<player_count: bigint>"
PRICE_ENTRY = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("data", T.StructType([T.StructField("price_overview", T.StructType([
        T.StructField("final", T.LongType()), T.StructField("initial", T.LongType()),
        T.StructField("discount_percent", T.IntegerType()), T.StructField("currency", T.StringType())]))]))])
REVIEWS_BODY = ("success int, reviews array<struct<recommendationid: string, review: string, "
                "votes_helpful: int, timestamp_created: bigint>>")
APP_LIST_BODY = "applist struct<apps: array<struct<appid: int, name: string>>>"
DETAILS_DATA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("is_free", T.BooleanType()), T.StructField("short_description", T.StringType()),
    T.StructField("detailed_description", T.StringType()), T.StructField("about_the_game", T.StringType()),
    T.StructField("release_date", T.StructType([T.StructField("date", T.StringType())])),
    T.StructField("developers", T.ArrayType(T.StringType())),
    T.StructField("publishers", T.ArrayType(T.StringType())),
    T.StructField("platforms", T.MapType(T.StringType(), T.BooleanType())),
    T.StructField("categories", T.ArrayType(T.StructType([T.StructField("description", T.StringType())]))),
    T.StructField("genres", T.ArrayType(T.StructType([T.StructField("description", T.StringType())]))),
    T.StructField("supported_languages", T.StringType()),
    T.StructField("header_image", T.StringType()),
    T.StructField("screenshots", T.ArrayType(T.StructType([T.StructField("path_full", T.StringType())]))),
    T.StructField("movies", T.ArrayType(T.StructType([T.StructField(
        "webm", T.StructType([T.StructField("max", T.StringType())]))]))),
    T.StructField("pc_requirements", T.StringType()), T.StructField("mac_requirements", T.StringType()),
    T.StructField("linux_requirements", T.StringType()),
    T.StructField("metacritic", T.StructType([T.StructField("score", T.IntegerType()),
                                             T.StructField("url", T.StringType())])),
    T.StructField("price_overview", T.StructType([
        T.StructField("final", T.LongType()), T.StructField("initial", T.LongType()),
        T.StructField("discount_percent", T.IntegerType()), T.StructField("currency", T.StringType())])),
])
DETAILS_ENTRY = T.StructType([T.StructField("success", T.BooleanType()), T.StructField("data", DETAILS_DATA)])
OWNERS_BODY = ("error string, owners string, owners_variance bigint, players_forever bigint, "
               "players_2weeks bigint, average_forever bigint, average_2weeks bigint, "
               "median_forever bigint, median_2weeks bigint")
# The store's release-date spellings ("21 Aug, 2012", "Aug 21, 2012").
DATE_FORMATS = ("d MMM, yyyy", "MMM d, yyyy")


def _ntz(col):
    return col.cast("timestamp_ntz")


def _units(cents) -> F.Column:
    """Integer cents as DECIMAL(10,2); NULL where they do not fit."""
    return (cents.cast("decimal(20,0)") / F.lit(100)).try_cast("decimal(10,2)")


def _entry(raw: DataFrame, body: str, entry: T.StructType, *keep: str) -> DataFrame:
    """The successful entry ``e`` of each body, an object keyed by app id.
    Exploding the parsed object keeps the parse in one place: a filter on its
    result cannot be pushed below it and parse again."""
    parsed = F.explode(F.from_json(F.col(body), T.MapType(T.StringType(), entry))).alias("k", "e")
    rows = raw.select(F.col("app_id").cast("int").alias("app_id"), *keep, parsed)
    return rows.filter((F.col("k") == F.col("app_id").cast("string")) & F.coalesce(F.col("e.success"), F.lit(False))).drop("k")


def parse_player_payload(raw: DataFrame, body: str = "body", fetched_at: str = "fetched_at",
                         latency_ms: str = "latency_ms", source: str = "dynamic_tracker") -> DataFrame:
    """A5: ``{response: {player_count}}`` -> reading; a body without the
    count is dropped; latency rounded to 2 dp (half-even, as Python);
    ``message_id`` = ``<app_id>_<epoch seconds>``."""
    out = parse_once(raw, body, PLAYER_BODY, "_p").select(
        F.col("app_id").cast("int").alias("app_id"),
        F.col("_p.response.player_count").cast("int").alias("player_count"),
        F.col(fetched_at).alias("timestamp"),
        F.bround(F.col(latency_ms), 2).alias("api_response_time_ms"),
        F.lit(source).alias("source"),
        F.concat_ws("_", F.col("app_id").cast("string"),
                    F.unix_seconds(F.col(fetched_at).cast("timestamp")).cast("string")).alias("message_id"))
    return out.filter(F.col("player_count").isNotNull())


def parse_price_payload(raw: DataFrame, body: str = "body", fetched_at: str = "fetched_at") -> DataFrame:
    """Body is an object keyed by app id; the entry must exist and have
    ``success``; prices are cents / 100 as DECIMAL(10,2); without ``price_overview`` (free
    title) the row is 0.0 / 0.0 / 0 / 'USD'."""
    ok = _entry(raw.withColumn("timestamp", F.col(fetched_at)), body, PRICE_ENTRY, "timestamp")
    po = F.col("e.data.price_overview")
    free = F.lit(0).cast("decimal(10,2)")
    return ok.select("app_id",
                     F.when(po.isNotNull(), _units(F.coalesce(po["final"], F.lit(0)))).otherwise(free).alias("price_current"),
                     F.when(po.isNotNull(), _units(F.coalesce(po["initial"], F.lit(0)))).otherwise(free).alias("price_original"),
                     F.when(po.isNotNull(), F.coalesce(po["discount_percent"], F.lit(0))).otherwise(0).alias("discount_percent"),
                     F.when(po.isNotNull(), F.coalesce(po["currency"], F.lit("USD"))).otherwise("USD").alias("currency"),
                     "timestamp")


def explode_review_payload(raw: DataFrame, body: str = "body") -> DataFrame:
    """``success == 1`` -> one row per review; epoch -> UTC timestamp
    (0 / NULL -> NULL); missing text -> ''; missing votes -> 0."""
    ok = parse_once(raw.select(F.col("app_id").cast("int").alias("app_id"), body), body, REVIEWS_BODY, "_p").filter(F.col("_p.success") == 1)
    r = ok.select("app_id", F.explode("_p.reviews").alias("r"))
    return r.select(
        "app_id", F.col("r.recommendationid").alias("review_id"),
        F.coalesce(F.col("r.review"), F.lit("")).alias("review_text"),
        F.coalesce(F.col("r.votes_helpful"), F.lit(0)).alias("review_helpful"),
        _ntz(F.timestamp_seconds(F.nullif(F.col("r.timestamp_created"), F.lit(0)))).alias("review_timestamp"))


def explode_app_list(raw: DataFrame, max_n: int | None = None, body: str = "body") -> DataFrame:
    """``applist.apps`` -> (appid, name): the first ``max_n`` entries of
    each document, *then* entries with a NULL or 1-character name dropped."""
    p = F.from_json(F.col(body), APP_LIST_BODY)
    e = raw.select(F.posexplode(p["applist"]["apps"]).alias("pos", "a"))
    if max_n is not None:
        e = e.filter(F.col("pos") < max_n)
    return (e.select(F.col("a.appid").alias("appid"), F.col("a.name").alias("name"))
            .filter(F.col("name").isNotNull() & (F.length("name") >= 2)))


def _json_list(arr_col, field: str):
    return F.to_json(F.coalesce(F.transform(arr_col, lambda x: x[field]), F.array().cast("array<string>")))


def parse_store_date(col) -> F.Column:
    """Store date text -> DATE; unparsable (e.g. 'Coming soon') -> NULL."""
    return F.coalesce(*[F.try_to_date(col, f) for f in DATE_FORMATS])


def flatten_app_details(raw: DataFrame, body: str = "body") -> DataFrame:
    """Store details -> registry record (defaults as in the collector;
    arrays of objects become JSON lists of one field; developers joined by
    ', '; price cents -> units with 0 -> NULL; release date parsed, with the
    original text kept in ``release_date_text``)."""
    d = _entry(raw, body, DETAILS_ENTRY).select("app_id", "e.data")
    g = lambda c: F.col(f"data.{c}")
    po = g("price_overview")
    date_text = g("release_date.date")
    return d.select(
        "app_id", F.coalesce(g("name"), F.lit("")).alias("name"), F.coalesce(g("type"), F.lit("")).alias("type"),
        F.coalesce(g("is_free"), F.lit(False)).alias("is_free"),
        F.coalesce(g("short_description"), F.lit("")).alias("short_description"),
        F.coalesce(g("detailed_description"), F.lit("")).alias("detailed_description"),
        F.coalesce(g("about_the_game"), F.lit("")).alias("about_the_game"),
        _units(F.nullif(po["final"], F.lit(0))).alias("price_current"),
        _units(F.nullif(po["initial"], F.lit(0))).alias("price_original"),
        po["discount_percent"].alias("discount_percent"), po["currency"].alias("currency"),
        parse_store_date(date_text).alias("release_date"), date_text.alias("release_date_text"),
        F.array_join(F.coalesce(g("developers"), F.array()), ", ").alias("developer"),
        F.array_join(F.coalesce(g("publishers"), F.array()), ", ").alias("publisher"),
        F.to_json(F.coalesce(g("platforms"), F.create_map().cast("map<string,boolean>"))).alias("platforms"),
        _json_list(g("categories"), "description").alias("categories"),
        _json_list(g("genres"), "description").alias("genres"),
        F.to_json(F.array(F.coalesce(g("supported_languages"), F.lit(""))))
        .substr(F.lit(2), F.length(F.to_json(F.array(F.coalesce(g("supported_languages"), F.lit(""))))) - 2)
        .alias("languages"),
        F.coalesce(g("header_image"), F.lit("")).alias("header_image"),
        _json_list(g("screenshots"), "path_full").alias("screenshots"),
        F.to_json(F.coalesce(F.transform(g("movies"), lambda x: x["webm"]["max"]),
                             F.array().cast("array<string>"))).alias("movies"),
        *[F.coalesce(g(c), F.lit("{}")).alias(c) for c in ("pc_requirements", "mac_requirements", "linux_requirements")],
        g("metacritic.score").alias("metacritic_score"), g("metacritic.url").alias("metacritic_url"))


def flatten_owner_estimates(raw: DataFrame, body: str = "body") -> DataFrame:
    """A10: the eight ownership / playtime estimates; a body with ``error``,
    a broken one or one without any of them yields no row."""
    fields = ("owners", "owners_variance", "players_forever", "players_2weeks", "average_forever", "average_2weeks",
              "median_forever", "median_2weeks")
    parsed = raw.select(F.col("app_id").cast("int").alias("app_id"), F.inline(F.array(F.from_json(F.col(body), OWNERS_BODY))))
    known = F.coalesce(*[F.col(c).cast("string") for c in fields]).isNotNull()
    return parsed.filter(F.col("error").isNull() & known).select(
        "app_id", F.col("owners").alias("owners_estimate"), *fields[1:])


def merge_estimates(details: DataFrame, estimates: DataFrame) -> DataFrame:
    """Overlay estimates on details by app id; games without estimates
    keep what they have (left join, estimates win where present)."""
    cols = [c for c in estimates.columns if c != "app_id"]
    kept = [c for c in details.columns if c not in cols]
    j = details.alias("d").join(estimates.alias("e"), "app_id", "left")
    have = F.col("e.owners_estimate").isNotNull() if "owners_estimate" in cols else F.lit(True)
    over = [(F.when(have, F.col(f"e.{c}")).otherwise(F.col(f"d.{c}")) if c in details.columns
             else F.col(f"e.{c}")).alias(c) for c in cols]
    return j.select(*[F.col(f"d.{c}") if c != "app_id" else F.col("app_id") for c in kept], *over)
