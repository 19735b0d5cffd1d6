"""Registered queries: payload parsers.

Landed payloads are produced from the input tables by Spark (``to_json``),
so each parse is a round trip whose expected result the oracle computes
straight from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import payloads as A
from .registry import query


def _player_raw(x):
    p = x.players
    body = F.when(F.col("player_count") == 0, F.lit('{"response":{}}')).otherwise(
        F.to_json(F.struct(F.struct(F.col("player_count").cast("long").alias("player_count")).alias("response"))))
    return p.select("app_id", body.alias("body"), F.col("timestamp").alias("fetched_at"),
                    (F.col("api_response_time_ms") / 7).alias("latency_ms"))


@query("parse_player_payload", """
select app_id, player_count, timestamp, round_even(api_response_time_ms / 7, 2) as api_response_time_ms,
  'dynamic_tracker' as source,
  concat(cast(app_id as varchar), '_', cast(cast(floor(epoch(timestamp)) as bigint) as varchar)) as message_id
from player_tracking where player_count <> 0
""", floats=("api_response_time_ms",))
def _a5(x):
    return A.parse_player_payload(_player_raw(x))


def _price_raw(x):
    li = x.table("lineitem")
    ln = F.col("l_linenumber")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    po = F.struct(cents.alias("final"), cents.alias("initial"),
                  F.round(F.col("l_discount") * 100).cast("int").alias("discount_percent"),
                  F.lit("USD").alias("currency"))
    po_type = "struct<final: bigint, initial: bigint, discount_percent: int, currency: string>"
    po_or_none = F.when(ln == 7, F.lit(None).cast(po_type)).otherwise(po)
    entry = F.struct((ln != 6).alias("success"), F.struct(po_or_none.alias("price_overview")).alias("data"))
    body = F.to_json(F.create_map(F.col("l_partkey").cast("string"), entry))
    return li.select(F.col("l_partkey").alias("app_id"), body.alias("body"), F.col("l_shipdate").alias("fetched_at"))


@query("parse_price_payload", """
select cast(l_partkey as int) as app_id,
  cast(case when l_linenumber = 7 then 0 else cast(l_extendedprice as decimal(10,2)) end as decimal(10,2)) as price_current,
  cast(case when l_linenumber = 7 then 0 else cast(l_extendedprice as decimal(10,2)) end as decimal(10,2)) as price_original,
  case when l_linenumber = 7 then 0 else cast(round(l_discount * 100) as int) end as discount_percent,
  'USD' as currency, l_shipdate as timestamp
from lineitem where l_linenumber <> 6
""")
def _a6(x):
    return A.parse_price_payload(_price_raw(x))


def _review_raw(x):
    r = x.reviews_text
    item = F.struct(F.col("review_id").alias("recommendationid"), F.col("review_text").alias("review"),
                    F.nullif(F.col("review_helpful"), F.lit(0)).alias("votes_helpful"),
                    F.when(F.col("sentiment_label").isNull(), F.lit(0).cast("long"))
                    .otherwise(F.unix_seconds(F.col("review_timestamp").cast("timestamp"))).alias("timestamp_created"))
    # One landed page per (game, review id): at most two reviews each.
    pages = r.groupBy("app_id", "review_id").agg(F.array_sort(F.collect_list(item)).alias("reviews"))
    return pages.select("app_id", F.to_json(F.struct(F.lit(1).alias("success"), "reviews")).alias("body"))


@query("explode_review_payload", """
select app_id, review_id, review_text, review_helpful,
  case when sentiment_label is null then null else date_trunc('second', review_timestamp) end as review_timestamp
from review_tracking
""")
def _a7(x):
    return A.explode_review_payload(_review_raw(x))


PAGE = 100


def _app_list_raw(x):
    p = x.table("part")
    name = (F.when(F.col("p_size") % 11 == 0, F.lit("x")).when(F.col("p_size") % 13 == 0, F.lit(None))
            .otherwise(F.col("p_name")))
    item = F.struct(F.col("p_partkey").cast("int").alias("appid"), name.alias("name"))
    pages = (p.groupBy(F.floor(F.col("p_partkey") / PAGE).alias("page"))
             .agg(F.array_sort(F.collect_list(item)).alias("apps")))
    return pages.select(F.to_json(F.struct(F.struct("apps").alias("applist"))).alias("body"))


@query("explode_app_list", """
select appid, name from (
  select cast(p_partkey as int) as appid,
    case when p_size % 11 = 0 then 'x' when p_size % 13 = 0 then null else p_name end as name
  from part) a
where name is not null and length(name) >= 2
""")
def _a8(x):
    return A.explode_app_list(_app_list_raw(x))


def _details_raw(x):
    p = x.table("part")
    size = F.col("p_size")
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    data = F.struct(
        F.col("p_name").alias("name"), F.lit("game").alias("type"), (size % 4 == 0).alias("is_free"),
        F.col("p_type").alias("short_description"),
        F.struct(F.date_format(F.date_add(F.lit("2012-01-01").cast("date"), size * 30), "d MMM, yyyy")
                 .alias("date")).alias("release_date"),
        F.array(F.col("p_brand"), F.lit("Studio")).alias("developers"),
        F.array(F.col("p_brand")).alias("publishers"),
        F.array(F.struct(F.col("p_type").alias("description"))).alias("genres"),
        F.struct(F.col("p_name").alias("minimum")).alias("pc_requirements"),
        F.when(size % 3 == 0, F.array()).otherwise(
            F.array(F.struct(F.concat(F.lit("img/"), F.col("p_partkey").cast("string")).alias("path_full"))))
        .alias("screenshots"),
        F.struct(F.when(size % 2 == 0, cents).otherwise(F.lit(0)).alias("final"), cents.alias("initial"),
                 F.lit(0).alias("discount_percent"), F.lit("USD").alias("currency")).alias("price_overview"))
    body = F.to_json(F.create_map(F.col("p_partkey").cast("string"),
                                  F.struct((size % 17 != 0).alias("success"), data.alias("data"))))
    return p.select(F.col("p_partkey").alias("app_id"), body.alias("body"))


#: What the parser must make of the landed details, straight from the table.
DETAILS_CTES = """
details AS (
  select cast(p_partkey as int) as app_id, p_name as name, 'game' as type, p_size % 4 = 0 as is_free,
    p_type as short_description, '' as detailed_description, '' as about_the_game,
    case when p_size % 2 = 0 then cast(p_retailprice as decimal(10,2)) end as price_current,
    cast(p_retailprice as decimal(10,2)) as price_original, 0 as discount_percent, 'USD' as currency,
    cast(date '2012-01-01' + cast(p_size * 30 as int) as date) as release_date,
    strftime(date '2012-01-01' + cast(p_size * 30 as int), '%-d %b, %Y') as release_date_text,
    concat(p_brand, ', Studio') as developer, p_brand as publisher, '{}' as platforms, '[]' as categories,
    concat('["', p_type, '"]') as genres, '""' as languages, '' as header_image,
    case when p_size % 3 = 0 then '[]' else concat('["img/', cast(p_partkey as varchar), '"]') end as screenshots,
    '[]' as movies, concat('{"minimum":"', p_name, '"}') as pc_requirements, '{}' as mac_requirements,
    '{}' as linux_requirements, cast(null as int) as metacritic_score, cast(null as varchar) as metacritic_url
  from part where p_size % 17 <> 0),
estimates AS (
  select cast(p_partkey as int) as app_id, printf('%d .. %d', p_size * 1000, p_size * 2000) as owners_estimate,
    cast(p_size * 10 as bigint) as owners_variance, cast(p_size * 50 as bigint) as players_forever,
    cast(p_size * 5 as bigint) as players_2weeks, cast(p_size as bigint) as average_forever,
    cast(0 as bigint) as average_2weeks, cast(p_size as bigint) as median_forever, cast(0 as bigint) as median_2weeks
  from part where p_size % 9 <> 0)
"""


@query("flatten_app_details", "select * from details", ctes=DETAILS_CTES)
def _a9(x):
    return A.flatten_app_details(_details_raw(x))


def _owners_raw(x):
    p = x.table("part")
    body = F.when(F.col("p_size") % 9 == 0, F.lit('{"error": "not found"}')).otherwise(F.to_json(F.struct(
        F.format_string("%d .. %d", F.col("p_size") * 1000, F.col("p_size") * 2000).alias("owners"),
        (F.col("p_size") * 10).alias("owners_variance"), (F.col("p_size") * 50).alias("players_forever"),
        (F.col("p_size") * 5).alias("players_2weeks"), F.col("p_size").alias("average_forever"),
        F.lit(0).alias("average_2weeks"), F.col("p_size").alias("median_forever"),
        F.lit(0).alias("median_2weeks"))))
    return p.select(F.col("p_partkey").alias("app_id"), body.alias("body"))


@query("flatten_owner_estimates", """
select cast(p_partkey as int) as app_id, printf('%d .. %d', p_size * 1000, p_size * 2000) as owners_estimate,
  cast(p_size * 10 as bigint) as owners_variance, cast(p_size * 50 as bigint) as players_forever,
  cast(p_size * 5 as bigint) as players_2weeks, cast(p_size as bigint) as average_forever,
  cast(0 as bigint) as average_2weeks, cast(p_size as bigint) as median_forever, cast(0 as bigint) as median_2weeks
from part where p_size % 9 <> 0
""")
def _a10(x):
    return A.flatten_owner_estimates(_owners_raw(x))


@query("merge_estimates", "select d.*, e.* exclude (app_id) from details d left join estimates e on d.app_id = e.app_id",
       ctes=DETAILS_CTES)
def _d6(x):
    return A.merge_estimates(A.flatten_app_details(_details_raw(x)), A.flatten_owner_estimates(_owners_raw(x)))
