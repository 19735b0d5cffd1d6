"""Data-quality checks and reports.

Each check is a small DataFrame: a one-row status frame or a frame of issue
rows ``(source, severity, message)``. Status logic is column expressions over
the aggregates in ``sentiment`` / ``players``; reports are unions plus one
global aggregate. Issue lists are never gathered into a single row unless
they are bounded by construction (top-k lists, a fixed set of rules).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import attach
from ..functions.timefns import minus
from . import players as P
from . import sentiment as S
from . import windows as W

# Freshness limits in minutes per table, and the words that
# make an issue critical.
FRESHNESS_LIMITS = {"steam_player_tracking": 15, "steam_review_tracking": 60, "game_tracking_config": 1440}
CRITICAL_WORDS = ("failed", "error", "missing", "stuck")
# Issue and recommendation texts, as dashboards and alerts expect them.
DATA_IS_MINUTES_OLD = "%s: Data is %s minutes old (max: %d)"
NO_RECORDS_FOUND = "%s: No records found"
CHANGE_DETECTED_AT = "%s: %s%% change detected at %s"
HIGH_API_RESPONSE_TIMES = "High API response times: %sms average"
API_PERFORMANCE_DEGRADED_REQUESTS = "API performance degraded: %s%% requests >10s"
NO_RECENT_SENTIMENT_PROCESSING = "No recent sentiment processing activity"
LARGE_PROCESSING_BACKLOG_REVIEWS = "Large processing backlog: %d reviews pending"
SLOW_SENTIMENT_PROCESSING_MS = "Slow sentiment processing: %sms average"
REVIEWS_STUCK_IN_PROCESSING = "%d reviews stuck in processing queue"
NO_RECENT_SCORING_DETECTED = "No recent sentiment processing detected"
SLOW_PROCESSING_MS_AVERAGE = "Slow processing: %sms average"
POSITIVE_REVIEWS_HAVE_NEGATIVE = "Positive reviews have negative avg score: %.3f"
NEGATIVE_REVIEWS_HAVE_POSITIVE = "Negative reviews have positive avg score: %.3f"
EXTREME_SENTIMENT_SKEW = "Extreme sentiment skew: %s%% %s"
HIGH_LOW_CONFIDENCE_PREDICTIONS = "High low-confidence predictions: %s%%"
PROCESSING_TIMEOUTS_DETECTED_REVIEWS = "Processing timeouts detected: %d reviews"
SENTIMENT_CONSUMER_APPEARS_TO = "Sentiment consumer appears to be down - check service logs"
MULTIPLE_QUALITY_ISSUES_DETECTED = "Multiple quality issues detected - review model performance"
LOW_PROCESSING_RATE_CONSIDER = "Low processing rate - consider scaling up resources"
CONSIDER_OPTIMIZING_LLM_BACKEND = "Consider optimizing LLM backend for faster processing"
HIGH_REVIEW_VOLUME_MONITOR = "High review volume - monitor resource usage"
NO_PLAYER_TRACKING_DATA = "No player tracking data found"
NO_REVIEW_DATA_FOUND = "No review data found"
NO_RECENT_DATA_COLLECTION = "No recent data collection - check data ingestion services"
LOW_DATA_COLLECTION_RATE = "Low data collection rate - monitor API performance"
CONSIDER_ADDING_MORE_GAMES = "Consider adding more games to tracking configuration"


def fmt(pattern: str, *cols) -> Column:
    return F.format_string(pattern, *cols)


def half_even(x, digits: int = 0) -> Column:
    """Python's ``f'{x:.Nf}'`` rounds half-even; round first, then format."""
    return F.bround(x, digits)


def severity(message: Column) -> Column:
    crit = "|".join(CRITICAL_WORDS)
    return F.when(F.lower(message).rlike(crit), "critical").otherwise("warning")


def issues_frame(df: DataFrame, source: str, message: Column) -> DataFrame:
    m = df.select(F.lit(source).alias("source"), message.alias("message")).filter(F.col("message").isNotNull())
    return m.withColumn("severity", severity(F.col("message")))


def freshness_status(tables: dict[str, tuple[DataFrame, str]], as_of=None,
                     limits: dict[str, int] | None = None) -> DataFrame:
    """L1: E11 plus status (stale > limit, healthy with rows, else empty) and
    the issue text. 0 minutes reads as "no value" as in the reference."""
    limits = limits or FRESHNESS_LIMITS
    f = P.freshness(tables, as_of)
    lim = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])[F.col("table_name")]
    m = F.nullif(F.col("minutes_since_update"), F.lit(0.0))
    stale = m.isNotNull() & (m > lim)
    status = F.when(stale, "stale").when(F.col("total_records") > 0, "healthy").otherwise("empty")
    issue = (F.when(stale, fmt(DATA_IS_MINUTES_OLD, F.col("table_name"),
                               fmt("%.1f", half_even(m, 1)), lim))
             .when(F.col("total_records") == 0, fmt(NO_RECORDS_FOUND, F.col("table_name"))))
    return f.select("table_name", "total_records", "last_update",
                    half_even(m, 1).alias("minutes_since_update"), status.alias("status"),
                    issue.alias("issue"))


def completeness_issues(config: DataFrame, players: DataFrame, as_of=None) -> DataFrame:
    """L2: issue rows of the completeness rules (missing / low readings,
    anomalies, API latency)."""
    d3 = issues_frame(P.games_missing_data(config, players, as_of), "completeness", F.col("issue"))
    an = W.player_anomalies(players, as_of, k=None)
    a = issues_frame(an, "anomaly", fmt(CHANGE_DETECTED_AT, F.col("game_name"),
                                        F.col("change_pct"), F.date_format("timestamp", "HH:mm")))
    has = F.col("total_requests") > 0
    slow = F.when(has & (F.col("avg_response_time") > 3000), fmt(HIGH_API_RESPONSE_TIMES, fmt("%.0f", half_even(F.col("avg_response_time")))))
    degraded = F.when(has & (F.col("slow_pct") > 10), fmt(API_PERFORMANCE_DEGRADED_REQUESTS, fmt("%.1f", half_even(F.col("slow_pct"), 1))))
    # both rules read one aggregate
    api = issues_frame(P.api_health(players, as_of).select(F.explode(F.array(slow, degraded)).alias("m")), "api", F.col("m"))
    return d3.unionByName(a).unionByName(api)


def sentiment_health(reviews: DataFrame, as_of=None, backlog: int = 50, slow_ms: float = 5000) -> DataFrame:
    """L3: scoring health over E13 and E14 (one row, fixed rule set)."""
    # One pass: each check is a conditional aggregate over the same rows.
    ms, label = F.col("processing_time_ms"), F.col("sentiment_label")
    recent = F.coalesce((F.col("review_timestamp") > minus(as_of, hours=24)) | (F.col("processed_timestamp") > minus(as_of, hours=2)), F.lit(False))
    waiting = S.has_text(reviews) & label.isNull()
    j = reviews.agg(F.count_if(recent & label.isNotNull()).alias("recent_processed"),
                    F.count_if(recent & waiting).alias("pending_reviews"),
                    F.avg(F.when(recent & (ms > 0), ms)).alias("avg_raw"),
                    F.count_if(waiting & (F.col("review_timestamp") < minus(as_of, days=1))).alias("stuck_reviews"))
    issues = F.array_compact(F.array(
        F.when(F.col("recent_processed") == 0, F.lit(NO_RECENT_SENTIMENT_PROCESSING)),
        F.when(F.col("pending_reviews") > backlog,
               fmt(LARGE_PROCESSING_BACKLOG_REVIEWS, F.col("pending_reviews"))),
        F.when(F.col("avg_raw") > slow_ms,
               fmt(SLOW_SENTIMENT_PROCESSING_MS, fmt("%.0f", half_even(F.col("avg_raw"))))),
        F.when(F.col("stuck_reviews") > 0, fmt(REVIEWS_STUCK_IN_PROCESSING, F.col("stuck_reviews")))))
    return j.select((F.col("recent_processed") > 0).alias("processing_healthy"), "recent_processed",
                    "pending_reviews", F.round(F.coalesce("avg_raw", F.lit(0.0)), 2).alias("avg_processing_time"),
                    "stuck_reviews", issues.alias("issues"))


def quality_report(freshness: DataFrame, completeness: DataFrame, health: DataFrame) -> DataFrame:
    """L4: overall status over all issues: none -> HEALTHY; a critical word
    or more than 5 -> CRITICAL; else WARNING. Issue rows stay a frame (see
    ``report_issues``); the report row only counts them."""
    # Every part is computed once: its rows, passing checks with a NULL
    # message included, go into one aggregate.
    source, message = F.col("source"), F.col("message")
    flags = F.struct(F.col("processing_healthy").alias("healthy"), F.col("pending_reviews").alias("pending"))
    none = F.lit(None).cast("struct<healthy:boolean,pending:bigint>")
    rows = (freshness.select(F.lit("freshness").alias("source"), F.col("issue").alias("message"), none.alias("flags"))
            .union(completeness.select("source", "message", none))
            .union(health.select(F.lit("sentiment"), F.explode(F.concat(F.array(F.lit(None).cast("string")), "issues")), flags)))
    issue = message.isNotNull()
    j = rows.agg(F.count("message").alias("total_issues"),
                 F.count_if(issue & (severity(message) == "critical")).alias("critical_issues"),
                 F.count_if((source == "freshness") & ~issue).alias("freshness_checks_passed"),
                 F.count_if((source == "freshness") & issue).alias("freshness_checks_failed"),
                 F.count_if(source.isin("completeness", "anomaly", "api")).alias("completeness_issues"),
                 F.max("flags").alias("flags"))
    j = j.select("*", F.col("flags.healthy").alias("sentiment_processing_healthy"),
                 F.col("flags.pending").alias("pending_sentiment_reviews"))
    status = (F.when(F.col("total_issues") == 0, "HEALTHY")
              .when((F.col("critical_issues") > 0) | (F.col("total_issues") > 5), "CRITICAL")
              .otherwise("WARNING"))
    return j.select(status.alias("overall_status"), "total_issues", "critical_issues",
                    "freshness_checks_passed", "freshness_checks_failed", "completeness_issues",
                    "sentiment_processing_healthy", "pending_sentiment_reviews")


def report_issues(freshness: DataFrame, completeness: DataFrame, health: DataFrame) -> DataFrame:
    fr = issues_frame(freshness, "freshness", F.col("issue"))
    he = issues_frame(health.select(F.explode("issues").alias("m")), "sentiment", F.col("m"))
    return fr.unionByName(completeness).unionByName(he)


def scorer_health(reviews: DataFrame, as_of=None, slow_ms: float = 10000) -> DataFrame:
    """E15 plus health flag and issues."""
    a = S.scorer_activity(reviews, as_of)
    issues = F.array_compact(F.array(
        F.when(F.col("recent_reviews") == 0, F.lit(NO_RECENT_SCORING_DETECTED)),
        F.when(F.col("avg_processing_time") > slow_ms,
               fmt(SLOW_PROCESSING_MS_AVERAGE, fmt("%.0f", half_even(F.col("avg_processing_time")))))))
    return a.select((F.col("recent_reviews") > 0).alias("consumer_healthy"), "recent_reviews",
                    "avg_processing_time", "processing_rate", issues.alias("issues"))


def score_quality_issues(reviews: DataFrame, as_of=None, skew_pct: float = 80,
                         low_conf_pct: float = 20) -> DataFrame:
    """Issue rows from the score distribution (E16), low-confidence share
    (E17) and time-outs (E18): one pass to a row per label, from which every
    rule reads."""
    lab, n = F.col("sentiment_label"), F.col("n")
    labels = (reviews.filter(F.col("processed_timestamp") > minus(as_of, hours=24)).groupBy("sentiment_label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("sentiment_score").alias("avg_score"),
        F.count_if(F.col("sentiment_confidence") < 0.3).alias("low"),
        F.count_if(F.col("processing_time_ms") > 30000).alias("slow")))
    row = F.struct("sentiment_label", "n", "avg_score", "low", "slow")
    one = labels.agg(F.sort_array(F.collect_list(row)).alias("g"))  # a row per label: bounded
    add = lambda field, only: F.aggregate(F.filter("g", only), F.lit(0).cast("long"), lambda a, x: a + x[field])
    named = lambda x: x["sentiment_label"].isNotNull()
    one = one.select("g", add("n", named).alias("total"), add("low", named).alias("low"), add("slow", lambda x: F.lit(True)).alias("slow"))
    share = lambda part: F.try_divide(part.cast("double"), F.col("total").cast("double")) * 100

    def per_label(x):
        score, pct = half_even(x["avg_score"], 3), half_even(share(x["n"]), 1)
        is_ = lambda v: x["sentiment_label"] == v
        return F.array(
            F.when(is_("positive") & (x["avg_score"] < 0), fmt(POSITIVE_REVIEWS_HAVE_NEGATIVE, score)),
            F.when(is_("negative") & (x["avg_score"] > 0), fmt(NEGATIVE_REVIEWS_HAVE_POSITIVE, score)),
            F.when(share(x["n"]) > skew_pct, fmt(EXTREME_SENTIMENT_SKEW, fmt("%.1f", pct), x["sentiment_label"])))
    low_pct = F.coalesce(share(F.col("low")), F.lit(0.0))
    low = F.when((F.col("low") > 0) & (low_pct > low_conf_pct), fmt(HIGH_LOW_CONFIDENCE_PREDICTIONS, fmt("%.1f", half_even(low_pct, 1))))
    slow = F.when(F.col("slow") > 0, fmt(PROCESSING_TIMEOUTS_DETECTED_REVIEWS, F.col("slow")))
    tag = lambda source, m: F.struct(F.lit(source).alias("source"), m.alias("message"))
    found = F.concat(F.transform(F.flatten(F.transform(F.filter("g", named), per_label)), lambda m: tag("distribution", m)),
                     F.array(tag("confidence", low), tag("timeouts", slow)))
    rows = one.select(F.inline(F.filter(found, lambda x: x["message"].isNotNull())))
    return rows.withColumn("severity", severity(F.col("message")))


def insights_document(reviews: DataFrame, as_of=None, trend_hours: int | None = 24) -> DataFrame:
    """One row with the bounded top lists (5, 5), the newest
    ``trend_hours`` hours (None: all that the window touches), volume and
    class, plus its JSON form."""
    def lst(df, name, *order):
        """The rows in their order: gathered with their rank and sorted by it
        (a list keeps no order of its own)."""
        ranked = df.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))  # 25 rows at most
        rows = F.sort_array(F.collect_list(F.struct("_rank", F.struct(*df.columns).alias("row"))))
        return ranked.agg(F.transform(rows, lambda x: x["row"]).alias(name))
    tie = (F.desc("review_count"), "app_id", "game_name")
    doc = attach(attach(attach(
        lst(S.top_positive_games(reviews, as_of), "top_positive_games", F.desc("avg_sentiment"), *tie),
        lst(S.top_negative_games(reviews, as_of), "top_negative_games", F.asc("avg_sentiment"), *tie)),
        lst(S.sentiment_trend_24h(reviews, as_of, k=trend_hours), "sentiment_trends", F.desc("hour"))),
        S.overall_sentiment(reviews, as_of).select("review_volume", "overall_sentiment"))
    return doc.withColumn("insights_json", F.to_json(F.struct(*doc.columns)))


def scoring_pipeline_report(reviews: DataFrame, as_of=None, max_issues: int = 5, min_rate: float = 1.0,
                            slow_ms: float = 5000, high_volume: int = 1000) -> DataFrame:
    """Pipeline status and recommendations from L5, L6 and E22."""
    h = scorer_health(reviews, as_of)
    q = score_quality_issues(reviews, as_of).agg(F.count(F.lit(1)).alias("total_issues"))
    o = S.overall_sentiment(reviews, as_of).select("review_volume", "overall_sentiment")
    j = attach(attach(h, q), o)
    healthy, n, rate = F.col("consumer_healthy"), F.col("total_issues"), F.col("processing_rate")
    status = (F.when(~healthy, "CRITICAL").when(n > max_issues, "WARNING")
              .when(rate < min_rate, "WARNING").otherwise("HEALTHY"))
    first = (F.when(~healthy, F.lit(SENTIMENT_CONSUMER_APPEARS_TO))
             .when(n > max_issues, F.lit(MULTIPLE_QUALITY_ISSUES_DETECTED))
             .when(rate < min_rate, F.lit(LOW_PROCESSING_RATE_CONSIDER)))
    recs = F.array_compact(F.array(
        first,
        F.when(F.col("avg_processing_time") > slow_ms, F.lit(CONSIDER_OPTIMIZING_LLM_BACKEND)),
        F.when(F.col("review_volume") > high_volume, F.lit(HIGH_REVIEW_VOLUME_MONITOR))))
    return j.select(status.alias("pipeline_status"), "total_issues",
                    F.col("recent_reviews").alias("reviews_processed"),
                    F.round(rate, 2).alias("processing_rate"), "overall_sentiment", "review_volume",
                    recs.alias("recommendations"))


def source_health(players: DataFrame, reviews: DataFrame, config: DataFrame) -> DataFrame:
    """Per-source state, issues and HEALTHY / WARNING / CRITICAL."""
    p = P.player_source_stats(players)
    r = P.review_source_stats(reviews)
    c = P.config_stats(config)
    j = attach(attach(p, r), c)
    issues = F.array_compact(F.array(
        F.when(F.col("total_records") == 0, F.lit(NO_PLAYER_TRACKING_DATA)),
        F.when(F.col("total_reviews") == 0, F.lit(NO_REVIEW_DATA_FOUND))))
    n = F.size(issues)
    status = F.when(n == 0, "HEALTHY").when(n <= 2, "WARNING").otherwise("CRITICAL")
    return j.select(
        status.alias("pipeline_status"),
        F.when(F.col("total_records") > 0, "active").otherwise("empty").alias("player_status"),
        F.when(F.col("total_reviews") > 0, "active").otherwise("empty").alias("review_status"),
        F.when(F.col("configured_games") > 0, "configured").otherwise("empty").alias("config_status"),
        "total_records", "games_tracked", "total_reviews", "processed_reviews", "games_with_reviews",
        "processing_rate", "configured_games", "active_games", issues.alias("issues"))


def monitoring_summary(players: DataFrame, as_of=None, low_rows: int = 50, min_games: int = 3) -> DataFrame:
    """D4 rounded plus recommendations."""
    d = P.pipeline_summary_stats(players, as_of)
    rec = F.col("recent_player_records")
    recs = F.array_compact(F.array(
        F.when(rec == 0, F.lit(NO_RECENT_DATA_COLLECTION))
        .when(rec < low_rows, F.lit(LOW_DATA_COLLECTION_RATE)),
        F.when(F.col("active_games") < min_games, F.lit(CONSIDER_ADDING_MORE_GAMES))))
    return d.select(rec.alias("recent_activity_24h"), "active_games",
                    F.coalesce(F.bround("avg_player_count", 0), F.lit(0.0)).alias("avg_player_count"),
                    F.coalesce("peak_player_count", F.lit(0)).alias("peak_player_count"),
                    recs.alias("recommendations"))


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` stored more than once (NULLs group together)."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1).select(F.lit(col).alias("column_name"), F.col("value").cast("string"), "n"))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Number of rows failing NOT NULL on ``col`` (one row)."""
    return df.agg(F.count_if(F.col(col).isNull()).alias("n")).select(
        F.lit(col).alias("column_name"), F.lit(None).cast("string").alias("value"), "n")
