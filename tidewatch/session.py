"""SparkSession construction.

Plain Spark configuration: AQE on (coalescing, skew-join splitting, broadcast
joins decided on measured shuffle sizes), UTC session time zone (the tables
hold naive UTC timestamps), Arrow for pandas exchange, and the UI off. The
number of shuffle partitions stays the cluster's own unless given: AQE
coalesces but never raises it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE turns a join into a broadcast join after the build side has been
# written and measured below this size; the static, estimated threshold stays
# at Spark's default.
BROADCAST_CEILING = "64MB"


def build_session(master: str | None = None, app: str = "tidewatch",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_CEILING,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
