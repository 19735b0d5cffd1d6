"""A1 ``load_table``: scan a base table by name with its fixed schema.

Tables live as Parquet folders (partitioned by date where written by our
sinks). Reading with an explicit schema avoids inference and keeps the scan
prunable; Catalyst pushes filters and the projected column list into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import TABLES


def load_table(spark: SparkSession, root: str, name: str, register: bool = True) -> DataFrame:
    schema = TABLES.get(name)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(f"{root.rstrip('/')}/{name}")
    if register:
        df.createOrReplaceTempView(name)
    return df


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver-provided input tables (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
