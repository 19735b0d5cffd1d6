"""Stored tables: plain Parquet folders that Spark reads and writes.

Upserts (B4-B8, J6) come to a table as a batch and a function from
``operators.merge`` that gives the new state of rows. Parquet has no MERGE,
so the folders that a batch touches are written anew, and the layout keeps
these few: ``key_range=<range of the key>/part_day=<day of the row>``. Ids of
records grow with time, so a batch's keys fall into few ranges, and a range's
rows into few days. A row stays in the day under which it was first stored:
keys of the touched ranges (key and folder columns only) tell where.

A batch is applied in two steps. The new state of the touched folders is
written to a journal folder named by the batch, then copied over the table's
folders by dynamic partition overwrite. A job that stops in the first step has
changed nothing; one that stops in the second, even between two folders, is
finished by the next run of the same batch, which finds the journal whole and
only copies. So a replayed batch gives the same table.

Columns can be added with a default (B13): the schema is kept as Spark's own
JSON, and the default as its metadata, which Spark's Parquet reader applies to
files that lack the column. Rows of older files show the default, a NULL
stored later stays NULL.

One writer at a time (a stream with its checkpoint is one). Readers see each
folder in its old or its new state.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE, DAY = "key_range", "part_day"
#: Ids in a range, and ranges of keys that hold no number.
WIDTH, HASHED = 1_000_000, 64
#: The day of rows that have none.
NO_DAY = date(1970, 1, 1)
Change = Callable[[DataFrame, DataFrame], DataFrame]


def key_range(key: str, width: int = WIDTH, hashed: int = HASHED) -> Column:
    """The range of a key by the number at its end, else by its hash; rows
    without a key have a range of their own."""
    text = F.col(key).cast("string")
    number = F.regexp_extract(text, r"([0-9]{1,18})$", 1)
    return (F.when(text.isNull(), "none").when(number == "", F.concat(F.lit("h"), F.pmod(F.xxhash64(text), F.lit(hashed)).cast("string")))
            .otherwise(F.concat(F.lit("n"), F.floor(number.cast("long") / width).cast("string"))))


def sql_literal(value) -> str:
    """A default as SQL text, as Spark keeps column defaults."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


class StoredTable:
    """A table of rows with a ``key``; ``day`` is the column whose date the
    rows are laid out by (none: one folder per key range)."""

    def __init__(self, spark: SparkSession, path: str, key: str, day: str | None = None, width: int = WIDTH, hashed: int = HASHED):
        self.spark, self.path, self.key, self.day, self.width, self.hashed = spark, path.rstrip("/"), key, day, width, hashed

    # -- schema ----------------------------------------------------------------

    def schema(self) -> T.StructType | None:
        """The newest schema, None for a table that does not exist."""
        folder = f"{self.path}/_schema"
        if not exists(self.spark, folder):
            return None
        newest = self.spark.read.schema("version long, fields string").json(folder).orderBy(F.desc("version")).first()
        return T.StructType.fromJson(json.loads(newest.fields)) if newest else None

    def _keep_schema(self, schema: T.StructType) -> None:
        row = [(len(schema), schema.json())]  # columns are only ever added
        self.spark.createDataFrame(row, "version long, fields string").coalesce(1).write.mode("append").json(f"{self.path}/_schema")

    def add_columns(self, defaults: dict[str, object]) -> None:
        """Columns that the table lacks, with the value that rows stored
        so far have; columns it has stay as they are."""
        schema = self.schema()
        if schema is None:
            raise ValueError(f"{self.path} holds no table")
        kinds = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType()}
        new = [T.StructField(c, kinds[type(v)], True, {"EXISTS_DEFAULT": sql_literal(v), "CURRENT_DEFAULT": sql_literal(v)})
               for c, v in defaults.items() if c not in schema.names]
        if new:
            self._keep_schema(T.StructType([*schema.fields, *new]))

    def defaults(self) -> dict[str, str]:
        return {f.name: f.metadata["CURRENT_DEFAULT"] for f in self.schema().fields if "CURRENT_DEFAULT" in f.metadata}

    # -- rows --------------------------------------------------------------------

    def _files(self, schema: T.StructType, folder: str | None = None) -> DataFrame:
        laid = T.StructType([*schema.fields, T.StructField(RANGE, T.StringType()), T.StructField(DAY, T.DateType())])
        return self.spark.read.schema(laid).option("basePath", folder or self.path).parquet(folder or self.path)

    def read(self, from_day: date | None = None) -> DataFrame | None:
        """The rows, of folders from a day on if one is given."""
        schema = self.schema()
        if schema is None:
            return None
        files = self._files(schema)
        return (files if from_day is None else files.filter(F.col(DAY) >= F.lit(from_day))).select(*schema.names)

    def _write(self, df: DataFrame, folder: str, dynamic: bool) -> None:
        # a large folder is dealt to several tasks, small ones share one
        laid = df.hint("rebalance", RANGE, DAY)
        w = laid.write.mode("overwrite").partitionBy(RANGE, DAY)
        (w.option("partitionOverwriteMode", "dynamic") if dynamic else w).parquet(folder)

    def upsert(self, batch: DataFrame, change: Change, batch_id: int | str | None = None, schema: T.StructType | None = None) -> None:
        """``change(current, batch)`` gives the new state of the rows in the
        folders that the batch touches. A batch id names the batch for good:
        applied again it changes nothing more. ``schema`` is that of a new
        table."""
        if self.schema() is None:
            self._keep_schema(schema or batch.schema)
        known = self.schema()
        name = uuid.uuid4().hex if batch_id is None else batch_id
        journal = f"{self.path}/_journal/batch={name}"
        if not exists(self.spark, f"{journal}/_SUCCESS"):
            self._write(self._state(batch, change, known), journal, False)
        self._write(self._files(known, journal), self.path, True)
        self._clear(f"batch={name}", keep=batch_id is not None)

    def _state(self, batch: DataFrame, change: Change, schema: T.StructType) -> DataFrame:
        missing = {c: F.expr(v) for c, v in self.defaults().items() if c not in batch.columns}
        batch = batch.withColumns(missing).withColumn(RANGE, key_range(self.key, self.width, self.hashed))
        own = F.coalesce(F.to_date(self.day), F.lit(NO_DAY)) if self.day else F.lit(NO_DAY)
        ranges = [r[0] for r in batch.select(RANGE).distinct().collect()]  # of one batch
        files = self._files(schema).filter(F.col(RANGE).isin(ranges))
        keys = batch.select(F.col(self.key).alias("_key")).filter("_key is not null").distinct()
        stored = files.select(F.col(self.key).alias("_key"), F.col(DAY).alias("_day")).join(keys, "_key", "left_semi").groupBy("_key").agg(F.min("_day").alias("_day"))
        placed = batch.join(stored, batch[self.key] == stored["_key"], "left").withColumn(DAY, F.coalesce("_day", own)).drop("_key", "_day")
        touched = placed.select(RANGE, DAY).distinct().collect()  # of one batch
        pairs = self.spark.createDataFrame(touched, f"{RANGE} string, {DAY} date")
        current = files.filter(F.col(DAY).isin(sorted({r[1] for r in touched}))).join(pairs, [RANGE, DAY], "left_semi").select(*schema.names, DAY)
        state = change(current, placed.drop(RANGE))
        return state.withColumn(RANGE, key_range(self.key, self.width, self.hashed))

    def _clear(self, name: str, keep: bool) -> None:
        """Journals of other batches are done with; that of a named batch
        stays for its replay."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_journal")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for x in fs.listStatus(path):
            if not keep or x.getPath().getName() != name:
                fs.delete(x.getPath(), True)


# -- appends ---------------------------------------------------------------------

def append_run(df: DataFrame, path: str, run: str | int, by: tuple[str, ...] = ()) -> None:
    """Rows of one run of a job (or one micro-batch) in the run's own folder:
    a run that is repeated replaces what it wrote before, all of it."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(f"{path.rstrip('/')}/run={run}")


def earlier_runs(spark: SparkSession, path: str, run: int, schema: T.StructType) -> DataFrame:
    """What runs with a smaller number have appended."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    names = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
    return spark.read.schema(names).parquet(path).filter(F.col("run") < run).drop("run")


# -- retention -------------------------------------------------------------------

def drop_days(spark: SparkSession, path: str, cutoff: date, by: str = "date") -> list[str]:
    """G3-G5 on a table laid out by day: the folders of days before the cutoff
    are removed, at whatever level they are; nothing is read or rewritten.
    Returns their names. Rows of the cutoff's own day stay until the next."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone, levels = [], [top]
    while levels:
        for x in fs.listStatus(levels.pop()):
            name = x.getPath().getName()
            if not x.isDirectory() or name[0] in "._":
                continue
            column, _, value = name.partition("=")
            if column != by:
                levels.append(x.getPath())
            elif re.fullmatch(r"\d{4}-\d{2}-\d{2}", value) and date.fromisoformat(value) < cutoff:
                fs.delete(x.getPath(), True)
                gone.append(name)
    return sorted(set(gone))
