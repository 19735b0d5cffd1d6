"""Shared helpers: reading inputs, tables written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the operators' contracts: space and \\t \\n \\v \\f \\r.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session without
    the setting (tests) gets one of its own; a cluster without it is an
    error, as a machine-local folder is lost with its machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        folder = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_SCOPE: ContextVar[list | None] = ContextVar("scope", default=None)


def _scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which goes when the session ends, or
    with its :class:`Scratch`."""
    path = f"{shared_folder(spark)}/{name}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(hadoop)
    if (scope := _SCOPE.get()) is not None:
        scope.append((fs, hadoop))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here,
    so a lost executor costs no recomputation of what came before and rows
    keep the values they were written with."""
    spark = df.sparkSession
    path = _scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, by: str, order: str, buckets: int) -> DataFrame:
    """:func:`staged` as a bucketed table: each task deals its own rows to the
    buckets of ``by``, sorted by ``order``, so nothing is exchanged for it,
    and a join on ``by`` leaves the table where it is. The catalog knows it
    only while it is written: what is returned reads the files."""
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    unique = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(min(buckets, most), by).sortBy(order).option("path", _scratch_path(spark, unique)).saveAsTable(unique)
    out = spark.table(unique)
    spark.sql(f"drop table {unique}")  # an external table: its files stay
    return out


class Scratch:
    """The tables staged within ``with scratch:``; ``clear`` removes them,
    once all that reads them has been written elsewhere."""

    def __init__(self):
        self.tables: list = []

    def __enter__(self) -> Scratch:
        self._token = _SCOPE.set(self.tables)
        return self

    def __exit__(self, *_) -> None:
        _SCOPE.reset(self._token)

    def clear(self) -> None:
        for fs, path in self.tables:
            fs.delete(path, True)
        self.tables.clear()


@contextmanager
def exchanges_end(spark: SparkSession):
    """Within it the files of an execution's exchanges go when it ends, not
    when the driver next happens to collect its garbage. For work that stages
    each result, as an execution run again would have to make them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: as the variable
    of a one-element transform it cannot be copied into inner lambdas, where
    it would be computed again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def with_row_id(docs: DataFrame, name: str = "__row") -> DataFrame:
    """A long that tells rows apart, also repeated ones. ``docs`` must be a
    plain scan (files or a local relation), so that every reading of it deals
    out the same rows in the same order."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def slices(batches, column: str, most_bytes: int = 4 << 20):
    """The Arrow batches in slices of about so many bytes of a text or binary
    column, and one row at least, so that Python objects stay few."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(b):
            start = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, start + most_bytes, side="right")))
            yield b.slice(at, end - at)
            at = end
