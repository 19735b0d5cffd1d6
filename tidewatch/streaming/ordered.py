"""Comparisons with the previous row of a key, in event-time order, over a
stream (J4, J5).

Messages arrive out of order, so a row is compared only once the watermark
(the newest time seen less ``delay``) has passed it: until then it waits. What
is ready in a micro-batch meets one carried row per key, the newest that was
compared before, and ``LAG`` runs over both with the batch operators' own
``lag_by_key``, which cuts a hot key's rows into time buckets. A key's rows
never gather in a frame or a state object, and any arrival order within the
delay gives the batch result.

The state after a micro-batch is three small tables in a folder of the batch:
``carried`` (a row per key), ``waiting`` (what arrived within the delay) and
``mark``. A batch reads its predecessor's folder and writes its own in
overwrite mode, so a replay gives the same result. Rows older than what has
been compared already cannot be placed any more; they go to ``late``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import lag_by_key, latest_per_key
from ..sinks.stored import exists

Finish = Callable[[DataFrame], DataFrame]


class Ordered:
    """``finish`` turns rows with ``prev_<value>`` columns into results, which
    go to ``out``; ``order`` begins with the event time."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: str, order: Sequence[str], values: Sequence[str],
                 finish: Finish, delay: timedelta):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.key, self.order, self.values, self.finish, self.delay = key, list(order), list(values), finish, delay

    def _state(self, batch_id: int) -> str:
        return f"{self.folder}/state/batch={batch_id}"

    def _read(self, batch_id: int, name: str) -> DataFrame:
        folder = f"{self._state(batch_id)}/{name}"
        return self.spark.read.schema(self.schema).parquet(folder) if batch_id >= 0 else self.spark.createDataFrame([], self.schema)

    def _mark(self, batch_id: int) -> datetime | None:
        """The newest time seen by the end of a batch."""
        return self.spark.read.parquet(f"{self._state(batch_id)}/mark").first()[0] if batch_id >= 0 else None

    def _compared(self, carried: DataFrame, ready: DataFrame) -> DataFrame:
        both = carried.withColumn("_carried", F.lit(True)).unionByName(ready.withColumn("_carried", F.lit(False)))
        return self.finish(lag_by_key(both, [self.key], self.order, self.values).filter(~F.col("_carried")).drop("_carried"))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        time = self.order[0]
        new = batch.select(*self.schema.names).persist()
        newest = new.agg(F.max(time)).first()[0]
        before = self._mark(batch_id - 1)
        seen = max((t for t in (newest, before) if t is not None), default=None)
        done, ready_to = (None if t is None else t - self.delay for t in (before, seen))
        passed = lambda t: F.lit(False) if t is None else F.col(time) <= F.lit(t)
        late = new.filter(passed(done))
        rows = self._read(batch_id - 1, "waiting").unionByName(new.filter(~passed(done)))
        ready, carried = rows.filter(passed(ready_to)), self._read(batch_id - 1, "carried")
        self._compared(carried, ready).write.mode("overwrite").parquet(f"{self.folder}/out/batch={batch_id}")
        late.write.mode("overwrite").parquet(f"{self.folder}/late/batch={batch_id}")
        state = self._state(batch_id)
        latest_per_key(carried.unionByName(ready), [self.key], self.order).select(*self.schema.names).write.mode("overwrite").parquet(f"{state}/carried")
        rows.filter(~passed(ready_to)).write.mode("overwrite").parquet(f"{state}/waiting")
        self.spark.createDataFrame([(seen,)], "seen timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(f"{state}/mark")
        new.unpersist()
        self._forget(batch_id - 2)

    def _forget(self, batch_id: int) -> None:
        """A replay needs the state of one batch before."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._state(batch_id))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def results(self) -> DataFrame | None:
        """What has been compared so far."""
        return self.spark.read.parquet(f"{self.folder}/out").drop("batch") if exists(self.spark, f"{self.folder}/out") else None

    def waiting(self, batch_id: int) -> DataFrame:
        """Results of the rows that still wait after a batch, as if no more
        came; the state stays as it is."""
        return self._compared(self._read(batch_id, "carried"), self._read(batch_id, "waiting"))

    def start(self, rows: DataFrame, checkpoint: str, available_now: bool = True):
        w = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, i: self.process(b, i))
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()


def last_batch(spark: SparkSession, folder: str) -> int:
    """The number of the newest batch whose state is stored, -1 for none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/state")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath() for x in fs.listStatus(path)] if fs.exists(path) else []
    whole = [int(p.getName().split("=")[1]) for p in names if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "mark/_SUCCESS"))]
    return max(whole, default=-1)
