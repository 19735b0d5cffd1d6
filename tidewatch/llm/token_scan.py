"""Operator 10: token counts by a separator scan of flat token files.

A flat token file is a stream of token ids in which every document ends with
a separator id; it has no index. Files are stored as blocks of ``BLOCK_IDS``
ids that ignore document borders, one row per block. The scan:

1. finds the separators of each block with one vectorised comparison;
2. stitches borders across blocks by a prefix scan over block summaries (ids,
   separators, last separator): in two levels, runs of ``RUN`` blocks first,
   so that a file of any length is spread over many tasks;
3. turns each separator into a document: its number in the file, its first
   id and its length.

``write`` makes such files from texts: one per input partition, in Parquet
rows in the shared folder, with a manifest of the documents' ids in order
that the scan never reads.

Defined cases: a null or empty text is a document of no tokens; a document
may span any number of blocks; ids after a file's last separator are one
unterminated document; blocks may be short or empty; a file without blocks
has no documents; repeated rows are documents of their own; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .tokens import encoder

SEPARATOR = 50256
BLOCK_IDS = 1 << 16
RUN = 1024
_WIDTH = {2: np.dtype("<u2"), 4: np.dtype("<u4")}
FILES = "file int, block long, ids binary, first long, keys array<long>"


def _writer(ranks_path: str, separator: int, block_ids: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file = TaskContext.get().partitionId()
        encode = encoder(ranks_path)
        end = np.array([separator], _WIDTH[width])
        held: list[np.ndarray] = []
        n = block = done = 0
        names = ["file", "block", "ids", "first", "keys"]

        def blocks(last: bool):
            nonlocal n, block
            if not held:
                return
            flat = np.concatenate(held)
            cut = len(flat) if last else len(flat) - len(flat) % block_ids
            for k in range(0, cut, block_ids):
                yield pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([flat[k:min(k + block_ids, cut)].tobytes()], pa.binary()),
                                                  pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int64()))], names=names)
                block += 1
            held[:] = [flat[cut:]] if cut < len(flat) else []
            n = len(flat) - cut

        for b in batches:
            keys = b.column(0).to_pylist()
            for text in b.column(1):
                ids = encode(text.as_py() or "").astype(_WIDTH[width])
                held += [ids, end]
                n += len(ids) + 1
                if n >= 8 * block_ids:
                    yield from blocks(False)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                                  pa.array([done], pa.int64()), pa.array([keys], pa.list_(pa.int64()))], names=names)
            done += len(keys)
        yield from blocks(True)
    return run


def write(docs: DataFrame, ranks_path: str, text: str = "text", key: str = "doc_id", separator: int = SEPARATOR,
          block_ids: int = BLOCK_IDS, width: int = 2) -> tuple[DataFrame, DataFrame]:
    """(token files: file, block, ids; manifest: file, ordinal, key) of the
    documents, in the shared folder. width: bytes per id."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    out = staged(rows.mapInArrow(_writer(ranks_path, separator, block_ids, width), FILES), "token-files")
    manifest = out.where("keys is not null").select("file", F.posexplode("keys").alias("at", "key"), "first")
    return (out.where("ids is not null").select("file", "block", "ids"),
            manifest.select("file", (F.col("first") + F.col("at")).alias("ordinal"), "key"))


def _find(separator: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, sizes = [], []
            for data in b.column("ids"):
                ids = np.frombuffer(data.as_buffer(), _WIDTH[width])
                found.append(np.flatnonzero(ids == separator))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                             names=["file", "block", "n", "seps"])
    return run


def scan(files: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """One row per document: file, ordinal (from 0), start (its first id's
    place in the file), n_tokens (without the separator), terminated."""
    found = staged(files.mapInArrow(_find(separator, width), "file int, block long, n long, seps array<long>"), "token-separators")
    last = F.when(F.size("seps") > 0, F.element_at("seps", -1))
    blocks = found.select("file", "block", F.floor(F.col("block") / RUN).alias("run"), "n", F.size("seps").cast("long").alias("k"), last.alias("last"))

    def prefix(rows: DataFrame, by: list[str], order: str) -> DataFrame:
        """Ids and separators before each row, and the end of the last
        document before it, all counted from the row group's first id."""
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumns({"ids": F.coalesce(F.sum("n").over(before), F.lit(0)), "docs": F.coalesce(F.sum("k").over(before), F.lit(0))})
        return rows.withColumn("open", F.max(F.col("ids") + F.col("last") + 1).over(before))

    inner = prefix(blocks, ["file", "run"], "block")
    # a run's own summary: its ids, separators and the place after its last separator
    runs = inner.groupBy("file", "run").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max(F.col("ids") + F.col("last")).alias("last"))
    outer = prefix(runs, ["file"], "run").select("file", "run", F.col("ids").alias("run_ids"), F.col("docs").alias("run_docs"), F.col("open").alias("run_open"),
                                                 (F.row_number().over(Window.partitionBy("file").orderBy(F.desc("run"))) == 1).alias("final_run"))
    placed = inner.join(outer, ["file", "run"]).select(
        "file", "block", (F.col("run_ids") + F.col("ids")).alias("base"), (F.col("run_docs") + F.col("docs")).alias("docs"),
        F.coalesce(F.col("run_ids") + F.col("open"), "run_open", F.lit(0)).alias("open"))
    whole = found.join(placed, ["file", "block"])
    docs = whole.select("file", "base", "docs", "open", "seps", F.posexplode("seps").alias("i", "sep"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("base") + F.get("seps", F.col("i") - 1) + 1)
    docs = docs.select("file", (F.col("docs") + F.col("i")).alias("ordinal"), start.alias("start"),
                       (F.col("base") + F.col("sep") - start).alias("n_tokens"), F.lit(True).alias("terminated"))
    ends = runs.groupBy("file").agg(F.sum("n").alias("ids"), F.sum("k").alias("k"))
    tail = outer.where("final_run").join(runs.select("file", "run", "last"), ["file", "run"]).join(ends, "file").select(
        "file", F.col("k").alias("ordinal"), F.coalesce(F.col("run_ids") + F.col("last") + 1, "run_open", F.lit(0)).alias("start"), "ids")
    tail = tail.where("ids > start").select("file", "ordinal", "start", (F.col("ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("terminated"))
    return docs.union(tail)


def token_counts(docs: DataFrame, ranks_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_tokens, file, start of each document, by the scan of its file."""
    files, manifest = write(docs, ranks_path, text, key)
    return scan(files).join(manifest, ["file", "ordinal"]).select(F.col("key").alias(key), "n_tokens", "file", "start")
