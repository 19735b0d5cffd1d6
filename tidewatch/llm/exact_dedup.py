"""Operator 3: exact dedup by Grace hash partitioning.

Rows are dealt out by a hash of their content; each bucket goes through an
open-addressing table that compares complete contents. Memory is bounded:
a table takes contents up to ``table_bytes``, and what finds no room is dealt
out again by another hash, level by level, until every bucket fits. The
partition files are Spark's own exchange files and tables in the shared
folder, so a lost executor costs a retry and no spill file lives on one
machine only.

Before the first exchange each input partition goes through tables of its
own (emptied whenever they are full), so a group of copies reaches an
exchange at most once per input partition and table: a group with a third of
all rows is as cheap as any other.

Defined cases: a null text counts as empty; all empty (or blank) texts are
one group; ties in length go to the smallest ``doc_id`` (null last), repeated
rows (equal in both) keep exactly one of them; an empty table gives no rows;
extra columns pass through :func:`dedupe` under any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, slices, staged, with_row_id

TABLE_BYTES = 64 << 20
_DELETED = SPACES.encode()


class ContentTable:
    """Open addressing with linear probing; equal hashes are told apart by
    the complete content."""

    def __init__(self, table_bytes: int):
        self.room = table_bytes
        self.slots = np.full(1 << 10, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def _slot(self, h: int, content: bytes) -> tuple[int, int]:
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return at, entry
            at = (at + 1) & mask
        return at, -1

    def find_or_add(self, h: int, content: bytes) -> int | None:
        """The content's number; a new one if there is room, else None. The
        first content always finds room."""
        at, entry = self._slot(h, content)
        if entry >= 0:
            return entry
        cost = len(content) + 200
        if cost > self.room and self.contents:
            return None
        self.room -= cost
        entry = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.slots[at] = entry
        if 2 * len(self.contents) > len(self.slots):
            mask = 2 * len(self.slots) - 1
            self.slots = np.full(mask + 1, -1, np.int64)
            for i, x in enumerate(self.hashes):
                at = x & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = i
        return entry


def normalised(text: bytes | None) -> bytes:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``."""
    return (text or b"").translate(None, _DELETED)


def _bucket_hash(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little") >> 1


_MEMBER = "__row long, doc_id long, part int, class long, sha binary"
_CLASS = "size long, best_chars long, best_doc long, best_row long, content binary"
LOCAL = f"{_MEMBER}, {_CLASS}"


def _better(a: tuple, b: tuple) -> bool:
    """a, b: (chars, doc_id, row). More code points, then the smaller doc_id
    (null last), then the earlier row."""
    key = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    return key(a) < key(b)


def _local_groups(table_bytes: int):
    """Each input partition: a row per document (its class in the partition)
    and a row per class (size, best row, content)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        state = {"table": ContentTable(table_bytes), "first": 0}
        sizes: list[int] = []
        best: list[tuple] = []
        digests: list[bytes] = []
        schema = pa.schema([("__row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("class", pa.int64()),
                            ("sha", pa.binary()), ("size", pa.int64()), ("best_chars", pa.int64()),
                            ("best_doc", pa.int64()), ("best_row", pa.int64()), ("content", pa.binary())])

        def classes(step: int = 512):
            contents = state["table"].contents
            for k in range(0, len(contents), step):
                n = len(contents[k:k + step])
                bs = best[k:k + step]
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([part] * n, pa.int32()),
                    pa.array(range(state["first"] + k, state["first"] + k + n), pa.int64()),
                    pa.array(digests[k:k + step], pa.binary()), pa.array(sizes[k:k + step], pa.int64()),
                    pa.array([b[0] for b in bs], pa.int64()), pa.array([b[1] for b in bs], pa.int64()),
                    pa.array([b[2] for b in bs], pa.int64()), pa.array(contents[k:k + step], pa.binary())], schema=schema)
            state["first"] += len(contents)
            state["table"] = ContentTable(table_bytes)
            sizes.clear(), best.clear(), digests.clear()

        for batch in slices(batches, "text"):
            rows, docs, chars, texts = (c.to_pylist() for c in batch.columns)
            own: list[int] = []
            shas: list[bytes] = []
            flushed = []
            for row, doc, n, text in zip(rows, docs, chars, texts, strict=True):
                content = normalised(text)
                sha = hashlib.sha256(content).digest()
                entry = state["table"].find_or_add(_bucket_hash(sha), content)
                if entry is None:
                    flushed += classes()
                    entry = state["table"].find_or_add(_bucket_hash(sha), content)
                if entry == len(sizes):
                    sizes.append(0), best.append((n, doc, row)), digests.append(sha)
                elif _better((n, doc, row), best[entry]):
                    best[entry] = (n, doc, row)
                sizes[entry] += 1
                own.append(state["first"] + entry)
                shas.append(sha)
            yield from flushed
            n = len(rows)
            if n:
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1), pa.array([part] * n, pa.int32()), pa.array(own, pa.int64()),
                    pa.array(shas, pa.binary()), *(pa.nulls(n, f.type) for f in schema if f.name in
                    ("size", "best_chars", "best_doc", "best_row", "content"))], schema=schema)
        yield from classes()
    return run


_RESOLVED = "part int, class long, keep_id long, keep_row long, group_size long, level_row boolean"
MERGED = f"{_RESOLVED}, sha binary, {_CLASS}"


def _merge_groups(table_bytes: int):
    """One bucket: the classes of equal content become one group. A row per
    class with its group's result, or the class itself where the table had no
    room (``level_row`` false)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(table_bytes)
        sizes: list[int] = []
        best: list[tuple] = []
        members: list[list[tuple]] = []
        names = [f.split()[0] for f in MERGED.split(", ")]
        types = {"part": pa.int32(), "level_row": pa.bool_(), "sha": pa.binary(), "content": pa.binary()}
        schema = pa.schema([(n, types.get(n, pa.int64())) for n in names])
        for batch in slices(batches, "content"):
            over = []
            for at, r in enumerate(zip(*(batch.column(n).to_pylist() for n in (
                    "part", "class", "sha", "size", "best_chars", "best_doc", "best_row", "content")), strict=True)):
                part, cls, sha, size, chars, doc, row, content = r
                entry = table.find_or_add(_bucket_hash(sha), content)
                if entry is None:
                    over.append(at)
                    continue
                if entry == len(sizes):
                    sizes.append(0), best.append((chars, doc, row)), members.append([])
                elif _better((chars, doc, row), best[entry]):
                    best[entry] = (chars, doc, row)
                sizes[entry] += size
                members[entry].append((part, cls))
            if over:
                left = batch.take(pa.array(over))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([False] * len(over)) if n == "level_row" else left.column(n)
                     if n in left.schema.names else pa.nulls(len(over), schema.field(n).type) for n in names], schema=schema)
        flat = [(p, c, best[g][1], best[g][2], sizes[g], True) for g, m in enumerate(members) for p, c in m]
        for k in range(0, len(flat), 10_000):
            rows = flat[k:k + 10_000]
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[i], schema.field(n).type) if i < 6 else pa.nulls(len(rows), schema.field(n).type)
                 for i, n in enumerate(names)], schema=schema)
    return run


def _buckets(total_bytes: int, table_bytes: int, least: int) -> int:
    """As many that a bucket fills half a table on average."""
    return max(least, -(-2 * total_bytes // table_bytes))


def _resolve(classes: DataFrame, total_bytes: int, table_bytes: int, content: str, step) -> DataFrame:
    """Deals ``classes`` out into buckets, level by level, until no row
    overflows; ``step`` puts a bucket through its table. Returns the resolved
    rows of all levels."""
    least = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done: DataFrame | None = None
    level = 0
    while True:
        dealt = classes.repartition(_buckets(total_bytes, table_bytes, least), F.xxhash64("sha", F.lit(level)))
        out = staged(step(dealt), f"dedup-level{level}")
        ready = out.where("level_row")
        done = ready if done is None else done.unionByName(ready)
        classes = out.where("not level_row")
        rows, total_bytes = classes.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(content)), F.lit(0))).first()
        if not rows:
            return done
        level += 1


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id",
                 table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``__row``, ``doc_id``, ``keep_id`` (the
    key of the row that stays), ``group_size``, ``kept``, ``text_sha256``
    (hex, of the normalised text)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = with_row_id(docs).select("__row", F.col(key).cast("long").alias("doc_id"),
                                    F.length(whole).cast("long").alias("chars"), whole.cast("binary").alias("text"))
    local = staged(rows.mapInArrow(_local_groups(table_bytes), LOCAL), "dedup-local")
    classes = local.where("size is not null").select("part", "class", "sha", "size", "best_chars", "best_doc", "best_row", "content")
    total = classes.agg(F.sum(F.length("content"))).first()[0] or 0
    merged = _resolve(classes, total, table_bytes, "content", lambda df: df.mapInArrow(_merge_groups(table_bytes), MERGED))
    members = local.where("size is null").select("__row", "doc_id", "part", "class", "sha")
    found = merged.select("part", "class", "keep_id", "keep_row", "group_size")
    return (members.join(found, ["part", "class"])
            .select("__row", "doc_id", "keep_id", "group_size", (F.col("__row") == F.col("keep_row")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def _winners(schema: T.StructType, table_bytes: int, text: str, local: bool):
    """Rows pass with all their columns; of equal contents the best stays.
    local: a full table is emptied; else what has no room is marked."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(table_bytes)
        best: list[tuple] = []
        rows: list[dict] = []

        def flush():
            for k in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[k:k + 256], schema=arrow)
            rows.clear(), best.clear()

        for batch in slices(batches, text):
            for r in batch.to_pylist():
                content = normalised((r[text] or "").encode())
                r["sha"] = hashlib.sha256(content).digest()
                rank = (r["chars"], r["key"], r["row"])
                entry = table.find_or_add(_bucket_hash(r["sha"]), content)
                if entry is None:
                    if not local:
                        r["level_row"] = False
                        yield pa.RecordBatch.from_pylist([r], schema=arrow)
                        continue
                    yield from flush()
                    table = ContentTable(table_bytes)
                    entry = table.find_or_add(_bucket_hash(r["sha"]), content)
                r["level_row"] = True
                if entry == len(rows):
                    rows.append(r), best.append(rank)
                elif _better(rank, best[entry]):
                    rows[entry], best[entry] = r, rank
        yield from flush()
    return run


def dedupe(docs: DataFrame, text: str = "text", key: str = "doc_id", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with all their columns: one exchange of what is
    left after each input partition's own tables."""
    plain = [f"c{i}" for i in range(len(docs.columns))]  # inner names, so that no column clashes
    t, k = plain[docs.columns.index(text)], plain[docs.columns.index(key)]
    rows = with_row_id(docs.toDF(*plain), "row").withColumns({
        "chars": F.coalesce(F.length(t), F.lit(0)).cast("long"), "key": F.col(k).cast("long"),
        "sha": F.lit(None).cast("binary"), "level_row": F.lit(True)})
    back = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
    total = docs.toDF(*plain).agg(F.sum(F.octet_length(t))).first()[0] or 0
    local = rows.mapInArrow(_winners(back, table_bytes, t, True), back)
    merged = _resolve(local, total, table_bytes, t, lambda df: df.mapInArrow(_winners(back, table_bytes, t, False), back))
    return merged.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)])
