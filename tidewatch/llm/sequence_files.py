"""Operator 12: token ids in Arrow files of equal-length sequences.

A file set is a folder of Arrow IPC files (the stream format with the file
format's footer) and a manifest. A file's record batches hold fixed-size
lists: ``ids`` (``length`` ids a row) and ``mask`` (false where a row is
padded), so that sequence *i* of a file lies at a known place of batch
``i // rows``: a memory map gives it without a copy or a scan
(:class:`SequenceFile`). Two more columns name the documents that begin in a
row and where; a document goes on through rows until the next one begins.
Rows are full but for the last one of a file.

Spark writes and reads file sets through a Python data source: every task
attempt writes files of its own names, and only the commit of all tasks names
them in the manifest (written aside, then moved), so lost executors and
repeated attempts leave no trace. ``pyarrow`` opens the folder, which must be
one that driver and executors share: a mounted one (read by memory map), or a
store that ``pyarrow.fs`` knows.

Documents are dealt out by ranges of their key and sorted, so files and rows
follow ascending keys (nulls first). Rows of one key, such as a null one that a
third of all rows have, are told apart by their place in the scan and may be
dealt to several tasks.

Ids come from the ``tokenizers`` library. Its normaliser and splitter never
join characters across ASCII white space, so a text's ids are those of its
white-space runs in order; each task keeps the ids of recent runs and encodes
new ones many at a time.

Defined cases: a null or empty text is its end id alone; texts of any length
are encoded whole, and fill as many rows as they need; repeated rows are
documents of their own; strings of the special tokens are their ids, as the
library gives them; an empty table gives a manifest without files; other
columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import shared_folder, slices

LENGTH = 2048
ROWS = 64
FILE_IDS = 1 << 26
END_ID = 1
FORMAT = "token_sequences"
MANIFEST = "manifest.json"
_IDS = {2: pa.uint16(), 4: pa.uint32()}


# -- ids ---------------------------------------------------------------------

#: The splitter of a public vocabulary of words.
LETTER_SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_LATIN = re.compile("([a-zß-öø-ÿ]+)([.,;:!?]*)")
_NEVER = re.compile("(?!)")


class WordEncoder:
    """Ids of texts by a tokenizer that never joins characters across ASCII
    white space; about ``kept`` recent runs are remembered, and as many before."""

    def __init__(self, path: str, kept: int = 1 << 18):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given the task its core
        self.tokenizer = Tokenizer.from_file(path)
        self.kept = kept
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._type = np.dtype(f"<u{self.width}")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: A special token between two runs is one id that no run has.
        self._between = min(special)
        self._cut = self.tokenizer.token_to_id(self._between)
        self._special = "|".join(map(re.escape, special))
        #: Where the tokenizer lowers letters itself, runs that differ in ASCII case are one.
        self._folds = bool((n := self.tokenizer.normalizer) and n.normalize_str("AZ") == "az")
        #: Where the splitter makes one token of letters and one of marks: such runs in Latin letters without case.
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"]
        self._letters = _LATIN if split == LETTER_SPLITTER and self._folds else _NEVER
        bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
        self._byte_letters = {c: bytewise.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self._of: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self._type)

    def _learn(self, runs: list[str]) -> dict[str, bytes]:
        """Runs of letters, also with a sentence mark behind, are tokens of
        the splitter as they are and go to the library's model at once; other
        runs go through all of the tokenizer, many between special tokens."""
        out, rest, marks = {}, [], {}
        code = "H" if self.width == 2 else "I"
        model, byte_letters = self.tokenizer.model.tokenize, self._byte_letters
        for run in runs:
            if found := self._letters.fullmatch(run):
                word, mark = found.groups()
                ids = [t.id for t in model(word if word.isascii() else word.translate(byte_letters))]
                if mark:
                    if mark not in marks:
                        marks[mark] = [t.id for t in model(mark)]
                    ids += marks[mark]
                out[run] = pack("<%d%s" % (len(ids), code), *ids)
            else:
                rest.append(run)
        groups = [rest[k:k + 500] for k in range(0, len(rest), 500)]
        for at in range(0, len(groups), 16):
            some = groups[at:at + 16]
            joined = [self._between.join(g) for g in some]
            for group, found in zip(some, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
                ids = np.array(found.ids, self._type)
                raw, start = ids.tobytes(), 0
                ends = np.append(np.flatnonzero(ids == self._cut), len(ids)) * self.width
                for run, end in zip(group, ends.tolist(), strict=True):
                    out[run] = raw[start:end]
                    start = end + self.width
        return out

    def _ids(self, runs: list[str]) -> list[bytes]:
        """The ids of distinct runs."""
        if len(self._of) > self.kept:
            self._before, self._of = self._of, {}
        known, before = self._of, self._before
        found = [known.get(r) or before.get(r) for r in runs]
        new = self._learn([r for r, ids in zip(runs, found, strict=True) if ids is None])
        out = [new[r] if ids is None else ids for r, ids in zip(runs, found, strict=True)]
        known.update(zip(runs, out, strict=True))
        return out

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string array. Splitting, telling runs
        apart and putting ids together is vectorised; Python meets each
        distinct run of the array once."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring_regex(texts, self._special, ignore_case=True)
        rows = pc.if_else(special, "", texts)
        split = pc.ascii_split_whitespace(pc.ascii_lower(rows) if self._folds else rows)
        runs = split.flatten().dictionary_encode()
        ids = pa.array(self._ids(runs.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary()).take(runs.indices)
        _, ends, data = ids.buffers()
        joined = np.frombuffer(data or b"", self._type)
        ends = np.frombuffer(ends, np.int32)[:len(ids) + 1] // self.width if len(ids) else np.zeros(1, np.int32)
        borders = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        out = [joined[x:y] for x, y in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
        for k in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            out[k] = self._whole(texts[k].as_py())
        return out


def word_encoder(path: str) -> WordEncoder:
    """One per Python worker, kept for its later tasks."""
    held = sys.__dict__.setdefault("_llm_word_encoders", {})
    if path not in held:
        held[path] = WordEncoder(path)
    return held[path]


def in_order(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and text, dealt out by ranges of the key and sorted."""
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text), F.monotonically_increasing_id().alias("__at"))
    return rows.repartitionByRange(key, "__at").sortWithinPartitions(key, "__at").select(key, text)


# -- files -------------------------------------------------------------------

def _store(folder: str):
    """(file system, path in it) of a shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _schema(length: int, width: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(_IDS[width], length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("doc_keys", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int32()))])


class FileWriter:
    """One file: documents in, record batches of full rows out."""

    def __init__(self, sink, length: int, rows: int, width: int, end_id: int | None = None):
        self.length, self.rows, self.width = length, rows, width
        self.end = np.array([] if end_id is None else [end_id], f"<u{width}")
        self.schema = _schema(length, width)
        self._out = pa.ipc.new_file(sink, self.schema)
        self._parts: list[np.ndarray] = []
        self._held = self._base = self.ids = self.documents = 0
        self._keys: list[int | None] = []
        self._starts: list[int] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self._keys.append(key)
        self._starts.append(self.ids)
        self._parts += [ids, self.end]
        self._held += len(ids) + len(self.end)
        self.ids += len(ids) + len(self.end)
        self.documents += 1
        if self._held >= 4 * self.rows * self.length:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate([*self._parts, np.empty(0, f"<u{self.width}")])
        per = self.rows * self.length
        ready = len(flat) if last else len(flat) - len(flat) % per
        keys, starts = np.array(self._keys, object), np.array(self._starts, np.int64) - self._base
        for at in range(0, ready, per):
            part = flat[at:min(at + per, ready)]
            n = -(-len(part) // self.length)
            mask = np.arange(n * self.length) < len(part)
            inside = slice(*np.searchsorted(starts, [at, at + n * self.length]))
            place = starts[inside] - at
            borders = pa.array(np.searchsorted(place, np.arange(n + 1) * self.length), pa.int32())
            self._out.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(np.pad(part, (0, n * self.length - len(part)))), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                pa.ListArray.from_arrays(borders, pa.array(keys[inside].tolist(), pa.int64())),
                pa.ListArray.from_arrays(borders, pa.array(place % self.length, pa.int32()))], schema=self.schema))
        left = np.searchsorted(starts, ready)
        self._keys, self._starts = self._keys[left:], self._starts[left:]
        self._parts = [flat[ready:].copy()]
        self._held, self._base = len(flat) - ready, self._base + ready

    def close(self) -> None:
        self._flush(True)
        self._out.close()


class SequenceFile:
    """Random access to a file's sequences: ``file[i]`` is (ids, mask) of
    sequence i. Over a memory map the ids are a view of the mapped file and
    the mask an Arrow array over it; nothing is copied."""

    def __init__(self, folder: str, name: str):
        store, path = _store(folder)
        local = store.type_name == "local"
        self.source = pa.memory_map(f"{path}/{name}") if local else store.open_input_file(f"{path}/{name}")
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.batches = self.reader.num_record_batches
        self.rows = self.reader.get_batch(0).num_rows if self.batches else 0
        self._last: tuple[int, pa.RecordBatch] = (-1, None)

    def batch(self, k: int) -> pa.RecordBatch:
        if self._last[0] != k:
            self._last = (k, self.reader.get_batch(k))
        return self._last[1]

    def __len__(self) -> int:
        return (self.batches - 1) * self.rows + self.batch(self.batches - 1).num_rows if self.batches else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        b, row = self.batch(i // self.rows), i % self.rows
        cut = slice(row * self.length, (row + 1) * self.length)
        return b.column("ids").values.to_numpy(zero_copy_only=True)[cut], b.column("mask").values[cut]


@dataclass
class Written(WriterCommitMessage):
    partition: int
    files: list[dict]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        if not overwrite:
            raise ValueError("a file set is written whole: use mode('overwrite')")
        self.folder = options["path"]
        self.length, self.rows = int(options.get("length", LENGTH)), int(options.get("rows", ROWS))
        self.file_ids, self.width = int(options.get("file_ids", FILE_IDS)), int(options.get("width", 2))
        self.tokenizer, self.end_id = options["tokenizer"], int(options.get("end_id", END_ID))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, path = _store(self.folder)
        store.create_dir(path, recursive=True)
        files: list[dict] = []
        held: tuple | None = None
        encoder = word_encoder(self.tokenizer)

        def close():
            sink, file, name = held
            file.close()
            sink.close()
            files.append({"name": name, "ids": file.ids, "documents": file.documents, "sequences": -(-file.ids // self.length)})

        for batch in slices(iterator, "text", 8 << 20):
            for key, ids in zip(batch.column("key").to_pylist(), encoder(batch.column("text")), strict=True):
                if held and held[1].ids >= self.file_ids:
                    close()
                    held = None
                if not held:
                    name = f"{uuid.uuid4().hex}.arrow"
                    sink = store.open_output_stream(f"{path}/{name}")
                    held = sink, FileWriter(sink, self.length, self.rows, self.width, self.end_id), name
                held[1].add(key, ids)
        if held:
            close()
        return Written(TaskContext.get().partitionId(), files)

    def commit(self, messages: list) -> None:
        """Files in order of their partitions, each with the number of ids before it."""
        store, path = _store(self.folder)
        store.create_dir(path, recursive=True)
        files, before = [], 0
        for m in sorted((m for m in messages if m), key=lambda m: m.partition):
            for f in m.files:
                files.append(f | {"first_id": before})
                before += f["ids"]
        aside = f"{path}/{uuid.uuid4().hex}.tmp"
        with store.open_output_stream(aside) as out:
            out.write(json.dumps({"length": self.length, "rows": self.rows, "width": self.width, "ids": before, "files": files}).encode())
        store.move(aside, f"{path}/{MANIFEST}")

    def abort(self, messages: list) -> None:
        store, path = _store(self.folder)
        for m in messages:
            for f in m.files if m else ():
                store.delete_file(f"{path}/{f['name']}")


def manifest(folder: str) -> dict:
    store, path = _store(folder)
    with store.open_input_stream(f"{path}/{MANIFEST}") as src:
        return json.loads(src.read())


@dataclass
class FilePart(InputPartition):
    name: str
    first_id: int
    ids: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict, view: str):
        self.folder, self.view = options["path"], view

    def partitions(self) -> list[FilePart]:
        return [FilePart(f["name"], f["first_id"], f["ids"]) for f in manifest(self.folder)["files"]] or [FilePart("", 0, 0)]

    def read(self, part: FilePart) -> Iterator[pa.RecordBatch]:
        if part.name:
            file = SequenceFile(self.folder, part.name)
            yield from (_documents if self.view == "documents" else _sequences)(file, part)


def _sequences(file: SequenceFile, part: FilePart) -> Iterator[pa.RecordBatch]:
    for k in range(file.batches):
        b = file.batch(k)
        at = pa.array(np.arange(b.num_rows, dtype=np.int64) + k * file.rows)
        yield pa.RecordBatch.from_arrays([pa.array([part.name] * b.num_rows), at, b.column("ids").cast(pa.list_(pa.int32())),
                                          b.column("mask").cast(pa.list_(pa.bool_()))], names=["file", "sequence", "ids", "mask"])


def _documents(file: SequenceFile, part: FilePart) -> Iterator[pa.RecordBatch]:
    """A document ends where the next one begins, or with the file's ids."""
    names = ["key", "start", "n_tokens", "ids_crc32"]
    open_key, open_at, crc, opened = None, 0, 0, False
    for k in range(file.batches):
        b = file.batch(k)
        base = k * file.rows * file.length
        ids = b.column("ids").values.to_numpy(zero_copy_only=True)[:part.ids - base].astype("<u4")
        sizes = np.diff(b.column("doc_starts").offsets.to_numpy())
        starts = b.column("doc_starts").values.to_numpy() + np.repeat(np.arange(b.num_rows) * file.length, sizes)
        out: list[tuple] = []
        at = 0
        for key, start in zip(b.column("doc_keys").values.to_pylist(), starts.tolist(), strict=True):
            crc = zlib.crc32(ids[at:start], crc)
            if opened:
                out.append((open_key, part.first_id + open_at, base + start - open_at, crc))
            open_key, open_at, crc, opened, at = key, base + start, 0, True, start
        crc = zlib.crc32(ids[at:], crc)
        if k == file.batches - 1 and opened:
            out.append((open_key, part.first_id + open_at, part.ids - open_at, crc))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)


class SequenceSource(DataSource):
    """``format("token_sequences")``; option ``view`` of a read: ``sequences``
    (file, sequence, ids, mask) or ``documents`` (key, start, n_tokens,
    ids_crc32, from the ids in the files)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        if self.options.get("view") == "documents":
            return "key long, start long, n_tokens long, ids_crc32 long"
        return "file string, sequence long, ids array<int>, mask array<boolean>"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), overwrite)

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options), self.options.get("view", "sequences"))


def write(docs: DataFrame, folder: str, tokenizer: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID, length: int = LENGTH,
          rows: int = ROWS, file_ids: int = FILE_IDS) -> None:
    """The documents' ids in ascending key order as a file set in ``folder``."""
    docs.sparkSession.dataSource.register(SequenceSource)
    rows_in_order = in_order(docs, text, key).toDF("key", "text")
    options = {"length": length, "rows": rows, "file_ids": file_ids, "width": word_encoder(tokenizer).width, "tokenizer": tokenizer, "end_id": end_id}
    rows_in_order.write.format(FORMAT).options(**options).mode("overwrite").save(folder)


def read(spark: SparkSession, folder: str, view: str = "sequences") -> DataFrame:
    spark.dataSource.register(SequenceSource)
    return spark.read.format(FORMAT).option("view", view).load(folder)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that goes when the session ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def document_ids(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Writes the documents and reads them back: key, start, n_tokens and
    ids_crc32 of each."""
    folder = scratch_folder(docs.sparkSession, "token-sequences")
    write(docs, folder, tokenizer, text, key)
    return read(docs.sparkSession, folder, "documents").withColumnRenamed("key", key)
