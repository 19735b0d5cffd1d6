"""Operator 11: repairs the structure of conversations.

A well-formed conversation's roles begin as ``(s?(ua)+)?``. Turns are aligned
to the alternating grammar by :mod:`.turn_alignment`; here Spark brings each
conversation's turns together in order and applies the edits.

A conversation's rows are taken by turn (nulls first), equal turns by role and
text. A row's first fault counts: blank (nothing but white space), duplicate
(role and text seen earlier), truncated (the last character that is no white
space is none of ``.!?``). Blank and duplicate rows are deleted.

Conversations of at most ``long_rows`` rows and ``long_bytes`` bytes are
dealt out by conversation, sorted and repaired as a stream of rows. Longer
ones, which may hold a third of all rows, never gather in one task: equal rows
are counted first, rows are dealt out by ranges of (conversation, turn, role,
text), each chunk of 64 gives its cheapest audits between any two places of
the grammar, and only these few numbers are folded, within a range and then
over the ranges of a conversation, to find the place at which each chunk
begins. The results are the same. What remains sequential is what the result
itself asks for: an audit is one string, and the SHA-256 of a repaired
conversation is one computation, made over a sorted stream that is not held.

Defined cases: a null id is a conversation of its own; a null role or text is
one space (so a null text is blank), a null turn comes first and takes no part
in gaps; any other role's initial is its first character, an empty role's the
empty string, and such rows are rerolled or deleted; a conversation of no rows
has zeros, an empty audit and the hash of nothing; an empty table gives no
rows; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, slices, staged
from .turn_alignment import CHUNK, _FAR, align, behind, choice, close, through

LONG_ROWS = 4096
LONG_BYTES = 32 << 20
_ROLES = {"u": "user", "a": "assistant"}
_FITTING = {"su", "ua", "au"}
SUMMARY = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
TURNS = "conv string, position long, edit string, role string, text string"


def _arrow(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(","))])


def damage(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """The contract's damage by crc32 of ``id:turn`` modulo 20. Rows are not
    multiplied: ``copies`` says how often one stands in its place."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name(key), F.lit(":"), name("turn"))) % 20
    text = name("text")
    return rows.select(
        F.col(key), F.col("turn"), F.when(kind == 4, "user").otherwise(name("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _rows(turns: DataFrame, key: str) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    return turns.select(text(key).alias("conv"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"),
                        text("text").alias("text"), F.coalesce(copies.cast("long"), F.lit(1)).alias("copies"))


def repaired(audit: str, roles: list[str], place: int = 0) -> Iterator[tuple[int | None, str, str]]:
    """(row, edit, role) of each edit; inserts have no row, deletes no role.
    ``place`` is the grammar's place before the first one."""
    i = 0
    for e in audit:
        if e == "D":
            yield i, e, ""
            i += 1
            continue
        if e == "K":
            role, letter = roles[i], roles[i][:1]
        else:
            letter = "a" if place == 2 else "u"
            role = _ROLES[letter]
        place = {"s": 1, "u": 2, "a": 3}[letter]
        yield (None if e == "I" else i), e, role
        i += e != "I"


def symbol(role: str, truncated: bool) -> str:
    c = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return c.upper() if truncated else c


def _conversation(rows: list[tuple]) -> tuple[list, str, list[tuple], tuple]:
    """(counts, audit, edits, rows) of (turn, role, text) in order."""
    seen: set = set()
    symbols, counts = [], [0, 0, 0]
    for _, role, text in rows:
        end = text.rstrip(SPACES)
        if not end:
            fault = 0
        elif (role, text) in seen:
            fault = 1
        else:
            fault = 2 if end[-1] not in ".!?" else 3
        seen.add((role, text))
        if fault < 3:
            counts[fault] += 1
        symbols.append("x" if fault < 2 else symbol(role, fault == 2))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in _FITTING for a, b in zip(initials, initials[1:], strict=False))
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = align("".join(symbols))
    return [gaps, *counts, illegal, cost], audit, list(repaired(audit, [r[1] for r in rows])), rows


def _short(edits: bool):
    """Repairs conversations whose rows come sorted, one after the other."""
    def finished(conv: str, rows: list[tuple]):
        counts, audit, done, rows = _conversation(rows)
        if edits:
            return [(conv, k, e, role or rows[i][1], "" if i is None else rows[i][2]) for k, (i, e, role) in enumerate(done)]
        lines = [f"{role}:{'' if i is None else rows[i][2]}" for i, e, role in done if e != "D"]
        return [(conv, *counts, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(TURNS if edits else SUMMARY)
        now, rows, out = None, [], []
        for b in slices(batches, "text"):
            for conv, turn, role, text, copies in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies")), strict=True):
                if conv != now:
                    if now is not None:
                        out += finished(now, rows)
                    now, rows = conv, []
                rows += [(turn, role, text)] * copies
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if now is not None and (out := finished(now, rows)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    return run


# -- long conversations --------------------------------------------------------

def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each distinct row of a conversation once: with the number of its
    copies, its first fault and its place (a long in the rows' order, whose
    upper bits are the range it was dealt to); and its text by place."""
    text = F.col("text")
    facts = (rows.where("copies > 0").groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
             .withColumn("same", F.sha2(text, 256)))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # nulls first
    facts = staged(facts.repartitionByRange("conv", "turn", "role", "same").sortWithinPartitions("conv", "turn", "role", "text")
                   .withColumn("place", F.monotonically_increasing_id()), "long-turns")
    first = facts.groupBy("conv", "role", "same").agg(F.min(order).alias("first"))
    end = F.rtrim(text, F.lit(SPACES))
    known = facts.join(first, ["conv", "role", "same"])
    fault = F.when(end == "", 0).when(known["first.turn"].eqNullSafe(known["turn"]), F.when(F.substring(end, -1, 1).isin(".", "!", "?"), 3).otherwise(2)).otherwise(1)
    return staged(known.select("conv", "turn", "role", "copies", "place", F.shiftright("place", 33).alias("part"), fault.alias("fault")), "long-faults"), facts


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk: its audits between any two places, its last audits, and the
    illegal neighbours in it."""
    for frame in batches:
        out = []
        for conv, part, chunk, turns in zip(frame["conv"], frame["part"], frame["chunk"], frame["turns"], strict=True):
            symbols, weights, places, roles, illegal = [], [], [], [], 0
            before = None
            for t in turns:
                place, role, copies, fault = t["place"], t["role"], t["copies"], t["fault"]
                letter = role[:1]
                illegal += (before is not None and before + letter not in _FITTING) + copies - 1
                before = letter
                live = fault >= 2
                if live:
                    symbols.append(symbol(role, fault == 2)), weights.append(1), places.append(place), roles.append(role)
                if copies > live:
                    symbols.append("x"), weights.append(copies - live), places.append(place), roles.append(role)
            text, w = "".join(symbols), tuple(weights)
            m = through(text, w)
            last = [close(text, w, p) for p in range(4)]
            flat = [m[p][q] or (_FAR, "") for p in range(4) for q in range(4)] + last
            out.append((conv, part, chunk, [c for c, _ in flat], [a for _, a in flat], places, roles, weights, illegal, turns[0]["role"][:1], before))
        yield pd.DataFrame(out, columns=["conv", "part", "chunk", "costs", "audits", "places", "roles", "weights", "illegal", "head", "end"])


_CHUNKS = ("conv string, part long, chunk long, costs array<long>, audits array<string>, places array<long>, roles array<string>, "
           "weights array<long>, illegal long, head string, end string")


def _matrix(costs, audits=None) -> list:
    return [[None if costs[4 * p + q] >= _FAR else (int(costs[4 * p + q]), audits[4 * p + q] if audits is not None else "") for q in range(4)] for p in range(4)]


def _product(a: list, b: list) -> list:
    return [[min((a[p][k] + b[k][q] for k in range(4)), default=_FAR) for q in range(4)] for p in range(4)]


def _borders(rows: pd.DataFrame) -> int:
    return int(rows["illegal"].sum()) + sum(a + b not in _FITTING for a, b in zip(rows["end"][:-1], rows["head"][1:], strict=True))


def _range(rows: pd.DataFrame) -> pd.DataFrame:
    """The chunks of a range as one: costs between places, with the last
    chunk taken as one in between and as the end."""
    rows = rows.sort_values("chunk", ignore_index=True)
    total = [[0 if p == q else _FAR for q in range(4)] for p in range(4)]
    for costs in rows["costs"][:-1]:
        total = _product(total, [[int(x) for x in costs[4 * p:4 * p + 4]] for p in range(4)])
    costs = rows["costs"].iloc[-1]
    through_all = _product(total, [[int(x) for x in costs[4 * p:4 * p + 4]] for p in range(4)])
    ended = [min(total[p][q] + int(costs[16 + q]) for q in range(4)) for p in range(4)]
    return pd.DataFrame([(rows["conv"][0], rows["part"][0], [min(x, _FAR) for r in through_all for x in r], ended, _borders(rows), rows["head"].iloc[0], rows["end"].iloc[-1])],
                        columns=["conv", "part", "costs", "ended", "illegal", "head", "end"])


def _after(rows: pd.DataFrame) -> pd.DataFrame:
    """Over a conversation's ranges: the costs behind each, null at the end."""
    rows = rows.sort_values("part", ignore_index=True)
    costs = behind([_matrix(c) for c in rows["costs"][:-1]], [int(x) for x in rows["ended"].iloc[-1]])
    after = [*costs[1:], None]
    return pd.DataFrame({"conv": rows["conv"], "part": rows["part"], "after": after, "cost": costs[0][0], "illegal": _borders(rows)})


def _choices(rows: pd.DataFrame) -> pd.DataFrame:
    """Per chunk of a range the place to which the least audit leads from
    each place, and the range's own such places."""
    rows = rows.sort_values("chunk", ignore_index=True)
    after = rows["after"].iloc[0]
    matrices = [_matrix(c, a) for c, a in zip(rows["costs"], rows["audits"], strict=True)]
    last = after is None
    costs = behind(matrices[:-1], [int(x) for x in rows["costs"].iloc[-1][16:]]) + [None] if last else behind(matrices, [int(x) for x in after])
    leads = [[-1] * 4 if last and k == len(rows) - 1 else [choice(m, p, costs[k + 1]) for p in range(4)] for k, m in enumerate(matrices)]
    ends = list(range(4))
    for lead in leads:
        ends = [lead[p] if p >= 0 else p for p in ends]
    return pd.DataFrame({"conv": rows["conv"], "part": rows["part"], "chunk": rows["chunk"], "leads": leads, "ends": [ends] * len(rows)})


def _entries(by: str, leads: str):
    """The place at which each row begins, the first one at ``enter``."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(by, ignore_index=True)
        place, out = int(rows["enter"].iloc[0]), []
        for lead in rows[leads]:
            out.append(place)
            place = int(lead[place])
        return rows[["conv", "part", *(["chunk"] if by == "chunk" else [])]].assign(enter=out)
    return run


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each chunk's audit, and its edits."""
    for frame in batches:
        out = []
        for r in frame.itertuples():
            p = r.enter
            audit = r.audits[4 * p + r.leads[p]] if r.leads[p] >= 0 else r.audits[16 + p]
            weights, roles, places = [int(x) for x in r.weights], list(r.roles), list(r.places)
            edits = [{"place": None if at is None else places[at], "edit": e, "role": role or roles[at], "times": weights[at] if e == "D" else 1}
                     for at, e, role in repaired(audit, roles, place=p)]
            whole, i = [], 0
            for e in audit:
                whole.append(e * weights[i] if e == "D" else e)
                i += e != "I"
            out.append((r.conv, r.part, r.chunk, "".join(whole), edits))
        yield pd.DataFrame(out, columns=["conv", "part", "chunk", "audit", "edits"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come sorted; none is held."""
    now, state = None, None
    for b in slices(batches, "line"):
        for conv, line in zip(b.column("conv").to_pylist(), b.column("line").to_pylist(), strict=True):
            if conv != now:
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["conv", "repaired_sha256"])
                now, state = conv, hashlib.sha256(line.encode())
            else:
                state.update(b"\n" + line.encode())
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["conv", "repaired_sha256"])


def _long(rows: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """(summary, edits) of long conversations."""
    faults, facts = _placed(rows)
    number = F.floor(F.col("place").bitwiseAND((1 << 33) - 1) / chunk).alias("chunk")
    turn = F.struct("place", "role", "copies", "fault")
    chunks = staged(faults.select("conv", "part", number, turn.alias("turn")).groupBy("conv", "part", "chunk").agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # a chunk at most
                    .mapInPandas(_chunks, _CHUNKS), "turn-chunks")
    costs = chunks.select("conv", "part", "chunk", "costs", "illegal", "head", "end")
    ranges = staged(costs.groupBy("conv", "part").applyInPandas(_range, "conv string, part long, costs array<long>, ended array<long>, illegal long, head string, end string"), "turn-ranges")
    after = staged(ranges.groupBy("conv").applyInPandas(_after, "conv string, part long, after array<long>, cost long, illegal long"), "turn-costs")
    leads = staged(chunks.select("conv", "part", "chunk", "costs", "audits").join(after.select("conv", "part", "after"), ["conv", "part"]).groupBy("conv", "part")
                   .applyInPandas(_choices, "conv string, part long, chunk long, leads array<int>, ends array<int>"), "turn-choices")
    ends = leads.groupBy("conv", "part").agg(F.min("ends").alias("ends"), F.lit(0).alias("enter"))
    enter = ends.groupBy("conv").applyInPandas(_entries("part", "ends"), "conv string, part long, enter int")
    entry = (leads.join(enter, ["conv", "part"]).groupBy("conv", "part")
             .applyInPandas(_entries("chunk", "leads"), "conv string, part long, chunk long, enter int"))
    pieces = staged(chunks.join(leads.drop("ends"), ["conv", "part", "chunk"]).join(entry, ["conv", "part", "chunk"]).mapInPandas(
        _pieces, "conv string, part long, chunk long, audit string, edits array<struct<place:long,edit:string,role:string,times:long>>"), "turn-pieces")
    edits = pieces.select("conv", "part", "chunk", F.posexplode("edits").alias("at", "e")).select("conv", "part", "chunk", "at", "e.*")
    edits = edits.join(facts.select("place", "text"), "place", "left").withColumn("text", F.coalesce("text", F.lit("")))
    lines = edits.where("edit <> 'D'").select("conv", "part", "chunk", "at", F.concat("role", F.lit(":"), "text").alias("line"))
    hashes = lines.repartition("conv").sortWithinPartitions("conv", "part", "chunk", "at").mapInArrow(_hashes, "conv string, repaired_sha256 string")
    audit = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "chunk", "audit"))).alias("a"))  # the result's own string
    audit = audit.select("conv", F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit"))
    kinds = {"blank": F.when(F.col("fault") == 0, F.col("copies")), "duplicate": F.when(F.col("fault") == 1, F.col("copies")).when(F.col("fault") > 1, F.col("copies") - 1),
             "truncated": F.when(F.col("fault") == 2, 1)}
    counted = faults.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"), *[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in kinds.items()])
    totals = after.groupBy("conv").agg(F.min("cost").alias("cost"), F.min("illegal").alias("illegal"))
    out = counted.join(totals, "conv").join(audit, "conv").join(hashes, "conv", "left")
    nothing = F.sha2(F.lit(""), 256)
    summary = out.select("conv", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                         F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
    return summary, edits


def _split(rows: DataFrame, long_rows: int, long_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of short conversations, rows of long ones, None if there are none)."""
    sizes = rows.groupBy("conv").agg(F.sum("copies").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = staged(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("conv"), "long-conversations")
    if long.isEmpty():
        return rows, None
    return rows.join(long, "conv", "left_anti"), rows.join(long, "conv", "left_semi")


def _run(turns: DataFrame, key: str, edits: bool, long_rows: int, long_bytes: int, chunk: int) -> DataFrame:
    rows = _rows(turns, key)
    short, long = _split(rows, long_rows, long_bytes)
    out = short.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(_short(edits), TURNS if edits else SUMMARY)
    if long is None:
        return out
    summary, changed = _long(long, chunk)
    if not edits:
        gone = long.groupBy("conv").agg(F.sum("copies").alias("n")).where("n = 0")
        zero = F.lit(0).cast("long")
        empty = gone.select("conv", *[zero.alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.lit("").alias("audit"),
                            F.sha2(F.lit(""), 256).alias("repaired_sha256"))
        return out.unionByName(summary).unionByName(empty)
    # the position of a long conversation's edit tells its order, not its distance to the next
    position = F.shiftleft("part", 42) + F.shiftleft("chunk", 14) + F.col("at")
    each = changed.withColumn("times", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))))
    return out.unionByName(each.select("conv", position.alias("position"), "edit", "role", "text"))


def _named(out: DataFrame, turns: DataFrame, key: str) -> DataFrame:
    back = F.when(F.col("conv") != " ", F.col("conv")).try_cast(turns.schema[key].dataType)
    return out.select(back.alias(key), *[c for c in out.columns if c != "conv"])


def repair(turns: DataFrame, key: str = "conv_id", long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: its id, faults, cost, audit and the hash of
    the repaired ``role:text`` lines. A column ``copies``, if there, says how
    often a row stands in its place (0: only its conversation counts)."""
    return _named(_run(turns, key, False, long_rows, long_bytes, chunk), turns, key)


def repaired_turns(turns: DataFrame, key: str = "conv_id", long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, chunk: int = CHUNK) -> DataFrame:
    """One row per edit: id, position (in order), edit, role and text; the
    rows that are not deleted are the repaired conversation."""
    return _named(_run(turns, key, True, long_rows, long_bytes, chunk), turns, key)
