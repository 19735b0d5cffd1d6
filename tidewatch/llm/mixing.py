"""Operator 4: mixing sources to target weights by Pfair scheduling
(DataFrame functions only).

A source's documents, in a fixed pseudo-random order, are cut into blocks of
``BLOCK_CHARS`` characters; a document belongs to the block in which it
begins. Target weights: each source's share of all blocks, but no source
more than ``MOST_SHARE`` of the mix; what a source has beyond its quota stays
outside the mix (``in_mix`` false) and is still scheduled after it.

A source's weight is exact, ``quota / mix`` in blocks. Block b (from 0) of a
source with weight w is released at ``floor(b / w)`` and due at
``ceil((b + 1) / w)``, in whole numbers without rounding; in each slot the
released block with the earliest deadline runs (the first source of equals).
As the weights add up to one, every block runs within its window, so at any
slot t a source has run less than one block more or less than ``w t``,
however long the mix. The mix is one period; the surplus goes on in further
ones. Sources under 1 in ``PERIOD`` of the mix share lanes by hash: the lane is
scheduled by its members' weights, and its blocks are dealt to the members by
the same rule, so a member with the share s of its lane deviates by less than
``1 + s`` blocks from its own target.

A plan has one row per block, not per document, and is made ``SPAN`` slots at
a time, each span going on from the state that the one before has written.

``docs`` must be a plain scan. Defined cases: a null source is a source of
its own; a null or empty text counts one character; ties in the order go to
the smaller key (null first), then the earlier row; repeated rows are
scheduled one by one; an empty table gives no rows; extra columns pass
through :func:`mixed` and :func:`interleaved` under any name.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, with_row_id

BLOCK_CHARS = 1 << 16
MOST_SHARE = 0.25
PERIOD = 1024
POOLS = 64
#: Slots that one row plans, and steps of it between which results are put together.
SPAN = 1 << 16
STEPS = 256
#: Documents that one ordered run holds, on average.
RUN_ROWS = 4096


def quota_limit(largest: list[int], total: int, sources: int, most_share: float) -> int:
    """Blocks that a source may bring so that none exceeds most_share of the
    mix (two shares of an equal mix, where sources are few). largest: the
    most blocks of any sources, descending, as many as
    could exceed it."""
    share = max(most_share, 2 / max(sources, 1))
    rest = total
    for k, blocks in enumerate(largest):
        left = 1 - k * share
        if left <= 1e-9 or blocks <= share * rest / left:
            break
        rest -= blocks
    else:
        k = len(largest)
    left = 1 - k * share
    if k == 0:
        return total
    return max(1, math.floor(share * rest / left + 1e-9)) if left > 1e-9 and rest else largest[-1] if sources > k else min(largest)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _release(nth: Column, slots: Column, period: Column) -> Column:
    return _div(nth * period, slots)


def _due(nth: Column, slots: Column, period: Column) -> Column:
    return _div((nth + 1) * period + slots - 1, slots)


def _span(state: DataFrame, start: int, span: int) -> DataFrame:
    """state (pool, lanes, period, ran) after the slots from start on, and
    what ran in them."""
    def pick(acc: Column, t: Column) -> Column:
        def window(lane: Column, i: Column) -> Column:
            ran = F.get(acc["ran"], i)
            due = _due(ran, lane["slots"], F.col("period"))
            return F.when(_release(ran, lane["slots"], F.col("period")) <= t, F.struct(due.alias("due"), i.alias("i"), ran.alias("nth")))
        return F.array_min(F.transform(F.col("lanes"), window))

    def step(acc: Column, t: Column) -> Column:
        chosen = F.transform(F.array(pick(acc, t)), lambda c: F.struct(
            F.transform(acc["ran"], lambda n, i: F.when(i == c["i"], n + 1).otherwise(n)).alias("ran"),
            F.concat(acc["out"], F.array(F.struct(t.alias("slot"), c["i"].alias("i"), c["nth"].alias("nth")))).alias("out")))
        return F.element_at(chosen, 1)

    end = F.least("period", F.lit(start + span).cast("long"))
    none = F.array().cast("array<struct<slot:bigint,i:int,nth:bigint>>")

    def steps(acc: Column, first: Column) -> Column:
        inner = F.aggregate(F.sequence(first, F.least(first + STEPS, end) - 1), F.struct(acc["ran"].alias("ran"), none.alias("out")), step)
        return F.element_at(F.transform(F.array(inner), lambda x: F.struct(x["ran"].alias("ran"), F.concat(acc["outs"], F.array(x["out"])).alias("outs"))), 1)

    zero = F.struct(F.col("ran"), F.array().cast("array<array<struct<slot:bigint,i:int,nth:bigint>>>").alias("outs"))
    run = F.aggregate(F.sequence(F.lit(start).cast("long"), end - 1, F.lit(STEPS).cast("long")), zero, steps)
    return state.where(F.col("period") > start).select("pool", "lanes", "period", run.alias("run")).select(
        "pool", "lanes", "period", F.col("run.ran").alias("ran"), F.col("run.outs").alias("outs"))


def period_schedule(lanes: DataFrame, span: int = SPAN) -> DataFrame:
    """(lane, nth, slot) of one period, by earliest deadline first; lanes:
    lane, slots, and pool if there are several periods, one per pool (then
    pool is returned too). A period is as long as its slots add up to."""
    pools = "pool" in lanes.columns
    lanes = lanes if pools else lanes.withColumn("pool", F.lit(""))
    state = lanes.where("slots > 0").groupBy("pool").agg(F.sort_array(F.collect_list(F.struct("lane", F.col("slots").cast("long").alias("slots")))).alias("lanes"),
                                                         F.sum("slots").cast("long").alias("period"))
    state = staged(state.withColumn("ran", F.transform("lanes", lambda _: F.lit(0).cast("long"))), "mixing-state")
    longest = state.agg(F.coalesce(F.max("period"), F.lit(0))).first()[0]
    parts = []
    for start in range(0, max(longest, 1), span):
        state = staged(_span(state, start, span), "mixing-state")
        parts.append(state.select("pool", "lanes", F.explode(F.flatten("outs")).alias("x")).select(
            *(["pool"] if pools else []), F.get("lanes", F.col("x.i"))["lane"].alias("lane"), F.col("x.nth").alias("nth"), F.col("x.slot").alias("slot")))
        state = state.drop("outs")
    return reduce(DataFrame.union, parts)


def schedule(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", block_chars: int = BLOCK_CHARS,
             most_share: float = MOST_SHARE) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, source, chars, lane (one per
    source), block (of the lane), release, deadline, slot, place (characters
    of the block before it), in_mix."""
    return _schedule(with_row_id(docs, "row"), text, key, source, block_chars, most_share)


def _schedule(rows: DataFrame, text: str, key: str, source: str, block_chars: int, most_share: float) -> DataFrame:
    rows = rows.select(
        "row", F.col(key).alias("doc_id"), F.col(source).alias("source"), F.greatest(F.coalesce(F.length(text), F.lit(1)), F.lit(1)).cast("long").alias("chars"))
    rows = staged(rows, "mixing-rows")
    named = F.coalesce(F.concat(F.lit("s:"), F.col("source").cast("string")), F.lit("null"))
    rows = rows.withColumn("name", named)
    supply = rows.groupBy("name").agg(F.ceil(F.sum("chars") / block_chars).alias("blocks"), F.count("*").alias("rows"))
    supply = staged(supply, "mixing-sources")
    total, sources, documents = supply.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    largest = supply.orderBy(F.desc("blocks")).limit(math.ceil(1 / most_share)).collect()
    limit = quota_limit([r["blocks"] for r in largest], total, sources, most_share)
    taken = F.least("blocks", F.lit(limit))
    mix = supply.agg(F.coalesce(F.sum(taken), F.lit(0))).first()[0]
    supply = supply.select(F.col("name").alias("lane"), taken.alias("quota"))

    runs = max(1, -(-documents // RUN_ROWS))
    rank = F.xxhash64("doc_id", "name")
    rows = rows.withColumns({"lane": F.col("name"), "rank": rank, "run": F.pmod(rank, F.lit(runs))})
    # the order of a lane: by run, then by rank; offsets by a scan over runs and one within each
    sums = rows.groupBy("lane", "run").agg(F.sum("chars").alias("in_run"))
    before = F.sum("in_run").over(Window.partitionBy("lane").orderBy("run")) - F.col("in_run")
    inner = F.sum("chars").over(Window.partitionBy("lane", "run").orderBy("rank", "doc_id", "row")) - F.col("chars")
    placed = rows.withColumn("inner", inner).join(sums.withColumn("before", before), ["lane", "run"])
    start = F.col("before") + F.col("inner")
    placed = placed.withColumns({"block": F.floor(start / block_chars), "place": F.pmod(start, F.lit(block_chars))})

    plan = _plan(supply, mix)
    out = placed.join(supply, "lane").withColumn("nth", F.pmod("block", "quota"))
    out = out.join(plan, ["lane", "nth"])
    period = F.lit(mix).cast("long")
    return out.select(
        "row", "doc_id", "source", "chars", "lane", "block", _release(F.col("block"), F.col("quota"), period).alias("release"),
        _due(F.col("block"), F.col("quota"), period).alias("deadline"),
        (_div(F.col("block"), F.col("quota")) * period + F.col("slot")).alias("slot"), "place", (F.col("block") < F.col("quota")).alias("in_mix"))


def _plan(supply: DataFrame, mix: int, span: int = SPAN) -> DataFrame:
    """(lane, nth, slot) of the mix; supply: lane, quota."""
    pool = F.concat(F.lit("pool:"), F.pmod(F.xxhash64("lane"), F.lit(POOLS)).cast("string"))
    own = supply.where(F.col("quota") * PERIOD >= mix).select("lane", F.col("quota").alias("slots"))
    small = supply.where(F.col("quota") * PERIOD < mix).select(pool.alias("pool"), "lane", F.col("quota").alias("slots"))
    pools = small.groupBy("pool").agg(F.sum("slots").alias("slots"))
    if not small.take(1):
        return staged(period_schedule(own, span), "mixing-plan")
    # at most PERIOD + POOLS lanes; a lane of many is told by its place in the row, as names may look alike
    top = staged(period_schedule(own.select(F.struct(F.lit(False).alias("shared"), F.col("lane").alias("name")).alias("lane"), "slots").union(
        pools.select(F.struct(F.lit(True).alias("shared"), F.col("pool").alias("name")).alias("lane"), "slots")), span), "mixing-lanes")
    inside = period_schedule(small, span).select("pool", "lane", "nth", F.col("slot").alias("turn"))
    shared = top.where("lane.shared").select(F.col("lane.name").alias("pool"), F.col("nth").alias("turn"), "slot")
    return staged(top.where("not lane.shared").select(F.col("lane.name").alias("lane"), "nth", "slot").union(
        inside.join(shared, ["pool", "turn"]).select("lane", "nth", "slot")), "mixing-plan")


def _numbered(docs: DataFrame, text: str, key: str, source: str, block_chars: int, most_share: float) -> tuple[DataFrame, DataFrame, Column]:
    """(the documents, staged once with their row numbers under inner names,
    the schedule of these rows, the documents' own columns)."""
    plain = [f"c{i}" for i in range(len(docs.columns))]  # inner names, so that no column clashes
    name = dict(zip(docs.columns, plain, strict=True))
    rows = staged(with_row_id(docs.toDF(*plain), "row"), "mixing-documents")
    own = [F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)]
    return rows, _schedule(rows, name[text], name[key], name[source], block_chars, most_share), own


def interleaved(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", block_chars: int = BLOCK_CHARS,
                most_share: float = MOST_SHARE) -> DataFrame:
    """All documents with all their columns, in the order of the schedule:
    dealt by ranges of (slot, place) and sorted within, so that written files
    hold the sources interleaved at their target weights and the surplus
    last in its own later slots."""
    rows, plan, own = _numbered(docs, text, key, source, block_chars, most_share)
    order = ["slot", "place", "row"]
    return rows.join(plan.select(*order), "row").repartitionByRange(*order).sortWithinPartitions(*order).select(*own)


def mixed(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", block_chars: int = BLOCK_CHARS,
          most_share: float = MOST_SHARE) -> DataFrame:
    """The documents of the mix alone, with all their columns."""
    rows, plan, own = _numbered(docs, text, key, source, block_chars, most_share)
    return rows.join(plan.where("in_mix").select("row"), "row", "left_semi").select(*own)
