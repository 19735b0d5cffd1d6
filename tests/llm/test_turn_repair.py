from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from tests.conftest import SF001
from tidewatch.llm.turn_alignment import align
from tidewatch.llm.turn_repair import damage, repair, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain_audit(symbols: str) -> tuple[int, str]:
    """All of the grammar's places at once, from the last turn to the first,
    with whole audits."""
    nexts = ((0, 2), (1, 2), (2, 3), (3, 2))

    def inserts(best):
        for _ in range(4):
            for p, q in nexts:
                if best[q] and (not best[p] or (best[q][0] + 2, "I" + best[q][1]) < best[p]):
                    best[p] = (best[q][0] + 2, "I" + best[q][1])
        return best

    best = inserts({0: (0, ""), 1: None, 2: None, 3: (0, "")})
    for c in reversed(symbols):
        new = {}
        for p, q in nexts:
            options = [(best[p][0] + 3, "D" + best[p][1])] if best[p] else []
            if c != "x":
                fits = c.lower() == ("a" if p == 2 else "u")
                options.append((best[q][0] + 2 * (not fits) + c.isupper(), "RK"[fits] + best[q][1]))
                if p == 0 and c in "sS":
                    options.append((best[1][0] + c.isupper(), "K" + best[1][1]))
            new[p] = min(options)
        best = inserts(new)
    return best[0]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text("suaoSUAOx", max_size=14), st.text("uaUAx", max_size=40), st.text("sx", max_size=8)), st.sampled_from([1, 2, 3, 7, 64]))
def test_audits_are_the_least_of_the_cheapest(symbols, chunk):
    assert align(symbols, chunk) == plain_audit(symbols)


def plain(rows: list[tuple], harm: bool) -> dict:
    """The contract, row by row."""
    out, convs = {}, {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if harm else 9
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({46: None, 33: None, 63: None})
        if kind == 4:
            role = "user"
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts, seen, symbols = [0, 0, 0], set(), ""
        for _, role, text in mine:
            fault = 0 if not text.strip(SPACE) else 1 if (role, text) in seen else 2 if text.rstrip(SPACE)[-1] not in ".!?" else 3
            seen.add((role, text))
            counts = [n + (k == fault) for k, n in enumerate(counts)]
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault < 2 else letter.upper() if fault == 2 else letter
        cost, audit = plain_audit(symbols)
        lines, i = [], 0
        for e in audit:
            after = [x[0] for x in lines]
            if e != "D":
                role = mine[i][1] if e == "K" else "assistant" if after and after[-1] == "u" else "user"
                lines.append(f"{role}:{'' if e == 'I' else mine[i][2]}")
            i += e != "I"
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:], strict=False)]
        turns = {r[0] for r in mine if r[0] is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out


def hard() -> list[tuple]:
    rng = random.Random(3)
    texts = ["Yes.", "No!", "Why? \n", "and then", "", " \t", None, "é \x85.", "é  ", "x" * 200_000 + "."]
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (-5, 3, "tool", "T."), (-5, 4, "", "T."), (7, None, "user", "a."), (7, None, "assistant", "b."),
            (8, 0, "user", "q?"), (8, 0, "user", "q?"), (8, 0, "user", "q?"), (8, 9, "assistant", "q?")]
    for conv in range(20, 60):
        for k in range(rng.choice([1, 2, 3, 5, 9, 24])):
            rows.append((conv, rng.choice([k, k, k, k // 2, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "usher", None, "other"]), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("harm", [False, True])
@pytest.mark.parametrize("long_rows", [4096, 4, 0])
def test_conversations_match_the_contract(spark, harm, long_rows):
    from pyspark.sql import functions as F

    rows = hard()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(c) for c in ("conv", "place", "part", "chunk", "edit")})
    turns = damage(turns) if harm else turns
    want = plain(rows, harm)
    got = {r.conv_id: tuple(r)[1:] for r in repair(turns, long_rows=long_rows, chunk=3).collect()}
    assert got == {k: v[:-1] for k, v in want.items()}


@pytest.mark.parametrize("long_rows", [4096, 4])
def test_turns_are_those_of_the_hash(spark, long_rows):
    rows = hard()
    want = plain(rows, False)
    lines: dict = {}
    for r in sorted(repaired_turns(spark.createDataFrame(rows, SCHEMA), long_rows=long_rows, chunk=3).collect(), key=lambda r: r.position):
        lines.setdefault(r.conv_id, [])
        if r.edit != "D":
            lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert lines == {k: v[-1] for k, v in want.items()}


def test_a_third_of_all_rows_alike_meet_no_task(spark):
    """Equal rows of a long conversation are one row with a number."""
    rows = [(1, 0, "user", "Hi.")] * 3000 + [(1, 1, "assistant", "Yes.")]
    got = repair(spark.createDataFrame(rows, SCHEMA), long_rows=100).first()
    assert (got.duplicate, got.illegal, got.cost, got.audit) == (2999, 2999, 3 * 2999, "K" + "D" * 2999 + "K")


def test_empty_table(spark):
    assert repair(spark.createDataFrame([], SCHEMA)).collect() == [] and repair(spark.createDataFrame([], SCHEMA), long_rows=0).collect() == []


def test_query_matches_the_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in E.queries()["op11_turn_repair"](spark, SF001).collect()}
    assert got == {k: v[:-1] for k, v in plain(rows, True).items()}
