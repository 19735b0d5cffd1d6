"""Operator 1: URL filter with a blocked Bloom filter before an exact join.

``judge`` decides each URL by rules first and else by a list of canonical
URLs. The listed URLs become a blocked Bloom filter: a table of blocks of 256
bits (four longs), 8 bits of one block per URL, about 16 bits of room each.
A URL is looked up by an equi-join on the block number, so the filter is
broadcast only when Spark has measured it as small and is dealt out by block
otherwise. URLs whose bits are all set, listed ones and about one in a
thousand others, then go through an exact join on the canonical text, which
removes the false positives. All other rows never meet the list.

Both joins are plain equi-joins against one row per block or URL, so Spark
splits a hot block or URL on the side of the pages.

Rules are (host, path, verdict): a rule fits its host and all subdomains if
the path starts with the rule's; the longest host and path wins, the earlier
of equals. They are a short list given by the caller.

``pages`` must be a plain scan. Defined cases: a null URL or one without
``://`` has an empty host and path, fits no rule and is never listed; equal
URLs are judged alike; null and repeated entries of the list count as none
and one; an empty list allows all; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, with_row_id

BITS_PER_URL = 16
_PROBES = 8



def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in
    lower case."""
    after = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host_: Column, path_: Column) -> Column:
    """One form for the spellings of a page: no scheme, ``www.`` or ``m.``,
    query, fragment, closing slash or ``.html``; null without a host."""
    short = F.regexp_replace(host_, r"^(www|m)\.", "")
    return F.when(host_ != "", F.concat(short, F.regexp_replace(path_, r"(/index)?(\.html?)?/*$", "")))


def rule_of(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(host and path of the rule that fits, its verdict); null without one."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):  # the last that fits is the longest
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _masks(url: Column) -> list[Column]:
    """The four longs of a URL's bits within its block."""
    h = F.xxhash64(url, F.lit(17))
    bits = [F.shiftrightunsigned(h, 8 * k).bitwiseAND(F.lit(255)) for k in range(_PROBES)]
    one = F.lit(1).cast("long")

    def word(w: int) -> Column:
        parts = [F.when(F.shiftright(b, 6) == w, F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long")) for b in bits]
        out = parts[0]
        for p in parts[1:]:
            out = out.bitwiseOR(p)
        return out
    return [word(w) for w in range(4)]


def _with_bits(rows: DataFrame, blocks: int) -> DataFrame:
    masks = _masks(F.col("url"))
    return rows.withColumns({"block": F.pmod(F.xxhash64("url"), F.lit(blocks)), **{f"m{w}": m for w, m in enumerate(masks)}})


def blocked_bloom(listed: DataFrame, urls: int, bits_per_url: int = BITS_PER_URL) -> tuple[DataFrame, int]:
    """(block, w0..w3) for the column ``url`` of ``listed``, and the number
    of blocks for so many urls."""
    blocks = max(1, -(-urls * bits_per_url // 256))
    rows = _with_bits(listed, blocks)
    return rows.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(4)]), blocks


def possible_hits(rows: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows whose ``url`` may be listed; all that are listed are among
    them."""
    probe = _with_bits(rows.where("url is not null"), blocks).join(bloom, "block")
    every = F.lit(True)
    for w in range(4):
        every = every & (F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    return probe.where(every).select(*rows.columns)


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = (), key: str = "page_id",
          url: str = "url") -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule, verdict, listed.
    listed: canonical URLs in a column ``url``. A rule's verdict is its own;
    else a listed URL is blocked and any other allowed."""
    rows = with_row_id(pages, "row").select("row", F.col(key).alias("key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    # staged with their numbers, so that both readings below see the same ones
    rows = staged(rows.withColumns({"rule": name, "given": verdict, "url": canonical(F.col("host"), F.col("path"))}), "url-rows")
    listed = listed.select("url").where("url is not null").distinct()
    bloom, blocks = blocked_bloom(listed, listed.count())
    maybe = possible_hits(rows.select("row", "url"), bloom, blocks)
    hits = maybe.join(listed, "url", "left_semi").select(F.col("row").alias("hit"))
    out = rows.join(hits, F.col("row") == F.col("hit"), "left")
    found = F.col("hit").isNotNull()
    return out.select(F.col("key").alias(key), "host", "path", "rule",
                      F.coalesce("given", F.when(found, "block").otherwise("allow")).alias("verdict"), found.alias("listed"))
