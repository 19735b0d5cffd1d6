"""Operator 9: main text of pages by nearest-URL page differencing.

A page's markup becomes text lines, one per block, each with a flag that says
if it lies in an element that the page itself declares as its article
(``article`` or ``main``). Script, style and similar elements, and elements
that are declared as something else (``nav``, ``header``, ``footer``,
``aside``, ``form``, adverts, notices, reader comments by class or id), give
no lines. A class, an id or a form that wraps an article does not count, nor
where nothing else is on the page. Pages are then paired: within a host,
sorted by path, with the nearest page of other lines before or after,
whichever path shares the longer prefix; copies are passed over. The lines of both are aligned
by a longest common subsequence, and a page's lines in it are deleted as
template. Every page is differenced; then the declared article is an exact
check on the result: two articles may well share a sentence, so deleted lines
that lie in one come back. Of the other lines of such a page, those between
its first and its last article line stay if differencing left them; those
before and after are the page's frame.

Neighbours are found on (host, path) rows alone, dealt out by range, so a
hot host is spread over many tasks; only line hashes travel to the
neighbour. Texts are not staged: pages are parsed once for the hashes and
once for the text, by when the lines to delete are known. Pages meet those by
a digest of id, URL and markup, so nothing hangs on how a scan is split.

Defined cases: null or empty markup gives an
empty text; a null URL belongs to an empty host with an empty path; equal
paths are ordered by page id, then digest; pages without a neighbour lose no
lines; repeated rows are extracted one by one; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged
from .url_filter import host, path

# Elements without a closing tag, elements that are never text,
# elements that hold no main text, elements that begin and end a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math xmp noembed noframes".split())
ASIDE = frozenset("nav header footer aside form dialog menu button select head object canvas audio video".split())
MAIN = frozenset(("article", "main"))
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split())
NAMED = re.compile(
    r"(?:^|[\s_-])(?<!\bhas[_-])(?<!\bno[_-])(?<!\bnot[_-])(?<!\bwith[_-])(?<!\bwithout[_-])(?:ad|ads|advert|adverts|advertisement|adverti[sz]ing|sponsor|sponsored|promo|banner|cookie|cookies|consent|notice|"
    r"notices|alert|popup|modal|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|header|footer|comment|comments|"
    r"reply|replies|disqus|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|widget|toolbar|pagination|"
    r"pager)(?:$|[\s_-]|\d)", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAME = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW}


def _named(attributes: str) -> bool:
    return any(m[1].lower() != "role" and NAMED.search(m[2] or m[3] or m[4] or "") for m in _NAME.finditer(attributes))


def _declared_other(tag: str, attributes: str) -> int:
    """2: holds no main text; 1: so by its class, its id or as a form, which
    may as well wrap the page; 0: nothing declared."""
    if tag in ASIDE and tag != "form":
        return 2
    if tag in ("html", "body") or tag in MAIN:
        return 0
    if attributes and (_HIDDEN.search(attributes) or any(
            m[1].lower() == "role" and (m[2] or m[3] or m[4] or "").lower() in ROLES for m in _NAME.finditer(attributes))):
        return 2
    return int(tag == "form" or _named(attributes))


def lines_of(html: str) -> list[tuple[str, bool]]:
    """(text, in a declared article) of each block with text, in page order.
    Where all text lies in forms and containers so named, it counts."""
    return _lines(html, 1) or _lines(html, 2)


def _lines(html: str, least: int) -> list[tuple[str, bool]]:
    out: list[tuple[str, bool]] = []
    open_tags: list[tuple[str, int, bool]] = []  # tag, skipped (by what, if from least on), in an article
    held: list[str] = []
    skipped, article = 0, False

    def close():
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, article))

    at = 0
    while True:
        m = _MARKUP.search(html, at)
        if not skipped:
            held.append(html[at:m.start() if m else len(html)])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            close()
        if m[1]:
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == tag:
                    del open_tags[k:]
                    now = open_tags[-1][1:] if open_tags else (0, False)
                    if now != (skipped, article):
                        close()
                    skipped, article = now
                    break
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in VOID or m[3].endswith("/"):
            continue
        other = _declared_other(tag, m[3])
        inside = max(skipped, other if other >= least else 0)
        if inside == 1 and tag in MAIN and not _named(m[3]):
            inside = 0  # what wraps an article is not what it was named after
        if tag in BLOCK or inside != skipped:
            close()
        open_tags.append((tag, inside, article or tag in MAIN))
        skipped, article = open_tags[-1][1:]
    close()
    return out


def _reach(a: list[int], b: list[int]) -> list[int]:
    """The length of a longest common subsequence of ``a`` and each prefix
    of ``b``: a row of the table as the bits of one number."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        if at := places.get(x):
            row = (row + (row & at) | row & ~at) & full
    out, n = [0], 0
    for bit in reversed(bin(row)[2:].zfill(len(b))) if b else "":
        n += bit == "0"
        out.append(n)
    return out


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Positions of ``a`` in a longest common subsequence of both: equal ends
    are taken off, lines that the other has not are left out, and the rest is
    halved where both halves' lengths add up to most. Memory is linear; the
    steps are lines of one times 64th parts of the other."""
    found: set[int] = set()
    todo = [([(x, i) for i, x in enumerate(a)], list(b))]
    while todo:
        left, right = todo.pop()
        there, here = set(right), {x for x, _ in left}
        left, right = [p for p in left if p[0] in there], [x for x in right if x in here]
        n = 0
        while n < min(len(left), len(right)) and left[n][0] == right[n]:
            found.add(left[n][1])
            n += 1
        left, right = left[n:], right[n:]
        n = 0
        while n < min(len(left), len(right)) and left[-1 - n][0] == right[-1 - n]:
            found.add(left[-1 - n][1])
            n += 1
        left, right = left[:len(left) - n], right[:len(right) - n]
        if not left or not right:
            continue
        if len(left) == 1:
            found.update(i for x, i in left if x in right)
            continue
        half = len(left) // 2
        lines = [x for x, _ in left]
        before, after = _reach(lines[:half], right), _reach(lines[half:][::-1], right[::-1])
        cut = max(range(len(right) + 1), key=lambda j: before[j] + after[len(right) - j])
        todo += [(left[:half], right[:cut]), (left[half:], right[cut:])]
    return found


def _hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html"):
        pages = [lines_of(html.as_py()) for html in b.column("html")]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row", "page_id", "host", "path")),
                                          pa.array([[_hash(x) for x, _ in lines] for lines in pages], pa.list_(pa.int64())),
                                          pa.array([[m for _, m in lines] for lines in pages], pa.list_(pa.bool_()))],
                                         names=["row", "page_id", "host", "path", "hashes", "main"])


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of the lines to delete, those in a declared article
    restored."""
    for b in batches:
        gone = [[i for i in sorted(common_lines(own, near)) if not main[i]]
                for own, main, near in zip(*(b.column(c).to_pylist() for c in ("hashes", "main", "near")), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(gone, pa.list_(pa.int32()))], names=["row", "gone"])


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html"):
        texts = []
        for html, gone in zip(b.column("html"), b.column("gone").to_pylist(), strict=True):
            lines = lines_of(html.as_py())
            article = [i for i, (_, m) in enumerate(lines) if m]
            first, last = (article[0], article[-1]) if article else (0, len(lines))
            drop = set(gone or ())
            texts.append("\n\n".join(x for i, (x, _) in enumerate(lines) if first <= i <= last and i not in drop))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("page_id", "url")), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def neighbours(rows: DataFrame) -> DataFrame:
    """(row, neighbour): for each row the nearest one before or after it in
    the order of its host's paths, whichever path shares the longer prefix
    (the one before, of equals). rows: row, host, path, page_id, and content
    if rows of equal content are to be passed over (never null)."""
    rows = rows if "content" in rows.columns else rows.withColumn("content", F.col("row"))
    dealt = rows.repartitionByRange("host", "path", "page_id", "row").withColumn("part", F.spark_partition_id())
    dealt = staged(dealt, "html-order")
    names = ("host", "path", "page_id", "row")
    item = F.struct(*names, "content")

    def passed(line) -> Column:
        """The last item before this one that differs from it."""
        before = F.lag(item).over(line)
        return F.when(before["content"] != F.col("content"), before)

    back = Window.partitionBy("part").orderBy(*[F.col(c).asc() for c in names])
    ahead = Window.partitionBy("part").orderBy(*[F.col(c).desc() for c in names])
    so_far = lambda line: line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = dealt.select("*", passed(back).alias("prev"), passed(ahead).alias("next"))
    out = out.select("part", *names, "content", F.last("prev", ignorenulls=True).over(so_far(back)).alias("prev"),
                     F.last("next", ignorenulls=True).over(so_far(ahead)).alias("next"))
    # of each range one row: its first and last page and those nearest to them that differ, to meet the other ranges
    edges = out.groupBy("part").agg(F.min(item).alias("first"), F.max(item).alias("last"),
                                    F.min_by("next", item).alias("second"), F.max_by("prev", item).alias("last_but"))

    def nearest(near: str, far: str, order) -> tuple[Column, Column]:
        """Of the ranges on one side: their nearest page, and the page nearest
        to that one that differs from it, if it meets this range's edge."""
        other = F.lag(near).over(order)
        return other, F.coalesce(F.col(far), F.when(other["content"] != F.col(near)["content"], other))

    # a range without a second content hands on what the one before it met: two fields a range, no list of ranges
    ahead_of, after_it = Window.orderBy("part"), Window.orderBy(F.desc("part"))
    x, d = nearest("last", "last_but", ahead_of)
    y, e = nearest("first", "second", after_it)
    edges = edges.select("*", x.alias("x"), d.alias("d"), y.alias("y"), e.alias("e"))
    gone_by = lambda order: order.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select("part", "x", "y", "first", "last", F.last("d", ignorenulls=True).over(gone_by(ahead_of)).alias("d"),
                         F.last("e", ignorenulls=True).over(gone_by(after_it)).alias("e"))
    differs = lambda near, own, far: F.when(F.col(near)["content"] != F.col(own)["content"], F.col(near)).otherwise(F.col(far))
    edges = edges.select("part", differs("x", "first", "d").alias("before"), differs("y", "last", "e").alias("after"))
    out = out.join(edges, "part")
    same = lambda x: F.when(x["host"] == F.col("host"), x)
    out = out.select("row", "path", same(F.coalesce("prev", "before")).alias("prev"), same(F.coalesce("next", "after")).alias("next"))

    def shared(other):
        n = F.least(F.length("path"), F.length(other["path"]))
        return F.coalesce(F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: (k <= n) & (
            F.substring(F.col("path"), F.lit(1), k) == F.substring(other["path"], F.lit(1), k)))), F.lit(0))

    nearer = F.when(F.col("next").isNull() | (F.col("prev").isNotNull() & (shared(F.col("prev")) >= shared(F.col("next")))), F.col("prev")).otherwise(F.col("next"))
    return out.select("row", nearer["row"].alias("neighbour")).where("neighbour is not null")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"))
    known = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("page_id", "url", "html")]
    rows = rows.withColumn("row", F.md5(F.concat_ws("\n", *known)))
    parsed = rows.select("row", "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "html").mapInArrow(
        _parse, "row string, page_id long, host string, path string, hashes array<long>, main array<boolean>")
    parsed = staged(parsed.dropDuplicates(["row"]), "html-lines")  # equal rows have equal texts
    pairs = neighbours(parsed.select("row", "host", "path", "page_id", F.xxhash64("hashes").alias("content")))
    near = parsed.select(F.col("row").alias("neighbour"), F.col("hashes").alias("near"))
    both = pairs.join(near, "neighbour").select("row", "near").join(parsed.select("row", "hashes", "main"), "row")
    gone = staged(both.mapInArrow(_difference, "row string, gone array<int>").where(F.size("gone") > 0), "html-template")
    return rows.join(gone, "row", "left").select("page_id", "url", "html", "gone").mapInArrow(_text, "page_id long, url string, text string")
