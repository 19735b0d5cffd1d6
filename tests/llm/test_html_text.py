from __future__ import annotations

import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm.html_text import common_lines, lines_of, main_text, neighbours

PAGES = "page_id long, url string, html string"


def texts(html):
    return [t for t, _ in lines_of(html)]


def test_markup_to_lines():
    assert texts("<p>a  <b>b</b>\n c<br>d<p>e &amp; f&nbsp;g &copy &am;</p>") == ["a b c", "d", "e & f g © &am;"]
    assert texts("x<script>if (a<b) '</p>'</script>y<style>p{}</style><!-- <p>no --> z") == ["xy z"]
    assert texts("<nav><ul><li>m</ul></nav><div class='ad x'>no<div>no</div></div><p>yes<aside>no</aside>more") == ["yes", "more"]
    assert texts('<div id="comments"><p>no</div><section role="navigation">no</section><p hidden>no</p><div class="adapter headerless">yes</div>') == ["yes"]
    assert texts("<p title='a>b'>t</p") == ["t"] and texts("") == [] and texts("a < b <3 >") == ["a < b <3 >"]
    assert texts("<form>no</form><p>1<p>2</p></div></p>3") == ["1", "2", "3"]
    assert lines_of("<p>o</p><article><h1>t</h1><header>no</header><p>a</article><p>z") == [("o", False), ("t", True), ("a", True), ("z", False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_common_lines_are_a_longest_common_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    found = sorted(common_lines(a, b))
    assert len(found) == best[-1][-1]
    it = iter(b)
    assert all(any(a[i] == x for x in it) for i in found)


def test_many_equal_lines_are_aligned_in_time():
    """Tables of equal cells: every pair of lines matches, or every second."""
    start = time.monotonic()
    assert len(common_lines([1] * 20_000, [1] * 15_000)) == 15_000
    assert len(common_lines([1, 2] * 5_000, [2, 3, 1] * 4_000)) >= 5_333
    assert len(common_lines([7, *range(20_000)], [*range(20_000), 7])) == 20_000
    assert time.monotonic() - start < 60


def test_copies_over_many_ranges_are_passed_over(spark):
    rows = [(i, "h", f"/{i:04d}", i, 0 if 20 <= i < 180 else i // 7) for i in range(200)]
    df = spark.createDataFrame(rows, "row long, host string, path string, page_id long, content long")

    def nearest(i, step):
        j = i + step
        while 0 <= j < len(rows) and rows[j][4] == rows[i][4]:
            j += step
        return j if 0 <= j < len(rows) else None

    def prefix(i, j):
        n = 0
        while n < 5 and rows[i][2][n] == rows[j][2][n]:
            n += 1
        return n
    want = {}
    for i in range(200):
        near = [j for j in (nearest(i, -1), nearest(i, 1)) if j is not None]
        want[i] = max(near, key=lambda j: prefix(i, j))
    for n in ("1", "3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert {r.row: r.neighbour for r in neighbours(df).collect()} == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_shared_lines_go_unless_the_article_is_declared(spark):
    def page(i, p, body):
        return i, f"http://h.net/{p}", body
    rows = [page(1, "a/1", "<p>Site name</p><p>one</p><p>Imprint</p>"), page(2, "a/2", "<p>Site name</p><p>two</p><p>Imprint</p>"),
            page(3, "b/1", "<p>Top</p><article><p>licence</p><p>x</p></article><p>Imprint</p>"), page(4, "b/2", "<article><p>licence</p><p>y</p></article>"),
            (5, "http://other.net/a/1", "<p>Site name</p><p>five</p>"), (6, None, None), (7, "http://h.net/z", ""), (7, "http://h.net/z", "<p>twice</p>")]
    docs = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(c) for c in ("row", "host", "path", "lines", "near", "part")})
    got = sorted((r.page_id, r.url, r.text) for r in main_text(docs).collect() if r.url)
    assert [(i, t) for i, _, t in got] == [(1, "one"), (2, "two"), (3, "licence\n\nx"), (4, "licence\n\ny"), (5, "Site name\n\nfive"), (7, ""), (7, "twice")]


def test_differencing_decides_lines_of_pages_that_declare_articles(spark):
    rows = [(1, "http://h.net/a/1", "<article>one</article><p>Next story</p><p>own</p><article>licence</article><p>z</p>"),
            (2, "http://h.net/a/2", "<p>top</p><article>two</article><p>Next story</p><article>licence</article>")]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: "one\n\nown\n\nlicence", 2: "two\n\nlicence"}


def test_copies_do_not_delete_each_other(spark):
    a, b = "<p>Site</p><p>one</p><p>Imprint</p>", "<p>Site</p><p>two</p><p>Imprint</p>"
    rows = [(i, f"http{'s' * (i % 2)}://h.net/a/1?utm_source={i}", a) for i in range(40)] + [(50, "http://h.net/a/2", b), (51, "http://h.net/a/3", b)]
    rows += [(60 + i, "http://copies.net/x", a) for i in range(3)]
    for n in ("2", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        whole = "Site\n\none\n\nImprint"
        assert got == {**dict.fromkeys(range(40), "one"), 50: "two", 51: "two", **{60 + i: whole for i in range(3)}}


def test_wrappers_do_not_hide_the_page():
    for tag in ('<div class="layout has-sidebar">', '<div class="no-comments">', "<form action=x>", '<div id="sidebar"><form>', '<div class="widget">'):
        assert texts(f"<p>menu</p>{tag}<article><p>text</article>")[-1] == "text"
        assert texts(f"{tag}<p>text") == ["text"]
    assert texts('<div class="has-sidebar">a</div><div class="no_ads">b</div><div class="with-ad ad">c</div>') == ["a", "b"]
    assert texts("<aside><article>no</article></aside><div hidden><main>no</main></div>x") == ["x"]
    assert texts('x<div class="comments"><article class="comment">no</article></div>') == ["x"]


def test_neighbours_are_the_nearest_paths_whatever_the_partitions(spark):
    rows = [(i, "h" if i < 90 else "g", f"/en/{i * 37 % 200}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "row long, host string, path string, page_id long")
    order = sorted(rows, key=lambda r: (r[1], r[2], r[3]))

    def prefix(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    want = {}
    for k, r in enumerate(order):
        near = [order[j] for j in (k - 1, k + 1) if 0 <= j < len(order) and order[j][1] == r[1]]
        want[r[0]] = max(near, key=lambda x: prefix(r[2], x[2]))[0]
    for n in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert {r.row: r.neighbour for r in neighbours(df).collect()} == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_long_page_and_empty_table(spark):
    long = "<article>" + "".join(f"<p>word {i} &lt;{'x' * 50}" for i in range(20_000)) + "</article>"
    got = main_text(spark.createDataFrame([(1, "http://h/a", long), (2, "http://h/b", long)], PAGES)).collect()
    assert all(r.text.count("\n\n") == 19_999 for r in got)
    assert main_text(spark.createDataFrame([], PAGES)).collect() == []
