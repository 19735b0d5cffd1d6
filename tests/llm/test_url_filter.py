from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.queries import URL_RULES
from tidewatch.llm.url_filter import blocked_bloom, canonical, host, judge, path, possible_hits

URLS = [None, "", "no scheme", "http://", "https://Example.ORG/es/1", "http://a.example.org/en/12?x#y", "http://a.example.org/en/2", "http://xexample.org/es/",
        "ftp://COM/fr/", "http://b.com/de/x#/fr/", "http://b.com", "http://b.com?/de/", "http://www.spam.net/p/1.html?q=1", "https://m.spam.net/p/1/", "http://spam.net/p/12",
        "http://u:p@h.net:80/a", "x://y://z/q", "http://É.com/fr/é", "http://\n.org/\n", "http://spam.net/p/1", "http://spam.net/p/1"]


def brute(url, listed):
    m = re.match(r"^.*?://([^/?#]*)([^?#]*)", url or "", re.S)
    h, p = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for rh, rp, v in URL_RULES:
        if (h == rh or h.endswith("." + rh)) and p.startswith(rp) and (best is None or len(rh + rp) > len(best[0])):
            best = (rh + rp, v)
    canon = re.sub(r"^(www|m)\.", "", h) + re.sub(r"(/index)?(\.html?)?/*$", "", p) if h else None
    return h, p, best and best[0], best[1] if best else "block" if canon in listed else "allow"


@pytest.mark.parametrize("listed", [[], ["spam.net/p/1", "spam.net/p/1", None, "z"], [f"h{i}.net/x" for i in range(3000)] + ["spam.net/p/1"]])
def test_verdicts_match_brute_force(spark, listed):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumns(
        {c: F.lit(c) for c in ("row", "host", "path", "rule", "block", "m0", "key")})
    got = judge(pages, spark.createDataFrame([(x,) for x in listed], "url string"), URL_RULES).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == [
        (i, *brute(u, set(listed) - {None})) for i, u in enumerate(URLS)]


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(5000).select(F.concat(F.lit("host/"), "id").alias("url"))
    bloom, blocks = blocked_bloom(listed, 5000)
    assert possible_hits(listed, bloom, blocks).count() == 5000
    others = spark.range(20_000).select(F.concat(F.lit("other/"), "id").alias("url"))
    assert possible_hits(others, bloom, blocks).count() < 200


def test_spellings_of_a_page_share_a_canonical_form(spark):
    urls = ["http://www.a.net/x/", "https://A.net/x.html?q", "ftp://m.a.net/x#f", "http://a.net/x/index.html"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r[0] for r in df.select(canonical(host(F.col("u")), path(F.col("u")))).collect()} == {"a.net/x"}


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([("x",)], "url string"), URL_RULES).collect() == []
