import re

import pytest

from keepwell.llm import urls

ODD = [
    None, "", "no scheme", "http://", "://", "http://a.NET", "http://a.NET/", "HTTPS://WWW.Example.COM/de/x?y#z", "https://example.net/en/1",
    "https://sub.example.net/en/", "https://notexample.net/en/", "http://org/fr/", "http://x.org/fr", "http://x.org/fr/2//", "http://x.org/FR/2",
    "a://b://c/d", "http://h?q=/en/", "http://h#/en/", "http://Ünï.ORG/fr/é", "http://casino-win.com/a", "http://www.casino-win.com/a/", "x\n://y.net/\n/z",
    "http://.net/", "http://net/", "http://example.com/de/",
]


def brute(url, listed, rules=urls.RULES):
    url = url or ""
    at = url.find("://")
    host = path = ""
    if at >= 0:
        host = re.sub("[A-Z]", lambda m: m.group().lower(), re.split(r"[/?#]", url[at + 3 :])[0])
        path = re.split(r"[?#]", url[at + 3 + len(host) :])[0]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)
    address = (host.removeprefix("www.") + path.rstrip("/")) if host else None
    verdict = best.verdict if best else "block" if address in listed else "allow"
    return host, path, best.text if best else None, verdict


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(i, u, "x", True, "n", 1) for i, u in enumerate([*ODD, ODD[7]])]
    rows.append((None, ODD[19], None, None, None, None))
    return spark.createDataFrame(rows, "page_id long, url string, host string, possible boolean, entry string, _block long")


def entries(spark, found):
    return spark.createDataFrame([(e,) for e in found], "entry string")


def plain(df):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)


LISTED = ["casino-win.com/a", "casino-win.com/a", None, "notexample.net/en", "elsewhere.com", "h"]


@pytest.mark.parametrize("blocks", [1, 1 << 18])
def test_odd_urls(spark, odd_pages, blocks):
    """A filter of one block lets much through; the join decides."""
    got = plain(urls.judge(odd_pages, entries(spark, LISTED), most_blocks=blocks))
    want = sorted(((r.page_id, *brute(r.url, set(LISTED) - {None})) for r in odd_pages.collect()), key=str)
    assert got == want


def test_all_pages_equal_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    listed = urls.named_bad(pages)
    want = {r.entry for r in listed.collect()}
    bad = re.compile(r"(^|[.-])(%s)([.-]|$)" % "|".join(urls.LISTED_PARTS))
    assert want == {h.removeprefix("www.") + p.rstrip("/") for h, p, *_ in (brute(r.url, ()) for r in pages.collect()) if bad.search(h)}
    got = plain(urls.judge(pages, listed))
    assert got == sorted(((r.page_id, *brute(r.url, want)) for r in pages.collect()), key=str)


def test_filter_lets_every_entry_and_few_others_through(spark):
    rows = spark.range(20000).selectExpr("id AS page_id", "concat('http://h', id, '.com/p') AS url")
    listed = spark.range(2000).selectExpr("concat('h', id * 10, '.com/p') AS entry")
    found = urls.judge(rows, listed).select("page_id", "possible", "verdict").collect()
    assert {r.page_id for r in found if r.verdict == "block"} == set(range(0, 20000, 10))
    assert all(r.possible for r in found if r.verdict == "block")
    assert sum(r.possible and r.verdict == "allow" for r in found) < 18000 * 0.02
    assert urls.bloom_filter(listed, "entry", urls.filter_blocks(2000)).count() <= urls.filter_blocks(2000) == 125
    assert urls.filter_blocks(0) == 1 and urls.filter_blocks(10**12) == urls.MOST_BLOCKS


def test_empty_list_and_empty_table(spark, odd_pages):
    assert {r.verdict for r in urls.judge(odd_pages, entries(spark, []), rules=[]).collect()} == {"allow"}
    assert urls.judge(odd_pages.limit(0), entries(spark, LISTED)).collect() == []


def test_plan_is_native(spark, odd_pages):
    plan = urls.judge(odd_pages, entries(spark, LISTED))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
