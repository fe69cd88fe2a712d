import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from keepwell.llm import divergence

PATTERN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in PATTERN.findall(text or "")]


def brute(rows, least, terms):
    """(lang, source, part, item, value, rank) from whole counts of every group and term."""
    docs, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = Counter(words(text))
        held[lang, source] += found
        docs[lang] += Counter(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1000000000 * (count[t] + 2) // (total + 2 * v) for t in kept}

        whole = shares(sum((held[lang, s] for s in sources), Counter()))
        p = {s: shares(held[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in sources if o != s]
            own = [((p[s][t] - whole[t]) ** 2 // (p[s][t] + whole[t]), t) for t in kept if held[lang, s][t] and p[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def plain(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def some(documents):
    return documents.filter("doc_id < 60").select("lang", "source", "text")


@pytest.fixture(scope="module")
def expected(some):
    return brute([tuple(r) for r in some.collect()], 2, 5)


def test_equals_brute_force(some, expected):
    assert plain(divergence.audit(some, least=2, terms=5)) == expected and len(expected) > 100


def test_colliding_digests_are_split(some, expected):
    """Digests of six bits stand for many terms each."""
    tallied = divergence.tally(some, "lang", "source", "text", bits=6)
    met = divergence.collisions(tallied).collect()
    assert len(met) == 64 and all(r.least < r.most for r in met)
    assert plain(divergence.audit(some, least=2, terms=5, bits=6)) == expected


def test_partitions_do_not_matter(some, expected, monkeypatch):
    monkeypatch.setattr(divergence, "TALLY_BYTES", 500)
    assert plain(divergence.audit(some.repartition(5, "source"), least=2, terms=5)) == expected


def test_odd_input(odd_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    assert plain(divergence.audit(odd_docs, least=1, terms=3)) == brute(rows, 1, 3)


def test_group_without_terms_and_no_kept_terms(spark):
    rows = [("en", "a", "x y"), ("en", "b", "1 2"), ("en", None, None), (None, "a", "x")]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert plain(divergence.audit(df, least=1)) == brute(rows, 1, 10)
    nothing = plain(divergence.audit(df))
    assert {r[2] for r in nothing} == {"pair"} and {r[4] for r in nothing} == {0} and len(nothing) == 6


def test_empty_table(empty_docs):
    assert divergence.audit(empty_docs).collect() == []


def test_shuffles_of_counts_hold_no_text(some):
    tallied = divergence.tally(some, "lang", "source", "text")
    assert [f.dataType.simpleString() for f in tallied.select("lid", "gid", "digest", "n", "docs").schema] == ["bigint"] * 5


def test_shares_past_64_bits(spark):
    big = spark.sql(f"SELECT {divergence.share('n', 'total', 'kept')} AS p FROM VALUES (90000000000000L, 900000000000000L, 7L) AS t(n, total, kept)")
    assert big.first().p == 1 + 1000000000 * (90000000000000 + 2) // (900000000000000 + 14)
    assert spark.sql(f"SELECT {divergence.distance('p', 'q')} AS f FROM VALUES (1000000001L, 1L) AS t(p, q)").first().f == 10**18 // 1000000002
