import hashlib
import re

import pytest

from keepwell.llm import decontaminate as D

ITEMS = [
    (0, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (1, "short Item"),
    (2, "word"),
    (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),  # a window of item 0 as well
    (3, ""),
    (4, None),
    (None, "nobody asks"),
    (1, "short Item"),
    (5, "x x x x x x x x x x x x"),
    (6, "one two three"),
]
DOCS = [
    "Alpha, beta gamma-delta epsilon zeta eta; theta iota KAPPA lambda",
    "beta gamma delta epsilon zeta eta theta iota kappa lambda",  # the second window of item 0
    "beta gamma delta epsilon zeta eta theta iota kappa",  # nine words
    "a short item, and a word. nobody asks",
    "x " * 11,
    "x " * 9,
    "one two two three one two three",
    "",
    None,
    "short",
    "é" * 40 + " short item short item",
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    mine, hit, found = words(text), set(), set()
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        if not n:
            continue
        windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for k in range(len(mine) - n + 1):
            if tuple(mine[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                found |= {str(i)} - {"None"}
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(mine), len(hit), len(found), digest, bool(hit)


def rows(frame):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, text string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_equals_brute_force(tables, block_bytes):
    docs, items = tables
    found = rows(D.report(docs, items, block_bytes=block_bytes))
    assert found == {i: brute(t, ITEMS) for i, t in enumerate(DOCS)}


def test_small_tables(spark, documents, texts):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    listed = [tuple(r) for r in items.select("item_id", "text").collect()]
    found = rows(D.report(documents, items))
    assert found == {k: brute(t, listed) for k, t in texts.items()}
    clean = {r.doc_id for r in D.clean(documents, items).select("doc_id").collect()}
    assert clean == {k for k, v in found.items() if not v[4]}


def test_odd_texts(tables, odd_docs, empty_docs):
    _, items = tables
    assert D.report(odd_docs, items).count() == odd_docs.count()
    assert D.report(empty_docs, items).count() == 0
    none = D.report(odd_docs, items.limit(0)).collect()
    assert len(none) == odd_docs.count() and not any(r.contaminated for r in none)
    kept = D.clean(odd_docs, items)
    assert kept.schema == odd_docs.schema
    clashing = odd_docs.withColumnsRenamed({"hi": "__scan_0", "kept": "__scan_1"})
    assert D.clean(clashing, items).columns == clashing.columns


def test_items_without_an_id_contaminate(spark):
    docs = spark.createDataFrame([(1, "nobody asks this"), (2, "somebody asks")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "nobody asks")], "item_id long, text string")
    assert rows(D.report(docs, items)) == {i: brute(t, [(None, "nobody asks")]) for i, t in ((1, "nobody asks this"), (2, "somebody asks"))}
    assert [r.doc_id for r in D.clean(docs, items).collect()] == [2]


def test_a_window_is_filed_under_its_rarest_shingle():
    windows = D.Windows([("0", ITEMS[0][1])])
    common = {t: 100 for t in windows.token.view("int64").tolist()}
    rare = int(windows.token.view("int64")[4])
    index = D.Index(windows, common | {rare: 1})
    filed = {int(k) for _, table, *_ in index.parts for k in table.keys.view("int64")}
    assert rare in filed and len(filed) < len(set(common))


def test_documents_are_not_shuffled(tables, capsys):
    docs, items = tables
    D.report(docs, items).explain()
    assert "Exchange" not in capsys.readouterr().out
