import zlib

import numpy as np
import pytest

from keepwell.llm import language as L
from keepwell.llm.arrays import Block


@pytest.mark.parametrize("count", [[3], [1, 4, 0, 2], [L.STRIDE, 1, 3 * L.STRIDE + 5], [0, 0]])
def test_marginals_equal_forward_backward(count):
    rng = np.random.default_rng(len(count))
    n, k = sum(count), 3
    scores, transition = rng.normal(size=(n, k)) * 3, rng.normal(size=(k, k))
    got, forward, later = L.marginals(scores, np.array(count), transition)
    start = 0
    for m in count:
        if not m:
            continue
        own, move = np.exp(scores[start : start + m]), np.exp(transition)
        ahead = [np.ones(k) @ move * own[0]]
        for t in range(1, m):
            ahead.append(ahead[-1] @ move * own[t])
        behind = [np.ones(k)]
        for t in range(m - 1, 0, -1):
            behind.append(move @ (own[t] * behind[-1]))
        want = np.array(ahead) * np.array(behind[::-1])
        assert np.allclose(got[start : start + m], want / want.sum(axis=1, keepdims=True))
        assert np.allclose(forward[start], ahead[0] / max(ahead[0]))
        start += m


def test_long_texts_do_not_underflow():
    scores = np.tile([[30.0, -30.0]], (50_000, 1))
    got, _, _ = L.marginals(scores, np.array([50_000]), np.array([[0.0, -20.0], [-20.0, 0.0]]))
    assert np.isfinite(got).all() and got[:, 0].min() > 0.99


def test_features_depend_on_the_word_alone():
    one = L.FeatureWords(Block([b"Haus und Hof", b"hof"]))
    two = L.FeatureWords(Block([b"der hof"]))
    split = lambda w: {w.hash.tolist()[i]: np.split(w.numbers, np.cumsum(w.features)[:-1])[w.kind[i]].tolist() for i in range(len(w))}
    a, b = split(one), split(two)
    shared = set(a) & set(b)
    assert len(shared) == 1 and all(sorted(a[h]) == sorted(b[h]) for h in shared)


RUNS = [("de", "das haus und der hof ist gross"), ("en", "the house and the yard is large")] * 40


def test_code_switched_text_is_labelled_by_word():
    labels, weights, transition = L.fit(RUNS)
    words = L.FeatureWords(Block([b"the house and the yard das haus und der hof"]))
    got, _, _ = L.marginals(words.scores(weights), words.count, transition)
    assert [labels[i] for i in got.argmax(axis=1)] == ["en"] * 5 + ["de"] * 5
    assert transition[0, 0] > transition[0, 1] and transition[1, 1] > transition[1, 0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = L.identify(docs).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0}
    right = sum(r.lang_pred == truth[r.doc_id] for r in held if truth[r.doc_id])
    assert right / sum(truth[r.doc_id] is not None for r in held) > 0.96
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_the_text_is_an_input(spark):
    rows = [(i, f"{text} {i % 7}", label) for i, (label, text) in enumerate(RUNS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs)
    a = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, model).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs.drop("lang"), model).collect()}
    assert a == b and set(x for x, _ in a.values()) == {"de", "en"}


def test_odd_texts(odd_docs, empty_docs):
    rows = {r.doc_id: r for r in L.identify(odd_docs).collect()}
    assert len(rows) == odd_docs.select("doc_id").distinct().count()
    for k in (0, 1, 2, None):
        assert (rows[k].lang_pred, rows[k].score) == ("und", 0.0)
    assert rows[5].lang_pred == "en" and rows[None].held_out is False
    assert L.identify(empty_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", odd_docs["lang"].substr(5, 0)).where("false").union(odd_docs.selectExpr("doc_id", "text", "cast(null as string)", "source", "n_words", "kept", "hi"))
    assert {r.lang_pred for r in L.identify(unlabelled).collect()} == {"und"}
