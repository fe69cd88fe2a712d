import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from keepwell.llm import spelling

RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")


def lower(word):
    return re.sub("[A-Z]", lambda m: m.group().lower(), word)


def brute_words(rows, letters=6, least=5, share=199):
    total = Counter()
    for key, text in rows:
        for run in map(lower, RUN.findall(text or "")):
            crc = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if crc % share == 0:
                place = crc % len(run)
                run = run[:place] + run[place + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= letters and n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n, ratio=5):
    by_size = defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    near = {w: [v for d in (-1, 0, 1) for v in by_size[len(w) + d] if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def plain(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_equals_brute_force(spark, documents):
    documents = documents.filter("doc_id < 100")
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    n = brute_words(rows, least=2)
    got = plain(spelling.groups(documents, occurrences=2, ratio=2))
    assert got == brute(n, 2) and sum(v[0] is not None for v in got.values()) > 20


@pytest.mark.parametrize("share", [3, 199])
def test_words_that_lose_a_letter(documents, share):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = {r.word: r.n for r in spelling.vocabulary(documents, "doc_id", "text", 4, 3, share).collect()}
    assert got == brute_words(rows, 4, 3, share)


def test_blocks_of_a_large_file_and_small_batches(spark, monkeypatch):
    """Words over three letters fill files of hundreds; blocks of 16 words meet in pairs, batches end inside files."""
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("abé"), size=rng.integers(5, 8))) for _ in range(400)}
    n = {w: int(rng.integers(5, 4000)) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    monkeypatch.setattr(spelling, "BATCH", 60)
    monkeypatch.setattr(spelling, "SEARCH", 50)
    for pieces, most in ((1, 16), (3, 16), (3, 2048)):
        found = spelling.near_words(df, 5, pieces, most).collect()
        count, best = Counter(), {}
        for r in found:
            count[r.word] += r.n_near
            best[r.word] = min(best.get(r.word, (0, "~")), (-r.best_n, r.best))
        near = {w: [v for v in words if one_edit(w, v)] for w in words}
        assert {w: count[w] for w in words} == {w: len(v) for w, v in near.items()}
        assert {w: b for w, b in best.items()} == {w: min((-n[x], x) for x in v) for w, v in near.items() if v}


def test_very_long_words_and_columns_of_many_words():
    long = "ab" * 3000
    words = sorted([long, long[:2000] + long[2001:], long[:-1] + "c", *("word" + a + b for a in "abcdefghijklm" for b in "nopqrstuvwxyz")])
    index = spelling.Slices([w.encode("latin-1") for w in words], np.zeros(len(words), np.int64))
    for m in {len(w) for w in words}:
        sizes = np.full(len(words), m)
        a, b = index.near(sizes)
        got = {(words[i], words[j]) for i, j in zip(a, b)}
        assert got == {(v, w) for v in words for w in words if one_edit(v, w) and min(len(v), len(w)) == m}


def test_chains_are_followed_to_the_end(spark):
    """Each word is five times as frequent as the one before it: the longest chain that counts allow."""
    chain = ["aaaaaa", "baaaaa", "bbaaaa", "bbbaaa", "bbbbaa", "bbbbba"]
    text = " ".join(" ".join([w] * 5 ** (i + 1)) for i, w in enumerate(chain))
    got = plain(spelling.groups(spark.createDataFrame([(1, text)], "doc_id long, text string"), share=10**9))
    assert {v[1] for v in got.values()} == {"bbbbba"} and len(got) == 6
    assert got["bbaaaa"] == ("bbbaaa", "bbbbba", 125, 2, 625)
    assert [spelling.rounds(n, 5, 5) for n in (0, 25, 125, 625, 3125, 15625, 78125)] == [0, 0, 1, 2, 2, 3, 3]


def test_odd_input(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    n = brute_words(rows, 3, 1)
    assert plain(spelling.groups(odd_docs, letters=3, occurrences=1)) == brute(n)


def test_null_ids_and_only_a_to_z_lower_cased(spark):
    rows = [(None, "Été été ETE ÉTÉ"), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n for r in spelling.vocabulary(df, "doc_id", "text", 3, 1).collect()}
    assert got == brute_words(rows, 3, 1) and "ÉtÉ" in got


def test_empty_table(empty_docs):
    assert spelling.groups(empty_docs).collect() == []
