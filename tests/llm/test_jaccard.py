import random
import re

import numpy as np
import pytest

from keepwell.llm import jaccard as J
from keepwell.llm.arrays import Block


def shingles(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(texts, percent=85):
    sets, root = {k: shingles(t) for k, t in texts.items()}, {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return {k: (len(sets[k]), find(k)) for k in texts}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.fixture(scope="module")
def planted():
    """Groups of near copies of all distances, chains, shared passages, short texts, copies."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = {}
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((8, 20, 60, 200)))]
        chain = list(base)
        for n in range(8):
            near = list(base)
            for _ in range(n):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts[len(texts)] = " ".join(near)
            chain[rng.randrange(len(chain))] = rng.choice(vocabulary)
            texts[len(texts)] = " ".join(chain)
    for _ in range(30):
        texts[len(texts)] = " ".join(passage + [rng.choice(vocabulary) for _ in range(rng.randrange(0, 12))])
    for t in (None, "", "a", "A", "a b", "a b c", "a b c d", "a b c d e", "A  b c\td"):
        texts[len(texts)] = t
    for k in list(texts)[:20]:
        texts[len(texts)] = texts[k]
    return texts


@pytest.mark.parametrize("most", [1, 8])
def test_components_equal_brute_force(spark, planted, most):
    docs = spark.createDataFrame(list(planted.items()), "doc_id long, text string").repartition(5)
    assert found(J.link(docs, most=most)) == brute(planted)


def test_the_second_pass_finds_what_the_stars_miss(spark, planted, monkeypatch):
    monkeypatch.setattr(J, "stars", lambda lists, percent: lists.select("node", "node").toDF("a", "b").limit(0))
    docs = spark.createDataFrame(list(planted.items()), "doc_id long, text string")
    assert found(J.link(docs)) == brute(planted)


def test_wanted_texts_by_shuffle(spark, planted, monkeypatch):
    monkeypatch.setattr(J, "MOST_WANTED", 0)
    docs = spark.createDataFrame(list(planted.items()), "doc_id long, text string")
    assert found(J.link(docs)) == brute(planted)


def test_odd_texts(odd_docs, empty_docs):
    rows = J.link(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[0].component_id == 0 and by[0].n_shingles == 0  # null
    assert by[1].component_id == 1 and by[2].component_id == 2  # empty sets link with nothing
    assert by[5].component_id == by[6].component_id == by[7].component_id == 5
    assert J.link(empty_docs).count() == 0 == J.representatives(empty_docs).count()
    one = J.representatives(odd_docs)
    assert one.schema == odd_docs.schema
    kept = sorted((r.doc_id for r in one.collect()), key=str)
    assert kept == sorted([0, 1, 2, 3, 4, 5, 8, 9, 10, 11, None], key=str)


def test_signatures_tell_sets_apart():
    block = Block([b"a b c d e", b"A b c d e", b"a b c d f", b"", b"e"])
    owner, value = J.shingle_sets(block, 4)
    hi, lo = J.signatures(owner, value, 5)
    assert hi[0] == hi[1] != hi[2] and lo[0] == lo[1] != lo[2] and hi[3] == 0 != hi[4]


def test_parities_never_differ_more_than_the_sets():
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(300))) for _ in range(2100)]
    owner, value = J.shingle_sets(Block([t.encode() for t in texts]), 4)
    odd = J.parities(owner, value, len(texts)).view(np.uint64)
    sets = [shingles(t) for t in texts]
    for i in range(len(texts) - 1):
        differ = sum(int(x).bit_count() for x in odd[i] ^ odd[i + 1])
        apart = len(sets[i] ^ sets[i + 1])
        assert differ <= apart and differ % 2 == apart % 2


def test_longer_prefixes_where_candidates_cost_more():
    rng = np.random.default_rng(1)
    value = np.sort(rng.integers(0, 1 << 63, 200).astype(np.uint64))
    owner = np.zeros(200, np.int64)
    even = np.full(1 << J.SKETCH_BITS, 10)
    at = (value >> np.uint64(64 - J.SKETCH_BITS)).astype(int)
    busy, mixed = even.copy(), even.copy()
    busy[at] = 5000
    mixed[at[30:]] = 5000
    cheap, dear, some = (J.prefixes(owner, value, 1, counts, 85, 8) for counts in (even, busy, mixed))
    assert set(cheap[4]) == {1} and len(cheap[0]) == 200 - 170 + 1
    assert set(dear[4]) == {8} and len(dear[0]) == 200 - 170 + 8
    assert set(some[4]) == {1} and set(some[1][:30]) == set(value[:30])  # rarest first; more would cost more


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 3), (300, 200)]
    rows = J.components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r.node: r.root for r in rows}
    assert roots == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}, 200: 200, 300: 200}
    assert J.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_make_few_pairs(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        near = list(base)
        near[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(near)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = []
    whole = J.verified
    J.verified = lambda docs, pairs, *rest: (made.append(pairs.count()), whole(docs, pairs, *rest))[1]
    try:
        assert {c for _, c in found(J.link(docs)).values()} == {0}
    finally:
        J.verified = whole
    assert sum(made) < 4 * len(rows)  # all pairs would be 200 times the rows


def brute_links(texts, percent=85):
    sets = {k: shingles(t) for k, t in texts.items()}
    keys = [k for k in sorted(texts) if sets[k]]
    return {
        (a, b)
        for i, a in enumerate(keys)
        for b in keys[i + 1 :]
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    }


@pytest.mark.parametrize("block", [3, 128])
def test_every_link_is_found_and_counted(spark, planted, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    docs = spark.createDataFrame(list(planted.items()), "doc_id long, text string").repartition(5)
    want = brute_links(planted)
    rows = J.links(docs).collect()
    n = dict.fromkeys(planted, 0)
    for pair in want:
        for k in pair:
            n[k] += 1
    assert {r.doc_id: r.n_links for r in rows} == n
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(planted)
    of = {r.doc_id: r.class_id for r in rows}
    found_pairs = [tuple(r) for r in J.pairs(docs).collect()]
    assert len(found_pairs) == len(set(found_pairs))
    assert set(found_pairs) == {(of[a], of[b]) for a, b in want if of[a] != of[b] and a == of[a] and b == of[b]}


def test_the_query_returns_the_links_of_near_copies(spark):
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(words[:-1] + [f"x{i}"])) for i in range(40)] + [(100, " ".join(words[:-1] + ["x0"]))]
    found = J.links(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.n_links for r in found} == {40}


def test_links_of_odd_texts(odd_docs, empty_docs):
    rows = J.links(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.doc_id: r.n_links for r in rows} == {None: 0, **dict.fromkeys(range(12), 0), 5: 3, 6: 3, 7: 3}
    assert J.links(empty_docs).count() == 0 == J.pairs(empty_docs).count()


def test_different_texts_under_one_key_stay(spark):
    rows = [(1, "one two three four five"), (1, "one two three four five"), (1, "quite another text that is kept as well")]
    kept = J.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in kept) == sorted(set(rows))


def rows_brute(rows, percent=85):
    """(component, links, kept) of each row, ids aside: texts link with texts, an id may have many."""
    sets = [shingles(t) for _, t in rows]
    near = [
        {j for j in range(len(rows)) if j != i and x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j])}
        for i, x in enumerate(sets)
    ]
    out = []
    for i in range(len(rows)):
        reached, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - reached
            reached |= new
            todo += new
        out.append((min(rows[j][0] for j in reached), len(near[i])))
    return out


def repeated_ids():
    rng = random.Random(6)
    base = {c: [f"{c}{rng.randrange(500)}" for _ in range(60)] for c in "abcdef"}

    def near(c, n):
        words = list(base[c])
        for i in rng.sample(range(60), n):
            words[i] = f"x{rng.randrange(10**6)}"
        return " ".join(words)

    a, b = near("a", 0), near("b", 0)
    rows = [(3, a), (5, near("a", 1)), (5, b), (9, b)]
    rows += [(rng.randrange(20, 40), near(rng.choice("cdef"), rng.choice((0, 0, 1, 1, 2)))) for _ in range(120)]
    return rows + [(50, "Same Words here now"), (50, "same  words here now"), (50, ""), (60, None), (60, "")]


def test_links_of_repeated_ids_equal_brute_force(spark):
    rows = repeated_ids()
    want = sorted((k, *x) for (k, _), x in zip(rows, rows_brute(rows)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted((r.doc_id, r.component_id, r.n_links) for r in J.links(docs).collect()) == want
    assert [x[1] for x in rows_brute(rows)[:4]] == [1, 1, 1, 1]


def test_no_text_is_lost_under_repeated_ids(spark):
    """Every component keeps one row, that of its smallest id, however rows are dealt out."""
    rows = repeated_ids()
    results = []
    for parts in (1, 7):
        docs = spark.createDataFrame([(k, t, "v") for k, t in rows], "doc_id long, text string, set_hi string").repartition(parts)
        kept = J.representatives(docs)
        assert kept.columns == docs.columns
        results.append(sorted((tuple(r)[:2] for r in kept.collect()), key=str))
    assert results[0] == results[1]
    kept = [r for r in results[0] if shingles(r[1])]
    components = []  # by text: which component each one is in
    root = rows_brute(rows)
    sets = [shingles(t) for _, t in rows]
    near = lambda x, y: bool(x and y) and 100 * len(x & y) >= 85 * len(x | y)
    for i, x in enumerate(sets):
        if x:
            met = [c for c in components if any(near(x, sets[j]) for j in c)]
            components = [c for c in components if c not in met] + [sum(met, []) + [i]]
    assert len(kept) == len(components)
    for c in components:
        mine = [r for r in kept if any(r[1] == rows[j][1] for j in c)]
        assert len(mine) == 1 and mine[0][0] == root[c[0]][0]
    assert {r for r in results[0] if not shingles(r[1])} == {(50, ""), (60, "")}
    assert (3, rows[0][1]) in results[0] and (5, rows[2][1]) in results[0]
