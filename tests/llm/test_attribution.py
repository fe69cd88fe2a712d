import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import attribution as A


def brute(text, sections, rule, encoder):
    """Characters of each token from the bytes; sections by looking at every one."""
    ids = encoder.encode_ordinary(text)
    begins = [len(text[:i].encode()) for i in range(len(text) + 1)]
    spans, at = [], 0
    for i in ids:
        n = len(encoder.decode_single_token_bytes(i))
        inside = [c for c in range(len(text)) if begins[c] < at + n and begins[c + 1] > at]
        first = inside[0]
        after = max([c + 1 for c in inside if begins[c] >= at and begins[c] < at + n] or [first + 1])
        spans.append((first, after))
        at += n
    count, across = [0] * len(sections), [0] * len(sections)
    for first, after in spans:
        if rule == "most":
            share = [min(e, after) - max(s, first) for s, e in sections]
            k = max(range(len(sections)), key=lambda i: (share[i], -sections[i][0]), default=-1)
            k = k if k >= 0 and share[k] > 0 else -1
        else:
            place = first if rule == "first" else after - 1
            k = next((i for i, (s, e) in enumerate(sections) if s <= place < e), -1)
        if k >= 0:
            count[k] += 1
            across[k] += first < sections[k][0] or after > sections[k][1]
    return count, across, len(ids)


@pytest.fixture(scope="module")
def encoder():
    return A.encoding(A.default_path())


@pytest.mark.parametrize("rule", A.RULES)
def test_rules_equal_brute_force(encoder, rule):
    rng = random.Random(9)
    for _ in range(150):
        text = "".join(rng.choice("the and 漢é😀 ing\n12,. ") for _ in range(rng.randrange(1, 60)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, rng.randrange(0, 7) * 2)))
        sections = list(zip(cuts[0::2], cuts[1::2]))
        rng.shuffle(sections)
        begin, end = (np.array([s[i] for s in sections], np.int64) for i in (0, 1))
        ids = encoder[0].encode_ordinary(text)
        count, across = A.allocate(*A.spans(text.encode(), ids, encoder[1]), begin, end, rule)
        assert (count.tolist(), across.tolist(), len(ids)) == brute(text, sections, rule, encoder[0])


def test_lines_tile_the_text(documents, texts, encoder):
    rows = {}
    for r in A.attribute(documents).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert set(rows) == {k for k, t in texts.items() if t}
    for key, found in rows.items():
        found.sort(key=lambda r: r.section)
        text = texts[key]
        assert [text[r.start : r.end] for r in found] == text.splitlines(keepends=True) or any(
            c in text for c in "\r\x0b\x0c\x1c\x1d\x1e\x85  "
        ) or "".join(text[r.start : r.end] for r in found) == text
        assert sum(r.n_tokens for r in found) == found[0].n_doc_tokens == len(encoder[0].encode_ordinary(text))


@pytest.mark.parametrize("rule", A.RULES)
def test_given_sections(spark, odd_docs, encoder, rule):
    odd = [(1, 4), (6, 6), (4, 9), (100000, 100009)]
    sections = F.when(F.col("doc_id") != 3, F.array(*(F.struct(F.lit(s).alias("start"), F.lit(e).alias("end")) for s, e in odd)))
    rows = A.attribute(odd_docs, sections, rule=rule).collect()
    by = {r.doc_id: r.text for r in odd_docs.collect()}
    assert len(rows) == 4 * (odd_docs.count() - 2)  # no sections where the array is null
    for r in rows:
        text = by[r.doc_id] or ""
        count, across, total = brute(text, odd, rule, encoder[0]) if 0 < len(text) < 200 else (None, None, None)
        if count:
            assert (count[r.section], across[r.section], total) == (r.n_tokens, r.n_across, r.n_doc_tokens)


def test_odd_texts(odd_docs, empty_docs):
    rows = A.attribute(odd_docs).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in odd_docs.collect() if r.text}
    assert A.attribute(empty_docs).count() == 0
    with pytest.raises(ValueError):
        A.attribute(odd_docs, rule="none")
