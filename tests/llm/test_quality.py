import base64
import random
import re
from collections import Counter

import pytest
import zstandard

from keepwell.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(hit), failed


def verdict(text):
    """Whether a text is kept, chunk by chunk."""
    if brute(text)[-1]:
        return False
    data = text.encode()
    for part in [data, *(data[i : i + 4096] for i in range(0, len(data), 4096))]:
        ratio = len(part) / len(zstandard.ZstdCompressor(level=3).compress(part))
        low, high = [(low, high) for least, low, high in quality.BANDS if len(part) >= least][-1]
        if not low <= ratio <= high:
            return False
    return True


def counts(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed


def test_base_counts_equal_brute_force(documents, texts):
    found = {r.doc_id: r for r in quality.assess(documents).collect()}
    assert len(found) == len(texts)
    assert all(counts(found[k]) == brute(t) for k, t in texts.items())
    assert all(r.kept == verdict(texts[k]) for k, r in found.items())
    assert 0 < sum(r.kept for r in found.values()) < len(texts)


def test_odd_texts(odd_docs, empty_docs):
    found = quality.assess(odd_docs).collect()
    by = {r.doc_id: r for r in odd_docs.collect()}
    assert len(found) == odd_docs.count()
    assert all(counts(r) == brute(by[r.doc_id].text) for r in found)
    assert quality.assess(empty_docs).count() == 0 == quality.keep(empty_docs).count()
    kept = quality.keep(odd_docs)
    assert kept.schema == odd_docs.schema
    assert sorted(map(str, kept.collect())) == sorted(str(by[r.doc_id]) for r in found if r.kept)


def test_bands_reject_repetition_and_noise(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    clean = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (30, 150, 600, 3000, 20000)]
    noise = [" ".join("".join(chr(rng.randint(33, 0x2FFF)) for _ in range(9)) for _ in range(n)) for n in (100, 900)]
    # repeats that no five words have in common: the base rules let them pass
    same = [" ".join(f"{'ab' * 40}{i:x}" for i in range(n)) for n in (40, 400)]
    half = [clean[3] + " " + " ".join(f"{'x' * 200}{i}" for i in range(600))]  # within bounds as a whole, not in its chunks
    rows = [(k, t) for k, part in enumerate((clean, noise, same, half)) for t in part]
    found = quality.assess(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.kept == (r.doc_id == 0) for r in found), [(r.doc_id, r.ratio, r.n_bad_chunks) for r in found]
    assert not any(r.base_failed for r in found)


def test_every_chunk_is_judged(spark):
    """Noise in any part of a text: one of two chunks, some of five, a short text's half, a tail shorter than a chunk."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(900)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))[:n]

    def noise(n):
        coded = base64.b64encode(bytes(rng.randrange(256) for _ in range(n))).decode()
        return " ".join(coded[i : i + 60] for i in range(0, len(coded), 60))[:n]

    texts = [
        prose(4096) + noise(4096), prose(10240) + noise(10240), prose(3500) + noise(3500), prose(8192) + noise(4095),
        noise(4096) + prose(30000), prose(4096), prose(20480), prose(9000),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in quality.assess(df).collect()}
    assert [found[i].kept for i in range(8)] == [False] * 5 + [True] * 3
    assert all(found[i].kept == verdict(t) for i, t in enumerate(texts)) and found[3].n_chunks == 3


def test_bands_are_a_parameter(documents):
    assert quality.keep(documents, bands=((0, 9e9, 9e9),)).count() == 0


def test_plan_has_no_shuffle(documents, capsys):
    quality.assess(documents).explain()
    assert "Exchange" not in capsys.readouterr().out


@pytest.mark.parametrize("size, expected", [(0, (0.0, 1e9)), (127, (0.0, 1e9)), (128, (0.9, 3.0)), (10**9, (1.5, 7.0))])
def test_band_by_length(size, expected):
    assert quality.band(size) == expected
