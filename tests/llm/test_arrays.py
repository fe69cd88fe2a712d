import re

import numpy as np
import pyarrow as pa

from keepwell.llm import arrays as A

TEXTS = ["", "a", " a  bb ", "A b\nc", "é 漢 x", "a b c a b c", "\t"]


def test_words_match_the_patterns():
    for letters, pattern in ((A.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (A.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        block = A.Block([t.encode() for t in TEXTS])
        words = A.Words(block, letters, lower=True)
        found = [[] for _ in TEXTS]
        for o, s, e in zip(words.owner, words.start, words.end):
            found[o].append(bytes(block.data[s:e]).lower().decode())
        lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TEXTS]
        assert found == [re.findall(pattern, t) for t in lowered]
        assert words.count.tolist() == [len(x) for x in found]


def test_equal_words_and_windows_have_equal_hashes():
    block = A.Block([b"x Foo foo", b"foo bar foo bar", b"bar"])
    words = A.Words(block, lower=True)
    by = {}
    for h, s, e in zip(words.hash.tolist(), words.start, words.end):
        by.setdefault(bytes(block.data[s:e]).lower(), set()).add(h)
    assert all(len(x) == 1 for x in by.values()) and len(set.union(*by.values())) == len(by)
    at, value = words.windows(2)
    assert at.tolist() == [0, 1, 3, 4, 5]  # none crosses from a text to the next
    assert value[2] == value[4] != value[3]
    assert not len(words.windows(9)[0])


def test_blocks_never_cut_a_text():
    long = "x" * (A.BLOCK_BYTES + 5)
    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 3, 4], "text": ["a", long, None, "b"]})
    parts = list(A.blocks(batch, "text"))
    assert [p.column(0).to_pylist() for p, _ in parts] == [[1], [2], [3, 4]]
    assert [t for _, b in parts for t in b.texts] == [b"a", long.encode(), b"", b"b"]
    assert not list(A.blocks(batch.slice(0, 0), "text"))


def test_ragged_and_covered():
    assert A.ragged(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert A.covered(np.array([1, 2]), 3, 7).tolist() == [False, True, True, True, True, False, False]
