import random

import numpy as np
import pytest
import xxhash
from sentencepiece import SentencePieceProcessor

from keepwell.llm import pieces as P

ODD = ["  a  b ", "\n", "end ", "a\u0000b", "�￾", "😀😀", "x y▁z ▁", "漢" * 200]


@pytest.fixture(scope="module")
def model():
    return P.load(P.default_path())


def split(ids, sizes):
    ends = np.cumsum(sizes)
    return [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]


def test_without_dropout_equals_the_library(model, texts, odd_texts):
    library = SentencePieceProcessor(model_file=P.default_path())
    some = [t for t in [*texts.values(), *odd_texts, *ODD] if t and P.MARK not in t]
    assert split(*P.encode(some, [0] * len(some), model, 0.0)) == library.encode(some)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.7, 1.0])
def test_every_text_decodes_to_itself(model, texts, odd_texts, dropout):
    some = [t or "" for t in texts.values()] + odd_texts + ODD
    ids, sizes = P.encode(some, list(range(len(some))), model, dropout)
    assert [b.decode() for b in P.decode(ids, sizes, model)] == some


@pytest.mark.parametrize("dropout", [0.0, 0.2, 0.6])
def test_side_by_side_equals_the_agenda(model, dropout):
    rng = random.Random(6)
    words = ["".join(rng.choice("theanoringst ") for _ in range(rng.randint(1, 70))) for _ in range(120)]
    want = []
    for key, text in enumerate(words):
        full = " " + text
        starts = [i for i in range(len(full)) if full[i] == " " and (i == 0 or full[i - 1] != " ")]
        for number, (s, e) in enumerate(zip(starts, [*starts[1:], len(full)])):
            code = np.array([ord(c) for c in full[s:e]], np.uint32)
            unit = P.spans_hash(P.mix(code.astype(np.uint64) + np.uint64(1)), np.array([0]), np.array([e - s]))
            if dropout:
                keyed = np.array([xxhash.xxh64_intdigest(str(key), P.SEED)], np.uint64)
                variant = P.mix(keyed + np.uint64(number))
                unit = P.mix(unit ^ P.mix(variant + np.uint64(P.SEED << 8) + np.uint64(1)))
            want += [x for x, _ in P.agenda(model.symbol[code].tolist(), int(unit[0]), model, dropout)]
    assert P.encode(words, list(range(len(words))), model, dropout)[0].tolist() == want


def test_seed_and_key_decide_the_segmentation(model):
    text = ["segmentation of international words " * 20] * 2
    one, sizes = P.encode(text, [1, 1], model, 0.3, 1)
    again, _ = P.encode(text, [1, 1], model, 0.3, 1)
    other, _ = P.encode(text, [1, 1], model, 0.3, 2)
    assert one.tolist() == again.tolist() and one.tolist() != other.tolist()
    a, b = split(one, sizes)
    assert a == b
    c, d = split(*P.encode(text, [1, 2], model, 0.3, 1))
    assert c == a != d
    plain, _ = P.encode(text[:1], [1], model, 0.0)
    assert len(plain) < len(a)


def test_dropout_skips_its_share(model):
    n = np.arange(200_000)
    lost = P.skipped(P.mix(n.astype(np.uint64)), n % 7, n % 7 + 1, n % 7 + 2, 0.1)
    assert 0.095 < lost.mean() < 0.105
    assert not P.skipped(P.mix(n.astype(np.uint64)), n, n, n, 0.0).any()


def test_queries(odd_docs, empty_docs):
    rows = P.pieces(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.lossless and r.n_tokens == len(r.ids) for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[0] == 0
    assert P.pieces(empty_docs).count() == 0 == P.transcribe(empty_docs).count()
    told = P.transcribe(odd_docs).collect()
    key = lambda r: (str(r.doc_id), str(r.text))
    for a, b in zip(sorted(told, key=key), sorted(odd_docs.collect(), key=key)):
        assert tuple(a)[:-1] == tuple(b)
    assert len({tuple(r.ids) for r in rows if r.doc_id == 5}) == 1  # repeated rows are alike


def test_partitioning_changes_nothing(documents):
    one = {r.doc_id: r.ids_crc32 for r in P.pieces(documents.coalesce(1)).collect()}
    many = {r.doc_id: r.ids_crc32 for r in P.pieces(documents.repartition(7)).collect()}
    assert one == many


def test_every_occurrence_draws_its_own_skips(model):
    text = "international " * 3000
    ids, _ = P.encode([text], [1], model, 0.3)
    seen, word = set(), []
    for piece in ids.tolist():
        if model.bytes[piece].startswith(b" ") and word:
            seen.add(tuple(word))
            word = []
        word.append(piece)
    assert len(seen) > 20  # four variants for the whole corpus would give four at most
    both = P.encode([text] * 2, [1, 2], model, 0.3)
    assert both[0][: both[1][0]].tolist() == ids.tolist() != both[0][both[1][0] :].tolist()


def test_a_column_of_the_same_name(odd_docs):
    clashing = odd_docs.withColumnsRenamed({"hi": "ids"})
    found = P.transcribe(clashing)
    assert found.columns == [*clashing.columns, "_ids"] and found.count() == odd_docs.count()


def test_merges_are_found_by_their_slot(model):
    found = model.keys[model.number[model._slot(model.keys)]] == model.keys
    assert found.mean() > 0.9  # the rest share a slot and are searched for
    left, right = np.array(list(model.merges)).T
    assert (model.rank(left, right) == list(model.merges.values())).all()
    other = np.array([p for p in zip(left, right[::-1]) if tuple(map(int, p)) not in model.merges][:5000])
    assert (model.rank(*other.T) == P._NEVER).all()
