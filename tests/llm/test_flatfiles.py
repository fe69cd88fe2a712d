import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from keepwell.llm import flatfiles as T
from keepwell.llm.arrays import Block


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out.encode_special_tokens = True
    return out


def test_words_encoded_apart_equal_whole_texts(library, texts, odd_texts):
    rng = random.Random(8)
    letters = "aAéÉ  \t\n 'sdtÉß漢😀Σσ1２.,​　-İ"
    odd = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(800)]
    some = [*odd, *odd_texts, *(t or "" for t in texts.values())]
    encode = T.Encoder(T.default_path())
    for _ in range(2):  # the second time from memory
        ids, count = encode(Block([t.encode() for t in some]))
        want = [e.ids + [1] for e in library.encode_batch(some, add_special_tokens=False)]
        assert ids.tolist() == [i for x in want for i in x] and count.tolist() == [len(x) for x in want]


def expected(library, rows):
    out, start = [], 0
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_all_documents_in_order(spark, documents, library, tmp_path):
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    shuffled = documents.repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = T.write(shuffled, str(tmp_path / "t"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = sorted(tuple(r) for r in T.read(spark, str(tmp_path / "t")).collect())
    assert found == expected(library, rows)
    # the format itself: bases are prefix sums, the files lie one after another
    assert json.loads((tmp_path / "t/manifest.json").read_text()) == manifest
    before_ids = before_docs = 0
    flat = []
    for part in manifest["parts"]:
        assert (part["first_id"], part["first_doc"]) == (before_ids, before_docs)
        ids = np.memmap(tmp_path / "t" / f"{part['name']}.ids", "<u2")
        offsets = np.fromfile(tmp_path / "t" / f"{part['name']}.offsets", "<u8")
        assert offsets[0] == 0 and offsets[-1] == len(ids) == part["n_ids"] and len(offsets) == part["n_docs"] + 1
        before_ids, before_docs = before_ids + part["n_ids"], before_docs + part["n_docs"]
        flat += ids.tolist()
    assert [before_ids, before_docs] == [manifest["n_ids"], manifest["n_docs"]] == [len(flat), len(rows)]
    assert flat.count(1) >= len(rows) and len(manifest["parts"]) > 1


def test_odd_texts(spark, odd_docs, empty_docs, library, tmp_path):
    folder = f"file://{tmp_path}/odd"
    T.write(odd_docs, folder)
    rows = [tuple(r) for r in T.read(spark, folder).collect()]
    assert len(rows) == odd_docs.count()
    by = sorted(rows, key=lambda r: r[1])
    assert [r[0] for r in by] == [None, *sorted(r[0] for r in rows if r[0] is not None)]
    assert all(a[1] + a[2] == b[1] for a, b in zip(by, by[1:]))
    one = zlib.crc32(np.array([1], "<u4").tobytes())
    assert [(r[2], r[3]) for r in by if r[0] in (0, 1, 2, None)] == [(1, one)] * 4
    manifest = T.write(empty_docs, f"{tmp_path}/none")
    assert manifest["parts"] == [] and T.read(spark, f"{tmp_path}/none").count() == 0


def test_reads_in_ranges(monkeypatch, spark, documents, library, tmp_path):
    monkeypatch.setattr(T, "READ_DOCS", 3)
    manifest = T.write(documents.limit(50).coalesce(1), str(tmp_path))
    seen = 0
    for part in manifest["parts"]:
        for keys, place, ids in T.documents(str(tmp_path), part, manifest["ids"]):
            assert len(keys) <= 3 and len(place) == len(keys) + 1 and place[-1] - place[0] == len(ids)
            seen += len(keys)
    assert seen == 50


def test_another_vocabulary_equals_the_library(texts, odd_texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert T.wordwise(T.default_path()) and not T.wordwise(path)
    some = [*odd_texts, *list(texts.values())[:40]]
    some = [t or "" for t in some]
    ids, count = T.Encoder(path, 7)(Block([t.encode() for t in some]))
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    want = [library.encode(t, add_special_tokens=False).ids + [7] for t in some]
    assert ids.tolist() == [i for x in want for i in x] and count.tolist() == [len(x) for x in want]


def test_keys_must_be_integers(documents, tmp_path):
    with pytest.raises(ValueError, match="64-bit integers"):
        T.write(documents.withColumn("doc_id", documents.doc_id.cast("string")), str(tmp_path))
