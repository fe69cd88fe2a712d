import sys

import pytest
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from check import compare, connect
from keepwell.llm import pieces, pii, quality, queries

from test_decontaminate import brute as contaminated
from test_jaccard import brute as linked
from test_pii import brute as private
from test_quality import brute as counted

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    exact, _, note = compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name])
    assert exact, note


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(queries.SQL) <= set(entry.oracle_sql())


def test_the_rest_works_without_this_subpackage(monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    names = set(entry.queries())
    assert names and not any(x.startswith("op") and "_" in x and x[2].isdigit() for x in names) and "pipeline" not in names
    assert set(entry.oracle_sql()) <= names


@pytest.fixture(scope="module")
def stages(spark, documents):
    """The rows after each stage, as {id: row}."""
    docs, out = documents, [{r.doc_id: r for r in documents.collect()}]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), stage(spark, docs, FOLDER).schema)
        out.append({r.doc_id: r for r in docs.collect()})
    return out


def test_stages_are_in_order_and_keep_the_columns(stages, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "SentencePiece encoding and decoding",
    ]
    assert all(next(iter(s.values())).__fields__ == documents.columns for s in stages[:-1])
    assert next(iter(stages[-1].values())).__fields__ == [*documents.columns, "ids"]


def test_quality_stage(stages, spark, documents):
    kept = {r.doc_id for r in quality.assess(documents).collect() if r.kept}
    assert set(stages[1]) == kept and not any(counted(stages[0][k].text)[-1] for k in kept)


def test_near_duplicate_stage(stages):
    root = linked({k: r.text for k, r in stages[1].items()})
    assert set(stages[2]) == {k for k, (_, c) in root.items() if k == c} < set(stages[1])


def test_decontamination_stage(stages, spark):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(stages[3]) == {k for k, r in stages[2].items() if not contaminated(r.text, items)[4]} < set(stages[2])


def test_private_data_stage(stages):
    assert set(stages[4]) == set(stages[3])
    changed = 0
    for k, r in stages[4].items():
        before = stages[3][k]
        assert not private(r.text) and r.n_chars == len(r.text) and (r.lang, r.source) == (before.lang, before.source)
        if private(before.text):
            assert r.text != before.text and any(f"<{kind.upper()}>" in r.text for kind in pii.KINDS)
        changed += r.text != before.text
    assert changed


def test_encoding_stage(stages):
    library = SentencePieceProcessor(model_file=pieces.default_path())
    assert set(stages[5]) == set(stages[4])
    longer = 0
    for k, r in stages[5].items():
        assert r.text == stages[4][k].text
        assert library.decode(list(r.ids)) == r.text
        longer += len(r.ids) > len(library.encode(r.text))
    assert longer > len(stages[5]) / 2  # dropped merges show


def test_run_equals_the_stages(spark, stages):
    found = {r.doc_id: (r.text, list(r.ids)) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found == {k: (r.text, list(r.ids)) for k, r in stages[-1].items()}
