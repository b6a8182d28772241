"""The contract of the pipeline: its stages in turn, its tokens against the library, odd rows, no rows."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in names} and "pipeline" in names


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    expected, start = [], 0
    for d, text in rows:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        expected.append((d, start, n))
        start += n
    found = [(r.doc_id, r.start, r.n_tokens) for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    assert sorted(found) == expected


@pytest.mark.parametrize("number", range(5))
def test_stages_on_odd_rows_and_none(spark, odd, none, number):
    stage = corpus_pipeline.STAGES[number][1]
    found, empty = stage(spark, odd, SF_DIR), stage(spark, none, SF_DIR)
    assert empty.count() == 0
    rows = found.collect()
    if number == 4:
        assert len(rows) == odd.count()
        return
    assert found.columns == odd.columns == empty.columns
    texts = [r.text for r in rows]
    given = {(r.doc_id, r.text) for r in odd.collect()}
    assert {(r.doc_id, r.text) for r in rows} <= given
    # Texts without words fail the quality rules, and are one class of near copies.
    assert (None in texts, "" in texts) == [(False, False), (True, False), (True, True), (True, True)][number]
