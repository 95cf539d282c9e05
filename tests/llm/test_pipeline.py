from __future__ import annotations

import collections

import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from clickpath.llm import mixing
from clickpath.storage import stored
from . import brute
from .conftest import SMOKE, edited, pairs, prose


@pytest.fixture(scope="module")
def steps(spark):
    """Rows after each stage, the whole table first."""
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMOKE), "test-stage")
        out.append(docs)
    return out


def test_columns_stay(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_toxicity_drops_rows_only(steps):
    before, after = (collections.Counter(map(tuple, df.collect())) for df in steps[:2])
    assert after <= before and len(after) > 0.8 * len(before)


def test_line_dedup(steps):
    want = {}
    for (doc_id, text), (n, gone, kept) in brute.without_repeated_lines(pairs(steps[1]), by_words=True).items():
        if gone < n or not gone:
            want[doc_id] = kept
    assert dict(pairs(steps[2])) == want
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2].collect())


def test_near_dedup(steps):
    want = {d for (d, _, _, kept) in brute.near_groups(pairs(steps[2])) if kept}
    assert sorted(d for d, _ in pairs(steps[3])) == sorted(want)


def test_mixing(steps):
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(steps[3]).collect()}
    rows = collections.Counter(map(tuple, steps[4].collect()))
    assert rows == collections.Counter({tuple(r): copies[r["doc_id"]] for r in steps[3].collect() if copies[r["doc_id"]]})


def test_encoding(steps):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((d, library.encode(t), brute.sha(t)) for d, t in pairs(steps[4]))
    assert sorted((r["doc_id"], list(r["ids"]), r["decoded_sha256"]) for r in steps[5].collect()) == want


def test_run_is_all_stages(spark, steps):
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SMOKE).collect()) == sorted(r["doc_id"] for r in steps[-1].collect())


@pytest.mark.parametrize("table", ["awkward", "clashing", "nothing"])
def test_awkward_rows(request, spark, table):
    docs = request.getfixturevalue(table)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMOKE), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            if table != "nothing":
                assert docs.where(F.col("doc_id").isNull()).count() == 2 or name == "mixing"
    assert docs.isEmpty() is (table == "nothing")


def test_near_dedup_tells_texts_of_one_id_apart(spark):
    """A clean text stays whatever else has its doc_id; of a group one row stays, also where rows or ids repeat."""
    a, b, c = prose(80, 100), prose(81, 100), prose(82, 100)
    rows = [(1, a), (5, edited(a, 60)), (5, b), (6, edited(b, 70)), (7, c), (7, c), (7, edited(c, 50)), (None, a), (None, a), (8, " "), (8, " "), (9, None)]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, number int")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SMOKE)
    assert kept.columns == docs.columns
    got = collections.Counter(pairs(kept))
    third = [t for (d, t), n in got.items() if d == 7]
    assert len(third) == 1 and third[0] in (c, edited(c, 50))
    assert got == collections.Counter([(1, a), (5, b), (7, third[0]), (None, a), (None, a), (8, " "), (8, " "), (9, None)])
