from __future__ import annotations

import collections

import numpy as np
import pytest

from clickpath.llm import substrings, words
from . import brute
from .conftest import pairs


def found(df, k: int = 13) -> collections.Counter:
    rows = substrings.drop_repeated_substrings(df, k).collect()
    return collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows)


@pytest.mark.parametrize("table", ["awkward", "clashing", "smoke", "nothing"])
def test_equals_brute_force(request, table):
    df = request.getfixturevalue(table)
    assert found(df) == brute.kept_words(pairs(df))


def test_other_lengths(awkward):
    assert found(awkward, 2) == brute.kept_words(pairs(awkward), 2)


def test_a_long_passage_is_one_span(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"a b {passage} c"), (2, f"d {passage} e f"), (3, "nothing of it")]
    out = {r["doc_id"]: r for r in substrings.drop_repeated_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1]["spans"] == [] and out[3]["n_removed"] == 0
    assert [(s["start"], s["length"]) for s in out[2]["spans"]] == [(1, 60)]
    assert out[2]["kept_text"] == "d e f"


def test_keys_survive_packing():
    keys = np.array([0, 1, 2**56 - 1, 2**63 + 12345], dtype=np.uint64)
    assert (substrings._unpack(substrings._pack(keys)) == keys & np.uint64(2**56 - 1)).all()


def test_words_and_hashes():
    import pyarrow as pa

    texts = ["a b  a", None, "", "\tb\n", "ab"]
    seen = {}
    for group in words.word_groups(words.as_binary(pa.array(texts)), most=4):
        hashes = words.word_hashes(group)
        for d in range(group.rows.start, group.rows.stop):
            lo, hi = group.first[d - group.rows.start], group.first[d - group.rows.start + 1]
            assert [group.text_of(i).decode() for i in range(lo, hi)] == brute.words(texts[d])
        for i, h in enumerate(hashes):
            assert seen.setdefault(int(h), group.text_of(i)) == group.text_of(i)
    assert len(seen) == 3
