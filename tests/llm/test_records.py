from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickpath.llm import records
from .conftest import SMOKE, pairs

MODEL = public_tokenizers.path("word_bpe_49k.json")


def expected(rows: list[tuple]) -> list[tuple]:
    """(doc_id, ids) in the order of the files; texts with the same doc_id in any order."""
    tokenizer = Tokenizer.from_file(MODEL)
    return [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


@pytest.mark.parametrize("table", ["awkward", "clashing", "smoke", "nothing"])
def test_files_give_back_every_document(request, spark, table):
    df = request.getfixturevalue(table)
    root = records.new_record_folder(spark)
    manifest = records.write_token_records(df, root, MODEL, file_bytes=20_000)
    back = sorted(records.read_token_records(spark, manifest, root, read_bytes=5_000).collect(), key=lambda r: r["start"])
    want = expected(pairs(df))
    assert [r["doc_id"] for r in back] == [d for d, _ in want]
    assert sorted(((r["doc_id"] is not None, r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in back), key=repr) == sorted(
        ((d is not None, d, ids) for d, ids in want), key=repr
    )
    sizes = [len(r["ids"]) // 4 for r in back]
    assert [r["start"] for r in back] == [sum(sizes[:i]) for i in range(len(sizes))]
    for row in manifest.collect():
        for number in (0, row["records"] - 1):
            doc_id, ids = records.read_one(root, row["path"], number)
            assert (doc_id, len(ids)) in {(d, len(i)) for d, i in want}


def test_query_equals_the_library(spark, smoke):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in records.op7_token_records(spark, SMOKE).collect()}
    start, want = 0, {}
    for doc_id, ids in expected(pairs(smoke)):
        want[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert got == want


def test_damage_is_found():
    payload = records.payload_of(7, np.array([1, 2, 70], dtype="<u2"))
    data = records.frame(payload)
    assert records.unframe(b"xx" + data, 2) == (payload, len(data) + 2)
    doc_id, ids = records.document_of(payload)
    assert doc_id == 7 and ids.tolist() == [1, 2, 70]
    for i in range(len(data)):
        broken = bytearray(data)
        broken[i] ^= 1
        with pytest.raises(records.DamagedRecord):
            records.unframe(bytes(broken))
    with pytest.raises(records.DamagedRecord):
        records.unframe(data[:-1])


def test_wide_ids_and_missing_doc_id():
    payload = records.payload_of(None, np.array([1, 70_000], dtype="<u4"))
    doc_id, ids = records.document_of(payload)
    assert doc_id is None and ids.tolist() == [1, 70_000]


def test_words_alone_give_what_whole_texts_give():
    import pyarrow as pa

    from clickpath.llm import words

    made = records.WordTokenizer(MODEL)
    assert made.by_words and made.by_model and made.plain
    texts = ["It's A.B., x.,y 3.14 ...,. Été É.  ÇA, don't 's 'S a\u0301. \u0301x ﬁ Straße. ΑΣ ΣΑΣ. İ. a,\u0338 ½. Ⅷ a_b.c <|endoftext|>.x", "", "日本.語"]
    whole = Tokenizer.from_file(MODEL)
    for rows, ids, at in made.groups(words.as_binary(pa.array(texts))):
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [whole.encode(t, add_special_tokens=False).ids for t in texts[rows]]


def test_other_tokenizers_get_whole_texts():
    import pyarrow as pa

    from clickpath.llm import words

    path = public_tokenizers.path("byte_bpe_50k.json")
    made = records.WordTokenizer(path)
    assert not made.by_words
    texts = ["Hello there,  world", "", "a\nb"]
    for rows, ids, at in made.groups(words.as_binary(pa.array(texts))):
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [made._ids(t) for t in texts[rows]]
