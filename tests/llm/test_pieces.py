from __future__ import annotations

import struct

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from clickpath.llm import pieces, words
from .conftest import pairs

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("table", ["awkward", "clashing", "smoke", "nothing"])
def test_equals_the_library(request, library, table):
    df = request.getfixturevalue(table)
    got = pieces.encode_and_decode(df, MODEL).collect()
    want = [(d, library.encode(t or ""), (t or "").replace("▁", " ")) for d, t in pairs(df)]
    assert sorted(((r["doc_id"], list(r["ids"]), r["decoded"]) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r["n_differing"] for r in got) == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aeiou  \n▁<>0x"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_any_text_goes_there_and_back(library, texts):
    texts = [t.replace("\0", "") for t in texts]
    made = pieces.codec(MODEL)
    out, ids_of = [], []
    for ids, at, wrong in made.encode_texts(words.as_binary(pa.array(texts, pa.string()))):
        out += made.decode_texts(ids, at)
        ids_of += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        assert not wrong.any()
    assert ids_of == library.encode(texts)
    assert out == [t.replace("▁", " ") for t in texts]


def test_broken_bytes_are_replaced():
    made = pieces.codec(MODEL)
    first_byte = made.model.kinds.index(pieces.BYTE)
    import numpy as np

    assert made.decode_texts(np.array([first_byte + 0xE3]), np.array([0, 1])) == ["�"]


def _field(number: int, value: int | float | bytes) -> bytes:
    def varint(n: int) -> bytes:
        out = b""
        while n > 0x7F:
            out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
        return out + bytes([n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    return varint(number << 3) + varint(value)


def unigram_model(path: str, remove_extra_spaces: int) -> None:
    """A small model written by hand: no model is trained here."""
    rows = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL), ("</s>", 0.0, pieces.CONTROL)]
    rows += [(f"<0x{i:02X}>", 0.0, pieces.BYTE) for i in range(256)]
    rows += [(p, -float(i) / 3 - 2, pieces.NORMAL) for i, p in enumerate(["▁", "a", "b", "▁a", "ab", "▁ab", "abb", "c", "▁c", "ca"])]
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in rows)
    data += _field(2, _field(3, pieces.UNIGRAM) + _field(35, 1))
    data += _field(3, _field(1, b"identity") + _field(3, 1) + _field(4, remove_extra_spaces) + _field(5, 1))
    with open(path, "wb") as file:
        file.write(data)


@pytest.mark.parametrize("remove_extra_spaces", [0, 1])
def test_unigram_model(tmp_path, remove_extra_spaces):
    path = str(tmp_path / "unigram.model")
    unigram_model(path, remove_extra_spaces)
    made = pieces.Codec(path)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert made.model.kind == pieces.UNIGRAM and made.by_segments is not bool(remove_extra_spaces)
    texts = ["abba cab", "", "  ab   c ", "aé b", "ccc", "z"]
    got = []
    for ids, at, _ in made.encode_texts(words.as_binary(pa.array(texts))):
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert got == library.encode(texts)
    assert not made.differing


def test_a_difference_is_counted_and_mended(tmp_path):
    made = pieces.Codec(MODEL)
    right = made.tokenizer

    class Wrong:
        def encode_batch_fast(self, texts, add_special_tokens):
            return right.encode_batch_fast([t.replace("b", "c") for t in texts], add_special_tokens=False)

    made.tokenizer = Wrong()
    ids, at, wrong = next(made.encode_texts(words.as_binary(pa.array(["a b", "a c"]))))
    assert wrong.tolist() == [1, 0]
    assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == made.library.encode(["a b", "a c"])
