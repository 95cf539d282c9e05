from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SMOKE = "/root/testdata/sf0.001"

# names that the operators use for columns of their own
CLASHING = [
    "n_words", "n_removed", "kept", "size", "bucket", "copies", "key", "node", "row", "chunk", "label", "score", "start", "ids",
    "part", "text_hash", "tail", "next", "bins", "draw", "place", "rate", "training", "held_out", "dropped", "cut_text", "col",
]

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int"


# two words that polynomial hashes modulo 2**64 cannot tell apart
TWINS = ["".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(2048)) for flip in (0, 1)]


def prose(seed: int, n: int, per_line: int = 12) -> str:
    draw = random.Random(seed)
    w = ["".join(draw.choices("abcdeghilmnorstu", k=draw.randint(2, 7))) for _ in range(n)]
    return "\n".join(" ".join(w[i : i + per_line]) for i in range(0, n, per_line))


def edited(text: str, every: int) -> str:
    w = text.split(" ")
    return " ".join("changed" if i % every == every - 1 else x for i, x in enumerate(w))


def awkward_rows() -> list[tuple]:
    a, b, passage = prose(1, 130), prose(2, 400), prose(3, 60, 60)
    rows = [
        (None, prose(4, 40), "en", "s1", 5),
        (None, None, None, None, None),
        (1, None, "en", None, None),
        (2, "", "en", "s1", 0),
        (3, " \t\n\r\x0b\x0c ", "en", "s2", 7),
        (4, a, "en", "s1", 1),
        (5, a, None, "s1", 1),
        (6, a + "\n" + b, "en", "s3", 1),
        (7, b, "en", "s1", 1),
        (8, edited(b, 90), "en", "s1", 1),
        (8, edited(b, 90), "en", "s1", 1),
        (9, edited(b, 91), "en", None, 1),
        (10, "one", "en", "s1", 3),
        (11, "One", "en", "é", 3),
        (12, "one two three four", "en", "s1", 18),
        (13, "one two three four five", "en", "s1", 23),
        (14, " ".join(f"w{i}" for i in range(13)), "en", "s1", 1),
        (15, "x " + " ".join(f"w{i}" for i in range(13)) + " y", "en", "s1", 1),
        (16, prose(5, 30) + "\n" + passage + "\n" + prose(6, 30), "en", "s4", 1),
        (17, prose(7, 30) + "\n" + passage, "de", "s4", 1),
        (18, "ß é 日本語 \U0001f600 ▁ <s> <0x0A> <|endoftext|> á ́b İ ſ", "de", "s2", 1),
        (19, prose(8, 30_000), "en", "s1", 1),
        (20, "same line\n" * 50, "en", "s1", 1),
        (21, "   lead and   trail   ", "en", "s1", 1),
        (-5, prose(9, 20), "en", "s1", 1),
        (22, TWINS[0], "en", "s1", 1),
        (23, TWINS[1], "en", "s1", 1),
        (24, " ".join([f"v{i}" for i in range(12)] + [TWINS[0]]), "en", "s1", 1),
        (25, " ".join([f"v{i}" for i in range(12)] + [TWINS[1]]), "en", "s1", 1),
        (26, "see <|ENDOFTEXT|> here, <|EndOfText|>. <|startoftext|>", "en", "s1", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with columns whose names the operators use."""
    return awkward.withColumns({c: F.lit(-1) for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def smoke(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet")


def pairs(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
