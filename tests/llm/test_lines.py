from __future__ import annotations

import duckdb
import pytest

from checks.compare import difference, duck, expected_of
from clickpath.llm import lines
from clickpath.storage import stored
from . import brute
from .conftest import SMOKE, pairs, prose


def found(df) -> dict:
    return {(r["doc_id"], r["text"]): (r["n_lines"], r["n_removed"], r["kept_text"]) for r in lines.drop_repeated_lines(df).collect()}


@pytest.mark.parametrize("table", ["awkward", "clashing", "smoke", "nothing"])
def test_equals_brute_force(request, table):
    df = request.getfixturevalue(table)
    assert found(df) == brute.without_repeated_lines(pairs(df))
    assert lines.drop_repeated_lines(df).count() == df.count()


def test_equals_the_sql(spark):
    assert difference(lines.op8_line_dedup(spark, SMOKE), expected_of(duck(SMOKE), lines.OP8_SQL)) is None


def test_later_runs_go(spark):
    shared, passage = "l1\nl2\nl3\nl4", prose(1, 55, 55)
    rows = [(1, f"a\n{shared}\nb"), (2, f"l1\nc\n{shared}"), (3, f"l2\nl3\n{passage}"), (4, f"x\n{passage}\ny"), (5, "l1\nl2\nz")]
    out = found(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = {doc_id: text for (doc_id, _), (_, _, text) in out.items()}
    assert kept == {1: f"a\n{shared}\nb", 2: "l1\nc", 3: f"l2\nl3\n{passage}", 4: "x\ny", 5: "l1\nl2\nz"}


def test_sql_reads_any_table():
    connection = duckdb.connect()
    connection.execute("create table t as select 1 as doc_id, 'a' as text")
    assert connection.sql(lines.op8_sql("t")).fetchall()[0][:3] == (1, 1, 0)


def cut_by_words(docs: list[tuple], run: int = 3, long_words: int = 50) -> dict:
    """doc_id to kept text, by every window of up to ``run`` lines that is long enough in lines or words."""
    places, out = {}, {}
    for doc_id, text in sorted(docs):
        parts, gone = text.split("\n"), set()
        for size in range(1, run + 1):
            for j in range(len(parts) - size + 1):
                window = tuple(parts[j : j + size])
                if size == run or sum(len(brute.words(x)) for x in window) >= long_words:
                    if places.setdefault(window, (doc_id, j)) != (doc_id, j):
                        gone |= set(range(j, j + size))
        out[doc_id] = "\n".join(x for j, x in enumerate(parts) if j not in gone)
    return out


def test_runs_are_judged_by_words(spark):
    two, few = prose(70, 54, 27), prose(71, 40, 20)
    inner = two.split("\n")
    rows = [
        (1, f"a\n{two}\nb"), (2, two), (3, f"x\n{two}\ny"), (4, few), (5, few), (6, f"{inner[0]}\nz\n{inner[1]}"),
        (7, f"{two}\nend\n{two}"), (8, f"{inner[1]}\n{inner[0]}"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r["kept_text"] for r in lines.drop_repeated_lines(df, by_words=True).collect()}
    assert kept == cut_by_words(rows)
    assert (kept[2], kept[3], kept[5], kept[7]) == ("", "x\ny", few, "end")


def test_given_documents_are_judged_by_words(spark):
    df = spark.read.parquet(SMOKE.replace("sf0.001", "sf0.01") + "/documents.parquet").where("text is not null")
    kept = {r["doc_id"]: r["kept_text"] for r in lines.drop_repeated_lines(df, by_words=True).collect()}
    assert kept == cut_by_words(pairs(df))


def test_a_text_of_very_many_lines(spark):
    """The work per line does not depend on the number of lines."""
    lines_of = [f"line {i * 7919 % 100_003}" for i in range(100_000)]
    rows = [(1, "\n".join(lines_of)), (2, "\n".join(["new", *lines_of[20_000:80_000], "end"])), (3, "\n".join(x for i, x in enumerate(lines_of) if i % 5))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute.without_repeated_lines(rows)


def shuffled_types(df) -> list[set]:
    """The types of the columns that each exchange of the plan passes on."""
    found, todo = [], [df._jdf.queryExecution().executedPlan().initialPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append({node.output().apply(i).dataType().simpleString() for i in range(node.output().size())})
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.mark.parametrize("by_words", [False, True])
def test_no_text_is_shuffled_for_fingerprints(smoke, monkeypatch, by_words):
    plans = {}

    def recorded(df, label):
        plans[label] = shuffled_types(df)
        return stored(df, label)

    monkeypatch.setattr(lines, "stored", recorded)
    lines.repeated_line_windows(smoke, by_words=by_words)
    assert plans["line-fingerprints"]
    for types in plans["line-fingerprints"]:
        assert not any("string" in name for name in types)


def test_digests_fill_few_files(spark, tmp_path):
    """The texts' join has many partitions; what is returned is a small part of them."""
    rows = [(i, prose(i, 2000)) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        lines.op8_line_dedup(spark, str(tmp_path)).write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advised)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1


def test_documents_that_come_twice_are_one(spark):
    """Equal rows do not repeat each other, and every one of them loses the same lines."""
    shared = "l1\nl2\nl3"
    rows = [(1, f"a\n{shared}"), (1, f"a\n{shared}"), (2, f"{shared}\nb"), (2, f"{shared}\nb"), (None, "c\nd\ne"), (None, "c\nd\ne")]
    out = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r["doc_id"] or 0, r["kept_text"]) for r in out) == [(0, "c\nd\ne")] * 2 + [(1, f"a\n{shared}")] * 2 + [(2, "b")] * 2
