"""Line dedup: winnowing over line hashes.

Lines are the parts of a text between newlines. A run of lines is repeated when the same lines follow
each other at an earlier place: in a document with a smaller doc_id, or further up in the same one.
``drop_repeated_lines`` removes every line that lies in a repeated run of at least ``run`` lines, or
that is itself repeated and has at least ``long_words`` words. With ``by_words`` a shorter run, of two
lines up to ``run - 1``, goes as well when its lines have ``long_words`` words together. ``op8_line_dedup``
keeps to the rule of its SQL, which has no such runs, and so does the pipeline.

1. Winnowing: of each ``run`` consecutive lines the one with the smallest hash (the last of equals) is
   the fingerprint. Equal runs choose equal fingerprints, so no run of ``run`` lines can escape. Long
   lines, and with ``by_words`` the first lines of shorter runs with enough words, are fingerprints besides.
2. Positions are joined: a fingerprint that occurs at one place only is dropped.
3. Matches are extended both ways: each remaining position opens the windows of ``run`` lines around
   it, and these are compared with the first place of the same window. Overlapping windows make up the
   whole repeated run, however long.
4. The lines under later windows are deleted.

Only first places are joined, so a line that occurs everywhere costs a row per place and no pairs.

Lines are told apart by 64 bits where fingerprints are looked for and by 96 where windows are equal.

Cases: null text counts as no lines and stays null; a text of any number of lines is cut without holding more than a
few hashes per line; of equal lines in a window the last is its minimum; a text without newline is one line; rows that
agree in doc_id and text are one document and get one result; documents without a doc_id come first.
Nothing is read of other columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.storage import stored

from .mixing import WORD

RUN = 3
LONG_WORDS = 50


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _places(docs: DataFrame, run: int, long_words: int, by_words: bool) -> DataFrame:
    """A row per fingerprint: its hash, its document and the windows it lies in.

    A row holds the lines beside its own and no others, so a text of any number of lines takes room in proportion.
    """
    lines = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), _lines("text").alias("lines"))
    # texts stay where they are read: only the numbers of their lines are shuffled
    hashed = lines.select(
        "doc_id",
        "text_hash",
        F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
        # a second hash of another kind, which tells windows apart along with the first
        F.transform("lines", lambda x: F.hash(x)).alias("others"),
        F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"),
    ).dropDuplicates(["doc_id", "text_hash"])
    # lines i - back to i + ahead of a document; a place outside has no line
    back, ahead = run - 1, run - 1

    def beside(name: str, i: Column) -> Column:
        return F.array(*[F.get(F.col(name), i + step) for step in range(-back, ahead + 1)])

    near = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - 1),
        lambda i: F.struct(
            beside("hashes", i).alias("hashes"), beside("others", i).alias("others"),
            F.array(*[F.get(F.col("words"), i + step) for step in range(ahead + 1)]).alias("words"),
        ),
    )
    rows = hashed.select("doc_id", "text_hash", F.posexplode(near).alias("line", "near"))
    i, hash = F.col("line").cast("int"), F.get(F.col("near.hashes"), F.lit(back))

    def at(step: int, name: str = "hashes") -> Column:
        return F.get(F.col(f"near.{name}"), F.lit(back + step))

    def key(first: int, size: int) -> Column:
        steps = range(first, first + size)
        return F.struct(
            F.xxhash64(F.lit(size), *[at(step) for step in steps]).alias("one"), F.hash(*[at(step, "others") for step in steps]).alias("two")
        )

    # windows of ``run`` lines that hold line i, by the step to their first one
    starts = range(-back, 1)
    inside = {s: at(s).isNotNull() & at(s + run - 1).isNotNull() for s in starts}

    def smallest(s: int) -> Column:
        """Whether line i is the smallest of the window from s on, the last of equals."""
        test = F.lit(True)
        for step in range(s, s + run):
            test = test & (hash < at(step) if step > 0 else hash <= at(step))
        return test

    is_minimum = F.lit(False)
    for s in starts:
        is_minimum = is_minimum | F.when(inside[s], smallest(s)).otherwise(F.lit(False))

    def window(s: int, size: int, ok: Column) -> Column:
        return F.when(ok, F.struct((i + s).alias("start"), F.lit(size).alias("length"), key(s, size).alias("window")))

    def worded(size: int) -> Column:
        """Whether the ``size`` lines from i on have enough words together."""
        total = sum((F.get(F.col("near.words"), F.lit(step)) for step in range(1, size)), F.get(F.col("near.words"), F.lit(0)))
        return at(size - 1).isNotNull() & (total >= long_words)

    by_count = {size: worded(size) for size in range(1, run if by_words else 2)}
    is_worded = F.lit(False)
    for ok in by_count.values():
        is_worded = is_worded | F.coalesce(ok, F.lit(False))
    windows = [window(0, size, ok) for size, ok in by_count.items()]
    windows += [F.when(F.col("minimum"), window(s, run, inside[s])) for s in starts]
    return (
        rows.withColumn("minimum", is_minimum)
        .where(F.col("minimum") | is_worded)
        .select("doc_id", "text_hash", "line", hash.alias("hash"), F.filter(F.array(*windows), lambda w: w.isNotNull()).alias("windows"))
    )


def repeated_line_windows(
    docs: DataFrame, run: int = RUN, long_words: int = LONG_WORDS, by_words: bool = False
) -> DataFrame:
    """Windows of lines seen before: doc_id, text_hash, start, length, and the first place they occur at."""
    place = F.struct("doc_id", "text_hash", "line")
    marks = stored(_places(docs, run, long_words, by_words), "line-fingerprints")
    seen = stored(
        marks.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("z")).where("a < z").select("hash"),
        "line-repeated",
    )
    windows = stored(
        marks.join(seen, "hash").select("doc_id", "text_hash", F.explode("windows").alias("w"))
        .select("doc_id", "text_hash", "w.*").distinct(),
        "line-windows",
    )
    here = F.struct("doc_id", "text_hash", "start")
    first = stored(
        windows.groupBy("window").agg(F.min(here).alias("first"), F.max(here).alias("last"))
        .where("first < last").select("window", "first"),
        "line-first",
    )
    return (
        windows.join(first, "window")
        .where(F.col("first") < here)
        .select("doc_id", "text_hash", "start", "length", F.col("first.doc_id").alias("first_doc_id"),
                F.col("first.start").alias("first_start"))
    )


def drop_repeated_lines(
    docs: DataFrame, run: int = RUN, long_words: int = LONG_WORDS, by_words: bool = False
) -> DataFrame:
    """doc_id, text, n_lines, n_removed, kept_text, text_hash of every row of ``docs``."""
    cuts = (
        repeated_line_windows(docs, run, long_words, by_words)
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.expr("sequence(start, start + length - 1)"))))).alias("cuts"))
        .withColumnsRenamed({"doc_id": "cut_doc_id", "text_hash": "cut_text_hash"})
    )
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    joined = rows.join(
        cuts, F.col("doc_id").eqNullSafe(F.col("cut_doc_id")) & (F.col("text_hash") == F.col("cut_text_hash")), "left"
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("cuts"))
    return (
        joined.withColumn("lines", _lines("text"))
        .select(
            "doc_id",
            "text",
            F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
            F.coalesce(F.when(F.col("cuts").isNotNull(), F.size("cuts")), F.lit(0)).cast("bigint").alias("n_removed"),
            F.when(F.col("cuts").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n"))
            .alias("kept_text"),
            "text_hash",
        )
    )


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digests = drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
    # as many files as the digests fill, not one per partition of texts
    return digests.hint("rebalance", "doc_id")


def op8_sql(table: str = "documents", run: int = RUN, long_words: int = LONG_WORDS) -> str:
    """The same lines removed, from the windows of all lines and no fingerprints."""
    keys = "], l[i + ".join(str(step) for step in range(run))
    return rf"""
with d as (select doc_id, text, string_split(text, chr(10)) as l from {table}),
w as (
  select doc_id, i as start, {run} as length, [l[i + {keys}]] as win
  from (select doc_id, l, unnest(range(1, len(l) - {run} + 2)) as i from d)
  union all
  select doc_id, i, 1, [l[i]]
  from (select doc_id, l, unnest(range(1, len(l) + 1)) as i from d)
  where len(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) >= {long_words}),
later as (
  select doc_id, start, length
  from (select *, row_number() over (partition by win order by doc_id, start) as n from w) where n > 1),
cut as (select distinct doc_id, unnest(range(start, start + length)) as line from later),
kept as (
  select d.doc_id, len(l) as n_lines, list_filter(range(1, len(l) + 1), lambda i: not list_contains(coalesce(c.lines, []), i)) as keep, l
  from d left join (select doc_id, list(line) as lines from cut group by doc_id) c using (doc_id))
select doc_id, n_lines::bigint as n_lines, (n_lines - len(keep))::bigint as n_removed,
       sha256(array_to_string(list_transform(keep, lambda i: l[i]), chr(10))) as kept_sha256
from kept
"""


OP8_SQL = op8_sql()
