"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Shingles are five consecutive words (all words of a shorter text). Each shingle is hashed once; the
highest bits of the hash pick one of 128 bins and each bin keeps its smallest hash. An empty bin takes
the value of another one: bin ``j`` asks the bins ``step * t + shift`` for t = 0, 1, ... with its own
odd step and its own shift until one is filled, so every bin chooses by itself and any two texts ask
in the same order. A fingerprint stores the eight low-order bits of each bin as two hex digits. Two
fingerprints of unlike texts agree in a bin by chance with probability 1/256, which ``likeness`` takes out.

Cases: a text without words has the empty fingerprint; it is like another such text (1.0) and unlike
all others (0.0). Null text counts as empty. Rows that agree in doc_id and text are one document, with
a result for each row. A missing doc_id comes first. Other columns are not read. All of it is built-in
expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.storage import stored

from .mixing import WORD

BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8
SHINGLE = 5
# asked at once before the whole round of bins is
FIRST_ASKED = 16


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shingles(text: Column) -> Column:
    words = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))

    def cut(h: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])
        )
        return F.when(F.size(h) >= SHINGLE, each).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
            F.array().cast("array<bigint>")
        )

    return _let(words, cut)


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BIN_BITS).cast("int")


def _minima(hashes: Column) -> Column:
    """The smallest hash of each bin, null for an empty bin."""

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1))))

    def by_bin(m: Column) -> Column:
        def place(bins: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), F.lit(BINS - 1)),
                lambda j: F.get(m, F.nullif(F.array_position(bins, j), F.lit(0)).cast("int") - 1),
            )

        return _let(F.transform(m, _bin), place)

    return _let(_let(F.sort_array(hashes), firsts), by_bin)


def _densified(minima: Column) -> Column:
    def asked(m: Column, j: Column, how_many: int) -> Column:
        seed = F.xxhash64(j)
        step, shift = seed.bitwiseAND(F.lit(BINS - 1)).bitwiseOR(F.lit(1)), F.shiftrightunsigned(seed, 32)
        found = F.filter(
            F.transform(
                F.sequence(F.lit(0), F.lit(how_many - 1)),
                lambda t: F.get(m, (step * t + shift).bitwiseAND(F.lit(BINS - 1)).cast("int")),
            ),
            lambda v: v.isNotNull(),
        )
        return F.get(found, F.lit(0))

    def fill(m: Column) -> Column:
        return F.transform(m, lambda v, j: F.coalesce(v, asked(m, j, FIRST_ASKED), asked(m, j, BINS)))

    return _let(minima, fill)


def fingerprint(text: Column) -> Column:
    """Low-order bits of each bin, one small number each; an empty array for a text without words."""

    def pack(s: Column) -> Column:
        low = F.transform(_densified(_minima(s)), lambda v: v.bitwiseAND(F.lit((1 << LOW_BITS) - 1)).cast("smallint"))
        return F.when(F.size(s) > 0, low).otherwise(F.array().cast("array<smallint>"))

    return _let(_shingles(F.coalesce(text, F.lit(""))), pack)


def packed(bins: Column) -> Column:
    return F.array_join(F.transform(bins, lambda v: F.lpad(F.lower(F.hex(v.cast("bigint"))), LOW_BITS // 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1, with chance agreement taken out."""
    chance = 2.0**-LOW_BITS
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), (same - chance) / (1 - chance)))
    )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_chars and bins of every distinct document."""
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"),
        fingerprint(F.col("text")).alias("bins"),
    ).dropDuplicates(["doc_id", "text_hash"])


def with_next(prints: DataFrame) -> DataFrame:
    """Each row with ``next``, the row after it by doc_id; after the last comes the first.

    Rows are dealt by ranges of doc_id; within a range a window finds the next row, and the first row
    of each range (one row per range) serves the last of the range before.
    """
    whole = F.struct("doc_id", "text_hash", "bins")
    ranged = stored(
        prints.repartitionByRange("doc_id", "text_hash").withColumn("part", F.spark_partition_id()), "print-ranges"
    )
    heads = ranged.groupBy("part").agg(F.min(whole).alias("head"))
    by_part = Window.orderBy("part")
    after = heads.select(
        F.col("part").alias("head_part"),
        F.coalesce(F.lead("head").over(by_part), F.first("head").over(by_part)).alias("next_head"),
    )
    inside = Window.partitionBy("part").orderBy("doc_id", "text_hash")
    return (
        ranged.withColumn("following", F.lead(whole).over(inside))
        .join(after, F.col("part") == F.col("head_part"))
        .withColumn("next", F.coalesce("following", "next_head"))
        .select("doc_id", "text_hash", "n_chars", "bins", "next")
    )


def edited_halves(docs: DataFrame) -> DataFrame:
    """Every document with its fingerprint, the next one's, and its text with the last half replaced from the next."""
    links = stored(with_next(stored(document_fingerprints(docs), "prints")), "print-links")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash"))

    def same(prefix: str) -> Column:
        return F.col("doc_id").eqNullSafe(F.col(f"{prefix}_id")) & (F.col("text_hash") == F.col(f"{prefix}_hash"))

    half = F.floor(F.col("n_chars") / 2).cast("int")
    needs = links.select(
        F.col("next.doc_id").alias("after_id"),
        F.col("next.text_hash").alias("after_hash"),
        F.col("doc_id").alias("tail_id"),
        F.col("text_hash").alias("tail_hash"),
        half.alias("wanted"),
    )
    tails = (
        texts.join(needs, same("after"))
        .groupBy("tail_id", "tail_hash")
        .agg(F.any_value(F.substring(F.col("text"), F.lit(1), F.col("wanted"))).alias("tail"))
    )
    own = links.select(
        F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "n_chars", "bins",
        F.col("next.bins").alias("next_bins"),
    )
    return (
        texts.join(own, same("own"))
        .join(tails, same("tail"))
        .select(
            "doc_id", "n_chars", "bins", "next_bins",
            F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), "tail").alias("edited"),
        )
    )


def op5_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = edited_halves(docs).withColumn("edited_bins", fingerprint(F.col("edited")))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )
