"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions.

``source_targets`` clamps each source at ``most`` epochs and shares the rest by weight among the
others until none is above its cap. A share per unit of weight (the level) clamps exactly the sources
with the smallest caps per weight, so ordering them by that ratio gives the fixed point of the rounds.

``mix`` turns the targets into copies of documents. A source's rate (target over size) is at most
``most``. Its documents are dealt into buckets by a seeded hash, ordered by size within a bucket, and
document ``i`` takes ``floor(rate * i + u) - floor(rate * (i - 1) + u)`` copies with ``u`` seeded by
bucket. So every document gets the rate rounded down or up, and neighbours in size make up for each
other: a bucket's words are off by one document's size at most.

Cases: null text has size 0; a null source is a source of its own, the last one; sources without
words get target 0, and their documents no copies; an empty table gives an empty one. Repeated rows
are documents of their own. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.storage import stored

WORD = r"[^\x20\x09-\x0D]+"

# rows of a bucket that one task orders
BUCKET_ROWS = 4096


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")


def _seeded(seed: int, *parts: Column) -> Column:
    """A number below 2**32 from the seed and the parts; null parts count as empty."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Rows (source, source_size, documents) with weight and target; one task handles one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    below, above = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    ranked = (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int")))
        .withColumn("most_words", F.col("source_size") * F.lit(most))
        .withColumn("ratio", F.col("most_words") / F.col("weight"))
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(every))
    )
    level = (F.col("budget") - F.coalesce(F.sum("most_words").over(below), F.lit(0))) / F.sum("weight").over(above)
    leveled = ranked.withColumn("level", level).withColumn("place", F.row_number().over(by_ratio))
    # the first source that its level does not fill: those before it are clamped, it and those after share this level
    first_free = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("place", "level"))).over(every)
    free = F.col("place") >= F.col("first_free.place")
    return leveled.withColumn("first_free", first_free).select(
        "source",
        "source_size",
        "documents",
        "weight",
        F.when(free, F.col("weight") * F.col("first_free.level"))
        .otherwise(F.col("most_words").cast("double"))
        .alias("target"),
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 7,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Copies of each document: doc_id, source, size, source_size, target, copies, taken, text_hash.

    ``weights`` go to the sources in order of their names, from the start again when used up; ``share``
    is the words of the mix over the words there are; ``most`` the epochs no source may pass.
    """
    sized = stored(
        docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("text_hash")),
        "mix-sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    # renamed, so that neither side's column hides the other's
    plan = stored(source_targets(sizes, weights, share, most), "mix-plan").withColumnRenamed("source", "plan_source")
    buckets = F.ceil(F.col("documents") / bucket_rows)
    ordered = Window.partitionBy("source", "bucket").orderBy("size", "draw", "doc_id", "text_hash")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("draw", _seeded(seed, F.col("doc_id")))
        .withColumn("bucket", F.col("draw") % buckets)
        .withColumn("place", F.row_number().over(ordered))
        .withColumn("rate", rate)
        .withColumn("offset", _seeded(seed, F.col("source"), F.col("bucket")) / F.lit(2.0**32))
        .withColumn(
            "copies",
            F.floor(F.col("rate") * F.col("place") + F.col("offset"))
            - F.floor(F.col("rate") * (F.col("place") - 1) + F.col("offset")),
        )
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"), "text_hash",
        )
    )


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP6_SQL = r"""
with sized as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sizes as (
  select source, sum(size)::bigint as source_size, count(*) as documents from sized group by source),
ranked as (
  select *, 2 * source_size as most_words, (2 * source_size) / weight as ratio,
         1.5::double * sum(source_size) over () as budget
  from (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from sizes)),
leveled as (
  select *, (budget - coalesce(sum(most_words) over (order by ratio, source nulls last
                        rows between unbounded preceding and 1 preceding), 0)::bigint)
            / sum(weight) over (order by ratio, source nulls last
                        rows between current row and unbounded following) as level,
         row_number() over (order by ratio, source nulls last) as place
  from ranked),
free as (select min(place) as first_free, arg_min(level, place) as free_level from leveled where ratio > level),
plan as (
  select source, source_size, documents,
         case when place >= first_free then weight * free_level else most_words::double end as target
  from leveled, free),
drawn as (
  select d.doc_id, d.size, p.source_size, p.target, d.source,
         ('0x' || substr(md5('7:' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint as draw, p.documents
  from sized d join plan p on d.source is not distinct from p.source),
bucketed as (select *, draw % ceil(documents / 4096)::bigint as bucket from drawn),
placed as (
  select *, row_number() over (partition by source, bucket order by size, draw, doc_id) as place,
         case when source_size > 0 then target / source_size else 0.0::double end as rate,
         ('0x' || substr(md5('7:' || coalesce(source, '') || ':' || bucket), 1, 8))::bigint / 4294967296.0::double as shift
  from bucketed),
taken as (
  select *, (floor(rate * place + shift) - floor(rate * (place - 1) + shift))::bigint as copies from placed)
select doc_id, size, source_size, target, copies * size as taken, copies from taken
"""
