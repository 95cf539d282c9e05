"""A training corpus from raw documents, in five stages.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that the one before it kept. Its
result is written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs``. Missing doc_ids and texts are kept unless a stage's own rule drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpath.llm import lines, mixing, near_duplicates, pieces, toxicity
from clickpath.storage import stored

# A document is dropped as toxic from this score on: the one from which the operator itself calls a text toxic.
DROP_TOXIC = toxicity.THRESHOLD


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model finds toxic go; it learns from the training rows of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = toxicity.scorer(toxicity.learn_from_labels(docs, labels))
    return docs.where(toxic(F.col("text")) < DROP_TOXIC)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines are cut from the later texts; a text that is nothing else goes."""
    cut = (
        lines.drop_repeated_lines(docs, by_words=True).where(F.col("n_removed") > 0)
        .select(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash"),
                F.col("n_removed").alias("cut_lines"), F.col("n_lines").alias("all_lines"), F.col("kept_text").alias("cut_text"))
        .dropDuplicates(["cut_id", "cut_hash"])
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = whole.join(cut, F.col("row.doc_id").eqNullSafe(F.col("cut_id")) & (F.xxhash64("row.text") == F.col("cut_hash")), "left")
    kept = joined.where(F.col("cut_hash").isNull() | (F.col("cut_lines") < F.col("all_lines")))
    text = F.when(F.col("cut_hash").isNull(), F.col("row.text")).otherwise(F.col("cut_text"))
    replaced = {"text": text, "n_chars": F.char_length(text)}
    return kept.select(*[replaced.get(f.name, F.col(f"row.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: the smallest doc_id, and of its texts and rows any one.

    Rows are told apart by doc_id and text, so a text does not go because another one has its doc_id.
    Rows without a doc_id and those without words stay.
    """
    found = near_duplicates.near_duplicates(docs).where(F.col("component").isNotNull())
    texts = found.groupBy("doc_id", "text_hash").agg(F.first("component").alias("component"), F.max("kept").alias("kept"), F.count("*").alias("rows"))
    texts = stored(texts, "near-texts")
    # a group's smallest doc_id may have several texts of the group
    chosen = texts.where("kept").groupBy("component").agg(F.min("text_hash").alias("chosen"))
    judged = stored(texts.join(chosen, "component", "left"), "near-judged")
    stays = F.col("kept") & (F.col("text_hash") == F.col("chosen"))
    copy = [F.col("doc_id").alias("copy_id"), F.col("text_hash").alias("copy_hash")]
    dropped = stored(judged.where(~stays).select(*copy), "near-copies")
    repeated = stored(judged.where(stays & (F.col("rows") > 1)).select(*copy), "near-repeated")

    def of(rows: DataFrame, copies: DataFrame, how: str) -> DataFrame:
        return rows.join(copies, (F.col("row.doc_id") == F.col("copy_id")) & (F.xxhash64("row.text") == F.col("copy_hash")), how)

    rows = of(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), dropped, "left_anti")
    if not repeated.isEmpty():
        one = of(rows, repeated, "inner").dropDuplicates(["copy_id", "copy_hash"]).select("row")
        rows = of(rows, repeated, "left_anti").unionByName(one)
    return rows.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice, as rows of their own."""
    keys = ["key_id", "key_missing", "key_text", "key_source", "key_sourceless"]

    def keyed(df: DataFrame, doc_id: str, text_hash, source: str) -> DataFrame:
        values = [
            F.coalesce(F.col(doc_id), F.lit(0)), F.col(doc_id).isNull(), F.coalesce(text_hash, F.lit(0)),
            F.coalesce(F.col(source), F.lit("")), F.col(source).isNull(),
        ]
        return df.withColumns(dict(zip(keys, values)))

    taken = mixing.mix(docs)
    taken = keyed(taken, "doc_id", F.col("text_hash"), "source").groupBy(*keys).agg(
        F.sum("copies").alias("mix_copies"), F.count("*").alias("mix_rows")
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = keyed(whole, "row.doc_id", F.xxhash64("row.text"), "row.source").join(taken, keys)
    # rows that are the same in all of this share their copies
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    each = F.floor(F.col("mix_copies") / F.col("mix_rows"))
    rest = F.col("mix_copies") - each * F.col("mix_rows")
    copies = (each + (place <= rest).cast("int")).cast("int")
    return joined.withColumn("copies", copies).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with what they decode to."""
    import public_tokenizers

    done = pieces.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "n_differing",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode_pieces),
]

# The first stage's model has no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
