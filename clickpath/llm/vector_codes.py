"""Vector code compression: parts of vectors as numbers of codebook entries, by value dictionaries.

Components become whole numbers, ``floor(scale * x)``, and vectors are cut into ``parts`` equal pieces. The codebook
of a piece starts as that piece of the first vectors; in each round every piece goes to the nearest entry
of its codebook (ties to the lower number) and every entry becomes the mean of its pieces, rounded down; an entry
without pieces stays. Afterwards pieces are coded once more.

1. Vectors are packed once into blocks: per dimension the sorted distinct values (its dictionary), and for each
   vector the numbers of its values in them. A block has the rows of one Arrow batch.
2. In a round, a block tabulates for each dimension the squared difference of every dictionary value to the
   value of every entry. The distances of a piece are rows of these tables, gathered by the codes and added up.
3. Sums and counts per entry leave each task as one row per entry and are added up by Spark. Only codebooks
   come to the driver: entries times dimensions numbers, whatever the table's size.

Numbers are 64-bit where these hold every sum of squares, and Python's own otherwise.

Cases: vectors that are null or hold a null, NaN or infinite component take no part, nor do empty ones; the others must be
as long as the first one (smallest vec_id, then smallest vector), or take no part; where ``parts`` does not divide the
length, vectors count as filled up with zeros at their end; with fewer vectors than entries there are as many
entries as vectors; rows without a vec_id come last; repeated rows are vectors of their own; components of 1e25
and more in size take no part, as no column can hold their squares; errors beyond 64 bits are given as the largest
64-bit number; an empty table gives an empty one. Columns other than vec_id, the vector and the label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.operators.skew import lookup_join
from clickpath.storage import stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

# components that are smaller than this in size take part
_LARGEST = 1e25
_MOST = 2**63 - 1

BLOCK = "vec_ids array<bigint>, labels array<string>, values array<string>, codes binary"
SUMS = "part int, entry int, dimension int, total decimal(38,0), pieces bigint"

# for each part its entries, each a list of whole numbers
Codebooks = list[list[list[int]]]


def whole_vectors(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label (as text) and floor(scale * component), still as doubles, of the rows that take part."""
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_LARGEST)))
    return (
        table.select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.col(label).cast("string").alias("label"),
            F.col(vector).cast("array<double>").alias("v"),
        )
        .where(F.col("v").isNotNull() & (F.size("v") > 0))
        .where(usable)
        # adding zero makes one zero of both
        .withColumn("v", F.transform("v", lambda c: F.expr("0D") + F.lit(float(scale)) * c))
    )


def _floored(flat: np.ndarray) -> np.ndarray:
    """Doubles rounded down, as 64-bit numbers where they fit and as Python's otherwise."""
    down = np.floor(flat)
    if np.abs(down).max(initial=0) < 2.0**62:
        return down.astype(np.int64)
    return np.array([int(x) for x in down.tolist()], dtype=object)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch, all of the same length, filled up with zeros to ``width``."""
    flat = _floored(lists.flatten().to_numpy(zero_copy_only=False))
    found = flat.reshape(len(lists), -1)
    out = np.zeros((len(lists), width), dtype=found.dtype)
    out[:, : found.shape[1]] = found
    return out


def _pack(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values, codes = [], []
            for column in _matrix(batch.column("v"), width).T:
                distinct, code = np.unique(column, return_inverse=True)
                values.append(" ".join(map(str, distinct.tolist())))
                codes.append(code.astype("<u4" if len(distinct) > 1 << 16 else "<u2"))
            kind = max((c.dtype for c in codes), key=lambda k: k.itemsize)
            yield pa.record_batch(
                [pa.array([batch.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([batch.column("label").to_pylist()], pa.list_(pa.string())),
                 pa.array([values], pa.list_(pa.string())),
                 pa.array([b"".join(c.astype(kind).tobytes() for c in codes)], pa.binary())],
                names=["vec_ids", "labels", "values", "codes"],
            )

    return run


def _opened(batch: pa.RecordBatch, i: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per dimension of a block: the dictionary and the codes of its vectors."""
    spelled = batch.column("values")[i].as_py()
    numbers = [[int(x) for x in text.split(" ")] for text in spelled]
    wide = max(max(abs(v[0]), abs(v[-1])) for v in numbers) >= 2**62
    values = [np.array(v, dtype=object if wide else np.int64) for v in numbers]
    rows = len(batch.column("vec_ids")[i])
    raw = batch.column("codes")[i].as_buffer()
    kind = "<u2" if raw.size == 2 * rows * len(values) else "<u4"
    return values, list(np.frombuffer(raw, kind).reshape(len(values), rows))


def _nearest(values: list[np.ndarray], codes: list[np.ndarray], codebooks: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each part: the nearest entry of every vector and the squared distance to it."""
    size = len(codebooks[0][0])
    for p, entries in enumerate(codebooks):
        mine = range(p * size, (p + 1) * size)
        largest = max(max(abs(int(values[d][0])), abs(int(values[d][-1]))) for d in mine)
        largest += max(abs(x) for e in entries for x in e)
        kind = np.int64 if size * len(codebooks) * largest**2 < 2**62 else object
        distance = np.zeros((len(codes[0]), len(entries)), dtype=kind)
        for k, d in enumerate(mine):
            table = values[d].astype(kind)[:, None] - np.array([e[k] for e in entries], dtype=kind)[None, :]
            distance += (table * table)[codes[d]]
        nearest = distance.argmin(axis=1)
        yield nearest, distance[np.arange(len(nearest)), nearest]


def _sum(codebooks: Codebooks):
    """Sums and counts of the pieces of each entry, once per task."""
    size, n = len(codebooks[0][0]), len(codebooks[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(codebooks), n, size), dtype=object)
        count = np.zeros((len(codebooks), n), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                values, codes = _opened(batch, i)
                for p, (nearest, _) in enumerate(_nearest(values, codes, codebooks)):
                    order = np.argsort(nearest, kind="stable")
                    used, first = np.unique(nearest[order], return_index=True)
                    count[p] += np.bincount(nearest, minlength=n)
                    for k in range(size):
                        d = p * size + k
                        # a batch has fewer rows than would carry these sums over 64 bits
                        small = max(abs(int(values[d][0])), abs(int(values[d][-1]))) < 1 << 40
                        added = np.add.reduceat((values[d] if small else values[d].astype(object))[codes[d][order]], first)
                        total[p, used, k] += added.astype(object)
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.record_batch(
                [pa.array(np.repeat(part, size).astype(np.int32)), pa.array(np.repeat(entry, size).astype(np.int32)),
                 pa.array(np.tile(np.arange(size, dtype=np.int32), len(part))),
                 pa.array([str(x) for x in total[part, entry].ravel()]).cast(pa.decimal128(38, 0)),
                 pa.array(np.repeat(count[part, entry], size))],
                names=["part", "entry", "dimension", "total", "pieces"],
            )

    return run


def _encode(codebooks: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values, codes = _opened(batch, i)
                found = list(_nearest(values, codes, codebooks))
                code = np.stack([nearest for nearest, _ in found], axis=1).astype(np.uint8).tobytes()
                error = sum(d.astype(object) for _, d in found).tolist()
                yield pa.record_batch(
                    [batch.column("vec_ids").slice(i, 1).flatten(), batch.column("labels").slice(i, 1).flatten(),
                     pa.array([code[at : at + len(found)].hex() for at in range(0, len(code), len(found))]),
                     pa.array([min(e, _MOST) for e in error], pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


class VectorCodes:
    """Codebooks of a table of vectors, and its codes. ``vectors`` are those of ``whole_vectors``."""

    def __init__(self, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
        if not 1 <= entries <= 256:
            raise ValueError("an entry's number must fit two hex digits")
        order = [F.col("vec_id").asc_nulls_last(), F.col("v").asc()]
        # at most ``entries`` rows
        first = vectors.select("vec_id", "v").orderBy(*order).limit(1).collect()
        self.blocks: DataFrame | None = None
        self.codebooks: Codebooks = []
        if not first:
            return
        length = len(first[0]["v"])
        same = vectors.where(F.size("v") == length)
        start = same.select("vec_id", "v").orderBy(*order).limit(entries).collect()
        size = -(-length // parts)
        rows = [_floored(np.array(r["v"])).tolist() + [0] * (size * parts - length) for r in start]
        self.codebooks = [[row[p * size : (p + 1) * size] for row in rows] for p in range(parts)]
        self.blocks = stored(same.select("vec_id", "label", "v").mapInArrow(_pack(size * parts), BLOCK), "vector-blocks")
        for _ in range(rounds):
            self._round()

    def _round(self) -> None:
        sums = self.blocks.mapInArrow(_sum(self.codebooks), SUMS).groupBy("part", "entry", "dimension")
        # one row for each number of the codebooks
        for row in sums.agg(F.sum("total").alias("total"), F.sum("pieces").alias("pieces")).collect():
            self.codebooks[row["part"]][row["entry"]][row["dimension"]] = int(row["total"]) // row["pieces"]

    def digest(self) -> str:
        """SHA-256 of all numbers of the codebooks by part, entry and place, joined by commas."""
        numbers = [str(x) for part in self.codebooks for entry in part for x in entry]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def encode(self, spark) -> DataFrame:
        """vec_id, label, code (two hex digits a part) and error of every vector."""
        if self.blocks is None:
            return spark.createDataFrame([], "vec_id bigint, label string, code string, error bigint")
        return self.blocks.mapInArrow(_encode(self.codebooks), "vec_id bigint, label string, code string, error bigint")


def with_label_errors(encoded: DataFrame) -> DataFrame:
    """``encoded`` with the errors summed over rows of the same label; rows without a label belong together."""
    encoded = stored(encoded, "vector-codes")
    total = F.least(F.sum(F.col("error").cast(T.DecimalType(38, 0))), F.lit(_MOST).cast(T.DecimalType(38, 0)))
    by_label = encoded.groupBy("label").agg(total.cast("bigint").alias("label_error"))
    return lookup_join(encoded, by_label, "label", ["vec_id", "code"], nulls_match=True)


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    made = VectorCodes(whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return with_label_errors(made.encode(spark)).select(
        "vec_id", "code", "error", "label_error", F.lit(made.digest()).alias("codebooks_sha256")
    )


def op13_sql(rounds: int = ROUNDS) -> str:
    """The same codes by plain distances: one table of codebooks and one of assignments for each round."""
    distance = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - e[i]) * (v[i] - e[i])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (
  select id, part, arg_min(entry, (d, entry)) as entry, min(d) as d
  from (select id, p.part, entry, {distance} as d from p join b{r} using (part)) group by id, part)""")
        if r < rounds:
            steps.append(f"""
b{r + 1} as materialized (
  select part, entry, coalesce(n.e, b.e) as e
  from b{r} b left join (
    select part, entry, list(m order by place) as e
    from (
      select part, entry, place, (s - ((s % c) + c) % c) // c as m
      from (
        select part, entry, place, sum(x)::bigint as s, count(*) as c
        from (select part, entry, unnest(v) as x, unnest(range(len(v))) as place from p join a{r} using (id, part))
        group by part, entry, place))
    group by part, entry) n using (part, entry))""")
    return f"""
with v as (
  select row_number() over (order by vec_id) as id, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as c
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (
  select id, part, c[part * (len(c) // {PARTS}) + 1 : (part + 1) * (len(c) // {PARTS})] as v
  from (select id, c, unnest(range({PARTS})) as part from v)),
b0 as materialized (select part, id - 1 as entry, v as e from p where id <= {ENTRIES}),
{",".join(steps)},
coded as (
  select id, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from a{rounds} group by id),
books as (
  select sha256(string_agg(array_to_string(e, ','), ',' order by part, entry)) as codebooks_sha256 from b{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from v join coded using (id) cross join books
"""


OP13_SQL = op13_sql()
