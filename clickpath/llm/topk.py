"""Exact top-k inner products by pivot-table elimination.

Distances of every vector to many pivots are computed once. Candidates are put together by their nearest pivot
in tiles, of which the least and the greatest distance to each pivot are kept. For a query q and a candidate x of
a tile, the largest gap between q's distance to a pivot and the tile's distances to it is a lower bound of
|q - x|, and with ``q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2`` that gives an upper bound of the scores in the tile.
Tiles are evaluated in the order of their bounds, for those queries only whose k-th best score is not above the
bound.

Queries and candidates are written in blocks of bounded size. Every task reads some blocks of both from their files,
nothing is shuffled or sent to the driver for it, and keeps ``k`` rows per query over all of its candidates. The
rows of a query are then ranked. Pivots are ``pivots`` vectors chosen by a seeded hash.

Cases: vectors that are null or hold a null, NaN or infinite component take no part; shorter vectors
count as filled up with zeros; equal rows count once; where one id has several vectors each takes part, and a
pair of ids has its highest score; no id is its own candidate; a missing id takes no part; ties go to the
smaller id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.storage import stored

K = 5
PIVOTS = 32
SCALE = 256
QUERY_ROWS = 16384
BLOCK_ROWS = 16384
# candidates that a task meets, unless that makes fewer tasks than TASKS_PER_CORE for each core
TASK_ROWS = 1 << 20
TASKS_PER_CORE = 4
# queries and candidates evaluated at once; their scores fit a core's cache
QUERIES_AT_ONCE = 1024
TILE_ROWS = 256

# Rows of megabytes: Parquet's writer and reader hold a row group, which by itself has 100 rows at least.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}

LEAST, GREATEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

BLOCK = "rows int, width int, size int, ids binary, vectors binary, starts binary, low binary, high binary"
QUERY_BLOCK = "rows int, width int, size int, ids binary, vectors binary, distances binary"


def scaled_vectors(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * component) of the rows that take part."""
    x = F.col("v")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        table.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & x.isNotNull())
        .where(finite)
        .select("vec_id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"))
        .distinct()
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), width), dtype=np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = lists.flatten().to_numpy()
    return out


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    v, p = vectors.astype(np.float64), pivots.astype(np.float64)
    square = (v * v).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None, :] - 2 * (v @ p.T)
    return np.sqrt(np.maximum(square, 0)).T.copy()


def _squares(vectors: np.ndarray) -> np.ndarray:
    return (vectors.astype(np.float64) ** 2).sum(axis=1)


def _by_pivot(distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of vectors by their nearest pivot and the distance to it, and the starts of tiles in that order."""
    n = distances.shape[1]
    near = distances.argmin(axis=0) if len(distances) else np.zeros(n, dtype=np.int64)
    order = np.lexsort((distances[near, np.arange(n)], near)) if len(distances) else np.arange(n)
    bounds = [*np.flatnonzero(np.diff(near[order], prepend=-1)).tolist(), n]
    return order, np.array([i for a, b in zip(bounds, bounds[1:]) for i in range(a, b, TILE_ROWS)], dtype=np.int64)


class _Candidates:
    """A block of candidates in tiles; ``low`` and ``high`` hold each tile's distances to each pivot."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, starts: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.ids, self.vectors, self.low, self.high = ids, vectors, low, high
        self.tiles = list(zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]))
        self.squares = np.maximum.reduceat(_squares(vectors), starts)
        self.repeated = len(ids) - len(np.unique(ids))
        self._typed: dict[type, np.ndarray] = {}

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray) -> _Candidates:
        order, starts = _by_pivot(distances)
        ordered = distances[:, order]
        low, high = (f.reduceat(ordered, starts, axis=1) for f in (np.minimum, np.maximum))
        return cls(ids[order], vectors[order], starts, low, high)

    def typed(self, kind: type) -> np.ndarray:
        if kind not in self._typed:
            self._typed[kind] = self.vectors.astype(kind)
        return self._typed[kind]


class _Best:
    """Queries and the ``k`` best of the candidates that each has met."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray, k: int):
        n = len(ids)
        self.ids, self.vectors, self.distances, self.k = ids, vectors, distances.astype(np.float32), k
        self.squares = _squares(vectors)
        self.found, self.scores = np.zeros((n, k), dtype=np.int64), np.zeros((n, k), dtype=np.int64)
        self.count = np.zeros(n, dtype=np.int64)
        # score and id of the k-th best; what comes after them is of no use
        self.least, self.last = np.full(n, LEAST), np.full(n, GREATEST)
        self.evaluated = 0
        # query rows, ids and scores of candidates that may be among the best
        self._waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _bounds(self, at: slice, block: _Candidates) -> np.ndarray:
        """Upper bounds of the scores of each query in each tile."""
        far, low, high = self.distances[:, at], block.low.astype(np.float32), block.high.astype(np.float32)
        gap = np.zeros((far.shape[1], len(block.tiles)), dtype=np.float32)
        for a, b, c in zip(far, low, high):
            np.maximum(gap, b[None, :] - a[:, None], out=gap)
            np.maximum(gap, a[:, None] - c[None, :], out=gap)
        qq, xx = self.squares[at], block.squares
        # room for the rounding of distances
        reach = float(far.max(initial=0)) + float(high.max(initial=0)) + float(np.sqrt(qq.max()) + np.sqrt(xx.max()))
        gap = np.maximum(gap.astype(np.float64) - 1e-6 * reach, 0)
        both = qq[:, None] + xx[None, :]
        return (both - gap * gap) / 2 + 1e-9 * both + 1e-6

    def meet(self, block: _Candidates) -> None:
        for lo in range(0, len(self.ids), QUERIES_AT_ONCE):
            at = slice(lo, lo + QUERIES_AT_ONCE)
            bounds = self._bounds(at, block)
            kind = _exact(self.squares[at].max(), block.squares.max())
            queries, candidates = self.vectors[at].astype(kind), block.typed(kind)
            fresh = (self.least[at] == LEAST) & (len(block.tiles) > 1)
            nearest = np.where(fresh, bounds.argmax(axis=1), -1)
            if fresh.any():
                # a query's most likely tile first, as its k-th best score leaves others out
                for tile in np.unique(nearest[fresh]).tolist():
                    self._evaluate(lo, np.flatnonzero(nearest == tile), queries, candidates, block, tile)
                self._keep()
            for tile in np.argsort(-bounds.max(axis=0)).tolist():
                rows = np.flatnonzero((bounds[:, tile] >= self.least[at]) & (nearest != tile))
                if len(rows):
                    self._evaluate(lo, rows, queries, candidates, block, tile)
            self._keep()

    def _evaluate(self, lo: int, rows: np.ndarray, queries: np.ndarray, candidates: np.ndarray, block: _Candidates, tile: int) -> None:
        start, end = block.tiles[tile]
        scores = (queries if len(rows) == len(queries) else queries[rows]) @ candidates[start:end].T
        self.evaluated += scores.size
        rows = rows + lo
        least = self.least[rows].astype(scores.dtype)
        some = np.flatnonzero(scores.max(axis=1) >= least)
        if not len(some):
            return
        rows, scores, least = rows[some], scores[some], least[some]
        # in one tile no more than these can be among the best: k, the query itself, and further vectors of an id
        most = self.k + 1 + block.repeated
        if most < scores.shape[1]:
            dense = np.flatnonzero((scores >= least[:, None]).sum(axis=1) > 2 * most)
            if len(dense):
                least[dense] = np.maximum(least[dense], -np.partition(-scores[dense], most - 1, axis=1)[:, most - 1])
        row, column = np.nonzero(scores >= least[:, None])
        new_rows, new_ids, new = rows[row], block.ids[start:end][column], scores[row, column].astype(np.int64)
        useful = (new > self.least[new_rows]) | (new == self.least[new_rows]) & (new_ids < self.last[new_rows])
        useful &= new_ids != self.ids[new_rows]
        if useful.any():
            self._waiting.append((new_rows[useful], new_ids[useful], new[useful]))
            if sum(len(found[0]) for found in self._waiting) >= QUERIES_AT_ONCE:
                self._keep()

    def _keep(self) -> None:
        if not self._waiting:
            return
        rows, ids, scores = (np.concatenate(found) for found in zip(*self._waiting))
        self._waiting.clear()
        met = np.unique(rows)
        before = np.arange(self.k)[None, :] < self.count[met][:, None]
        rows = np.concatenate([np.repeat(met, self.count[met]), rows])
        ids = np.concatenate([self.found[met][before], ids])
        scores = np.concatenate([self.scores[met][before], scores])
        # an id with several vectors counts by its best one
        order = np.lexsort((-scores, ids, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        once = np.append(True, (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1]))
        rows, ids, scores = rows[once], ids[once], scores[once]
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        n = np.diff(np.append(first, len(rows)))
        rank = np.arange(len(rows)) - np.repeat(first, n)
        kept = rank < self.k
        self.found[rows[kept], rank[kept]] = ids[kept]
        self.scores[rows[kept], rank[kept]] = scores[kept]
        self.count[met] = np.minimum(n, self.k)
        full = met[n >= self.k]
        self.least[full], self.last[full] = self.scores[full, self.k - 1], self.found[full, self.k - 1]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Query ids, vector ids, scores; and the evaluations made."""
        filled = np.arange(self.k)[None, :] < self.count[:, None]
        return np.repeat(self.ids, self.count), self.found[filled], self.scores[filled], self.evaluated


def _exact(a: float, b: float) -> type:
    """The fastest type in which sums of products are exact, for vectors of at most these squared lengths."""
    largest = np.sqrt(a) * np.sqrt(b) * (1 + 1e-9)
    return np.float32 if largest < 2.0**24 else np.float64 if largest < 2.0**53 else np.int64


def _search(query: tuple, block: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """k best candidates of a block for each query: query ids, vector ids, scores; and the evaluations made."""
    best = _Best(*query, k)
    best.meet(_Candidates.of(*block))
    return best.rows()


def _narrow(vectors: np.ndarray) -> np.ndarray:
    low, high = vectors.min(initial=0), vectors.max(initial=0)
    return vectors.astype(next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _record(ids: np.ndarray, vectors: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    narrow = _narrow(vectors)
    numbers = {"rows": len(ids), "width": vectors.shape[1], "size": narrow.itemsize}
    arrays = {"ids": ids.astype("<i8"), "vectors": narrow, **more}
    return pa.record_batch(
        [pa.array([n], pa.int32()) for n in numbers.values()] + [pa.array([x.tobytes()], pa.binary()) for x in arrays.values()],
        names=[*numbers, *arrays],
    )


def _candidate_block(ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray) -> pa.RecordBatch:
    block = _Candidates.of(ids, vectors, distances)
    starts = np.array([start for start, _ in block.tiles], dtype="<i8")
    return _record(block.ids, block.vectors, starts=starts, low=block.low.astype("<f8"), high=block.high.astype("<f8"))


def _query_block(ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray) -> pa.RecordBatch:
    order, _ = _by_pivot(distances)
    return _record(ids[order], vectors[order], distances=distances[:, order].astype("<f4"))


def _blocks(vectors: DataFrame, pivots: np.ndarray, rows: int, record: Callable, schema: str, label: str) -> DataFrame:
    """One row for each ``rows`` vectors of a partition, as ``record`` packs them, and a ``block`` number."""

    def packed(table: pa.Table) -> pa.RecordBatch:
        v = _matrix(table.column("v"), pivots.shape[1])
        return record(table.column("vec_id").to_numpy(), v, _distances(v, pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            while waiting.num_rows >= rows:
                yield packed(waiting.slice(0, rows))
                waiting = waiting.slice(rows)
        if waiting is not None and waiting.num_rows:
            yield packed(waiting)

    return stored(vectors.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), label, options=ROW_GROUPS)


def _meet(k: int):
    """The best candidates of the queries over all pairs of blocks of a task, in whatever order these come."""

    def opened(batch: pa.RecordBatch, i: int, prefix: str) -> tuple[np.ndarray, np.ndarray, Callable]:
        n, width, size = (batch.column(f"{prefix}{c}")[i].as_py() for c in ("rows", "width", "size"))

        def array(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(batch.column(f"{prefix}{name}")[i].as_buffer(), kind)

        # copies, as the batch goes
        return array("ids", "<i8").copy(), array("vectors", f"<i{size}").reshape(n, width).copy(), array

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, _Best] = {}
        block, last = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if (key := batch.column("q_block")[i].as_py()) not in best:
                    ids, vectors, array = opened(batch, i, "q_")
                    best[key] = _Best(ids, vectors, array("distances", "<f4").reshape(-1, len(ids)), k)
                if (at := batch.column("block")[i].as_py()) != last:
                    ids, vectors, array = opened(batch, i, "")
                    starts = array("starts", "<i8")
                    low, high = (array(c, "<f8").reshape(-1, len(starts)).copy() for c in ("low", "high"))
                    block, last = _Candidates(ids, vectors, starts, low, high), at
                best[key].meet(block)
        for found in best.values():
            q, x, s, n = found.rows()
            evaluated = np.zeros(len(q), dtype=np.int64)
            evaluated[:1] = n
            yield pa.record_batch(
                [pa.array(c, pa.int64()) for c in (q, x, s, evaluated)], names=["query_id", "vec_id", "score", "evaluated"]
            )

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, pivots: int = PIVOTS, seed: int = 1) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` highest inner products of each query with all other rows.

    ``vectors`` has rows (vec_id, v) as ``scaled_vectors`` gives them.
    """
    vectors = stored(vectors, "topk-vectors")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    chosen = vectors.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id", "v").limit(pivots).select("v").toArrow()
    table = _matrix(chosen.column("v"), size["width"]) if size["n"] else np.zeros((1, 1), dtype=np.int64)
    blocks = _blocks(vectors, table, BLOCK_ROWS, _candidate_block, BLOCK, "topk-blocks")
    queries = _blocks(vectors.where(is_query), table, QUERY_ROWS, _query_block, QUERY_BLOCK, "topk-queries")
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-size["n"] // TASK_ROWS), min(-(-size["n"] // BLOCK_ROWS), TASKS_PER_CORE * cores), 1)
    # all pairs of a partition of candidates and one of queries, read from the files by the task that needs them
    right = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("block", "rows", "width", "size", "ids", "vectors", "distances")])
    found = (
        blocks.coalesce(tasks)
        .crossJoin(right.hint("shuffle_replicate_nl"))
        .mapInArrow(_meet(k), "query_id bigint, vec_id bigint, score bigint, evaluated bigint")
    )
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(scaled_vectors(table), F.col("vec_id") % 50 == 0)


OP3_SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
scored as (
  select q.vec_id as query_id, x.vec_id,
         max(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])))::bigint as score
  from v q join v x on q.vec_id <> x.vec_id where q.vec_id % 50 = 0 group by all)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 5
"""
