"""Exact n-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A document's set holds its distinct shingles of five words (all words of a shorter text). Two documents
are linked when ``den * intersection >= num * union``. Documents with equal sets form a class, which is
compared once, whatever the number of its copies.

1. Every chunk of classes sends its distinct shingles once, packed by bucket, and learns in how many
   classes each of them occurs. A linked pair of sets has ``ceil(n * num / den)`` shingles of either in common, so
   a class with fewer shared shingles than that has no partner; most classes end here.
2. In order of rarity, two linked sets share one of their first ``n - ceil(n * num / den) + 1`` shingles. These
   are posted, and classes that meet in a posting form a cluster, so no linked pair lies in two clusters.
3. Classes of a cluster are cut into size bands, in which linked sets lie in the same or the next one, and bands
   into tiles of bounded numbers of classes and shingles. Small clusters share tiles. Tiles whose bands can
   hold a linked pair meet, each two in one row of their own.
4. In a meeting all pairs are bounded at once: a bit of the hashed bitmap that one set has and the other has not is
   a shingle that they do not share, so ``min(n_a - bits_a, n_b - bits_b) + bits in common`` is no less than the
   intersection. Only pairs whose bound allows a link are intersected, as sorted arrays.
5. A meeting returns for each class how many documents it is linked to and one of these links per group of
   connected classes; components come from joins over these.

The work in a cluster grows with the square of its different sets, as the number of their links does; it is
cut into tiles of bounded memory. Copies add nothing to it.

Cases: null and blank texts have no shingles and are linked with nothing; rows with the same doc_id take part
as documents of their own; rows without a doc_id take no part (component_id null); very long texts are sets like
others, and a tile may hold one alone; an empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.storage import stored

from . import chunks as C
from . import words as W
from .components import components

SHINGLE = 5
NUM, DEN = 80, 100

# classes and shingles of a tile; a class with more shingles is a tile of its own
TILE_CLASSES = 512
TILE_SHINGLES = 1 << 18
# clusters of up to so many classes share tiles
SMALL_CLUSTER = 128

SIGNED = "doc_id bigint, n_shingles bigint, node binary"
CANDIDATE = "node binary, n int, keys array<bigint>, shingles binary"


def least_common(n, num: int, den: int):
    """Shingles that a set of ``n`` has in common with any set it is linked to, at the least."""
    return -(-n * num // den)


def size_band(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Number of the size band: linked sets lie in the same band or in neighbouring ones."""
    edges = [1]
    while edges[-1] <= n.max(initial=0):
        edges.append(edges[-1] * den // num + 1)
    return np.searchsorted(np.array(edges), n, side="right").astype(np.int32)


def shingle_sets(words: W.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in order, and where each text's start."""
    n = words.counts()
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(n)), count)
    begin = np.arange(starts[-1]) - starts[text] + words.first[text]
    hashes = W.window_hashes(W.word_hashes(words), begin, begin + np.minimum(n, size)[text])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(n)))])


def _set_ids(hashes: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    """128 bits that tell sets apart; None for the empty one."""
    total = [np.zeros(len(hashes) + 1, dtype=np.uint64) for _ in range(2)]
    for t, base in zip(total, (W._WORD_BASE, W._OTHER_BASE)):
        np.cumsum(W.mixed(hashes * np.uint64(base)), out=t[1:])
    one, two = (W.mixed(t[starts[1:]] - t[starts[:-1]]).astype("<u8").tobytes() for t in total)
    return [
        one[8 * i : 8 * i + 8] + two[8 * i : 8 * i + 8] if b > a else None
        for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist()))
    ]


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for words in W.word_groups(W.as_binary(batch.column("text")), lower=True):
                hashes, starts = shingle_sets(words, size)
                n = len(starts) - 1
                yield pa.record_batch(
                    [batch.column("doc_id").slice(done, n), pa.array(np.diff(starts).astype(np.int64)),
                     pa.array(_set_ids(hashes, starts), pa.binary())],
                    names=["doc_id", "n_shingles", "node"],
                )
                done += n

    return run


def _one_text_each(size: int):
    """(node, text): of each class one text from every task, so that copies stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            done = 0
            for words in W.word_groups(W.as_binary(batch.column("text")), lower=True):
                nodes = _set_ids(*shingle_sets(words, size))
                new = []
                for i, node in enumerate(nodes):
                    if node is not None and node not in seen:
                        seen.add(node)
                        new.append(i)
                texts = batch.column("text").take(pa.array([done + i for i in new], pa.int64()))
                yield pa.record_batch([pa.array([nodes[i] for i in new], pa.binary()), texts], names=["node", "text"])
                done += len(nodes)

    return run


def _distinct(table: pa.Table | pa.RecordBatch, seen: set[bytes]) -> pa.Table | pa.RecordBatch:
    """The rows of classes that are not in ``seen`` yet."""
    new = []
    for node in table.column("node").to_pylist():
        new.append(node not in seen)
        seen.add(node)
    return table if all(new) else table.filter(pa.array(new, pa.bool_()))


def _send(size: int, buckets: int):
    """Each chunk's distinct shingles, packed by bucket, with the number of classes that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = defaultdict(list)
        seen: set[bytes] = set()
        for batch in batches:
            batch = _distinct(batch, seen)
            chunk = batch.column("chunk").to_numpy()
            for words in W.word_groups(W.as_binary(batch.column("text")), lower=True):
                hashes, starts = shingle_sets(words, size)
                owner = np.repeat(chunk[words.rows], np.diff(starts))
                for c in np.unique(owner):
                    held[int(c)].append(hashes[owner == c])
        for c in list(held):
            keys, times = np.unique(np.concatenate(held.pop(c)), return_counts=True)
            # those that occur once come first and need no count
            rows = []
            for b, at in C.bucket_slices(keys, buckets):
                once = times[at] == 1
                head = np.array([once.sum()], dtype="<u8")
                many = times[at][~once].astype("<u4")
                rows.append((c, b, b"".join([head.tobytes(), keys[at][once].astype("<u8").tobytes(), keys[at][~once].astype("<u8").tobytes(), many.tobytes()])))
            if rows:
                yield C.sent(rows)

    return run


def _sent_counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    once = int(np.frombuffer(raw, "<u8", 1)[0])
    many = (len(raw) - 8 - 8 * once) // 12
    keys = np.frombuffer(raw, "<u8", once + many, 8)
    times = np.ones(once + many, dtype=np.int64)
    times[once:] = np.frombuffer(raw, "<u4", many, 8 * (1 + once + many))
    return keys, times


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk, the shingles that two classes or more have, and how many have them."""
    sent = [_sent_counts(raw) for raw in table.column("payload").to_pylist()]
    keys, index = np.unique(np.concatenate([k for k, _ in sent]), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate([t for _, t in sent])).astype(np.int64)
    bucket, rows, at = int(table.column("bucket")[0].as_py()), [], 0
    for chunk, (own, _) in zip(table.column("chunk").to_pylist(), sent):
        times = total[index[at : at + len(own)]]
        at += len(own)
        again = times > 1
        if again.any():
            found = np.minimum(times[again], 2**32 - 1).astype("<u4")
            rows.append((chunk, bucket, own[again].astype("<u8").tobytes() + found.tobytes()))
    return pa.Table.from_batches([C.sent(rows)]) if rows else table.slice(0, 0)


def _candidates(size: int, num: int, den: int):
    """Of one chunk: the classes with enough shared shingles, and the shingles that they are posted under."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        found = [np.frombuffer(raw, np.uint8) for raw in answers.column("payload").to_pylist()]
        keys = np.concatenate([np.zeros(0, "<u8")] + [np.frombuffer(raw, "<u8", len(raw) // 12) for raw in found])
        times = np.concatenate([np.zeros(0, "<u4")] + [np.frombuffer(raw, "<u4", len(raw) // 12, len(raw) // 12 * 8) for raw in found])
        order = np.argsort(keys)
        keys, times = keys[order], times[order].astype(np.int64)
        out: tuple[list, list, list, list] = ([], [], [], [])
        docs = _distinct(docs, set())
        nodes = docs.column("node").to_pylist() if len(keys) else []
        done = 0
        for words in W.word_groups(C.texts_of(docs), lower=True) if nodes else ():
            hashes, starts = shingle_sets(words, size)
            n = np.diff(starts)
            text = np.repeat(np.arange(len(n)), n)
            place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            count = np.where(keys[place] == hashes, times[place], 1)
            shared = np.bincount(text, weights=count > 1, minlength=len(n)).astype(np.int64)
            least = least_common(n, num, den)
            rarest = np.lexsort((hashes, count, text))
            for i in np.flatnonzero((shared >= least) & (n > 0)):
                own = rarest[starts[i] : starts[i + 1]]
                posted = own[n[i] - shared[i] : n[i] - least[i] + 1]
                out[0].append(nodes[done + i])
                out[1].append(int(n[i]))
                out[2].append(hashes[posted].view(np.int64))
                out[3].append(hashes[starts[i] : starts[i + 1]].astype("<u8").tobytes())
            done += len(n)
        return pa.table(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())],
            names=["node", "n", "keys", "shingles"],
        )

    return run


_TILE = "cluster_set string, band int, tile int, clusters binary, members binary, sizes binary, weights binary, shingles binary"


def _pack_tile(table: pa.Table) -> pa.Table:
    """One row of a tile's classes, one after the other."""
    raw = [
        b"".join(table.column("cluster").to_pylist()),
        b"".join(table.column("member").to_pylist()),
        table.column("n").to_numpy().astype("<i8").tobytes(),
        table.column("weight").to_numpy().astype("<i8").tobytes(),
        b"".join(table.column("shingles").to_pylist()),
    ]
    return pa.table(
        [pa.array([table.column("cluster_set")[0].as_py()], pa.string())]
        + [pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("band", "tile")]
        + [pa.array([x], pa.binary()) for x in raw],
        names=["cluster_set", "band", "tile", "clusters", "members", "sizes", "weights", "shingles"],
    )


class _Tile:
    def __init__(self, batch: pa.RecordBatch, i: int, side: str):
        raw = [batch.column(f"{c}{side}")[i].as_py() for c in ("clusters", "members", "sizes", "weights", "shingles")]
        self.clusters = [raw[0][j : j + 16] for j in range(0, len(raw[0]), 16)]
        self.members = [raw[1][j : j + 16] for j in range(0, len(raw[1]), 16)]
        self.sizes, self.weights = (np.frombuffer(r, "<i8") for r in raw[2:4])
        self.flat = np.frombuffer(raw[4], "<u8")
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def bitmaps(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """A row of ``bits`` bits for each set, and how many of them are set."""
        marks = np.zeros((len(self.sizes), bits), dtype=bool)
        marks[self.row, (self.flat >> np.uint64(7)) & np.uint64(bits - 1)] = True
        return np.packbits(marks, axis=1).view(np.uint64), marks.sum(axis=1)

    def ranked(self, universe: np.ndarray) -> np.ndarray:
        return np.searchsorted(universe, self.flat).astype(np.int32)


def overlap_bounds(a: _Tile, b: _Tile) -> np.ndarray:
    """An upper bound of the intersection of each set of ``a`` with each set of ``b``, from their bitmaps."""
    largest = int(max(a.sizes.max(), b.sizes.max()))
    bits = min(max(64, 1 << (2 * largest - 1).bit_length()), 1 << 13)
    (bits_a, set_a), (bits_b, set_b) = a.bitmaps(bits), b.bitmaps(bits)
    common = np.zeros((len(a.sizes), len(b.sizes)), dtype=np.int32)
    for x, y in zip(bits_a.T, bits_b.T):
        common += np.bitwise_count(x[:, None] & y[None, :])
    return common + np.minimum((a.sizes - set_a)[:, None], (b.sizes - set_b)[None, :])


def _links(a: _Tile, b: _Tile, same: bool, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """For sets of ``a``: its number and those of the sets of ``b`` that it is linked to."""
    sizes = a.sizes[:, None] + b.sizes[None, :]
    # den * common >= num * (sizes - common)
    likely = (den + num) * overlap_bounds(a, b).astype(np.int64) >= num * sizes
    numbers = {c: j for j, c in enumerate({*a.clusters, *b.clusters})}
    of_a, of_b = (np.array([numbers[c] for c in t.clusters]) for t in (a, b))
    likely &= of_a[:, None] == of_b[None, :]
    if same:
        likely &= np.arange(len(a.sizes))[:, None] < np.arange(len(b.sizes))[None, :]
    if not likely.any():
        return
    universe = np.unique(np.concatenate([a.flat, b.flat]))
    flat_a, flat_b = a.ranked(universe), b.ranked(universe)
    for i in np.flatnonzero(likely.any(axis=1)):
        others = np.flatnonzero(likely[i])
        length = b.sizes[others]
        own = flat_a[a.starts[i] : a.starts[i + 1]]
        theirs = flat_b[W.pieces(length, b.starts[others])]
        place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        ends = np.concatenate([[0], np.cumsum(own[place] == theirs)])[np.cumsum(length)]
        common = np.diff(ends, prepend=0)
        linked = others[(den + num) * common >= num * sizes[i, others]]
        if len(linked):
            yield i, linked


def _meet(num: int, den: int):
    """member, linked (documents that it is linked to), partner: one link of each class, enough to connect what is connected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                a, b = _Tile(batch, r, ""), _Tile(batch, r, "_b")
                same = all(batch.column(c)[r].as_py() == batch.column(f"{c}_b")[r].as_py() for c in ("band", "tile"))
                members = a.members + b.members
                linked = np.zeros(len(members), dtype=np.int64)
                parent = np.arange(len(members))

                def root(x: int) -> int:
                    while parent[x] != x:
                        parent[x] = parent[parent[x]]
                        x = parent[x]
                    return x

                for i, others in _links(a, b, same, num, den):
                    linked[i] += b.weights[others].sum()
                    there = others + (0 if same else len(a.members))
                    linked[there] += a.weights[i]
                    for x in np.unique(parent[there]).tolist():
                        parent[root(x)] = root(i)
                some = np.flatnonzero(linked).tolist()
                yield pa.record_batch(
                    [pa.array([members[x] for x in some], pa.binary()), pa.array(linked[some], pa.int64()),
                     pa.array([members[root(x)] for x in some], pa.binary())],
                    names=["member", "linked", "partner"],
                )

    return run


class JaccardJoin:
    """The classes of a table of documents and their links; each step is a written table."""

    def __init__(self, docs: DataFrame, num: int = NUM, den: int = DEN, shingle: int = SHINGLE):
        if not 0 < num <= den:
            raise ValueError("the threshold must be above 0 and at most 1")
        self.num, self.den, self.shingle = num, den, shingle
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        self.signed = stored(self.docs.mapInArrow(_sign(shingle), SIGNED), "jaccard-signed")
        self.classes = stored(
            self.signed.where("node is not null and doc_id is not null")
            .groupBy("node")
            .agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("weight")),
            "jaccard-classes",
        )

    def candidates(self) -> DataFrame:
        """(node, n, keys, shingles) of the classes that share enough shingles with others."""
        n = C.chunk_count(self.docs)
        texts = self.docs.where("doc_id is not null").mapInArrow(_one_text_each(self.shingle), "node binary, text string")
        dealt = C.dealt(texts.withColumn(C.CHUNK, F.pmod(F.xxhash64("node"), F.lit(n)).cast("int")), n)
        answers = dealt.mapInArrow(_send(self.shingle, n), C.SENT).repartition(n, "bucket").groupBy("bucket").applyInArrow(_shared, C.SENT)
        found = dealt.groupBy(C.CHUNK).cogroup(answers.groupBy(C.CHUNK)).applyInArrow(_candidates(self.shingle, self.num, self.den), CANDIDATE)
        return stored(found, "jaccard-candidates")

    def _clustered(self, candidates: DataFrame) -> DataFrame:
        """(node, label) of the candidates that meet others in a posting."""
        posted = stored(candidates.select("node", F.explode("keys").alias("key")), "jaccard-postings")
        heads = posted.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last")
        edges = posted.join(heads.select("key", "head"), "key").where("node <> head")
        return components(stored(edges.select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(), "jaccard-meetings"))

    def _tiles(self, candidates: DataFrame, clustered: DataFrame) -> DataFrame:
        num, den = self.num, self.den

        @F.pandas_udf("int")
        def band(n):
            import pandas as pd

            return pd.Series(size_band(n.to_numpy(), num, den))

        rows = candidates.join(self.classes.select("node", "weight"), "node").join(clustered.withColumnRenamed("label", "cluster"), "node")
        rows = stored(rows.select(F.col("node").alias("member"), "cluster", "weight", "n", band("n").alias("band"), "shingles"), "jaccard-members")
        sizes = rows.groupBy("cluster").agg(F.count("*").alias("in_cluster"))
        pools = max(1, rows.count() // TILE_CLASSES)
        small = F.col("in_cluster") <= SMALL_CLUSTER
        pool = F.concat(F.lit("pool"), F.pmod(F.xxhash64("cluster"), F.lit(pools)).cast("string"))
        sized = sizes.select("cluster", F.when(small, pool).otherwise(F.hex("cluster")).alias("cluster_set"))
        rows = rows.join(sized, "cluster")
        bands = (
            rows.groupBy("cluster_set", "band")
            .agg(F.greatest(F.ceil(F.count("*") / TILE_CLASSES), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int").alias("tiles"))
        )
        rows = stored(
            rows.join(bands, ["cluster_set", "band"])
            .withColumn("tile", F.pmod(F.xxhash64("member", F.lit(1)), F.col("tiles")).cast("int"))
            .select("cluster_set", "band", "tile", "cluster", "member", "n", "weight", "shingles"),
            "jaccard-dealt",
        )
        return stored(rows.groupBy("cluster_set", "band", "tile").applyInArrow(_pack_tile, _TILE), "jaccard-tiles")

    def links(self) -> DataFrame:
        """(member, linked, partner) of every meeting in which a class has a link."""
        candidates = self.candidates()
        tiles = self._tiles(candidates, self._clustered(candidates))
        places = tiles.select("cluster_set", "band", "tile")
        other = places.select(F.col("cluster_set").alias("cluster_set_b"), F.col("band").alias("band_b"), F.col("tile").alias("tile_b"))
        near = (F.col("band_b") == F.col("band") + 1) | ((F.col("band_b") == F.col("band")) & (F.col("tile_b") >= F.col("tile")))
        meetings = places.join(other, (F.col("cluster_set") == F.col("cluster_set_b")) & near)
        packed_b = tiles.select(*[F.col(c).alias(f"{c}_b") for c in tiles.columns])
        first = meetings.join(tiles, ["cluster_set", "band", "tile"])
        both = first.join(packed_b, ["cluster_set_b", "band_b", "tile_b"])
        return stored(both.mapInArrow(_meet(self.num, self.den), "member binary, linked bigint, partner binary"), "jaccard-links")

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id and n_links (documents that it is linked to) of every row."""
        links = self.links()
        labels = components(stored(links.where("member <> partner").select(F.col("member").alias("a"), F.col("partner").alias("b")), "jaccard-edges"))
        linked = links.groupBy(F.col("member").alias("node")).agg(F.sum("linked").alias("linked"))
        classes = self.classes.join(labels, "node", "left").join(linked, "node", "left")
        n_links = F.col("weight") - 1 + F.coalesce("linked", F.lit(0))
        classes = stored(classes.select("node", "first_doc", F.coalesce("label", "node").alias("label"), n_links.alias("n_links")), "jaccard-labels")
        firsts = classes.groupBy("label").agg(F.min("first_doc").alias("component_id"))
        by_class = stored(classes.join(firsts, "label").select(F.col("node").alias("class_node"), "component_id", "n_links"), "jaccard-components")
        known = F.col("doc_id").isNotNull()
        component = F.when(known & F.col("node").isNull(), F.col("doc_id")).when(known, F.col("component_id"))
        return self.signed.join(by_class, F.col("node") == F.col("class_node"), "left").select(
            "doc_id", "n_shingles", component.alias("component_id"), F.when(known, F.coalesce("n_links", F.lit(0))).alias("n_links")
        )


def jaccard_join(docs: DataFrame, num: int = NUM, den: int = DEN, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row of ``docs``."""
    return JaccardJoin(docs, num, den, shingle).result()


def op11_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as l
  from documents),
s as (
  select distinct doc_id, array_to_string(l[i:i + 4], ' ') as shingle
  from (select doc_id, l, unnest(range(1, greatest(len(l) - 4, 1) + 1)) as i from w where len(l) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
link as (
  select x, y from common join n as nx on nx.doc_id = x join n as ny on ny.doc_id = y
  where 100 * c >= 80 * (nx.n + ny.n - c)),
reach as (
  select doc_id as x, doc_id as y from documents
  union
  select reach.x, link.y from reach join link on link.x = reach.y)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.component_id, coalesce(k.n_links, 0)::bigint as n_links
from documents d
join (select x, min(y) as component_id from reach group by x) r on r.x = d.doc_id
left join n on n.doc_id = d.doc_id
left join (select x, count(*) as n_links from link group by x) k on k.x = d.doc_id
"""
