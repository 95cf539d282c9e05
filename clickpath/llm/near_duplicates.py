"""MinHash near-dedup by an inverted join over signature coordinates.

A document's set holds its distinct shingles of five words (all words of a shorter text). Two documents
are linked when ``DEN * intersection >= NUM * union``. Documents with equal sets form a class, which
takes part once; copies are never paired with each other.

1. Signatures have ``COORDINATES`` minima. Linked sets agree in ``AGREE`` coordinates at least, but for a
   chance below 1e-7 at the threshold itself (binomial tail).
2. Prefix: with all coordinate values in order of how many classes share them, two classes that agree in
   ``AGREE`` of them share one of the rarest ``COORDINATES - AGREE + 1`` of each. Values of one class alone
   are the rarest, so only ``shared - AGREE + 1`` values of a class are posted, and none when fewer than
   ``AGREE`` of its values are shared at all (skip).
3. Posting lists are joined with their most typical class, collisions are counted, and each class is
   compared with the one it collides with most. That joins much of a large group in linear time.
4. Lists whose members lie in one component are done. Of the others, short ones are paired off across
   components. Long ones that share members form clusters, and these are compared in blocks: every two
   blocks meet in one task, which returns links only. So no pair with a common posting goes untested
   unless its classes are connected already.
5. Candidates need sizes that allow the threshold and ``AGREE`` equal coordinates; then their full sets are
   compared, read again from the whole texts.

Cases: null and blank texts have no shingles and are linked with nothing; rows with the same doc_id take
part as documents of their own; rows without a doc_id take no part (component_id null, not kept); an empty
table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.storage import stored

from . import words as W
from .components import components

SHINGLE = 5
NUM, DEN = 75, 100
COORDINATES = 32
AGREE = 10

# members of a list up to which its pairs become rows
SHORT_LIST = 32
# classes of a block of a cluster
BLOCK = 256
# ids that may be broadcast: two numbers each
BROADCAST_ROWS = 2_000_000

SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, signature array<bigint>"


def shingle_sets(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in order, and where each text's start."""
    n = words.counts()
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(n)), count)
    begin = np.arange(starts[-1]) - starts[text] + words.first[text]
    hashes = W.window_hashes(W.word_hashes(words), begin, begin + np.minimum(n, SHINGLE)[text])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])[: len(hashes)]
    return hashes[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(n)))])


def _multipliers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = W.mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 20))
    return drawn[:COORDINATES] | np.uint64(1), drawn[COORDINATES:]


def signatures(hashes: np.ndarray, starts: np.ndarray, seed: int = 1) -> np.ndarray:
    """A row per text: coordinate number and minimum in one number each. Texts must have shingles."""
    up, add = _multipliers(seed)
    out = np.empty((len(starts) - 1, COORDINATES), dtype=np.int64)
    for j in range(COORDINATES):
        least = np.minimum.reduceat((hashes * up[j] + add[j]) >> np.uint64(32), starts[:-1])
        out[:, j] = (least | np.uint64(j << 32)).astype(np.int64)
    return out


def _set_ids(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit id of each text's set."""
    return W.window_hashes(hashes, starts[:-1], starts[1:], other=True).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for words in W.word_groups(W.as_binary(batch.column("text")), lower=True):
            hashes, starts = shingle_sets(words)
            size = np.diff(starts)
            some = np.flatnonzero(size)
            rows = np.zeros((len(size), COORDINATES), dtype=np.int64)
            if len(some):
                rows[some] = signatures(hashes, np.concatenate([starts[some], [len(hashes)]]))
            empty = size == 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(size) + 1, dtype=np.int32) * COORDINATES), pa.array(rows.ravel()), mask=pa.array(empty)
            )
            yield pa.record_batch(
                [batch.column("doc_id").slice(done, len(size)), batch.column("text_hash").slice(done, len(size)),
                 pa.array(size.astype(np.int64)), pa.array(_set_ids(hashes, starts), mask=empty), lists],
                names=["doc_id", "text_hash", "n_shingles", "node", "signature"],
            )
            done += len(size)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts whose set is the one asked for."""
    for batch in batches:
        node = batch.column("node").to_numpy()
        for words in W.word_groups(W.as_binary(batch.column("text")), lower=True):
            hashes, starts = shingle_sets(words)
            right = _set_ids(hashes, starts) == node[words.rows]
            raw = hashes.astype("<u8")
            found = np.flatnonzero(right)
            yield pa.record_batch(
                [pa.array(node[words.rows][found]), pa.array([raw[starts[i] : starts[i + 1]].tobytes() for i in found], pa.binary())],
                names=["node", "shingles"],
            )


def _compare(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(den * common >= num * (len(x) + len(y) - common))
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Corpus:
    """The classes of a table of documents and what is needed to compare two of them."""

    def __init__(self, docs: DataFrame, num: int, den: int):
        self.num, self.den = num, den
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        told_apart = self.docs.withColumn("text_hash", F.xxhash64("text"))
        self.signed = stored(told_apart.mapInArrow(_sign, SIGNED), "signatures")
        self.classes = stored(
            self.signed.where("node is not null and doc_id is not null")
            .groupBy("node")
            .agg(F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")),
            "classes",
        )

    def postings(self) -> DataFrame:
        """(key, node, weight): the rarest shared coordinate values of each class, as many as it takes.

        The weight is the number of members of all its values: it is largest for the classes that
        are most typical of a group, such as the text that the others were copied from.
        """
        # a set of one shingle is like its copies only
        rows = self.classes.where("n > 1").select("node", F.explode("signature").alias("key"))
        shared = stored(rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "shared-keys")
        by_class = (
            rows.join(shared, "key")
            .groupBy("node")
            .agg(F.sort_array(F.collect_list(F.struct("members", "key"))).alias("keys"))
            .where(F.size("keys") >= AGREE)
        )
        prefix = F.slice("keys", F.lit(1), F.size("keys") - (AGREE - 1))
        weight = F.aggregate("keys", F.lit(0).cast("bigint"), lambda total, k: total + k["members"])
        posted = by_class.select("node", weight.alias("weight"), F.explode(prefix).alias("k"))
        return stored(posted.select("k.key", "node", "weight"), "postings")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs of classes (a, b), those that are linked."""
        side = self.classes.select("node", "n", "signature")
        a, b = (side.select(*[F.col(c).alias(f"{c}_{x}") for c in side.columns]) for x in "ab")
        equal = F.size(F.filter(F.zip_with("signature_a", "signature_b", lambda x, y: x == y), lambda e: e))
        fits = F.least("n_a", "n_b") * self.den >= F.greatest("n_a", "n_b") * self.num
        likely = stored(
            pairs.join(a, F.col("a") == F.col("node_a")).join(b, F.col("b") == F.col("node_b"))
            .where(fits & (equal >= AGREE)).select("a", "b"),
            "candidates",
        )
        sets = self.sets(likely.select("a").union(likely.select("b")).distinct().withColumnRenamed("a", "node"))
        of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
        of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
        return stored(likely.join(of_a, "a").join(of_b, "b").mapInArrow(_compare(self.num, self.den), "a bigint, b bigint"), "links")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles): the full sets of classes, read from their texts again."""
        wanted = stored(nodes.join(self.classes.select("node", F.col("first_doc").alias("wanted_doc")), "node"), "compared")
        few = wanted.count() <= BROADCAST_ROWS
        texts = self.docs.join(F.broadcast(wanted) if few else wanted, F.col("doc_id") == F.col("wanted_doc"))
        sets = stored(texts.select("node", "text").mapInArrow(_sets, "node bigint, shingles binary"), "sets")
        # rows that agree in doc_id and text give the same set again
        return sets.dropDuplicates(["node"]) if self._repeated_ids() else sets

    def _repeated_ids(self) -> bool:
        if not hasattr(self, "_repeated"):
            rows = self.signed.where("node is not null").groupBy("doc_id").count()
            self._repeated = not rows.where("count > 1").isEmpty()
        return self._repeated


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    found = labels.select(F.col("node").alias("labelled"), F.col("label"))
    return rows.join(found, F.col("node") == F.col("labelled"), "left").select(
        "key", "node", F.coalesce("label", "node").alias("label")
    )


def _merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (node, label) after the links ``found``; a node without a row is a component of its own."""

    def end(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(f"node_{side}"), F.col("label").alias(f"label_{side}"))

    raised = (
        found.join(end("a"), F.col("a") == F.col("node_a"), "left").join(end("b"), F.col("b") == F.col("node_b"), "left")
        .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).where("a <> b").distinct()
    )
    tops = components(stored(raised, "label-links"))
    over = tops.select(F.col("node").alias("under"), F.col("label").alias("top"))
    moved = labels.join(over, F.col("label") == F.col("under"), "left").select("node", F.coalesce("top", "label").alias("label"))
    new = tops.join(labels, "node", "left_anti").select("node", "label")
    return stored(moved.union(new), "labels")


def _first_pairs(postings: DataFrame) -> DataFrame:
    """Each class with the most typical member of a list, of the one it meets in most lists."""
    heads = postings.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("h"))
    heads = stored(heads.select("key", F.col("h.node").alias("head"), F.col("h.weight").alias("head_weight")), "list-heads")
    met = postings.join(heads, "key").where("node <> head").groupBy("node", "head", "head_weight").agg(F.count("*").alias("times"))
    best = met.groupBy("node").agg(F.max(F.struct("times", "head_weight", "head")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.head").alias("b"))


def _open_members(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, label, members, main) of the lists that hold several components; ``main`` is the largest."""
    rows = stored(_labelled(postings, labels), "list-members")
    parts = rows.groupBy("key", "label").agg(F.count("*").alias("n"))
    lists = stored(
        parts.groupBy("key")
        .agg(F.sum("n").alias("members"), F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1").select(F.col("key").alias("open"), "members", F.col("main.label").alias("main")),
        "open-lists",
    )
    open_rows = rows.join(lists, F.col("key") == F.col("open")).select("key", "node", "label", "members", "main")
    return stored(open_rows, "open-members")


def _pairs_across(members: DataFrame) -> DataFrame:
    """Every pair of members of a list that lie in different components; for short lists."""
    outside = members.where("label <> main").select(
        F.col("key").alias("outside_key"), F.col("node").alias("outside"), F.col("label").alias("outside_label")
    )
    once = (F.col("label") == F.col("main")) | (F.col("outside") < F.col("node"))
    met = members.join(outside, (F.col("key") == F.col("outside_key")) & (F.col("label") != F.col("outside_label")) & once)
    return met.select(F.least("node", "outside").alias("a"), F.greatest("node", "outside").alias("b")).distinct()


_BLOCK = "cluster bigint, block int, blocks int, nodes binary, labels binary, signatures binary, sizes binary, shingles binary"


def _pack_block(table: pa.Table) -> pa.Table:
    """One row of a block's classes, one after the other."""
    sets = table.column("shingles").to_pylist()
    signatures = table.column("signature").combine_chunks().flatten().to_numpy()
    raw = [
        table.column("node").to_numpy().astype("<i8").tobytes(),
        table.column("label").to_numpy().astype("<i8").tobytes(),
        signatures.astype("<i8").tobytes(),
        np.array([len(s) // 8 for s in sets], dtype="<i8").tobytes(),
        b"".join(sets),
    ]
    return pa.table(
        [pa.array([table.column("cluster")[0].as_py()], pa.int64())]
        + [pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("block", "blocks")]
        + [pa.array([x], pa.binary()) for x in raw],
        names=["cluster", "block", "blocks", "nodes", "labels", "signatures", "sizes", "shingles"],
    )


def _common(a: list[np.ndarray], b: list[np.ndarray], columns: int = 1 << 14) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks, over slices of the shingles they share."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(flat_a, flat_b)
    out = np.zeros((len(a), len(b)))

    def at(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        place = np.minimum(np.searchsorted(shared, flat), max(0, len(shared) - 1))
        hit = shared[place] == flat if len(shared) else np.zeros(len(flat), dtype=bool)
        order = np.argsort(place[hit], kind="stable")
        return row[hit][order], place[hit][order]

    (row_a, at_a), (row_b, at_b) = at(a, flat_a), at(b, flat_b)
    for lo in range(0, len(shared), columns):
        width = min(columns, len(shared) - lo)
        parts = []
        for rows, places, n in ((row_a, at_a, len(a)), (row_b, at_b, len(b))):
            x, y = np.searchsorted(places, [lo, lo + width])
            dense = np.zeros((n, width), dtype=np.float32)
            dense[rows[x:y], places[x:y] - lo] = 1
            parts.append(dense)
        out += parts[0] @ parts[1].T
    return out


def _linked_blocks(num: int, den: int):
    """Links between classes of two blocks that lie in different components, enough to connect what is connected."""

    def opened(batch: pa.RecordBatch, i: int, side: str) -> tuple:
        raw = [batch.column(f"{c}{side}")[i].as_py() for c in ("nodes", "labels", "signatures", "sizes", "shingles")]
        nodes, labels, signatures, sizes = (np.frombuffer(r, "<i8") for r in raw[:4])
        sets = np.split(np.frombuffer(raw[4], "<u8"), np.cumsum(sizes)[:-1])
        return nodes, labels, signatures.reshape(len(nodes), -1), sizes, sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [], []
            for i in range(batch.num_rows):
                nodes, labels, signatures, sizes, sets = opened(batch, i, "")
                nodes_b, labels_b, signatures_b, sizes_b, sets_b = opened(batch, i, "_b")
                agree = np.zeros((len(nodes), len(nodes_b)), dtype=np.int16)
                for x, y in zip(signatures.T, signatures_b.T):
                    agree += x[:, None] == y[None, :]
                likely = (agree >= AGREE) & (labels[:, None] != labels_b[None, :])
                likely &= den * np.minimum(sizes[:, None], sizes_b[None, :]) >= num * np.maximum(sizes[:, None], sizes_b[None, :])
                rows, columns = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
                if not len(rows):
                    continue
                common = _common([sets[r] for r in rows], [sets_b[c] for c in columns])
                union = sizes[rows][:, None] + sizes_b[columns][None, :] - common
                linked = likely[np.ix_(rows, columns)] & (den * common >= num * union)
                parent: dict[int, int] = {}

                def root(x: int) -> int:
                    while parent.setdefault(x, x) != x:
                        x = parent[x]
                    return x

                for r, c in zip(*np.nonzero(linked)):
                    x, y = root(int(labels[rows[r]])), root(int(labels_b[columns[c]]))
                    if x != y:
                        parent[x] = y
                        found_a.append(int(nodes[rows[r]]))
                        found_b.append(int(nodes_b[columns[c]]))
            yield pa.record_batch([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return run


def _links_in_clusters(corpus: _Corpus, members: DataFrame) -> DataFrame:
    """Links across components among the members of long lists.

    Lists that share members make up a cluster. It is cut into blocks, and every two blocks of a cluster
    meet in one row, so pairs are compared inside a task and only links come out.
    """
    heads = members.groupBy("key").agg(F.min("node").alias("head"))
    heads = stored(heads.select(F.col("key").alias("head_key"), "head"), "cluster-heads")
    edges = members.join(heads, (F.col("key") == F.col("head_key")) & (F.col("node") != F.col("head")))
    cluster = components(stored(edges.select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(), "cluster-edges"))
    labels = members.groupBy("node").agg(F.min("label").alias("component"))
    nodes = cluster.withColumnRenamed("label", "cluster").join(labels, "node").withColumnRenamed("component", "label")
    nodes = stored(nodes, "clustered")
    sizes = stored(nodes.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "clusters")
    sets = corpus.sets(nodes.select("node"))
    signed = corpus.classes.select("node", "signature")
    rows = (
        nodes.join(sizes.withColumnRenamed("cluster", "of"), F.col("cluster") == F.col("of")).join(sets, "node").join(signed, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("cluster", "block", "blocks", "node", "label", "signature", "shingles")
    )
    packed = stored(rows.groupBy("cluster", "block").applyInArrow(_pack_block, _BLOCK), "blocks")
    left = packed.withColumn("other", F.explode(F.expr("sequence(block, blocks - 1)")))
    right = packed.withColumn("other", F.explode(F.expr("sequence(0, block)")))
    right = right.select(
        F.col("cluster").alias("cluster_b"), F.col("other").alias("block_b"), F.col("block").alias("other_b"),
        *[F.col(c).alias(f"{c}_b") for c in ("nodes", "labels", "signatures", "sizes", "shingles")],
    )
    same = (F.col("cluster") == F.col("cluster_b")) & (F.col("block") == F.col("block_b")) & (F.col("other") == F.col("other_b"))
    return stored(left.join(right, same).mapInArrow(_linked_blocks(corpus.num, corpus.den), "a bigint, b bigint"), "cluster-links")


def _components(corpus: _Corpus) -> DataFrame:
    """(node, label) of all classes that are linked to others."""
    postings = corpus.postings()
    labels = components(corpus.links(_first_pairs(postings)))
    members = _open_members(postings, labels)
    long_ones = members.where(F.col("members") > SHORT_LIST)
    found = corpus.links(_pairs_across(members.where(F.col("members") <= SHORT_LIST)))
    if not long_ones.isEmpty():
        found = found.union(_links_in_clusters(corpus, long_ones))
    return _merged(labels, found)


def near_duplicates(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; text_hash tells texts with one doc_id apart.

    ``component`` is a number for the documents that are linked, which two groups never share even where they have the
    same smallest doc_id. It is missing where a document takes no part or has no shingles.
    """
    corpus = _Corpus(docs, num, den)
    labels = _components(corpus)
    found = labels.select(F.col("node").alias("labelled"), "label")
    classes = corpus.classes.select("node", "first_doc").join(found, F.col("node") == F.col("labelled"), "left")
    classes = stored(classes.select("node", "first_doc", F.coalesce("label", "node").alias("label")), "labelled-classes")
    firsts = classes.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    by_class = stored(classes.join(firsts, "label").select(F.col("node").alias("class_node"), "component_id", F.col("label").alias("component")), "class-components")
    known = F.col("doc_id").isNotNull()
    component = F.when(known & F.col("node").isNull(), F.col("doc_id")).when(known, F.col("component_id"))
    return (
        corpus.signed.join(by_class, F.col("node") == F.col("class_node"), "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), "text_hash", F.when(known, F.col("component")).alias("component"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def op10_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id", "kept")
