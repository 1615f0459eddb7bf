"""Nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

1. The tree is fitted on a bounded sample of directions (at most `SAMPLE`): k-means splits the sample, and each part again,
   until parts are small. The tree, bounded like the sample, goes to every task.
2. Every vector falls to one leaf. Equal vectors are one candidate with its least ids, as many as a query can return.
3. A query descends to the nearest leaf; branches passed by wait in a priority queue by their distance, and the nearest
   waiting branch is followed next, until enough leaves are visited.
4. How many are enough is calibrated: for a bounded set of queries the true neighbours are found among all vectors, and the
   visits are widened until the recall reaches the target; with all leaves it is 1. A query goes on beyond that until its
   leaves hold as many ids as it can return, its own apart, so that small or empty leaves leave no query short.
5. Queries meet the vectors of their leaves by (leaf, block); a leaf with many vectors is several blocks. Each block gives its
   best for each query, and the best of these are the result. Scores are exact cosines of the vectors as stored.

Defined cases. Vectors that are null, zero, or hold null or non-finite components take no part, neither do null ids or vectors
of another dimension than the most usual one. Equal scores: the smaller id first. Fewer candidates than asked: all of them.
Repeated rows with one id are one vector each; a query never returns its own id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.work import stored

SAMPLE = 20_000
FAN = 8
LEAF = 64
CALIBRATION = 128
RECALL = 0.97
BLOCK = 4096
SEED = 7


class Tree(NamedTuple):
    """Nodes in one array: centre, first child and number of children, and the number of a leaf or -1."""

    centres: np.ndarray
    first: np.ndarray
    children: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _split(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """k-means: centres, and of each row its centre."""
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:FAN]]
    for _ in range(8):
        near = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres, ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def build_tree(sample: np.ndarray, seed: int = SEED) -> Tree:
    rng = np.random.default_rng(seed)
    x = _units(sample)
    centres, first, children, leaf = [x.mean(axis=0)], [0], [0], [-1]
    waiting, leaves = [(0, np.arange(len(x)))], 0
    while waiting:
        node, rows = waiting.pop()
        own = x[rows]
        if len(rows) <= LEAF or (own == own[0]).all():
            leaf[node], leaves = leaves, leaves + 1
            continue
        parts, near = _split(own, rng)
        first[node], children[node] = len(centres), len(parts)
        for i, centre in enumerate(parts):
            waiting.append((len(centres), rows[near == i]))
            centres.append(centre)
            first.append(0)
            children.append(0)
            leaf.append(-1)
    return Tree(np.array(centres), np.array(first), np.array(children), np.array(leaf))


def fall(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each unit vector."""
    node = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(tree.children[node] > 0)
        if not len(inner):
            return tree.leaf[node]
        for parent in np.unique(node[inner]):
            own = inner[node[inner] == parent]
            a = tree.first[parent]
            centres = tree.centres[a : a + tree.children[parent]]
            node[own] = a + ((centres**2).sum(axis=1) - 2 * x[own] @ centres.T).argmin(axis=1)


def visits(tree: Tree, query: np.ndarray, enough: int, held: np.ndarray | None = None, least: int = 0) -> list[int]:
    """Leaves in best-bin-first order: `enough` of them, and more until they hold `least` ids. held: of each leaf its ids."""
    queue, out, number, ids = [(0.0, 0, 0)], [], 0, 0
    while queue and (len(out) < enough or ids < least):
        _, _, node = heapq.heappop(queue)
        while tree.children[node]:
            a = tree.first[node]
            away = ((tree.centres[a : a + tree.children[node]] - query) ** 2).sum(axis=1)
            best = int(away.argmin())
            for i, d in enumerate(away.tolist()):
                if i != best:
                    number += 1
                    heapq.heappush(queue, (d, number, int(a + i)))
            node = int(a + best)
        out.append(int(tree.leaf[node]))
        ids += int(held[out[-1]]) if held is not None else 0
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of a vector with each row; equal rows give equal numbers wherever they stand."""
    return (rows * query).sum(axis=1) / np.sqrt((rows * rows).sum(axis=1)) / np.sqrt((query * query).sum())


def _best(query_id: int, query: np.ndarray, ids: np.ndarray, owner: np.ndarray, rows: np.ndarray, units: np.ndarray, k: int) -> tuple[list[int], list[float]]:
    """The best k candidates: ids, and owner, the row of each id."""
    other = ids != query_id
    rough = units @ (query / np.sqrt((query * query).sum()))
    about = rough[owner[other]]
    if len(about) > k:
        keep = np.flatnonzero(other)[about >= np.partition(about, -k)[-k] - 1e-9]
    else:
        keep = np.flatnonzero(other)
    exact = cosines(query, rows[owner[keep]])
    order = np.lexsort((ids[keep], -exact))[:k]
    return ids[keep][order].tolist(), exact[order].tolist()


def _placed(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = fall(tree, _units(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], ["ids", "vector", "leaf"])

    return run


def _sent(tree: Tree, enough: int, held: np.ndarray, k: int):
    """Of each query (query, target, own) its leaves; own: how many vectors have its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = [visits(tree, q, enough, held, k + own) for q, own in zip(_units(_matrix(batch.column(1))), batch.column(2).to_pylist(), strict=True)]
                row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                leaf = pa.array(np.concatenate([np.array(x, np.int64) for x in lists]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), leaf], ["query", "target", "leaf"])

    return run


_FOUND = "query_id long, vec_id long, score double, leaf long"


def _compare(k: int):
    """One block: its vectors and the queries sent to its leaf."""

    def run(key, sent: pa.Table, held: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], []]
        if sent.num_rows and held.num_rows:
            rows, targets = _matrix(held["vector"].combine_chunks()), _matrix(sent["target"].combine_chunks())
            units, lists = _units(rows), held["ids"].combine_chunks()
            owner = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy()))
            ids = lists.flatten().to_numpy()
            for query, target in zip(sent["query"].to_pylist(), targets, strict=True):
                found, scores = _best(query, target, ids, owner, rows, units, k)
                for column, values in zip(columns, ([query] * len(found), found, scores, [key[0].as_py()] * len(found)), strict=True):
                    column += values
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score", "leaf"])

    return run


def _true(queries: np.ndarray, numbers: np.ndarray, k: int):
    """The best of a batch of placed vectors for each of a few queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, lists = _matrix(batch.column(1)), batch.column(0)
            units, ids = _units(rows), lists.flatten().to_numpy()
            owner, leaf = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy())), batch.column(2).to_numpy()
            for number, query in zip(numbers.tolist(), queries, strict=True):
                found, scores = _best(number, query, ids, owner, rows, units, k)
                of = dict(zip(ids.tolist(), leaf[owner].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(found), pa.int64()), pa.array(found, pa.int64()), pa.array(scores, pa.float64()), pa.array([of[i] for i in found], pa.int64())],
                    ["query_id", "vec_id", "score", "leaf"],
                )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrated_visits(tree: Tree, placed: DataFrame, queries: DataFrame, k: int, recall: float = RECALL) -> int:
    """The least number of visits, doubled from 1, at which the sample's queries find so many of their true neighbours."""
    chosen = queries.orderBy(F.xxhash64("query"), "query").limit(CALIBRATION).collect()  # bounded
    if not chosen:
        return tree.leaves
    vectors, numbers = np.array([r.target for r in chosen], np.float64), np.array([r["query"] for r in chosen])
    truth = _ranked(placed.mapInArrow(_true(vectors, numbers, k), _FOUND), k).select("query_id", "leaf").collect()  # k for each
    leaves: dict[int, list[int]] = {}
    for r in truth:
        leaves.setdefault(r.query_id, []).append(r.leaf)
    places = []
    for number, query in zip(numbers.tolist(), _units(vectors), strict=True):
        at = {leaf: i for i, leaf in enumerate(visits(tree, query, tree.leaves))}
        places += [at[leaf] for leaf in leaves.get(number, [])]
    most, places = 1, np.array(places)
    while most < tree.leaves and (places < most).mean() < recall:
        most *= 2
    return min(most, tree.leaves)


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """id, vector (doubles) of the vectors that take part."""
    value = F.col(vector).cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    known = vectors.select(F.col(id_column).cast("long").alias("id"), value.alias("vector")).where(F.col("id").isNotNull() & F.col("vector").isNotNull() & fine)
    sizes = known.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return known.where(F.size("vector") == (sizes.n if sizes else 0))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: of each query its k nearest found among all other rows, by cosine.

    is_query: a condition on the column `id`.
    """
    known = stored(usable(vectors, id_column, vector))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()  # bounded
    if not sample:
        return known.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = build_tree(np.array([r.vector for r in sample], np.float64))
    least = Window.partitionBy("vector").orderBy("id")
    copies = known.distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    merged = copies.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("ids", "vector")
    placed = stored(merged.mapInArrow(_placed(tree), "ids array<long>, vector array<double>, leaf long"))
    own = F.count("*").over(Window.partitionBy("id"))
    queries = known.where(is_query).distinct().select(F.col("id").alias("query"), F.col("vector").alias("target"), own.alias("own"))
    most = calibrated_visits(tree, placed, queries, k, recall)

    leaves = placed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.sum(F.size("ids")).alias("ids")).collect()  # a row for each leaf
    held_ids = np.zeros(tree.leaves, np.int64)
    held_ids[[r.leaf for r in leaves]] = [r.ids for r in leaves]
    blocks = known.sparkSession.createDataFrame([(r.leaf, r.blocks) for r in leaves], "leaf long, blocks long")
    held = placed.join(F.broadcast(blocks), "leaf").select("ids", "vector", "leaf", F.pmod(F.xxhash64("ids"), "blocks").alias("block"))
    sent = queries.mapInArrow(_sent(tree, most, held_ids, k), "query long, target array<double>, leaf long").join(F.broadcast(blocks.toDF("to", "blocks")), F.col("leaf") == F.col("to"))
    sent = sent.select("query", "target", "leaf", "blocks").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sent, held = sent.toDF(*sent.columns), held.toDF(*held.columns)
    found = sent.groupBy("leaf", "block").cogroup(held.groupBy("leaf", "block")).applyInArrow(_compare(k), _FOUND)
    return _ranked(found.select("query_id", "vec_id", "score").distinct(), k).select("query_id", "rank", "vec_id", "score")
