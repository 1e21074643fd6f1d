"""Approximate nearest neighbours: a tree of k-means centres, searched best bin first.

The tree is fitted on a bounded sample and every row is filed under the leaf it descends to.  A query
walks the tree through a priority queue, always opening the nearest centre seen so far, and collects
leaves in that order.  How many it visits is calibrated: held-out rows of the sample are searched
exactly and through the tree, and visits widen until the wanted recall is reached.  Leaves are stored
as blocks; those of a large leaf are spread over tasks by salt.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import hash_sample
from orderflow.llm.vectors import best, matrices, queries_of, vectors_of
from orderflow.session import stage

SAMPLE = 16_384  # rows the tree is fitted on
BRANCHES = 8
LEAF = 48  # rows of the sample below which a node is not split
ROUNDS = 8  # of Lloyd's algorithm per node
PROBES = 256  # held-out rows that calibrate the visits
BLOCK = 2048  # rows of a block of a leaf
SHARE = 8192  # rows of a leaf that one task gathers
_CHUNK = 1 << 22  # numbers of a distance table held at once


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to those of ``b``, good to rounding; for ranking centres."""
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]


@dataclass
class Tree:
    centres: np.ndarray  # of every node
    children: list[list[int]]  # empty at a leaf

    @classmethod
    def fit(cls, sample: np.ndarray) -> Tree:
        rng = np.random.default_rng(7)
        centres, children, work = [sample.mean(0)], [[]], [(0, np.arange(len(sample)))]
        while work:
            node, rows = work.pop()
            if len(rows) <= LEAF:
                continue
            points = sample[rows]
            distinct = np.unique(points, axis=0)
            if len(distinct) < 2:
                continue
            middle = distinct[rng.choice(len(distinct), min(BRANCHES, len(distinct)), replace=False)]
            for _ in range(ROUNDS):
                home = squared(points, middle).argmin(1)
                middle = np.stack([points[home == j].mean(0) for j in np.unique(home)])
            home = squared(points, middle).argmin(1)
            if len(np.unique(home)) < 2:
                continue
            for j in np.unique(home):
                children[node].append(len(centres))
                work.append((len(centres), rows[home == j]))
                centres.append(middle[j])
                children.append([])
        return cls(np.stack(centres), children)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(points), np.int32)
        work = [(0, np.arange(len(points)))]
        while work:
            node, rows = work.pop()
            leaf[rows] = node
            below = np.array(self.children[node])
            if len(below) and len(rows):
                home = squared(points[rows], self.centres[below]).argmin(1)
                work.extend((int(child), rows[home == j]) for j, child in enumerate(below))
        return leaf

    def leaves(self, point: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield node
            else:
                gap = self.centres[below] - point
                for d, child in zip((gap * gap).sum(1).tolist(), below, strict=True):
                    heapq.heappush(queue, (d, child))

    def calibrate(self, sample: np.ndarray, probes: np.ndarray, k: int, recall: float) -> int:
        """The fewest leaves with which searches from ``probes`` find ``recall`` of their true neighbours."""
        home = self.leaf_of(sample)
        table = squared(probes, sample)
        k = min(k, len(sample))
        near = np.argpartition(table, k - 1, 1)[:, :k]
        place = np.full((len(probes), len(self.children)), len(self.children), np.int64)
        for row, probe in enumerate(probes):
            for visit, leaf in enumerate(self.leaves(probe)):
                place[row, leaf] = visit
        needed = np.sort(np.take_along_axis(place, home[near], 1).ravel())  # visit at which each true neighbour is met
        return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def neighbours(table: DataFrame, k: int = 10, every: int = 100, recall: float = 0.98) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found by Euclidean distance in doubles.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; of rows that share such an id the
    smallest vector asks, and none of them answers.  ``recall`` is reached on held-out rows of the
    sample.  Where the leaves visited hold fewer than ``k`` others, the search goes on to the rest.
    Ties go to the smaller id; repeated rows answer each.  Vectors that are null, empty, zero or hold
    null or non-finite components, and rows without id, take no part.  Vectors answer those of their own
    length: each length has a tree of its own, of one leaf, which is searched as a whole, where the
    sample has only few of it.  Further columns are ignored; an empty table gives no row.
    """
    spark = table.sparkSession
    vectors = vectors_of(table, zero=False)
    drawn = hash_sample(vectors, SAMPLE + PROBES, "vec_id", "embedding").toArrow().combine_chunks()
    pieces = [m for b in drawn.to_batches() for _, _, m in matrices(b, SAMPLE + PROBES)]
    if not pieces:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest: dict[int, tuple[Tree, int]] = {}  # by length: the tree and how many leaves are visited
    for sample in pieces:
        if len(sample) > LEAF:
            probes = sample[: min(PROBES, len(sample) // 5)]
            sample = sample[len(probes) :]
            tree = Tree.fit(sample)
            forest[sample.shape[1]] = (tree, tree.calibrate(sample, probes, k, recall))
    single = Tree(np.zeros((1, 1)), [[]])
    shared = spark.sparkContext.broadcast(forest)

    def file(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for _, ids, matrix in matrices(batch, 1 << 14):
                dim = matrix.shape[1]
                tree = shared.value.get(dim, (single,))[0]
                rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * dim), len(ids), [None, pa.py_buffer(np.ascontiguousarray(matrix))])
                dims = pa.array(np.full(len(ids), dim, np.int32))
                yield pa.record_batch([dims, pa.array(tree.leaf_of(matrix)), pa.array(ids), rows.cast(pa.binary())], ["dim", "leaf", "vec_id", "vector"])

    filed = stage(vectors.mapInArrow(file, "dim int, leaf int, vec_id long, vector binary"), "tree-rows")
    sizes = stage(filed.groupBy("dim", "leaf").agg(F.count("*").alias("n")), "tree-sizes")
    # a row per leaf of the trees, whose number the sample bounds
    fullest = {(r.dim, r.leaf): r.n for r in sizes.filter(F.col("dim").isin(list(forest))).collect()} if forest else {}
    shares = sizes.filter(F.col("n") > SHARE).select("dim", "leaf", F.ceil(F.col("n") / SHARE).cast("int").alias("shares"))
    spread = filed.join(shares, ["dim", "leaf"], "left").withColumn("salt", F.pmod(F.hash("vec_id"), F.coalesce("shares", F.lit(1)))).drop("shares")

    def block(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: tuple[int, int], ids: list[np.ndarray], rows: list[bytes]) -> pa.RecordBatch:
            dim, leaf = (pa.array([x], pa.int32()) for x in key)
            return pa.record_batch([dim, leaf, pa.array([np.concatenate(ids).tobytes()]), pa.array([b"".join(rows)])], ["dim", "leaf", "ids", "rows"])

        last, ids, rows, held = (-1, -1), [], [], 0
        for batch in tables:
            dim, leaf, ident = (np.asarray(batch.column(c)) for c in ("dim", "leaf", "vec_id"))
            cuts = [0, *(np.flatnonzero((np.diff(leaf) != 0) | (np.diff(dim) != 0)) + 1), len(leaf)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                while a < b:
                    key = (int(dim[a]), int(leaf[a]))
                    if held and (key != last or held == BLOCK):
                        yield out(last, ids, rows)
                        ids, rows, held = [], [], 0
                    stop = min(b, a + BLOCK - held)
                    last = key
                    ids.append(ident[a:stop])
                    rows.extend(batch.column("vector").slice(a, stop - a).to_pylist())
                    held, a = held + stop - a, stop
        if held:
            yield out(last, ids, rows)

    blocks = spread.repartition("dim", "leaf", "salt").sortWithinPartitions("dim", "leaf", "vec_id").mapInArrow(block, "dim int, leaf int, ids binary, rows binary")

    def visit(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for _, ids, matrix in matrices(batch, 4096):
                dim = matrix.shape[1]
                tree, visits = shared.value.get(dim, (single, 1))
                by_leaf: dict[int, list[int]] = {}
                for row, point in enumerate(matrix):
                    seen = 0  # rows met; own rows are among them, so one more than k is wanted
                    for n, leaf in enumerate(tree.leaves(point)):
                        if n >= visits and seen > k:
                            break
                        seen += fullest.get((dim, leaf), 0)
                        by_leaf.setdefault(leaf, []).append(row)
                leaves = list(by_leaf)
                yield pa.record_batch(
                    [pa.array([dim] * len(leaves), pa.int32()), pa.array(leaves, pa.int32()), pa.array([ids[by_leaf[x]].tobytes() for x in leaves]), pa.array([matrix[by_leaf[x]].tobytes() for x in leaves])],
                    ["dim", "leaf", "asked", "queries"],
                )

    asked = queries_of(vectors, every).hint("rebalance").mapInArrow(visit, "dim int, leaf int, asked binary, queries binary")

    def search(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for dim, ids, rows, asked, queries in zip(batch.column("dim").to_pylist(), *(batch.column(c) for c in ("ids", "rows", "asked", "queries")), strict=True):
                ids, asked = np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(asked.as_buffer(), np.int64)
                rows, queries = (np.frombuffer(x.as_buffer(), np.float64).reshape(-1, dim) for x in (rows, queries))
                by_id = np.argsort(ids, kind="stable")
                ids, rows = ids[by_id], rows[by_id]
                step = max(1, _CHUNK // rows.size)
                for at in range(0, len(asked), step):
                    gap = queries[at : at + step, None, :] - rows[None]
                    far = np.sqrt((gap * gap).sum(2))
                    far[asked[at : at + step, None] == ids[None]] = np.inf
                    top = np.argsort(far, axis=1, kind="stable")[:, :k]  # rows are by id, so ties are too
                    score = np.take_along_axis(far, top, 1)
                    there = np.isfinite(score)
                    query = np.broadcast_to(asked[at : at + step, None], top.shape)
                    yield pa.record_batch([pa.array(query[there]), pa.array(ids[top[there]]), pa.array(score[there])], ["query_id", "vec_id", "score"])

    met = stage(blocks, "tree-blocks").join(stage(asked, "tree-visits"), ["dim", "leaf"]).select("dim", "ids", "rows", "asked", "queries")
    return best(met.mapInArrow(search, "query_id long, vec_id long, score double"), k, nearest=True)
