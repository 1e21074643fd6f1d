"""Exact top-k by inner product over a vector-approximation file.

The approximation and the vectors are two tables.  The first has blocks of cells, a byte a component,
and is all that a scan reads: cells bound every score from below and above, and in a block only the
rows stay whose upper bound reaches the k-th best lower bound.  Over all blocks the k-th best lower
bound of a query then rules out most of these.  Of what is left, exact vectors are read in the order of
their bounds: first as many as may settle the k-th score, then those whose bound still reaches it.
Blocks of queries meet blocks of cells, so no pair of rows is a row before it is a candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.vectors import best, matrices, queries_of, vectors_of
from orderflow.session import stage

BLOCK = 4096  # rows of a block
ASKED = 512  # queries of a block
CELLS = 256  # per dimension
SALTS = 256  # parts of the rows of a very common vector


def approximate(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each component, and each dimension's lowest value and cell width."""
    low = exact.min(0)
    width = (exact.max(0) - low) // CELLS + 1
    return ((exact - low) // width).astype(np.uint8), low, width


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every query: what its score with each row is about, and how far it may lie below and above that.

    The product runs in single precision; what that may be off by is part of the reach.
    """
    size = np.maximum(np.abs(queries).max(1, initial=1), 1).astype(np.float64)[:, None]
    q, w = queries / size, width.astype(np.float64)
    about = ((q * w).astype(np.float32) @ cells.T.astype(np.float32)).astype(np.float64) + (q @ low.astype(np.float64))[:, None]
    off = np.abs(q) @ (np.abs(low.astype(np.float64)) + w * CELLS) * (queries.shape[1] + 8) * 2.0**-23
    above, below = np.maximum(q, 0) @ (w - 1), np.maximum(-q, 0) @ (w - 1)
    return about * size, (below + off) * size[:, 0], (above + off) * size[:, 0]


def scan(queries: np.ndarray, asked: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(query, rows of the block, lower and upper bounds) of what may be among the ``k`` best, its own row left out."""
    for own, about, below, above in zip(asked, *bounds(queries, cells, low, width), strict=True):
        other = np.flatnonzero(ids != own)
        score = about[other]
        if len(score) > k:
            kth = np.partition(score, len(score) - k)[len(score) - k]
            fit = score + above >= kth - below
            other, score = other[fit], score[fit]
        yield own, other, score - below, score + above


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``, one by one."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest >= 2**63:
        raise OverflowError("scores do not fit 64 bits")
    return (a * b).sum(1)


def _by_dim(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Rows of one length at a time, with the matrices of their binary vectors."""
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        part = [batch.column(c).take(pa.array(at)).to_pylist() for c in columns]
        yield at, [np.frombuffer(b"".join(p), np.int64).reshape(-1, dim) for p in part]


def without_needless_copies(stored: DataFrame, k: int) -> DataFrame:
    """``stored`` with only the ``k + 1`` smallest ids of each vector.

    Copies tie for every query, and the smaller ids win, of which one may be the query's own row.  So
    further ones answer nothing, and no query has to tell a common vector's many rows apart.
    """
    copy = Window.partitionBy("dim", "sha", "salt").orderBy("vec_id", "row")
    many = stored.groupBy("dim", F.sha2("exact", 256).alias("sha")).agg(F.count("*").alias("n")).filter(F.col("n") > k + 1)
    many = stage(many.select("dim", "sha", F.lit(True).alias("many")), "va-copies")
    if many.isEmpty():
        return stored
    marked = stored.withColumn("sha", F.sha2("exact", 256)).join(many, ["dim", "sha"], "left")
    for salt in (F.pmod(F.xxhash64("row"), F.lit(SALTS)), F.lit(0)):  # a very common vector is sifted in parts first
        rank = F.row_number().over(copy)
        fewer = marked.filter("many").withColumn("salt", salt.cast("int")).withColumn("rank", rank).filter(F.col("rank") <= k + 1)
        marked = marked.filter("many is null").unionByName(fewer.select(*marked.columns))
    return stage(marked.select(*stored.columns), "va-distinct")


def candidates(stored: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(``query_id``, ``row``, ``vec_id``, ``low``, ``high``) that bounds do not rule out, found in the cells alone.

    ``stored`` has ``row``, ``vec_id``, ``dim``, ``exact``; ``asked`` ``query_id``, ``dim``, ``query``.
    """

    def pack(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for at, (exact,) in _by_dim(batch, "exact"):
                for a in range(0, len(at), BLOCK):
                    rows = at[a : a + BLOCK]
                    parts = (*approximate(exact[a : a + BLOCK]), *(np.asarray(batch.column(c))[rows] for c in ("row", "vec_id")))
                    yield pa.record_batch([pa.array([exact.shape[1]], pa.int32()), *(pa.array([p.tobytes()]) for p in parts)], ["dim", "cells", "low", "width", "rows", "ids"])

    def ask(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for at, (queries,) in _by_dim(batch, "query"):
                ids = np.asarray(batch.column("query_id"))[at]
                for a in range(0, len(at), ASKED):
                    yield pa.record_batch([pa.array([queries.shape[1]], pa.int32()), pa.array([queries[a : a + ASKED].tobytes()]), pa.array([ids[a : a + ASKED].tobytes()])], ["asked_dim", "queries", "asked"])

    def meet(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for row in range(batch.num_rows):
                dim = batch.column("dim")[row].as_py()
                if dim != batch.column("asked_dim")[row].as_py():
                    continue

                def read(name: str, kind: type = np.int64, shape: tuple[int, ...] = (-1,), row: int = row) -> np.ndarray:
                    return np.frombuffer(batch.column(name)[row].as_buffer(), kind).reshape(shape)

                ids, rows = read("ids"), read("rows")
                found = list(scan(read("queries", shape=(-1, dim)), read("asked"), read("cells", np.uint8, (-1, dim)), read("low"), read("width"), ids, k))
                at = np.concatenate([f[1] for f in found])
                query = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
                columns = query, rows[at], ids[at], np.concatenate([f[2] for f in found]), np.concatenate([f[3] for f in found])
                yield pa.record_batch([pa.array(c) for c in columns], ["query_id", "row", "vec_id", "low", "high"])

    blocks = stage(stored.mapInArrow(pack, "dim int, cells binary, low binary, width binary, rows binary, ids binary"), "va-cells")
    queries = stage(asked.mapInArrow(ask, "asked_dim int, queries binary, asked binary"), "va-queries")
    met = stage(blocks.crossJoin(queries).mapInArrow(meet, "query_id long, row long, vec_id long, low double, high double"), "va-met")
    best_low = Window.partitionBy("query_id").orderBy(F.desc("low"), "row")
    kth = met.withColumn("n", F.row_number().over(best_low)).filter(F.col("n") == k).select("query_id", F.col("low").alias("kth"))
    left = met.join(kth, "query_id", "left").filter(F.col("kth").isNull() | (F.col("high") >= F.col("kth")))
    return stage(left.select("query_id", "row", "vec_id", "low", "high"), "va-candidates")


def _exact(wanted: DataFrame, stored: DataFrame, asked: DataFrame) -> DataFrame:
    """``query_id``, ``vec_id`` and exact ``score`` of candidates, whose vectors are read now."""

    def multiply(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for at, (a, b) in _by_dim(batch, "query", "exact"):
                query, ids = (batch.column(c).take(pa.array(at)) for c in ("query_id", "vec_id"))
                yield pa.record_batch([query, ids, pa.array(products(a, b))], ["query_id", "vec_id", "score"])

    rows = wanted.select("query_id", "row").join(stored, "row").join(asked.select("query_id", "query"), "query_id")
    return rows.select("query_id", "vec_id", "dim", "query", "exact").mapInArrow(multiply, "query_id long, vec_id long, score long")


def top_k(table: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the exact ``k`` best of every query among all other rows.

    Components are ``floor(scale * x)``.  Queries are the rows whose ``vec_id`` is divisible by ``every``; of
    rows that share such an id the smallest vector asks, and none of them answers.  Ties go to the
    smaller id; repeated rows answer each.  Vectors that are null, empty, or hold null or non-finite
    components, and rows without id, take no part; vectors of another length than the query's do not
    answer it.  Further columns are ignored; an empty table gives no row.  Scores beyond 64 bits raise.
    """
    vectors = vectors_of(table)

    def whole(matrix: np.ndarray) -> np.ndarray:
        scaled = np.floor(scale * matrix)
        if np.abs(scaled).max(initial=0) >= 2.0**62:
            raise OverflowError("components do not fit 64 bits")
        return scaled.astype(np.int64)

    def store(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for _, ids, matrix in matrices(batch, BLOCK):
                rows = [r.tobytes() for r in whole(matrix)]
                yield pa.record_batch([pa.array(ids), pa.array(np.full(len(ids), matrix.shape[1], np.int32)), pa.array(rows, pa.binary())], ["vec_id", "dim", "exact"])

    kinds = "vec_id long, dim int, exact binary"
    stored = stage(vectors.mapInArrow(store, kinds).withColumn("row", F.monotonically_increasing_id()), "va-exact")
    stored = without_needless_copies(stored, k)
    asked = queries_of(vectors, every).hint("rebalance").mapInArrow(store, kinds)
    asked = stage(asked.select(F.col("vec_id").alias("query_id"), "dim", F.col("exact").alias("query")), "va-asked")
    left = candidates(stored, asked, k)
    # in the order of their bounds: first those that may settle the k-th score
    order = Window.partitionBy("query_id").orderBy(F.desc("high"), "row")
    ranked = left.withColumn("n", F.row_number().over(order))
    first = stage(_exact(ranked.filter(F.col("n") <= 2 * k), stored, asked), "va-first")
    kth = best(first, k, nearest=False).filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    open_ = ranked.filter(F.col("n") > 2 * k).join(kth, "query_id", "left").filter(F.col("kth").isNull() | (F.col("high") >= F.col("kth")))
    rest = _exact(open_, stored, asked)
    return best(first.unionByName(rest), k, nearest=False)
