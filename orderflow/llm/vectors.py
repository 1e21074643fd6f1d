"""Vectors as blocks: many rows of a table as one row of binary matrices, and the best of each query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: Column, zero: bool = True) -> Column:
    """Whether a vector is there, not empty, and all its components are finite; ``zero``: and may be all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    fit = finite & (F.size(vector) > 0)
    return fit if zero else fit & F.exists(vector, lambda x: x != 0)


def vectors_of(table: DataFrame, zero: bool = True) -> DataFrame:
    """``vec_id`` and ``embedding`` as doubles of the rows that take part; a null id takes none."""
    rows = table.select(table["vec_id"].cast("long").alias("vec_id"), table["embedding"].cast("array<double>").alias("embedding"))
    return rows.filter(F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("embedding"), zero), F.lit(False)))


def queries_of(vectors: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``; of rows that share an id the smallest vector asks."""
    return vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrices(table: pa.RecordBatch, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, ids, matrix) of a batch in pieces of ``rows``, each of one dimension."""
    lists = table.column("embedding")
    ends = np.asarray(lists.offsets, dtype=np.int64)
    values, ends = np.asarray(lists.flatten(), dtype=np.float64), ends - ends[0]
    ids, dims = np.asarray(table.column("vec_id"), dtype=np.int64), np.diff(ends)
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        for k in range(0, len(at), rows):
            part = at[k : k + rows]
            yield part, ids[part], values[ends[part][:, None] + np.arange(dim)]


def best(found: DataFrame, k: int, nearest: bool) -> DataFrame:
    """The ``k`` best of each query, ranked from 1, ties to the smaller ``vec_id``."""
    score = F.col("score").asc() if nearest else F.col("score").desc()
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(score, "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
