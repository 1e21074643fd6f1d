"""Surrogate keys, dense indexes and picks of parents.

A window without ``partitionBy`` would move every row to one task, so dense numbers come from two
steps: number the rows inside partitions, and shift each partition by the rows before it.  Only
the per-partition counts, one row each, are ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions.draws import pick_below
from orderflow.session import stage

MIN_BUCKETS = 1024
BUCKET_ROWS = 1_000_000  # rows a bucket is meant to hold; beyond it there are more buckets

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id counts rows of a partition in these


def max_id(df: DataFrame, column: str = "id", default: int = 1) -> DataFrame:
    """One row ``max_id``: the largest key, or the default for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(default)).cast("long").alias("max_id"))


def _shifts(counts: DataFrame, part: str, n: str) -> DataFrame:
    """Rows before each partition.  ``counts`` has one row per partition, so one task is enough."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias("_shift"))


def dense_index(df: DataFrame, order_by: list[str], name: str = "idx", start: int | Column = 0) -> DataFrame:
    """``start``, ``start + 1``, ... in the order of ``order_by``, which must be unique.

    Range partitioning spreads the rows evenly; the sorted rows are staged with their partition
    and their place in it, so both passes see the same numbers even if an executor is lost.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    placed = stage(
        ordered.withColumn("_part", F.spark_partition_id()).withColumn(
            "_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))
        ),
        "dense-index",
    )
    shifts = _shifts(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_part", "_n")
    first = start if isinstance(start, Column) else F.lit(start).cast("long")
    return placed.join(F.broadcast(shifts), "_part").select(  # one row per partition: bounded
        *df.columns, (first + F.col("_shift") + F.col("_place")).alias(name)
    )


def assign_keys(df: DataFrame, existing: DataFrame, order_by: list[str], key: str = "id") -> DataFrame:
    """Give each row the next free key of ``existing``, in batch order.

    On an empty table the largest key counts as 1, so the first assigned one is 2.
    """
    top = max_id(existing, key).first()["max_id"]
    numbered = dense_index(df.drop(key) if key in df.columns else df, order_by, "_key", top + 1)
    return numbered.select(F.col("_key").alias(key), *[c for c in numbered.columns if c != "_key"])


def bucket_count(n: int) -> int:
    """Buckets for ``n`` rows, so that a task sorts a bounded number of them at any size."""
    return max(MIN_BUCKETS, -(-n // BUCKET_ROWS))


def dense_by_hash(df: DataFrame, key: str, buckets: int, seed: int = 0, name: str = "idx") -> DataFrame:
    """A dense 0-based index in no meaningful order: by hash bucket, then by key inside it.

    Unlike ``dense_index`` it needs no staging; buckets are even because keys are unique.
    """
    bucketed = df.withColumn("_bucket", pick_below(seed, "bucket", F.col(key), buckets))
    shifts = _shifts(bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), "_bucket", "_n")
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    return (
        bucketed.withColumn("_place", place)
        .join(F.broadcast(shifts), "_bucket")  # one row per bucket: bounded
        .select(*df.columns, (F.col("_shift") + F.col("_place")).alias(name))
    )


def pick_parent(
    child: DataFrame,
    parents: DataFrame,
    parent_key: str,
    name: str,
    seed: int,
    row_id: str,
    carry: list[str] | None = None,
) -> DataFrame:
    """Add ``name``: a parent key picked for each child row, with replacement; ``carry`` names
    further parent columns to bring along.

    The pick is uniform, so the join on the parent's index has no hot key.  The optimizer
    broadcasts the parents when they are small and shuffles both sides when not.
    """
    # counted, bucketed and numbered, so made once
    parents = stage(parents.select(F.col(parent_key).alias(name), *(carry or [])), "parents")
    n = parents.count()
    if n == 0:
        raise ValueError(f"no parents to pick {name} from")
    indexed = dense_by_hash(parents, name, bucket_count(n), seed, "_idx")
    return (
        child.withColumn("_idx", pick_below(seed, f"pick-{name}", F.col(row_id), n))
        .join(indexed, "_idx")
        .select(*child.columns, name, *(carry or []))
    )


def zip_parents(child: DataFrame, child_order: list[str], parents: DataFrame, parent_order: list[str]) -> DataFrame:
    """Pair the i-th child with the i-th parent; rows without a partner drop out."""
    left = dense_index(child, child_order, "_idx")
    right = dense_index(parents, parent_order, "_idx")
    return left.join(right, "_idx").drop("_idx")
