"""Left joins to unique keys, in one pass over the left side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key tables up to this size, measured before, are broadcast.
LOOKUP_ROWS = 100_000
LOOKUP_CHARS = 16 * 1024 * 1024

# Parts that rows without a key are dealt over.
NO_KEY_PARTS = 4096


def left_join_unique(
    left: DataFrame, right: DataFrame, own: Column, key: str, n_right: int, chars: int = 0, lookup_rows: int = LOOKUP_ROWS, spread_by: list[str] | None = None
) -> DataFrame:
    """``left`` with the columns of ``right`` where ``own`` equals its unique column ``key``.

    ``right`` is a staged table of ``n_right`` rows and ``chars`` characters of keys.  A small one is
    broadcast.  Beside a large one the rows are shuffled once by key, and the adaptive skew join splits
    the partition of a hot key, whose one row on the right is read again per split.  Rows without a
    key carry a number in its place, so that they spread: a hash of ``spread_by``, or of all columns, which
    then all move.
    """
    if n_right <= lookup_rows and chars <= LOOKUP_CHARS:
        return left.join(F.broadcast(right), own == F.col(key), "left").drop(key)
    spread = F.when(own.isNull(), F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(NO_KEY_PARTS)))
    keyed = left.withColumn("_own", own).withColumn("_spread", F.coalesce(spread, F.lit(-1)))
    matched = (F.col("_own") == F.col(key)) & (F.col("_spread") == F.col("_none"))
    return keyed.join(right.withColumn("_none", F.lit(-1).cast("long")), matched, "left").drop("_own", "_spread", "_none", key)
