"""Looking up the keys of a batch in a stored table without moving that table.

A stored table may be many thousand times the batch.  Its key column is therefore never shuffled as a
whole: the distinct keys of the batch, staged and measured, go to the tasks that scan it.  Few keys are
broadcast.  Of more keys a bitmap is broadcast, built by Spark from their hashes and bounded in size;
only stored keys that pass it are shuffled to meet the batch's.  Either way the least and the greatest
key of the batch are pushed into the scan, where Parquet skips what lies outside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.operators.skew import LOOKUP_CHARS, LOOKUP_ROWS

BITS_PER_KEY = 16  # one stored key in sixteen passes by chance
BITMAP_KEYS = 1 << 24  # beyond it (a bitmap of 32 MB) the batch's keys are so many that both sides are shuffled
_CELL = 32_768  # bits of one row of Spark's bitmaps


@dataclass(frozen=True)
class Asked:
    """Distinct keys of a batch, as a stored table of columns ``names``, and what was measured of them."""

    keys: DataFrame
    names: tuple[str, ...]
    n: int
    chars: int
    low: tuple  # least and greatest value of each column
    high: tuple

    def is_small(self, lookup_rows: int = LOOKUP_ROWS) -> bool:
        return self.n <= lookup_rows and self.chars <= LOOKUP_CHARS


def measures(names: list[str]) -> list[Column]:
    """Aggregates that ``measured`` reads back: rows, characters, least and greatest keys."""
    chars = sum((F.coalesce(F.length(F.col(n).cast("string")), F.lit(0)) for n in names), F.lit(0))
    return [
        F.count(F.lit(1)).alias("_n"),
        F.coalesce(F.sum(chars), F.lit(0)).alias("_chars"),
        *[F.min(n).alias(f"_low_{n}") for n in names],
        *[F.max(n).alias(f"_high_{n}") for n in names],
    ]


def measured(keys: DataFrame, names: list[str], row) -> Asked:
    low, high = (tuple(row[f"_{end}_{n}"] for n in names) for end in ("low", "high"))
    return Asked(keys, tuple(names), row["_n"], row["_chars"], low, high)


def ask(keys: DataFrame) -> Asked:
    """Measure a stored table of distinct keys."""
    names = keys.columns
    return measured(keys, names, keys.agg(*measures(names)).first())


def _cell(names: list[str], bits: int) -> tuple[Column, Column]:
    """Row of the bitmap and place in it of a key."""
    at = F.pmod(F.xxhash64(*names), F.lit(bits))
    return F.floor(at / _CELL).cast("long"), F.pmod(at, F.lit(_CELL)).cast("int")


def _may_be_asked(stored: DataFrame, asked: Asked) -> DataFrame:
    """Rows of ``stored`` whose key passes the bitmap of the asked keys."""
    bits = -(-asked.n * BITS_PER_KEY // _CELL) * _CELL
    cell, place = _cell(list(asked.names), bits)
    bitmap = asked.keys.select(cell.alias("_cell"), place.alias("_place")).groupBy("_cell").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    marked = stored.withColumn("_cell", cell).withColumn("_place", place)
    met = marked.join(F.broadcast(bitmap), "_cell")  # at most ``bits`` bits
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(F.col("_place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.filter(F.getbit(byte, F.pmod(F.col("_place"), F.lit(8))) == 1).select(*stored.columns)


def stored_among(stored: DataFrame, asked: Asked, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """The asked keys that ``stored`` holds, once each.

    ``stored`` has the columns ``asked.names``, of the same types; its keys need not be distinct, and
    null ones match nothing.
    """
    names = list(asked.names)
    for name, low, high in zip(names, asked.low, asked.high, strict=True):
        stored = stored.filter(F.col(name).between(F.lit(low), F.lit(high)))
    if asked.is_small(lookup_rows):
        return stored.join(F.broadcast(asked.keys), names, "left_semi").distinct()
    if asked.n <= BITMAP_KEYS:
        stored = _may_be_asked(stored, asked)
    return stored.distinct().join(asked.keys, names, "left_semi")
