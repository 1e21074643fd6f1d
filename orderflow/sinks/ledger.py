"""Keys assigned once: a ledger beside a table remembers which row of which file got which key.

A row that comes without a key is known by its file and its number in it.  Its key is written to the
ledger before any table is touched, and taken from there ever after.  So a save that broke half way,
is repeated, or is repeated by another run over the same file, appends what is missing and nothing
twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.keys import dense_index
from orderflow.operators.probe import Asked, ask, stored_among
from orderflow.operators.rules import without_existing
from orderflow.session import stage
from orderflow.sources.tables import exists, max_key

SOURCE = "_source"


def stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    path = f"{root.rstrip('/')}/{name}.parquet"
    return spark.read.parquet(path) if exists(spark, path) else None


def with_source(rows: DataFrame) -> DataFrame:
    """``rows`` (``_file``, ``_pos``) with ``_source``: file and number of the row in it, whatever way the file was split."""
    numbered = dense_index(rows, ["_file", "_pos"], "_row")
    firsts = stage(numbered.groupBy("_file").agg(F.min("_row").alias("_first")), "file-rows")  # its true size decides the join
    source = F.concat_ws("#", "_file", F.lpad((F.col("_row") - F.col("_first")).cast("string"), 15, "0"))
    return numbered.join(firsts, "_file").withColumn(SOURCE, source).select(*rows.columns, SOURCE)


def _entries(ledger: DataFrame, asked: Asked) -> DataFrame:
    between = ledger.filter(F.col(SOURCE).between(F.lit(asked.low[0]), F.lit(asked.high[0])))
    return between.join(F.broadcast(asked.keys) if asked.is_small() else asked.keys, SOURCE)


def keyed(rows: DataFrame, root: str, name: str, tops: dict[str, int]) -> DataFrame:
    """``rows`` (``_source``, unique) with the columns of ``tops``: the key the ledger has for a row, else the next free one.

    ``tops`` gives the largest key of each column in use; free keys start after it and after those of the ledger.
    """
    spark = rows.sparkSession
    ledger_name = f"{name}_ledger"
    asked = ask(stage(rows.select(SOURCE), "sources"))
    if not asked.n:
        return rows.select("*", *[F.lit(None).cast("long").alias(c) for c in tops])
    ledger = stored(spark, root, ledger_name)
    fresh = asked.keys
    if ledger is not None:
        known = stage(stored_among(ledger.select(SOURCE), asked), "known-sources")
        fresh = fresh.join(known, SOURCE, "left_anti")
        tops = {c: max(top, max_key(spark, root, ledger_name, c) or top) for c, top in tops.items()}
    numbered = dense_index(fresh, [SOURCE], "_n", 1)
    entries = numbered.select(SOURCE, *[(F.col("_n") + top).alias(c) for c, top in tops.items()])
    entries.write.mode("append").parquet(f"{root.rstrip('/')}/{ledger_name}.parquet")
    return rows.join(_entries(stored(spark, root, ledger_name), asked), SOURCE)


def append_new(rows: DataFrame, root: str, name: str, key: list[str], append) -> None:
    """Append the rows whose key the table does not have yet."""
    held = stored(rows.sparkSession, root, name)
    append(rows if held is None else without_existing(rows, held, key), root, name)
