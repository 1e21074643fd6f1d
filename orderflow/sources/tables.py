"""Scans of stored tables and of their keys.  Column pruning is left to the optimizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _with_footers(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose minima, maxima and counts come from the footers of its files.

    Spark's second Parquet reader does so where it is allowed to; which reader serves a frame is decided
    when the frame is made.
    """
    setting = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(setting, before)


def max_key_plan(spark: SparkSession, root: str, name: str, column: str = "id") -> DataFrame:
    """One row ``max_id``: the largest key of a stored table, null if it has none."""
    return _with_footers(spark, f"{root.rstrip('/')}/{name}.parquet").agg(F.max(column).cast("long").alias("max_id"))


def max_key(spark: SparkSession, root: str, name: str, column: str = "id") -> int | None:
    """The largest key of a stored table without reading its rows; None if there is no table or no key."""
    if not exists(spark, f"{root.rstrip('/')}/{name}.parquet"):
        return None
    setting = "spark.sql.parquet.aggregatePushdown"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        return max_key_plan(spark, root, name, column).first()["max_id"]
    finally:
        spark.conf.set(setting, before)


def keys(df: DataFrame, column: str = "id") -> DataFrame:
    return df.select(F.col(column).alias("id"))


def hex_keys(df: DataFrame, column: str = "id") -> DataFrame:
    """Binary keys as lower-case hex text."""
    return df.select(F.lower(F.hex(column)).alias("id"))


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower: int = 0,
    upper: int = 0,
    partitions: int = 1,
) -> DataFrame:
    """A relational table; with a numeric ``partition_column`` it is read in parallel ranges.

    The bounds only shape the ranges: rows outside them are read too.
    """
    if partition_column is None:
        return spark.read.jdbc(url, name, properties=properties)
    return spark.read.jdbc(
        url, name, column=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=properties
    )


def append_jdbc(df: DataFrame, url: str, name: str, properties: dict[str, str], batch_size: int = 10_000, binary_ids: tuple[str, ...] = ()) -> None:
    """Append to a relational table in batches; ``binary_ids`` are hex columns stored as binary."""
    out = df.select(*[F.unhex(c).alias(c) if c in binary_ids else F.col(c) for c in df.columns])
    out.write.option("batchsize", batch_size).jdbc(url, name, mode="append", properties=properties)
