"""The relational queries around the tables: plain DataFrame plans, left to the optimizer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREVIEW_ROWS = 10  # fixed value: rows shown before a batch is saved


def without_match(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``left`` with no partner in ``right``, such as users who are not drivers yet."""
    return left.join(right.select(key), key, "left_anti")


def delivery_chain(
    orders: DataFrame, restaurants: DataFrame, addresses: DataFrame, deliveries: DataFrame, drivers: DataFrame
) -> DataFrame:
    """Order, restaurant and its address, delivery, driver and the driver's address: one row per
    order that has them all, as their keys.

    Only key columns travel.  The optimizer broadcasts the dimensions that fit.
    """
    place = addresses.select(F.col("id").alias("address_id"))
    shop = restaurants.select(F.col("id").alias("restaurant_id"), "address_id").join(place, "address_id")
    rider = drivers.select(F.col("id").alias("driver_id"), "address_id").join(place, "address_id")
    trip = deliveries.select(F.col("id").alias("delivery_id"), "driver_id").join(
        rider.withColumnRenamed("address_id", "driver_address_id"), "driver_id"
    )
    return (
        orders.select(F.col("id").alias("order_id"), "restaurant_id", "delivery_id")
        .join(shop.withColumnRenamed("address_id", "restaurant_address_id"), "restaurant_id")
        .join(trip, "delivery_id")
    )


_CHAIN_COUNTS = {
    "deliveries": "delivery_id",
    "orders": "order_id",
    "drivers": "driver_id",
    "restaurants": "restaurant_id",
}
_CHAIN_ADDRESSES = ("restaurant_address_id", "driver_address_id")


def chain_counts(chain: DataFrame) -> DataFrame:
    """Joined rows counted per column, as reported before everything is deleted.

    An inner join leaves no NULL, so all counts are equal; see ``chain_counts_distinct``.
    """
    counts = [F.count(c).alias(name) for name, c in _CHAIN_COUNTS.items()]
    both = F.count(_CHAIN_ADDRESSES[0]) + F.count(_CHAIN_ADDRESSES[1])
    return chain.agg(*counts, both.alias("addresses"))


def chain_counts_distinct(chain: DataFrame) -> DataFrame:
    """Rows of each table that take part in the chain.

    The chain holds an order at most once, since every table it joins has unique keys, so orders
    are simply counted; the other columns are counted distinct in the same pass.
    """
    counts = [
        (F.count(c) if name == "orders" else F.countDistinct(c)).alias(name) for name, c in _CHAIN_COUNTS.items()
    ]
    both = F.countDistinct(_CHAIN_ADDRESSES[0]) + F.countDistinct(_CHAIN_ADDRESSES[1])
    return chain.agg(*counts, both.alias("addresses"))


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def dependency_gates(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its size, and whether it is empty (which stops dependent work)."""
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n")).withColumn("is_empty", F.col("n") == 0)
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def first_empty(tables: dict[str, DataFrame]) -> str | None:
    """Name of the first empty table; looks at one row of each."""
    return next((name for name, df in tables.items() if df.isEmpty()), None)


def preview(df: DataFrame, order_by: list[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows, each with how many more there are.

    Sort and limit become a top-n: no task holds more than ``n`` rows.
    """
    total = df.count()
    return df.orderBy(*order_by).limit(n).withColumn("remaining", F.lit(max(total - n, 0)).cast("long"))


def concat_batches(*batches: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, batches)
