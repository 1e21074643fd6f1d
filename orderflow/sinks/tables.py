"""Appending accepted rows to stored Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.operators.keys import assign_keys, dense_index, max_id
from orderflow.schema import DRIVER, RESTAURANT, SPARK_TYPES, TABLES, Table


def append_table(df: DataFrame, root: str, name: str) -> None:
    """Append; a missing column of the table is simply not written, as in a partial insert."""
    columns = [c for c in TABLES[name].columns if c in df.columns]
    df.select(*columns).write.mode("append").parquet(f"{root.rstrip('/')}/{name}.parquet")


def target_rows(df: DataFrame, table: Table, columns: dict[str, str], fixed: dict[str, object]) -> DataFrame:
    """The columns of ``table`` that ``columns`` (by name in ``df``) and ``fixed`` give, in its own types."""
    given = {**{c: F.col(name) for c, name in columns.items()}, **{c: F.lit(v) for c, v in fixed.items()}}
    kinds = {a.name: SPARK_TYPES[a.kind] for a in table.attrs}
    return df.select(*[given[c].cast(kinds[c]).alias(c) for c in table.columns if c in given])


def numbered(df: DataFrame, tops: dict[str, int], order_by: list[str]) -> DataFrame:
    """``df`` with the columns of ``tops``, counted up from the keys in use by one dense numbering."""
    return dense_index(df, order_by, "_n", 1).select(*df.columns, *[(F.col("_n") + top).alias(c) for c, top in tops.items()])


def user_rows(df: DataFrame) -> DataFrame:
    flags = ("enabled", "confirmed", "account_non_expired", "account_non_locked", "credentials_non_expired")
    return df.select("id", "user_role", "password", "email", *flags)


def order_rows(df: DataFrame, existing: DataFrame, order_by: list[str]) -> DataFrame:
    """Orders to insert: given ids stay, NULL ids are assigned after the largest id of both.

    The table and the batch together decide where free keys start.
    """
    columns = ["id", "customer_id", "restaurant_id", "delivery_id", "confirmation_code"]
    given = df.filter(F.col("id").isNotNull()).select(*columns)
    unnamed = df.filter(F.col("id").isNull()).select(*dict.fromkeys([*columns, *order_by]))
    if unnamed.isEmpty():
        return given
    taken = existing.select("id").unionByName(given.select("id"))
    return given.unionByName(assign_keys(unnamed, taken, order_by).select(*columns))


def driver_rows(df: DataFrame) -> DataFrame:
    """Picture and status are set here, and the derived e-mail is not stored."""
    (target,) = DRIVER.targets
    columns = {c: c for c in DRIVER.columns if c in TABLES["driver"].columns} | (target.columns if "user_id" in df.columns else {"id": "id"})
    return target_rows(df, TABLES["driver"], columns, target.fixed)


def address_and_restaurant_rows(df: DataFrame, addresses: DataFrame, restaurants: DataFrame, order_by: list[str]) -> dict[str, DataFrame]:
    """Split flat restaurant rows into an address and a restaurant each.

    Both keys come from one dense numbering of the batch, so parent and child agree without a
    round trip per row.
    """
    tops = {"_address": max_id(addresses).first()["max_id"], "_restaurant": max_id(restaurants).first()["max_id"]}
    rows = numbered(df, tops, order_by)
    place, shop = RESTAURANT.targets
    own = {c: c for c in RESTAURANT.columns if c in TABLES["restaurant"].columns}
    return {
        "address": target_rows(rows, TABLES["address"], {"id": "_address", "city": "city", "state": "state", "zip": "zip", **place.columns}, place.fixed),
        "restaurant": target_rows(rows, TABLES["restaurant"], {**own, "id": "_restaurant", "address_id": "_address"}, shop.fixed),
    }
