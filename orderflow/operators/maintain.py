"""Deleting with references: everything in order, cascades, and refusals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.operators.relational import chain_counts, delivery_chain
from orderflow.schema import DELETE_ORDER, TABLES
from orderflow.sources.tables import table


def delete_plan(tables: dict[str, DataFrame]) -> DataFrame:
    """What a delete-all reports: the counts over the order chain."""
    chain = delivery_chain(tables["order"], tables["restaurant"], tables["address"], tables["delivery"], tables["driver"])
    return chain_counts(chain)


def delete_all(spark, root: str) -> list[str]:
    """Empty every stored table under ``root``, children before parents.

    Files have no transaction over several tables; each overwrite is idempotent, so an
    interrupted run is simply repeated.
    """
    for name in DELETE_ORDER:
        empty = spark.createDataFrame([], table(spark, root, name).schema)
        empty.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}.parquet")
    return list(DELETE_ORDER)


def children_of(parent: str) -> list[tuple[str, str, bool]]:
    """(child table, its column, cascades) for every declared reference to ``parent``."""
    return [(t.name, fk.column, fk.cascade) for t in TABLES.values() for fk in t.foreign_keys if fk.parent == parent]


def blocked_deletes(doomed: DataFrame, parent: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Keys among ``doomed`` (column ``id``) that a child without cascade still refers to.

    A child reached by a cascade blocks the delete in turn when its own children do not cascade.
    """
    blocked = doomed.select("id").limit(0)
    for child, column, cascades in children_of(parent):
        if child not in tables:
            continue
        if not cascades:
            used = tables[child].select(F.col(column).alias("id"))
            blocked = blocked.unionByName(doomed.select("id").join(used, "id", "left_semi"))
            continue
        reached = tables[child].join(doomed.select(F.col("id").alias(column)), column, "left_semi").select("id", column)
        stuck = blocked_deletes(reached.select("id"), child, tables)
        blocked = blocked.unionByName(reached.join(stuck, "id", "left_semi").select(F.col(column).alias("id")))
    return blocked.distinct()


def cascade_delete(doomed: DataFrame, parent: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables left after deleting ``doomed`` keys from ``parent``: blocked keys stay, and the
    rows of cascading children go with their parents."""
    free = doomed.select("id").join(blocked_deletes(doomed, parent, tables), "id", "left_anti")
    left = dict(tables)
    left[parent] = tables[parent].join(free, "id", "left_anti")
    for child, column, cascades in children_of(parent):
        if cascades and child in tables:
            gone = tables[child].join(free.select(F.col("id").alias(column)), column, "left_semi").select("id")
            left.update({k: v for k, v in cascade_delete(gone, child, tables).items() if v is not tables[k]})
    return left
