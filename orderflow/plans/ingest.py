"""Ingest jobs: read, check, append, report.

What is checked and appended follows from the declarations in ``schema``; the jobs of the four file
entities differ in nothing else, and a further entity needs a declaration only.

Each job returns an ``Ingest`` whose rows carry a reason or none.  ``save`` appends the accepted
rows.  The file is parsed once, into a staged table; the checks stage only the few keys that break
a rule, so counting outcomes, listing rejects and saving each are one scan of the staged rows.
A save may be repeated, also by another run over the same file: rows stored already are known by
their key, and keys that were assigned by the ledger (``sinks.ledger``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.keys import max_id
from orderflow.operators.rules import outcome_counts
from orderflow.plans import constraints
from orderflow.plans.constraints import Tables
from orderflow.schema import DRIVER, ORDER, RESTAURANT, TABLES, USER, Entity
from orderflow.sinks import ledger
from orderflow.sinks import tables as sink
from orderflow.sources.files import CONTROL, read_entity
from orderflow.sources.tables import max_key


@dataclass(frozen=True)
class Ingest:
    """Checked rows and, per table, the rows to append, which are planned when first asked for.

    ``plan_inserts`` is given the root of the stored tables, or None to plan them without a ledger.
    """

    rows: DataFrame
    plan_inserts: Callable[[str | None], Tables]

    @cached_property
    def inserts(self) -> Tables:
        return self.plan_inserts(None)

    @property
    def rejected(self) -> DataFrame:
        return self.rows.filter(F.col("reject_reason").isNotNull())

    @property
    def outcome(self) -> DataFrame:
        return outcome_counts(self.rows)

    def save(self, root: str) -> None:
        """Append what is not stored yet, parents first, as the dictionary is ordered."""
        for name, df in self.plan_inserts(root).items():
            ledger.append_new(df, root, name, list(TABLES[name].primary_key), sink.append_table)


def _good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNull())


def check_users(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Column limits, then key and e-mail against the table, then both inside the batch."""
    return constraints.check(rows, USER, {"user": users})


def _top(spark: SparkSession, name: str, tables: Tables, root: str | None) -> int:
    """The largest key in use, 1 if there is none: of the stored table by its footers, else of the one given."""
    held = max_key(spark, root, name) if root else None
    if held is not None:
        return held
    return max_id(tables[name]).first()["max_id"] if name in tables else 1


def plan_rows(rows: DataFrame, entity: Entity, tables: Tables, root: str | None) -> Tables:
    """Rows to append per target of the entity.

    Keys that are made come from the ledger under ``root``; without a root from a dense numbering of
    the batch.  Either way a parent and its child share one row's keys.
    """
    good = _good(rows)
    made = {(t.table, c): f"_{t.table}_{c}" for t in constraints.targets_of(entity) for c in t.made if c in TABLES[t.table].primary_key}
    if made:
        tops = {name: _top(rows.sparkSession, table, tables, root) for (table, _), name in made.items()}
        good = ledger.keyed(ledger.with_source(rows).filter("reject_reason is null"), root, entity.name, tops) if root else sink.numbered(good, tops, ["_pos"])
    out: Tables = {}
    for target in constraints.targets_of(entity):
        table = TABLES[target.table]
        columns = constraints.columns_from(entity, target)
        for fk in table.foreign_keys:
            if fk.column in target.made:
                columns[fk.column] = made[fk.parent, fk.parent_column]
        columns |= {c: made[target.table, c] for c in target.made if (target.table, c) in made}
        out[target.table] = sink.target_rows(good, table, columns, target.fixed)
    return out


def ingest_entity(spark: SparkSession, path: str, entity: Entity, tables: Tables, strict: bool = True, **options) -> Ingest:
    """The job of any declared entity; ``tables`` holds the stored tables that are to be looked at."""
    rows = constraints.check(read_entity(spark, path, entity, strict, **options), entity, tables)
    return Ingest(rows, lambda root: plan_rows(rows, entity, tables, root))


def ingest_users(spark: SparkSession, path: str, tables: Tables, strict: bool = True, **options) -> Ingest:
    return ingest_entity(spark, path, USER, {"user": tables["user"]}, strict, **options)


def ingest_orders(spark: SparkSession, path: str, tables: Tables, strict: bool = True, **options) -> Ingest:
    """Orders may come without id, which is then assigned after the largest of the table and the batch."""
    checked = ingest_entity(spark, path, ORDER, tables, strict, **options)

    def plan(root: str | None) -> Tables:
        good = _good(checked.rows)
        if root is None or good.filter("id is null").isEmpty():
            return {"order": sink.order_rows(good, tables["order"], ["_pos"])}
        sourced = ledger.with_source(checked.rows).filter("reject_reason is null")
        given = sourced.filter("id is not null")
        top = max(_top(spark, "order", tables, root), max_id(given).first()["max_id"])
        unnamed = ledger.keyed(sourced.filter("id is null"), root, "order", {"_key": top}).withColumn("id", F.col("_key"))
        return {"order": given.select(*ORDER.columns).unionByName(unnamed.select(*ORDER.columns))}

    return Ingest(checked.rows, plan)


def ingest_drivers(spark: SparkSession, path: str, tables: Tables, strict: bool = False, **options) -> Ingest:
    return ingest_entity(spark, path, DRIVER, tables, strict, **options)


def ingest_restaurants(spark: SparkSession, path: str, tables: Tables, strict: bool = False, **options) -> Ingest:
    """Addresses are made for accepted restaurants only."""
    return ingest_entity(spark, path, RESTAURANT, tables, strict, **options)


def ingest_with(
    spark: SparkSession, path: str, entity: Entity, mapper: Callable[[DataFrame], DataFrame], strict: bool = False, **options
) -> DataFrame:
    """Read any entity and hand its accepted rows to ``mapper``, a DataFrame function."""
    return mapper(_good(read_entity(spark, path, entity, strict, **options)).drop(*CONTROL))
