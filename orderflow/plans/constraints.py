"""Checks planned from the declared tables: what a row must satisfy before it is appended.

An entity names the tables its rows go to, and which column of the file each of their columns comes
from.  From the declaration of a table follow, in this order: limits of its columns, its key against
the stored keys, its unique columns against the stored ones, its references in declared order, and
then its keys inside the batch.  The first that fails is the reason.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.casts import first_failing
from orderflow.operators.rules import Rule, check_rules, mark_conflicts, mark_duplicates, must_be_new
from orderflow.schema import TABLES, Entity, Table, Target

Tables = dict[str, DataFrame]


def targets_of(entity: Entity) -> tuple[Target, ...]:
    if entity.targets:
        return entity.targets
    return (Target(entity.table),) if entity.table else ()


def columns_from(entity: Entity, target: Target) -> dict[str, str]:
    """Column of the file for each column of the table that the file brings."""
    table = TABLES[target.table]
    own = {c: c for c in table.columns if c in entity.columns and c not in target.made}
    return {**own, **target.columns}


def domain_checks(table: Table, columns: dict[str, str], made: tuple[str, ...]) -> list[tuple[Column, str]]:
    """Limits of the columns: not null and no longer than declared.

    References are left to their own rule, and so is a key that is assigned where it is null.
    """
    referring = {fk.column for fk in table.foreign_keys}
    assigned = {a.name for a in table.attrs if a.kind == "long" and (a.name,) == table.primary_key} | set(made)
    checks: list[tuple[Column, str]] = []
    for a in table.attrs:
        if a.name not in columns:
            continue
        c = F.col(columns[a.name])
        if a.required and a.name not in referring | assigned:
            checks.append((c.isNull(), f"not_null:{a.name}"))
        if a.max_len is not None:
            checks.append((F.length(c.cast("string")) > a.max_len, f"too_long:{a.name}"))
    return checks


def stored_rules(table: Table, columns: dict[str, str], tables: Tables, made: tuple[str, ...]) -> list[Rule]:
    """Key and unique columns must be new, references must exist; of the stored tables only those given are looked at."""
    rules: list[Rule] = []
    stored = tables.get(table.name)
    if stored is not None:
        if set(table.primary_key) <= set(columns):
            own = tuple(columns[k] for k in table.primary_key)
            rules.append(Rule(f"{table.name}_exists", own, stored, table.primary_key, must_exist=False, null_fails=False))
        rules += [must_be_new(f"{u}_exists", columns[u], stored, u, ignore_case=True) for u in table.unique if u in columns]
    for fk in table.foreign_keys:
        if fk.parent in tables and fk.column in columns and fk.column not in made:
            required = table.attr(fk.column).required
            rules.append(Rule(f"no_{fk.parent}", (columns[fk.column],), tables[fk.parent], (fk.parent_column,), null_fails=required))
    return rules


def mark_repeats(rows: DataFrame, table: Table, columns: dict[str, str], position: str) -> DataFrame:
    """Keys and unique columns inside the batch, as row-by-row inserts would decide."""
    key = [columns[k] for k in table.primary_key] if set(table.primary_key) <= set(columns) else []
    unique = [u for u in table.unique if u in columns]
    if not unique:
        return mark_duplicates(rows, key, [position]) if key else rows
    private = {f"_unique{i}": F.lower(F.col(columns[u])) for i, u in enumerate(unique)}
    reasons = {name: f"duplicate_{u}" for name, u in zip(private, unique, strict=True)}
    if key:
        whole = F.col(key[0]) if len(key) == 1 else F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]), F.to_json(F.struct(*key)))
        private, reasons = {"_key": whole, **private}, {"_key": "duplicate_in_batch", **reasons}
    return mark_conflicts(rows.withColumns(private), reasons, position).drop(*private)


def check(rows: DataFrame, entity: Entity, tables: Tables, position: str = "_pos") -> DataFrame:
    """``rows`` with ``reject_reason``: the first constraint of the entity's tables a row breaks; earlier reasons stay."""
    planned = [(TABLES[t.table], columns_from(entity, t), t.made) for t in targets_of(entity)]
    limits = [c for table, columns, made in planned for c in domain_checks(table, columns, made)]
    reason = F.col("reject_reason") if "reject_reason" in rows.columns else F.lit(None).cast("string")
    rows = rows.withColumn("reject_reason", F.coalesce(reason, first_failing(limits)))
    rules = [r for table, columns, made in planned for r in stored_rules(table, columns, tables, made)]
    if rules:
        rows = check_rules(rows, rules)
    for table, columns, _ in planned:
        rows = mark_repeats(rows, table, columns, position)
    return rows
