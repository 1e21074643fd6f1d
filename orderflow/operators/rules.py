"""Constraints as operators: keys, uniqueness and references, checked on whole batches.

Neither the rows of a batch nor the stored tables are shuffled to be checked.  For each rule the
*distinct* key values of the batch (partial aggregation shrinks a key that fills a third of the rows
to one row per task) are staged and sent to the tasks that scan the stored keys, see ``probe``.  Only
the violating keys are staged.  They are normally few; as a staged table their size is known: few are
broadcast, many are joined by one shuffle per rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.casts import all_of, first_failing
from orderflow.operators.components import components
from orderflow.operators.probe import Asked, ask, measured, measures, stored_among
from orderflow.operators.skew import LOOKUP_ROWS, left_join_unique
from orderflow.schema import Table
from orderflow.session import stage


# Rows in conflict that one task walks through.
SETTLE_ROWS = 200_000


@dataclass(frozen=True)
class Rule:
    """``columns`` of the batch must (or must not) be among ``stored_columns`` of ``stored``."""

    reason: str
    columns: tuple[str, ...]
    stored: DataFrame
    stored_columns: tuple[str, ...] = ("id",)
    must_exist: bool = True
    ignore_case: bool = False
    null_fails: bool = True

    def batch_key(self, i: int) -> Column:
        c = F.col(self.columns[i])
        return F.lower(c) if self.ignore_case else c

    def stored_key(self, i: int) -> Column:
        c = F.col(self.stored_columns[i])
        return F.lower(c) if self.ignore_case else c


def must_exist(reason: str, column: str, stored: DataFrame, stored_column: str = "id", null_fails: bool = True) -> Rule:
    return Rule(reason, (column,), stored, (stored_column,), True, False, null_fails)


def must_be_new(reason: str, column: str, stored: DataFrame, stored_column: str = "id", ignore_case: bool = False) -> Rule:
    return Rule(reason, (column,), stored, (stored_column,), False, ignore_case, False)


def _text_key(keys: list[Column]) -> Column:
    text = [k.cast("string") for k in keys]
    return text[0] if len(text) == 1 else F.concat_ws("\u001f", *text)


def ask_batch(batch: DataFrame, rules: list[Rule]) -> list[Asked]:
    """The distinct keys that each rule asks for, staged together and measured in one pass."""

    def names(i: int) -> list[str]:
        return [f"k{i}_{j}" for j in range(len(rules[i].columns))]

    kinds = {n: batch.select(rules[i].batch_key(j)).dtypes[0][1] for i in range(len(rules)) for j, n in enumerate(names(i))}
    parts = []
    for i, rule in enumerate(rules):
        own = batch.select(*[rule.batch_key(j).alias(n) for j, n in enumerate(names(i))]).dropna().distinct()
        parts.append(own.select(F.lit(i).alias("rule"), *[(F.col(n) if n in own.columns else F.lit(None).cast(kind)).alias(n) for n, kind in kinds.items()]))
    asked = stage(reduce(DataFrame.unionByName, parts), "asked-keys")
    found = {r["rule"]: r for r in asked.groupBy("rule").agg(*measures(list(kinds))).collect()}  # at most one row per rule
    out = []
    for i in range(len(rules)):
        keys = asked.filter(F.col("rule") == i).select(*names(i))
        out.append(measured(keys, names(i), found[i]) if i in found else Asked(keys, tuple(names(i)), 0, 0, (None,) * len(names(i)), (None,) * len(names(i))))
    return out


def violating_keys(rule: Rule, asked: Asked, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """The asked keys that break the rule, as one text column ``key``."""
    names = list(asked.names)
    kinds = dict(asked.keys.dtypes)
    stored = rule.stored.select(*[rule.stored_key(j).try_cast(kinds[n]).alias(n) for j, n in enumerate(names)])
    held = stored_among(stored, asked, lookup_rows)
    if rule.must_exist:
        # the keys held are some of those asked for, so few of these are few of those
        held = asked.keys.join(F.broadcast(held) if asked.is_small(lookup_rows) else held, names, "left_anti")
    return held.select(_text_key([F.col(n) for n in names]).alias("key"))


def check_rules(batch: DataFrame, rules: list[Rule], lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """``reject_reason`` = the first rule a row breaks, in the given order; earlier reasons stay.

    The key columns of the batch are read once per rule, so it had better be stored or staged.
    The stored keys need not be distinct: semi and anti joins never multiply rows.
    """
    if "reject_reason" not in batch.columns:
        batch = batch.withColumn("reject_reason", F.lit(None).cast("string"))
    live = batch.filter(F.col("reject_reason").isNull())
    asked = ask_batch(live, rules)
    found = [violating_keys(r, a, lookup_rows).select(F.lit(i).alias("rule"), "key") for i, (r, a) in enumerate(zip(rules, asked, strict=True)) if a.n]
    if not found:
        return _with_reasons(batch, rules, {}, None, lookup_rows)
    violations = stage(reduce(DataFrame.unionByName, found), "violations")
    sizes = violations.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("key")).alias("chars"))
    hit = {r["rule"]: (r["n"], r["chars"]) for r in sizes.collect()}  # at most one row per rule
    return _with_reasons(batch, rules, hit, violations, lookup_rows)


def _with_reasons(batch: DataFrame, rules: list[Rule], hit: dict[int, tuple[int, int]], violations: DataFrame | None, lookup_rows: int) -> DataFrame:
    # Whether a rule is broken is a flag from its join on, so that the joins after it need not move its key; text goes
    # first, as the longest.  Where rows know their place, it alone spreads those without a key.
    place = ["_pos"] if "_pos" in batch.columns else batch.columns
    out = batch
    kinds = dict(batch.dtypes)
    order = sorted(range(len(rules)), key=lambda i: not any(kinds[c] == "string" for c in rules[i].columns))
    for i in order:
        rule = rules[i]
        broken = F.lit(False)
        if rule.null_fails:
            broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in rule.columns])
        out = out.withColumn(f"_broken{i}", broken)
        if hit.get(i):
            keys = violations.filter(F.col("rule") == i).select(F.col("key").alias(f"_key{i}"), F.lit(True).alias(f"_hit{i}"))
            own = _text_key([rule.batch_key(j) for j in range(len(rule.columns))])
            out = left_join_unique(out, keys, own, f"_key{i}", *hit[i], lookup_rows, place)
            out = out.withColumn(f"_broken{i}", F.col(f"_broken{i}") | F.coalesce(F.col(f"_hit{i}"), F.lit(False))).drop(f"_hit{i}")
    checks = [(F.col(f"_broken{i}"), rule.reason) for i, rule in enumerate(rules)]
    reason = F.coalesce(F.col("reject_reason"), first_failing(checks))
    return out.withColumn("reject_reason", reason).select(*batch.columns)


def foreign_key_rules(table: Table, parents: dict[str, DataFrame]) -> list[Rule]:
    """Rules of the declared references whose parent table is given.

    A null reference passes where the column may be null.
    """
    return [
        must_exist(f"no_{fk.parent}", fk.column, parents[fk.parent], fk.parent_column, table.attr(fk.column).required)
        for fk in table.foreign_keys
        if fk.parent in parents
    ]


def mark_duplicates(
    batch: DataFrame, key: list[str], position: list[str], reason: str = "duplicate_in_batch", lookup_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """First row per key wins by ``position`` (unique); later ones get the reason.

    No group is gathered in one task: the winner of each key is a partial ``min``.  When few keys
    repeat, those keys are looked up; when many do, rows are matched to winners on key *and*
    position, which is spread evenly however large one group of copies is.
    """
    if "reject_reason" not in batch.columns:
        batch = batch.withColumn("reject_reason", F.lit(None).cast("string"))
    # A NULL key equals no other key.
    live = batch.filter(F.col("reject_reason").isNull()).dropna(subset=key)
    place = F.col(position[0]) if len(position) == 1 else F.struct(*position)
    groups = live.groupBy(*key).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = stage(groups.filter(F.col("_n") > 1).drop("_n"), "repeated-keys")
    n_repeated = repeated.count()
    if n_repeated == 0:
        return batch
    if n_repeated <= lookup_rows:
        marked = batch.join(F.broadcast(repeated), key, "left")
        later = F.col("_first").isNotNull() & (place != F.col("_first"))
    else:
        winners = groups.select(*key, F.col("_first"), F.lit(True).alias("_won"))
        marked = batch.withColumn("_first", place).join(winners, [*key, "_first"], "left")
        later = F.col("_won").isNull() & all_of(F.col(k).isNotNull() for k in key)
    mark = F.coalesce(F.col("reject_reason"), F.when(later, F.lit(reason)))
    return marked.withColumn("reject_reason", mark).select(*batch.columns)


def first_wins(batch: DataFrame, key: list[str], position: list[str]) -> DataFrame:
    """The winning row of each key, in one aggregation: the least row by position.

    Each task keeps one row per key before the shuffle, so a large group of copies costs nothing.
    Rows that tie in everything are the same row; a NULL key equals no other.
    """
    held = [c for c in dict.fromkeys([*position, *batch.columns]) if c not in key]
    least = F.min(F.struct(*held)).alias("_least")
    won = batch.dropna(subset=key).groupBy(*key).agg(least).select(*key, "_least.*")
    unkeyed = batch.filter(~all_of(F.col(k).isNotNull() for k in key))
    return won.select(*batch.columns).unionByName(unkeyed)


def without_existing(batch: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the stored table does not have yet; a null key it never has."""
    asked = ask(stage(batch.select(*key).dropna().distinct(), "asked-keys"))
    if not asked.n:
        return batch
    kinds = dict(asked.keys.dtypes)
    stored = existing.select(*[F.col(k).try_cast(kinds[k]).alias(k) for k in key])
    return batch.join(stage(stored_among(stored, asked), "held-keys"), key, "left_anti")  # its true size decides the join


def split_references(df: DataFrame, column: str, parents: DataFrame, parent_column: str = "id", nullable: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows whose reference has a parent, and the orphans."""
    checked = check_rules(df, [must_exist("orphan", column, parents, parent_column, not nullable)])
    bad = F.col("reject_reason") == "orphan"
    return checked.filter(~F.coalesce(bad, F.lit(False))).select(*df.columns), checked.filter(bad).select(*df.columns)


def outcome_counts(df: DataFrame) -> DataFrame:
    """Rows per outcome: ``accepted`` or the reason of rejection."""
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return df.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


def mark_conflicts(
    batch: DataFrame, uniques: dict[str, str], position: str, lookup_rows: int = LOOKUP_ROWS, settle_rows: int | None = None
) -> DataFrame:
    """Several unique columns at once, as inserting row by row would decide.

    ``uniques`` maps a column to the reason given when an *inserted* earlier row has its value.  A
    row loses only to a row that itself got in, so the columns cannot be handled one after the
    other.  Only rows in repeated groups take part, as keys and positions.  Up to ``settle_rows`` of
    them are walked through in order, by one task.  Of more, those first in all of their groups get in
    and whoever shares a value with them is out; this settles most conflicts.  If many are left after
    two such rounds, the components of rows that share values are settled each in a task, and only
    components of more than ``settle_rows`` go on in rounds.
    """
    settle_rows = SETTLE_ROWS if settle_rows is None else settle_rows
    if "reject_reason" not in batch.columns:
        batch = batch.withColumn("reject_reason", F.lit(None).cast("string"))
    columns = list(uniques)
    keys = {c: f"_u{i}" for i, c in enumerate(columns)}
    live = batch.filter(F.col("reject_reason").isNull()).select(
        F.col(position).alias("_at"), *[F.col(c).alias(k) for c, k in keys.items()]
    )
    every = open_rows = _conflicting(live, list(keys.values()))
    losers: list[DataFrame] = []
    reasons = {k: uniques[c] for c, k in keys.items()}
    rounds = 0
    while n_open := open_rows.count():
        if n_open <= settle_rows:
            losers.append(_settled(open_rows.withColumn("_group", F.lit(0)), reasons))
            break
        if rounds == 2:
            small, open_rows = _small_components(open_rows, list(keys.values()), settle_rows)
            losers.append(_settled(small, reasons))
        rounds += 1
        rest = _round(open_rows, reasons, lookup_rows)
        losers.append(rest.filter(F.col("_why").isNotNull()).select("_at", "_why"))
        open_rows = rest.filter(F.col("_why").isNull()).drop("_why")
    if not losers:
        return batch
    lost = stage(reduce(DataFrame.unionByName, losers), "losers")
    if rounds:
        lost = stage(_reasoned(every, lost, reasons, lookup_rows), "losers")
    marked = batch.join(lost.withColumnRenamed("_at", position), position, "left")
    return marked.withColumn("reject_reason", F.coalesce("reject_reason", "_why")).select(*batch.columns)


def _settled(rows: DataFrame, reasons: dict[str, str]) -> DataFrame:
    """(``_at``, ``_why``) of the rows of each ``_group`` that lose when they are inserted in order."""

    def insert(table: pa.Table) -> pa.Table:
        taken: dict[str, set] = {k: set() for k in reasons}
        order = table.sort_by("_at")
        values = {k: order.column(k).to_pylist() for k in reasons}
        why: list[str | None] = []
        for row in range(order.num_rows):
            own = {k: values[k][row] for k in reasons if values[k][row] is not None}
            reason = next((reasons[k] for k, v in own.items() if v in taken[k]), None)
            if reason is None:
                for k, v in own.items():
                    taken[k].add(v)
            why.append(reason)
        out = pa.table({"_at": order.column("_at"), "_why": pa.array(why, pa.string())})
        return out.filter(out.column("_why").is_valid())

    kind = dict(rows.dtypes)["_at"]
    return rows.groupBy("_group").applyInArrow(insert, f"_at {kind}, _why string")


def _round(open_rows: DataFrame, reasons: dict[str, str], lookup_rows: int) -> DataFrame:
    """All but the rows that are first in each of their groups, with ``_why`` if they share a value with such a row."""
    first = open_rows
    for k in reasons:
        lead = open_rows.groupBy(k).agg(F.min("_at").alias("_at"))
        # Joined on value and position, which no hot value can skew; a NULL value is never taken.
        named = first.filter(F.col(k).isNotNull()).join(lead, [k, "_at"], "left_semi")
        first = named.unionByName(first.filter(F.col(k).isNull()))
    winners = stage(first, "winners")
    rest = open_rows.join(winners.select("_at"), "_at", "left_anti")
    n_winners, *chars = winners.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(F.length(k)), F.lit(0)) for k in reasons]).first()
    for (k, reason), size in zip(reasons.items(), chars):
        taken = winners.select(F.col(k).alias("_taken"), F.lit(reason).alias(f"_why{k}")).dropna()
        rest = left_join_unique(rest, taken, F.col(k), "_taken", n_winners, size, lookup_rows)
    why = F.coalesce(*[F.col(f"_why{k}") for k in reasons])
    return stage(rest.select("_at", *reasons, why.alias("_why")), "conflicts")


def _reasoned(rows: DataFrame, lost: DataFrame, reasons: dict[str, str], lookup_rows: int) -> DataFrame:
    """``lost`` with the reason a row-by-row insert gives: the first column whose value an earlier row got in with.

    A round knows only the winners so far, of which a later one may hold a value of an earlier column.
    """
    winners = stage(rows.join(lost.select("_at"), "_at", "left_anti"), "winners")
    n_winners, *chars = winners.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(F.length(k)), F.lit(0)) for k in reasons]).first()
    out = rows.join(lost.select("_at"), "_at", "left_semi")
    why = []
    for (k, reason), size in zip(reasons.items(), chars):
        holder = winners.select(F.col(k).alias("_taken"), F.col("_at").alias(f"_by{k}")).dropna()
        out = left_join_unique(out, holder, F.col(k), "_taken", n_winners, size, lookup_rows)
        why.append(F.when(F.col(f"_by{k}") < F.col("_at"), reason))
    return out.select("_at", F.coalesce(*why).alias("_why"))


def _small_components(open_rows: DataFrame, keys: list[str], settle_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows in components of at most ``settle_rows`` rows, with their ``_group``, and the other rows."""
    tied = []
    for k in keys:
        lead = open_rows.dropna(subset=[k]).groupBy(k).agg(F.min("_at").alias("b"))
        tied.append(open_rows.join(lead, k).select(F.col("_at").alias("a"), "b"))
    found = stage(components(reduce(DataFrame.unionByName, tied)), "components")
    large = found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > settle_rows).select("component")
    grouped = open_rows.join(found.withColumnRenamed("node", "_at"), "_at", "left").withColumn("_group", F.coalesce("component", "_at")).drop("component")
    grouped = stage(grouped.join(large.select(F.col("component").alias("_group"), F.lit(True).alias("_large")), "_group", "left"), "conflicts")
    return grouped.filter(F.col("_large").isNull()).drop("_large"), grouped.filter("_large").drop("_large", "_group")


def _conflicting(live: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that share a value of some key with another row."""
    parts = []
    for k in keys:
        repeated = live.dropna(subset=[k]).groupBy(k).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(k)
        parts.append(live.join(stage(repeated, "repeated-keys"), k, "left_semi").select(*live.columns))
    return stage(reduce(DataFrame.unionByName, parts).distinct(), "conflicts")
