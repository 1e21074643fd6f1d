"""Constraints against brute force in plain Python."""

import random
import time

import pytest
from pyspark.sql import functions as F

from orderflow.operators import probe, rules
from orderflow.operators.components import components
from orderflow.schema import TABLES
from orderflow.session import stage


def insert_one_by_one(rows, existing_ids, existing_mails):
    """What inserting row after row into a table with two unique columns decides."""
    ids, mails, out = set(existing_ids), set(existing_mails), {}
    for pos, key, mail in rows:
        if key is not None and key in ids:
            out[pos] = "duplicate_in_batch"
        elif mail is not None and mail in mails:
            out[pos] = "duplicate_email"
        else:
            out[pos] = None
            ids.add(key)
            mails.add(mail)
    return out


@pytest.mark.parametrize(("seed", "lookup_rows", "settle_rows"), [(1, 100_000, None), (2, 100_000, 0), (3, 0, 0), (4, 0, 6)])
def test_two_unique_columns_decide_like_row_by_row_inserts(spark, seed, lookup_rows, settle_rows):
    rnd = random.Random(seed)
    rows = [(i, f"k{rnd.randrange(25)}", rnd.choice([None, f"m{rnd.randrange(20)}"])) for i in range(80)]
    df = spark.createDataFrame(rows, "pos long, id string, mail string").repartition(3)
    got = rules.mark_conflicts(df, {"id": "duplicate_in_batch", "mail": "duplicate_email"}, "pos", lookup_rows, settle_rows)
    assert {r["pos"]: r["reject_reason"] for r in got.collect()} == insert_one_by_one(rows, [], [])
    assert got.count() == len(rows)


def _chains(lengths):
    """Rows each of which shares its id with the one before and its mail with the one after it."""
    rows, at = [], 0
    for c, n in enumerate(lengths):
        for i in range(n):
            rows.append((at, f"k{c}-{(i + 1) // 2}", f"m{c}-{i // 2}"))
            at += 1
    return rows


def test_a_chain_of_conflicts_takes_a_bounded_number_of_jobs(spark):
    rows = _chains([2000])
    df = spark.createDataFrame(rows, "pos long, id string, mail string").repartition(3)
    start = time.monotonic()
    got = {r["pos"]: r["reject_reason"] for r in rules.mark_conflicts(df, {"id": "duplicate_in_batch", "mail": "duplicate_email"}, "pos").collect()}
    assert time.monotonic() - start < 30
    assert got == insert_one_by_one(rows, [], []) and sum(v is None for v in got.values()) == 1000


def test_many_long_chains_are_settled_by_component(spark, monkeypatch):
    rounds = []
    plain = rules._round
    monkeypatch.setattr(rules, "_round", lambda *a: rounds.append(1) or plain(*a))
    rows = _chains([40] * 12 + [70])
    df = spark.createDataFrame(rows, "pos long, id string, mail string").repartition(3)
    got = {r["pos"]: r["reject_reason"] for r in rules.mark_conflicts(df, {"id": "duplicate_in_batch", "mail": "duplicate_email"}, "pos", settle_rows=65).collect()}
    assert got == insert_one_by_one(rows, [], []) and len(rounds) <= 6


def test_components(spark):
    rnd = random.Random(2)
    pairs = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 260)] + [(5, 5), (300, 300)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_a_loser_does_not_block_others(spark):
    rows = [(1, "a", "x"), (2, "b", "x"), (3, "b", "y")]  # 2 loses by mail, so 3 may use its id
    df = spark.createDataFrame(rows, "pos long, id string, mail string")
    got = rules.mark_conflicts(df, {"id": "duplicate_in_batch", "mail": "duplicate_email"}, "pos")
    assert {r["pos"]: r["reject_reason"] for r in got.collect()} == {1: None, 2: "duplicate_email", 3: None}


@pytest.mark.parametrize("lookup_rows", [1_000_000, 0])
def test_first_wins_both_ways_with_a_hot_key(spark, lookup_rows):
    rnd = random.Random(7)
    # a third of the rows share one key, and some have none
    rows = [(i, 0 if rnd.random() < 0.33 else rnd.choice([None, rnd.randrange(300)])) for i in range(1500)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "pos long, key long").repartition(4)
    got = rules.mark_duplicates(df, ["key"], ["pos"], lookup_rows=lookup_rows)
    first = {}
    for pos, key in rows:
        first[key] = min(pos, first.get(key, pos))
    want = {pos: None if key is None or first[key] == pos else "duplicate_in_batch" for pos, key in rows}
    assert {r["pos"]: r["reject_reason"] for r in got.collect()} == want


def test_first_wins_with_composite_key_and_position(spark):
    rows = [(1, 1, 5, 9), (1, 1, 5, 3), (1, 2, 0, 0), (1, 1, 4, 8)]
    df = spark.createDataFrame(rows, "a int, b int, p int, q int")
    assert {tuple(r) for r in rules.first_wins(df, ["a", "b"], ["p", "q"]).collect()} == {(1, 1, 4, 8), (1, 2, 0, 0)}
    marked = {(r["p"], r["q"]) for r in rules.mark_duplicates(df, ["a", "b"], ["p", "q"]).filter("reject_reason IS NULL").collect()}
    assert marked == {(4, 8), (0, 0)}


def test_first_wins_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 2), (5, 1)], "id long, pos long")
    assert {tuple(r) for r in rules.first_wins(df, ["id"], ["pos"]).collect()} == {(None, 1), (None, 2), (5, 1)}


def test_rejected_rows_take_no_part_in_deduplication(spark):
    df = spark.createDataFrame([(1, 5, "no_customer"), (2, 5, None)], "pos long, id long, reject_reason string")
    got = rules.mark_duplicates(df, ["id"], ["pos"])
    assert {r["pos"]: r["reject_reason"] for r in got.collect()} == {1: "no_customer", 2: None}


def _order_tables(spark):
    return {
        "order": spark.createDataFrame([(1,), (1,), (2,)], "id long"),  # stored keys need not be distinct
        "customer": spark.createDataFrame([("c1",), ("c2",)], "id string"),
        "restaurant": spark.createDataFrame([(10,)], "id long"),
        "delivery": spark.createDataFrame([(100,)], "id long"),
    }


def test_orders_get_the_first_failing_reason(spark):
    tables = _order_tables(spark)
    rows = [
        (1, "nobody", 99, 99),  # everything wrong: the stored id comes first
        (3, "nobody", 99, 99),
        (4, "c1", 99, 99),
        (5, "c1", 10, 99),
        (6, "c2", 10, 100),
        (7, None, 10, 100),
    ]
    batch = spark.createDataFrame(rows, "id long, customer_id string, restaurant_id long, delivery_id long")
    order = [rules.must_be_new("order_exists", "id", tables["order"]), *rules.foreign_key_rules(TABLES["order"], tables)]
    got = rules.check_rules(batch, order)
    assert {r["id"]: r["reject_reason"] for r in got.collect()} == {
        1: "order_exists", 3: "no_customer", 4: "no_restaurant", 5: "no_delivery", 6: None, 7: "no_customer",
    }
    assert got.count() == len(rows)


@pytest.mark.parametrize("lookup_rows", [100_000, 0])
def test_hot_and_absent_keys_in_a_large_lookup(spark, lookup_rows):
    """A third of the rows share a broken key, a third a sound one, others have none."""
    rows = [(i, -1 if i % 3 == 0 else 7 if i % 3 == 1 else None if i % 2 else i) for i in range(3000)]
    batch = spark.createDataFrame(rows, "pos long, ref long")
    parents = spark.range(1500)
    got = rules.check_rules(batch, [rules.must_exist("orphan", "ref", parents, "id", null_fails=False)], lookup_rows)
    want = {p: None if k is None or 0 <= k < 1500 else "orphan" for p, k in rows}
    collected = got.collect()
    assert len(collected) == len(rows)
    assert {r["pos"]: r["reject_reason"] for r in collected} == want


def test_null_reference_passes_only_where_it_may(spark):
    parents = spark.createDataFrame([(1,)], "id long")
    df = spark.createDataFrame([(1,), (2,), (None,)], "ref long")
    for nullable, good in ((True, {1, None}), (False, {1})):
        valid, orphans = rules.split_references(df, "ref", parents, nullable=nullable)
        assert {r[0] for r in valid.collect()} == good
        assert {r[0] for r in orphans.collect()} == {1, 2, None} - good


def test_email_is_unique_ignoring_case(spark):
    stored = spark.createDataFrame([("Me@M.com",)], "email string")
    batch = spark.createDataFrame([("me@m.COM",), ("you@m.com",)], "email string")
    got = rules.check_rules(batch, [rules.must_be_new("email_exists", "email", stored, "email", ignore_case=True)])
    assert {r["email"]: r["reject_reason"] for r in got.collect()} == {"me@m.COM": "email_exists", "you@m.com": None}


def test_checking_does_not_shuffle_the_batch(spark):
    """With few violations the rows of the batch go through broadcast joins only."""
    tables = _order_tables(spark)
    batch = spark.range(1000).select(
        "id", F.lit("c1").alias("customer_id"), (F.col("id") % 11).alias("restaurant_id"), F.lit(100).cast("long").alias("delivery_id")
    )
    got = rules.check_rules(batch, rules.foreign_key_rules(TABLES["order"], tables))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert got.filter("reject_reason IS NULL").count() == 90


@pytest.mark.parametrize("lookup_rows", [100_000, 0])
def test_the_batch_is_scanned_once_however_many_rules_are_broken(spark, tmp_path, lookup_rows):
    names = ["a", "b", "c", "d"]
    batch = spark.range(200).select("id", *[F.when(F.col("id") % 7 > 0, F.col("id") % (i + 3)).alias(c) for i, c in enumerate(names)])
    path = str(tmp_path / "batch")
    batch.write.parquet(path)
    stored = spark.range(2).select("id")
    checks = [rules.must_exist(f"no_{c}", c, stored, null_fails=False) for c in names]
    got = rules.check_rules(spark.read.parquet(path), checks, lookup_rows)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 1 + len(names)  # the batch, and the broken keys of each rule
    want = [next((f"no_{c}" for c in names if r[c] is not None and r[c] > 1), None) for r in batch.orderBy("id").collect()]
    assert [r["reject_reason"] for r in got.orderBy("id").collect()] == want


def _above(plan, scan):
    """The operators above the scan that names ``scan``, from it upwards."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and scan in line)
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-*(0123456789)")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if own < depth:
            depth = own
            out.append(line.lstrip(" :+-*(0123456789)").split(" ")[0])
    return out


@pytest.mark.parametrize("must_exist", [True, False])
def test_a_stored_table_is_not_shuffled_for_a_small_batch(spark, tmp_path, must_exist):
    """Above the broadcast limit too, the stored keys stay in the tasks that scan them."""
    spark.range(200_000).select((F.col("id") * 2).alias("held_id")).write.parquet(str(tmp_path / "held"))
    stored = spark.read.parquet(str(tmp_path / "held"))
    batch = spark.createDataFrame([(i, k) for i, k in enumerate([10, 11, 10, None, 399_998, 400_000, 11])], "pos long, key long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rule = rules.must_exist("absent", "key", stored, "held_id") if must_exist else rules.must_be_new("known", "key", stored, "held_id")
        (asked,) = rules.ask_batch(batch, [rule])
        assert (asked.n, asked.low, asked.high) == (4, (10,), (400_000,))
        plan = rules.violating_keys(rule, asked)._jdf.queryExecution().executedPlan().toString()
        above = _above(plan, "held_id")
        assert "BroadcastHashJoin" in above and not any("Exchange" in step for step in above[: above.index("BroadcastHashJoin")])
        assert "GreaterThanOrEqual(held_id,10)" in plan and "LessThanOrEqual(held_id,400000)" in plan
        got = {r["pos"]: r["reject_reason"] for r in rules.check_rules(batch, [rule]).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    absent = {1, 3, 5, 6} if must_exist else {0, 2, 4}
    assert got == {pos: ("absent" if must_exist else "known") if pos in absent else None for pos in range(7)}


@pytest.mark.parametrize("names", [["a"], ["a", "b"]])
def test_a_large_batch_meets_only_stored_keys_that_pass_its_bitmap(spark, names):
    rnd = random.Random(5)
    have = [(rnd.randrange(4000), f"k{rnd.randrange(3)}") for _ in range(3000)]
    want = [(rnd.randrange(4000), f"k{rnd.randrange(3)}") for _ in range(500)]
    stored = spark.createDataFrame([*have, *have[:50], (None, None)], "a long, b string").select(*names)
    keys = spark.createDataFrame(want, "a long, b string").select(*names).distinct()
    asked = probe.ask(rules.stage(keys, "asked"))
    cut = (lambda r: tuple(r[: len(names)]))
    passed = probe._may_be_asked(stored, asked)
    assert passed.count() < stored.count() / 2
    got = sorted(tuple(r) for r in probe.stored_among(stored, asked, lookup_rows=0).collect())
    assert got == sorted(set(map(cut, have)) & set(map(cut, want)))
    assert got == sorted(tuple(r) for r in probe.stored_among(stored, asked).collect())


def test_existing_keys_are_left_out_of_a_batch(spark):
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (2, "w")], "id long, v string")
    assert sorted(r["v"] for r in rules.without_existing(batch, spark.range(2), ["id"]).collect()) == ["w", "y", "z"]
    assert rules.without_existing(batch.limit(0), spark.range(2), ["id"]).count() == 0
    assert rules.without_existing(batch, spark.range(0), ["id"]).count() == 4


def test_checks_by_shuffle_move_keys_and_places_only(spark):
    stored = spark.range(0, 40, 2).select("id", F.concat(F.lit("k"), "id").alias("key"))
    rows = [(i, f"k{i % 50}" if i % 7 else None, i % 45 if i % 5 else None, "ballast") for i in range(300)]
    batch = stage(spark.createDataFrame(rows, "_pos long, name string, number long, code string"), "batch")
    both = [rules.must_exist("no_number", "number", stored), rules.must_exist("no_name", "name", stored, "key")]
    checked = rules.check_rules(batch, both, lookup_rows=0)

    def expected(name, number):
        return "no_number" if number is None or number % 2 or number >= 40 else "no_name" if name is None or int(name[1:]) % 2 or int(name[1:]) >= 40 else None

    assert {r._pos: (r.reject_reason, r.code) for r in checked.collect()} == {p: (expected(n, k), c) for p, n, k, c in rows}
    plan = rules.outcome_counts(checked)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "code" in line and "Relation" not in line]
