"""Dense numbers, assigned keys and picks, independent of the partitioning."""

import pytest
from pyspark.sql import functions as F

from orderflow.functions import draws
from orderflow.operators import keys


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(500).select(F.md5(F.col("id").cast("string")).alias("name"))


@pytest.mark.parametrize("parts", [1, 8])
def test_dense_index_is_dense_and_ordered(spark, names, parts):
    got = keys.dense_index(names.repartition(parts), ["name"], "idx", 5).collect()
    ordered = sorted(r["name"] for r in names.collect())
    assert {r["name"]: r["idx"] for r in got} == {n: i + 5 for i, n in enumerate(ordered)}


def test_dense_index_uses_no_single_task_window_on_rows(spark, names):
    df = keys.dense_index(names, ["name"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the only window runs over the per-partition counts
    assert plan.count("Window [") == 1 and "_n#" in plan.split("Window [")[1].split("\n")[0]


@pytest.mark.parametrize("parts", [1, 8])
def test_dense_by_hash_is_a_permutation_that_never_changes(spark, names, parts):
    got = {r["name"]: r["idx"] for r in keys.dense_by_hash(names.repartition(parts), "name", buckets=16).collect()}
    assert sorted(got.values()) == list(range(500))
    again = {r["name"]: r["idx"] for r in keys.dense_by_hash(names, "name", buckets=16).collect()}
    assert got == again


def test_assigned_keys_follow_the_largest(spark):
    batch = spark.createDataFrame([("b",), ("a",)], "name string")
    full = spark.createDataFrame([(7,), (3,)], "id long")
    assert {r["name"]: r["id"] for r in keys.assign_keys(batch, full, ["name"]).collect()} == {"a": 8, "b": 9}
    # an empty table counts as having the key 1
    assert {r["name"]: r["id"] for r in keys.assign_keys(batch, full.limit(0), ["name"]).collect()} == {"a": 2, "b": 3}


def test_max_id_of_an_empty_table_is_one(spark):
    assert keys.max_id(spark.range(0)).first()["max_id"] == 1


def test_picks_are_valid_spread_and_stable(spark):
    parents = spark.range(20).select((F.col("id") * 3).alias("id"))
    child = spark.range(4000)
    got = keys.pick_parent(child, parents, "id", "parent", 1, "id")
    shares = {r["parent"]: r["count"] for r in got.groupBy("parent").count().collect()}
    assert set(shares) == {i * 3 for i in range(20)}
    assert all(120 < n < 290 for n in shares.values())
    again = keys.pick_parent(child.repartition(7), parents.repartition(3), "id", "parent", 1, "id")
    assert got.exceptAll(again).isEmpty()
    with pytest.raises(ValueError):
        keys.pick_parent(child, parents.limit(0), "id", "parent", 1, "id")


def test_zip_pairs_by_position_and_drops_the_rest(spark):
    left = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    right = spark.createDataFrame([(30,), (10,)], "y int")
    got = keys.zip_parents(left, ["x"], right, ["y"])
    assert {(r["x"], r["y"]) for r in got.collect()} == {("a", 10), ("b", 30)}


def test_picks_reach_beyond_32_bits(spark):
    n = 1 << 50
    picked = spark.range(200).select(draws.pick_below(1, "far", F.col("id"), n).alias("p"), draws.uniform(1, "far", F.col("id")).alias("u"))
    low, high, top = picked.agg(F.min("p"), F.max("p"), F.max("u")).first()
    assert 0 <= low and n // 2 < high < n and top < 1


def test_buckets_grow_with_the_rows():
    assert keys.bucket_count(0) == keys.bucket_count(10**9) == 1024
    assert keys.bucket_count(10**12) == 10**6
