"""Invariants of generated rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from orderflow.catalog import generator_queries
from orderflow.errors import IngestError
from orderflow.functions import draws
from orderflow.operators import generate

SEED = 3


@pytest.fixture(scope="module")
def five(spark):
    return generate.row_numbers(spark, 5)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_users_by_role(spark):
    got = generate.users_by_role(generate.row_numbers(spark, 10), SEED, 1, 3, 4, 2).groupBy("user_role").count()
    assert {r["user_role"]: r["count"] for r in got.collect()} == {
        "ROLE_CUSTOMER": 1, "ROLE_ADMIN": 3, "ROLE_EMPLOYEE": 4, "ROLE_DRIVER": 2,
    }


def test_formats(spark):
    i = F.col("i")
    rows = generate.row_numbers(spark, 2000).select(
        draws.email(SEED, i).alias("email"),
        draws.uuid4_hex(SEED, "u", i).alias("uuid"),
        draws.phone_bracketed(SEED, i).alias("a"),
        draws.phone_dashed(SEED, i).alias("b"),
        draws.distinct_chars(SEED, "w", i, draws.LOWER, 20).alias("word"),
        draws.distinct_chars(SEED, "p", i, draws.PASSWORD_CHARS, 12).alias("secret"),
        draws.confirmation_code(SEED, i).alias("code"),
        draws.password_digest(SEED, i).alias("password"),
    )
    patterns = {
        "email": r"^[a-z0-9]{4,12}@[a-z]+\.(com|net|org|gov)$",
        "uuid": r"^[0-9a-f]{12}4[0-9a-f]{3}[89ab][0-9a-f]{15}$",
        "a": r"^\(\d{3}\) \d{3}-\d{4}$",
        "b": r"^[1-9]{3}-[1-9]{3}-[1-9]{4}$",
        "word": "^[a-z]{20}$",
        "code": "^[0-9a-f]{10}$",
        "password": r"^[0-9a-f]{16}\$[0-9a-f]{64}$",
    }
    for column, pattern in patterns.items():
        assert rows.filter(~F.col(column).rlike(pattern)).isEmpty(), column
    for column, size in (("word", 20), ("secret", 12)):
        letters = rows.select(F.size(F.array_distinct(F.split(column, ""))).alias("n"), F.length(column).alias("len"))
        assert letters.filter((F.col("n") != size) | (F.col("len") != size)).isEmpty()
    assert rows.select("uuid").distinct().count() == 2000
    assert rows.select(F.length(F.split("email", "@")[0]).alias("n")).distinct().count() == 9


def test_draws_do_not_depend_on_the_partitioning(spark):
    rows = generate.row_numbers(spark, 300)
    assert same(generate.users(rows.repartition(1), SEED, "R"), generate.users(rows.repartition(8), SEED, "R"))


def test_customers(five):
    made = generate.customers_with_users(five, SEED)
    assert {k: v.count() for k, v in made.items()} == {"user": 5, "customer": 5}
    assert made["customer"].join(made["user"], "id", "left_anti").isEmpty()


def test_restaurants(five):
    made = generate.restaurants_with_parents(five, SEED, 1, 1)
    assert {k: v.count() for k, v in made.items()} == {"address": 5, "user": 5, "owner": 5, "restaurant": 5}
    assert sorted(r["id"] for r in made["restaurant"].collect()) == [2, 3, 4, 5, 6]
    owners = made["owner"].withColumnRenamed("id", "owner_id")
    places = made["address"].withColumnRenamed("id", "address_id")
    assert made["restaurant"].join(owners, "owner_id", "left_anti").isEmpty()
    assert made["restaurant"].join(places, "address_id", "left_anti").isEmpty()
    assert made["owner"].join(made["user"], "id", "left_anti").isEmpty()


def test_deliveries(five):
    made = generate.deliveries_with_parents(five, SEED, 1, 1, 5)
    assert {k: v.count() for k, v in made.items()} == {"user": 5, "address": 10, "driver": 5, "delivery": 5}
    assert made["address"].select("id").distinct().count() == 10
    assert made["delivery"].join(made["driver"].withColumnRenamed("id", "driver_id"), "driver_id", "left_anti").isEmpty()
    for child in ("delivery", "driver"):
        places = made["address"].withColumnRenamed("id", "address_id")
        assert made[child].join(places, "address_id", "left_anti").isEmpty()


def test_dependency_set_has_no_clashing_keys(spark):
    rows = {n: generate.row_numbers(spark, n) for n in (3, 4, 5)}
    made = generate.dependency_set(rows[3], rows[4], rows[5], SEED, 4, 5, {"address": 1, "restaurant": 1, "delivery": 1})
    sizes = {k: v.count() for k, v in made.items()}
    assert sizes == {"user": 12, "customer": 3, "address": 14, "owner": 4, "restaurant": 4, "driver": 5, "delivery": 5}
    assert all(v.select("id").distinct().count() == sizes[k] for k, v in made.items())


def test_orders_need_every_parent(spark, five):
    ids = five.select(F.col("i").alias("id"))
    people = five.select(F.md5(F.col("i").cast("string")).alias("id"))
    got = generate.orders(generate.row_numbers(spark, 50), SEED, people, ids, ids)
    assert got.count() == 50 and got.filter("id IS NOT NULL OR customer_id IS NULL").isEmpty()
    with pytest.raises(IngestError) as e:
        generate.orders(five, SEED, people, ids.limit(0), ids)
    assert e.value.detail == "restaurant"


def test_drivers_from_seed(spark, five):
    users = five.select("i", F.md5(F.col("i").cast("string")).alias("id"))
    names = spark.createDataFrame([("Ann",), ("Bob",)], "name string")
    places = five.select(F.col("i").alias("id"))
    got = generate.drivers_from_seed(users, SEED, places, names, names, dt.date(2024, 3, 9)).collect()
    assert len(got) == 5 and {r["dob"] for r in got} == {"09/03/2024"}
    assert all(r["email"] == f"{r['first_name']}.{r['last_name']}@mail.com" for r in got)
    assert all(0 <= r["rating"] < 5 and 10000 <= int(r["license_num"]) <= 99999 for r in got)


def test_keys_of_a_set_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(generator_queries, "BUCKET_ROWS", 100)
    got = generator_queries.gen_dependency_set(spark, "/root/testdata/sf0.001")
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(id#\d+L?, (\d+)\), REPARTITION_BY_NUM", got._jdf.queryExecution().executedPlan().toString())]
    counts = {r.table_name: r for r in got.collect()}
    assert all(r.n == r.n_ids and r.n_dangling == 0 for r in counts.values())
    assert dealt and max(r.n for r in counts.values()) / max(dealt) <= 100


def test_rows_are_dealt_by_their_number(spark, tmp_path):
    """However few bytes their numbers are in: one file, of one row group, is one task."""
    generate.row_numbers(spark, 60_000).coalesce(1).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    customers = rows.select(F.col("i").alias("c_custkey"))
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    got = generator_queries._customer_rows(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 1 and got.rdd.getNumPartitions() == 3
    assert same(got, rows)
