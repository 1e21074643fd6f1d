"""The registry and the entity tables bound to the test tables.

Entities are bound to the test tables whole.  Faults come from the data: a customer with a negative
balance is not on record, an order with status P is stored already, and so on.  Each binding has
its SQL twin in ``CTES`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions import draws
from orderflow.operators.keys import BUCKET_ROWS, MIN_BUCKETS
from orderflow.session import fresh_path
from orderflow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SEED = 42
AFTER_ALL = 1 << 40  # added to a position, it comes after all others


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def scratch_file(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; the extension of ``name`` tells the format."""
    return f"{fresh_path(spark, 'files')}/{name}"


def write_lines(df: DataFrame, path: str, header: str | None = None) -> None:
    """Write the one text column of ``df`` as it is, a header line first in every part file."""
    if header is None:
        df.write.text(path)
        return
    line = df.columns[0]
    raw = df.select(F.col(line).alias(header))
    # A separator and a quote that occur nowhere leave the text untouched.
    raw.write.option("header", True).option("sep", "\u0001").option("quote", "").option("emptyValue", "").csv(path)


# ------------------------------------------------------------------ identifiers


def person_id(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(F.concat(F.lit("person:"), c.cast("string")))


def owner_id(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(F.concat(F.lit("owner:"), c.cast("string")))


# ------------------------------------------------------------------ entity tables


def persons(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer row as a user with a number, some e-mails being shared."""
    name = F.lower("c_mktsegment")
    whole = F.floor("c_acctbal").cast("long")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("n"),
        person_id("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "ROLE_ADMIN")
        .when(F.col("c_mktsegment") == "MACHINERY", "ROLE_EMPLOYEE")
        .when(F.col("c_mktsegment") == "FURNITURE", "ROLE_DRIVER")
        .otherwise("ROLE_CUSTOMER")
        .alias("user_role"),
        F.md5("c_name").alias("password"),
        F.concat(name, F.lit("."), whole.cast("string"), F.lit("@mail.com")).alias("email"),
        (F.col("c_acctbal") >= 0).alias("enabled"),
        (F.col("c_acctbal") >= 1000).alias("confirmed"),
        (F.col("c_nationkey") < 20).alias("account_non_expired"),
        (F.col("c_nationkey") < 10).alias("account_non_locked"),
        (F.col("c_acctbal") < 5000).alias("credentials_non_expired"),
    )


def stored_users(spark: SparkSession, sf: str) -> DataFrame:
    """The admins, and some employees under other ids; all e-mails are stored in capitals."""
    other = F.when(F.col("account_non_locked"), F.md5(F.concat(F.lit("stored:"), F.col("n").cast("string"))))
    held = F.when(F.col("user_role") == "ROLE_ADMIN", F.col("id")).when(F.col("user_role") == "ROLE_EMPLOYEE", other)
    return persons(spark, sf).withColumn("id", held).filter(F.col("id").isNotNull()).withColumn("email", F.upper("email")).drop("n")


def incoming_users(spark: SparkSession, sf: str) -> DataFrame:
    """All persons, then the drivers once more under the same ids with other e-mails."""
    people = persons(spark, sf)
    again = people.filter(F.col("user_role") == "ROLE_DRIVER").withColumn("n", F.col("n") + AFTER_ALL)
    return people.unionByName(again.withColumn("email", F.concat(F.lit("again."), F.col("email"))))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0).select(person_id("c_custkey").alias("id"))


def addresses(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.col("n_name").alias("line1"),
        F.lit("").alias("line2"),
        F.col("r_name").alias("city"),
        F.substring("r_name", 1, 2).alias("state"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("zip"),
    )


def owners(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(owner_id("s_suppkey").alias("id"))


def restaurants(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "supplier")
        .filter(F.col("s_acctbal") >= 0)
        .select(
            F.col("s_suppkey").alias("id"),
            F.col("s_nationkey").cast("long").alias("address_id"),
            owner_id("s_suppkey").alias("owner_id"),
            F.col("s_name").alias("name"),
        )
    )


def drivers(spark: SparkSession, sf: str) -> DataFrame:
    """The users seen in events drive."""
    seen = table(spark, sf, "events").select("user_id").distinct()
    return seen.select(person_id("user_id").alias("id"), (F.col("user_id") % 25).alias("address_id"))


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .filter(F.col("o_orderpriority") != "5-LOW")
        .select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).alias("address_id"), person_id("o_custkey").alias("driver_id"))
    )


def incoming_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A batch: every order that has lines, delivered from the smallest supplier of its lines."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("restaurant_id"))
    orders = table(spark, sf, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        F.col("o_orderkey").alias("id"),
        person_id("o_custkey").alias("customer_id"),
        "restaurant_id",
        F.col("o_orderkey").alias("delivery_id"),
        F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 10).alias("confirmation_code"),
    )


def stored_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("id"))


def order_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "order": stored_orders(spark, sf),
        "customer": customers(spark, sf),
        "restaurant": restaurants(spark, sf),
        "delivery": deliveries(spark, sf),
    }


CTES = {
    "persons": """persons AS (SELECT c_custkey AS n, md5('person:' || c_custkey) AS id,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'ROLE_ADMIN' WHEN 'MACHINERY' THEN 'ROLE_EMPLOYEE'
             WHEN 'FURNITURE' THEN 'ROLE_DRIVER' ELSE 'ROLE_CUSTOMER' END AS user_role,
        md5(c_name) AS password,
        lower(c_mktsegment) || '.' || floor(c_acctbal)::BIGINT || '@mail.com' AS email,
        c_acctbal >= 0 AS enabled, c_acctbal >= 1000 AS confirmed, c_nationkey < 20 AS account_non_expired,
        c_nationkey < 10 AS account_non_locked, c_acctbal < 5000 AS credentials_non_expired FROM customer)""",
    "stored_users": """stored_users AS (SELECT * EXCLUDE (n) REPLACE (upper(email) AS email,
        CASE user_role WHEN 'ROLE_ADMIN' THEN id ELSE md5('stored:' || n) END AS id) FROM persons
        WHERE user_role = 'ROLE_ADMIN' OR (user_role = 'ROLE_EMPLOYEE' AND account_non_locked))""",
    "customers": "customers AS (SELECT md5('person:' || c_custkey) AS id FROM customer WHERE c_acctbal >= 0)",
    "addresses": """addresses AS (SELECT n_nationkey::BIGINT AS id, n_name AS line1, '' AS line2, r_name AS city,
        substr(r_name, 1, 2) AS state, lpad(n_nationkey::VARCHAR, 5, '0') AS zip
        FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "owners": "owners AS (SELECT md5('owner:' || s_suppkey) AS id FROM supplier)",
    "restaurants": """restaurants AS (SELECT s_suppkey AS id, s_nationkey::BIGINT AS address_id,
        md5('owner:' || s_suppkey) AS owner_id, s_name AS name FROM supplier WHERE s_acctbal >= 0)""",
    "drivers": """drivers AS (SELECT md5('person:' || user_id) AS id, user_id % 25 AS address_id
        FROM (SELECT DISTINCT user_id FROM events))""",
    "deliveries": """deliveries AS (SELECT o_orderkey AS id, o_custkey % 25 AS address_id,
        md5('person:' || o_custkey) AS driver_id FROM orders WHERE o_orderpriority <> '5-LOW')""",
    "incoming_orders": """incoming_orders AS (SELECT o_orderkey AS id, md5('person:' || o_custkey) AS customer_id,
        restaurant_id, o_orderkey AS delivery_id, substr(md5(o_orderkey::VARCHAR), 1, 10) AS confirmation_code
        FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS restaurant_id FROM lineitem GROUP BY 1)
        ON o_orderkey = l_orderkey)""",
    "stored_orders": "stored_orders AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P')",
}
ORDER_CTES = ("incoming_orders", "stored_orders", "customers", "restaurants", "deliveries")


def with_(*names: str) -> str:
    return "WITH " + ", ".join(CTES[n] for n in names) + " "


# ------------------------------------------------------------------ SQL twins of the draws


def sql_pick(purpose: str, row_id: str, seed: int = SEED) -> str:
    return f"('0x' || substr(md5('{seed}:{purpose}:' || {row_id}), 1, 15))::BIGINT"


def sql_digest(purpose: str, row_id: str, blocks: int, seed: int = SEED) -> str:
    return "(" + " || ".join(f"sha256('{seed}:{purpose}/{b}:' || {row_id})" for b in range(blocks)) + ")"


def sql_draw(digest: str, j: int, n: int) -> str:
    per = draws.draws_per_number(n)
    block, which = divmod(j // per, 4)
    return f"(('0x' || substr({digest}, {64 * block + 15 * which + 1}, 15))::BIGINT // {n ** (j % per)} % {n})"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_chars(purpose: str, row_id: str, alphabet: str, count: int) -> list[str]:
    n = len(alphabet)
    d = sql_digest(purpose, row_id, -(-count // (4 * draws.draws_per_number(n))))
    return [f"substr({sql_text(alphabet)}, ({sql_draw(d, j, n)} + 1)::INT, 1)" for j in range(count)]


def sql_distinct(purpose: str, row_id: str, alphabet: str, size: int) -> str:
    n = len(alphabet)
    if draws.sparse(alphabet, size):
        drawn = "[" + ", ".join(_sql_chars(purpose, row_id, alphabet, draws.sparse_draws(size)) + [sql_text(ch) for ch in alphabet]) + "]"
        return f"(SELECT array_to_string(list_slice(list_filter(l, lambda x, i: list_position(l, x) = i), 1, {size}), '') FROM (SELECT {drawn} AS l))"
    d = sql_digest(purpose, row_id, -(-n // 16))
    tagged = f"list_transform(range(0, {n}), lambda k: substr({d}, (4 * k + 1)::INT, 4) || substr({sql_text(alphabet)}, (k + 1)::INT, 1))"
    return f"regexp_replace(array_to_string(list_slice(list_sort({tagged}), 1, {size}), ''), '....(.)', '\\1', 'g')"


def sql_repeated(purpose: str, row_id: str, alphabet: str, size: int) -> str:
    return " || ".join(_sql_chars(purpose, row_id, alphabet, size))


def sql_uuid4(purpose: str, row_id: str, seed: int = SEED) -> str:
    h = f"md5('{seed}:{purpose}:' || {row_id})"
    return (
        f"(substr({h}, 1, 12) || '4' || substr({h}, 14, 3) || "
        f"substr('89ab', (('0x' || substr({h}, 17, 1))::BIGINT % 4 + 1)::INT, 1) || substr({h}, 18, 15))"
    )


def sql_by_hash(rel: str, key: str, seed: int = SEED) -> str:
    """Rows of ``rel`` with the 0-based index of ``dense_by_hash`` in ``bucket_count`` buckets."""
    buckets = f"(SELECT greatest({MIN_BUCKETS}, ceil(count(*) / {BUCKET_ROWS})::BIGINT) FROM {rel})"
    return f"(SELECT *, row_number() OVER (ORDER BY {sql_pick('bucket', key, seed)} % {buckets}, {key}) - 1 AS idx FROM {rel})"
