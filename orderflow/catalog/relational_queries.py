"""Joins, aggregates, keys, limits, unions and deletes over whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.catalog.registry import (
    ORDER_CTES,
    SEED,
    addresses,
    customers,
    deliveries,
    drivers,
    incoming_orders,
    order_tables,
    owners,
    person_id,
    persons,
    query,
    restaurants,
    sql_by_hash,
    sql_pick,
    stored_orders,
    stored_users,
    table,
    with_,
)
from orderflow.operators import keys, maintain, relational, rules
from orderflow.schema import TABLES
from orderflow.session import stage
from orderflow.sources import tables as sources

# ------------------------------------------------------------------ scans


@query("scan_table", "SELECT * FROM part")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part")


@query("scan_keys", "SELECT o_orderkey AS id FROM orders")
def scan_keys(spark: SparkSession, sf: str) -> DataFrame:
    return sources.keys(table(spark, sf, "orders"), "o_orderkey")


@query("scan_keys_hex", "SELECT md5('person:' || c_custkey) AS id FROM customer")
def scan_keys_hex(spark: SparkSession, sf: str) -> DataFrame:
    binary = table(spark, sf, "customer").select(F.unhex(person_id("c_custkey")).alias("id"))
    return sources.hex_keys(binary)


# ------------------------------------------------------------------ joins


@query(
    "users_without_driver",
    with_("persons", "drivers") + "SELECT p.id, user_role FROM persons p LEFT JOIN drivers d ON p.id = d.id WHERE d.id IS NULL",
)
def users_without_driver(spark: SparkSession, sf: str) -> DataFrame:
    return relational.without_match(persons(spark, sf).select("id", "user_role"), drivers(spark, sf))


_CHAIN = (
    with_("incoming_orders", "restaurants", "addresses", "deliveries", "drivers")
    + """, chain AS (SELECT o.id AS order_id, r.id AS restaurant_id, a1.id AS restaurant_address_id, d.id AS delivery_id,
    v.id AS driver_id, a2.id AS driver_address_id FROM incoming_orders o JOIN restaurants r ON o.restaurant_id = r.id
    JOIN addresses a1 ON a1.id = r.address_id JOIN deliveries d ON d.id = o.delivery_id
    JOIN drivers v ON v.id = d.driver_id JOIN addresses a2 ON a2.id = v.address_id) """
)


def _chain(spark: SparkSession, sf: str) -> DataFrame:
    return relational.delivery_chain(
        incoming_orders(spark, sf), restaurants(spark, sf), addresses(spark, sf), deliveries(spark, sf), drivers(spark, sf)
    )


@query("order_delivery_chain", _CHAIN + "SELECT * FROM chain")
def order_delivery_chain(spark: SparkSession, sf: str) -> DataFrame:
    return _chain(spark, sf)


_CHECKED = (
    with_(*ORDER_CTES)
    + """, checked AS (SELECT o.*, CASE WHEN s.id IS NOT NULL THEN 'order_exists' WHEN c.id IS NULL THEN 'no_customer'
    WHEN r.id IS NULL THEN 'no_restaurant' WHEN d.id IS NULL THEN 'no_delivery' END AS reject_reason
    FROM incoming_orders o LEFT JOIN stored_orders s ON s.id = o.id LEFT JOIN customers c ON c.id = o.customer_id
    LEFT JOIN restaurants r ON r.id = o.restaurant_id LEFT JOIN deliveries d ON d.id = o.delivery_id) """
)


def _checked_orders(spark: SparkSession, sf: str) -> DataFrame:
    batch = stage(incoming_orders(spark, sf), "batch")  # made by a join, read once per rule
    tables = order_tables(spark, sf)
    order = [rules.must_be_new("order_exists", "id", tables["order"]), *rules.foreign_key_rules(TABLES["order"], tables)]
    return rules.check_rules(batch, order)


@query("validate_orders", _CHECKED + "SELECT * EXCLUDE (reject_reason) FROM checked WHERE reject_reason IS NULL")
def validate_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_orders(spark, sf).filter(F.col("reject_reason").isNull()).drop("reject_reason")


@query("rejected_orders", _CHECKED + "SELECT id, reject_reason FROM checked WHERE reject_reason IS NOT NULL")
def rejected_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_orders(spark, sf).filter(F.col("reject_reason").isNotNull()).select("id", "reject_reason")


@query(
    "exclude_existing_keys",
    with_("incoming_orders", "stored_orders") + "SELECT * FROM incoming_orders WHERE id NOT IN (SELECT id FROM stored_orders)",
)
def exclude_existing_keys(spark: SparkSession, sf: str) -> DataFrame:
    return rules.without_existing(incoming_orders(spark, sf), stored_orders(spark, sf), ["id"])


def _line_references(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their supplier as a reference that may be NULL; a hot key included."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("menuitem_id"),
        # a third of all lines refer to one and the same supplier, which nobody knows
        F.when(F.col("l_returnflag") == "R", F.lit(-1)).when(F.col("l_quantity") > 2, F.col("l_suppkey")).alias("restaurant_id"),
    )


_LINES = (
    with_("restaurants")
    + """, lines AS (SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS menuitem_id,
    CASE WHEN l_returnflag = 'R' THEN -1 WHEN l_quantity > 2 THEN l_suppkey END AS restaurant_id FROM lineitem) """
)


@query("fk_valid", _LINES + "SELECT * FROM lines WHERE restaurant_id IS NULL OR restaurant_id IN (SELECT id FROM restaurants)")
def fk_valid(spark: SparkSession, sf: str) -> DataFrame:
    return rules.split_references(_line_references(spark, sf), "restaurant_id", restaurants(spark, sf), nullable=True)[0]


@query("fk_orphans", _LINES + "SELECT * FROM lines WHERE restaurant_id NOT IN (SELECT id FROM restaurants)")
def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return rules.split_references(_line_references(spark, sf), "restaurant_id", restaurants(spark, sf), nullable=True)[1]


@query(
    "unique_email",
    with_("persons", "stored_users")
    + """, fresh AS (SELECT * FROM persons WHERE lower(email) NOT IN (SELECT lower(email) FROM stored_users)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lower(email) ORDER BY n) AS rn FROM fresh) SELECT n, id, email FROM ranked WHERE rn = 1""",
)
def unique_email(spark: SparkSession, sf: str) -> DataFrame:
    batch = persons(spark, sf).select("n", "id", "email", F.lower("email").alias("mail"))
    rule = rules.must_be_new("email_exists", "email", stored_users(spark, sf), "email", ignore_case=True)
    marked = rules.mark_duplicates(rules.check_rules(batch, [rule]), ["mail"], ["n"], "duplicate_email")
    return marked.filter(F.col("reject_reason").isNull()).select("n", "id", "email")


@query(
    "pick_parent",
    with_("customers")
    + f"""SELECT o_orderkey, id AS customer_id FROM orders JOIN {sql_by_hash("customers", "id")}
    ON idx = {sql_pick("pick-customer_id", "o_orderkey")} % (SELECT count(*) FROM customers)""",
)
def pick_parent(spark: SparkSession, sf: str) -> DataFrame:
    child = table(spark, sf, "orders").select("o_orderkey")
    return keys.pick_parent(child, customers(spark, sf), "id", "customer_id", SEED, "o_orderkey")


@query(
    "zip_parents",
    """SELECT event_id, o_orderkey FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS i FROM events)
    JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS i FROM orders) USING (i)""",
)
def zip_parents(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return keys.zip_parents(events, ["event_id"], orders, ["o_totalprice", "o_orderkey"]).select("event_id", "o_orderkey")


# ------------------------------------------------------------------ aggregates


@query(
    "chain_counts",
    _CHAIN + "SELECT count(delivery_id) AS deliveries, count(order_id) AS orders, count(driver_id) AS drivers, "
    "count(restaurant_id) AS restaurants, count(restaurant_address_id) + count(driver_address_id) AS addresses FROM chain",
)
def chain_counts(spark: SparkSession, sf: str) -> DataFrame:
    return relational.chain_counts(_chain(spark, sf))


@query(
    "chain_counts_distinct",
    _CHAIN + "SELECT count(DISTINCT delivery_id) AS deliveries, count(DISTINCT order_id) AS orders, count(DISTINCT driver_id) AS drivers, "
    "count(DISTINCT restaurant_id) AS restaurants, count(DISTINCT restaurant_address_id) + count(DISTINCT driver_address_id) AS addresses FROM chain",
)
def chain_counts_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return relational.chain_counts_distinct(_chain(spark, sf))


@query(
    "max_id_default",
    """SELECT 'orders' AS table_name, coalesce(max(o_orderkey), 1)::BIGINT AS max_id FROM orders
    UNION ALL SELECT 'none', coalesce(max(o_orderkey), 1)::BIGINT FROM orders WHERE o_totalprice < 0""",
)
def max_id_default(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    parts = {"orders": orders, "none": orders.filter(F.col("o_totalprice") < 0)}
    tops = [keys.max_id(df, "o_orderkey").select(F.lit(name).alias("table_name"), "max_id") for name, df in parts.items()]
    return relational.concat_batches(*tops)


@query("outcome_counts", _CHECKED + "SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n FROM checked GROUP BY 1")
def outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rules.outcome_counts(_checked_orders(spark, sf))


@query("count_by_role", with_("persons") + "SELECT user_role, count(*) AS n FROM persons GROUP BY 1")
def count_by_role(spark: SparkSession, sf: str) -> DataFrame:
    return relational.count_by(persons(spark, sf), "user_role")


@query(
    "dependency_gates",
    with_("customers", "restaurants", "deliveries")
    + """SELECT 'customer' AS table_name, count(*) AS n, count(*) = 0 AS is_empty FROM customers
    UNION ALL SELECT 'restaurant', count(*), count(*) = 0 FROM restaurants UNION ALL SELECT 'delivery', count(*), count(*) = 0 FROM deliveries
    UNION ALL SELECT 'admin', count(*), count(*) = 0 FROM orders WHERE o_totalprice < 0""",
)
def dependency_gates(spark: SparkSession, sf: str) -> DataFrame:
    return relational.dependency_gates(
        {
            "customer": customers(spark, sf),
            "restaurant": restaurants(spark, sf),
            "delivery": deliveries(spark, sf),
            "admin": table(spark, sf, "orders").filter(F.col("o_totalprice") < 0),
        }
    )


# ------------------------------------------------------------------ keys and duplicates


@query(
    "assign_keys",
    with_("incoming_orders", "stored_orders")
    + """SELECT (SELECT coalesce(max(id), 1) FROM stored_orders) + row_number() OVER (ORDER BY confirmation_code, o.id) AS id,
    o.id AS batch_row, customer_id, confirmation_code FROM incoming_orders o""",
)
def assign_keys(spark: SparkSession, sf: str) -> DataFrame:
    batch = incoming_orders(spark, sf).select(F.col("id").alias("batch_row"), "customer_id", "confirmation_code")
    return keys.assign_keys(batch, stored_orders(spark, sf), ["confirmation_code", "batch_row"])


@query(
    "dedup_first_wins",
    """SELECT user_id AS id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def dedup_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(F.col("user_id").alias("id"), "event_id", "event_type")
    return rules.first_wins(events, ["id"], ["event_id"])


_LINE_ORDER = ["l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity"]


@query(
    "dedup_composite",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_quantity FROM (SELECT *,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_composite(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", *_LINE_ORDER)
    return rules.first_wins(lines, ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query(
    "dedup_bridge",
    f"""SELECT l_partkey AS menuitem_id, l_orderkey AS order_id, l_quantity::BIGINT AS quantity FROM (SELECT *,
    row_number() OVER (PARTITION BY l_partkey, l_orderkey ORDER BY {", ".join(_LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_bridge(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", *_LINE_ORDER)
    best = rules.first_wins(lines, ["l_partkey", "l_orderkey"], _LINE_ORDER)
    return best.select(F.col("l_partkey").alias("menuitem_id"), F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("long").alias("quantity"))


# ------------------------------------------------------------------ sort, limit, union


@query("sorted_orders", with_("incoming_orders") + "SELECT * FROM incoming_orders ORDER BY id")
def sorted_orders(spark: SparkSession, sf: str) -> DataFrame:
    return incoming_orders(spark, sf).orderBy("id")


@query(
    "preview_limit",
    with_("incoming_orders")
    + "SELECT *, greatest((SELECT count(*) FROM incoming_orders) - 10, 0)::BIGINT AS remaining FROM incoming_orders ORDER BY id LIMIT 10",
)
def preview_limit(spark: SparkSession, sf: str) -> DataFrame:
    return relational.preview(incoming_orders(spark, sf), ["id"])


@query(
    "union_roles",
    with_("persons", "drivers", "owners")
    + """SELECT id, 'ROLE_CUSTOMER' AS user_role FROM persons UNION ALL SELECT id, 'ROLE_EMPLOYEE' FROM owners
    UNION ALL SELECT id, 'ROLE_DRIVER' FROM drivers""",
)
def union_roles(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        df.select("id", F.lit(role).alias("user_role"))
        for df, role in ((persons(spark, sf), "ROLE_CUSTOMER"), (owners(spark, sf), "ROLE_EMPLOYEE"), (drivers(spark, sf), "ROLE_DRIVER"))
    ]
    return relational.concat_batches(*parts)


# ------------------------------------------------------------------ deletes


@query(
    "delete_plan",
    _CHAIN + "SELECT count(delivery_id) AS deliveries, count(order_id) AS orders, count(driver_id) AS drivers, "
    "count(restaurant_id) AS restaurants, count(restaurant_address_id) + count(driver_address_id) AS addresses FROM chain",
)
def delete_plan(spark: SparkSession, sf: str) -> DataFrame:
    return maintain.delete_plan(
        {
            "order": incoming_orders(spark, sf),
            "restaurant": restaurants(spark, sf),
            "address": addresses(spark, sf),
            "delivery": deliveries(spark, sf),
            "driver": drivers(spark, sf),
        }
    )


def _menu(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Customers as addresses, their orders as restaurants, and order lines as menu items, of which
    returned seventh lines refer to their restaurant and hold it back."""
    kept = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    return {
        "address": table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("line1")),
        "restaurant": table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("address_id")),
        "menuitem": table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"), F.when(kept, F.col("l_orderkey")).alias("restaurant_id")),
    }


_MENU = """WITH doomed AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0),
    stuck AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_custkey IN (SELECT id FROM doomed)
      AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7 AND l_returnflag = 'R')),
    gone AS (SELECT id FROM doomed WHERE id NOT IN (SELECT id FROM stuck)) """


def _doomed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("id"))


@query(
    "cascade_delete",
    _MENU
    + """SELECT 'address' AS table_name, c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT id FROM gone)
    UNION ALL SELECT 'restaurant', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT id FROM gone)""",
)
def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    left = maintain.cascade_delete(_doomed(spark, sf), "address", _menu(spark, sf))
    return relational.concat_batches(*[left[t].select(F.lit(t).alias("table_name"), "id") for t in ("address", "restaurant")])


@query("blocked_delete", _MENU + "SELECT id FROM stuck")
def blocked_delete(spark: SparkSession, sf: str) -> DataFrame:
    return maintain.blocked_deletes(_doomed(spark, sf), "address", _menu(spark, sf))

