"""Generators driven by the keys of the test tables: one generated row per table row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.catalog.registry import (
    SEED,
    customers,
    deliveries,
    drivers,
    owners,
    persons,
    query,
    restaurants,
    sql_by_hash,
    sql_digest,
    sql_distinct,
    sql_draw,
    sql_pick,
    sql_repeated,
    sql_uuid4,
    table,
    with_,
)
from orderflow.functions import draws
from orderflow.operators import generate
from orderflow.operators.keys import BUCKET_ROWS, dense_index, max_id
from orderflow.operators.relational import concat_batches, without_match
from orderflow.schema import TABLES, ForeignKey
from orderflow.session import stage

RUN_DATE = dt.date(2024, 1, 31)


def _customer_rows(spark: SparkSession, sf: str) -> DataFrame:
    return generate.dealt(table(spark, sf, "customer").select(F.col("c_custkey").alias("i")))


def _order_rows(spark: SparkSession, sf: str) -> DataFrame:
    return generate.dealt(table(spark, sf, "orders").select(F.col("o_orderkey").alias("i")))


# Generated keys go on after the largest ones of these tables.
_KEYS = {"address": ("nation", "n_nationkey"), "restaurant": ("supplier", "s_suppkey"), "delivery": ("orders", "o_orderkey")}
_TOP_ADDRESS, _TOP_RESTAURANT, _TOP_DELIVERY = (f"(SELECT max({key}) FROM {name})" for name, key in _KEYS.values())


def _tops(spark: SparkSession, sf: str) -> dict[str, int]:
    return {made: max_id(table(spark, sf, name), key).first()["max_id"] for made, (name, key) in _KEYS.items()}


_C = "(SELECT c_custkey AS i FROM customer)"
_O = "(SELECT o_orderkey AS i FROM orders)"


# ------------------------------------------------------------------ SQL of generated columns


def _email(row_id: str) -> str:
    domains, exts = ("[" + ", ".join(f"'{x}'" for x in xs) + "]" for xs in (draws.EMAIL_DOMAINS, draws.EMAIL_EXTENSIONS))
    d = sql_digest("email", row_id, 1)
    size = f"({sql_draw(d, 0, draws.EMAIL_MAX - draws.EMAIL_MIN + 1)} + {draws.EMAIL_MIN})::INT"
    domain = sql_draw(d, draws.draws_per_number(len(draws.EMAIL_DOMAINS)), len(draws.EMAIL_DOMAINS))
    ext = sql_draw(d, 2 * draws.draws_per_number(len(draws.EMAIL_EXTENSIONS)), len(draws.EMAIL_EXTENSIONS))
    account = sql_repeated("account", row_id, draws.ACCOUNT_CHARS, draws.EMAIL_MAX)
    return (
        f"(substr({account}, 1, {size}) || '@' || list_extract({domains}, ({domain})::INT + 1) "
        f"|| '.' || list_extract({exts}, ({ext})::INT + 1))"
    )


def _password(row_id: str) -> str:
    salt = f"substr(md5('{SEED}:salt:' || {row_id}), 1, 16)"
    word = sql_distinct("password", row_id, draws.PASSWORD_CHARS, draws.PASSWORD_LENGTH)
    return f"({salt} || '$' || sha256({salt} || {word}))"


def _letters(purpose: str, size: int, alphabet: str = draws.LOWER) -> str:
    return sql_distinct(purpose, "i", alphabet, size)


def _phone_bracketed(row_id: str = "i") -> str:
    a, b, c = (sql_distinct(f"phone{k}", row_id, draws.DIGITS, size) for k, size in enumerate((3, 3, 4)))
    return f"('(' || {a} || ') ' || {b} || '-' || {c})"


def _phone_dashed(row_id: str = "i") -> str:
    s = sql_repeated("phone", row_id, draws.DIGITS[1:], 10)
    return f"(SELECT substr(s, 1, 3) || '-' || substr(s, 4, 3) || '-' || substr(s, 7, 4) FROM (SELECT {s} AS s))"


_FLAG_NAMES = ("enabled", "confirmed", "account_non_expired", "account_non_locked", "credentials_non_expired")
_TRUE_FLAGS = ", ".join(f"true AS {f}" for f in _FLAG_NAMES)


def _users(kind: str, role: str, rows: str) -> str:
    key = f"'{kind}-' || i"
    return (
        f"SELECT {sql_uuid4(f'user-{kind}', 'i')} AS id, {role} AS user_role, {_password(f'({key})')} AS password, "
        f"{_email(f'({key})')} AS email, {_TRUE_FLAGS} FROM {rows}"
    )


def _addresses(kind: str, after: str, rows: str) -> str:
    return (
        f"SELECT i + {after} + 1 AS id, {_letters(f'{kind}-line1', 20)} AS line1, {_letters(f'{kind}-city', 10)} AS city, "
        f"{_letters(f'{kind}-state', 2, draws.UPPER)} AS state, {_letters(f'{kind}-zip', 5, draws.DIGITS)} AS zip FROM {rows}"
    )


# ------------------------------------------------------------------ single columns


@query("gen_uuid", f"SELECT i, {sql_uuid4('user-any', 'i')} AS id FROM {_O}")
def gen_uuid(spark: SparkSession, sf: str) -> DataFrame:
    return _order_rows(spark, sf).select("i", generate.user_id(SEED, "any").alias("id"))


@query("gen_email", f"SELECT i, {_email('i')} AS email FROM {_O}")
def gen_email(spark: SparkSession, sf: str) -> DataFrame:
    return _order_rows(spark, sf).select("i", draws.email(SEED, F.col("i")).alias("email"))


@query(
    "gen_distinct_string",
    f"SELECT i, {_letters('word', 20)} AS word, {_letters('code', 2, draws.UPPER)} AS code, {_letters('zip', 5, draws.DIGITS)} AS zip FROM {_O}",
)
def gen_distinct_string(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("i")
    return _order_rows(spark, sf).select(
        "i",
        draws.distinct_chars(SEED, "word", i, draws.LOWER, 20).alias("word"),
        draws.distinct_chars(SEED, "code", i, draws.UPPER, 2).alias("code"),
        draws.distinct_chars(SEED, "zip", i, draws.DIGITS, 5).alias("zip"),
    )


@query("gen_phone_a", f"SELECT i, {_phone_bracketed()} AS phone FROM {_O}")
def gen_phone_a(spark: SparkSession, sf: str) -> DataFrame:
    return _order_rows(spark, sf).select("i", draws.phone_bracketed(SEED, F.col("i")).alias("phone"))


@query("gen_phone_b", f"SELECT i, {_phone_dashed()} AS phone FROM {_O}")
def gen_phone_b(spark: SparkSession, sf: str) -> DataFrame:
    return _order_rows(spark, sf).select("i", draws.phone_dashed(SEED, F.col("i")).alias("phone"))


def _rating(row_id: str = "i") -> str:
    return f"round({sql_pick('rating', row_id)} % {1 << 52} / {1 << 52}.0::DOUBLE * 5.0::DOUBLE, 6)"


@query(
    "gen_uniform",
    f"""SELECT i, {_rating()} AS rating, ({sql_pick("licence", "i")} % 90000 + 10000)::VARCHAR AS license_num,
    ({sql_pick("price", "i")} % 3 + 1)::INT AS price_category, {sql_pick("active", "i")} % 2 = 0 AS is_active FROM {_O}""",
)
def gen_uniform(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("i")
    return _order_rows(spark, sf).select(
        "i",
        F.round(draws.uniform(SEED, "rating", i, 5.0), 6).alias("rating"),
        (draws.pick_below(SEED, "licence", i, 90000) + 10000).cast("string").alias("license_num"),
        (draws.pick_below(SEED, "price", i, 3) + 1).cast("int").alias("price_category"),
        (draws.pick_below(SEED, "active", i, 2) == 0).alias("is_active"),
    )


@query("gen_credential", f"SELECT i, {_password('i')} AS password FROM {_C}")
def gen_credential(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_rows(spark, sf).select("i", draws.password_digest(SEED, F.col("i")).alias("password"))


# ------------------------------------------------------------------ entities


_SHARES = "SELECT count(*) AS n, count(*) // 2 AS c, count(*) // 4 AS a, count(*) // 8 AS e FROM customer"


@query(
    "gen_users",
    f"WITH share AS ({_SHARES}), numbered AS (SELECT c_custkey AS i, c, a, e FROM customer, share) "
    + _users("any", "CASE WHEN i < c THEN 'ROLE_CUSTOMER' WHEN i < c + a THEN 'ROLE_ADMIN' WHEN i < c + a + e THEN 'ROLE_EMPLOYEE' ELSE 'ROLE_DRIVER' END", "numbered"),
)
def gen_users(spark: SparkSession, sf: str) -> DataFrame:
    """Half customers, a quarter admins, an eighth employees, the rest drivers."""
    rows = _customer_rows(spark, sf)
    n = rows.count()
    shares = n // 2, n // 4, n // 8
    return generate.users_by_role(rows, SEED, *shares, n - sum(shares))


def _picked(parents: str, name: str, key: str = "id") -> str:
    """SQL of a picked parent for each row ``t.i``."""
    return f"JOIN {sql_by_hash(parents, key)} {name} ON {name}.idx = {sql_pick(f'pick-{name}', 't.i')} % (SELECT count(*) FROM {parents})"


_ORDERS_OF = (
    with_("customers", "restaurants", "deliveries")
    + f"""SELECT t.i, NULL::BIGINT AS id, customer_id.id AS customer_id, restaurant_id.id AS restaurant_id, delivery_id.id AS delivery_id,
    substr(md5('{SEED}:confirmation:' || t.i), 1, 10) AS confirmation_code FROM {{}} t
    {_picked("customers", "customer_id")} {_picked("restaurants", "restaurant_id")} {_picked("deliveries", "delivery_id")}"""
)


@query("gen_orders", _ORDERS_OF.format("(SELECT event_id AS i FROM events)"))
def gen_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(F.col("event_id").alias("i"))
    return generate.orders(rows, SEED, customers(spark, sf), restaurants(spark, sf), deliveries(spark, sf))


@query(
    "gen_example",
    _ORDERS_OF.format("(SELECT 0::BIGINT AS i)"),
)
def gen_example(spark: SparkSession, sf: str) -> DataFrame:
    """One example row, its parents picked from the whole tables."""
    return generate.orders(generate.row_numbers(spark, 1), SEED, customers(spark, sf), restaurants(spark, sf), deliveries(spark, sf))


@query("gen_addresses", _addresses("any", _TOP_ADDRESS, _C))
def gen_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return generate.addresses(_customer_rows(spark, sf), SEED, _tops(spark, sf)["address"])


def _tagged(parts: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """Rows of several generated tables in one frame: table, key and the other values as JSON-free text."""
    frames = [
        parts[name].select(F.lit(name).alias("table_name"), F.col("id").cast("string").alias("id"), F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("content"))
        for name, cols in columns.items()
    ]
    return concat_batches(*frames)


def _sql_tagged(sql: dict[str, str], columns: dict[str, list[str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, id::VARCHAR AS id, concat_ws('|', {', '.join(cols)}) AS content FROM ({sql[name]})"
        for name, cols in columns.items()
    )


_USER_COLUMNS = ["user_role", "password", "email", *_FLAG_NAMES]
_ADDRESS_COLUMNS = ["line1", "city", "state", "zip"]
_RESTAURANTS = {
    "address": _addresses("restaurant", _TOP_ADDRESS, _C),
    "user": _users("owner", "'ROLE_EMPLOYEE'", _C),
    "owner": f"SELECT {sql_uuid4('user-owner', 'i')} AS id FROM {_C}",
    "restaurant": f"""SELECT i + {_TOP_RESTAURANT} + 1 AS id, i + {_TOP_ADDRESS} + 1 AS address_id, {sql_uuid4("user-owner", "i")} AS owner_id,
      {_letters("restaurant-name", 24)} AS name, 5.0::DOUBLE AS rating FROM {_C}""",
}
_RESTAURANT_COLUMNS = {
    "address": _ADDRESS_COLUMNS,
    "user": _USER_COLUMNS,
    "owner": ["id"],
    "restaurant": ["address_id", "owner_id", "name", "rating"],
}


@query("gen_restaurants_deps", _sql_tagged(_RESTAURANTS, _RESTAURANT_COLUMNS))
def gen_restaurants_deps(spark: SparkSession, sf: str) -> DataFrame:
    tops = _tops(spark, sf)
    made = generate.restaurants_with_parents(_customer_rows(spark, sf), SEED, tops["address"], tops["restaurant"])
    return _tagged(made, _RESTAURANT_COLUMNS)


_CUSTOMERS = {
    "user": _users("customer", "'ROLE_CUSTOMER'", _C),
    "customer": f"""SELECT {sql_uuid4("user-customer", "i")} AS id, {_letters("customer-first", 10)} AS first_name,
      {_letters("customer-last", 10)} AS last_name, {_phone_bracketed()} AS phone FROM {_C}""",
}
_CUSTOMER_COLUMNS = {"user": _USER_COLUMNS, "customer": ["first_name", "last_name", "phone"]}


@query("gen_customers", _sql_tagged(_CUSTOMERS, _CUSTOMER_COLUMNS))
def gen_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged(generate.customers_with_users(_customer_rows(spark, sf), SEED), _CUSTOMER_COLUMNS)


_N = "(SELECT count(*) FROM customer)"
_DRIVERS = {
    "user": _users("driver", "'ROLE_DRIVER'", _C),
    "address": _addresses("driver", _TOP_ADDRESS, _C),
    "driver": f"""SELECT {sql_uuid4("user-driver", "i")} AS id, {sql_pick("driver-address", "i")} % {_N} + {_TOP_ADDRESS} + 1 AS address_id,
      {_letters("driver-first", 10)} AS first_name, {_letters("driver-last", 10)} AS last_name, {_phone_bracketed()} AS phone,
      {_letters("licence-head", 1, draws.UPPER)} || {_letters("licence-tail", 7)} AS license_num, 'ACTIVE' AS status FROM {_C}""",
}
_DRIVER_COLUMNS = {
    "user": _USER_COLUMNS,
    "address": _ADDRESS_COLUMNS,
    "driver": ["address_id", "first_name", "last_name", "phone", "license_num", "status"],
}


@query("gen_drivers_deps", _sql_tagged(_DRIVERS, _DRIVER_COLUMNS))
def gen_drivers_deps(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customer_rows(spark, sf)
    return _tagged(generate.drivers_with_parents(rows, SEED, _tops(spark, sf)["address"], rows.count()), _DRIVER_COLUMNS)


_DELIVERIES = {
    "user": _DRIVERS["user"],
    "driver": _DRIVERS["driver"],
    "address": f"{_DRIVERS['address']} UNION ALL {_addresses('delivery', f'{_TOP_ADDRESS} + {_N}', _C)}",
    "delivery": f"""SELECT i + {_TOP_DELIVERY} + 1 AS id, {sql_pick("delivery-address", "i")} % {_N} + {_TOP_ADDRESS} + {_N} + 1 AS address_id,
      {sql_uuid4("user-driver", f"({sql_pick('delivery-driver', 'i')} % {_N})")} AS driver_id FROM {_C}""",
}
_DELIVERY_COLUMNS = {
    "user": _USER_COLUMNS,
    "driver": _DRIVER_COLUMNS["driver"],
    "address": _ADDRESS_COLUMNS,
    "delivery": ["address_id", "driver_id"],
}


@query("gen_deliveries", _sql_tagged(_DELIVERIES, _DELIVERY_COLUMNS))
def gen_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customer_rows(spark, sf)
    tops = _tops(spark, sf)
    return _tagged(generate.deliveries_with_parents(rows, SEED, tops["address"], tops["delivery"], rows.count()), _DELIVERY_COLUMNS)


@query(
    "gen_dependency_set",
    """WITH c AS (SELECT count(*) AS n FROM customer), r AS (SELECT count(*) AS n FROM supplier), d AS (SELECT count(*) AS n FROM orders)
    SELECT *, 0::BIGINT AS n_dangling FROM (SELECT 'user' AS table_name, c.n + r.n + d.n AS n, c.n + r.n + d.n AS n_ids FROM c, r, d UNION ALL SELECT 'customer', n, n FROM c
    UNION ALL SELECT 'owner', n, n FROM r UNION ALL SELECT 'restaurant', n, n FROM r
    UNION ALL SELECT 'address', r.n + 2 * d.n, r.n + 2 * d.n FROM r, d UNION ALL SELECT 'driver', n, n FROM d UNION ALL SELECT 'delivery', n, n FROM d)""",
)
def gen_dependency_set(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, distinct keys and references to nothing per generated table."""
    suppliers = generate.dealt(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("i")))
    orders = _order_rows(spark, sf)
    made = generate.dependency_set(
        _customer_rows(spark, sf), suppliers, orders, SEED, suppliers.count(), orders.count(), _tops(spark, sf)
    )
    # Keys and references are met several times below, so they are made once.
    referring = {name: [fk for fk in TABLES[name].foreign_keys if fk.parent in made and fk.column in df.columns] for name, df in made.items()}
    made = {name: stage(df.select(*dict.fromkeys(["id", *[fk.column for fk in referring[name]]])), f"made-{name}") for name, df in made.items()}
    # Keys are 16 bytes of digest or dense numbers: grouping them is a shuffle of ids only, dealt over as many
    # tasks as there are rows for, since nearly all are distinct and a task holds all that it is dealt.
    dealt = {name: -(-df.count() // BUCKET_ROWS) + 1 for name, df in made.items()}
    sizes = [
        df.repartition(dealt[name], "id")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(F.lit(name).alias("table_name"), F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_ids"))
        for name, df in made.items()
    ]

    def loose_of(name: str, fk: ForeignKey) -> DataFrame:
        n = max(dealt[name], dealt[fk.parent])
        parents = made[fk.parent].select(F.col(fk.parent_column).alias(fk.column)).repartition(n, fk.column)
        return made[name].repartition(n, fk.column).join(parents, fk.column, "left_anti").select(F.lit(name).alias("table_name"))

    loose = [loose_of(name, fk) for name in made for fk in referring[name]]
    dangling = concat_batches(*loose).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_dangling"))
    return concat_batches(*sizes).join(dangling, "table_name", "left").fillna(0, ["n_dangling"])


# ------------------------------------------------------------------ from seed lists

_FIRST_NAMES = "first_names AS (SELECT DISTINCT p_brand AS name FROM part)"
_LAST_NAMES = "last_names AS (SELECT DISTINCT p_name AS name FROM part)"


@query(
    "gen_drivers_seed",
    with_("persons", "drivers")
    + f""", {_FIRST_NAMES}, {_LAST_NAMES}, places AS (SELECT n_nationkey AS id FROM nation),
    t AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i FROM persons WHERE id NOT IN (SELECT id FROM drivers))
    SELECT t.id, address_id.id::BIGINT AS address_id, first_name.name AS first_name, last_name.name AS last_name,
      first_name.name || '.' || last_name.name || '@mail.com' AS email, {_phone_dashed("t.i")} AS phone, '31/01/2024' AS dob,
      ({sql_pick("licence", "t.i")} % 90000 + 10000)::VARCHAR AS license_num, {_rating("t.i")} AS rating, 'waiting' AS status
    FROM t {_picked("places", "address_id")} {_picked("first_names", "first_name", "name")} {_picked("last_names", "last_name", "name")}""",
)
def gen_drivers_seed(spark: SparkSession, sf: str) -> DataFrame:
    """A driver for every user who is none yet."""
    free = without_match(persons(spark, sf).select("id"), drivers(spark, sf))
    rows = dense_index(free, ["id"], "i")
    places = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("id"))
    parts = table(spark, sf, "part")
    first_names = parts.select(F.col("p_brand").alias("name")).distinct()
    last_names = parts.select(F.col("p_name").alias("name")).distinct()
    return generate.drivers_from_seed(rows, SEED, places, first_names, last_names, RUN_DATE)


_SEED_RESTAURANTS = (
    with_("owners")
    + f""", {_LAST_NAMES}, places AS (SELECT c_custkey AS place_id, c_name AS address, c_mktsegment AS city, 'UT' AS state, lpad(c_custkey::VARCHAR, 6, '0') AS zip FROM customer),
    t AS (SELECT p_partkey AS i FROM part),
    made AS (SELECT t.i, place_id.place_id, address, city, state, zip, name.name, owner_id.id AS owner_id FROM t
      {_picked("places", "place_id", "place_id")} {_picked("last_names", "name", "name")} {_picked("owners", "owner_id")}) """
)


@query(
    "gen_restaurants_seed",
    _SEED_RESTAURANTS
    + f"""SELECT i + {_TOP_RESTAURANT} + 1 AS id, i + {_TOP_ADDRESS} + 1 AS address_id, owner_id, name, {_rating("i")} AS rating, ({sql_pick("price", "i")} % 3 + 1)::INT AS price_category,
      {_phone_dashed("i")} AS phone, {sql_pick("active", "i")} % 2 = 0 AS is_active, address AS line1, '' AS line2, city, state, zip FROM made""",
)
def gen_restaurants_seed(spark: SparkSession, sf: str) -> DataFrame:
    """Each generated restaurant beside its generated address."""
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("i"))
    places = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("place_id"), F.col("c_name").alias("address"), F.col("c_mktsegment").alias("city"),
        F.lit("UT").alias("state"), F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("zip"),
    )
    names = table(spark, sf, "part").select(F.col("p_name").alias("name")).distinct()
    tops = _tops(spark, sf)
    made = generate.restaurants_from_seed(rows, SEED, places, names, owners(spark, sf), tops["address"], tops["restaurant"])
    return made["restaurant"].join(made["address"].withColumnRenamed("id", "address_id"), "address_id")
