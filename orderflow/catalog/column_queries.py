"""Casts, predicates, defaults and masks over whole test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.catalog.registry import owner_id, persons, query, table, with_
from orderflow.functions import casts
from orderflow.schema import DRIVER, ORDER, RESTAURANT, TABLES, USER, Entity
from orderflow.sources.files import type_rows

# Texts the cast queries spread over the rows of a table.
BOOL_TEXTS = ("yes", "No", "TRUE", "f", "1", "0", "On", "OFF", "maybe", "Y", "n", "", "T", "False")
LONG_TEXTS = ("17", "-4", "+9", "5.0", "1_0", "abc", "", "9223372036854775807", "9223372036854775808", "007")
DOUBLE_TEXTS = ("3.6", "5", "-0.25", ".5", "1e3", "1d", "nan", "x", "", "1_0")


def _spread(texts: tuple[str, ...], key: str) -> Column:
    return F.element_at(F.array(*map(F.lit, texts)), (F.col(key) % len(texts)).cast("int") + 1)


def _sql_spread(texts: tuple[str, ...], key: str) -> str:
    return "list_extract([" + ", ".join(f"'{t}'" for t in texts) + f"], ({key} % {len(texts)})::INT + 1)"


@query(
    "cast_bool",
    f"""WITH t AS (SELECT event_id, {_sql_spread(BOOL_TEXTS, "event_id")} AS text FROM events)
    SELECT event_id, text, CASE WHEN lower(text) IN ('y','yes','t','true','on','1') THEN true
      WHEN lower(text) IN ('n','no','f','false','off','0') THEN false END AS value FROM t""",
)
def cast_bool(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "events").select("event_id", _spread(BOOL_TEXTS, "event_id").alias("text"))
    return t.withColumn("value", casts.to_bool(F.col("text")))


@query(
    "cast_long",
    f"""WITH t AS (SELECT event_id, {_sql_spread(LONG_TEXTS, "event_id")} AS text FROM events)
    SELECT event_id, text, CASE WHEN regexp_full_match(text, '[+-]?[0-9]+') THEN try_cast(text AS BIGINT) END AS value FROM t""",
)
def cast_long(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "events").select("event_id", _spread(LONG_TEXTS, "event_id").alias("text"))
    return t.withColumn("value", casts.to_long(F.col("text")))


@query(
    "cast_double",
    f"""WITH t AS (SELECT event_id, {_sql_spread(DOUBLE_TEXTS, "event_id")} AS text FROM events)
    SELECT event_id, text, CASE WHEN text NOT IN ('1d', 'nan', 'x', '', '1_0') THEN try_cast(text AS DOUBLE) END AS value FROM t""",
)
def cast_double(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "events").select("event_id", _spread(DOUBLE_TEXTS, "event_id").alias("text"))
    return t.withColumn("value", casts.to_double(F.col("text")))


@query(
    "uuid_normalize",
    """WITH h AS (SELECT c_custkey, c_mktsegment, md5('person:' || c_custkey) AS h FROM customer),
    t AS (SELECT c_custkey, h, CASE c_mktsegment
        WHEN 'BUILDING' THEN upper(substr(h,1,8) || '-' || substr(h,9,4) || '-' || substr(h,13,4) || '-' || substr(h,17,4) || '-' || substr(h,21))
        WHEN 'MACHINERY' THEN upper(h) WHEN 'FURNITURE' THEN 'urn:uuid:' || h WHEN 'HOUSEHOLD' THEN substr(h, 2) ELSE h END AS text,
        c_mktsegment = 'HOUSEHOLD' AS damaged FROM h)
    SELECT c_custkey, text, CASE WHEN NOT damaged THEN h END AS id,
      CASE WHEN NOT damaged THEN substr(h,1,8) || '-' || substr(h,9,4) || '-' || substr(h,13,4) || '-' || substr(h,17,4) || '-' || substr(h,21) END AS hyphenated
    FROM t""",
)
def uuid_normalize(spark: SparkSession, sf: str) -> DataFrame:
    h = F.md5(F.concat(F.lit("person:"), F.col("c_custkey").cast("string")))
    segment = F.col("c_mktsegment")
    text = (
        F.when(segment == "BUILDING", F.upper(casts.uuid_text(h)))
        .when(segment == "MACHINERY", F.upper(h))
        .when(segment == "FURNITURE", F.concat(F.lit("urn:uuid:"), h))
        .when(segment == "HOUSEHOLD", F.substring(h, 2, 31))
        .otherwise(h)
    )
    t = table(spark, sf, "customer").select("c_custkey", text.alias("text"))
    ids = t.withColumn("id", casts.uuid_hex(F.col("text")))
    return ids.withColumn("hyphenated", F.when(F.col("id").isNotNull(), casts.uuid_text(F.col("id"))))


def _gappy_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customer rows in which some fields are absent."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") < 20, F.col("c_nationkey").cast("string")).alias("nation"),
    )


_GAPPY = """WITH t AS (SELECT c_custkey::VARCHAR AS id, CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
    CASE WHEN c_nationkey < 20 THEN c_nationkey::VARCHAR END AS nation FROM customer) """


@query(
    "required_fields",
    _GAPPY + "SELECT id, CASE WHEN id IS NULL THEN 'id' WHEN name IS NULL THEN 'name' WHEN nation IS NULL THEN 'nation' END AS missing_field FROM t",
)
def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    t = _gappy_customers(spark, sf)
    return t.select("id", casts.missing_field(["id", "name", "nation"]).alias("missing_field"))


@query(
    "row_arity",
    """WITH t AS (SELECT doc_id, len(string_split(text, ',')) AS fields FROM documents)
    SELECT doc_id, fields::INT AS fields, fields = 5 AS exact, fields >= 5 AS at_least FROM t""",
)
def row_arity(spark: SparkSession, sf: str) -> DataFrame:
    fields = F.size(F.split("text", ",", -1))
    t = table(spark, sf, "documents").select("doc_id", fields.alias("fields"))
    return t.select("*", (F.col("fields") == 5).alias("exact"), (F.col("fields") >= 5).alias("at_least"))


def _typed(rows: DataFrame, entity: Entity) -> DataFrame:
    """Type rows that did not come from a file."""
    nothing = F.lit(None).cast("string")
    control = rows.select(
        *entity.columns, nothing.alias("_mark"), nothing.alias("_file"), F.lit(0).alias("_pos"),
        nothing.alias("reject_reason"), nothing.alias("reject_detail"),
    )
    return type_rows(control, entity).drop("_mark", "_file", "_pos")


_FLAGS = USER.columns[4:]


@query(
    "typed_users",
    with_("persons")
    + """, t AS (SELECT id, user_role, password, email, """
    + ", ".join(f"CASE WHEN {f} THEN 'Yes' ELSE 'off' END AS {f}" for f in _FLAGS[:4])
    + f", CASE WHEN {_FLAGS[4]} THEN 'perhaps' ELSE '0' END AS {_FLAGS[4]} FROM persons) SELECT id, user_role, password, email, "
    + ", ".join(f"{f} = 'Yes' AS {f}" for f in _FLAGS[:4])
    + f""", CASE WHEN {_FLAGS[4]} = '0' THEN false END AS {_FLAGS[4]},
    CASE WHEN {_FLAGS[4]} = 'perhaps' THEN 'bad_value' END AS reject_reason,
    CASE WHEN {_FLAGS[4]} = 'perhaps' THEN '{_FLAGS[4]}' END AS reject_detail FROM t""",
)
def typed_users(spark: SparkSession, sf: str) -> DataFrame:
    text = persons(spark, sf).select(
        F.upper(casts.uuid_text(F.col("id"))).alias("id"),
        "user_role",
        "password",
        "email",
        *[F.when(F.col(f), "Yes").otherwise("off").alias(f) for f in _FLAGS[:4]],
        F.when(F.col(_FLAGS[4]), "perhaps").otherwise("0").alias(_FLAGS[4]),
    )
    return _typed(text, USER)


@query(
    "typed_orders",
    """WITH t AS (SELECT o_orderkey, md5('person:' || o_custkey) AS customer_id, o_custkey % 100 AS restaurant_id,
      CASE o_orderpriority WHEN '5-LOW' THEN 'soon' WHEN '2-HIGH' THEN NULL ELSE o_orderkey::VARCHAR END AS delivery, o_orderpriority AS code FROM orders)
    SELECT o_orderkey AS id, customer_id, restaurant_id, try_cast(delivery AS BIGINT) AS delivery_id, code AS confirmation_code,
      CASE WHEN delivery IS NULL THEN 'missing_field' WHEN delivery = 'soon' THEN 'bad_value' END AS reject_reason,
      CASE WHEN delivery IS NULL OR delivery = 'soon' THEN 'delivery_id' END AS reject_detail FROM t""",
)
def typed_orders(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    text = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.upper(F.md5(F.concat(F.lit("person:"), F.col("o_custkey").cast("string")))).alias("customer_id"),
        (F.col("o_custkey") % 100).cast("string").alias("restaurant_id"),
        F.when(priority == "5-LOW", "soon").when(priority != "2-HIGH", F.col("o_orderkey").cast("string")).alias("delivery_id"),
        priority.alias("confirmation_code"),
    )
    return _typed(text, ORDER)


@query(
    "typed_drivers",
    """SELECT md5('person:' || c_custkey) AS user_id, c_nationkey::BIGINT AS address_id, c_mktsegment AS first_name, c_name AS last_name,
      '200-555-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone, lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') || '-15-1990' AS dob, c_custkey::VARCHAR AS license_num,
      CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS rating, 'active' AS status,
      CASE WHEN c_acctbal < 0 THEN 'bad_value' END AS reject_reason, CASE WHEN c_acctbal < 0 THEN 'rating' END AS reject_detail FROM customer""",
)
def typed_drivers(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "customer").select(
        F.md5(F.concat(F.lit("person:"), F.col("c_custkey").cast("string"))).alias("user_id"),
        F.col("c_nationkey").cast("string").alias("address_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit("200-555-"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")).alias("phone"),
        F.concat(F.lpad((F.col("c_custkey") % 12 + 1).cast("string"), 2, "0"), F.lit("-15-1990")).alias("dob"),
        F.col("c_custkey").cast("string").alias("license_num"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("none").alias("rating"),
        F.lit("active").alias("status"),
    )
    return _typed(text, DRIVER)


def restaurant_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every part as a restaurant record in text, its owner a supplier or nobody."""
    return table(spark, sf, "part").select(
        F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"')).alias("street"),
        F.col("p_type").alias("city"),
        F.substring("p_type", 1, 2).alias("state"),
        F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("zip"),
        owner_id(F.col("p_size")).alias("owner_id"),
        F.concat_ws(" ", "p_name", "p_partkey").alias("name"),
        F.when(F.col("p_size") > 5, (F.col("p_size") / 10).cast("string")).otherwise("good").alias("rating"),
        (F.col("p_size") % 3 + 1).cast("string").alias("price_category"),
        F.concat(F.lit("200-555-"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0")).alias("phone"),
        F.when(F.col("p_type") == "PROMO", "1").otherwise("0").alias("is_active"),
        F.concat(F.lit("https://pictures.example.com/"), F.col("p_partkey").cast("string")).alias("picture"),
    )


# The same records, typed.
RESTAURANT_ROWS = """rest AS (SELECT p_partkey, p_type, p_brand, p_size, p_name || ', "' || p_brand || '"' AS street, p_type AS city, substr(p_type, 1, 2) AS state,
    lpad(p_partkey::VARCHAR, 6, '0') AS zip, md5('owner:' || p_size) AS owner_id, p_name || ' ' || p_partkey AS name,
    CASE WHEN p_size > 5 THEN p_size / 10 END AS rating, (p_size % 3 + 1)::INT AS price_category, '200-555-' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS phone,
    CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END::INT AS is_active, 'https://pictures.example.com/' || p_partkey AS picture,
    CASE WHEN p_size <= 5 THEN 'bad_value' END AS reject_reason, CASE WHEN p_size <= 5 THEN 'rating' END AS reject_detail FROM part)"""
RESTAURANT_COLUMNS = ", ".join(RESTAURANT.columns)


@query("typed_restaurants", f"WITH {RESTAURANT_ROWS} SELECT {RESTAURANT_COLUMNS}, reject_reason, reject_detail FROM rest")
def typed_restaurants(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(restaurant_texts(spark, sf), RESTAURANT)


@query(
    "fill_defaults",
    """SELECT l_partkey AS menuitem_id, l_orderkey AS order_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE l_quantity::BIGINT END AS quantity FROM lineitem""",
)
def fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("menuitem_id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("long")).alias("quantity"),
    )
    return casts.fill_defaults(lines, TABLES["menuitem_order"])


@query(
    "derive_email",
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment || '.' || c_name || '@mail.com' END AS email FROM customer",
)
def derive_email(spark: SparkSession, sf: str) -> DataFrame:
    first = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", casts.derived_email(first, F.col("c_name")).alias("email"))


@query(
    "domain_checks",
    """WITH t AS (SELECT doc_id AS id, source AS line1, CASE WHEN n_chars > 500 THEN lang END AS city,
        CASE WHEN lang = 'en' THEN 'ENG' ELSE lang END AS state, n_chars::VARCHAR || source AS zip FROM documents)
    SELECT id, CASE WHEN line1 IS NULL THEN 'not_null:line1' WHEN length(line1) > 255 THEN 'too_long:line1' WHEN city IS NULL THEN 'not_null:city'
      WHEN length(city) > 255 THEN 'too_long:city' WHEN state IS NULL THEN 'not_null:state' WHEN length(state) > 2 THEN 'too_long:state'
      WHEN zip IS NULL THEN 'not_null:zip' WHEN length(zip) > 10 THEN 'too_long:zip' END AS violation FROM t""",
)
def domain_checks(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("line1"),
        F.lit("").alias("line2"),
        F.when(F.col("n_chars") > 500, F.col("lang")).alias("city"),
        F.when(F.col("lang") == "en", "ENG").otherwise(F.col("lang")).alias("state"),
        F.concat(F.col("n_chars").cast("string"), F.col("source")).alias("zip"),
    )
    return t.select("id", casts.domain_violation(TABLES["address"]).alias("violation"))


@query(
    "mask_columns",
    with_("persons") + "SELECT substr(id, 1, 12) || '...' AS id, user_role, substr(password, 1, 16) || '...' AS password, email FROM persons",
)
def mask_columns(spark: SparkSession, sf: str) -> DataFrame:
    return casts.mask_display(persons(spark, sf).select("id", "user_role", "password", "email"))


@query(
    "mask_short",
    """SELECT CASE WHEN length(c_custkey::VARCHAR) > 2 THEN substr(c_custkey::VARCHAR, 1, 2) || '...' ELSE c_custkey::VARCHAR END AS c_custkey,
      CASE WHEN length(c_mktsegment) > 2 THEN substr(c_mktsegment, 1, 2) || '...' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
)
def mask_short(spark: SparkSession, sf: str) -> DataFrame:
    return casts.mask_short(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"))


