"""Sinks, conversion, ingest jobs and deletes from end to end."""

import json
from pathlib import Path
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from orderflow.catalog.registry import scratch_file
from orderflow.errors import IngestError
from orderflow.functions import casts
from orderflow.operators import maintain
from orderflow.plans import constraints, ingest
from orderflow.plans.convert import convert
from orderflow.schema import DELETE_ORDER, DRIVER, ORDER, RESTAURANT, TABLES, USER, Attr, Entity
from orderflow.sinks import files as sink
from orderflow.sinks.tables import append_table
from orderflow.sources.files import read_entity
from orderflow.sources import tables as tables_
from orderflow.sources.tables import table

USERS = [
    ("698bb0ddef094f47adf00cfa08a485bb", "ROLE_ADMIN", "p", "me@m.com", True, False, True, False, True),
    ("00000000000000000000000000000001", "ROLE_DRIVER", "q", "you@m.com", False, False, True, True, True),
]
USER_DDL = "id string, user_role string, password string, email string, " + ", ".join(f"{c} boolean" for c in USER.columns[4:])


@pytest.fixture
def users(spark):
    return spark.createDataFrame(USERS, USER_DDL)


def text_of(path):
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))


def test_csv_text(spark, users, tmp_path):
    path = str(tmp_path / "u.csv")
    sink.write_entity(users.coalesce(1).orderBy("user_role").withColumn("password", F.lit(None).cast("string")), path, USER)
    assert text_of(path).splitlines()[0] == (
        "698bb0dd-ef09-4f47-adf0-0cfa08a485bb,ROLE_ADMIN,None,me@m.com,True,False,True,False,True"
    )


@pytest.mark.parametrize("n", [0, 1, 2])
def test_json_array_parts_are_json(spark, users, tmp_path, n):
    path = str(tmp_path / "u.json")
    sink.write_json(users.limit(n).coalesce(1), path, USER, layout="array")
    assert len(json.loads(text_of(path) or "[]")) == n
    assert read_entity(spark, path, USER).count() == n


def test_json_array_over_many_batches(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        orders = spark.range(50).select("id", F.lit("c").alias("customer_id"), *[F.col("id").alias(c) for c in ORDER.columns[2:4]], F.lit("x").alias("confirmation_code"))
        path = str(tmp_path / "o.json")
        sink.write_json(orders.coalesce(1), path, ORDER, layout="array")
        assert [o["id"] for o in json.loads(text_of(path))] == list(range(50))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_xml_has_root_and_row_tags(spark, users, tmp_path):
    path = str(tmp_path / "u.xml")
    sink.write_entity(users.coalesce(1), path, USER)
    root = ElementTree.fromstring(text_of(path))
    assert root.tag == "users" and [e.tag for e in root] == ["user", "user"]
    assert [c.tag for c in root[0]] == USER.columns


@pytest.mark.parametrize("first", ["csv", "json", "xml"])
@pytest.mark.parametrize("second", ["csv", "json", "xml"])
def test_conversion_keeps_content(spark, users, tmp_path, first, second):
    a, b = str(tmp_path / f"a.{first}"), str(tmp_path / f"b.{second}")
    sink.write_entity(users, a, USER)
    convert(spark, a, b, USER)
    assert {tuple(r) for r in read_entity(spark, b, USER).select(*USER.columns).collect()} == set(USERS)


@pytest.mark.parametrize("first", ["csv", "json", "xml"])
@pytest.mark.parametrize("second", ["csv", "json", "xml"])
def test_conversion_keeps_commas_quotes_and_line_breaks(spark, users, tmp_path, first, second):
    a, b = str(tmp_path / f"a.{first}"), str(tmp_path / f"b.{second}")
    odd = users.withColumn("password", F.lit('a, "b"\n<c&d>'))
    sink.write_entity(odd, a, USER)
    convert(spark, a, b, USER, quoted=True)
    got = read_entity(spark, b, USER, quoted=True).select(*USER.columns)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in odd.select(*USER.columns).collect()}


def test_conversion_raises_instead_of_losing_rows(spark, users, tmp_path):
    source = str(tmp_path / "a.json")
    sink.write_entity(users.withColumn("password", F.lit("a,b")), source, USER)
    with pytest.raises(IngestError) as e:
        convert(spark, source, str(tmp_path / "b.csv"), USER)
    assert (e.value.reason, e.value.detail) == ("needs_quotes", "password")
    (tmp_path / "c.csv").write_text("one,field,too\n")
    with pytest.raises(IngestError) as e:
        convert(spark, str(tmp_path / "c.csv"), str(tmp_path / "d.json"), USER)
    assert e.value.reason == "field_count"


@pytest.mark.parametrize("ext", ["csv", "json", "xml"])
def test_an_empty_table_survives(spark, users, tmp_path, ext):
    path = str(tmp_path / f"u.{ext}")
    sink.write_entity(users.limit(0), path, USER)
    assert read_entity(spark, path, USER).isEmpty()


def test_conversion_checks_both_extensions_first(spark, tmp_path):
    for a, b in (("missing.csv", "out.txt"), ("in.txt", "out.csv")):
        with pytest.raises(IngestError) as e:
            convert(spark, str(tmp_path / a), str(tmp_path / b), USER)
        assert e.value.reason == "unsupported_format"


def test_ingest_users_saves_once(spark, users, tmp_path):
    root, path = str(tmp_path / "store"), str(tmp_path / "u.csv")
    append_table(users.filter("email = 'me@m.com'"), root, "user")
    sink.write_entity(users, path, USER)
    job = ingest.ingest_users(spark, path, {"user": table(spark, root, "user")})
    assert {tuple(r) for r in job.outcome.collect()} == {("accepted", 1), ("user_exists", 1)}
    job.save(root)
    again = ingest.ingest_users(spark, path, {"user": table(spark, root, "user")})
    assert {tuple(r) for r in again.outcome.collect()} == {("user_exists", 2)}
    assert table(spark, root, "user").count() == 2


def test_ingest_orders_with_whole_file_refused(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("1,c1,10,100,x\n2,c1,10,100\n")
    ids = spark.createDataFrame([(10,), (100,)], "id long")
    tables = {"order": ids.limit(0), "customer": spark.createDataFrame([("c1",)], "id string"), "restaurant": ids, "delivery": ids}
    job = ingest.ingest_orders(spark, str(path), tables)
    assert {tuple(r) for r in job.outcome.collect()} == {("field_count", 2)}
    assert job.inserts["order"].isEmpty()


def test_ingest_orders_first_of_a_file_wins(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("1,c1,10,100,first\n1,c1,10,100,second\n3,zz,10,100,a\n3,C-1,10,100,b\n")
    ids = spark.createDataFrame([(10,), (100,)], "id long")
    tables = {"order": ids.limit(0), "customer": spark.createDataFrame([("c1",)], "id string"), "restaurant": ids, "delivery": ids}
    job = ingest.ingest_orders(spark, str(path), tables)
    # the third row has no customer, so the fourth may use its id
    assert {r["id"]: r["confirmation_code"] for r in job.inserts["order"].collect()} == {1: "first", 3: "b"}


def test_ingest_restaurants_makes_addresses_for_accepted_rows_only(spark, tmp_path):
    path = tmp_path / "r.csv"
    rows = ["1 A St,Phoenix,AZ,05084,o1,R1,5,1,407,1,p", "2 B St,Phoenix,ARIZ,1,o1,R2,5,1,407,1,p", "3 C St,X,AZ,1,none,R3,5,1,407,0,p", "4 D St,Y,WY,2,o1,R4,3,2,555,0,p"]
    path.write_text("\n".join(rows))
    tables = {"owner": spark.createDataFrame([("o1",)], "id string"), "address": spark.createDataFrame([(6,)], "id long"), "restaurant": spark.range(0)}
    job = ingest.ingest_restaurants(spark, str(path), tables)
    job.save(str(tmp_path / "store"))
    places = {r["id"]: r["line1"] for r in table(spark, str(tmp_path / "store"), "address").collect()}
    shops = {r["id"]: (r["address_id"], r["name"], r["is_active"]) for r in table(spark, str(tmp_path / "store"), "restaurant").collect()}
    assert places == {7: "1 A St", 8: "4 D St"}
    assert shops == {2: (7, "R1", True), 3: (8, "R4", False)}
    assert {r["outcome"] for r in job.outcome.collect()} == {"accepted", "too_long:state", "no_owner"}


def test_custom_mapper(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("1 A St,Phoenix,AZ,05084,o1,R1,5,1,407,1,p\nshort")
    got = ingest.ingest_with(spark, str(path), RESTAURANT, lambda df: df.select((F.col("rating") * 2).alias("stars")))
    assert [r["stars"] for r in got.collect()] == [10.0]


def test_fill_defaults_adds_missing_columns(spark):
    df = spark.createDataFrame([(1, None)], "id string, enabled boolean")
    row = casts.fill_defaults(df, TABLES["user"]).first()
    assert row["enabled"] is True and row["confirmed"] is True and row["created_at"] is not None


def test_delete_all_empties_every_table(spark, tmp_path):
    root = str(tmp_path / "store")
    for name in DELETE_ORDER:
        spark.range(3).write.parquet(f"{root}/{name}.parquet")
    maintain.delete_all(spark, root)
    assert all(table(spark, root, name).isEmpty() for name in DELETE_ORDER)


def test_cascade_is_blocked_by_a_grandchild(spark):
    tables = {
        "address": spark.range(4),
        "restaurant": spark.createDataFrame([(10, 0), (11, 1)], "id long, address_id long"),
        "order": spark.createDataFrame([(5, 11)], "id long, restaurant_id long"),
        "driver": spark.createDataFrame([(7, 3)], "id long, address_id long"),
    }
    doomed = spark.range(4)
    assert {r["id"] for r in maintain.blocked_deletes(doomed, "address", tables).collect()} == {1, 3}
    left = maintain.cascade_delete(doomed, "address", tables)
    assert {r["id"] for r in left["address"].collect()} == {1, 3}
    assert {r["id"] for r in left["restaurant"].collect()} == {11}


def test_every_reference_names_a_table_and_a_column():
    for t in TABLES.values():
        for fk in t.foreign_keys:
            assert fk.column in t.columns and fk.parent_column in TABLES[fk.parent].columns
        assert set(t.primary_key) | set(t.unique) <= set(t.columns)
    assert len(TABLES) == 19


def test_scratch_paths_are_fresh(spark):
    assert scratch_file(spark, "x.csv") != scratch_file(spark, "x.csv")


ORDERS_DDL = "id long, customer_id string, restaurant_id long, delivery_id long, confirmation_code string"


def _order_tables(spark):
    ids = spark.createDataFrame([(10,), (100,)], "id long")
    return {"order": ids.limit(0), "customer": spark.createDataFrame([("c1",)], "id string"), "restaurant": ids, "delivery": ids}


RESTAURANT_LINES = [f"{i} A St,Phoenix,AZ,0508{i % 10},{'o1' if i % 4 else 'none'},R{i % 3},5,1,407,1,p" for i in range(40)]


def test_saving_again_adds_nothing(spark, users, tmp_path):
    root = str(tmp_path / "store")
    path = str(tmp_path / "u.csv")
    sink.write_entity(users, path, USER)
    job = ingest.ingest_users(spark, path, {"user": users.limit(0)})
    job.save(root)
    job.save(root)
    assert table(spark, root, "user").count() == 2
    # orders without id get theirs once, whoever saves
    batch = spark.createDataFrame([(i if i % 2 else None, "c1", 10, 100, f"x{i}") for i in range(6)], ORDERS_DDL).coalesce(1)
    rows = batch.select("*", F.lit("f").alias("_file"), F.monotonically_increasing_id().alias("_pos"), F.lit(None).cast("string").alias("reject_reason"))
    checked = ingest.constraints.check(rows, ORDER, _order_tables(spark))
    for _ in range(2):
        keyed = ingest.ledger.keyed(ingest.ledger.with_source(checked).filter("id is null"), root, "order", {"_key": 5})
        assert sorted((r["_key"], r["confirmation_code"]) for r in keyed.collect()) == [(6, "x0"), (7, "x2"), (8, "x4")]


@pytest.mark.parametrize("size", ["128m", "400b"])
def test_restaurants_are_saved_once_however_often_and_however_split(spark, tmp_path, size):
    (tmp_path / "r.csv").mkdir()
    (tmp_path / "r.csv" / "a").write_text("\n".join(RESTAURANT_LINES))
    (tmp_path / "r.csv" / "b").write_text("\n".join(RESTAURANT_LINES))  # the same rows in another file are other restaurants
    tables = {"owner": spark.createDataFrame([("o1",)], "id string"), "address": spark.range(0), "restaurant": spark.range(0)}
    root = str(tmp_path / "store")
    first = ingest.ingest_restaurants(spark, str(tmp_path / "r.csv"), tables)
    first.save(root)
    held = {n: sorted(map(tuple, table(spark, root, n).collect())) for n in ("address", "restaurant")}
    first.save(root)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        ingest.ingest_restaurants(spark, str(tmp_path / "r.csv"), tables).save(root)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert held == {n: sorted(map(tuple, table(spark, root, n).collect())) for n in ("address", "restaurant")}
    assert len(held["address"]) == len(held["restaurant"]) == 60
    assert [r[0] for r in held["restaurant"]] == list(range(2, 62))


def test_a_save_that_broke_is_healed(spark, tmp_path, monkeypatch):
    (tmp_path / "r.csv").write_text("\n".join(RESTAURANT_LINES))
    tables = {"owner": spark.createDataFrame([("o1",)], "id string"), "address": spark.range(0), "restaurant": spark.range(0)}
    root = str(tmp_path / "store")
    plain = ingest.sink.append_table

    def breaks(df, where, name):
        if name == "restaurant":
            raise OSError("gone")
        plain(df, where, name)

    monkeypatch.setattr(ingest.sink, "append_table", breaks)
    with pytest.raises(OSError):
        ingest.ingest_restaurants(spark, str(tmp_path / "r.csv"), tables).save(root)
    monkeypatch.setattr(ingest.sink, "append_table", plain)
    assert table(spark, root, "address").count() == 30
    with (tmp_path / "r.csv").open("a") as file:
        file.write("\n99 New St,Phoenix,AZ,05080,o1,New,5,1,407,1,p")
    ingest.ingest_restaurants(spark, str(tmp_path / "r.csv"), tables).save(root)
    shops = {r["address_id"]: r["name"] for r in table(spark, root, "restaurant").collect()}
    places = {r["id"]: r["line1"] for r in table(spark, root, "address").collect()}
    assert len(shops) == len(places) == 31 and shops.keys() == places.keys()
    assert all(shops[k] == ("New" if places[k] == "99 New St" else f"R{int(places[k].split()[0]) % 3}") for k in shops)


@pytest.mark.parametrize("first", ["csv", "json", "xml"])
@pytest.mark.parametrize("second", ["csv", "json", "xml"])
def test_conversion_keeps_the_order(spark, tmp_path, first, second):
    a, b = str(tmp_path / f"a.{first}"), str(tmp_path / f"b.{second}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        n = 600
        # files of very different sizes, which are read in order of size
        orders = spark.range(n).select("id", F.lit("c").alias("customer_id"), *[F.col("id").alias(c) for c in ORDER.columns[2:4]], F.lit("x").alias("confirmation_code"))
        part = F.when(F.col("id") < 10, 0).when(F.col("id") < 400, 1).when(F.col("id") < 420, 2).otherwise(3)
        sink.write_entity(orders.withColumn("p", part).repartitionByRange(4, "p").sortWithinPartitions("id"), a, ORDER, layout="array")
        convert(spark, a, b, ORDER)
        texts = [p.read_text() for p in sorted(Path(b).glob("part-*"))]
        if second == "csv":
            got = [int(line.split(",")[0]) for t in texts for line in t.splitlines()]
        elif second == "json":
            got = [o["id"] for t in texts if t.strip() for o in json.loads(t)]
        else:
            got = [int(e.find("id").text) for t in texts if t.strip() for e in ElementTree.fromstring(t)]
        assert got == list(range(n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_the_four_entities_are_checked_as_declared():
    planned = {}
    for entity in (USER, ORDER, DRIVER, RESTAURANT):
        for target in constraints.targets_of(entity):
            t, columns = TABLES[target.table], constraints.columns_from(entity, target)
            names = dict.fromkeys(["user", "order", "driver", "restaurant", "customer", "delivery", "owner", "address"], None)
            tables = {n: "stored" for n in names}
            planned[entity.name, t.name] = [(r.reason, r.columns) for r in constraints.stored_rules(t, columns, tables, target.made)]
    assert planned == {
        ("user", "user"): [("user_exists", ("id",)), ("email_exists", ("email",))],
        ("order", "order"): [("order_exists", ("id",)), ("no_customer", ("customer_id",)), ("no_restaurant", ("restaurant_id",)), ("no_delivery", ("delivery_id",))],
        ("driver", "driver"): [("driver_exists", ("user_id",)), ("no_address", ("address_id",)), ("no_user", ("user_id",))],
        ("restaurant", "address"): [],
        ("restaurant", "restaurant"): [("no_owner", ("owner_id",))],
    }


def test_a_fifth_entity_needs_its_declaration_only(spark, tmp_path):
    line = Entity("line", (Attr("menuitem_id", "long"), Attr("order_id", "long"), Attr("quantity", "long")), table="menuitem_order")
    (tmp_path / "l.csv").write_text("1,1,5\n1,1,6\n1,2,1\n9,2,1\n2,9,1\n2,2,1\n")
    held = spark.createDataFrame([(2, 2, 1), (2, 3, 1)], "menuitem_id long, order_id long, quantity long")
    tables = {"menuitem_order": held, "menuitem": spark.range(3), "order": spark.range(3)}
    job = ingest.ingest_entity(spark, str(tmp_path / "l.csv"), line, tables)
    assert {tuple(r) for r in job.outcome.collect()} == {("accepted", 2), ("duplicate_in_batch", 1), ("no_menuitem", 1), ("no_order", 1), ("menuitem_order_exists", 1)}
    root = str(tmp_path / "store")
    job.save(root)
    job.save(root)
    assert {tuple(r) for r in table(spark, root, "menuitem_order").collect()} == {(1, 1, 5), (1, 2, 1)}


def test_the_largest_key_is_read_from_footers(spark, tmp_path):
    root = str(tmp_path)
    assert tables_.max_key(spark, root, "order") is None
    spark.range(0).write.parquet(f"{root}/order.parquet")
    assert tables_.max_key(spark, root, "order") is None
    spark.range(500).repartition(3).withColumn("note", F.lit("x")).write.mode("append").parquet(f"{root}/order.parquet")
    assert tables_.max_key(spark, root, "order") == 499
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        plan = tables_.max_key_plan(spark, root, "order")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")
    assert "PushedAggregation: [MAX(id)]" in plan and "ReadSchema: struct<max(id):bigint>" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert "BatchScan" not in table(spark, root, "order")._jdf.queryExecution().executedPlan().toString()
