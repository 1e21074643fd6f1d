"""Every registered query against its SQL at the smallest scale."""

import pytest

from orderflow.catalog import ORACLES, QUERIES
from tests.compare import difference, oracle

SF = "/root/testdata/sf0.001"

# At the smallest scale these have nothing to return.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    problem = difference(QUERIES[name](spark, SF), con, ORACLES[name])
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY)


SEEN = {
    "ingest_users": {"accepted", "user_exists", "email_exists"},
    "save_outcome": {"accepted", "user_exists", "email_exists", "duplicate_in_batch"},
    "ingest_drivers": {"accepted", "driver_exists", "duplicate_in_batch", "no_address", "missing_field", "bad_value"},
    "ingest_orders": {"accepted", "order_exists", "no_customer", "no_delivery", "duplicate_in_batch"},
}


@pytest.mark.parametrize("name", sorted(SEEN))
@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_every_outcome_occurs(spark, name, sf):
    assert SEEN[name] <= {r["outcome"] for r in QUERIES[name](spark, sf).collect()}


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_deletes_remove_parents_and_children_and_are_blocked(spark, sf):
    left = {r["table_name"]: r["count"] for r in QUERIES["cascade_delete"](spark, sf).groupBy("table_name").count().collect()}
    assert left["address"] < spark.read.parquet(f"{sf}/customer.parquet").count()
    assert left["restaurant"] < spark.read.parquet(f"{sf}/orders.parquet").count()
    assert not QUERIES["blocked_delete"](spark, sf).isEmpty()
    assert all(r["stored"] > r["remaining"] for r in QUERIES["delete_all"](spark, sf).collect())


def test_entry(spark):
    import __spark_entry__ as entry

    outcomes = {r["outcome"]: r["n"] for r in entry.entry(spark).collect()}
    assert {"accepted", "order_exists", "no_customer", "no_delivery", "duplicate_in_batch"} <= set(outcomes)
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
