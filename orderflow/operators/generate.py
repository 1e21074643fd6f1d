"""Synthetic, referentially valid rows, as column expressions.

Every generator takes ``rows``, a frame with a dense 0-based long column ``i`` (``row_numbers`` or
``dense_index`` makes one), and a seed.  A row depends on (seed, i) alone, so parents and children
of one set are linked by arithmetic on ``i`` and need no join; only picks from *given* parents do.
Table names used as purposes keep the draws of different tables apart.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.errors import IngestError
from orderflow.functions import draws
from orderflow.functions.casts import derived_email
from orderflow.operators.keys import pick_parent
from orderflow.operators.relational import first_empty
from orderflow.schema import ROLE_ADMIN, ROLE_CUSTOMER, ROLE_DRIVER, ROLE_EMPLOYEE

# Lengths and constants of generated columns.
LINE_LENGTH, CITY_LENGTH, STATE_LENGTH, ZIP_LENGTH = 20, 10, 2, 5
NAME_LENGTH, RESTAURANT_NAME_LENGTH = 10, 24
LICENCE_TAIL_LENGTH = 7
LICENCE_LOW, LICENCE_COUNT = 10000, 90000
PRICE_CATEGORIES = 3
MAX_RATING = 5.0
STATUS_ACTIVE, STATUS_WAITING = "ACTIVE", "waiting"
DOB_FORMAT = "dd/MM/yyyy"

TASK_ROWS = 25_000  # rows that a task makes, of a table

def _i() -> Column:
    return F.col("i")


def row_numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("i"))


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` over as many tasks as there is work for: numbers are few bytes, by which Spark deals out
    a scan, but what is made of each takes long."""
    return rows.repartition(max(1, -(-rows.count() // TASK_ROWS)))


def user_id(seed: int, kind: str, i: Column | None = None) -> Column:
    return draws.uuid4_hex(seed, f"user-{kind}", _i() if i is None else i)


def users(rows: DataFrame, seed: int, role: str | Column, kind: str = "any") -> DataFrame:
    """Users with all five flags set; ``kind`` separates sets made with the same seed."""
    key = F.concat(F.lit(f"{kind}-"), _i().cast("string"))
    flags = ("enabled", "confirmed", "account_non_expired", "account_non_locked", "credentials_non_expired")
    return rows.select(
        user_id(seed, kind).alias("id"),
        (F.lit(role) if isinstance(role, str) else role).alias("user_role"),
        draws.password_digest(seed, key).alias("password"),
        draws.email(seed, key).alias("email"),
        *[F.lit(True).alias(f) for f in flags],
    )


def users_by_role(rows: DataFrame, seed: int, customers: int, admins: int, employees: int, drivers: int) -> DataFrame:
    """The first ``customers`` rows are customers, the next ``admins`` are admins, and so on."""
    total = customers + admins + employees + drivers
    role = (
        F.when(_i() < customers, ROLE_CUSTOMER)
        .when(_i() < customers + admins, ROLE_ADMIN)
        .when(_i() < customers + admins + employees, ROLE_EMPLOYEE)
        .otherwise(ROLE_DRIVER)
    )
    return users(rows.filter(_i() < total), seed, role)


def _letters(seed: int, purpose: str, size: int, alphabet: str = draws.LOWER) -> Column:
    return draws.distinct_chars(seed, purpose, _i(), alphabet, size)


def addresses(rows: DataFrame, seed: int, after: int, kind: str = "any") -> DataFrame:
    """Addresses with ids ``after + 1``, ``after + 2``, ..."""
    return rows.select(
        (_i() + after + 1).alias("id"),
        _letters(seed, f"{kind}-line1", LINE_LENGTH).alias("line1"),
        _letters(seed, f"{kind}-city", CITY_LENGTH).alias("city"),
        _letters(seed, f"{kind}-state", STATE_LENGTH, draws.UPPER).alias("state"),
        _letters(seed, f"{kind}-zip", ZIP_LENGTH, draws.DIGITS).alias("zip"),
    )


def customers_with_users(rows: DataFrame, seed: int) -> dict[str, DataFrame]:
    customers = rows.select(
        user_id(seed, "customer").alias("id"),
        _letters(seed, "customer-first", NAME_LENGTH).alias("first_name"),
        _letters(seed, "customer-last", NAME_LENGTH).alias("last_name"),
        draws.phone_bracketed(seed, _i()).alias("phone"),
    )
    return {"user": users(rows, seed, ROLE_CUSTOMER, "customer"), "customer": customers}


def restaurants_with_parents(rows: DataFrame, seed: int, after_address: int, after_restaurant: int) -> dict[str, DataFrame]:
    """Per row one address, one owner user, one owner and one restaurant, paired by position."""
    owner = user_id(seed, "owner")
    return {
        "address": addresses(rows, seed, after_address, "restaurant"),
        "user": users(rows, seed, ROLE_EMPLOYEE, "owner"),
        "owner": rows.select(owner.alias("id")),
        "restaurant": rows.select(
            (_i() + after_restaurant + 1).alias("id"),
            (_i() + after_address + 1).alias("address_id"),
            owner.alias("owner_id"),
            _letters(seed, "restaurant-name", RESTAURANT_NAME_LENGTH).alias("name"),
            F.lit(MAX_RATING).alias("rating"),
        ),
    }


def drivers_with_parents(rows: DataFrame, seed: int, after_address: int, n: int) -> dict[str, DataFrame]:
    """Per row one driver user, one address and one driver, whose address is picked among the new ones."""
    licence = F.concat(
        _letters(seed, "licence-head", 1, draws.UPPER), _letters(seed, "licence-tail", LICENCE_TAIL_LENGTH)
    )
    return {
        "user": users(rows, seed, ROLE_DRIVER, "driver"),
        "address": addresses(rows, seed, after_address, "driver"),
        "driver": rows.select(
            user_id(seed, "driver").alias("id"),
            (draws.pick_below(seed, "driver-address", _i(), n) + after_address + 1).alias("address_id"),
            _letters(seed, "driver-first", NAME_LENGTH).alias("first_name"),
            _letters(seed, "driver-last", NAME_LENGTH).alias("last_name"),
            draws.phone_bracketed(seed, _i()).alias("phone"),
            licence.alias("license_num"),
            F.lit(STATUS_ACTIVE).alias("status"),
        ),
    }


def deliveries_with_parents(rows: DataFrame, seed: int, after_address: int, after_delivery: int, n: int) -> dict[str, DataFrame]:
    """Drivers as above, as many further addresses, and deliveries that pick among both."""
    made = drivers_with_parents(rows, seed, after_address, n)
    own = addresses(rows, seed, after_address + n, "delivery")
    # A picked driver is the driver of a picked row number, so its id is computed, not joined.
    picked = draws.pick_below(seed, "delivery-driver", _i(), n)
    made["address"] = made["address"].unionByName(own)
    made["delivery"] = rows.select(
        (_i() + after_delivery + 1).alias("id"),
        (draws.pick_below(seed, "delivery-address", _i(), n) + after_address + n + 1).alias("address_id"),
        user_id(seed, "driver", picked).alias("driver_id"),
    )
    return made


def dependency_set(
    customers: DataFrame, restaurants: DataFrame, deliveries: DataFrame, seed: int, n_restaurants: int, n_deliveries: int, after: dict[str, int]
) -> dict[str, DataFrame]:
    """Everything orders refer to: each argument frame carries ``i`` and asks for one set per row.

    ``after`` holds the largest key in use of address, restaurant and delivery.
    """
    made = [
        customers_with_users(customers, seed),
        restaurants_with_parents(restaurants, seed, after["address"], after["restaurant"]),
        deliveries_with_parents(deliveries, seed, after["address"] + n_restaurants, after["delivery"], n_deliveries),
    ]
    names = dict.fromkeys(name for part in made for name in part)
    return {name: reduce(DataFrame.unionByName, [part[name] for part in made if name in part]) for name in names}


def orders(rows: DataFrame, seed: int, customers: DataFrame, restaurants: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Orders without id that refer to picked customers, restaurants and deliveries.

    Keeps ``i``, the batch order that keys are assigned in.
    """
    empty = first_empty({"customer": customers, "delivery": deliveries, "restaurant": restaurants})
    if empty:
        raise IngestError("no_parents", empty)
    picked = rows.select("i")
    for parents, name in ((customers, "customer_id"), (restaurants, "restaurant_id"), (deliveries, "delivery_id")):
        picked = pick_parent(picked, parents, "id", name, seed, "i")
    return picked.select(
        "i",
        F.lit(None).cast("long").alias("id"),
        "customer_id",
        "restaurant_id",
        "delivery_id",
        draws.confirmation_code(seed, _i()).alias("confirmation_code"),
    )


def drivers_from_seed(
    rows: DataFrame, seed: int, addresses: DataFrame, first_names: DataFrame, last_names: DataFrame, run_date: dt.date | None = None
) -> DataFrame:
    """Drivers for given users: ``rows`` has ``i`` and the user's ``id``; names come from seed lists.

    One driver per user; drawing users with replacement would only break the key.
    """
    empty = first_empty({"user": rows, "address": addresses})
    if empty:
        raise IngestError("no_parents", empty)
    picked = pick_parent(rows.select("i", "id"), addresses, "id", "address_id", seed, "i")
    picked = pick_parent(picked, first_names, "name", "first_name", seed, "i")
    picked = pick_parent(picked, last_names, "name", "last_name", seed, "i")
    return picked.select(
        "id",
        "address_id",
        "first_name",
        "last_name",
        derived_email(F.col("first_name"), F.col("last_name")).alias("email"),
        draws.phone_dashed(seed, _i()).alias("phone"),
        F.date_format(F.lit(run_date or dt.date.today()), DOB_FORMAT).alias("dob"),
        (draws.pick_below(seed, "licence", _i(), LICENCE_COUNT) + LICENCE_LOW).cast("string").alias("license_num"),
        F.round(draws.uniform(seed, "rating", _i(), MAX_RATING), 6).alias("rating"),
        F.lit(STATUS_WAITING).alias("status"),
    )


def restaurants_from_seed(
    rows: DataFrame, seed: int, places: DataFrame, names: DataFrame, owners: DataFrame, after_address: int, after_restaurant: int
) -> dict[str, DataFrame]:
    """Restaurants at seed places (``place_id``, address, city, state, zip) with seed names and
    picked owners, and one new address row for each."""
    if owners.isEmpty():
        raise IngestError("no_parents", "owner")
    picked = pick_parent(rows.select("i"), places, "place_id", "place_id", seed, "i", ["address", "city", "state", "zip"])
    picked = pick_parent(picked, names, "name", "name", seed, "i")
    picked = pick_parent(picked, owners, "id", "owner_id", seed, "i")
    return {
        "address": picked.select(
            (_i() + after_address + 1).alias("id"), F.col("address").alias("line1"), F.lit("").alias("line2"), "city", "state", "zip"
        ),
        "restaurant": picked.select(
            (_i() + after_restaurant + 1).alias("id"),
            (_i() + after_address + 1).alias("address_id"),
            "owner_id",
            "name",
            F.round(draws.uniform(seed, "rating", _i(), MAX_RATING), 6).alias("rating"),
            (draws.pick_below(seed, "price", _i(), PRICE_CATEGORIES) + 1).cast("int").alias("price_category"),
            draws.phone_dashed(seed, _i()).alias("phone"),
            (draws.pick_below(seed, "active", _i(), 2) == 0).alias("is_active"),
        ),
    }
