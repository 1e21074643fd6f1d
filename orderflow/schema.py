"""Declared schemas: the nineteen tables and the entities that arrive as files.

Spark enforces neither keys nor references, so they are declared here as data and checked by
``orderflow.operators.rules``.  Identifiers that are 16-byte binaries in the relational schema are
kept as 32 lower-case hex digits; ``unhex`` belongs at a JDBC sink only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# Spark type of each declared kind. "uuid" is written with hyphens in files, "hex" without.
SPARK_TYPES = {
    "uuid": T.StringType(),
    "hex": T.StringType(),
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class Attr:
    """One column: its kind, whether null is allowed, its text length limit and its default."""

    name: str
    kind: str = "string"
    required: bool = True
    max_len: int | None = None
    default: object = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    cascade: bool = False
    parent_column: str = "id"


@dataclass(frozen=True)
class Table:
    name: str
    attrs: tuple[Attr, ...]
    primary_key: tuple[str, ...] = ("id",)
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [a.name for a in self.attrs]

    def attr(self, name: str) -> Attr:
        return next(a for a in self.attrs if a.name == name)

    def struct(self) -> T.StructType:
        # Nullable throughout: nullability is a checked rule here, not a promise to the optimizer.
        return T.StructType([T.StructField(a.name, SPARK_TYPES[a.kind], True) for a in self.attrs])


def _text(name: str, required: bool = True, max_len: int = 255, default: object = None) -> Attr:
    return Attr(name, "string", required, max_len, default)


def _bridge(name: str, left: str, left_kind: str, right: str, *extra: Attr) -> Table:
    left_col, right_col = f"{left}_id", f"{right}_id"
    return Table(
        name,
        (Attr(left_col, left_kind), Attr(right_col, "long"), *extra),
        primary_key=(left_col, right_col),
        foreign_keys=(ForeignKey(left_col, left), ForeignKey(right_col, right)),
    )


def _lookup(name: str) -> Table:
    return Table(name, (Attr("id", "long"), _text("type")))


def _person(name: str) -> Table:
    return Table(
        name,
        (
            Attr("id", "hex"),
            _text("first_name", False),
            _text("last_name", False),
            _text("phone", False),
            _text("email", False),
        ),
        foreign_keys=(ForeignKey("id", "user"),),
    )


# Table, column, key, length and default declarations of the relational schema.
_TABLES = (
    Table(
        "user",
        (
            Attr("id", "uuid"),
            _text("user_role"),
            _text("password"),
            _text("email"),
            Attr("created_at", "timestamp", default="now"),
            Attr("updated_at", "timestamp", default="now"),
            Attr("enabled", "boolean", default=True),
            Attr("confirmed", "boolean", default=True),
            Attr("account_non_expired", "boolean", default=True),
            Attr("account_non_locked", "boolean", default=True),
            Attr("credentials_non_expired", "boolean", default=True),
        ),
        unique=("email",),
    ),
    Table(
        "address",
        (
            Attr("id", "long"),
            _text("line1"),
            _text("line2", False),
            _text("city"),
            _text("state", max_len=2),
            _text("zip", max_len=10),
        ),
    ),
    _person("owner"),
    Table(
        "restaurant",
        (
            Attr("id", "long"),
            Attr("address_id", "long"),
            Attr("owner_id", "hex"),
            _text("name"),
            Attr("rating", "double", default=0.0),
            _text("price_category", False, 3),
            _text("phone", False),
            Attr("is_active", "boolean", False),
            _text("picture", False),
        ),
        foreign_keys=(ForeignKey("address_id", "address", cascade=True), ForeignKey("owner_id", "owner")),
    ),
    _lookup("cuisine"),
    Table(
        "menuitem",
        (
            Attr("id", "long"),
            Attr("restaurant_id", "long"),
            _text("name"),
            Attr("price", "double"),
            _text("picture", False),
            _text("description", False),
            Attr("is_available", "boolean", default=False),
            _text("size", False),
            Attr("discount", "double", False),
        ),
        foreign_keys=(ForeignKey("restaurant_id", "restaurant"),),
    ),
    _lookup("category"),
    Table(
        "driver",
        (
            Attr("id", "hex"),
            Attr("address_id", "long"),
            _text("first_name"),
            _text("last_name"),
            _text("phone"),
            _text("dob", False),
            _text("license_num"),
            Attr("rating", "double", False),
            _text("picture", False),
            _text("status"),
            _text("email", False),
        ),
        foreign_keys=(ForeignKey("address_id", "address"), ForeignKey("id", "user")),
    ),
    Table(
        "delivery",
        (
            Attr("id", "long"),
            Attr("address_id", "long"),
            Attr("driver_id", "hex"),
            Attr("estimated_delivery_time", "timestamp", False),
            _text("delivery_status", False),
            Attr("actual_delivery_time", "timestamp", False),
        ),
        foreign_keys=(ForeignKey("address_id", "address"), ForeignKey("driver_id", "driver")),
    ),
    Table(
        "customer",
        (
            Attr("id", "hex"),
            _text("first_name"),
            _text("last_name"),
            _text("phone"),
            Attr("dob", "date", False),
            Attr("loyalty_points", "int", default=0),
            _text("picture", False),
            Attr("veteranary_status", "boolean", False),
            _text("email", False),
        ),
        foreign_keys=(ForeignKey("id", "user"),),
    ),
    Table(
        "order",
        (
            Attr("id", "long"),
            Attr("customer_id", "hex"),
            Attr("restaurant_id", "long"),
            Attr("delivery_id", "long"),
            _text("confirmation_code", False),
            Attr("requested_delivery_time", "timestamp", False),
            Attr("order_discount", "double", False),
            Attr("submited_at", "timestamp", False),
            _text("preparation_status", False),
        ),
        # Checked in this order; the first missing parent is the reason.
        foreign_keys=(
            ForeignKey("customer_id", "customer"),
            ForeignKey("restaurant_id", "restaurant"),
            ForeignKey("delivery_id", "delivery"),
        ),
    ),
    _lookup("tag"),
    Table(
        "payment",
        (
            Attr("id", "long"),
            Attr("customer_id", "hex"),
            _text("name"),
            _text("stripe_id", False),
            Attr("refunded", "boolean", False),
            _text("payment_status", False),
        ),
        foreign_keys=(ForeignKey("customer_id", "customer"),),
    ),
    _bridge("customer_address", "customer", "hex", "address"),
    _person("admin"),
    _bridge("menuitem_tag", "menuitem", "long", "tag"),
    _bridge("menuitem_category", "menuitem", "long", "category"),
    _bridge("menuitem_order", "menuitem", "long", "order", Attr("quantity", "long", default=1)),
    _bridge("restaurant_cuisine", "restaurant", "long", "cuisine"),
)

TABLES: dict[str, Table] = {t.name: t for t in _TABLES}

# Fixed value: children come before their parents when every table is emptied.
DELETE_ORDER = ("order", "restaurant", "owner", "delivery", "driver", "customer", "address", "user")

# The user roles.
ROLE_CUSTOMER = "ROLE_CUSTOMER"
ROLE_ADMIN = "ROLE_ADMIN"
ROLE_EMPLOYEE = "ROLE_EMPLOYEE"
ROLE_DRIVER = "ROLE_DRIVER"


@dataclass(frozen=True)
class Target:
    """A table that an entity's rows go to.

    ``columns`` names the file's column for those of the table that are called otherwise, ``fixed`` has
    values stored whatever the file says, ``made`` names keys that are assigned when rows are saved.
    """

    table: str
    columns: dict[str, str] = field(default_factory=dict)
    fixed: dict[str, object] = field(default_factory=dict)
    made: tuple[str, ...] = ()


@dataclass(frozen=True)
class Entity:
    """An entity as it arrives in a file: field names in file order and the kind each is cast to.

    ``targets`` are the tables its rows go to, parents first; with none, ``table`` alone.  ``derive`` is
    the extension point: extra columns added after typing, as a plain ``DataFrame -> DataFrame``
    function.
    """

    name: str
    fields: tuple[Attr, ...]
    table: str | None = None
    targets: tuple[Target, ...] = field(default=(), compare=False)
    derive: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)
    casts: dict[str, Callable[[Column], Column]] = field(default_factory=dict, compare=False)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def root_tag(self) -> str:
        return f"{self.name}s"


# File layouts (field order and kind) of the four ingested entities.
USER = Entity(
    "user",
    (
        Attr("id", "uuid"),
        Attr("user_role"),
        Attr("password"),
        Attr("email"),
        Attr("enabled", "boolean"),
        Attr("confirmed", "boolean"),
        Attr("account_non_expired", "boolean"),
        Attr("account_non_locked", "boolean"),
        Attr("credentials_non_expired", "boolean"),
    ),
    table="user",
)
ORDER = Entity(
    "order",
    (
        Attr("id", "long"),
        Attr("customer_id", "hex"),
        Attr("restaurant_id", "long"),
        Attr("delivery_id", "long"),
        Attr("confirmation_code"),
    ),
    table="order",
)
DRIVER = Entity(
    "driver",
    (
        Attr("user_id", "hex"),
        Attr("address_id", "long"),
        Attr("first_name"),
        Attr("last_name"),
        Attr("phone"),
        Attr("dob"),
        Attr("license_num"),
        Attr("rating", "double"),
        Attr("status"),
    ),
    table="driver",
    # Picture and status stored with every driver.
    targets=(Target("driver", {"id": "user_id"}, {"picture": "https://temp.url/", "status": "active"}),),
)
RESTAURANT = Entity(
    "restaurant",
    (
        Attr("street"),
        Attr("city"),
        Attr("state"),
        Attr("zip"),
        Attr("owner_id", "hex"),
        Attr("name"),
        Attr("rating", "double"),
        Attr("price_category", "int"),
        Attr("phone"),
        Attr("is_active", "int"),
        Attr("picture"),
    ),
    table="restaurant",
    targets=(
        Target("address", {"line1": "street"}, {"line2": ""}, made=("id",)),
        Target("restaurant", made=("id", "address_id")),
    ),
)
