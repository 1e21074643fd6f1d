"""Column builders that turn file text into typed values, defaults and masked renderings.

Every builder returns NULL for text it refuses; nothing here raises, so one bad value never stops
a job.  ANSI mode is on in Spark 4, hence ``try_cast`` and never a bare cast of file text.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.schema import SPARK_TYPES, Attr, Table

# The words accepted as true and as false, in any case.
TRUE_WORDS = ("y", "yes", "t", "true", "on", "1")
FALSE_WORDS = ("n", "no", "f", "false", "off", "0")

# How many characters each masked column keeps.
MASK_LENGTHS = {"id": 12, "password": 16}
SHORT_MASK_LENGTH = 2
MASK_TAIL = "..."

EMAIL_DOMAIN = "@mail.com"  # fixed value


def to_bool(c: Column) -> Column:
    word = F.lower(c)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def to_long(c: Column) -> Column:
    # The pattern keeps out "5.0" and "1_0"; try_cast then only has to catch overflow.
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c).try_cast("bigint"))


def to_int(c: Column) -> Column:
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c).try_cast("int"))


def to_double(c: Column) -> Column:
    # The pattern keeps out the Java suffixes ("1d") and the non-finite words.
    number = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
    return F.when(c.rlike(number), F.trim(c).try_cast("double"))


def hex_id(c: Column) -> Column:
    """Normalise an identifier: lower case, no hyphens, braces or URN prefix; not checked."""
    return F.regexp_replace(F.lower(c), r"^urn:uuid:|[{}\-]", "")


def uuid_hex(c: Column) -> Column:
    """Normalise a UUID to 32 lower-case hex digits, NULL when it is none."""
    plain = hex_id(c)
    return F.when(plain.rlike("^[0-9a-f]{32}$"), plain)


def uuid_text(c: Column) -> Column:
    """The hyphenated form of a 32-digit UUID."""
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(c, start, size) for start, size in cuts])


_CASTS = {
    "uuid": uuid_hex,
    "hex": hex_id,
    "string": lambda c: c,
    "long": to_long,
    "int": to_int,
    "double": to_double,
    "boolean": to_bool,
    "timestamp": lambda c: c.try_cast("timestamp"),
    "date": lambda c: c.try_cast("date"),
}


def cast_text(c: Column, kind: str) -> Column:
    return _CASTS[kind](c)


def first_failing(checks: Iterable[tuple[Column, object]]) -> Column:
    """The label of the first condition that holds, NULL when none does."""
    return F.coalesce(*[F.when(cond, F.lit(label)) for cond, label in checks], F.lit(None).cast("string"))


def missing_field(names: Iterable[str]) -> Column:
    """Name of the first required field that is absent (NULL), NULL when all are there."""
    return first_failing((F.col(n).isNull(), n) for n in names)


def fill_defaults(df: DataFrame, table: Table) -> DataFrame:
    """Replace NULL by the declared default, adding columns of the table that are not there."""

    def value(a: Attr) -> Column:
        given = F.col(a.name) if a.name in df.columns else None
        if a.default is None:
            return given if given is not None else F.lit(None).cast(SPARK_TYPES[a.kind])
        default = F.current_timestamp() if a.default == "now" else F.lit(a.default).cast(SPARK_TYPES[a.kind])
        return default if given is None else F.coalesce(given, default)

    return df.select(*[value(a).alias(a.name) for a in table.attrs])


def derived_email(first: Column, last: Column) -> Column:
    """``first.last@mail.com``; NULL when either name is."""
    return F.concat(first, F.lit("."), last, F.lit(EMAIL_DOMAIN))


def domain_violation(table: Table, columns: Iterable[str] | None = None) -> Column:
    """First broken column rule of the table: ``not_null:<col>`` or ``too_long:<col>``."""
    chosen = [table.attr(n) for n in columns] if columns is not None else table.attrs
    checks: list[tuple[Column, object]] = []
    for a in chosen:
        if a.required:
            checks.append((F.col(a.name).isNull(), f"not_null:{a.name}"))
        if a.max_len is not None:
            checks.append((F.length(a.name) > a.max_len, f"too_long:{a.name}"))
    return first_failing(checks)


def mask(c: Column, keep: int, always: bool = False) -> Column:
    """First ``keep`` characters and a tail; the tail only when something was cut, or always."""
    text = c.cast("string")
    cut = F.concat(F.substring(text, 1, keep), F.lit(MASK_TAIL))
    return cut if always else F.when(F.length(text) > keep, cut).otherwise(text)


def mask_display(df: DataFrame) -> DataFrame:
    """Long identifiers and passwords cut for display, every other column as it is."""
    return df.select(
        *[mask(F.col(c), MASK_LENGTHS[c], always=True).alias(c) if c in MASK_LENGTHS else F.col(c) for c in df.columns]
    )


def mask_short(df: DataFrame, keep: int = SHORT_MASK_LENGTH) -> DataFrame:
    """Every column cut to its first characters."""
    return df.select(*[mask(F.col(c), keep).alias(c) for c in df.columns])


def file_text(c: Column, kind: str, null_text: str | None = "None") -> Column:
    """How a typed value is written in CSV and XML: True/False, hyphenated UUID, ``None`` for null."""
    if kind == "boolean":
        text = F.initcap(c.cast("string"))
    elif kind == "uuid":
        text = F.when(c.isNotNull(), uuid_text(c))
    else:
        text = c.cast("string")
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
