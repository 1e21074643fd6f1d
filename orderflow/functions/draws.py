"""Reproducible random draws as column expressions.

A draw is a function of (seed, purpose, row id) through a digest, so it is the same under task
retries, speculative execution and any repartitioning, which ``rand()`` and ``uuid()`` are not.
One SHA-256 feeds a whole string instead of one hash per character: 15 hex digits make a 60-bit
number, whose digits in base n are draws below n.  Everything is built from ordinary expressions,
with no lambda, so that it stays in generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alphabets, e-mail parts and lengths of generated values.
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
SYMBOLS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ACCOUNT_CHARS = LOWER + DIGITS
PASSWORD_CHARS = LOWER + UPPER + DIGITS + SYMBOLS
EMAIL_EXTENSIONS = ("com", "net", "org", "gov")
EMAIL_DOMAINS = ("gmail", "yahoo", "comcast", "verizon", "hotmail")
EMAIL_MIN, EMAIL_MAX = 4, 12
PASSWORD_LENGTH = 12

_TAGS = 16  # four-digit tags in one SHA-256
_NUMBERS = 4  # 15-digit numbers in one SHA-256
_DRAW_BITS = 52  # bits of a number used for draws; the rest keep the bias below 1/256


def _key(seed: int, purpose: str, row_id: Column) -> Column:
    return F.concat(F.lit(f"{seed}:{purpose}:"), row_id.cast("string"))


def pick(seed: int, purpose: str, row_id: Column) -> Column:
    """Uniform integer in [0, 2^60)."""
    return F.conv(F.substring(F.md5(_key(seed, purpose, row_id)), 1, 15), 16, 10).cast("long")


def pick_below(seed: int, purpose: str, row_id: Column, n: int | Column) -> Column:
    return pick(seed, purpose, row_id) % n


def uniform(seed: int, purpose: str, row_id: Column, high: float = 1.0) -> Column:
    """Uniform real in [0, high)."""
    exact = 1 << _DRAW_BITS  # a double holds these bits, so the quotient stays below 1
    return pick(seed, purpose, row_id) % exact / F.lit(float(exact)) * F.lit(float(high))


def _digest(seed: int, purpose: str, row_id: Column, blocks: int) -> Column:
    return F.concat(*[F.sha2(_key(seed, f"{purpose}/{b}", row_id), 256) for b in range(blocks)])


def draws_per_number(n: int) -> int:
    return int(_DRAW_BITS / math.log2(n))


def _blocks(n: int, count: int) -> int:
    """Digests needed for ``count`` draws below ``n``."""
    return -(-count // (_NUMBERS * draws_per_number(n)))


def _draw(digest: Column, j: int, n: int) -> Column:
    """The ``j``-th draw below ``n``: a base-n digit of one of the digest's numbers."""
    per = draws_per_number(n)
    block, which = divmod(j // per, _NUMBERS)
    number = F.conv(F.substring(digest, 64 * block + 15 * which + 1, 15), 16, 10).cast("long")
    return (F.call_function("div", number, F.lit(n ** (j % per))) % n).cast("int")


def _char(alphabet: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), at + 1, F.lit(1))


def repeated_chars(seed: int, purpose: str, row_id: Column, alphabet: str, size: int) -> Column:
    """``size`` characters drawn with replacement."""
    d = _digest(seed, purpose, row_id, _blocks(len(alphabet), size))
    return F.concat(*[_char(alphabet, _draw(d, j, len(alphabet))) for j in range(size)])


def sparse(alphabet: str, size: int) -> bool:
    """Whether few of the characters are wanted, so that repeated draws soon give enough."""
    return 4 * size <= len(alphabet)


def sparse_draws(size: int) -> int:
    return 2 * size + 4


def distinct_chars(seed: int, purpose: str, row_id: Column, alphabet: str, size: int) -> Column:
    """``size`` different characters of the alphabet, in random order."""
    n = len(alphabet)
    if size > n:
        raise ValueError("cannot draw more distinct characters than there are")
    if sparse(alphabet, size):
        # Draw with replacement and keep first occurrences.  Should they not suffice, which is all
        # but impossible, the alphabet itself makes up the rest.
        count = sparse_draws(size)
        d = _digest(seed, purpose, row_id, _blocks(n, count))
        drawn = F.array(*[_char(alphabet, _draw(d, j, n)) for j in range(count)])
        first = F.array_distinct(drawn)
        whole = F.array_distinct(F.concat(drawn, F.array(*map(F.lit, alphabet))))
        return F.array_join(F.slice(F.when(F.size(first) >= size, first).otherwise(whole), 1, size), "")
    # The alphabet ordered by a tag per character, cut to size.
    d = _digest(seed, purpose, row_id, -(-n // _TAGS))
    tagged = F.array(*[F.concat(F.substring(d, 4 * i + 1, 4), F.lit(ch)) for i, ch in enumerate(alphabet)])
    chosen = F.array_join(F.slice(F.sort_array(tagged), 1, size), "")
    return F.regexp_replace(chosen, "....(.)", "$1")  # drop the four tag digits of each


def uuid4_hex(seed: int, purpose: str, row_id: Column) -> Column:
    """32 hex digits with the version and variant digits of a random UUID."""
    h = F.md5(_key(seed, purpose, row_id))
    variant = F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4
    return F.concat(
        F.substring(h, 1, 12),
        F.lit("4"),
        F.substring(h, 14, 3),
        F.substring(F.lit("89ab"), variant + 1, F.lit(1)),
        F.substring(h, 18, 15),
    )


def email(seed: int, row_id: Column) -> Column:
    """account@domain.ext with an account of 4 to 12 characters."""
    account = repeated_chars(seed, "account", row_id, ACCOUNT_CHARS, EMAIL_MAX)
    d = _digest(seed, "email", row_id, 1)
    size = _draw(d, 0, EMAIL_MAX - EMAIL_MIN + 1) + EMAIL_MIN
    # A fresh number for each draw of another base.
    domain = _draw(d, draws_per_number(len(EMAIL_DOMAINS)), len(EMAIL_DOMAINS))
    ext = _draw(d, 2 * draws_per_number(len(EMAIL_EXTENSIONS)), len(EMAIL_EXTENSIONS))
    return F.concat(
        F.substring(account, F.lit(1), size),
        F.lit("@"),
        F.element_at(F.array(*map(F.lit, EMAIL_DOMAINS)), domain + 1),
        F.lit("."),
        F.element_at(F.array(*map(F.lit, EMAIL_EXTENSIONS)), ext + 1),
    )


def phone_bracketed(seed: int, row_id: Column) -> Column:
    """``(ddd) ddd-dddd``; the digits of one group differ."""
    groups = [distinct_chars(seed, f"phone{i}", row_id, DIGITS, size) for i, size in enumerate((3, 3, 4))]
    return F.concat(F.lit("("), groups[0], F.lit(") "), groups[1], F.lit("-"), groups[2])


def phone_dashed(seed: int, row_id: Column) -> Column:
    """``ddd-ddd-dddd`` of the digits 1 to 9."""
    d = repeated_chars(seed, "phone", row_id, DIGITS[1:], 10)
    return F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4))


def password_digest(seed: int, row_id: Column) -> Column:
    """Salted SHA-256 of a random password; the password itself never becomes a column.

    This is a stand-in for a slow password hash, not a replacement of one.
    """
    password = distinct_chars(seed, "password", row_id, PASSWORD_CHARS, PASSWORD_LENGTH)
    salt = F.substring(F.md5(_key(seed, "salt", row_id)), 1, 16)
    return F.concat(salt, F.lit("$"), F.sha2(F.concat(salt, password), 256))


def confirmation_code(seed: int, row_id: Column) -> Column:
    """Ten hex digits."""
    return F.substring(F.md5(_key(seed, "confirmation", row_id)), 1, 10)
