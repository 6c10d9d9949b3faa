"""Scalar column functions used by the sources and the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier and bitmap size of the hashed visitor count.
HASH_MULTIPLIER = 61
BITMAP_BITS = 1 << 29


def epoch_seconds(col: Column | str) -> Column:
    return F.timestamp_seconds(F.col(col) if isinstance(col, str) else col)


def epoch_millis(col: Column | str) -> Column:
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def access_log_time(text: Column, lenient: bool = False) -> Column:
    """Zone-less timestamp of a web server log time such as ``17/05/2015:10:05:03``.

    Text that is no such time fails the job, or gives null if ``lenient``.
    """
    part = F.split(text, "[/:]")
    if lenient:
        numbers = [F.get(part, F.lit(i)).try_cast("int") for i in range(6)]
    else:
        numbers = [F.element_at(part, i + 1).cast("int") for i in range(6)]
    day, month, year, hour, minute, second = numbers
    make = F.try_make_timestamp_ntz if lenient else F.make_timestamp_ntz
    return make(year, month, day, hour, minute, second.cast("decimal(8,6)"))


def poly_hash(value: Column | str, multiplier: int = HASH_MULTIPLIER, bits: int = BITMAP_BITS) -> Column:
    """Polynomial string hash reduced to ``bits`` slots (a power of two).

    Reducing at every step equals reducing once at the end, because ``bits`` is
    a power of two, and it keeps the sum far from overflow.
    """
    if bits < 1 or bits & (bits - 1):
        raise ValueError("bits must be a power of two")
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    codes = F.transform(F.split(text, ""), F.ascii)
    mask = F.lit(bits - 1).cast("bigint")
    return F.aggregate(
        codes, F.lit(0).cast("bigint"), lambda acc, code: (acc * multiplier + code).bitwiseAND(mask)
    )


def choice(key: Column | str, options: list[str]) -> Column:
    """One of ``options``, picked by a hash of ``key``: repeatable, unlike a random draw."""
    col = F.col(key) if isinstance(key, str) else key
    return F.element_at(
        F.array(*[F.lit(o) for o in options]),
        (F.pmod(F.xxhash64(col), F.lit(len(options))) + 1).cast("int"),
    )


def message(template: str, *cols: Column | str) -> Column:
    return F.format_string(template, *cols)
