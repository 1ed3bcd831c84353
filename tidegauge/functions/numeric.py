"""Numeric and null columns (NUM-01..05, NUL-01..02, PRJ-06..07)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """One kind of missing: NaN becomes null."""
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Number or null, whatever the text holds."""
    return nan_to_null(c.try_cast("double"))


def text_to_number(c: Column) -> Column:
    """`to_number` of a text column (binary collation).

    A failed parse costs an exception per row, so words are not tried: a number starts with a digit, sign, point or blank, all of
    them below ":", or is spelled "inf".
    """
    may_parse = (c < ":") | c.startswith("i") | c.startswith("I")
    return nan_to_null(F.when(may_parse, c.try_cast("double")))


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, c)


def clip(c: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """Bound a value; null stays null (plain least/greatest would return the bound)."""
    out = c
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    return F.when(c.isNotNull(), out)


def rounded(c: Column, digits: int) -> Column:
    """`F.round` of a double, half up, without its decimal arithmetic where the result is plain.

    For a positive value below 1e14 units of the last digit, 0.1 units or more away from a tie, the nearest number of units is certain,
    and its division by a power of ten is the correctly rounded result. All others take `F.round`.
    """
    unit = float(10**digits)
    scaled = c * unit
    plain = (c > 0) & (c < 1e14 / unit) & (F.abs(scaled - F.rint(scaled)) < 0.4)
    return F.when(plain, F.rint(scaled) / unit).otherwise(F.round(c, digits))


def half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def fill(c: Column, *fallbacks: Column | str | float) -> Column:
    return F.coalesce(c, *[f if isinstance(f, Column) else F.lit(f) for f in fallbacks])


def masked(mask: Column, replacement: Column, original: Column) -> Column:
    """Replace where the mask holds; an unknown mask keeps the original."""
    return F.when(mask, replacement).otherwise(original)


def scaled_with_cap(c: Column, factor: float, cap: float) -> Column:
    return clip(c * factor, high=cap)


def hash_text(seed: int, *keys: Column) -> Column:
    """32 hex digits that depend only on the seed and the keys, the same on any engine and in any run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def unit_value(seed: int, *keys: Column) -> Column:
    """Repeatable value in [0, 1) with 52 random bits."""
    return F.conv(F.substring(hash_text(seed, *keys), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def jittered(base: Column, ratio: float, seed: int, *keys: Column) -> Column:
    """base * (1 + u), u repeatable and uniform in [-ratio, ratio)."""
    return base * (1 + (unit_value(seed, *keys) * 2 - 1) * ratio)
