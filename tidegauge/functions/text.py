"""String columns (STR-01..11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted e-mail shape and the white space a trim removes.
EMAIL_PATTERN = r"(?U)^[^@\s]+@[^@\s]+\.[^@\s]+\z"
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(c, F.lit(WHITE_SPACE))


def strip_lower(c: Column) -> Column:
    return F.lower(strip(c))


def is_email(c: Column) -> Column:
    return c.rlike(EMAIL_PATTERN)


def length_between(c: Column, low: int, high: int) -> Column:
    return F.char_length(c).between(low, high)


def is_server_error(status: Column) -> Column:
    return F.startswith(status, F.lit("5"))


def iso_hour(ts: Column) -> Column:
    """Hour digits of an ISO text timestamp."""
    return F.substring(ts, 12, 2)


def part_as_int(c: Column, delimiter: str, part: int) -> Column:
    """`fixed-10` -> 10; null where the part is no number."""
    return F.split_part(c, F.lit(delimiter), F.lit(part)).try_cast("int")


def dotted(parts: Column) -> Column:
    return F.array_join(parts, ".")


def elided(values: Column, arrow: str = "→", keep: int = 6, head: int = 3, tail: int = 2) -> Column:
    """Join a list; longer than `keep` shows the first three, an ellipsis, the last two."""
    texts = F.transform(values, lambda v: v.cast("string"))
    short = F.concat(F.slice(texts, 1, head), F.array(F.lit("…")), F.slice(texts, -tail, tail))
    return F.when(F.size(values) > keep, F.array_join(short, arrow)).otherwise(F.array_join(texts, arrow))


def short_label(c: Column, limit: int = 14, kept: int = 12) -> Column:
    return F.when(F.char_length(c) > limit, F.concat(F.left(c, F.lit(kept)), F.lit("…"))).otherwise(c)


def numbered(template: str, n: Column) -> Column:
    """`numbered("DLQ-%05d", n)`."""
    return F.format_string(template, n)


def thousands(c: Column, digits: int = 2) -> Column:
    return F.format_number(c, digits)


def percent(c: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", F.bround(c * 100, digits))


def signed(c: Column, digits: int = 2, suffix: str = "") -> Column:
    return F.format_string(f"%+.{digits}f{suffix}", F.bround(c, digits))
