"""Dates (DT-01..03)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts accepted by `mixed_timestamp`, each with the shape of its text.
MIXED_LAYOUTS = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}\z",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z",
    "yyyy-MM-dd'T'HH:mm:ss": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\z",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}\z",
    "MM/dd/yyyy": r"^\d{2}/\d{2}/\d{4}\z",
    "yyyyMMdd": r"^\d{8}\z",
}


_MIXED_SHAPE = "|".join(MIXED_LAYOUTS.values())


def _as_iso(c: Column) -> Column:
    """ISO text of a text in one of `MIXED_LAYOUTS`."""
    us = F.concat_ws("-", F.substring(c, 7, 4), F.substring(c, 1, 2), F.substring(c, 4, 2))
    plain = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return (
        F.when(F.octet_length(c) == 8, plain)
        .when(F.substring(c, 3, 1) == "/", us)
        .otherwise(F.replace(c, F.lit("/"), F.lit("-")))
    )


def mixed_timestamp(c: Column, layouts: dict[str, str] = MIXED_LAYOUTS) -> Column:
    """Timestamp under the layout whose shape fits; null where none does.

    The shape is tested first: a parse that fails costs an exception per row. The usual layouts are tested at once and cast from
    ISO text, which takes a fraction of a pattern's time; others are tried one by one.
    """
    if layouts == MIXED_LAYOUTS:
        return F.when(c.rlike(_MIXED_SHAPE), _as_iso(c).try_cast("timestamp"))
    out = F.lit(None).cast("timestamp")
    for layout, shape in reversed(layouts.items()):
        out = F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(layout))).otherwise(out)
    return out


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us.cast("bigint"))


def iso_date(c: Column) -> Column:
    """Date from strict `yyyy-MM-dd` text, else null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}\z"), c.try_cast("date"))
