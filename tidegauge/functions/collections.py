"""Arrays, maps and JSON text (ARR-01..03, MAP-01..02, JSN-01..02)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .shipping import ship_by_value

ship_by_value(__name__)


def all_present(values: Column) -> Column:
    return F.forall(values, lambda v: v.isNotNull())


def missing_names(fields: dict[str, Column]) -> Column:
    """Names of the null fields, in the order given."""
    return F.array_compact(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in fields.items()]))


def counts_map(key: Column, n: Column) -> Column:
    """Aggregate: key-sorted map of counts. One entry per distinct key already counted."""
    pairs = F.array_sort(F.collect_list(F.struct(key.cast("string").alias("k"), n.alias("n"))))
    return F.map_from_entries(pairs)


def ordered_list(order: Column, value: Column) -> Column:
    """Aggregate: values in order. For groups whose length is bounded by the caller."""
    packed = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.transform(packed, lambda e: e["v"])


def parsed(text: Column) -> Column:
    """VARIANT of a JSON text, null where the text is no JSON."""
    return F.try_parse_json(text)


def at(v: Column, path: str, as_type: str = "string") -> Column:
    """Value at a dotted path, null where any step is absent."""
    return F.try_variant_get(v, f"$.{path}" if path else "$", as_type)


# Variant types that count as numbers.
NUMBER_TYPES = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")


def type_of(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID (JSON null) or a number type; null where the value is absent.

    Project it as a column of its own before comparing it several times.
    """
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def object_mark(v: Column, path: str = "") -> Column:
    """OBJECT, OTHER, or null where the value is absent. Reading an object as an empty struct tells it without a walk
    through its fields, which the type text of a large object needs."""
    return F.when(at(v, path, "struct<>").isNotNull(), "OBJECT").when(at(v, path, "variant").isNotNull(), "OTHER")


def json_fault(text: Column) -> Column:
    """Where a malformed JSON text breaks, as `line L, column C: reason`.

    Meant for the few rows that `parsed` turned into null; filter to those first.
    """

    @F.pandas_udf("string")
    def locate(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return "no text"
            try:
                json.loads(t)
            except json.JSONDecodeError as e:
                return f"line {e.lineno}, column {e.colno}: {e.msg}"
            return None

        return texts.map(one)

    return locate(text)
