"""Declarative row validation (VAL-01..12).

A list of `Field`s adds two columns to a frame with a VARIANT record: `errors`, an array with every error of the row, and
`clean`, the coerced and normalised struct. The type of a value is read from the variant itself, so `"7"` and `7` stay
different until the coercion table of the declared kind is applied.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.collections import NUMBER_TYPES, at, object_mark, type_of
from ..functions.text import strip

ERROR = "struct<loc:string,type:string,msg:string,input:string>"

# Texts that count as true and false.
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")

# Shapes of a day and of a moment in text.
DAY = r"^\d{4}-\d{2}-\d{2}\z"
MOMENT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?\z"
ZONE = r"(Z|[+-]\d{2}:?\d{2})\z"

# Message per error code.
MESSAGES = {
    "missing": "Field required",
    "model_type": "Input should be a valid object",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "bool_type": "Input should be a valid boolean",
    "bool_parsing": "Input should be a valid boolean, unable to interpret input",
    "date_type": "Input should be a valid date",
    "date_parsing": "Input should be a valid date, unable to read the text",
    "date_inexact": "Datetimes provided to dates should have zero time",
    "string_type": "Input should be a valid string",
    "list_type": "Input should be a valid list",
    "map_type": "Input should be a valid dictionary",
}


@dataclass(frozen=True)
class Field:
    """One leaf of the record: path, kind and rules."""

    path: str
    kind: str  # int, float, bool, date, str, list<str>, list<int>, map<int>
    required: bool = True
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    choices: tuple[str, ...] = ()
    strip: bool = False
    lower: bool = False
    min_stripped: int | None = None
    pattern: str | None = None
    pattern_message: str = "the text has the wrong form"
    element_ge: float | None = None
    name: str = ""

    @property
    def column(self) -> str:
        return self.name or self.path.replace(".", "_")


def _error(loc: str | Column, code: str | Column, value: Column, message: str | Column | None = None) -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        as_column(loc).alias("loc"),
        as_column(code).alias("type"),
        as_column(message if message is not None else MESSAGES[code]).alias("msg"),
        value.alias("input"),
    )


class _Leaf:
    """Names of the working columns of one field; each step below is a projection of its own.

    A value is read from the variant once and referred to by column afterwards. Written as one nested expression the same
    rules would repeat their inputs many times over.
    """

    def __init__(self, i: int, f: Field):
        self.f, self.family = f, f.kind.split("<")[0]
        self.type, self.text, self.number = (F.col(f"_{n}{i}") for n in ("type", "text", "number"))
        self.value, self.code, self.normal = (F.col(f"_{n}{i}") for n in ("value", "code", "normal"))
        self.extra = F.col(f"_extra{i}")
        self.names = {n: f"_{n}{i}" for n in ("type", "text", "number", "value", "code", "normal", "extra")}

    def read(self, record: Column) -> dict[str, Column]:
        v = at(record, self.f.path, "variant")
        out = {self.names["type"]: type_of(v), self.names["text"]: at(record, self.f.path, "string")}
        if self.family in ("int", "float", "bool", "date"):
            out[self.names["number"]] = at(record, self.f.path, "double")
        if self.family == "list":
            out[self.names["extra"]] = at(record, self.f.path, "array<variant>")
        if self.family == "map":
            out[self.names["extra"]] = at(record, self.f.path, "map<string,variant>")
        return out

    def is_number(self) -> Column:
        return self.type.isin(*NUMBER_TYPES)

    def coerce(self) -> Column:
        """Value under the lax coercion table of the kind; null where it does not fit."""
        text, number, type_ = self.text, self.number, self.type
        squeezed = strip(text)
        truth = F.when(text == "true", 1).when(text == "false", 0)
        if self.family == "int":
            whole = F.when(squeezed.rlike(r"^[+-]?\d+(\.0*)?\z"), F.regexp_replace(squeezed, r"\.0*\z", ""))
            return (
                F.when(type_ == "BOOLEAN", truth.cast("bigint"))
                .when(type_ == "STRING", whole.try_cast("bigint"))
                .when(self.is_number() & (number == F.floor(number)), number.try_cast("bigint"))
            )
        if self.family == "float":
            shape = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\z"
            spelled = F.regexp_replace(squeezed, r"(?i)^([+-]?)inf\z", "$1infinity")
            return (
                F.when(type_ == "BOOLEAN", truth.cast("double"))
                .when(type_ == "STRING", F.when(squeezed.rlike(shape), spelled.try_cast("double")))
                .when(self.is_number(), number)
            )
        if self.family == "bool":
            low = F.lower(text)
            return (
                F.when(type_ == "BOOLEAN", text == "true")
                .when((type_ == "STRING") & low.isin(*TRUE_TEXTS), True)
                .when((type_ == "STRING") & low.isin(*FALSE_TEXTS), False)
                .when(self.is_number() & number.isin(0.0, 1.0), number == 1.0)
            )
        if self.family == "date":
            moment = F.coalesce(
                F.when((type_ == "STRING") & text.rlike(MOMENT), F.regexp_replace(text, ZONE, "").try_cast("timestamp_ntz")),
                F.when(self.is_number(), F.timestamp_seconds(number).cast("timestamp_ntz")),
            )
            day = F.when((type_ == "STRING") & text.rlike(DAY), text.try_cast("date"))
            return F.coalesce(day, F.when(F.date_format(moment, "HH:mm:ss.SSSSSS") == "00:00:00.000000", moment.cast("date")))
        if self.family == "str":
            return F.when(type_ == "STRING", text)
        if self.family == "list":
            element = "string" if self.f.kind == "list<str>" else "bigint"
            return F.transform(self.extra, lambda e: F.try_variant_get(e, "$", element))
        if self.family == "map":
            return F.transform_values(self.extra, lambda k, e: F.try_variant_get(e, "$", "bigint"))
        raise ValueError(f"unknown kind: {self.f.kind}")

    def fault(self) -> Column:
        """Error code of a present value that does not fit its kind."""
        text, number = self.type == "STRING", self.is_number()
        if self.f.choices:
            return F.lit("literal_error")
        if self.family == "int":
            return F.when(text, "int_parsing").when(number, "int_from_float").otherwise("int_type")
        if self.family == "float":
            return F.when(text, "float_parsing").otherwise("float_type")
        if self.family == "bool":
            return F.when(text | (number & (self.number == F.floor(self.number))), "bool_parsing").otherwise("bool_type")
        if self.family == "date":
            # a real moment off midnight is inexact, any other text is no date
            moment = self.text.rlike(MOMENT) & F.regexp_replace(self.text, ZONE, "").try_cast("timestamp_ntz").isNotNull()
            return F.when(number | (text & moment), "date_inexact").when(text, "date_parsing").otherwise("date_type")
        return F.lit({"str": "string_type", "list": "list_type", "map": "map_type"}[self.family])

    def normalise(self) -> Column:
        c = self.value
        if self.f.strip:
            c = strip(c)
        return F.lower(c) if self.f.lower else c

    def first_fault(self, inside: Column) -> Column:
        """Code of the field's error, null where there is none; nothing is reported inside an absent parent."""
        f, absent = self.f, self.type.isNull()
        code = F.when(~inside, F.lit(None).cast("string"))
        code = code.when(absent, "missing") if f.required else code.when(absent | (self.type == "VOID"), F.lit(None))
        code = code.when(self.value.isNull(), self.fault())
        for bad, name, _ in self.rules():
            code = code.when(bad, name)
        return code

    def error(self) -> Column:
        """One struct per field; its type is null where the field is fine."""
        messages = {c: MESSAGES[c] for c in (*_CODES[self.family], "missing")} | {n: m for _, n, m in self.rules()}
        texts = F.create_map(*[F.lit(x) for pair in messages.items() for x in pair])
        shown = F.when(self.code != "missing", self.text)
        return F.struct(
            F.lit(self.f.path).alias("loc"), self.code.alias("type"), F.element_at(texts, self.code).alias("msg"), shown.alias("input")
        )

    def element_errors(self) -> Column:
        texts = self.f.kind == "list<str>"
        wanted = ("STRING",) if texts else NUMBER_TYPES
        code = "string_type" if texts else "int_type"
        wrong = F.transform(
            self.extra,
            lambda e, i: F.when(
                ~type_of(e).isin(*wanted), _error(F.concat(F.lit(f"{self.f.path}."), i.cast("string")), code, e.cast("string"))
            ),
        )
        return F.coalesce(F.filter(wrong, lambda x: x.isNotNull()), _no_errors())

    def rules(self) -> list[tuple[Column, str, str]]:
        """(broken, code, message) in the order they are tested; the first broken one is reported."""
        f, value, normal = self.f, self.value, self.normal
        checks: list[tuple[Column, str, str]] = []
        if self.family in ("int", "float"):
            # NaN breaks every bound; Spark orders it above all numbers, so it is tested by name
            nan = F.isnan(value.cast("double"))
            for limit, code, word, holds in (
                (f.le, "less_than_equal", "less than or equal to", lambda x: value <= x),
                (f.lt, "less_than", "less than", lambda x: value < x),
                (f.ge, "greater_than_equal", "greater than or equal to", lambda x: value >= x),
                (f.gt, "greater_than", "greater than", lambda x: value > x),
            ):
                if limit is not None:
                    checks.append((~holds(limit) | nan, code, f"Input should be {word} {limit:g}"))
        if f.choices:
            wanted = " or ".join(f"'{c}'" for c in f.choices)
            checks.append((~value.isin(*f.choices), "literal_error", f"Input should be {wanted}"))
        if f.min_length is not None:
            text = f"String should have at least {f.min_length} characters"
            checks.append((F.char_length(value) < f.min_length, "string_too_short", text))
        if f.max_length is not None:
            text = f"String should have at most {f.max_length} characters"
            checks.append((F.char_length(value) > f.max_length, "string_too_long", text))
        if f.min_stripped is not None:
            text = f"the text needs at least {f.min_stripped} characters without outer spaces"
            checks.append((F.char_length(normal) < f.min_stripped, "value_error", text))
        if f.pattern:
            checks.append((~normal.rlike(f.pattern), "value_error", f.pattern_message))
        if self.family == "map" and f.element_ge is not None:
            low = f.element_ge
            fine = F.coalesce(F.forall(F.map_values(value), lambda x: x >= low), F.lit(False))
            checks.append((~fine, "value_error", f"all values must be at least {low:g}"))
        return checks


_CODES = {
    "int": ("int_type", "int_parsing", "int_from_float"),
    "float": ("float_type", "float_parsing"),
    "bool": ("bool_type", "bool_parsing"),
    "date": ("date_type", "date_parsing", "date_inexact"),
    "str": ("string_type",),
    "list": ("list_type",),
    "map": ("map_type",),
}


def _no_errors() -> Column:
    return F.array().cast(f"array<{ERROR}>")


def validate(df: DataFrame, record: str, fields: Sequence[Field]) -> DataFrame:
    """Add `errors` (all errors of the row) and `clean`; a broken row never stops the others.

    Stage the result before splitting it: a filter on `errors` over the lazy frame would be pushed below the rules and
    repeat them.
    """
    leaves = [_Leaf(i, f) for i, f in enumerate(fields)]
    parents: dict[str, str] = {"": "_parent_root"}
    for f in fields:
        steps = f.path.split(".")[:-1]
        for i in range(1, len(steps) + 1):
            parents.setdefault(".".join(steps[:i]), f"_parent{len(parents)}")
    source = F.col(record)

    work = df.withColumns(
        {name: object_mark(source, path) for path, name in parents.items()}
        | {name: c for leaf in leaves for name, c in leaf.read(source).items()}
    )
    work = work.withColumns({leaf.names["value"]: leaf.coerce() for leaf in leaves})
    work = work.withColumns({leaf.names["normal"]: leaf.normalise() for leaf in leaves})

    def holds_object(path: str) -> Column:
        return F.coalesce(F.col(parents[path]) == "OBJECT", F.lit(False))

    work = work.withColumns(
        {leaf.names["code"]: leaf.first_fault(holds_object(leaf.f.path.rpartition(".")[0])) for leaf in leaves}
    )
    root = F.when(~holds_object(""), "model_type")
    found = [F.array(_error("", root, at(source, "", "string"), MESSAGES["model_type"]))]
    reported = {""}
    for leaf in leaves:
        parent, _, _ = leaf.f.path.rpartition(".")
        if parent not in reported:
            reported.add(parent)
            absent = F.col(parents[parent]).isNull()
            code = F.when(~holds_object(parent.rpartition(".")[0]), F.lit(None).cast("string")).when(absent, "missing").when(
                ~holds_object(parent), "model_type"
            )
            message = F.when(absent, MESSAGES["missing"]).otherwise(MESSAGES["model_type"])
            found.append(F.array(_error(parent, code, at(source, parent, "string"), message)))
        found.append(F.array(leaf.error()))
        if leaf.family == "list":
            found.append(leaf.element_errors())
    errors = F.filter(F.concat(*found), lambda e: e["type"].isNotNull())
    return work.select(
        *df.columns,
        errors.cast(f"array<{ERROR}>").alias("errors"),
        F.struct(*[leaf.normal.alias(leaf.f.column) for leaf in leaves]).alias("clean"),
    )


def valid_rows(checked: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat normalised rows without errors."""
    return checked.filter(F.size("errors") == 0).select(*keep, "clean.*")


def invalid_rows(checked: DataFrame, keep: Sequence[str], data: str, stage: str = "transform") -> DataFrame:
    """{keep..., stage, data, errors} of the rows with errors (VAL-10); `data` is the column with the record's JSON text."""
    return checked.filter(F.size("errors") > 0).select(
        *keep, F.lit(stage).alias("stage"), F.col(data).alias("data"), "errors"
    )


def split_counts(checked: DataFrame) -> DataFrame:
    """extracted = valid + invalid in one row (AGG-33)."""
    good = F.count_if(F.size("errors") == 0)
    return checked.agg(
        F.count(F.lit(1)).alias("extracted"),
        good.alias("valid"),
        (F.count(F.lit(1)) - good).alias("invalid"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("n_errors"),
    )


def error_lines(checked: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per error (VAL-11)."""
    return checked.select(*keep, F.explode("errors").alias("e")).select(*keep, "e.loc", "e.type", "e.msg", "e.input")


def error_report(checked: DataFrame) -> DataFrame:
    """Number of errors by field and code."""
    return error_lines(checked, []).groupBy("loc", "type").agg(F.count(F.lit(1)).alias("n"))

