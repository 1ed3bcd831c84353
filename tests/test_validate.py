"""Rules against literal fixtures and, where it is installed, against a row parser of the same contract."""

from __future__ import annotations

import datetime
import json
import random
from typing import Literal

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import validate as V
from tidegauge.plans.record_queries import PRODUCT_FIELDS, USER_FIELDS


def check(spark, records, fields):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "row int, text string")
    return V.validate(df.withColumn("record", F.try_parse_json("text")), "record", fields).drop("record")


def marks(checked):
    return {r.row: [(e.loc, e.type) for e in r.errors] for r in checked.collect()}


USER = {
    "id": 1, "username": "user_1", "email": " A@Example.com ", "age": 30, "is_active": True, "signup_date": "2024-07-02",
    "profile": {"country": "KR", "tier": "pro", "score": 50.5}, "tags": ["a", "b"],
}


def test_forty_records(spark):
    """Four bad ones: age -5, a broken address, an absent address, a score of 150."""
    users = [{**USER, "id": i} for i in range(1, 41)]
    users[6]["age"] = -5
    users[12]["email"] = "not-an-email"
    del users[20]["email"]
    users[28]["profile"] = {**USER["profile"], "score": 150.0}
    checked = check(spark, users, USER_FIELDS)
    bad = {k: v for k, v in marks(checked).items() if v}
    assert bad == {
        6: [("age", "greater_than_equal")], 12: [("email", "value_error")], 20: [("email", "missing")],
        28: [("profile.score", "less_than_equal")],
    }
    counts = V.split_counts(checked).first()
    assert (counts.extracted, counts.valid, counts.invalid) == (40, 36, 4)
    assert V.valid_rows(checked).first().email == "a@example.com"
    assert V.invalid_rows(checked, ["row"], "text").count() == 4
    assert {(r.loc, r.n) for r in V.error_report(checked).collect()} == {("age", 1), ("email", 1), ("profile.score", 1)} | {("email", 1)}
    line = V.error_lines(checked, ["row"]).filter("row = 6").first()
    assert (line.msg, line.input) == ("Input should be greater than or equal to 0", "-5")


def test_products(spark):
    good = {"id": 1, "name": " Product A ", "category": " FOOD ", "price": 10.5, "seller": {"seller_id": 2, "region": " Gwangju "}}
    rows = [good, {**good, "price": -1}, {**good, "price": 0}, {**good, "seller": {"seller_id": 0, "region": " S "}}, {**good, "name": "  "}]
    checked = check(spark, rows, PRODUCT_FIELDS)
    assert marks(checked) == {
        0: [], 1: [("price", "greater_than")], 2: [("price", "greater_than")],
        3: [("seller.seller_id", "greater_than"), ("seller.region", "value_error")], 4: [("name", "value_error")],
    }
    flat = V.valid_rows(checked).first()
    assert (flat.name, flat.category, flat.seller_region, flat.seller_id) == ("Product A", "food", "Gwangju", 2)


def test_map_values_and_optional(spark):
    fields = [V.Field("failures", "map<int>", element_ge=0), V.Field("limit", "int", required=False, ge=1)]
    rows = [{"failures": {"1": 2}}, {"failures": {"1": -1}, "limit": None}, {"failures": [1], "limit": 0}, {"failures": {"1": "x"}, "limit": 3}]
    assert marks(check(spark, rows, fields)) == {
        0: [], 1: [("failures", "value_error")], 2: [("failures", "map_type"), ("limit", "greater_than_equal")], 3: [("failures", "value_error")],
    }


def test_record_that_is_no_object(spark):
    assert marks(check(spark, [[1], "x"], USER_FIELDS)) == {0: [("", "model_type")], 1: [("", "model_type")]}


# what our codes are called there
SAME = {"date_parsing": "date_from_datetime_parsing", "date_inexact": "date_from_datetime_inexact"}


def test_against_a_row_parser(spark):
    pydantic = pytest.importorskip("pydantic")

    class Profile(pydantic.BaseModel):
        country: Literal["KR", "US", "JP", "DE"]
        score: float = pydantic.Field(ge=0, le=100)

    class User(pydantic.BaseModel):
        id: int = pydantic.Field(gt=0)
        username: str = pydantic.Field(min_length=3, max_length=6)
        age: int = pydantic.Field(ge=0, le=120)
        is_active: bool
        day: datetime.date
        profile: Profile
        tags: list[str]

    fields = (
        V.Field("id", "int", gt=0), V.Field("username", "str", min_length=3, max_length=6), V.Field("age", "int", ge=0, le=120),
        V.Field("is_active", "bool"), V.Field("day", "date"), V.Field("profile.country", "str", choices=("KR", "US", "JP", "DE")),
        V.Field("profile.score", "float", ge=0, le=100), V.Field("tags", "list<str>"),
    )
    pools = {
        "id": [1, 5, 0, -3, "7", " 7 ", 7.0, "7.0", 7.5, True, None, "x", [1], {}],
        "username": ["abc", "ab", "abcdef", "abcdefg", "", 5, None],
        "age": [0, 120, 121, -1, "30", 30.0, 30.5, "3.5", False, None],
        "is_active": [True, False, 1, 0, 2, 1.0, 0.5, "yes", "NO", "on", "off", "t", "F", "y", "n", "maybe", None, []],
        "day": ["2024-07-02", "2024-07-02T00:00:00", "2024-07-02T10:00:00", "2024-13-02", "x", None, True, [1], 1719878400, 1719878401],
        "profile": [{"country": "KR", "score": 1}, {"country": "XX", "score": "1.5"}, {"score": True}, {}, None, "x", {"country": 5, "score": "nan"}, {"country": "US", "score": 100.5}],
        "tags": [[], ["a"], ["a", 5], "a", None, [None], [["a"]]],
    }
    rng = random.Random(4)
    records = []
    for _ in range(400):
        r = {k: rng.choice(v) for k, v in pools.items()}
        if rng.random() < 0.3:
            del r[rng.choice(list(r))]
        records.append(r)
    got = marks(check(spark, records, fields))
    for i, r in enumerate(records):
        try:
            User.model_validate(r)
            expected = []
        except pydantic.ValidationError as e:
            expected = [(".".join(map(str, x["loc"])), x["type"]) for x in e.errors()]
        assert [loc for loc, _ in got[i]] == [loc for loc, _ in expected], r
        for (_, mine), (_, theirs) in zip(got[i], expected):
            assert SAME.get(mine, mine) == theirs, (r, mine, theirs)
