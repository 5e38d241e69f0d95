"""Lax and strict JSON rules."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assaylake.config import LOINC_URI, RACE_URL
from assaylake.functions import json as j
from assaylake.plans.staging import OBSERVATION, PATIENT

def member():
    return j.json_path(F.col("raw"), "x")


@pytest.mark.parametrize(
    "value, expected",
    [("a", "a"), (42, "42"), (5.5, "5.5"), (True, "true"), (None, None), ([], None), ([1], None), ({"a": 1}, None)],
)
def test_text_coerces_scalars_only(values, value, expected):
    assert values({"x": value}, got=j.text(member())).got == expected


@pytest.mark.parametrize("value, expected", [("a", "a"), ("", ""), (42, None), (True, None), (["a"], None), (None, None)])
def test_strict_text_takes_strings_only(values, value, expected):
    assert values({"x": value}, got=j.strict_text(member())).got == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("5.5", Decimal("5.5")),
        (5, Decimal(5)),
        (0.1, Decimal("0.1")),
        (True, None),
        (False, None),
        ("abc", None),
        ("NaN", None),
        ([1], None),
        (None, None),
        (1e40, None),
    ],
)
def test_number(values, value, expected):
    assert values({"x": value}, got=j.number(member())).got == expected


@pytest.mark.parametrize("value, expected", [(True, True), ("false", False), ("maybe", None), ([], None), (None, None)])
def test_boolean(values, value, expected):
    assert values({"x": value}, got=j.boolean(member())).got == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05.123+02:00", dt.datetime(2024, 1, 2, 1, 4, 5, 123000)),
        ("2024-01-02T23:30:00-03:00", dt.datetime(2024, 1, 3, 2, 30)),
        ("2024-01-02T03:04:05.123456Z", dt.datetime(2024, 1, 2, 3, 4, 5, 123456)),
        ("2024-01-02T03:04:05.123456789Z", dt.datetime(2024, 1, 2, 3, 4, 5, 123456)),
        ("2024-01-02", None),
        ("2024-01-02T03:04:05", None),
        ("2024-13-02T03:04:05Z", None),
        ("soon", None),
        (20240102, None),
    ],
)
def test_instant_needs_time_and_offset(values, value, expected):
    assert values({"x": value}, got=j.instant(member()).cast("timestamp_ntz")).got == expected


@pytest.mark.parametrize(
    "value, expected",
    [("2024-02-29", dt.date(2024, 2, 29)), ("2024-02", None), ("2024-02-30", None), ("2024-02-29T00:00:00Z", None)],
)
def test_day(values, value, expected):
    assert values({"x": value}, got=j.day(member())).got == expected


def laboratory(values, document):
    members = j.shape(F.col("raw"), {"category": OBSERVATION["category"]})
    return values(document, got=j.is_laboratory(members[0])).got


@pytest.mark.parametrize(
    "category, expected",
    [
        ([{"coding": [{"code": "laboratory"}]}], True),
        ([{"coding": [{"code": "x"}, {"display": "Lab"}]}], True),
        ([{"text": "LABORATORY"}], True),
        ([{"text": "vital"}, {"coding": [{"code": "LAB"}]}], True),
        ([{"text": "vital"}], False),
        ([{"coding": [{"system": "lab"}]}], False),
        ([], False),
        ([None], False),
        ([None, {"text": "lab"}], True),
        (["lab"], False),
        ({"text": "lab"}, False),
        (None, False),
    ],
)
def test_laboratory_category(values, category, expected):
    assert laboratory(values, {"category": category}) is expected


def test_laboratory_without_category(values):
    assert laboratory(values, {"id": "1"}) is False


def codings(values, document, column):
    member = j.shape(F.col("raw"), {"code": OBSERVATION["code"]})[0]
    return values(document, got=column(member["coding"])).got


def test_code_for_system_takes_the_first_of_its_system(values):
    many = [{"system": "y", "code": "0"}, {"system": LOINC_URI, "code": "1"}, {"system": LOINC_URI, "code": "2"}]
    pick = lambda c: j.code_for_system(c, LOINC_URI)
    assert codings(values, {"code": {"coding": many}}, pick) == "1"
    assert codings(values, {"code": {"coding": many[:1]}}, pick) is None
    assert codings(values, {"code": {"coding": [{"system": LOINC_URI, "code": 42}]}}, pick) is None
    assert codings(values, {"code": {"coding": {"system": LOINC_URI, "code": "1"}}}, pick) is None
    assert codings(values, {"code": "text"}, pick) is None


def test_first_does_not_search_for_a_filled_element(values):
    pick = lambda c: j.strict_text(j.first(c)["display"])
    assert codings(values, {"code": {"coding": [{"code": "1"}, {"display": "d"}]}}, pick) is None


def test_first_nested_code_skips_empty_groups(values):
    member = j.shape(F.col("raw"), {"interpretation": OBSERVATION["interpretation"]})[0]
    document = {"interpretation": [{"text": "x"}, {"coding": []}, {"coding": [{"code": "H"}, {"code": "L"}]}]}
    assert values(document, got=j.first_nested_code(member)).got == "H"


@pytest.mark.parametrize("single, shape_of", [(True, lambda c: c), (True, lambda c: [c]), (False, lambda c: [c])])
def test_extension_code(values, single, shape_of):
    member = j.shape(F.col("raw"), {"extension": PATIENT["extension"]})[0]
    race = {"url": RACE_URL, "extension": [{"url": "text"}, {"valueCoding": shape_of({"code": "2106-3"})}]}
    document = {"extension": [{"url": "other"}, race]}
    assert values(document, got=j.extension_code(member, RACE_URL, single)).got == "2106-3"


def test_extension_code_array_only_ignores_an_object(values):
    member = j.shape(F.col("raw"), {"extension": PATIENT["extension"]})[0]
    document = {"extension": [{"url": RACE_URL, "extension": [{"valueCoding": {"code": "1"}}]}]}
    assert values(document, got=j.extension_code(member, RACE_URL, False)).got is None


scalars = st.none() | st.booleans() | st.integers(-(10**6), 10**6) | st.sampled_from(["lab", "Laboratory", "x", ""])
trees = st.recursive(
    scalars,
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["coding", "code", "text"]), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(category=trees)
def test_every_category_is_lab_or_not(values, category):
    assert laboratory(values, {"category": category}) in (True, False)
