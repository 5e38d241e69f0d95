"""References, keys, hashes, conversions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from assaylake import EngineConfig
from assaylake.functions import scalars as s


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "reference, expected",
    [("Patient/1", "1"), ("http://h/fhir/Patient/1", "1"), ("1", "1"), ("Patient/", None), ("", None), (None, None)],
)
def test_reference_id(spark, reference, expected):
    assert one(spark, s.reference_id(F.lit(reference).cast("string"))) == expected


@pytest.mark.parametrize("value", ["", "1", "Patient/1", "C0", "é"])
def test_surrogate_key_is_the_leading_half_of_md5(spark, value):
    expected = int.from_bytes(hashlib.md5(value.encode()).digest()[:8], "big", signed=True)
    assert one(spark, s.surrogate_key(F.lit(value))) == expected


def test_surrogate_key_of_null_is_null(spark):
    assert one(spark, s.surrogate_key(F.lit(None).cast("string"))) is None


def test_person_source_plain_hashed_and_without_pepper(spark, monkeypatch):
    monkeypatch.delenv("DBT_PEPPER", raising=False)
    plain, hashing = EngineConfig(), EngineConfig(hash_person_source_value=True, person_source_value_pepper="p")
    assert one(spark, s.person_source(F.lit("m"), plain)) == "m"
    assert one(spark, s.person_source(F.lit("m"), hashing)) == hashlib.sha256(b"mp").hexdigest()
    assert one(spark, s.person_source(F.lit(None).cast("string"), hashing)) == hashlib.sha256(b"p").hexdigest()
    with pytest.raises(ValueError):
        s.person_source(F.lit("m"), EngineConfig(hash_person_source_value=True))
    monkeypatch.setenv("DBT_PEPPER", "q")
    from_environment = EngineConfig(hash_person_source_value=True)
    assert one(spark, s.person_source(F.lit("m"), from_environment)) == hashlib.sha256(b"mq").hexdigest()


def test_joined_key_keeps_empty_places(spark):
    assert one(spark, s.joined_key(F.lit("a"), F.lit(None).cast("string"), F.lit("c"))) == "a||c"


@pytest.mark.parametrize("value, expected", [("100", "100"), ("0", "0"), ("5.5", "5.5"), ("-0.25", "-0.25"), ("1e-9", "0.000000001")])
def test_decimal_text(spark, value, expected):
    assert one(spark, s.decimal_text(F.lit(value).cast("decimal(38,9)"))) == expected


@pytest.mark.parametrize("symbol, expected", [("<", "lt"), ("<=", "lte"), (">", "gt"), (">=", "gte"), ("=", "eq"), ("ad", None), (None, None)])
def test_comparator_code(spark, symbol, expected):
    assert one(spark, s.comparator_code(F.lit(symbol).cast("string"))) == expected
