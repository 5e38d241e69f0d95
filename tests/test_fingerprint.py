"""Fingerprints against the implementation in the JVM's public hashing library, and published values."""

import random

import pytest
from pyspark.sql import functions as F

from assaylake.functions.fingerprint import fingerprint64
from assaylake.session import settings

# Published fingerprints.
PUBLISHED = {"1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312}


def expected(spark, text):
    data = text.encode()
    return spark._jvm.com.google.common.hash.Hashing.farmHashFingerprint64().hashBytes(data).asLong()


def texts():
    draw = random.Random(7)
    letters = "abcXYZ019-_/|. éßж漢😀"
    by_length = ["".join(draw.choice(letters[:14]) for _ in range(n)) for n in [*range(0, 140), 191, 192, 193, 256, 1000, 4097]]
    return by_length + ["".join(draw.choice(letters) for _ in range(n)) for n in range(1, 90, 3)] + ["\0", "\0" * 70, "Patient/" + "f" * 64]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_every_length_equals_the_public_implementation(spark, ansi):
    rows = [(t,) for t in [*texts(), *PUBLISHED]]
    with settings(spark, {"spark.sql.ansi.enabled": ansi}):
        found = spark.createDataFrame(rows, "t string").select("t", fingerprint64(F.col("t")).alias("f")).collect()
    assert len(found) == len(rows)
    assert [r.t for r in found if r.f != expected(spark, r.t)] == []
    assert {r.t: r.f for r in found if r.t in PUBLISHED} == PUBLISHED


def test_null_stays_null_and_numbers_are_taken_as_text(spark):
    none, number, text = spark.range(1).select(
        fingerprint64(F.lit(None).cast("string")), fingerprint64(F.lit(12345)), fingerprint64(F.lit("12345"))
    ).first()
    assert none is None and number == text
