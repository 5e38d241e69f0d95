"""Hand-kept code mappings: read from CSV, or the defaults below."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TEST_SEED = T.StructType(
    [
        T.StructField("source_code", T.StringType()),
        T.StructField("source_code_system", T.StringType()),
        T.StructField("target_concept_id", T.LongType()),
        T.StructField("source_concept_id", T.LongType()),
        T.StructField("target_description", T.StringType()),
    ]
)
UNIT_SEED = T.StructType(
    [
        T.StructField("source_unit", T.StringType()),
        T.StructField("target_concept_id", T.LongType()),
        T.StructField("notes", T.StringType()),
    ]
)

# Analyser test codes and the concepts they stand for.
_ANALYSER = "urn:roche:cobas"
TEST_ROWS = [
    ("ROCHE_GLUC_FST", _ANALYSER, 3004501, 0, "glucose, fasting"),
    ("ROCHE_HGB", _ANALYSER, 3000963, 0, "hemoglobin"),
    ("ROCHE_CREA", _ANALYSER, 3016723, 0, "creatinine"),
    ("ROCHE_A1C", _ANALYSER, 3004410, 0, "hemoglobin A1c"),
    ("ROCHE_K", _ANALYSER, 3023103, 0, "potassium"),
    ("ROCHE_NA", _ANALYSER, 3019550, 0, "sodium"),
    ("ROCHE_CL", _ANALYSER, 3014576, 0, "chloride"),
]

# Unit spellings and the concepts they stand for.
UNIT_ROWS = [
    ("mg/dl", 8840),
    ("mg/dL", 8840),
    ("g/dl", 8713),
    ("g/dL", 8713),
    ("mmol/l", 8753),
    ("mmol/L", 8753),
    ("umol/l", 9028),
    ("µmol/L", 9028),
    ("U/l", 8763),
    ("U/L", 8763),
    ("IU/l", 8985),
    ("IU/L", 8985),
    ("x10^9/L", 8848),
    ("x10^3/uL", 8848),
    ("10^9/L", 8848),
    ("10*9/L", 8848),
    ("/uL", 8784),
    ("%", 8554),
    ("ng/ml", 8842),
    ("ng/mL", 8842),
    ("mEq/L", 9557),
    ("mmHg", 8876),
    ("s", 8555),
    ("ratio", 9117),
    ("titer", 8623),
]


def default_test_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEST_ROWS, TEST_SEED)


def default_unit_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(unit, target, None) for unit, target in UNIT_ROWS], UNIT_SEED)


def seed_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A mapping CSV with a header row, read under a declared schema."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST")
