import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from assaylake import Workspace
from assaylake.schemas.vocabulary import VOCABULARY_SCHEMAS
from assaylake.session import configure
from assaylake.sources.ndjson import raw_envelope


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate named column expressions over one JSON document."""

    def evaluate(document, **columns):
        df = spark.createDataFrame([(json.dumps(document),)], "text string")
        return df.select(F.parse_json("text").alias("raw")).select(*[c.alias(n) for n, c in columns.items()]).first()

    return evaluate


# (concept_id, name, vocabulary, standard, code, invalid)
CONCEPTS = [
    (100, "Glucose", "LOINC", "S", "1-1", None),
    (101, "Old glucose", "LOINC", None, "1-2", None),
    (102, "Potassium", "LOINC", "S", "2-1", None),
    (103, "Split code", "LOINC", "C", "3-1", None),
    (200, "Positive", "SNOMED", "S", "pos", None),
    (201, "Blood", "SNOMED", "S", "blood", None),
    (8840, "milligram per deciliter", "UCUM", "S", "mg/dL", None),
    (8507, "MALE", "Gender", "S", "male", None),
    (8527, "White", "Race", "S", "2106-3", None),
    (9201, "Inpatient", "Visit", "S", "IMP", None),
    (4171756, "Less than", "Meas Value Operator", "S", "op", None),
]
MAPS = [(101, 100), (103, 102), (103, 100)]


@pytest.fixture(scope="session")
def workspace(spark):
    """Workspace over lists of FHIR documents, per type or per (type, run date, file)."""

    def build(resources, config=None, seeds=None):
        def raw(resource_type):
            rows = []
            for entry in resources.get(resource_type, []):
                document, run_date, uri = entry if isinstance(entry, tuple) else (entry, "2024-01-02", "f")
                rows.append((json.dumps(document), uri, run_date))
            lines = spark.createDataFrame(rows, "line string, file_uri string, run_date string")
            return raw_envelope(lines, F.col("run_date"))

        def vocabulary(table):
            if table == "concept":
                rows = spark.createDataFrame(
                    CONCEPTS,
                    "concept_id long, concept_name string, vocabulary_id string, standard_concept string, "
                    "concept_code string, invalid_reason string",
                )
                return rows.withColumn("domain_id", F.lit("x"))
            if table == "concept_relationship":
                pairs = spark.createDataFrame(MAPS, "concept_id_1 long, concept_id_2 long")
                return pairs.withColumns(
                    {"relationship_id": F.lit("Maps to"), "invalid_reason": F.lit(None).cast("string")}
                )
            return spark.createDataFrame([], VOCABULARY_SCHEMAS[table])

        return Workspace(spark, raw, vocabulary, config, seeds)

    return build
