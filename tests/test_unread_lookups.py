"""A lookup too large to broadcast costs nothing where nothing it gives is read."""

from pyspark.sql import functions as F

from assaylake.config import EngineConfig
from assaylake.operators.joins import lookup_join, unique_key
from assaylake.quality import stages


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")


def test_a_shuffled_lookup_is_left_out_where_unread(spark):
    fact = spark.range(60).select(F.col("id").cast("string").alias("oid"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("c"), F.col("id") % 7)).alias("code"))
    rows = spark.range(10).select(F.concat(F.lit("c"), F.col("id") % 5).alias("code"), F.col("id").alias("concept_id"))
    lookup = unique_key(rows, {"code": F.col("code")})
    salted = lookup_join(fact, lookup, {"code": F.col("code")}, {"found": "concept_id"}, False, 4, "oid", grouped=True)
    plain = lookup_join(fact, lookup, {"code": F.col("code")}, {"found": "concept_id"}, True, 4, "oid")
    assert salted.columns == plain.columns and salted.count() == 60
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
    assert joins(salted) == 1 and joins(salted.select("oid")) == 0 and joins(salted.agg(F.count("*"))) == 0


def test_counting_measurement_joins_no_lookup(spark, workspace):
    def observed(i):
        code = {"coding": [{"system": "http://loinc.org", "code": "1-1"}]}
        return {
            "resourceType": "Observation", "id": f"o{i}", "meta": {"lastUpdated": "2024-01-01T00:00:00Z"}, "code": code,
            "subject": {"reference": "Patient/p"}, "category": [{"text": "lab"}],
        }

    resources = {"Patient": [{"resourceType": "Patient", "id": "p"}], "Observation": [observed(i) for i in range(5)]}
    large = workspace(resources, config=EngineConfig(broadcast_row_limit=0, salt_buckets=3))
    counts = stages.exit_counts(large)
    assert "_lk_salt" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert counts.first().measurement_rows == 5
    measured = large.model("omop_measurement")
    assert [r.measurement_concept_id for r in measured.collect()] == [100] * 5
