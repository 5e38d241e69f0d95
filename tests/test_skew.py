"""A third of all rows on one key: results stay whole and no task takes them all."""

import pytest
from pyspark.sql import functions as F

from assaylake.operators.joins import entity_left_join, heavy_keys, lookup_join
from assaylake.operators.versions import latest_version
from assaylake.session import settings


@pytest.fixture
def no_broadcast(spark):
    """Thresholds small enough for test data to count as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def facts(spark, tmp_path, reference):
    """Stored in several files, as one map task's output is not split."""
    rows = spark.range(60000).select(
        F.col("id").cast("string").alias("oid"), reference.alias("ref"), F.sha2(F.col("id").cast("string"), 512).alias("payload")
    )
    rows.repartition(24).write.parquet(str(tmp_path / "facts"))
    return spark.read.parquet(str(tmp_path / "facts"))


def entities(spark, tmp_path):
    spark.range(2000).select(F.concat(F.lit("E"), "id").alias("source"), F.col("id").alias("visit")).write.parquet(
        str(tmp_path / "entities")
    )
    return spark.read.parquet(str(tmp_path / "entities"))


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_reference_is_split(spark, tmp_path, no_broadcast):
    hot = F.when(F.col("id") % 3 == 0, "E7").otherwise(F.concat(F.lit("E"), F.col("id") % 4000))
    fact, entity = facts(spark, tmp_path, hot), entities(spark, tmp_path)
    joined = entity_left_join(fact, entity, "ref", "source", "oid").select("oid", "visit", "payload")
    assert "skew=true" in executed(joined)
    counts = joined.agg(
        F.count("*").alias("n"), F.count_if(F.col("visit") == 7).alias("hot"), F.count("visit").alias("matched")
    ).first()
    expected = fact.join(entity, F.col("ref") == F.col("source"), "left").agg(
        F.count("*").alias("n"), F.count_if(F.col("visit") == 7).alias("hot"), F.count("visit").alias("matched")
    )
    assert counts == expected.first() and counts.n == 60000 and counts.hot >= 20000


def largest_share(joined):
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_absent_references_do_not_meet(spark, tmp_path, no_broadcast):
    sparse = F.when(F.col("id") % 10 == 0, F.concat(F.lit("E"), F.col("id") % 4000))
    fact, entity = facts(spark, tmp_path, sparse), entities(spark, tmp_path)
    joined = entity_left_join(fact, entity, "ref", "source", "oid")
    assert joined.count() == 60000 and joined.filter("ref is null and visit is not null").isEmpty()
    assert largest_share(joined) < 0.2


def test_heavy_references_are_spread_without_adaptive_execution(spark, tmp_path, no_broadcast):
    hot = F.when(F.col("id") % 3 == 0, "E7").when(F.col("id") % 3 == 1, F.concat(F.lit("E"), F.col("id") % 4000))
    fact, entity = facts(spark, tmp_path, hot), entities(spark, tmp_path)
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        heavy = heavy_keys(fact, ["ref", "oid"], 16)
        assert list(heavy) == ["ref"]
        assert [(r.key, r.parts) for r in heavy["ref"].collect()] == [("E7", 6)]
        plain = entity_left_join(fact, entity, "ref", "source", "oid")
        spread = entity_left_join(fact, entity, "ref", "source", "oid", heavy["ref"])
        assert largest_share(plain) > 0.33 and largest_share(spread) < 0.25
        assert spread.columns == plain.columns and spread.count() == 60000
        assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_no_key_is_heavy_in_an_empty_or_even_table(spark):
    none = spark.createDataFrame([], "ref string, n long")
    assert heavy_keys(none, ["ref", "n"], 16) == {}
    even = spark.range(1000).select(F.col("id").cast("string").alias("ref"), F.lit(None).cast("long").alias("n"))
    assert heavy_keys(even, ["ref", "n"], 16) == {}


def test_marts_of_stored_relations_spread_heavy_references(spark, workspace, tmp_path):
    """A third of the observations share patient, encounter and specimen; results equal those computed without counting."""

    def document(kind, key, **members):
        return {"resourceType": kind, "id": key, "meta": {"lastUpdated": "2024-01-01T00:00:00Z"}, **members}

    def observed(i):
        n = 0 if i % 3 == 0 else i
        links = {"encounter": {"reference": f"Encounter/e{n}"}, "specimen": {"reference": f"Specimen/s{n}"}} if i % 5 else {}
        kind = {"category": [{"coding": [{"code": "laboratory" if i % 2 else "vital-signs"}]}]}
        return document("Observation", f"o{i}", subject={"reference": f"Patient/p{n}"}, effectiveDateTime="2024-01-01T10:00:00Z", **kind, **links)

    ids = range(0, 120, 2)
    resources = {
        "Patient": [document("Patient", f"p{i}") for i in ids],
        "Encounter": [document("Encounter", f"e{i}", subject={"reference": f"Patient/p{i}"}) for i in ids],
        "Specimen": [document("Specimen", f"s{i}", subject={"reference": f"Patient/p{i}"}) for i in ids],
        "Observation": [observed(i) for i in range(120)],
    }
    plain, counted = workspace(resources), workspace(resources)
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16"}):
        counted.model("observation_versions").write.parquet(str(tmp_path / "versions"))
        counted.adopt("observation_versions", spark.read.parquet(str(tmp_path / "versions")))
        heavy = counted.heavy_references("observation_versions")
        assert sorted(heavy) == ["encounter_ref", "patient_ref", "specimen_ref"]
        assert heavy["patient_ref"].first().key == "p0" and counted.heavy_references("stg_encounter") == {}
        for name, rows in (("omop_measurement", 40), ("omop_observation", 60)):
            one, two = plain.model(name), counted.model(name)
            assert one.columns == two.columns and one.count() == rows
            assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_a_hot_code_is_spread_over_salts(spark, tmp_path, no_broadcast):
    hot = F.when(F.col("id") % 3 == 0, "E7").when(F.col("id") % 3 == 1, F.concat(F.lit("E"), F.col("id") % 4000))
    fact, entity = facts(spark, tmp_path, hot), entities(spark, tmp_path)
    salted = lookup_join(fact, entity, {"source": F.col("ref")}, {"visit": "visit"}, False, 16, "oid")
    plain = lookup_join(fact, entity, {"source": F.col("ref")}, {"visit": "visit"}, True, 16, "oid")
    assert "Broadcast" not in executed(salted)
    assert largest_share(salted) < 0.25
    assert salted.columns == plain.columns and salted.exceptAll(plain).isEmpty() and salted.count() == plain.count()


def test_a_key_with_many_versions_is_cut_before_the_shuffle(spark, tmp_path, no_broadcast):
    hot = F.when(F.col("id") % 3 == 0, "E7").otherwise(F.concat(F.lit("E"), F.col("id") % 4000))
    fact = facts(spark, tmp_path, hot).withColumn("number", F.col("oid").cast("long"))
    newest = latest_version(fact, "ref", ("number",))
    rows = {r.ref: r.number for r in newest.select("ref", "number").collect()}
    assert rows["E7"] == 59997 and len(rows) == fact.select("ref").distinct().count()
    written = newest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in written
