"""Registered queries against their SQL on the smallest driver tables, and the plans behind them."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from assaylake.sources.ndjson import ndjson_scan
from contract import load_queries
from contract.check import compare, connect
from contract.registry import tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")

SAMPLE = [
    "omop_measurement",
    "omop_observation",
    "stg_observation_lab",
    "omop_person",
    "omop_validation_summary",
    "inventory_source_codes",
    "incremental_filter",
    "json_ts",
    "left_join_composite",
    "dq_concept_valid",
    "partition_replace",
]


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    build, sql = entry_point.queries()[name], entry_point.oracle_sql()[name]
    assert compare(spark, duck, FOLDER, name, build, sql) is None


def test_every_query_has_sql_and_no_forbidden_name():
    queries = load_queries().QUERIES  # those of the optional subpackage have their own tests
    assert set(queries) == set(load_queries().ORACLES)
    assert set(queries) <= set(entry_point.queries())
    assert not [n for n in queries if "pipeline" in n or n.startswith("op") and n[2:3].isdigit()]


def test_entry_has_rows(spark):
    assert not entry_point.entry(spark).isEmpty()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_version_is_limited_before_the_shuffle(spark):
    plan = physical(tables(spark, FOLDER).ws.model("stg_patient"))
    before, after = plan.split("Exchange hashpartitioning(resource_id", maxsplit=1)
    assert "row_number(), 1, Partial" in after and "row_number(), 1, Final" in before


def test_unread_members_are_neither_extracted_nor_shuffled(spark):
    plan = physical(tables(spark, FOLDER).ws.model("observation_versions").select("fhir_observation_id", "is_lab"))
    assert "$.category" in plan and "$.valueQuantity" not in plan and "$.code" not in plan


def test_no_python_and_no_cartesian_product(spark):
    ws = tables(spark, FOLDER).ws
    for name in ("omop_measurement", "omop_observation", "omop_visit_detail", "omop_specimen", "omop_fact_relationship"):
        plan = physical(ws.model(name))
        assert not [word for word in ("Python", "Pandas", "Cartesian", "NestedLoop") if word in plan], name


@pytest.mark.parametrize("name", ["inner_join_person", "cte_relations"])
def test_facts_of_known_persons_match_sql(spark, duck, name):
    build, sql = entry_point.queries()[name], entry_point.oracle_sql()[name]
    assert compare(spark, duck, FOLDER, name, build, sql) is None


def test_a_filter_by_time_parses_each_document_once(spark):
    assert physical(entry_point.queries()["since_window"](spark, FOLDER)).count("parseJson") == 1


def test_new_rows_of_an_upsert_are_computed_once(spark):
    """Only the old rows' plan parses observations and reports; keys and rows of what is new are stored."""
    plan = physical(entry_point.queries()["upsert_by_key"](spark, FOLDER))
    old = physical(tables(spark, FOLDER).ws.model("omop_measurement").select("measurement_id", "value_source_value", "_loaded_at"))
    assert plan.count("parseJson") <= old.count("parseJson")


def test_landing_files_are_compressed_and_read_back_whole(spark):
    from contract.queries_ingest import RUN_DATE, land

    t = tables(spark, FOLDER)
    root = land(t, ["Specimen"])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length").collect()
    assert files and all(f.path.endswith(".gz") for f in files)
    assert sum(f.length for f in files) < 100 * t.lines("Specimen").count()
    assert ndjson_scan(spark, root, RUN_DATE, "Specimen").count() == t.lines("Specimen").count()


def test_quality_checks_read_stored_marts(spark):
    """No check runs the plan of a mart again."""
    from contract.queries_checks import marts

    made = marts(tables(spark, FOLDER))
    assert not [n for n in made if n not in ("location", "cdm_source") and "parseJson" in physical(made[n])]
