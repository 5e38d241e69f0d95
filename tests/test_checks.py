"""Checks, stage verdicts, catalogue, whole-day run, streaming front."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from assaylake.config import REQUIRED_VOCABULARY_TABLES
from assaylake.functions.scalars import surrogate_key
from assaylake.operators.joins import ambiguous_keys
from assaylake.plans.build import adopt_stored, refresh_observation_versions
from assaylake.plans.nightly import build, completed_stages, record_stage, run_day, verdicts
from assaylake.quality import checks, stages
from assaylake.sinks.raw import load_run
from assaylake.sources.ndjson import raw_envelope
from assaylake.schemas.cdm import ForeignKey, built_in_catalogue, catalogue_from_csv, catalogue_from_ddl
from assaylake.schemas.vocabulary import VOCABULARY_SCHEMAS
from assaylake.streaming.landing import land_available
from assaylake.workspace import Workspace
from tests.conftest import CONCEPTS, MAPS
from tests.test_marts import UPDATED, facts, observation, patient, resource
from tests.test_storage import DAY, land


def failing(df):
    return {(r.check, r.table_name, r.column_name): (r.failed, r.total) for r in df.collect()}


def test_generic_checks_count_failures(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None), (None, 9)], "k long, fk long")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    assert failing(checks.check_unique(df, "t", "k")) == {("unique", "t", "k"): (1, 2)}
    assert failing(checks.check_not_null(df, "t", ["k", "fk"])) == {
        ("not_null", "t", "k"): (1, 4),
        ("not_null", "t", "fk"): (1, 4),
    }
    assert failing(checks.check_relationship(df, "t", ["fk", "k"], parent, "id")) == {
        ("relationship", "t", "fk"): (1, 3),
        ("relationship", "t", "k"): (0, 3),
    }
    assert failing(checks.check_unique_combination(df, "t", ["k", "fk"])) == {
        ("unique_combination", "t", "k,fk"): (0, 4)
    }
    dates = spark.createDataFrame([(dt.date(2024, 1, 2), dt.date(2024, 1, 1)), (dt.date(2024, 1, 2), None)], "a date, b date")
    assert list(failing(checks.check_date_order(dates, "t", "a", "b")).values()) == [(1, 2)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_keys_share_one_shuffle(spark):
    one = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "b")], "k long, t string")
    none = one.filter("false")
    keys = [("one", "k", one), ("one", "t", one), ("none", "k", none)]
    got = checks.check_keys(keys)
    want = checks.union_all(p for name, key, df in keys for p in (checks.check_unique(df, name, key), checks.check_not_null(df, name, [key])))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert plan(checks.check_keys(keys)).count("Exchange hashpartitioning") == 2


def test_concept_ids_are_looked_up_in_bit_maps(spark, monkeypatch):
    concept = spark.createDataFrame([(1,), (40_000,), (2_000_000_001,), (None,)], "concept_id long")
    facts_ = spark.createDataFrame([(1, 5), (40_000, None), (7, 2_000_000_001), (None, 40_000)], "measurement_concept_id long, unit_concept_id long")
    results = checks.check_concepts_valid({"measurement": facts_}, concept, built_in_catalogue())
    assert "SortMergeJoin" not in plan(results) and plan(results).count("BroadcastHashJoin") == 2
    assert failing(results) == {("concept_valid", "measurement", "measurement_concept_id"): (1, 3), ("concept_valid", "measurement", "unit_concept_id"): (1, 3)}
    monkeypatch.setattr(checks, "MOST_BITMAPS", 1)  # too many maps: ids are counted and joined
    assert failing(checks.check_concepts_valid({"measurement": facts_}, concept, built_in_catalogue())) == failing(results)


def test_vocabulary_files_that_were_not_loaded_count_as_missing(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([], VOCABULARY_SCHEMAS["vocabulary"]).write.parquet(f"{root}/vocabulary/vocabulary")
    ws = Workspace.at(spark, root)
    assert ws.vocabulary("domain").collect() == [] and ws.vocabulary("domain").schema == VOCABULARY_SCHEMAS["domain"]
    row = stages.vocabulary_tables(ws.vocabularies(REQUIRED_VOCABULARY_TABLES)).first()
    assert (row["ok"], row["missing_tables"], row["empty_tables"]) == (False, 3, 1)


def test_late_sources_are_reported(spark, workspace):
    ws = workspace({"Patient": [patient("p")]})
    at = lambda day: F.lit(day).cast("timestamp")
    late = stages.freshness_checks(ws, ["Patient", "Specimen"], at("2024-01-03"))
    assert failing(late) == {("freshness", "Patient", "_ingest_run_date"): (0, 1), ("freshness", "Specimen", "_ingest_run_date"): (1, 1)}
    assert failing(stages.freshness_checks(ws, ["Patient"], at("2024-01-05")))[("freshness", "Patient", "_ingest_run_date")] == (1, 1)


def test_empty_table_still_reports(spark):
    empty = spark.createDataFrame([], "k long, fk long")
    assert list(failing(checks.check_unique(empty, "t", "k")).values()) == [(0, 0)]
    assert list(failing(checks.check_relationship(empty, "t", ["fk"], empty, "k")).values()) == [(0, 0)]


def test_freshness(workspace):
    ws = workspace({"Patient": [patient("a")]})
    for now, status in (("2024-01-03 01:00:00", "pass"), ("2024-01-03 03:00:00", "warn"), ("2024-01-04 01:00:00", "error")):
        rows = stages.source_freshness(ws, ["Patient", "Encounter"], F.lit(now).cast("timestamp")).collect()
        assert {r.resource_type: r.status for r in rows} == {"Patient": status, "Encounter": "error"}


def test_raw_contract(workspace):
    uri = "file:/l/2024-01-02/Patient-0000.ndjson"
    rows = [patient("a"), {"id": "b"}, {"resourceType": "Encounter", "id": "c"}, {}, {"resourceType": "Patient"}]
    ws = workspace({"Patient": [(r, DAY, uri) for r in rows]})
    row = stages.raw_contract(ws.raw("Patient")).first()
    assert (row.n_rows, row.empty_id, row.empty_type, row.wrong_type, row.empty_raw, row.ok) == (5, 2, 2, 1, 1, False)
    assert row.empty_last_updated == 4


def test_lost_rows_and_gaps(workspace):
    ws = facts(workspace, observation("a"), observation("b", subject="Patient/x"), observation("c", subject="Patient/"))
    lost = checks.check_lost_rows(
        ws.model("stg_observation_lab"), "lab", surrogate_key(F.col("patient_ref")), ws.model("omop_person")
    )
    assert list(failing(lost).values()) == [(2, 3)]
    gaps = stages.measurement_gaps(ws).first()
    assert (gaps.ok, gaps.n_rows, gaps.unknown_concept, gaps.pct_unknown_unit) == (True, 1, 1, 100.0)
    assert stages.observation_gaps(ws).first().ok is True
    assert stages.exit_counts(ws).first().ok is True


def test_required_tables(spark):
    full, empty = spark.range(1), spark.range(0)
    names = ("Patient", "Observation", "DiagnosticReport", "Specimen")
    assert stages.raw_tables({n: full for n in names}).first().ok is True
    row = stages.raw_tables({"Patient": empty, "Observation": full, "Specimen": full}).first()
    assert (row.ok, row.missing_tables, row.empty_tables) == (False, 1, 1)


def test_exit_criteria_ask_for_review_not_success(spark):
    rows = [("raw_tables", True), ("final_person_measurement", False), ("measurement_gaps", False)]
    results = spark.createDataFrame(rows, "name string, ok boolean")
    got = {r.criterion: r.passed for r in stages.exit_criteria(results, ["parse", "build", "test"]).collect()}
    assert got == {
        "raw_tables_loaded": True,
        "parse_build_test_succeeded": True,
        "person_and_measurement_filled": False,
        "unknown_rates_reviewed": False,
    }
    more = results.union(spark.createDataFrame([("observation_gaps", False)], results.schema))
    got = {r.criterion: r.passed for r in stages.exit_criteria(more, []).collect()}
    assert got["unknown_rates_reviewed"] is True and got["parse_build_test_succeeded"] is False


def test_catalogue():
    catalogue = built_in_catalogue()
    assert len(catalogue.primary_keys) == 28 and catalogue.primary_keys["note_nlp"] == "note_nlp_id"
    assert catalogue.required("measurement") == [
        "measurement_id",
        "person_id",
        "measurement_concept_id",
        "measurement_date",
        "measurement_type_concept_id",
    ]
    links = {(f.table, f.column, f.parent) for f in catalogue.foreign_keys}
    assert ("measurement", "operator_concept_id", "concept") in links
    assert ("fact_relationship", "domain_concept_id_1", "concept") in links
    assert ("concept", "vocabulary_id", "vocabulary") in links
    assert ("measurement", "measurement_id", "measurement") not in links
    assert ("concept", "concept_id", "concept") not in links


def test_catalogue_from_field_level_csv(spark, tmp_path):
    path = tmp_path / "fields.csv"
    path.write_text(
        "cdmTableName,cdmFieldName,isRequired,cdmDatatype,userGuidance,isPrimaryKey,isForeignKey,fkTableName,fkFieldName\n"
        'death,person_id,Yes,integer,"one, with\na break",No,Yes,PERSON,PERSON_ID\n'
        "death,death_date,Yes,date,,No,No,NA,NA\n"
        "note,note_id,Yes,integer,,Yes,No,NA,NA\n"
        'note,"""offset""",No,varchar(50),,No,No,NA,NA\n'
    )
    catalogue = catalogue_from_csv(spark, str(path))
    assert catalogue.required("death") == ["person_id", "death_date"]
    assert catalogue.primary_keys == {"note": "note_id"}
    assert [(f.table, f.column, f.parent, f.parent_column) for f in catalogue.foreign_keys] == [
        ("death", "person_id", "person", "person_id")
    ]


def test_conform_reports_differences(workspace):
    ws = facts(workspace, observation("a"))
    conformed, report = checks.conform_to_cdm(ws.model("omop_measurement"), "measurement", built_in_catalogue())
    assert conformed.schema.names == built_in_catalogue().schemas["measurement"].names
    assert {(r.column_name, r.finding) for r in report.collect()} == {
        ("specimen_id", "extra"),
        ("_loaded_at", "extra"),
        ("unit_source_concept_id", "missing"),
        ("measurement_event_id", "missing"),
        ("meas_event_field_concept_id", "missing"),
    }


def test_ambiguous_keys(workspace):
    ws = facts(workspace)
    got = ambiguous_keys(ws.seed("unit"), {"unit": F.lower("source_unit")}, "target_concept_id").collect()
    assert got == []
    got = ambiguous_keys(ws.model("loinc_lookup"), {"code": F.col("concept_code")}).collect()
    assert [(r.code, r.n_values) for r in got] == [("3-1", 2)]


def stored_vocabulary(spark, root):
    for name, schema in VOCABULARY_SCHEMAS.items():
        rows = []
        day = dt.date(1970, 1, 1)
        if name == "concept":
            rows = [(i, n, "d", v, "c", s, code, day, day, bad) for i, n, v, s, code, bad in CONCEPTS]
        elif name == "concept_relationship":
            rows = [(a, b, "Maps to", day, day, None) for a, b in MAPS]
        elif name == "vocabulary":
            rows = [("LOINC", "LOINC", None, "2.77", 1)]
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/vocabulary/{name}")


def test_two_days_from_landing_to_report(spark, tmp_path):
    root = str(tmp_path / "lake")
    stored_vocabulary(spark, root)
    landing = land(tmp_path, "Patient-0000.ndjson", [patient("p", birthDate="1980-01-01")])
    land(tmp_path, "Observation-0000.ndjson", [observation("a", valueString="1"), observation("b", valueString="2")])
    land(tmp_path, "Specimen-0000.ndjson", [resource("Specimen", "s", subject={"reference": "Patient/p"})])
    land(tmp_path, "DiagnosticReport-0000.ndjson", [resource("DiagnosticReport", "r", subject={"reference": "Patient/p"}, effectiveDateTime=UPDATED)])
    first = run_day(spark, landing, root, DAY, full_refresh=True)
    bad = {(r.check, r.table_name, r.column_name): r.failed for r in first.collect() if r.failed}
    assert ("unique", "omop_measurement", "measurement_id") not in bad
    assert not [key for key in bad if key[0] in ("relationship", "key_collision")]
    assert bad[("required_field", "visit_detail", "visit_occurrence_id")] == 1
    assert not [key for key in bad if key[0] == "freshness"]
    stored = {r["criterion"]: r["passed"] for r in spark.read.json(f"{root}/verdicts").filter(f"run_date = '{DAY}'").collect()}
    assert len(stored) == 4 and stored["raw_tables_loaded"]

    later = "2024-02-01T00:00:00Z"
    land(tmp_path, "Observation-0000.ndjson", [observation("b", updated=later, valueString="3", effectiveDateTime="2024-01-31T00:00:00Z"), observation("c", updated=later)], "2024-02-01")
    load_run(spark, landing, "2024-02-01", f"{root}/raw")
    build(Workspace.at(spark, root), root)
    ws = Workspace.at(spark, root)
    adopt_stored(ws, f"{root}/staging", f"{root}/cdm")
    rows = ws.model("omop_measurement").select("measurement_date", "value_source_value").collect()
    assert sorted((str(r[0]), str(r[1])) for r in rows) == [("2024-01-01", "1"), ("2024-01-01", "None"), ("2024-01-31", "3")]
    assert {r.criterion: r.passed for r in verdicts(ws, ["parse", "build", "test"]).collect()} == {
        "raw_tables_loaded": True,
        "parse_build_test_succeeded": True,
        "person_and_measurement_filled": True,
        "unknown_rates_reviewed": True,
    }


def test_stream_takes_each_file_once(spark, tmp_path):
    landing = land(tmp_path, "Patient-0000.ndjson", [{"id": "1"}, ""])
    path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    land_available(spark, landing, "Patient", path, checkpoint).awaitTermination()
    land(tmp_path, "Patient-0000.ndjson", [json.dumps({"id": "2"})], "2024-01-03")
    for _ in range(2):
        land_available(spark, landing, "Patient", path, checkpoint).awaitTermination()
    rows = spark.read.parquet(path).select("resource_id", "_ingest_run_date").collect()
    assert sorted((r[0], str(r[1])) for r in rows) == [("1", "2024-01-02"), ("2", "2024-01-03")]


def test_streamed_and_batch_loads_share_a_table(spark, tmp_path):
    landing = land(tmp_path, "Patient-0000.ndjson", [{"id": "1"}])
    land(tmp_path, "Patient-0001.ndjson", [{"id": "1b"}])
    root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    rows = lambda: sorted((r[0], str(r[1])) for r in spark.read.parquet(f"{root}/Patient").select("resource_id", "_ingest_run_date").collect())
    land_available(spark, landing, "Patient", f"{root}/Patient", checkpoint).awaitTermination()
    land(tmp_path, "Patient-0000.ndjson", [{"id": "2"}], "2024-01-03")
    load_run(spark, landing, "2024-01-03", root)
    assert rows() == [("1", DAY), ("1b", DAY), ("2", "2024-01-03")]
    land(tmp_path, "Patient-0000.ndjson", [{"id": "1 again"}])
    load_run(spark, landing, DAY, root)
    assert rows() == [("1 again", DAY), ("1b", DAY), ("2", "2024-01-03")]
    land_available(spark, landing, "Patient", f"{root}/Patient", checkpoint).awaitTermination()
    assert rows() == [("1 again", DAY), ("1b", DAY), ("2", "2024-01-03")]


def test_files_in_folders_of_a_day_are_loaded(spark, tmp_path):
    landing = land(tmp_path, "Patient-0000.ndjson", [{"id": "1"}])
    nested = tmp_path / "landing" / DAY / "part"
    folder = next(p for p in tmp_path.rglob("Patient-0000.ndjson")).parent / "part"
    del nested
    folder.mkdir()
    (folder / "Patient-0001.ndjson").write_text(json.dumps({"id": "2", "resourceType": "Patient"}) + "\n")
    load_run(spark, landing, DAY, str(tmp_path / "raw"))
    assert {r[0] for r in spark.read.parquet(str(tmp_path / "raw" / "Patient")).select("resource_id").collect()} == {"1", "2"}
    # The stream sees the same files, and their day.
    land_available(spark, landing, "Patient", str(tmp_path / "streamed"), str(tmp_path / "checkpoint")).awaitTermination()
    assert {(r[0], str(r[1])) for r in spark.read.parquet(str(tmp_path / "streamed")).select("resource_id", "_ingest_run_date").collect()} == {("1", DAY), ("2", DAY)}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_dates_fail_and_small_decimals_are_plain_in_any_session(spark, ansi):
    from assaylake.functions.scalars import decimal_text
    from assaylake.sources.vocabulary import vocabulary_date

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = ["0", "0.00000005", "-0.5", "12.340000000", "-7", "123456789012345678901.000000001"]
        df = spark.createDataFrame([(v,) for v in values], "v string").select(decimal_text(F.col("v").cast("decimal(38,9)")))
        assert [r[0] for r in df.collect()] == ["0", "0.00000005", "-0.5", "12.34", "-7", "123456789012345678901.000000001"]
        days = spark.createDataFrame([("20240102",), ("2024-01-03",), (None,)], "v string").select(vocabulary_date(F.col("v")))
        assert [str(r[0]) for r in days.collect()] == ["2024-01-02", "2024-01-03", "None"]
        with pytest.raises(Exception, match="bad vocabulary date"):
            spark.createDataFrame([("2024-13-01",)], "v string").select(vocabulary_date(F.col("v"))).collect()
        with pytest.raises(Exception, match="bad lastUpdated"):
            lines = spark.createDataFrame([(json.dumps({"id": "1", "meta": {"lastUpdated": "soon"}}), "f")], "line string, file_uri string")
            raw_envelope(lines, DAY).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_maintained_observations_equal_a_full_refresh(spark, tmp_path):
    """A first run without tables, a new day, a late reload with a newer and with a lost version, a row leaving the laboratory."""
    root = str(tmp_path / "lake")
    stored_vocabulary(spark, root)
    landing = land(tmp_path, "Patient-0000.ndjson", [patient("p", birthDate="1980-01-01")])
    land(tmp_path, "Specimen-0000.ndjson", [resource("Specimen", "s", subject={"reference": "Patient/p"})])
    land(tmp_path, "DiagnosticReport-0000.ndjson", [resource("DiagnosticReport", "r", subject={"reference": "Patient/p"})])

    def observe(day, *documents):
        land(tmp_path, "Observation-0000.ndjson", list(documents), day)

    def staged(how):
        ws = Workspace.at(spark, root)
        if how == "stored":
            adopt_stored(ws, f"{root}/staging", f"{root}/cdm")
        rows = ws.model("observation_versions").select("fhir_observation_id", "is_lab", "value_string", "_loaded_at").collect()
        return sorted(tuple(map(str, r)) for r in rows)

    at = "2024-0{}-01T00:00:00Z".format
    observe(DAY, observation("a", updated=at(2), valueString="1"), observation("b", updated=at(2), valueString="2"), observation("c", updated=at(2)))
    nights = [
        (DAY, []),
        ("2024-02-01", [observation("b", updated=at(3), valueString="3"), observation("d", updated=at(3), valueString="4")]),
        (DAY, [observation("a", updated=at(2), valueString="late"), observation("e", updated=at(1), valueString="older"), observation("b", updated=at(2)), observation("c", updated=at(2))]),
        ("2024-03-01", [observation("d", updated=at(4), category="vital-signs", valueString="left")]),
        ("2024-03-01", [observation("f", updated=at(4), valueString="d is gone from this day")]),
    ]
    for number, (day, documents) in enumerate(nights):
        if documents:
            observe(day, *documents)
        if day != DAY:
            land(tmp_path, "Patient-0000.ndjson", [patient("p", birthDate="1980-01-01")], day)
        load_run(spark, landing, day, f"{root}/raw")
        ws = Workspace.at(spark, root)
        if number in (0, 2):  # whole builds around the late reload; the staged relation alone on other nights
            build(ws, root, days=[day])
        else:
            refresh_observation_versions(ws, f"{root}/staging", [day])
        assert staged("stored") == staged("whole"), day
    ws = Workspace.at(spark, root)
    adopt_stored(ws, f"{root}/staging", f"{root}/cdm")
    values = {r[0] for r in ws.model("omop_measurement").select("value_source_value").collect()}
    assert {"late", "older"} <= values
    assert completed_stages(ws, root) == []
    for ok in (True, False):
        record_stage(ws, root, "build", ok)
        record_stage(ws, root, "parse", True)
        assert completed_stages(ws, root) == (["build", "parse"] if ok else ["parse"])


def test_command_line_fails_with_the_checks(spark, tmp_path, capsys):
    from assaylake.__main__ import configured, report

    schema = "check string, table_name string, column_name string, failed long, total long"
    good = spark.createDataFrame([("unique", "t", "k", 0, 5), ("lost_at_person", "t", "p", 2, 5)], schema)
    bad = good.unionByName(spark.createDataFrame([("unique", "t", "j", 1, 5)], schema))
    assert report(good) == 0 and report(bad) == 1
    assert "unique t.j: 1 of 5" in capsys.readouterr().out
    assert configured(["salt_buckets=4", "accept_single_coding_extension=false"]).salt_buckets == 4


def test_catalogue_from_ddl(spark, tmp_path):
    (tmp_path / "tables.sql").write_text(
        """--a comment, with a comma
CREATE TABLE @cdm.DEATH (
    person_id integer NOT NULL, -- who
    death_date date NOT NULL,
    death_datetime TIMESTAMP NULL,
    note varchar(50) NULL,
    amount numeric(10,2) );
create table `lake`.provider (provider_id INT64 not null, provider_name STRING);
"""
    )
    (tmp_path / "keys.sql").write_text(
        """ALTER TABLE @cdm.provider ADD CONSTRAINT xpk_provider PRIMARY KEY NONCLUSTERED (provider_id);
ALTER TABLE @cdm.death ADD CONSTRAINT fpk_death FOREIGN KEY (person_id) REFERENCES @cdm.PERSON (PERSON_ID);
"""
    )
    found = catalogue_from_ddl(spark, str(tmp_path / "tables.sql"), str(tmp_path / "keys.sql"))
    assert [(f.name, f.dataType.typeName(), f.nullable) for f in found.schemas["death"].fields] == [
        ("person_id", "long", False),
        ("death_date", "date", False),
        ("death_datetime", "timestamp", True),
        ("note", "string", True),
        ("amount", "double", True),
    ]
    assert found.required("provider") == ["provider_id"]
    assert found.primary_keys == {"provider": "provider_id"}
    assert found.foreign_keys == (ForeignKey("death", "person_id", "person", "person_id"),)
