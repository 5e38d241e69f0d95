"""Landing, raw tables, partitioned writes and upserts."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from assaylake.schemas.raw import RAW
from assaylake.session import INITIAL_PARTITIONS, scratch_path, scratch_root, sized_shuffles, stored_bytes
from assaylake.sinks.raw import load_run, raw_append, raw_read
from assaylake.sinks.reports import report_sink
from assaylake.sinks.tables import partitioned_sink, table_sink
from assaylake.sinks.upsert import merge_by_key, upsert_partitions
from assaylake.sources.ndjson import landing_discover, ndjson_scan, raw_envelope_quarantined
from assaylake.sources.vocabulary import load_bundle, vocabulary_scan

DAY = "2024-01-02"


def land(root, name, lines, day=DAY):
    folder = root / "landing" / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return str(root / "landing")


def test_scan_skips_blanks_and_fills_the_envelope(spark, tmp_path):
    document = {"resourceType": "Patient", "id": "1", "meta": {"lastUpdated": "2024-01-01T01:00:00+01:00"}}
    landing = land(tmp_path, "Patient-0000.ndjson", [document, "", "   ", {"gender": "male"}])
    rows = ndjson_scan(spark, landing, DAY, "Patient").withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))
    got = sorted(rows.drop("raw").collect())
    assert [r.resource_id for r in got] == ["", "1"]
    assert (got[0].resource_type, got[0].last_updated) == ("", None)
    assert got[1].last_updated == dt.datetime(2024, 1, 1)
    assert got[1]._ingest_run_date == dt.date(2024, 1, 2) and got[1]._ingest_file_uri.endswith("Patient-0000.ndjson")
    assert rows.schema.names == ["resource_id", "resource_type", "last_updated", "raw", "_ingest_run_date", "_ingest_file_uri"]
    assert rows.schema["raw"].dataType == RAW["raw"].dataType


@pytest.mark.parametrize("line", ["{bad", "[1]", "null", '"text"'])
def test_a_line_that_is_no_object_fails_or_is_set_aside(spark, tmp_path, line):
    landing = land(tmp_path, "Patient-0000.ndjson", [{"id": "1"}, line])
    with pytest.raises(Exception, match="bad NDJSON line in .*Patient-0000"):
        ndjson_scan(spark, landing, DAY, "Patient").collect()
    lines = spark.createDataFrame([('{"id": "1"}', "f"), (line, "f")], "line string, file_uri string")
    good, bad = raw_envelope_quarantined(lines, DAY)
    assert good.count() == 1 and bad.first().line == line


def test_discover_by_file_name(spark, tmp_path):
    land(tmp_path, "Patient-0000.ndjson", [{"id": "1"}])
    land(tmp_path, "Patient-0001.ndjson", [{"id": "2"}])
    land(tmp_path, "PatientLink-0000.ndjson", [{"id": "9"}])
    landing = land(tmp_path, "notes.txt", ["x"])
    found = landing_discover(spark, landing, DAY).groupBy("resource_type").count().collect()
    assert {tuple(r) for r in found} == {("Patient", 2), ("PatientLink", 1)}
    assert ndjson_scan(spark, landing, DAY, "Patient").count() == 2


def test_reload_replaces_its_own_day_only(spark, tmp_path):
    root = str(tmp_path / "raw")
    land(tmp_path, "Patient-0000.ndjson", [{"id": "1"}, {"id": "2"}])
    landing = land(tmp_path, "Patient-0000.ndjson", [{"id": "1"}], "2024-01-03")
    for _ in range(2):
        assert load_run(spark, landing, DAY, root).collect() == [("Patient", 2)]
        assert load_run(spark, landing, "2024-01-03", root).collect() == [("Patient", 1)]
    assert raw_read(spark, f"{root}/Patient").count() == 3

    land(tmp_path, "Patient-0000.ndjson", ["  "])
    land(tmp_path, "Specimen-0000.ndjson", [{"id": "s"}])
    assert dict(map(tuple, load_run(spark, landing, DAY, root).collect())) == {"Patient": 0, "Specimen": 1}
    assert [r.resource_id for r in raw_read(spark, f"{root}/Patient").collect()] == ["1"]


def test_nothing_landed_is_an_error(spark, tmp_path):
    landing = land(tmp_path, "Patient-0000.ndjson", [" "])
    with pytest.raises(RuntimeError):
        load_run(spark, landing, DAY, str(tmp_path / "raw"))


def test_append_keeps_new_columns(spark, tmp_path, workspace):
    path = str(tmp_path / "raw")
    rows = workspace({"Patient": [{"id": "1"}]}).raw("Patient")
    raw_append(rows, path)
    raw_append(rows.withColumn("sender", F.lit("x")), path)
    assert sorted(str(r.sender) for r in raw_read(spark, path).collect()) == ["None", "x"]


HEADER = "concept_id concept_name domain_id vocabulary_id concept_class_id standard_concept concept_code valid_start_date valid_end_date invalid_reason"


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "CONCEPT.csv"
    lines = [HEADER.split(), ["1", 'a "quoted" name', "d", "v", "c", "S", "x", "19700101", "2099-12-31", ""]]
    path.write_text("\n".join("\t".join(x) for x in lines) + "\n")
    row = vocabulary_scan(spark, "concept", str(path)).first()
    assert (row.concept_id, row.concept_name, row.invalid_reason) == (1, 'a "quoted" name', None)
    assert (row.valid_start_date, row.valid_end_date) == (dt.date(1970, 1, 1), dt.date(2099, 12, 31))
    stored, skipped = load_bundle(spark, lambda n: str(path) if n == "concept" else None, str(tmp_path / "v"))
    assert stored["concept"].count() == 1 and len(skipped) == 8


SCHEMA = "id long, day date, person_id long, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, dt.date(2024, 1, d) if d else None, 1, v) for i, d, v in rows], SCHEMA)


def content(df):
    return {(r.id, r.day.day if r.day else None, r.v) for r in df.collect()}


def test_upsert_moves_rows_between_days(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, [(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "d"), (5, 9, "untouched")])
    target = partitioned_sink(first, path, "day", ["person_id"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=2024-01-09").glob("*.parquet")}
    delta = frame(spark, [(1, 3, "a2"), (3, 4, "c2"), (4, 5, "d2"), (6, None, "new")])
    expected = {(1, 3, "a2"), (2, 1, "b"), (3, 4, "c2"), (4, 5, "d2"), (5, 9, "untouched"), (6, None, "new")}
    for _ in range(2):
        target = upsert_partitions(path, target, delta, "id", "day", ["person_id"])
        assert content(target) == expected
        assert content(spark.read.parquet(path)) == expected
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=2024-01-09").glob("*.parquet")}


def test_upsert_with_a_new_column_and_with_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    target = partitioned_sink(frame(spark, [(1, 1, "a"), (2, 2, "b")]), path, "day", ["person_id"])
    target = upsert_partitions(path, target, frame(spark, []), "id", "day", ["person_id"])
    assert content(target) == {(1, 1, "a"), (2, 2, "b")}
    delta = frame(spark, [(2, 2, "b2"), (3, 3, "c")]).withColumn("batch", F.lit("x"))
    merged = upsert_partitions(path, target, delta, "id", "day", ["person_id"])
    assert {(r.id, r.v, r.batch) for r in merged.collect()} == {(1, "a", None), (2, "b2", "x"), (3, "c", "x")}


def test_merge_is_idempotent(spark):
    old, new = frame(spark, [(1, 1, "a"), (2, 1, "b")]), frame(spark, [(2, 2, "c")])
    once = merge_by_key(old, new, "id")
    assert content(once) == content(merge_by_key(once, new, "id")) == {(1, 1, "a"), (2, 2, "c")}


def test_writes_spread_one_hot_day_and_keep_order(spark, tmp_path):
    rows = spark.range(20000).select(
        "id", F.lit(dt.date(2024, 1, 1)).alias("day"), (F.col("id") % 97).alias("person_id"), F.sha2(F.col("id").cast("string"), 512).alias("v")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        stored = partitioned_sink(rows, str(tmp_path / "t"), "day", ["person_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    assert len(files) > 1 and stored.count() == 20000
    people = [r.person_id for r in spark.read.parquet(str(files[0])).select("person_id").collect()]
    assert people == sorted(people)


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.parquet").write_bytes(b"12345")
    (tmp_path / "y.parquet").write_bytes(b"678")
    assert stored_bytes(spark, str(tmp_path)) == 8
    for size, most, wanted in ((8, 9, 4), (10**12, 10**6, 7451), (100 * 10**12, 10**6, 745_059), (100 * 10**12, 1000, 1000)):
        with sized_shuffles(spark, size, most) as partitions:
            assert partitions == wanted and spark.conf.get(INITIAL_PARTITIONS) == str(wanted)
        assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_scratch_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path.startswith((named or scratch_root(spark)).rstrip("/")) and path != scratch_path(spark, "x")


def test_table_and_report_sinks(spark, tmp_path):
    assert table_sink(spark.range(3).toDF("id"), str(tmp_path / "t")).count() == 3
    results = spark.createDataFrame([("c", "t", "x", 0, 1)], "check string, table_name string, column_name string, failed long, total long")
    for day in ("2024-01-02", "2024-01-03", "2024-01-03"):
        report_sink(results, str(tmp_path / "r"), day)
    assert spark.read.json(str(tmp_path / "r")).count() == 2
