"""Raw tables: counts from footers, members of shredded documents read alone."""

import glob
import hashlib
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assaylake import Workspace
from assaylake.plans.analyses import raw_resource_counts
from assaylake.quality import stages
from assaylake.schemas.raw import RUN_DATE
from assaylake.session import EXTRACT_IN_SCAN, settings
from assaylake.sinks.raw import load_report, raw_append
from assaylake.sources.ndjson import raw_envelope

ROWS = 6000
ODD = [
    {"status": 7, "code": "no object", "subject": {"reference": ["Patient/p1"]}},
    {"status": None, "code": {"coding": {"system": "s"}}, "subject": None},
    {"status": {"deep": True}, "valueQuantity": {"value": 1.50, "unit": "mg/dL"}},
    {"valueQuantity": {"value": "12"}, "category": [{"text": "Lab"}, 3, None]},
    {"valueQuantity": {"value": 12345678901234567890.123456789}, "effectiveDateTime": "2024-01-01T00:00:00Z"},
    {},
]


def observations(n=ROWS):
    for i in range(n):
        plain = {
            "status": "final",
            "code": {"coding": [{"system": "http://loinc.org", "code": f"{i % 9}-1", "display": "d"}]},
            "subject": {"reference": f"Patient/p{i % 7}"},
            "effectiveDateTime": "2024-01-01T08:00:00Z",
            "valueQuantity": {"value": i / 4, "unit": "mg/dL"},
            "note": [{"text": hashlib.sha256(str(i).encode()).hexdigest()[:8]}],
            "performer": [{"reference": f"Practitioner/{i % 5}"}],
            "issued": f"2024-01-01T08:{i % 60:02d}:00Z",
        }
        document = ODD[i // 50 % len(ODD)] if i % 50 == 0 else plain
        yield {"resourceType": "Observation", "id": f"o{i}", "meta": {"lastUpdated": "2024-01-02T00:00:00Z"}, **document}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The same observations of two days: written as raw tables are, and with whole documents."""
    root = tmp_path_factory.mktemp("raw")
    lines = spark.createDataFrame([(json.dumps(d), "file:/x/Observation-0.ndjson") for d in observations()], "line string, file_uri string")
    day = F.when(F.col("line").contains('"id": "o1'), "2024-01-01").otherwise("2024-01-02")
    rows = raw_envelope(lines, day).coalesce(2)
    with settings(spark, {EXTRACT_IN_SCAN: "true"}):
        raw_append(rows, f"{root}/shredded/raw/Observation")
    raw_append(rows, f"{root}/whole/raw/Observation")
    return root


def bytes_read(spark, df):
    """Bytes the scan of a query takes from storage, as its tasks report them."""
    with settings(spark, {"parquet.hadoop.vectored.io.enabled": "false"}):
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"read-{id(df)}", "")
        df.collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        store = spark._jsc.sc().statusStore()
        stages_run = {s for j in tracker.getJobIdsForGroup(f"read-{id(df)}") for s in tracker.getJobInfo(j).stageIds}
        return sum(store.lastStageAttempt(s).inputBytes() for s in stages_run)


def test_documents_come_back_unchanged(spark, stored):
    whole, shredded = (spark.read.parquet(f"{stored}/{kind}/raw/Observation") for kind in ("whole", "shredded"))
    text = [df.select("resource_id", F.to_json("raw").alias("t")) for df in (whole, shredded)]
    assert text[0].count() == ROWS and text[0].exceptAll(text[1]).isEmpty() and text[1].exceptAll(text[0]).isEmpty()
    names = {pq.ParquetFile(f).metadata.row_group(0).column(i).path_in_schema for f in glob.glob(f"{stored}/shredded/raw/Observation/*/*.parquet") for i in range(12)}
    assert any(n.startswith("raw.typed_value.") for n in names)


@pytest.mark.parametrize("in_scan", ["true", "false"])
def test_staged_rows_do_not_depend_on_the_layout(spark, stored, in_scan):
    with settings(spark, {EXTRACT_IN_SCAN: in_scan}):
        compare_layouts(spark, stored)


def compare_layouts(spark, stored):
    one, two = (Workspace.at(spark, f"{stored}/{kind}").model("observation_versions") for kind in ("whole", "shredded"))
    assert one.columns == two.columns and one.count() == ROWS
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_shredded_documents_take_fewer_bytes_to_read(spark, stored):
    def codes(kind):
        raw = Workspace.at(spark, f"{stored}/{kind}").raw("Observation")
        return raw.select(F.try_variant_get("raw", "$.code", "variant").cast("string").alias("s")).groupBy("s").count()

    with settings(spark, {EXTRACT_IN_SCAN: "true"}):
        assert sorted(map(str, codes("whole").collect())) == sorted(map(str, codes("shredded").collect()))
        few, all_bytes = bytes_read(spark, codes("shredded")), bytes_read(spark, codes("whole"))
    assert 0 < few < 0.8 * all_bytes


def pushed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_come_from_footers(spark, stored):
    ws = Workspace.at(spark, f"{stored}/shredded")
    by_day = ws.raw_counts("Observation")
    assert {str(r[0]): r[1] for r in by_day.collect()} == {
        str(r[0]): r[1] for r in ws.raw("Observation").groupBy(RUN_DATE).count().collect()
    }
    for df in (by_day, raw_resource_counts(ws), stages.source_freshness(ws, ["Observation"], F.lit("2024-01-03").cast("timestamp"))):
        plan = pushed(df)
        assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<_ingest_run_date:date,count(*):bigint>" in plan
    counts = {r.resource_type: (r.row_count, str(r.latest_ingest_date)) for r in raw_resource_counts(ws).collect()}
    assert counts["Observation"] == (ROWS, "2024-01-02") and counts["Patient"] == (0, "None")
    assert spark.conf.get("spark.sql.sources.useV1SourceList").find("parquet") >= 0
    row = stages.stored_raw_tables(ws).first()
    assert not row.ok and row.empty_tables == 3


def test_a_load_report_opens_one_run_date(spark, stored):
    report = load_report(spark, f"{stored}/shredded/raw", ["Observation", "Patient"], "2024-01-01")
    assert {r.resource_type: r.row_count for r in report.collect()} == {"Observation": 1111, "Patient": 0}
    assert "PartitionFilters: [isnotnull(_ingest_run_date" in pushed(report)


def test_tables_given_as_readers_are_counted_by_scan(spark, stored):
    ws = Workspace(spark, lambda name: spark.read.parquet(f"{stored}/whole/raw/Observation"), lambda name: None)
    assert sum(r.row_count for r in ws.raw_counts("Observation").collect()) == ROWS
