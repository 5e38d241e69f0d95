"""Sources and sinks: each query writes whole tables to the shared scratch folder and reads them back."""

from pyspark.sql import functions as F

from assaylake.config import RESOURCE_TYPES
from assaylake.functions import json as j
from assaylake.plans.build import LAYOUT
from assaylake.quality import checks
from assaylake.schemas.raw import FILE_URI
from assaylake.schemas.raw import RUN_DATE as RUN_DATE_COLUMN
from assaylake.schemas.vocabulary import VOCABULARY_SCHEMAS, required_columns
from assaylake.session import scratch_path
from assaylake.sinks import tables as sinks
from assaylake.sinks.raw import load_report, load_run, raw_append, raw_read
from assaylake.sinks.reports import report_sink
from assaylake.sinks.upsert import upsert_partitions
from assaylake.sources import seeds
from assaylake.sources.ndjson import landing_discover, ndjson_scan, raw_envelope_quarantined
from assaylake.sources.vocabulary import bundle_counts, load_bundle, vocabulary_date, vocabulary_scan
from assaylake.workspace import Workspace
from contract.adapter import RUN_DATE
from contract.oracle import key
from contract.queries_models import RAW_COUNTS
from contract.registry import query


LINES_PER_PART = 250_000


def land(t, resource_types):
    """Landing files of these types, one folder of compressed parts per type; blank lines are mixed in."""
    root = scratch_path(t.spark, "landing")
    for name in resource_types:
        blank = F.expr("explode(case when crc32(line) % 10 = 0 then array(line, '  ') else array(concat(' ', line)) end)")
        # A compressed part is read by one task, so its lines are bounded.
        written = t.lines(name).filter(f"run_date = '{RUN_DATE}'").select(blank.alias("value")).write
        written.option("maxRecordsPerFile", LINES_PER_PART).text(f"{root}/{RUN_DATE}/{name}-0000.ndjson", compression="gzip")
    return root


query(
    "ndjson_scan",
    """SELECT oid AS resource_id, 'Observation' AS resource_type, l_shipdate AS last_updated, DATE '2024-01-02' AS run_date,
        true AS own_file, oid AS raw_id, 'Practitioner/D' || l_suppkey AS raw_performer, l_discount AS raw_low FROM versions""",
)(lambda t: _scanned(t))


def _scanned(t):
    """Every column of the raw table; the document by members of different kinds."""
    rows = ndjson_scan(t.spark, land(t, ["Observation"]), RUN_DATE, "Observation")
    return rows.select(
        "resource_id",
        "resource_type",
        "last_updated",
        F.col(RUN_DATE_COLUMN).alias("run_date"),
        F.col(FILE_URI).rlike(f"/{RUN_DATE}/Observation-0000.ndjson/part-").alias("own_file"),
        j.text(j.json_path(F.col("raw"), "id")).alias("raw_id"),
        j.text(j.json_path(F.col("raw"), "performer[0].reference")).alias("raw_performer"),
        j.number(j.json_path(F.col("raw"), "referenceRange[0].low.value")).alias("raw_low"),
    )


query(
    "ndjson_quarantine",
    "SELECT count(*) AS good, (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0) AS bad FROM specimens",
)(lambda t: _quarantine(t))


def _quarantine(t):
    broken = t.base("customer").filter("c_custkey % 3 = 0").selectExpr(
        "concat('{\"id\": \"', c_name) as line", "'file:/landing/x/Specimen-0001.ndjson' as file_uri"
    )
    good, bad = raw_envelope_quarantined(
        t.lines("Specimen").select("line", "file_uri").unionByName(broken), RUN_DATE
    )
    counts = good.select(F.lit("good").alias("kind")).unionByName(bad.select(F.lit("bad").alias("kind")))
    return counts.agg(
        F.count_if(F.col("kind") == "good").alias("good"), F.count_if(F.col("kind") == "bad").alias("bad")
    )


query(
    "raw_envelope",
    """SELECT id AS resource_id, 'Specimen' AS resource_type, o_orderdate AS last_updated, DATE '2024-01-02' AS run_date,
        'file:/landing/2024-01-02/Specimen-0000.ndjson' AS file_uri, 'available' AS status FROM specimens""",
)(
    lambda t: t.raw("Specimen").select(
        "resource_id",
        "resource_type",
        "last_updated",
        F.col(RUN_DATE_COLUMN).alias("run_date"),
        F.col("_ingest_file_uri").alias("file_uri"),
        j.text(j.json_path(F.col("raw"), "status")).alias("status"),
    )
)
query(
    "landing_discover",
    f"SELECT resource_type, true AS filled, true AS well_named FROM ({RAW_COUNTS})",
)(
    lambda t: landing_discover(t.spark, land(t, RESOURCE_TYPES), RUN_DATE)
    .groupBy("resource_type")
    .agg(
        (F.sum("length") > 0).alias("filled"),
        F.bool_and(F.expr(f"contains(path, concat('/{RUN_DATE}/', resource_type, '-0000.ndjson'))")).alias("well_named"),
    )
)
query(
    "raw_sink",
    "SELECT id AS resource_id, o_orderdate AS last_updated, DATE '2024-01-02' AS run_date, 'available' AS status FROM specimens",
)(lambda t: _raw_sink(t))


def _raw_sink(t):
    path = scratch_path(t.spark, "raw")
    raw_append(t.raw("Specimen"), path)
    return raw_read(t.spark, path).select(
        "resource_id",
        "last_updated",
        F.col(RUN_DATE_COLUMN).alias("run_date"),
        j.text(j.json_path(F.col("raw"), "status")).alias("status"),
    )


ALL_COUNTS = f"SELECT resource_type, row_count - CASE WHEN resource_type = 'Patient' THEN (SELECT count(*) FROM customer WHERE c_custkey % 13 = 0) ELSE 0 END AS row_count FROM ({RAW_COUNTS})"
query("raw_reload_idempotent", ALL_COUNTS)(lambda t: _loaded_twice(t))


def _loaded_twice(t):
    landing, root = land(t, RESOURCE_TYPES), scratch_path(t.spark, "raw")
    load_run(t.spark, landing, RUN_DATE, root)
    return load_run(t.spark, landing, RUN_DATE, root)


query(
    "raw_append_evolve",
    """SELECT id AS resource_id, CASE WHEN o_orderkey % 4 = 0 THEN 'lab-' || (o_orderkey % 3) END AS sender FROM specimens""",
)(lambda t: _evolved(t))


def _evolved(t):
    path = scratch_path(t.spark, "raw")
    number = F.substring("resource_id", 2, 20).cast("bigint")
    raw_append(t.raw("Specimen").filter(number % 4 != 0), path)
    raw_append(
        t.raw("Specimen").filter(number % 4 == 0).withColumn("sender", F.concat(F.lit("lab-"), number % 3)), path
    )
    return raw_read(t.spark, path).select("resource_id", "sender")


query("raw_load_report", ALL_COUNTS)(lambda t: _report(t))


def _report(t):
    root = scratch_path(t.spark, "raw")
    load_run(t.spark, land(t, RESOURCE_TYPES), RUN_DATE, root)
    return load_report(t.spark, root, list(RESOURCE_TYPES), RUN_DATE)


# ---- vocabulary --------------------------------------------------------------------------------


def write_vocabulary(t, names, compact_dates=True):
    """Tab-separated files with a header, unquoted, dates as eight digits."""
    root = scratch_path(t.spark, "bundle")
    for name in names:
        df = t.vocabulary(name)
        for column in [c for c in df.columns if c.endswith("_date")] if compact_dates else []:
            df = df.withColumn(column, F.date_format(column, "yyyyMMdd"))
        df.write.csv(f"{root}/{name}.csv", sep="\t", header=True, quote="", emptyValue="")
    return root


query("vocab_scan", "SELECT * FROM all_concepts")(
    lambda t: vocabulary_scan(t.spark, "concept", f"{write_vocabulary(t, ['concept'])}/concept.csv")
)
BUNDLE = """
    SELECT 'concept' AS table_name, 2 * count(*) + 16 AS row_count FROM part
    UNION ALL SELECT 'concept_relationship', count(*) + count(*) FILTER (p_partkey % 13 = 0) FROM part WHERE p_size % 5 = 0
    UNION ALL SELECT 'concept_ancestor', count(*) FROM part UNION ALL SELECT 'concept_synonym', count(*) FROM part
    UNION ALL SELECT 'concept_class', count(*) FROM nation UNION ALL SELECT 'domain', count(*) FROM region
    UNION ALL SELECT 'relationship', count(*) FROM nation
    UNION ALL SELECT 'drug_strength', count(*) FROM part UNION ALL SELECT 'vocabulary', count(*) FROM region"""
query("vocab_schemas", f"SELECT table_name, row_count AS total, CAST(0 AS BIGINT) AS failed FROM ({BUNDLE})")(
    lambda t: _schema_checks(t)
)


def _schema_checks(t):
    root = write_vocabulary(t, VOCABULARY_SCHEMAS)
    per_column = checks.union_all(
        checks.check_not_null(vocabulary_scan(t.spark, n, f"{root}/{n}.csv"), n, required_columns(n)) for n in VOCABULARY_SCHEMAS
    )
    return per_column.groupBy("table_name").agg(F.max("total").alias("total"), F.sum("failed").alias("failed"))


query("vocab_date_fix", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")(
    lambda t: t.base("orders").select(
        "o_orderkey",
        vocabulary_date(
            F.expr("date_format(o_orderdate, if(o_orderkey % 2 = 0, 'yyyyMMdd', 'yyyy-MM-dd'))")
        ).alias("day"),
    )
)
query("vocab_bundle_load", BUNDLE)(lambda t: _bundle(t))


def _bundle(t):
    root = write_vocabulary(t, VOCABULARY_SCHEMAS)
    stored, skipped = load_bundle(t.spark, lambda n: f"{root}/{n}.csv", scratch_path(t.spark, "vocabulary"))
    assert not skipped
    return bundle_counts(stored)


_SEEDS = f"""
    SELECT 'test' AS seed, code AS source, 'URN:lab:local' AS system, CAST(target AS BIGINT) AS target_concept_id,
        CAST(coalesce(source, 0) AS BIGINT) AS source_concept_id, p_name AS note
    FROM local_tests JOIN part ON code = 'P' || p_partkey
    UNION ALL SELECT 'test', * FROM (VALUES {", ".join(map(str, seeds.TEST_ROWS))}) AS v(c, s, t, z, d)
    UNION ALL SELECT 'unit', unit, NULL, target, NULL, NULL FROM (VALUES {", ".join(map(str, seeds.UNIT_ROWS))}) AS u(unit, target)"""
query("seed_scan", _SEEDS)(lambda t: _seed(t))


def _seed(t):
    """Both seeds, written as a site keeps them and read back whole."""
    path = scratch_path(t.spark, "seed")
    t.test_seed().write.csv(f"{path}/test", header=True)
    seeds.default_unit_seed(t.spark).write.csv(f"{path}/unit", header=True)
    tests = seeds.seed_scan(t.spark, f"{path}/test", seeds.TEST_SEED).select(
        F.lit("test").alias("seed"),
        F.col("source_code").alias("source"),
        F.col("source_code_system").alias("system"),
        "target_concept_id",
        "source_concept_id",
        F.col("target_description").alias("note"),
    )
    units = seeds.seed_scan(t.spark, f"{path}/unit", seeds.UNIT_SEED).select(
        F.lit("unit").alias("seed"), F.col("source_unit").alias("source"), "target_concept_id", F.col("notes").alias("note")
    )
    return tests.unionByName(units, allowMissingColumns=True)


# ---- tables ------------------------------------------------------------------------------------

query("table_scan", "SELECT id AS resource_id, o_orderdate AS last_updated FROM specimens WHERE o_orderdate >= DATE '1996-01-01'")(
    lambda t: _scan(t)
)


def _scan(t):
    """A stored raw table, read under its declared schema through a workspace."""
    root = scratch_path(t.spark, "lake")
    raw_append(t.raw("Specimen"), f"{root}/raw/Specimen")
    table = Workspace.at(t.spark, root).raw("Specimen")
    return table.filter("last_updated >= timestamp'1996-01-01'").select("resource_id", "last_updated")


query("view_sink", "SELECT site_code, count(*) AS n FROM specimens GROUP BY 1")(lambda t: _view(t))


def _view(t):
    sinks.view_sink(t.ws.model("stg_specimen"), "assaylake_stg_specimen")
    return t.spark.sql(
        "SELECT body_site_snomed_code AS site_code, count(*) AS n FROM assaylake_stg_specimen GROUP BY 1"
    )


query("table_sink", f"SELECT {key('address')} AS location_id, city, zip FROM locations")(
    lambda t: sinks.table_sink(t.ws.model("omop_location"), scratch_path(t.spark, "location")).select(
        "location_id", "city", "zip"
    )
)
query(
    "partitioned_sink",
    "SELECT specimen_id, person_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS specimen_date FROM person_specimens",
)(
    # One partition per month: thousands of days would leave a few rows in each file here.
    lambda t: sinks.partitioned_sink(
        t.ws.model("omop_specimen").withColumn("specimen_date", F.trunc("specimen_date", "month")),
        scratch_path(t.spark, "specimen"),
        *LAYOUT["omop_specimen"],
    ).select("specimen_id", "person_id", "specimen_date")
)
query(
    "incremental_sink",
    """SELECT visit_occurrence_id, CAST(date_trunc('month', started)
            + CASE WHEN o_orderkey % 9 = 0 THEN INTERVAL 100 MONTH ELSE INTERVAL 0 MONTH END AS DATE) AS visit_start_date, o_orderkey % 9 = 0 AS corrected FROM visits""",
)(lambda t: _corrected_visits(t))


def _corrected_visits(t):
    """Store two thirds of the visits, then upsert corrected and new ones."""
    number = F.substring("visit_source_value", 2, 20).cast("bigint")
    visits = (
        t.ws.model("omop_visit_occurrence")
        .withColumn("number", number)
        .withColumn("visit_start_date", F.trunc("visit_start_date", "month"))
        .select("visit_occurrence_id", "visit_start_date", "person_id", "number", F.lit(False).alias("corrected"))
    )
    path = scratch_path(t.spark, "visit_occurrence")
    target = sinks.partitioned_sink(visits.filter("number % 7 <> 0"), path, *LAYOUT["omop_visit_occurrence"])
    changed = visits.filter("number % 9 = 0 or number % 7 = 0").withColumns(
        {
            "corrected": F.expr("number % 9 = 0"),
            "visit_start_date": F.expr("if(number % 9 = 0, add_months(visit_start_date, 100), visit_start_date)"),
        }
    )
    date_column, cluster_by = LAYOUT["omop_visit_occurrence"]
    merged = upsert_partitions(path, target, changed, "visit_occurrence_id", date_column, cluster_by)
    return merged.select("visit_occurrence_id", "visit_start_date", "corrected")


query(
    "dq_report_sink",
    """SELECT 'not_null' AS "check", 'orders' AS table_name, 'o_custkey' AS column_name, CAST(0 AS BIGINT) AS failed, count(*) AS total,
        DATE '2024-01-02' AS run_date FROM orders""",
)(lambda t: _stored_report(t))


def _stored_report(t):
    path = scratch_path(t.spark, "report")
    results = checks.check_not_null(t.base("orders"), "orders", ["o_custkey"])
    for _ in range(2):
        report_sink(results, path, RUN_DATE)
    schema = "check string, table_name string, column_name string, failed bigint, total bigint, run_date date"
    return t.spark.read.schema(schema).json(path)
