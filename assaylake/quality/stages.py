"""Named stage checks: one row each with its verdict, and the first-run exit criteria."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.config import REQUIRED_RESOURCE_TYPES, REQUIRED_VOCABULARY_TABLES
from assaylake.quality.checks import check_keys, check_not_null, check_relationship, check_unique_combination, union_all
from assaylake.schemas.raw import FILE_URI, RUN_DATE
from assaylake.sources.ndjson import resource_type_of
from assaylake.workspace import Workspace

# Staging and mart columns with declared tests.
STAGING_KEYS = {
    "stg_patient": "fhir_patient_id",
    "stg_encounter": "fhir_encounter_id",
    "stg_specimen": "fhir_specimen_id",
    "stg_diagnostic_report": "fhir_report_id",
    "stg_observation_lab": "fhir_observation_id",
    "stg_observation_nonlab": "fhir_observation_id",
}
MART_KEYS = {
    "omop_person": "person_id",
    "omop_location": "location_id",
    "omop_visit_occurrence": "visit_occurrence_id",
    "omop_visit_detail": "visit_detail_id",
    "omop_specimen": "specimen_id",
    "omop_measurement": "measurement_id",
    "omop_observation": "observation_id",
}
MART_REQUIRED = {
    "omop_person": ("person_id", "gender_concept_id", "year_of_birth"),
    "omop_location": ("location_id",),
    "omop_visit_occurrence": ("visit_occurrence_id", "person_id"),
    "omop_visit_detail": ("visit_detail_id", "person_id"),
    "omop_specimen": ("specimen_id", "person_id"),
    "omop_measurement": (
        "measurement_id",
        "person_id",
        "measurement_concept_id",
        "measurement_date",
        "measurement_type_concept_id",
    ),
    "omop_observation": ("observation_id",),
}
PERSON_FACTS = (
    "omop_visit_occurrence",
    "omop_visit_detail",
    "omop_specimen",
    "omop_measurement",
    "omop_observation",
)


def unique_checks(ws: Workspace) -> DataFrame:
    keys = {**STAGING_KEYS, **MART_KEYS}
    wanted = [(name, key, ws.model(name)) for name, key in keys.items()]
    wanted.append(("seed_unit", "source_unit", ws.seed("unit")))
    return check_keys(wanted).filter("check = 'unique'")


def not_null_checks(ws: Workspace) -> DataFrame:
    wanted = {name: (key,) for name, key in STAGING_KEYS.items()} | MART_REQUIRED
    parts = [check_not_null(ws.model(name), name, columns) for name, columns in wanted.items()]
    parts.append(check_not_null(ws.seed("unit"), "seed_unit", ["source_unit", "target_concept_id"]))
    parts.append(
        check_not_null(
            ws.seed("test"), "seed_test", ["source_code", "source_code_system", "target_concept_id"]
        )
    )
    return union_all(parts)


def person_relationship_checks(ws: Workspace) -> DataFrame:
    person = ws.model("omop_person")
    return union_all(
        check_relationship(ws.model(name), name, ["person_id"], person, "person_id") for name in PERSON_FACTS
    )


def seed_combination_check(ws: Workspace) -> DataFrame:
    return check_unique_combination(ws.seed("test"), "seed_test", ["source_code", "source_code_system"])


def source_freshness(ws: Workspace, resource_types: Sequence[str], now: Column) -> DataFrame:
    """Age of each raw table in hours since its newest run date, and pass, warn or error."""
    # Hours after which a source is late, and too late.
    warn_hours, error_hours = 26, 48
    parts = [
        ws.raw_counts(t).filter("row_count > 0").agg(F.max(RUN_DATE).alias("latest")).select(F.lit(t).alias("resource_type"), "latest")
        for t in resource_types
    ]
    age = (F.unix_timestamp(now) - F.unix_timestamp(F.col("latest").cast("timestamp"))) / 3600
    aged = union_all(parts).withColumn("age_hours", age)
    status = (
        F.when(F.col("latest").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return aged.withColumn("status", status)


def freshness_checks(ws: Workspace, resource_types: Sequence[str], now: Column) -> DataFrame:
    """Late sources in the form of the generic checks: failed is 1 for one that is too late or empty."""
    aged = source_freshness(ws, resource_types, now)
    failed = F.when(F.col("status") == "error", 1).otherwise(0).cast("long")
    columns = (F.lit("freshness"), F.col("resource_type"), F.lit(RUN_DATE), failed, F.lit(1).cast("long"))
    return aged.select(*[c.alias(n) for c, n in zip(columns, ("check", "table_name", "column_name", "failed", "total"))])


def raw_contract(raw: DataFrame) -> DataFrame:
    """Contract violations per landed file. A missing update time is counted but no violation."""
    expected = resource_type_of(F.col(FILE_URI))
    empty_type = F.col("resource_type") == ""
    shape = F.schema_of_variant("raw")
    counts = raw.groupBy(F.col(FILE_URI).alias("file_uri")).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("resource_id") == "").alias("empty_id"),
        F.count_if(empty_type).alias("empty_type"),
        F.count_if(~empty_type & ~F.col("resource_type").eqNullSafe(expected)).alias("wrong_type"),
        F.count_if(shape.isin("OBJECT<>", "VOID")).alias("empty_raw"),
        F.count_if(F.col("last_updated").isNull()).alias("empty_last_updated"),
    )
    bad = F.col("empty_id") + F.col("empty_type") + F.col("wrong_type") + F.col("empty_raw")
    return counts.withColumn("ok", bad == 0)


def _present_and_filled(check: str, tables: Mapping[str, DataFrame], required: Sequence[str]) -> DataFrame:
    return _counted(check, {name: df.agg(F.count("*").alias("row_count")) for name, df in tables.items()}, required)


def _counted(check: str, counts: Mapping[str, DataFrame], required: Sequence[str]) -> DataFrame:
    """One row: how many required tables are missing or empty, and whether none is. ``counts`` hold one ``row_count`` each."""
    spark = SparkSession.active()
    found = spark.createDataFrame([], "table_name string, row_count long")
    for name, df in counts.items():
        found = found.unionByName(df.select(F.lit(name).alias("table_name"), "row_count"))
    wanted = spark.createDataFrame([(t,) for t in required], "table_name string")
    joined = wanted.join(found, "table_name", "left")
    missing = F.count_if(F.col("row_count").isNull())
    empty = F.count_if(F.col("row_count") == 0)
    return joined.agg(missing.alias("missing_tables"), empty.alias("empty_tables")).select(
        F.lit(check).alias("name"),
        ((F.col("missing_tables") + F.col("empty_tables")) == 0).alias("ok"),
        "missing_tables",
        "empty_tables",
    )


def raw_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _present_and_filled("raw_tables", tables, REQUIRED_RESOURCE_TYPES)


def stored_raw_tables(ws: Workspace) -> DataFrame:
    """As ``raw_tables`` for the workspace's own, counted from file footers; a type that was never landed counts as empty."""
    total = F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    return _counted("raw_tables", {t: ws.raw_counts(t).agg(total) for t in REQUIRED_RESOURCE_TYPES}, REQUIRED_RESOURCE_TYPES)


def vocabulary_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _present_and_filled("vocab_tables", tables, REQUIRED_VOCABULARY_TABLES)


def omop_counts(ws: Workspace) -> DataFrame:
    tables = {"person": ws.model("omop_person"), "measurement": ws.model("omop_measurement")}
    return _present_and_filled("omop_row_counts", tables, ("person", "measurement"))


def _percent(part: str, total: str) -> Column:
    return F.when(F.col(total) > 0, F.lit(100.0) * F.col(part) / F.col(total)).otherwise(0.0)


def measurement_gaps(ws: Workspace) -> DataFrame:
    """Unknown concepts and units of measurement; fails only when empty or without a person."""
    unknown = ws.config.unknown_concept_id
    counts = ws.model("omop_measurement").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("measurement_concept_id") == unknown).alias("unknown_concept"),
        F.count_if(F.col("unit_concept_id") == unknown).alias("unknown_unit"),
        F.count_if(F.col("person_id").isNull()).alias("null_person"),
    )
    return counts.select(
        F.lit("measurement_gaps").alias("name"),
        ((F.col("n_rows") > 0) & (F.col("null_person") == 0)).alias("ok"),
        "*",
        _percent("unknown_concept", "n_rows").alias("pct_unknown_concept"),
        _percent("unknown_unit", "n_rows").alias("pct_unknown_unit"),
    )


def observation_gaps(ws: Workspace) -> DataFrame:
    """Unknown concepts of observation; a high rate is reported, never failed."""
    unknown = ws.config.unknown_concept_id
    counts = ws.model("omop_observation").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("observation_concept_id") == unknown).alias("unknown_concept"),
    )
    return counts.select(
        F.lit("observation_gaps").alias("name"),
        F.lit(True).alias("ok"),
        "*",
        _percent("unknown_concept", "n_rows").alias("pct_unknown_concept"),
    )


def two_counts(left: DataFrame, left_name: str, right: DataFrame, right_name: str) -> DataFrame:
    """One row with the row counts of two tables."""
    counts = union_all(
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("t"), "n")
        for df, name in ((left, left_name), (right, right_name))
    )
    return counts.agg(*[F.max(F.when(F.col("t") == n, F.col("n"))).alias(n) for n in (left_name, right_name)])


def exit_counts(ws: Workspace) -> DataFrame:
    counts = two_counts(
        ws.model("omop_person"), "person_rows", ws.model("omop_measurement"), "measurement_rows"
    )
    return counts.select(
        F.lit("final_person_measurement").alias("name"),
        ((F.col("person_rows") > 0) & (F.col("measurement_rows") > 0)).alias("ok"),
        "person_rows",
        "measurement_rows",
    )


def exit_criteria(results: DataFrame, completed: Sequence[str]) -> DataFrame:
    """Four verdicts from named results (name, ok).

    The unknown-rate criterion asks that both gap checks were run, not that they passed.
    """

    def passed(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("name") == name, F.col("ok"))), F.lit(False))

    def present(name: str) -> Column:
        return F.count_if(F.col("name") == name) > 0

    built = {"parse", "build", "test"} <= set(completed)
    verdicts = {
        "raw_tables_loaded": passed("raw_tables"),
        "parse_build_test_succeeded": F.lit(built),
        "person_and_measurement_filled": passed("final_person_measurement"),
        "unknown_rates_reviewed": present("measurement_gaps") & present("observation_gaps"),
    }
    row = results.agg(*[v.alias(n) for n, v in verdicts.items()])
    pairs = [F.struct(F.lit(n).alias("criterion"), F.col(n).alias("passed")) for n in verdicts]
    return row.select(F.inline(F.array(*pairs)))
