"""One day from landing files to checked CDM tables, as a chain of Spark jobs."""

from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.config import REQUIRED_RESOURCE_TYPES, REQUIRED_VOCABULARY_TABLES, RESOURCE_TYPES, EngineConfig
from assaylake.functions.scalars import surrogate_key
from assaylake.plans.build import MARTS, adopt_stored, build_all, build_changes
from assaylake.plans.maintain import Lake, Report
from assaylake.quality import checks, stages
from assaylake.schemas.cdm import Catalogue, built_in_catalogue
from assaylake.schemas.vocabulary import VOCABULARY_SCHEMAS
from assaylake.session import is_stored, sized_shuffles, stored_bytes
from assaylake.sinks.raw import load_run
from assaylake.sinks.reports import report_sink
from assaylake.workspace import Workspace

START_AND_END = {
    "omop_visit_occurrence": ("visit_start_date", "visit_end_date"),
    "omop_visit_detail": ("visit_detail_start_date", "visit_detail_end_date"),
}


def build(ws: Workspace, root: str, full_refresh: bool = False, days: Sequence[str] | None = None) -> Report | None:
    """All CDM tables: by changes, or whole where a full refresh is asked for or nothing was stored before.

    ``days`` are the run dates loaded since the last build: only their raw rows are read. Without them the stored
    relations are compared with all raw rows. Returns what changed, if it went by changes.
    """
    staging, cdm = f"{root}/staging", f"{root}/cdm"
    with sized_shuffles(ws.spark, stored_bytes(ws.spark, f"{root}/raw"), ws.config.most_shuffle_partitions):
        if full_refresh or not Lake(ws, staging, cdm).exists():
            build_all(ws, staging, cdm)
            return None
        return build_changes(ws, staging, cdm, days)


def check_all(ws: Workspace, catalogue: Catalogue | None = None, now: Column | None = None) -> DataFrame:
    """Every generic check over the workspace's models: check, table_name, column_name, failed, total.

    ``now`` is the time that sources are measured against; the current one if not given.
    """
    catalogue = catalogue or built_in_catalogue()
    tables = {name.removeprefix("omop_"): ws.model(name) for name in MARTS}
    vocabulary = ws.vocabularies(VOCABULARY_SCHEMAS)
    parts = [
        stages.unique_checks(ws),
        stages.not_null_checks(ws),
        stages.person_relationship_checks(ws),
        stages.seed_combination_check(ws),
        checks.check_required_fields(tables, catalogue),
        checks.check_primary_keys(tables | vocabulary, catalogue),
        checks.check_foreign_keys(tables | vocabulary, catalogue),
        checks.check_concepts_valid(tables, ws.vocabulary("concept"), catalogue),
        checks.check_lost_rows(
            ws.model("stg_observation_lab"), "stg_observation_lab", surrogate_key(F.col("patient_ref"), ws.config), ws.model("omop_person")
        ),
        contract_failures(ws),
        stages.freshness_checks(ws, REQUIRED_RESOURCE_TYPES, F.current_timestamp() if now is None else now),
    ]
    for name, key in stages.STAGING_KEYS.items():
        parts.append(checks.check_key_collisions(ws.model(name), name, key, ws.config))
    for name, (start, end) in START_AND_END.items():
        parts.append(checks.check_date_order(ws.model(name), name.removeprefix("omop_"), start, end))
    return checks.union_all(parts)


def contract_failures(ws: Workspace) -> DataFrame:
    """Rows that break the raw contract, in the form of the generic checks."""
    parts = []
    for name in RESOURCE_TYPES:
        by_file = stages.raw_contract(ws.raw(name))
        kinds = ("empty_id", "wrong_type", "empty_raw", "empty_last_updated")
        counts = by_file.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds])
        for kind in kinds:
            row = (F.lit("raw_contract"), F.lit(name), F.lit(kind), F.col(kind).cast("long"), F.col("total").cast("long"))
            parts.append(counts.select(*[c.alias(n) for c, n in zip(row, ("check", "table_name", "column_name", "failed", "total"))]))
    return checks.union_all(parts)


# Checks whose failures are counts to look at; any other failure fails the run.
REPORTED_ONLY = ("lost_at_person", "concept_valid", "raw_contract", "freshness")


def failing(results: DataFrame) -> DataFrame:
    """Failures that must stop a chain."""
    return results.filter((F.col("failed") > 0) & ~F.col("check").isin(*REPORTED_ONLY))


def record_stage(ws: Workspace, root: str, stage: str, ok: bool) -> None:
    """Store how a stage of the chain ended; the last entry of a stage counts."""
    row = ws.spark.range(1).select(F.lit(stage).alias("stage"), F.lit(ok).alias("ok"), F.current_timestamp().alias("at"))
    row.coalesce(1).write.mode("append").json(f"{root}/stages")


def completed_stages(ws: Workspace, root: str) -> list[str]:
    """Stages whose last stored entry is a success."""
    if not is_stored(ws.spark, f"{root}/stages"):
        return []
    runs = ws.spark.read.schema("stage string, ok boolean, at timestamp").json(f"{root}/stages")
    last = runs.groupBy("stage").agg(F.max_by("ok", "at").alias("ok"))
    return sorted(r["stage"] for r in last.filter("ok").collect())  # a handful of stages


def verdicts(ws: Workspace, completed: list[str]) -> DataFrame:
    """The four exit criteria of a first run."""
    named = [
        stages.stored_raw_tables(ws),
        stages.vocabulary_tables(ws.vocabularies(REQUIRED_VOCABULARY_TABLES)),
        stages.exit_counts(ws),
        stages.measurement_gaps(ws),
        stages.observation_gaps(ws),
    ]
    return stages.exit_criteria(checks.union_all(df.select("name", "ok") for df in named), completed)


def run_day(
    spark: SparkSession,
    landing: str,
    root: str,
    run_date: str,
    config: EngineConfig | None = None,
    full_refresh: bool = False,
    **seeds: DataFrame,
) -> DataFrame:
    """Load, build, check and report one day; returns the stored check results of that day.

    ``seeds`` are the site's mappings, ``test`` and ``unit``. Every stage's end is stored, and the exit criteria as they
    stand after the day, under ``verdicts``. Sources are late as seen from the end of the day.
    """
    ws = Workspace.at(spark, root, config, **seeds)
    with recorded(ws, root, "parse"):
        load_run(spark, landing, run_date, f"{root}/raw")
    with recorded(ws, root, "build"):
        build(ws, root, full_refresh, [run_date])
    stored = Workspace.at(spark, root, config, **seeds)
    adopt_stored(stored, f"{root}/staging", f"{root}/cdm")
    end_of_day = F.lit(run_date).cast("timestamp") + F.expr("interval 1 day")
    report_sink(check_all(stored, now=end_of_day), f"{root}/quality", run_date)
    schema = "check string, table_name string, column_name string, failed long, total long, run_date date"
    results = spark.read.schema(schema).json(f"{root}/quality")
    results = results.filter(F.col("run_date") == F.lit(run_date).cast("date"))
    record_stage(ws, root, "test", failing(results).isEmpty())
    report_sink(verdicts(stored, completed_stages(stored, root)), f"{root}/verdicts", run_date)
    return results


@contextlib.contextmanager
def recorded(ws: Workspace, root: str, stage: str):
    try:
        yield
    except BaseException:
        record_stage(ws, root, stage, False)
        raise
    record_stage(ws, root, stage, True)
