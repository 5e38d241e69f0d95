"""Code lookups over the vocabulary tables, and the report-to-observation map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.config import LOINC_URI, SNOMED_URI
from assaylake.functions.scalars import surrogate_key
from assaylake.operators.joins import unique_key
from assaylake.workspace import Workspace

JOINED_VOCABULARIES = (
    "LOINC",
    "SNOMED",
    "UCUM",
    "Gender",
    "Race",
    "Ethnicity",
    "Visit",
    "Meas Value Operator",
)

# Comparator codes and the names of their concepts.
OPERATOR_NAMES = {
    "lt": "Less than",
    "lte": "Less than or equal to",
    "gt": "Greater than",
    "gte": "Greater than or equal to",
    "eq": "Equal",
}


def _concepts(ws: Workspace, vocabulary_id: str, standard: bool = False, valid: bool = False) -> DataFrame:
    rows = ws.vocabulary("concept").filter(F.col("vocabulary_id") == vocabulary_id)
    if standard:
        rows = rows.filter(F.col("standard_concept") == "S")
    return rows.filter(F.col("invalid_reason").isNull()) if valid else rows


def loinc_lookup(ws: Workspace) -> DataFrame:
    """LOINC code to standard concept: itself, or what it maps to."""
    columns = ["concept_code", "concept_id", "concept_name", "standard_concept"]
    direct = _concepts(ws, "LOINC", standard=True).select(*columns)

    source = _concepts(ws, "LOINC").filter(
        F.col("standard_concept").isNull() | (F.col("standard_concept") != "S")
    )
    mapping = ws.vocabulary("concept_relationship").filter(
        (F.col("relationship_id") == "Maps to") & F.col("invalid_reason").isNull()
    )
    target = ws.vocabulary("concept").filter(F.col("standard_concept") == "S")
    mapped = (
        source.select("concept_code", F.col("concept_id").alias("concept_id_1"))
        .join(mapping.select("concept_id_1", "concept_id_2"), "concept_id_1")
        .join(target.select(F.col("concept_id").alias("concept_id_2"), "concept_id", "concept_name"), "concept_id_2")
        .withColumn("standard_concept", F.lit("S"))
        .select(*columns)
    )
    return direct.unionByName(mapped)


def ucum_lookup(ws: Workspace) -> DataFrame:
    return _concepts(ws, "UCUM", valid=True).select("concept_code", "concept_id", "concept_name")


def snomed_value_lookup(ws: Workspace) -> DataFrame:
    return _concepts(ws, "SNOMED", standard=True, valid=True).select(
        "concept_code", "concept_id", "concept_name"
    )


def operator_lookup(ws: Workspace) -> DataFrame:
    """Comparator code to concept, found by concept name."""
    code_of = F.create_map(*[F.lit(x) for code, name in OPERATOR_NAMES.items() for x in (name, code)])
    named = _concepts(ws, "Meas Value Operator").filter(F.col("concept_name").isin(*OPERATOR_NAMES.values()))
    return named.select(code_of[F.col("concept_name")].alias("comparator"), "concept_id")


def source_code_lookup(ws: Workspace) -> DataFrame:
    """(system URI, code) to the concept that carries exactly this code, standard or not."""
    rows = ws.vocabulary("concept").filter(
        F.col("vocabulary_id").isin("LOINC", "SNOMED") & F.col("invalid_reason").isNull()
    )
    uri = F.when(F.col("vocabulary_id") == "LOINC", LOINC_URI).otherwise(SNOMED_URI)
    return rows.select(
        uri.alias("system_uri"), "concept_code", "concept_id", "vocabulary_id", "standard_concept"
    )


def report_child_obs(ws: Workspace) -> DataFrame:
    """One row per (report, child observation)."""
    return ws.model("stg_diagnostic_report").select(
        surrogate_key(F.col("fhir_report_id"), ws.config).alias("visit_detail_id"),
        F.explode("child_observation_ids").alias("fhir_observation_id"),
    )


def standard_codes(ws: Workspace, vocabulary_id: str, code: Column) -> DataFrame:
    """(code, concept_id) of standard concepts, one row per code as normalised by ``code``."""
    return unique_key(_concepts(ws, vocabulary_id, standard=True), {"code": code})


def codes(lookup: DataFrame, code: Column | None = None) -> DataFrame:
    """(code, concept_id) of a lookup, one row per code."""
    return unique_key(lookup, {"code": F.col("concept_code") if code is None else code})
