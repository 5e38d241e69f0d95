"""The OMOP CDM v5.4 tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake import config as c
from assaylake.config import EngineConfig
from assaylake.functions.scalars import (
    comparator_code,
    concept,
    decimal_text,
    joined_key,
    person_source,
    surrogate_key,
    typed_null,
)
from assaylake.operators.joins import entity_left_join, in_parts, lookup_join, unique_key
from assaylake.plans.lookups import codes, standard_codes
from assaylake.plans.staging import laboratory_half, observation_versions
from assaylake.workspace import Workspace

ADDRESS = ("address_city", "address_state", "address_postal_code", "address_country")


def _or_unknown(ws: Workspace, *choices: Column) -> Column:
    return F.coalesce(*choices, concept(ws.config.unknown_concept_id))


def _look_up(
    ws: Workspace,
    fact: DataFrame,
    lookup: DataFrame,
    on: dict[str, Column],
    take: dict[str, str],
    vocabularies: tuple[str, ...],
    spread_by: str,
) -> DataFrame:
    """Vocabulary join; the concept count of its vocabularies bounds the lookup's rows."""
    bounded = ws.concept_count(*vocabularies) <= ws.config.broadcast_row_limit
    return lookup_join(fact, lookup, on, take, bounded, ws.config.salt_buckets, spread_by, grouped=True)


def _seed_bounded(ws: Workspace, seed: DataFrame) -> bool:
    limit = ws.config.broadcast_row_limit
    return seed.limit(limit + 1).count() <= limit


def _with_person(ws: Workspace, fact: DataFrame, spread_by: str, stored: str | None = None) -> DataFrame:
    """Facts whose patient reference resolves; the others are dropped. ``stored`` names the model the facts come from."""
    person = ws.model("omop_person").select("person_id")
    keyed = fact.withColumn("person_id", surrogate_key(F.col("patient_ref"), ws.config))
    heavy = ws.heavy_references(stored).get("patient_ref")
    if heavy is None:
        return keyed.join(person, "person_id")
    heavy = heavy.select(surrogate_key(F.col("key"), ws.config).alias("key"), "parts")
    keyed, person = in_parts(keyed, person, "person_id", "person_id", heavy, spread_by)
    return keyed.join(person, ["person_id", "_part"]).drop("_part")


def _address_text() -> Column:
    return joined_key(*[F.col(a) for a in ADDRESS])


def address_key(config: EngineConfig) -> Column:
    """The location of a staged patient; NULL without any address part."""
    parts = [F.nullif(F.col(a), F.lit("")) for a in ADDRESS]
    return F.when(F.coalesce(*parts).isNotNull(), surrogate_key(joined_key(*parts), config))


def _blank_as_null(patients: DataFrame) -> DataFrame:
    return patients.withColumns({a: F.nullif(F.col(a), F.lit("")) for a in ADDRESS})


def omop_location(ws: Workspace) -> DataFrame:
    """One row per distinct address. An empty part equals an absent one, as their keys are equal."""
    addresses = (
        _blank_as_null(ws.model("stg_patient").select(*ADDRESS))
        .filter(F.coalesce(*ADDRESS).isNotNull())
        .distinct()
    )
    return addresses.select(
        surrogate_key(_address_text(), ws.config).alias("location_id"),
        typed_null("string").alias("address_1"),
        typed_null("string").alias("address_2"),
        F.col("address_city").alias("city"),
        F.col("address_state").alias("state"),
        F.col("address_postal_code").alias("zip"),
        typed_null("string").alias("county"),
        _address_text().alias("location_source_value"),
        typed_null("bigint").alias("country_concept_id"),
        F.col("address_country").alias("country_source_value"),
        typed_null("double").alias("latitude"),
        typed_null("double").alias("longitude"),
    )


def omop_person(ws: Workspace) -> DataFrame:
    """One row per patient.

    The location key is computed, not joined: a location exists exactly when an address part is filled,
    and its id is the hash of the same text.
    """
    patients = _blank_as_null(ws.model("stg_patient"))
    exact, lowered = F.col("concept_code"), F.lower("concept_code")
    pid = "fhir_patient_id"
    patients = _look_up(
        ws,
        patients,
        standard_codes(ws, "Gender", lowered),
        {"code": F.lower("gender")},
        {"_gender": "concept_id"},
        ("Gender",),
        pid,
    )
    for vocabulary_id, source, out in (
        ("Race", "race_code", "_race"),
        ("Ethnicity", "ethnicity_code", "_ethnicity"),
    ):
        patients = _look_up(
            ws,
            patients,
            standard_codes(ws, vocabulary_id, exact),
            {"code": F.col(source)},
            {out: "concept_id"},
            (vocabulary_id,),
            pid,
        )
    has_address = F.coalesce(*ADDRESS).isNotNull()
    return patients.select(
        surrogate_key(F.col(pid), ws.config).alias("person_id"),
        _or_unknown(ws, F.col("_gender")).alias("gender_concept_id"),
        F.year("birth_date").cast("bigint").alias("year_of_birth"),
        F.month("birth_date").cast("bigint").alias("month_of_birth"),
        F.dayofmonth("birth_date").cast("bigint").alias("day_of_birth"),
        typed_null("timestamp").alias("birth_datetime"),
        _or_unknown(ws, F.col("_race")).alias("race_concept_id"),
        _or_unknown(ws, F.col("_ethnicity")).alias("ethnicity_concept_id"),
        F.when(has_address, surrogate_key(_address_text(), ws.config)).alias("location_id"),
        typed_null("bigint").alias("provider_id"),
        typed_null("bigint").alias("care_site_id"),
        person_source(F.coalesce("identifier_value", pid), ws.config).alias("person_source_value"),
        F.col("gender").alias("gender_source_value"),
        typed_null("bigint").alias("gender_source_concept_id"),
        F.col("race_code").alias("race_source_value"),
        typed_null("bigint").alias("race_source_concept_id"),
        F.col("ethnicity_code").alias("ethnicity_source_value"),
        typed_null("bigint").alias("ethnicity_source_concept_id"),
    )


def omop_visit_occurrence(ws: Workspace) -> DataFrame:
    visits = _look_up(
        ws,
        _with_person(ws, ws.model("stg_encounter"), "fhir_encounter_id", "stg_encounter"),
        standard_codes(ws, "Visit", F.lower("concept_code")),
        {"code": F.lower("class_code")},
        {"_visit": "concept_id"},
        ("Visit",),
        "fhir_encounter_id",
    )
    end = F.coalesce("period_end", "period_start")
    return visits.select(
        surrogate_key(F.col("fhir_encounter_id"), ws.config).alias("visit_occurrence_id"),
        "person_id",
        _or_unknown(ws, F.col("_visit")).alias("visit_concept_id"),
        F.to_date("period_start").alias("visit_start_date"),
        F.col("period_start").alias("visit_start_datetime"),
        F.to_date(end).alias("visit_end_date"),
        end.alias("visit_end_datetime"),
        concept(c.EHR_RECORD).alias("visit_type_concept_id"),
        typed_null("bigint").alias("provider_id"),
        typed_null("bigint").alias("care_site_id"),
        F.col("fhir_encounter_id").alias("visit_source_value"),
        typed_null("bigint").alias("visit_source_concept_id"),
        typed_null("bigint").alias("admitted_from_concept_id"),
        typed_null("string").alias("admitted_from_source_value"),
        typed_null("bigint").alias("discharged_to_concept_id"),
        typed_null("string").alias("discharged_to_source_value"),
        typed_null("bigint").alias("preceding_visit_occurrence_id"),
    )


def _with_visit(ws: Workspace, fact: DataFrame, spread_by: str, stored: str | None = None) -> DataFrame:
    visits = ws.model("omop_visit_occurrence").select("visit_occurrence_id", "visit_source_value")
    heavy = ws.heavy_references(stored).get("encounter_ref")
    return entity_left_join(fact, visits, "encounter_ref", "visit_source_value", spread_by, heavy)


def omop_visit_detail(ws: Workspace) -> DataFrame:
    """One row per diagnostic report of a known person."""
    reports = ws.model("stg_diagnostic_report").drop("child_observation_ids")
    reports = _with_person(ws, reports, "fhir_report_id", "stg_diagnostic_report")
    reports = _with_visit(ws, reports, "fhir_report_id", "stg_diagnostic_report")
    end = F.coalesce("issued_datetime", "effective_datetime")
    return reports.select(
        surrogate_key(F.col("fhir_report_id"), ws.config).alias("visit_detail_id"),
        "person_id",
        concept(c.EHR_RECORD).alias("visit_detail_concept_id"),
        F.to_date("effective_datetime").alias("visit_detail_start_date"),
        F.col("effective_datetime").alias("visit_detail_start_datetime"),
        F.to_date(end).alias("visit_detail_end_date"),
        end.alias("visit_detail_end_datetime"),
        concept(c.LAB_RESULT_RECORD).alias("visit_detail_type_concept_id"),
        typed_null("bigint").alias("provider_id"),
        typed_null("bigint").alias("care_site_id"),
        F.col("fhir_report_id").alias("visit_detail_source_value"),
        typed_null("bigint").alias("visit_detail_source_concept_id"),
        typed_null("bigint").alias("admitted_from_concept_id"),
        typed_null("string").alias("admitted_from_source_value"),
        typed_null("bigint").alias("discharged_to_concept_id"),
        typed_null("string").alias("discharged_to_source_value"),
        typed_null("bigint").alias("preceding_visit_detail_id"),
        typed_null("bigint").alias("parent_visit_detail_id"),
        "visit_occurrence_id",
    )


def omop_specimen(ws: Workspace) -> DataFrame:
    specimens = _with_person(ws, ws.model("stg_specimen"), "fhir_specimen_id", "stg_specimen")
    snomed = standard_codes(ws, "SNOMED", F.col("concept_code"))
    for source, out in (("type_snomed_code", "_type"), ("body_site_snomed_code", "_site")):
        specimens = _look_up(
            ws, specimens, snomed, {"code": F.col(source)}, {out: "concept_id"}, ("SNOMED",), "fhir_specimen_id"
        )
    taken = F.coalesce("collection_datetime", "collection_period_start")
    return specimens.select(
        surrogate_key(F.col("fhir_specimen_id"), ws.config).alias("specimen_id"),
        "person_id",
        _or_unknown(ws, F.col("_type")).alias("specimen_concept_id"),
        concept(c.SPECIMEN_FROM_MEASUREMENT).alias("specimen_type_concept_id"),
        F.to_date(taken).alias("specimen_date"),
        taken.alias("specimen_datetime"),
        typed_null("decimal(38,9)").alias("quantity"),
        typed_null("bigint").alias("unit_concept_id"),
        _or_unknown(ws, F.col("_site")).alias("anatomic_site_concept_id"),
        typed_null("bigint").alias("disease_status_concept_id"),
        F.col("fhir_specimen_id").alias("specimen_source_id"),
        F.col("type_snomed_code").alias("specimen_source_value"),
        typed_null("string").alias("unit_source_value"),
        F.col("body_site_snomed_code").alias("anatomic_site_source_value"),
        typed_null("string").alias("disease_status_source_value"),
    )


def _with_codes(ws: Workspace, fact: DataFrame) -> DataFrame:
    """Adds the concepts both fact tables resolve: ``_loinc``, ``_ucum``, ``_value``, ``_source``."""
    oid = "fhir_observation_id"
    fact = _look_up(
        ws,
        fact,
        codes(ws.model("loinc_lookup")),
        {"code": F.col("loinc_code")},
        {"_loinc": "concept_id"},
        ("LOINC",),
        oid,
    )
    fact = _look_up(
        ws,
        fact,
        codes(ws.model("ucum_lookup"), F.lower("concept_code")),
        {"code": F.lower("unit_ucum_code")},
        {"_ucum": "concept_id"},
        ("UCUM",),
        oid,
    )
    fact = _look_up(
        ws,
        fact,
        codes(ws.model("snomed_value_lookup")),
        {"code": F.col("value_snomed_code")},
        {"_value": "concept_id"},
        ("SNOMED",),
        oid,
    )
    source = unique_key(
        ws.model("source_code_lookup"), {"system": F.lower("system_uri"), "code": F.col("concept_code")}
    )
    return _look_up(
        ws,
        fact,
        source,
        {"system": F.lower("source_code_system"), "code": F.col("source_code")},
        {"_source": "concept_id"},
        ("LOINC", "SNOMED"),
        oid,
    )


def _with_seeds(ws: Workspace, fact: DataFrame) -> DataFrame:
    """Adds the hand mappings: ``_seed_target``, ``_seed_source``, ``_seed_unit``."""
    oid, salts = "fhir_observation_id", ws.config.salt_buckets
    tests = (
        ws.seed("test")
        .withColumn("_system", F.lower("source_code_system"))
        .dropna(subset=["source_code", "_system"])
        .groupBy("source_code", "_system")
        .agg(F.min(F.struct("target_concept_id", "source_concept_id")).alias("_pick"))
        .select("source_code", "_system", "_pick.*")
    )
    units = unique_key(ws.seed("unit"), {"unit": F.lower("source_unit")}, "target_concept_id")
    fact = lookup_join(
        fact,
        tests,
        {"source_code": F.col("source_code"), "_system": F.lower("source_code_system")},
        {"_seed_target": "target_concept_id", "_seed_source": "source_concept_id"},
        _seed_bounded(ws, ws.seed("test")),
        salts,
        oid,
        grouped=True,
    )
    return lookup_join(
        fact,
        units,
        {"unit": F.lower("unit_source")},
        {"_seed_unit": "target_concept_id"},
        _seed_bounded(ws, ws.seed("unit")),
        salts,
        oid,
        grouped=True,
    )


def _first_report(ws: Workspace) -> DataFrame:
    """One report per observation; an observation listed by several takes the least id."""
    return ws.model("report_child_obs").groupBy("fhir_observation_id").agg(F.min("visit_detail_id").alias("visit_detail_id"))


def measurement_from(ws: Workspace, lab: DataFrame, stored: str | None = None) -> DataFrame:
    """Measurement rows for these laboratory observations; ``stored`` names the model they all come from, if they do.

    The report join comes first: it is keyed like the version window below it, so it reuses that
    shuffle. Then one shuffle each for person, visit and specimen, fewer where adaptive execution
    finds the entity side small; the code lookups add none.
    """
    oid = "fhir_observation_id"
    fact = lab.withColumnRenamed("value_codeable_snomed_code", "value_snomed_code")
    fact = fact.join(_first_report(ws), oid, "left")
    fact = _with_person(ws, fact, oid, stored)
    fact = _with_seeds(ws, _with_codes(ws, fact))
    fact = _look_up(
        ws,
        fact,
        unique_key(ws.model("operator_lookup"), {"comparator": F.col("comparator")}),
        {"comparator": comparator_code(F.col("comparator"))},
        {"_operator": "concept_id"},
        ("Meas Value Operator",),
        oid,
    )
    fact = _with_visit(ws, fact, oid, stored)
    specimens = ws.model("omop_specimen").select("specimen_id", "specimen_source_id")
    heavy = ws.heavy_references(stored).get("specimen_ref")
    fact = entity_left_join(fact, specimens, "specimen_ref", "specimen_source_id", oid, heavy)

    taken = F.coalesce("effective_datetime", "effective_period_start")
    return fact.select(
        surrogate_key(F.col(oid), ws.config).alias("measurement_id"),
        "person_id",
        _or_unknown(ws, F.col("_loinc"), F.col("_seed_target")).alias("measurement_concept_id"),
        F.to_date(taken).alias("measurement_date"),
        taken.alias("measurement_datetime"),
        typed_null("string").alias("measurement_time"),
        concept(ws.config.lab_result_type_concept_id).alias("measurement_type_concept_id"),
        F.col("_operator").alias("operator_concept_id"),
        F.col("value_number").alias("value_as_number"),
        F.col("_value").alias("value_as_concept_id"),
        _or_unknown(ws, F.col("_ucum"), F.col("_seed_unit")).alias("unit_concept_id"),
        "range_low",
        "range_high",
        typed_null("bigint").alias("provider_id"),
        "visit_occurrence_id",
        "visit_detail_id",
        F.col("source_code").alias("measurement_source_value"),
        _or_unknown(ws, F.nullif(F.col("_seed_source"), concept(0)), F.col("_source")).alias(
            "measurement_source_concept_id"
        ),
        F.col("unit_source").alias("unit_source_value"),
        F.coalesce(decimal_text(F.col("value_number")), "value_string", "value_codeable_display").alias(
            "value_source_value"
        ),
        "specimen_id",
        "_loaded_at",
    )


def omop_measurement(ws: Workspace) -> DataFrame:
    return measurement_from(ws, ws.model("stg_observation_lab"), "observation_versions")


def measurement_delta(ws: Workspace, lab: DataFrame) -> DataFrame:
    """Measurement rows for a few laboratory observations, as from ``measurement_from``.

    Reports, persons, visits and specimens are first cut to those the observations refer to. The references are
    broadcast where their counted number allows it; then the whole tables are scanned but never shuffled. ``lab`` is
    read several times and should be stored.
    """
    small = lab.count() <= ws.config.broadcast_row_limit

    def cut(table: DataFrame, column: str, key: Column) -> DataFrame:
        used = lab.select(key.alias(column)).filter(F.col(column).isNotNull()).distinct()
        return table.join(F.broadcast(used) if small else used, column, "left_semi")

    reduced = {
        "report_child_obs": cut(ws.model("report_child_obs"), "fhir_observation_id", F.col("fhir_observation_id")),
        "omop_person": cut(ws.model("omop_person"), "person_id", surrogate_key(F.col("patient_ref"), ws.config)),
        "omop_visit_occurrence": cut(ws.model("omop_visit_occurrence"), "visit_source_value", F.col("encounter_ref")),
        "omop_specimen": cut(ws.model("omop_specimen"), "specimen_source_id", F.col("specimen_ref")),
    }
    return measurement_from(ws.replaced(reduced), lab)


def measurement_since(ws: Workspace, since: Column | None) -> DataFrame:
    """Measurement rows of observations updated at or after ``since``; all of them when it is None."""
    return measurement_from(ws, laboratory_half(observation_versions(ws, since)))


def omop_observation(ws: Workspace) -> DataFrame:
    oid = "fhir_observation_id"
    stored = "observation_versions"
    fact = _with_codes(ws, _with_person(ws, ws.model("stg_observation_nonlab"), oid, stored))
    fact = _look_up(
        ws,
        fact,
        codes(ws.model("snomed_value_lookup")),
        {"code": F.col("snomed_code")},
        {"_snomed": "concept_id"},
        ("SNOMED",),
        oid,
    )
    fact = _with_visit(ws, fact, oid, stored)
    taken = F.coalesce("effective_datetime", "effective_period_start")
    spoken = F.coalesce("value_string", "value_codeable_display")
    return fact.select(
        surrogate_key(F.col(oid), ws.config).alias("observation_id"),
        "person_id",
        _or_unknown(ws, F.col("_loinc"), F.col("_snomed")).alias("observation_concept_id"),
        F.to_date(taken).alias("observation_date"),
        taken.alias("observation_datetime"),
        concept(c.OBSERVATION_FROM_EHR).alias("observation_type_concept_id"),
        F.col("value_number").alias("value_as_number"),
        spoken.alias("value_as_string"),
        F.col("_value").alias("value_as_concept_id"),
        typed_null("bigint").alias("qualifier_concept_id"),
        _or_unknown(ws, F.col("_ucum")).alias("unit_concept_id"),
        typed_null("bigint").alias("provider_id"),
        "visit_occurrence_id",
        typed_null("bigint").alias("visit_detail_id"),
        F.col("source_code").alias("observation_source_value"),
        _or_unknown(ws, F.col("_source")).alias("observation_source_concept_id"),
        F.col("unit_source").alias("unit_source_value"),
        typed_null("string").alias("qualifier_source_value"),
        F.coalesce(decimal_text(F.col("value_number")), spoken).alias("value_source_value"),
        typed_null("bigint").alias("observation_event_id"),
        typed_null("bigint").alias("obs_event_field_concept_id"),
    )


def omop_fact_relationship(ws: Workspace) -> DataFrame:
    """Each measurement with its specimen, in both directions, from one pass over measurement."""
    return relationships(ws.model("omop_measurement"))


def relationships(measurements: DataFrame) -> DataFrame:
    linked = measurements.filter(F.col("specimen_id").isNotNull())

    def link(domain_1: int, fact_1: str, domain_2: int, fact_2: str, relationship: int) -> Column:
        return F.struct(
            concept(domain_1).alias("domain_concept_id_1"),
            F.col(fact_1).alias("fact_id_1"),
            concept(domain_2).alias("domain_concept_id_2"),
            F.col(fact_2).alias("fact_id_2"),
            concept(relationship).alias("relationship_concept_id"),
        )

    forth = link(c.MEASUREMENT_DOMAIN, "measurement_id", c.SPECIMEN_DOMAIN, "specimen_id", c.HAS_SPECIMEN)
    back = link(c.SPECIMEN_DOMAIN, "specimen_id", c.MEASUREMENT_DOMAIN, "measurement_id", c.SPECIMEN_OF)
    return linked.select(F.inline(F.array(forth, back)))


def omop_cdm_source(ws: Workspace, today: Column | None = None) -> DataFrame:
    """One row describing the CDM; ``today`` fixes the dates of a reproducible run."""
    info = ws.config.cdm_source
    day = F.current_date() if today is None else today
    version = ws.vocabulary("vocabulary").agg(F.max("vocabulary_version").alias("vocabulary_version"))
    return version.select(
        F.lit(info.name).alias("cdm_source_name"),
        F.lit(info.abbreviation).alias("cdm_source_abbreviation"),
        F.lit(info.holder).alias("cdm_holder"),
        F.lit(info.description).alias("source_description"),
        F.lit(info.documentation_reference).alias("source_documentation_reference"),
        day.alias("cdm_etl_reference"),
        day.alias("source_release_date"),
        day.alias("cdm_release_date"),
        F.lit(info.cdm_version).alias("cdm_version"),
        typed_null("bigint").alias("cdm_version_concept_id"),
        "vocabulary_version",
    )
