"""Staging, lookup, mart and analysis models."""

from pyspark.sql import functions as F

from assaylake.plans import analyses
from assaylake.plans.build import stored_once
from assaylake.plans.marts import omop_cdm_source
from contract.oracle import NULL_INT, NULL_TEXT, key
from contract.registry import query

TODAY = "DATE '2024-01-03'"


def model(name, sql, key_name=None):
    query(key_name or name, sql)(lambda t: t.ws.model(name))


model(
    "stg_patient",
    """SELECT id AS fhir_patient_id, gender, birth_date, deceased_datetime, deceased_bool, identifier_value,
        identifier_system, city AS address_city, state AS address_state, zip AS address_postal_code,
        country AS address_country, race AS race_code, ethnicity AS ethnicity_code,
        TIMESTAMP '2024-01-01 00:00:00' AS _loaded_at FROM patients""",
)
model(
    "stg_encounter",
    """SELECT id AS fhir_encounter_id, 'C' || o_custkey AS patient_ref, started AS period_start, ended AS period_end,
        class_code, 'urn:visit-class' AS class_system, 'finished' AS status, provider AS service_provider_ref,
        started AS _loaded_at FROM encounters""",
)
model(
    "stg_specimen",
    """SELECT id AS fhir_specimen_id, 'C' || o_custkey AS patient_ref, collected AS collection_datetime,
        o_orderdate AS collection_period_start, type_code AS type_snomed_code, 'Tube' AS type_display,
        site_code AS body_site_snomed_code, 'available' AS status, o_orderdate AS _loaded_at FROM specimens""",
)
# Arrays are compared as text, joined in order.
query(
    "stg_diagnostic_report",
    """SELECT r.id AS fhir_report_id, 'C' || o_custkey AS patient_ref, r.encounter_ref,
        taken AS effective_datetime, issued AS issued_datetime, code AS report_loinc_code, display AS report_display,
        coalesce((SELECT string_agg(oid, ',' ORDER BY oid) FROM children c WHERE c.report = r.id), '')
            AS child_observation_ids,
        'final' AS status, taken AS _loaded_at FROM reports r""",
)(
    lambda t: t.ws.model("stg_diagnostic_report").withColumn(
        "child_observation_ids", F.array_join("child_observation_ids", ",")
    )
)
model(
    "stg_observation_lab",
    """SELECT oid AS fhir_observation_id, patient_ref, encounter_ref, specimen_ref, loinc_code, source_code,
        source_code_system, source_code_display,
        CASE WHEN l_linestatus = 'F' THEN taken END AS effective_datetime,
        CASE WHEN l_linestatus <> 'F' THEN taken END AS effective_period_start,
        l_shipdate + INTERVAL 1 DAY AS issued_datetime, value_number, comparator, unit_source, unit_ucum_code,
        unit_system, value_snomed_code AS value_codeable_snomed_code, value_display AS value_codeable_display,
        value_string, l_discount AS range_low, l_tax AS range_high, interpretation AS interpretation_code,
        performer AS performer_ref, 'final' AS status, l_shipdate AS _loaded_at
        FROM observations WHERE is_lab""",
)
model(
    "stg_observation_nonlab",
    """SELECT oid AS fhir_observation_id, patient_ref, encounter_ref, loinc_code, snomed_code, source_code,
        source_code_system, source_code_display,
        CASE WHEN l_linestatus = 'F' THEN taken END AS effective_datetime,
        CASE WHEN l_linestatus <> 'F' THEN taken END AS effective_period_start,
        value_number, unit_source, unit_ucum_code, value_string, value_display AS value_codeable_display,
        value_snomed_code, l_shipdate AS _loaded_at FROM observations WHERE NOT is_lab""",
)
model("loinc_lookup", "SELECT code AS concept_code, concept_id, concept_name, 'S' AS standard_concept FROM loinc")
# The small vocabularies are literals; the row counts of the coded ones show that the whole table was read.
query(
    "ucum_lookup",
    """SELECT concept_code, CAST(concept_id AS BIGINT) AS concept_id, concept_name, n_units FROM (VALUES
        ('mg/dL', 8840, 'milligram per deciliter'), ('MG/DL', 9840, 'spelled in capitals'),
        ('10*9/L', 8848, 'thousand per microliter')) AS u(concept_code, concept_id, concept_name)
        LEFT JOIN (SELECT unit_ucum_code, count(*) AS n_units FROM observations GROUP BY 1) n
            ON n.unit_ucum_code = concept_code""",
)(
    lambda t: t.ws.model("ucum_lookup").join(
        t.ws.model("observation_versions")
        .groupBy(F.col("unit_ucum_code").alias("concept_code"))
        .agg(F.count("*").alias("n_units")),
        "concept_code",
        "left",
    )
)
model(
    "snomed_value_lookup",
    """SELECT code AS concept_code, concept_id, concept_name FROM concepts
        WHERE vocab = 'SNOMED' AND standard = 'S' AND invalid IS NULL""",
)
query(
    "operator_lookup",
    """SELECT o.comparator, CAST(concept_id AS BIGINT) AS concept_id, n_rows FROM (VALUES ('lt', '<', 4171756),
        ('lte', '<=', 4171754), ('gt', '>', 4172704), ('gte', '>=', 4171755), ('eq', '=', 4172703))
        AS o(comparator, symbol, concept_id)
        LEFT JOIN (SELECT comparator, count(*) AS n_rows FROM observations GROUP BY 1) n ON n.comparator = symbol""",
)(lambda t: _operators_with_rows(t))


def _operators_with_rows(t):
    from assaylake.functions.scalars import comparator_code

    used = (
        t.ws.model("observation_versions")
        .groupBy(comparator_code(F.col("comparator")).alias("comparator"))
        .agg(F.count("*").alias("n_rows"))
    )
    return t.ws.model("operator_lookup").join(used, "comparator", "left")


model(
    "source_code_lookup",
    """SELECT system_uri, code AS concept_code, concept_id, vocab AS vocabulary_id, standard AS standard_concept
        FROM source_codes""",
)
model(
    "report_child_obs", f"SELECT {key('report')} AS visit_detail_id, oid AS fhir_observation_id FROM children"
)
model(
    "omop_person",
    f"""SELECT person_id,
        CAST(CASE gender WHEN 'male' THEN 8507 WHEN 'female' THEN 8532 ELSE 0 END AS BIGINT) AS gender_concept_id,
        CAST(year(birth_date) AS BIGINT) AS year_of_birth, CAST(month(birth_date) AS BIGINT) AS month_of_birth,
        CAST(day(birth_date) AS BIGINT) AS day_of_birth, CAST(NULL AS TIMESTAMP) AS birth_datetime,
        CAST(CASE WHEN race = '2106-3' THEN 8527 ELSE 0 END AS BIGINT) AS race_concept_id,
        CAST(CASE WHEN ethnicity = '2135-2' THEN 38003563 ELSE 0 END AS BIGINT) AS ethnicity_concept_id,
        CASE WHEN coalesce(city, state, zip, country) IS NOT NULL THEN {key(
            "coalesce(city, '') || '|' || coalesce(state, '') || '|' || coalesce(zip, '') || '|' || coalesce(country, '')"
        )} END AS location_id,
        {NULL_INT} AS provider_id, {NULL_INT} AS care_site_id, coalesce(identifier_value, id) AS person_source_value,
        gender AS gender_source_value, {NULL_INT} AS gender_source_concept_id, race AS race_source_value,
        {NULL_INT} AS race_source_concept_id, ethnicity AS ethnicity_source_value,
        {NULL_INT} AS ethnicity_source_concept_id FROM persons""",
)
model(
    "omop_location",
    f"""SELECT {key('address')} AS location_id, {NULL_TEXT} AS address_1, {NULL_TEXT} AS address_2, city, state, zip,
        {NULL_TEXT} AS county, address AS location_source_value, {NULL_INT} AS country_concept_id,
        country AS country_source_value, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
        FROM locations""",
)
model(
    "omop_visit_occurrence",
    f"""SELECT visit_occurrence_id, person_id,
        CAST(CASE class_code WHEN 'P1' THEN 9201 WHEN 'P2' THEN 9202 WHEN 'P3' THEN 9203 WHEN 'P4' THEN 9204 ELSE 0 END
            AS BIGINT) AS visit_concept_id,
        CAST(started AS DATE) AS visit_start_date, started AS visit_start_datetime,
        CAST(coalesce(ended, started) AS DATE) AS visit_end_date, coalesce(ended, started) AS visit_end_datetime,
        CAST(32817 AS BIGINT) AS visit_type_concept_id, {NULL_INT} AS provider_id, {NULL_INT} AS care_site_id,
        id AS visit_source_value, {NULL_INT} AS visit_source_concept_id, {NULL_INT} AS admitted_from_concept_id,
        {NULL_TEXT} AS admitted_from_source_value, {NULL_INT} AS discharged_to_concept_id,
        {NULL_TEXT} AS discharged_to_source_value, {NULL_INT} AS preceding_visit_occurrence_id FROM visits""",
)
model(
    "omop_visit_detail",
    f"""SELECT visit_detail_id, person_id, CAST(32817 AS BIGINT) AS visit_detail_concept_id,
        CAST(taken AS DATE) AS visit_detail_start_date, taken AS visit_detail_start_datetime,
        CAST(coalesce(issued, taken) AS DATE) AS visit_detail_end_date,
        coalesce(issued, taken) AS visit_detail_end_datetime, CAST(32879 AS BIGINT) AS visit_detail_type_concept_id,
        {NULL_INT} AS provider_id, {NULL_INT} AS care_site_id, id AS visit_detail_source_value,
        {NULL_INT} AS visit_detail_source_concept_id, {NULL_INT} AS admitted_from_concept_id,
        {NULL_TEXT} AS admitted_from_source_value, {NULL_INT} AS discharged_to_concept_id,
        {NULL_TEXT} AS discharged_to_source_value, {NULL_INT} AS preceding_visit_detail_id,
        {NULL_INT} AS parent_visit_detail_id, visit_occurrence_id FROM visit_details""",
)
model(
    "omop_specimen",
    f"""SELECT specimen_id, person_id, CAST(coalesce(t.concept_id, 0) AS BIGINT) AS specimen_concept_id,
        CAST(581378 AS BIGINT) AS specimen_type_concept_id, CAST(o_orderdate AS DATE) AS specimen_date,
        o_orderdate AS specimen_datetime, CAST(NULL AS DOUBLE) AS quantity, {NULL_INT} AS unit_concept_id,
        CAST(coalesce(s.concept_id, 0) AS BIGINT) AS anatomic_site_concept_id, {NULL_INT} AS disease_status_concept_id,
        id AS specimen_source_id, type_code AS specimen_source_value, {NULL_TEXT} AS unit_source_value,
        site_code AS anatomic_site_source_value, {NULL_TEXT} AS disease_status_source_value
        FROM person_specimens LEFT JOIN snomed_standard t ON t.code = type_code
        LEFT JOIN snomed_standard s ON s.code = site_code""",
)
model("omop_measurement", "SELECT * FROM measurements")
model("omop_observation", "SELECT * FROM other_observations")
model(
    "omop_fact_relationship",
    """SELECT CAST(21 AS BIGINT) AS domain_concept_id_1, measurement_id AS fact_id_1,
        CAST(36 AS BIGINT) AS domain_concept_id_2, specimen_id AS fact_id_2,
        CAST(32676 AS BIGINT) AS relationship_concept_id FROM links
        UNION ALL SELECT 36, specimen_id, 21, measurement_id, 32677 FROM links""",
)
query(
    "omop_cdm_source",
    f"""SELECT 'Clinical laboratory CDM' AS cdm_source_name, 'lab-cdm' AS cdm_source_abbreviation,
        'Unnamed site' AS cdm_holder, 'FHIR R4 bulk exports mapped to OMOP CDM v5.4' AS source_description,
        'Internal' AS source_documentation_reference, {TODAY} AS cdm_etl_reference, {TODAY} AS source_release_date,
        {TODAY} AS cdm_release_date, 'v5.4' AS cdm_version, {NULL_INT} AS cdm_version_concept_id,
        max('v' || r_regionkey) AS vocabulary_version FROM region""",
)(lambda t: omop_cdm_source(t.ws, F.lit("2024-01-03").cast("date")))
query(
    "inventory_source_codes",
    """SELECT resolution, count(*) AS n_distinct_codes, CAST(sum(n) AS BIGINT) AS n_rows,
        100.0 * sum(n) / sum(sum(n)) OVER () AS pct_rows FROM (
            SELECT CASE WHEN l.concept_id IS NOT NULL THEN 'LOINC' ELSE 'NEEDS_MAPPING' END AS resolution, g.n
            FROM (SELECT loinc_code, source_code, source_code_system, count(*) AS n FROM observations WHERE is_lab
                GROUP BY 1, 2, 3) g LEFT JOIN loinc_one l ON l.code = g.loinc_code) GROUP BY resolution""",
)(lambda t: analyses.inventory_source_codes(t.ws))

SUMMARY = """
    SELECT 'person' AS table_name, 'row_count' AS metric_name, count(*) AS metric_value FROM persons
    UNION ALL SELECT 'visit_occurrence', 'row_count', count(*) FROM visits
    UNION ALL SELECT 'visit_detail', 'row_count', count(*) FROM visit_details
    UNION ALL SELECT 'specimen', 'row_count', count(*) FROM person_specimens
    UNION ALL SELECT 'measurement', 'row_count', count(*) FROM measurements
    UNION ALL SELECT 'measurement', 'unknown_concept_rows', count(*) FROM measurements WHERE measurement_concept_id = 0
    UNION ALL SELECT 'measurement', 'unknown_unit_rows', count(*) FROM measurements WHERE unit_concept_id = 0
    UNION ALL SELECT 'measurement', 'null_visit_occurrence_rows', count(*) FROM measurements
        WHERE visit_occurrence_id IS NULL
    UNION ALL SELECT 'observation', 'row_count', count(*) FROM other_observations
    UNION ALL SELECT 'observation', 'unknown_concept_rows', count(*) FROM other_observations
        WHERE observation_concept_id = 0
    UNION ALL SELECT 'fact_relationship', 'row_count', 2 * count(*) FROM links"""
# What the summary reads of observations, and of measurements, which it reads twice.
SUMMARY_READS = {
    "observation_versions": (
        "fhir_observation_id", "is_lab", "patient_ref", "encounter_ref", "specimen_ref", "loinc_code", "snomed_code", "source_code",
        "source_code_system", "unit_source", "unit_ucum_code",
    ),
    "omop_measurement": ("measurement_id", "measurement_concept_id", "unit_concept_id", "visit_occurrence_id", "specimen_id"),
}
SUMMARY_STORED = ("observation_versions", "omop_person", "omop_visit_occurrence", "omop_specimen", "omop_measurement")
query("omop_validation_summary", SUMMARY)(
    lambda t: analyses.omop_validation_summary(stored_once(t.ws, SUMMARY_STORED, SUMMARY_READS))
)

RAW_COUNTS = """
    SELECT 'Patient' AS resource_type, count(*) + count(*) FILTER (c_custkey % 13 = 0) AS row_count,
        DATE '2024-01-02' AS latest_ingest_date FROM customer
    UNION ALL SELECT 'Encounter', count(*), DATE '2024-01-02' FROM encounters
    UNION ALL SELECT 'DiagnosticReport', count(*), DATE '2024-01-02' FROM reports
    UNION ALL SELECT 'Observation', count(*), DATE '2024-01-02' FROM lineitem
    UNION ALL SELECT 'Specimen', count(*), DATE '2024-01-02' FROM specimens
    UNION ALL SELECT 'Practitioner', count(*), DATE '2024-01-02' FROM supplier
    UNION ALL SELECT 'Organization', count(*), DATE '2024-01-02' FROM nation
    UNION ALL SELECT 'Location', count(*), DATE '2024-01-02' FROM region"""
query("raw_resource_counts", RAW_COUNTS)(lambda t: analyses.raw_resource_counts(t.ws))
