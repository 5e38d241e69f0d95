"""Data tests and quality checks."""

from pyspark.sql import functions as F

from assaylake.config import REQUIRED_RESOURCE_TYPES, REQUIRED_VOCABULARY_TABLES, RESOURCE_TYPES
from assaylake.functions.scalars import surrogate_key
from assaylake.plans.build import MARTS, SHARED, stored_once
from assaylake.quality import checks, stages
from assaylake.schemas.cdm import built_in_catalogue
from assaylake.sources.seeds import TEST_ROWS, UNIT_ROWS
from contract.adapter import Tables
from contract.queries_models import RAW_COUNTS
from contract.registry import ORACLES, query

SEED_UNIT = f"(VALUES {', '.join(map(str, UNIT_ROWS))}) AS u(source_unit, target_concept_id)"
SEED_TEST = f"(SELECT code FROM local_tests UNION ALL SELECT c FROM (VALUES {', '.join(str((r[0],))[:-2] + ')' for r in TEST_ROWS)}) AS t(c))"

FACTS = {
    "omop_visit_occurrence": "visits",
    "omop_visit_detail": "visit_details",
    "omop_specimen": "person_specimens",
    "omop_measurement": "measurements",
    "omop_observation": "other_observations",
}
KEYED = {
    "stg_patient": ("patients", "fhir_patient_id"),
    "stg_encounter": ("encounters", "fhir_encounter_id"),
    "stg_specimen": ("specimens", "fhir_specimen_id"),
    "stg_diagnostic_report": ("reports", "fhir_report_id"),
    "stg_observation_lab": ("observations WHERE is_lab", "fhir_observation_id"),
    "stg_observation_nonlab": ("observations WHERE NOT is_lab", "fhir_observation_id"),
    "omop_person": ("persons", "person_id"),
    "omop_location": ("locations", "location_id"),
    "omop_visit_occurrence": ("visits", "visit_occurrence_id"),
    "omop_visit_detail": ("visit_details", "visit_detail_id"),
    "omop_specimen": ("person_specimens", "specimen_id"),
    "omop_measurement": ("measurements", "measurement_id"),
    "omop_observation": ("other_observations", "observation_id"),
}


def rows(check, entries):
    """SQL result rows of a check: (table, column, failed expression, source)."""
    return " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{column}' AS column_name, "
        f"CAST({failed} AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS total FROM {source}"
        for table, column, failed, source in entries
    )


# What checks of keys read of an observation, and of its references when these are joined.
OBSERVATION_KEYS = ("fhir_observation_id", "is_lab", "patient_ref", "encounter_ref", "specimen_ref")
SHARED_STAGES = ("observation_versions", "stg_encounter", "stg_specimen", "stg_diagnostic_report", "omop_person")


def staged_once(t: Tables, *more: str):
    """The stages that several marts are made of, stored once; of observations their keys and ``more``."""
    return stored_once(t.ws, SHARED_STAGES, {"observation_versions": OBSERVATION_KEYS + more})


UNIQUE = rows("unique", [(m, k, "0", src) for m, (src, k) in KEYED.items()] + [("seed_unit", "source_unit", "0", SEED_UNIT)])
query("check_unique", UNIQUE)(
    lambda t: stages.unique_checks(staged_once(t))
)
# Raw versions repeat their ids, so this one finds failures.
query(
    "check_unique_versions",
    """SELECT 'unique' AS "check", 'raw' AS table_name, 'resource_id' AS column_name, count(*) FILTER (n > 1) AS failed,
        count(*) AS total FROM (SELECT oid, count(*) AS n FROM versions GROUP BY 1)""",
)(lambda t: checks.check_unique(t.raw("Observation"), "raw", "resource_id"))

NO_BIRTH = "count(*) FILTER (birth_date IS NULL)"
NO_DATE = "count(*) FILTER (measurement_date IS NULL)"
REQUIRED = [(m, k, "0", src) for m, (src, k) in KEYED.items()]
REQUIRED += [("omop_person", "gender_concept_id", "0", "persons"), ("omop_person", "year_of_birth", NO_BIRTH, "persons")]
REQUIRED += [(m, "person_id", "0", s) for m, s in FACTS.items() if m != "omop_observation"]
REQUIRED += [
    ("omop_measurement", "measurement_concept_id", "0", "measurements"),
    ("omop_measurement", "measurement_date", NO_DATE, "measurements"),
    ("omop_measurement", "measurement_type_concept_id", "0", "measurements"),
]
REQUIRED += [("seed_unit", c, "0", SEED_UNIT) for c in ("source_unit", "target_concept_id")]
REQUIRED += [("seed_test", c, "0", SEED_TEST) for c in ("source_code", "source_code_system", "target_concept_id")]
query("check_not_null", rows("not_null", REQUIRED))(
    lambda t: stages.not_null_checks(
        staged_once(t, "loinc_code", "source_code", "source_code_system", "effective_datetime", "effective_period_start")
    )
)
query("check_relationship", rows("relationship", [(m, "person_id", "0", s) for m, s in FACTS.items()]))(
    lambda t: stages.person_relationship_checks(staged_once(t))
)
# Staged references against known patients: here orphans exist.
query(
    "check_relationship_orphans",
    """SELECT 'relationship' AS "check", 'stg_encounter' AS table_name, 'patient_ref' AS column_name,
        count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM patients)) AS failed, count(*) AS total FROM encounters""",
)(
    lambda t: checks.check_relationship(
        t.ws.model("stg_encounter"), "stg_encounter", ["patient_ref"], t.ws.model("stg_patient"), "fhir_patient_id"
    )
)
query(
    "check_key_collisions",
    """SELECT 'key_collision' AS "check", 'stg_observation' AS table_name, 'fhir_observation_id' AS column_name,
        CAST(0 AS BIGINT) AS failed, count(*) AS total FROM observations""",
)(
    lambda t: checks.check_key_collisions(
        t.ws.model("observation_versions"), "stg_observation", "fhir_observation_id"
    )
)
query(
    "check_unique_combination",
    """SELECT 'unique_combination' AS "check", 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS column_name,
        count(*) FILTER (n > 1) AS failed, count(*) AS total
        FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
)(lambda t: checks.check_unique_combination(t.base("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]))
query(
    "source_freshness",
    f"""SELECT resource_type, latest_ingest_date AS latest, CAST(30 AS DOUBLE) AS age_hours, 'warn' AS status
        FROM ({RAW_COUNTS})""",
)(
    lambda t: stages.source_freshness(
        t.ws, RESOURCE_TYPES, F.lit("2024-01-03 06:00:00").cast("timestamp")
    )
)
WRONG_ROWS = "SELECT 'Wrong', count(*), count(*), count(*), 0, 0 FROM encounters"
query(
    "check_raw_contract",
    f"""SELECT resource_type, row_count AS n_rows, 0 AS empty_id, 0 AS wrong_type, CAST(0 AS BIGINT) AS empty_raw,
        CAST(0 AS BIGINT) AS empty_last_updated FROM ({RAW_COUNTS}) UNION ALL {WRONG_ROWS}""",
)(lambda t: _contract(t))


def _contract(t):
    """Rows of every type as they are, and encounter rows without an id in a file named for another type."""
    bad = t.raw("Encounter").withColumns(
        {"resource_id": F.lit(""), "_ingest_file_uri": F.lit("file:/landing/2024-01-02/Wrong-0000.ndjson")}
    )
    for resource_type in RESOURCE_TYPES:
        bad = bad.unionByName(t.raw(resource_type))
    kind = F.regexp_extract("file_uri", "/([A-Za-z]+)-", 1)
    counts = ("n_rows", "empty_id", "wrong_type", "empty_raw", "empty_last_updated")
    return stages.raw_contract(bad).groupBy(kind.alias("resource_type")).agg(*[F.sum(c).alias(c) for c in counts])


STAGE = (
    "SELECT '{name}' AS name, true AS ok, CAST(0 AS BIGINT) AS missing_tables, CAST(0 AS BIGINT) AS empty_tables "
    "FROM {source} HAVING count(*) > 0"
)
query("check_raw_tables", STAGE.format(name="raw_tables", source="lineitem"))(
    lambda t: stages.raw_tables({n: t.raw(n) for n in REQUIRED_RESOURCE_TYPES})
)
query("check_vocab_tables", STAGE.format(name="vocab_tables", source="part"))(
    lambda t: stages.vocabulary_tables({n: t.vocabulary(n) for n in REQUIRED_VOCABULARY_TABLES})
)
query("check_omop_counts", STAGE.format(name="omop_row_counts", source="measurements"))(
    lambda t: stages.omop_counts(t.ws)
)
query(
    "measurement_gaps",
    """SELECT 'measurement_gaps' AS name, true AS ok, count(*) AS n_rows,
        count(*) FILTER (measurement_concept_id = 0) AS unknown_concept, count(*) FILTER (unit_concept_id = 0) AS unknown_unit,
        CAST(0 AS BIGINT) AS null_person, 100.0 * count(*) FILTER (measurement_concept_id = 0) / count(*) AS pct_unknown_concept,
        100.0 * count(*) FILTER (unit_concept_id = 0) / count(*) AS pct_unknown_unit FROM measurements""",
)(lambda t: stages.measurement_gaps(t.ws))
query(
    "observation_gaps",
    """SELECT 'observation_gaps' AS name, true AS ok, count(*) AS n_rows,
        count(*) FILTER (observation_concept_id = 0) AS unknown_concept,
        100.0 * count(*) FILTER (observation_concept_id = 0) / count(*) AS pct_unknown_concept FROM other_observations""",
)(lambda t: stages.observation_gaps(t.ws))
query(
    "check_exit_counts",
    """SELECT 'final_person_measurement' AS name, true AS ok, (SELECT count(*) FROM persons) AS person_rows,
        (SELECT count(*) FROM measurements) AS measurement_rows""",
)(lambda t: stages.exit_counts(t.ws))
query(
    "exit_criteria",
    """SELECT criterion, passed FROM (VALUES ('raw_tables_loaded', true), ('parse_build_test_succeeded', false),
        ('person_and_measurement_filled', true), ('unknown_rates_reviewed', true)) AS c(criterion, passed)
        WHERE EXISTS (SELECT 1 FROM measurements)""",
)(lambda t: _criteria(t))


def _criteria(t):
    named = [
        stages.raw_tables({n: t.raw(n) for n in REQUIRED_RESOURCE_TYPES}),
        stages.exit_counts(t.ws),
        stages.measurement_gaps(t.ws),
        stages.observation_gaps(t.ws),
    ]
    return stages.exit_criteria(checks.union_all(df.select("name", "ok") for df in named), ["parse", "build"])


def marts(t: Tables, *names: str):
    """The marts as a build stores them: those that others are made of, or that are read more than once, run once."""
    ws = stored_once(t.ws, [n for n in SHARED if n in MARTS or n in ("observation_versions", "stg_diagnostic_report")])
    return {n.removeprefix("omop_"): ws.model(n) for n in names or MARTS}


MART_SOURCES = {
    "person": "persons",
    "location": "locations",
    "visit_occurrence": "visits",
    "visit_detail": "visit_details",
    "specimen": "person_specimens",
    "measurement": "measurements",
    "observation": "other_observations",
    "fact_relationship": "(SELECT * FROM links UNION ALL SELECT * FROM links)",
    "cdm_source": "(SELECT 1 FROM region LIMIT 1)",
}
# Required columns that hold nulls here.
MISSING = {
    ("cdm_source", "cdm_version_concept_id"): "1",
    ("person", "year_of_birth"): NO_BIRTH,
    ("measurement", "measurement_date"): NO_DATE,
    ("observation", "observation_date"): "count(*) FILTER (observation_date IS NULL)",
    ("visit_detail", "visit_occurrence_id"): "count(*) FILTER (visit_occurrence_id IS NULL)",
}
query(
    "dq_field_nullability",
    rows(
        "required_field",
        [
            (mart, column, MISSING.get((mart, column), "0"), source)
            for mart, source in MART_SOURCES.items()
            for column in built_in_catalogue().required(mart)
        ],
    ),
)(lambda t: checks.check_required_fields(marts(t), built_in_catalogue()))

CONCEPT_IDS = (
    "SELECT concept_id FROM concepts UNION ALL SELECT * FROM (VALUES (8840), (9840), (8848), (8507), (8532), (8527), "
    "(38003563), (9201), (9202), (9203), (9204), (4171756), (4171754), (4172704), (4171755), (4172703)) AS k(concept_id)"
)
# The vocabulary tables' keys in SQL.
VOCABULARY_SOURCES = {
    "concept": f"(SELECT concept_id, 'Metadata' AS domain_id, 'LOINC' AS vocabulary_id, 'Term' AS concept_class_id FROM ({CONCEPT_IDS}))",
    "concept_relationship": """(SELECT 1000000 + p_partkey AS concept_id_1, 1000000 + p_partkey + step AS concept_id_2, 'Maps to' AS relationship_id
        FROM part, (VALUES (1), (2)) AS s(step) WHERE p_size % 5 = 0 AND (step = 1 OR p_partkey % 13 = 0))""",
    "concept_ancestor": "(SELECT 1000000 + p_partkey AS ancestor_concept_id, 1000001 + p_partkey AS descendant_concept_id FROM part)",
    "concept_synonym": "(SELECT 1000000 + p_partkey AS concept_id, 4180186 AS language_concept_id FROM part)",
    "concept_class": "(SELECT n_name AS concept_class_id, n_nationkey AS concept_class_concept_id FROM nation)",
    "domain": "(SELECT r_name AS domain_id, r_regionkey AS domain_concept_id FROM region)",
    "drug_strength": """(SELECT 1000000 + p_partkey AS drug_concept_id, 1000001 + p_partkey AS ingredient_concept_id, 8840 AS amount_unit_concept_id,
        CAST(NULL AS BIGINT) AS numerator_unit_concept_id, CAST(NULL AS BIGINT) AS denominator_unit_concept_id FROM part)""",
    "relationship": "(SELECT 'Relation ' || n_nationkey AS relationship_id, n_nationkey AS relationship_concept_id FROM nation)",
    "vocabulary": "(SELECT r_name AS vocabulary_id, r_regionkey AS vocabulary_concept_id FROM region)",
}


def source(table):
    """Rows of a mart or vocabulary table in SQL."""
    wide = {"measurement": "measurements", "observation": "other_observations"}
    return VOCABULARY_SOURCES.get(table) or wide.get(table) or f"({ORACLES['omop_' + table]})"


def every_table(t):
    return marts(t) | {name: t.vocabulary(name) for name in VOCABULARY_SOURCES}


def made(fk):
    """Whether a foreign key's columns and parent are among the tables built here."""
    tables = {m.removeprefix("omop_") for m in MARTS} | set(VOCABULARY_SOURCES)
    return fk.table in tables and fk.parent in tables and not (fk.table == "measurement" and fk.column in _NOT_MADE)


def strays(check, fk):
    return (
        f"SELECT '{check}' AS \"check\", '{fk.table}' AS table_name, '{fk.column}' AS column_name, "
        f"count(*) FILTER ({fk.column} IS NOT NULL AND {fk.column} NOT IN (SELECT p.{fk.parent_column} FROM {source(fk.parent)} AS p)) AS failed, "
        f"count({fk.column}) AS total FROM {source(fk.table)} AS c"
    )


_NOT_MADE = ("unit_source_concept_id", "measurement_event_id", "meas_event_field_concept_id")
FOREIGN = [fk for fk in built_in_catalogue().foreign_keys if made(fk)]
query(
    "dq_concept_valid", " UNION ALL ".join(strays("concept_valid", fk) for fk in FOREIGN if fk.parent == "concept" and fk.table != "concept")
)(lambda t: checks.check_concepts_valid(every_table(t), t.vocabulary("concept"), built_in_catalogue()))
query(
    "dq_date_order",
    rows(
        "date_order",
        [("visit_occurrence", "visit_start_date<=visit_end_date", "0", "visits")],
    )
    + " UNION ALL "
    + rows(
        "date_order",
        [("orders", "o_orderdate<=l_shipdate", "count(*) FILTER (l_shipdate < o_orderdate)", "versions")],
    ),
)(
    lambda t: checks.check_date_order(
        t.ws.model("omop_visit_occurrence"), "visit_occurrence", "visit_start_date", "visit_end_date"
    ).unionByName(
        checks.check_date_order(
            t.base("lineitem").join(t.base("orders"), F.col("l_orderkey") == F.col("o_orderkey")),
            "orders",
            "o_orderdate",
            "l_shipdate",
        )
    )
)
query(
    "dq_orphan_loss",
    """SELECT 'lost_at_person' AS "check", 'stg_observation_lab' AS table_name, 'patient_ref' AS column_name,
        count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM patients)) AS failed, count(*) AS total
        FROM observations WHERE is_lab""",
)(
    lambda t: checks.check_lost_rows(
        t.ws.model("stg_observation_lab"),
        "stg_observation_lab",
        surrogate_key(F.col("patient_ref")),
        t.ws.model("omop_person"),
    )
)
PRIMARY = [(m.removeprefix("omop_"), k, "0", s) for m, (s, k) in KEYED.items() if m.startswith("omop_")]
PRIMARY += [(name, built_in_catalogue().primary_keys[name], "0", src) for name, src in VOCABULARY_SOURCES.items() if name in built_in_catalogue().primary_keys]
query("cdm_primary_keys", rows("unique", PRIMARY) + " UNION ALL " + rows("not_null", PRIMARY))(
    lambda t: checks.check_primary_keys(every_table(t), built_in_catalogue())
)
query("cdm_foreign_keys", " UNION ALL ".join(strays("foreign_key", fk) for fk in FOREIGN))(
    lambda t: checks.check_foreign_keys(every_table(t), built_in_catalogue())
)
_CDM_MEASUREMENT = built_in_catalogue().schemas["measurement"].names
query(
    "conform_to_cdm",
    "SELECT "
    + ", ".join(f"CAST(NULL AS BIGINT) AS {c}" if c in _NOT_MADE else c for c in _CDM_MEASUREMENT)
    + " FROM measurements",
)(lambda t: checks.conform_to_cdm(t.ws.model("omop_measurement"), "measurement", built_in_catalogue())[0])
query(
    "conform_report",
    "SELECT 'measurement' AS table_name, c AS column_name, f AS finding FROM (VALUES ('specimen_id', 'extra'), ('_loaded_at', 'extra'), "
    + ", ".join(f"('{c}', 'missing')" for c in _NOT_MADE)
    + ") AS v(c, f) WHERE EXISTS (SELECT 1 FROM lineitem)",
)(lambda t: checks.conform_to_cdm(t.ws.model("omop_measurement"), "measurement", built_in_catalogue())[1])
