"""Projections, filters, joins, aggregates, windows, ordering, unions and subqueries."""

from pyspark.sql import functions as F

from assaylake.functions.json import is_laboratory, shape
from assaylake.functions.scalars import joined_key
from assaylake.operators.joins import entity_left_join, lookup_join, unique_key
from assaylake.operators.versions import high_water, latest_version, updated_since
from assaylake.plans import analyses, marts, staging
from assaylake.plans.lookups import codes
from assaylake.quality.stages import two_counts
from contract.oracle import VERSION_ORDER, key
from contract.registry import query

# ---- projections and filters -----------------------------------------------------------------

query(
    "project_rename",
    "SELECT id AS fhir_encounter_id, 'C' || o_custkey AS patient_ref, ended AS period_end, 'finished' AS status FROM encounters",
)(lambda t: t.ws.model("stg_encounter").select("fhir_encounter_id", "patient_ref", "period_end", "status"))
query("select_except", "SELECT * EXCLUDE (s_acctbal) FROM supplier")(
    # The rank that picks the newest version is dropped again.
    lambda t: latest_version(t.base("supplier").drop("s_acctbal"), "s_suppkey", ("s_name",))
)
query(
    "filter_bool",
    """SELECT oid, is_lab AS in_lab, NOT is_lab AS in_other FROM observations""",
)(
    lambda t: t.ws.model("stg_observation_lab")
    .select(F.col("fhir_observation_id").alias("oid"), F.lit(True).alias("in_lab"), F.lit(False).alias("in_other"))
    .unionByName(
        t.ws.model("stg_observation_nonlab").select(
            F.col("fhir_observation_id").alias("oid"), F.lit(False).alias("in_lab"), F.lit(True).alias("in_other")
        )
    )
)
query(
    "filter_vocab_standard",
    "SELECT code, concept_id, concept_name FROM concepts WHERE vocab = 'SNOMED' AND standard = 'S' AND invalid IS NULL",
)(
    lambda t: t.ws.model("snomed_value_lookup").select(
        F.col("concept_code").alias("code"), "concept_id", "concept_name"
    )
)
query(
    "filter_nonstandard",
    """SELECT s.code, t.concept_id FROM concepts s JOIN maps ON source = s.concept_id
        JOIN concepts t ON t.concept_id = target AND t.standard = 'S'
        WHERE s.vocab = 'LOINC' AND s.standard IS DISTINCT FROM 'S'""",
)(lambda t: _mapped(t))


def _mapped(t):
    """Codes of the LOINC lookup that come from no standard concept of their own."""
    lookup = t.ws.model("loinc_lookup")
    own = t.vocabulary("concept").filter("vocabulary_id = 'LOINC' and standard_concept = 'S'")
    own = own.select("concept_code", "concept_id")
    return lookup.join(own, ["concept_code", "concept_id"], "left_anti").select(F.col("concept_code").alias("code"), "concept_id")


query("filter_any_not_null", "SELECT id FROM patients WHERE coalesce(city, state, zip, country) IS NOT NULL")(
    lambda t: t.ws.model("stg_patient")
    .filter(F.coalesce(*marts.ADDRESS).isNotNull())
    .select(F.col("fhir_patient_id").alias("id"))
)
query("filter_not_null", "SELECT oid FROM observations WHERE encounter_ref IS NOT NULL")(
    lambda t: t.ws.model("observation_versions")
    .filter(F.col("encounter_ref").isNotNull())
    .select(F.col("fhir_observation_id").alias("oid"))
)
query("filter_in_list", "SELECT oid FROM observations WHERE is_lab")(
    # Codes and texts of a category are looked up in a list, in any case.
    lambda t: latest_version(t.raw("Observation").select("*", *shape(F.col("raw"), {"category": staging.OBSERVATION["category"]})))
    .filter(is_laboratory(F.col("category")))
    .select(F.col("resource_id").alias("oid"))
)
query(
    "filter_by_name",
    """SELECT comparator, concept_id FROM (VALUES ('lt', 4171756), ('lte', 4171754), ('gt', 4172704), ('gte', 4171755),
        ('eq', 4172703)) AS v(comparator, concept_id) WHERE EXISTS (SELECT 1 FROM part)""",
)(lambda t: t.ws.model("operator_lookup"))
query(
    "filter_high_water",
    """SELECT oid FROM observations
        WHERE l_shipdate >= (SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')""",
)(
    lambda t: updated_since(
        t.ws.model("observation_versions"),
        high_water(t.timed("Observation").filter("last_updated < timestamp'1998-01-01'"), "last_updated").scalar(),
        "_loaded_at",
    ).select(F.col("fhir_observation_id").alias("oid"))
)

# ---- joins -----------------------------------------------------------------------------------

query("inner_join_person", "SELECT o.id, p.person_id FROM encounters o JOIN persons p ON p.c_custkey = o.o_custkey")(
    lambda t: marts._with_person(t.ws, t.ws.model("stg_encounter"), "fhir_encounter_id", "stg_encounter").select(
        F.col("fhir_encounter_id").alias("id"), "person_id"
    )
)


def looked_up(t, fact, lookup, on, salts=1, bounded=True):
    return lookup_join(fact, lookup, on, {"concept_id": "concept_id"}, bounded, salts, "fhir_observation_id")


query(
    "left_join_exact",
    "SELECT o.oid, l.concept_id FROM observations o LEFT JOIN loinc_one l ON l.code = o.loinc_code",
)(
    lambda t: looked_up(
        t, t.ws.model("observation_versions"), codes(t.ws.model("loinc_lookup")), {"code": F.col("loinc_code")}
    ).select(F.col("fhir_observation_id").alias("oid"), "concept_id")
)
query(
    "left_join_lower",
    """SELECT oid, CAST(CASE WHEN unit_ucum_code IS NOT NULL THEN 8840 END AS BIGINT) AS concept_id FROM observations""",
)(
    lambda t: looked_up(
        t,
        t.ws.model("observation_versions"),
        codes(t.ws.model("ucum_lookup"), F.lower("concept_code")),
        {"code": F.lower("unit_ucum_code")},
    ).select(F.col("fhir_observation_id").alias("oid"), "concept_id")
)
# The same join on its shuffled path, for lookups too large to broadcast.
query(
    "left_join_composite",
    """SELECT o.oid, s.concept_id FROM observations o
        LEFT JOIN source_codes s ON s.system_uri = o.source_code_system AND s.code = o.source_code""",
)(
    lambda t: looked_up(
        t,
        t.ws.model("observation_versions"),
        unique_key(
            t.ws.model("source_code_lookup"), {"system": F.lower("system_uri"), "code": F.col("concept_code")}
        ),
        {"system": F.lower("source_code_system"), "code": F.col("source_code")},
        salts=4,
        bounded=False,
    ).select(F.col("fhir_observation_id").alias("oid"), "concept_id")
)
query(
    "left_join_fact",
    """SELECT o.oid, v.visit_occurrence_id FROM observations o LEFT JOIN visits v ON v.id = o.encounter_ref""",
)(
    lambda t: entity_left_join(
        t.ws.model("observation_versions").select("fhir_observation_id", "encounter_ref"),
        t.ws.model("omop_visit_occurrence").select("visit_occurrence_id", "visit_source_value"),
        "encounter_ref",
        "visit_source_value",
        "fhir_observation_id",
    ).select(F.col("fhir_observation_id").alias("oid"), "visit_occurrence_id")
)
query(
    "left_join_computed",
    f"""SELECT p.id, {key('l.address')} AS location_id FROM patients p LEFT JOIN locations l
        ON l.address = coalesce(p.city, '') || '|' || coalesce(p.state, '') || '|' || coalesce(p.zip, '') || '|'
            || coalesce(p.country, '')""",
)(lambda t: _address_join(t))


def _address_join(t):
    patients = t.ws.model("stg_patient").select("fhir_patient_id", *marts.ADDRESS)
    places = t.ws.model("omop_location").select("location_id", "location_source_value")
    address = joined_key(*[F.col(a) for a in marts.ADDRESS])
    joined = patients.withColumn("address", address).join(
        places, F.col("address") == F.col("location_source_value"), "left"
    )
    return joined.select(F.col("fhir_patient_id").alias("id"), "location_id")


query(
    "self_join_maps_to",
    """SELECT s.code, t.concept_id FROM concepts s JOIN maps ON source = s.concept_id
        JOIN concepts t ON t.concept_id = target AND t.standard = 'S'
        WHERE s.vocab = 'LOINC' AND s.standard IS DISTINCT FROM 'S'""",
)(
    lambda t: t.ws.model("loinc_lookup")
    .join(
        t.vocabulary("concept").select("concept_id", F.col("concept_code").alias("target_code")), "concept_id"
    )
    .filter(F.col("target_code") != F.col("concept_code"))
    .select(F.col("concept_code").alias("code"), "concept_id")
)
query(
    "cross_join_constant",
    "SELECT id, CAST(32817 AS BIGINT) AS visit_type_concept_id FROM encounters",
)(
    lambda t: t.ws.model("stg_encounter").select(
        F.col("fhir_encounter_id").alias("id"), F.lit(32817).cast("bigint").alias("visit_type_concept_id")
    )
)
query("lateral_unnest", "SELECT report AS id, oid FROM children")(
    lambda t: t.ws.model("stg_diagnostic_report").select(
        F.col("fhir_report_id").alias("id"), F.explode("child_observation_ids").alias("oid")
    )
)
query("lookup_chain", "SELECT * EXCLUDE (_loaded_at) FROM measurements")(
    lambda t: t.ws.model("omop_measurement").drop("_loaded_at")
)
query(
    "left_join_coverage",
    """SELECT g.loinc_code, g.n, l.concept_id FROM (SELECT loinc_code, count(*) AS n FROM observations WHERE is_lab
        GROUP BY 1) g LEFT JOIN loinc_one l ON l.code = g.loinc_code""",
)(lambda t: _coverage(t))


def _coverage(t):
    groups = t.ws.model("stg_observation_lab").groupBy("loinc_code").agg(F.count("*").alias("n"))
    loinc = codes(t.ws.model("loinc_lookup"))
    return groups.join(loinc, groups["loinc_code"] == loinc["code"], "left").select("loinc_code", "n", "concept_id")


# ---- aggregates and windows ------------------------------------------------------------------

query(
    "group_count",
    """SELECT loinc_code, source_code, source_code_system, source_code_display, count(*) AS n_rows
        FROM observations WHERE is_lab GROUP BY 1, 2, 3, 4""",
)(lambda t: analyses.source_code_groups(t.ws.model("stg_observation_lab")))
query(
    "group_two_aggs",
    """SELECT source_code_system, count(*) AS n_codes, CAST(sum(n) AS BIGINT) AS n_rows FROM (
        SELECT source_code_system, source_code, count(*) AS n FROM observations WHERE is_lab GROUP BY 1, 2) GROUP BY 1""",
)(
    lambda t: analyses.source_code_groups(t.ws.model("stg_observation_lab"))
    .groupBy("source_code_system")
    .agg(F.count("*").alias("n_codes"), F.sum("n_rows").alias("n_rows"))
)
query("global_count", "SELECT count(*) AS n FROM lineitem")(lambda t: t.raw("Observation").agg(F.count("*").alias("n")))
query(
    "count_if",
    """SELECT count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (nullif(l_linenumber, 7) > 3) AS late
        FROM lineitem""",
)(
    lambda t: t.base("lineitem").agg(
        F.count_if(F.col("l_returnflag") == "A").alias("a"),
        F.count_if(F.nullif(F.col("l_linenumber"), F.lit(7)) > 3).alias("late"),
    )
)
query("global_max", "SELECT max(l_shipdate) AS mark, DATE '2024-01-02' AS run_date FROM lineitem")(
    lambda t: t.raw("Observation").agg(
        F.max("last_updated").alias("mark"), F.max("_ingest_run_date").alias("run_date")
    )
)
query("distinct_rows", "SELECT city, state, zip, country FROM locations")(
    lambda t: t.ws.model("omop_location").select("city", "state", "zip", F.col("country_source_value").alias("country"))
)
query("latest_version", f"""SELECT oid, l_shipdate AS last_updated FROM versions
    QUALIFY row_number() OVER (PARTITION BY oid ORDER BY {VERSION_ORDER}) = 1""")(
    lambda t: latest_version(t.raw("Observation")).select(F.col("resource_id").alias("oid"), "last_updated")
)
query(
    "latest_version_tiebreak",
    "SELECT id, gender, DATE '2024-01-02' AS run_date FROM patients",
)(
    lambda t: latest_version(
        t.raw("Patient").select(
            "resource_id", "last_updated", "_ingest_run_date", "_ingest_file_uri",
            F.try_variant_get("raw", "$.gender", "string").alias("gender"),
        )
    ).select(F.col("resource_id").alias("id"), "gender", F.col("_ingest_run_date").alias("run_date"))
)
query(
    "latest_version_by_user",
    """SELECT user_id, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)(lambda t: latest_version(t.base("events"), "user_id", ("ts", "event_id")).select("user_id", "event_id"))
query(
    "share_of_total",
    """SELECT l_returnflag, count(*) AS n, 100.0 * count(*) / sum(count(*)) OVER () AS pct FROM lineitem GROUP BY 1""",
)(
    lambda t: analyses.share_of_total(
        t.base("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n")), "n", "pct"
    )
)

# ---- ordering, unions, subqueries --------------------------------------------------------------

query("order_by", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey")(
    lambda t: t.base("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey")
)
query(
    "limit_one_correlated",
    "SELECT id, identifier_value FROM patients",
)(
    lambda t: t.ws.model("stg_patient").select(F.col("fhir_patient_id").alias("id"), "identifier_value")
)
query(
    "union_all_lookup",
    """SELECT vocab AS vocabulary_id, count(*) AS n_codes, CAST(sum(concept_id) AS DOUBLE) AS ids
        FROM source_codes GROUP BY 1""",
)(
    lambda t: t.ws.model("source_code_lookup")
    .groupBy("vocabulary_id")
    .agg(F.count("*").alias("n_codes"), F.sum("concept_id").cast("double").alias("ids"))
)
query(
    "union_all_metrics",
    """SELECT 'orders' AS table_name, 'row_count' AS metric_name, count(*) AS metric_value FROM orders
        UNION ALL SELECT 'orders', 'open_rows', count(*) FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT 'lineitem', 'row_count', count(*) FROM lineitem""",
)(
    lambda t: analyses.stack_metrics(
        t.base("orders"),
        "orders",
        {"row_count": F.count("*"), "open_rows": F.count_if(F.col("o_orderstatus") == "O")},
    ).unionByName(analyses.stack_metrics(t.base("lineitem"), "lineitem", {"row_count": F.count("*")}))
)
query(
    "union_all_inverse",
    "SELECT measurement_id AS a, specimen_id AS b FROM links UNION ALL SELECT specimen_id, measurement_id FROM links",
)(
    lambda t: t.ws.model("omop_fact_relationship").select(
        F.col("fact_id_1").alias("a"), F.col("fact_id_2").alias("b")
    )
)
query(
    "scalar_subquery",
    "SELECT n_nationkey, (SELECT max('v' || r_regionkey) FROM region) AS version FROM nation",
)(
    lambda t: t.base("nation").select(
        "n_nationkey", t.vocabulary("vocabulary").agg(F.max("vocabulary_version")).scalar().alias("version")
    )
)
query(
    "scalar_subquery_filter",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY",
)(
    lambda t: t.base("orders")
    .filter(
        F.col("o_orderdate") >= t.base("orders").agg(F.max("o_orderdate")).scalar() - F.expr("interval 30 days")
    )
    .select("o_orderkey")
)
query(
    "two_scalar_subqueries",
    """SELECT (SELECT count(*) FROM persons) AS person_rows, (SELECT count(*) FROM measurements) AS measurement_rows""",
)(
    lambda t: two_counts(
        t.ws.model("omop_person"), "person_rows", t.ws.model("omop_measurement"), "measurement_rows"
    )
)
query(
    "correlated_array_subquery",
    """SELECT id, 'P' || (o_orderkey % 3000) AS type_code, site_code FROM specimens""",
)(
    lambda t: t.ws.model("stg_specimen").select(
        F.col("fhir_specimen_id").alias("id"),
        F.col("type_snomed_code").alias("type_code"),
        F.col("body_site_snomed_code").alias("site_code"),
    )
)
query(
    "nested_exists",
    """SELECT oid, l_returnflag IN ('A', 'N') AS is_lab, l_shipdate FROM versions""",
)(
    lambda t: t.raw("Observation")
    .select(
        F.col("resource_id").alias("oid"),
        F.col("last_updated").alias("l_shipdate"),
        *shape(F.col("raw"), {"category": staging.OBSERVATION["category"]}),
    )
    .select("oid", is_laboratory(F.col("category")).alias("is_lab"), "l_shipdate")
)
# Named intermediate relations combined step by step: visits per person and class, for resolved persons.
query(
    "cte_relations",
    """SELECT person_id, class_code, count(*) AS n_visits, max(coalesce(ended, started)) AS last_end
        FROM visits GROUP BY 1, 2""",
)(lambda t: _visits_by_class(t))


def _visits_by_class(t):
    encounters = t.ws.model("stg_encounter")
    known = marts._with_person(t.ws, encounters, "fhir_encounter_id", "stg_encounter")
    return known.groupBy("person_id", "class_code").agg(
        F.count("*").alias("n_visits"), F.max(F.coalesce("period_end", "period_start")).alias("last_end")
    )
