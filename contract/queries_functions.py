"""JSON rules and scalar functions, each over a whole table."""

from pyspark.sql import functions as F

from assaylake.config import ETHNICITY_URL, LOINC_URI, RACE_URL, SNOMED_URI, EngineConfig
from assaylake.functions import json as j
from assaylake.functions import scalars as s
from assaylake.quality import stages
from assaylake.operators.versions import high_water
from contract.oracle import fingerprint_of_8_to_32, key
from contract.registry import query


def props(t):
    """Events with their properties parsed."""
    return t.base("events").withColumn("doc", F.parse_json("props"))


def event_docs(t, expression):
    """Events with a document made of one member ``x``."""
    text = F.expr(f"to_json(named_struct('x', {expression}))")
    return t.base("events").select("event_id", F.parse_json(text).alias("doc"))


# ---- JSON ------------------------------------------------------------------------------------

query(
    "json_string_lax",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS container,
        event_type AS t FROM events""",
)(
    lambda t: props(t).select(
        "event_id",
        j.text(j.json_path(F.col("doc"), "k")).alias("k"),
        # A container is no scalar.
        j.text(F.col("doc")).alias("container"),
        j.text(j.json_path(F.parse_json(F.to_json(F.struct(F.col("event_type").alias("x")))), "x")).alias("t"),
    )
)
query(
    "json_number",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value AS from_text,
        CAST(NULL AS DOUBLE) AS from_word, CAST(NULL AS DOUBLE) AS from_bool FROM events""",
)(
    lambda t: props(t)
    .withColumn(
        "other",
        F.parse_json(
            F.expr("to_json(named_struct('n', cast(value as string), 'w', event_type, 'b', event_id % 2 = 0))")
        ),
    )
    .select(
        "event_id",
        j.number(j.json_path(F.col("doc"), "k")).alias("k"),
        j.number(j.json_path(F.col("other"), "n")).alias("from_text"),
        j.number(j.json_path(F.col("other"), "w")).alias("from_word"),
        j.number(j.json_path(F.col("other"), "b")).alias("from_bool"),
    )
)
query(
    "json_bool",
    """SELECT event_id, event_id % 3 = 0 AS plain, event_id % 2 = 0 AS from_text, CAST(NULL AS BOOLEAN) AS from_word
        FROM events""",
)(
    lambda t: t.base("events")
    .withColumn(
        "doc",
        F.parse_json(
            F.expr(
                "to_json(named_struct('b', event_id % 3 = 0, 's', cast(event_id % 2 = 0 as string), 'w', event_type))"
            )
        ),
    )
    .select(
        "event_id",
        *[
            j.boolean(j.json_path(F.col("doc"), path)).alias(name)
            for path, name in (("b", "plain"), ("s", "from_text"), ("w", "from_word"))
        ],
    )
)
query(
    "json_ts",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 2 HOUR END AS parsed FROM events""",
)(
    lambda t: event_docs(
        t,
        """case event_id % 4 when 0 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
            when 1 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'000+02:00'")
            when 2 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") else date_format(ts, 'yyyy-MM-dd') end""",
    ).select("event_id", j.instant(j.json_path(F.col("doc"), "x")).alias("parsed"))
)
query(
    "json_date",
    "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN CAST(ts AS DATE) END AS parsed FROM events",
)(
    lambda t: event_docs(
        t,
        """case event_id % 4 when 0 then date_format(ts, 'yyyy-MM-dd') when 1 then date_format(ts, 'yyyy-MM')
            when 2 then date_format(ts, "yyyy-MM-dd'T'HH:mm") else concat(year(ts), '-02-30') end""",
    ).select("event_id", j.day(j.json_path(F.col("doc"), "x")).alias("parsed"))
)
query(
    "json_string_strict",
    """SELECT event_id, CAST(NULL AS VARCHAR) AS from_number, event_type AS from_text,
        CAST(NULL AS VARCHAR) AS from_nothing FROM events""",
)(
    lambda t: props(t)
    .withColumn("other", F.parse_json(F.expr("to_json(named_struct('x', event_type))")))
    .select(
        "event_id",
        j.strict_text(j.json_path(F.col("doc"), "k")).alias("from_number"),
        j.strict_text(j.json_path(F.col("other"), "x")).alias("from_text"),
        j.strict_text(j.json_path(F.col("other"), "absent")).alias("from_nothing"),
    )
)
query(
    "json_path",
    """SELECT id AS resource_id, class_code, strftime(ended, '%Y-%m-%dT%H:%M:%SZ') AS period_end,
        CAST(NULL AS VARCHAR) AS below_text FROM encounters""",
)(
    lambda t: t.raw("Encounter").select(
        "resource_id",
        j.text(j.json_path(F.col("raw"), "class.code")).alias("class_code"),
        j.text(j.json_path(F.col("raw"), "period.end")).alias("period_end"),
        j.text(j.json_path(F.col("raw"), "status.code")).alias("below_text"),
    )
)
query(
    "json_array_expand",
    """SELECT report AS resource_id, 'Observation/' || oid AS reference, 0 AS from_object FROM children""",
)(
    lambda t: t.raw("DiagnosticReport")
    .select(
        "resource_id",
        F.explode(j.json_array(F.col("raw"), "result")).alias("item"),
        F.coalesce(F.size(j.json_array(F.col("raw"), "subject")), F.lit(0)).alias("from_object"),
    )
    .select("resource_id", j.text(j.json_path(F.col("item"), "reference")).alias("reference"), "from_object")
)
query(
    "first_of_array",
    """SELECT oid || '@' || strftime(l_shipdate, '%Y-%m-%d') || '@' || l_partkey AS version, 'P' || l_partkey AS code,
        'D' || l_suppkey AS performer, CAST(NULL AS VARCHAR) AS absent FROM versions""",
)(
    lambda t: t.raw("Observation").select(
        F.concat(
            "resource_id",
            F.lit("@"),
            F.to_date("last_updated").cast("string"),
            F.lit("@"),
            F.substring(j.strict_text(j.json_path(j.first(j.json_array(F.col("raw"), "code.coding")), "code")), 2, 99),
        ).alias("version"),
        j.strict_text(j.json_path(j.first(j.json_array(F.col("raw"), "code.coding")), "code")).alias("code"),
        s.reference_id(
            j.strict_text(j.json_path(j.first(j.json_array(F.col("raw"), "performer")), "reference"))
        ).alias("performer"),
        j.strict_text(j.json_path(j.first(j.json_array(F.col("raw"), "identifier")), "value")).alias("absent"),
    )
)


def shaped(t, resource_type, member):
    from assaylake.plans import staging

    shapes = {"Observation": staging.OBSERVATION, "Patient": staging.PATIENT}[resource_type]
    return t.raw(resource_type).select(
        "resource_id", "last_updated", *j.shape(F.col("raw"), {member: shapes[member]})
    )


query(
    "coding_by_system",
    """SELECT oid AS resource_id, l_shipdate AS last_updated,
        CASE WHEN l_partkey % 5 <> 0 THEN 'P' || l_partkey END AS loinc_code,
        CASE WHEN l_partkey % 3 = 0 THEN 'P' || l_partkey END AS snomed_code FROM versions""",
)(
    lambda t: shaped(t, "Observation", "code").select(
        "resource_id",
        "last_updated",
        j.code_for_system(F.col("code")["coding"], LOINC_URI).alias("loinc_code"),
        j.code_for_system(F.col("code")["coding"], SNOMED_URI).alias("snomed_code"),
    )
)
query(
    "nested_extension_code",
    """SELECT id AS resource_id, race, ethnicity, CAST(NULL AS VARCHAR) AS array_only FROM patients UNION ALL
        SELECT id, race, ethnicity, NULL FROM patients WHERE c_custkey % 13 = 0""",
)(
    lambda t: shaped(t, "Patient", "extension").select(
        "resource_id",
        j.extension_code(F.col("extension"), RACE_URL).alias("race"),
        j.extension_code(F.col("extension"), ETHNICITY_URL).alias("ethnicity"),
        j.extension_code(F.col("extension"), RACE_URL, accept_single=False).alias("array_only"),
    )
)
query(
    "nested_first",
    "SELECT oid AS resource_id, l_shipdate AS last_updated, CASE WHEN l_tax > 0.05 THEN 'H' END AS code FROM versions",
)(
    lambda t: shaped(t, "Observation", "interpretation").select(
        "resource_id", "last_updated", j.first_nested_code(F.col("interpretation")).alias("code")
    )
)
query(
    "first_range_numeric",
    "SELECT oid AS resource_id, l_shipdate AS last_updated, l_discount AS low, l_tax AS high FROM versions",
)(
    lambda t: shaped(t, "Observation", "referenceRange").select(
        "resource_id",
        "last_updated",
        j.number(j.first(F.col("referenceRange"))["low"]["value"]).alias("low"),
        j.number(j.first(F.col("referenceRange"))["high"]["value"]).alias("high"),
    )
)
query(
    "reference_array",
    """SELECT r.id AS fhir_report_id, count(c.oid) AS n_children, min(c.oid) AS first_child, max(c.oid) AS last_child
        FROM reports r LEFT JOIN children c ON c.report = r.id GROUP BY r.id""",
)(
    lambda t: t.ws.model("stg_diagnostic_report").select(
        "fhir_report_id",
        F.size("child_observation_ids").cast("bigint").alias("n_children"),
        F.array_min("child_observation_ids").alias("first_child"),
        F.array_max("child_observation_ids").alias("last_child"),
    )
)
query(
    "is_observation_lab",
    "SELECT l_returnflag IN ('A', 'N') AS is_lab, count(*) AS n_rows FROM lineitem GROUP BY 1",
)(
    lambda t: shaped(t, "Observation", "category")
    .groupBy(j.is_laboratory(F.col("category")).alias("is_lab"))
    .agg(F.count("*").alias("n_rows"))
)

# ---- scalars ---------------------------------------------------------------------------------

query(
    "reference_id",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN 'E' || o_orderkey END AS id FROM orders""",
)(
    lambda t: t.base("orders").select(
        "o_orderkey",
        s.reference_id(
            F.expr(
                """case o_orderkey % 4 when 0 then concat('Encounter/E', o_orderkey)
                when 1 then concat('http://h/fhir/Encounter/E', o_orderkey) when 2 then concat('E', o_orderkey)
                else 'Encounter/' end"""
            )
        ).alias("id"),
    )
)
query(
    "hash_id",
    f"""SELECT o_orderkey, {key("'E' || o_orderkey")} AS id, {key("CASE WHEN o_orderkey % 3 = 0 THEN 'x' END")} AS of_null
        FROM orders""",
)(
    lambda t: t.base("orders").select(
        "o_orderkey",
        s.surrogate_key(F.concat(F.lit("E"), "o_orderkey")).alias("id"),
        s.surrogate_key(F.when(F.col("o_orderkey") % 3 == 0, "x")).alias("of_null"),
    )
)
FINGERPRINTED = """SELECT c_custkey, 'name' AS part, c_name AS t FROM customer
    UNION ALL SELECT c_custkey, 'reference', 'Patient/' || c_custkey FROM customer"""
query("hash_id_fingerprint", f"SELECT c_custkey, part, id FROM ({fingerprint_of_8_to_32(FINGERPRINTED)})")(
    lambda t: t.base("customer")
    .select("c_custkey", F.col("c_name").alias("name"), F.concat(F.lit("Patient/"), "c_custkey").alias("reference"))
    .unpivot("c_custkey", ["name", "reference"], "part", "t")
    .select("c_custkey", "part", s.surrogate_key(F.col("t"), EngineConfig(key_hash="farm")).alias("id"))
)
PEPPER = "pepper-for-tests"
query(
    "hash_mrn",
    f"""SELECT c_custkey, c_name AS plain, sha256(c_name || '{PEPPER}') AS hashed,
        sha256(coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, '') || '{PEPPER}') AS hashed_or_empty FROM customer""",
)(lambda t: _hash_mrn(t))


def _hash_mrn(t):
    hashing = EngineConfig(hash_person_source_value=True, person_source_value_pepper=PEPPER)
    name = F.col("c_name")
    return t.base("customer").select(
        "c_custkey",
        s.person_source(name, EngineConfig()).alias("plain"),
        s.person_source(name, hashing).alias("hashed"),
        s.person_source(F.when(F.col("c_custkey") % 2 == 0, name), hashing).alias("hashed_or_empty"),
    )


query(
    "coalesce_chain",
    """SELECT oid, coalesce(CASE WHEN l_partkey % 17 > 1 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END,
        CASE WHEN l_partkey % 17 = 0 THEN 'positive' END, 'Finding ' || (l_partkey % 1000)) AS shown,
        l_shipdate AS issued FROM versions""",
)(
    lambda t: t.raw("Observation").select(
        F.col("resource_id").alias("oid"),
        F.coalesce(
            s.decimal_text(j.number(j.json_path(F.col("raw"), "valueQuantity.value"))),
            j.text(j.json_path(F.col("raw"), "valueString")),
            j.text(j.json_path(F.col("raw"), "valueCodeableConcept.coding[0].display")),
        ).alias("shown"),
        F.col("last_updated").alias("issued"),
    )
)
query("nullif", "SELECT p_partkey, coalesce(nullif(p_size % 5, 0), -1) AS size FROM part")(
    lambda t: t.base("part").select(
        "p_partkey", F.coalesce(F.nullif(F.col("p_size") % 5, F.lit(0)), F.lit(-1)).alias("size")
    )
)
query("lower", "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer WHERE lower(c_name) LIKE 'customer%'")(
    lambda t: t.base("customer")
    .filter(F.lower("c_name").startswith("customer"))
    .select("c_custkey", F.lower("c_mktsegment").alias("segment"))
)
query(
    "concat_key",
    """SELECT c_custkey, c_mktsegment || '|' || coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, '') || '|'
        || coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_name END, '') || '|x' AS address FROM customer""",
)(
    lambda t: t.base("customer").select(
        "c_custkey",
        s.joined_key(
            F.col("c_mktsegment"),
            F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")),
            F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")),
            F.lit("x"),
        ).alias("address"),
    )
)
query(
    "case_simple",
    """SELECT comparator, CASE comparator WHEN '<' THEN 'lt' WHEN '<=' THEN 'lte' WHEN '>' THEN 'gt'
        WHEN '>=' THEN 'gte' WHEN '=' THEN 'eq' END AS code, count(*) AS n_rows FROM observations GROUP BY 1, 2""",
)(
    lambda t: t.ws.model("observation_versions")
    .groupBy("comparator", s.comparator_code(F.col("comparator")).alias("code"))
    .agg(F.count("*").alias("n_rows"))
)
query(
    "case_searched",
    """SELECT o.oid, CASE WHEN l.concept_id IS NOT NULL THEN 'LOINC' ELSE 'NEEDS_MAPPING' END AS resolution
        FROM observations o LEFT JOIN loinc_one l ON l.code = o.loinc_code""",
)(lambda t: _resolution(t))


def _resolution(t):
    from assaylake.plans.lookups import codes

    observations = t.ws.model("observation_versions")
    loinc = codes(t.ws.model("loinc_lookup"))
    joined = observations.join(loinc, observations["loinc_code"] == loinc["code"], "left")
    return joined.select(
        F.col("fhir_observation_id").alias("oid"),
        F.when(F.col("concept_id").isNotNull(), "LOINC").otherwise("NEEDS_MAPPING").alias("resolution"),
    )


query("ts_to_date", "SELECT event_id, CAST(ts + INTERVAL 3 HOUR AS DATE) AS day FROM events")(
    lambda t: t.base("events").select(
        "event_id",
        F.to_date(
            j.parse_instant(F.expr("""date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'-03:00'")"""))
        ).alias("day"),
    )
)
query(
    "date_parts",
    """SELECT person_id, CAST(year(birth_date) AS BIGINT) AS y, CAST(month(birth_date) AS BIGINT) AS m,
        CAST(day(birth_date) AS BIGINT) AS d FROM persons""",
)(
    lambda t: t.ws.model("omop_person").select(
        "person_id", *[F.col(f"{part}_of_birth").cast("bigint").alias(part[0]) for part in ("year", "month", "day")]
    )
)
query(
    "current_date",
    """SELECT current_date AS cdm_release_date, current_date AS source_release_date, max('v' || r_regionkey) AS vocabulary_version
        FROM region""",
)(lambda t: t.ws.model("omop_cdm_source").select("cdm_release_date", "source_release_date", "vocabulary_version"))
query(
    "typed_null",
    """SELECT s_suppkey, CAST(NULL AS BIGINT) AS provider_id, CAST(NULL AS VARCHAR) AS county,
        CAST(NULL AS DATE) AS day FROM supplier""",
)(
    lambda t: t.base("supplier").select(
        "s_suppkey",
        s.typed_null("bigint").alias("provider_id"),
        s.typed_null("string").alias("county"),
        s.typed_null("date").alias("day"),
    )
)
query(
    "constant_column",
    """SELECT DISTINCT CAST(32817 AS BIGINT) AS visit_type, CAST(32856 AS BIGINT) AS measurement_type,
        o_orderstatus FROM orders""",
)(
    lambda t: t.base("orders")
    .select(
        s.concept(32817).alias("visit_type"),
        s.concept(t.ws.config.lab_result_type_concept_id).alias("measurement_type"),
        "o_orderstatus",
    )
    .distinct()
)
query(
    "numeric_to_string",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
        regexp_replace(regexp_replace(printf('%.9f', l_extendedprice), '0+$', ''), '\\.$', '') AS price,
        CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity FROM lineitem""",
)(
    lambda t: t.base("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        s.decimal_text(F.col("l_extendedprice").cast("decimal(38,9)")).alias("price"),
        s.decimal_text(F.col("l_quantity").cast("decimal(38,9)")).alias("quantity"),
    )
)
query(
    "safe_cast",
    """SELECT p_partkey, TRY_CAST(CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE CAST(p_retailprice AS VARCHAR) END
        AS DOUBLE) AS price FROM part""",
)(
    lambda t: t.base("part").select(
        "p_partkey",
        F.parse_json(
            F.expr("to_json(named_struct('v', if(p_partkey % 2 = 0, p_name, cast(p_retailprice as string))))")
        ).alias("document"),
    ).select("p_partkey", j.number(j.json_path(F.col("document"), "v")).alias("price"))
)
query(
    "pct_arith",
    """SELECT 100.0 * count(*) FILTER (measurement_concept_id = 0) / count(*) AS concepts,
        100.0 * count(*) FILTER (unit_concept_id = 0) / count(*) AS units FROM measurements""",
)(
    lambda t: stages.measurement_gaps(t.ws).select(
        F.col("pct_unknown_concept").alias("concepts"), F.col("pct_unknown_unit").alias("units")
    )
)
query(
    "epoch_default",
    """SELECT 'filled' AS source, max(l_shipdate) AS mark FROM lineitem
        UNION ALL SELECT 'empty', TIMESTAMP '1970-01-01 00:00:00'""",
)(
    lambda t: high_water(t.raw("Observation"), "last_updated")
    .select(F.lit("filled").alias("source"), "mark")
    .union(
        high_water(t.raw("Observation").filter("resource_type = ''"), "last_updated").select(
            F.lit("empty").alias("source"), "mark"
        )
    )
)
