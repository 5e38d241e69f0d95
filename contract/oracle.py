"""SQL that computes the expected answers straight from the base columns, without any JSON."""

from __future__ import annotations

import re

from contract.adapter import ENCOUNTER_KEY, FIXED_CONCEPTS, PATIENT_KEY, SPECIMEN_KEY


def key(expr: str) -> str:
    """Signed 64-bit key: leading half of the MD5 digest."""
    unsigned = f"CAST(CAST('0x' || substr(md5({expr}), 1, 16) AS UBIGINT) AS HUGEINT)"
    return (
        f"CAST({unsigned} - CASE WHEN {unsigned} >= 9223372036854775808 "
        "THEN 18446744073709551616 ELSE 0 END AS BIGINT)"
    )


def fingerprint_of_8_to_32(texts: str) -> str:
    """The 64-bit FarmHash fingerprint ``id`` of each ASCII ``t`` of 8 to 32 characters, in 128-bit arithmetic; other columns stay."""
    k1, k2, word = 0xB492B66FBE98F273, 0x9AE16A3B2F90404F, 1 << 64

    def wrapped(terms: str) -> str:
        return f"CAST(({terms}) % CAST({word} AS UHUGEINT) AS UHUGEINT)"

    def add(*terms) -> str:
        return wrapped(" + ".join(f"CAST({t} AS UHUGEINT)" for t in terms))

    def times(x, y) -> str:
        return wrapped(f"CAST({x} AS UHUGEINT) * CAST({y} AS UHUGEINT)")

    def turned(x, right: int) -> str:
        return f"xor({x} // {1 << right}, {times(x, 1 << (64 - right))})"

    def stirred(x) -> str:
        return f"xor({x}, {x} // {1 << 47})"

    def read(place: str) -> str:
        return f"CAST(CAST('0x' || hex(reverse(substr(t, CAST({place} + 1 AS INTEGER), 8))) AS UBIGINT) AS UHUGEINT)"

    steps = [
        {"m": add(k2, "2 * length(t)"), "is_long": "length(t) > 16"},
        {
            "a": f"CASE WHEN is_long THEN {times(read('0'), k1)} ELSE {add(read('0'), k2)} END",
            "b": f"CASE WHEN is_long THEN {read('8')} ELSE {read('length(t) - 8')} END",
            "c": f"CASE WHEN is_long THEN {times(read('length(t) - 8'), 'm')} END",
            "d": f"CASE WHEN is_long THEN {times(read('length(t) - 16'), k2)} END",
        },
        {"ab": add("a", "b"), "bk": add("b", k2)},
        {
            "u": f"CASE WHEN is_long THEN {add(turned('ab', 43), turned('c', 30), 'd')} ELSE {add(times(turned('b', 37), 'm'), 'a')} END",
            "v": f"CASE WHEN is_long THEN {add('a', turned('bk', 18), 'c')} ELSE {times(add(turned('a', 25), 'b'), 'm')} END",
        },
        {"p": times("xor(u, v)", "m")},
        {"q": times(f"xor(v, {stirred('p')})", "m")},
        {"f": times(stirred("q"), "m")},
        {"id": f"CAST(CAST(f AS HUGEINT) - CASE WHEN f >= {word // 2} THEN CAST({word} AS HUGEINT) ELSE 0 END AS BIGINT)"},
    ]
    for step in steps:
        texts = f"SELECT *, {', '.join(f'{value} AS {name}' for name, value in step.items())} FROM ({texts})"
    return texts


NULL_INT = "CAST(NULL AS BIGINT)"
NULL_TEXT = "CAST(NULL AS VARCHAR)"

VERSION_ORDER = (
    "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
    "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"
)

RELATIONS = {
    "patients": """
        SELECT c_custkey, c_name, 'C' || c_custkey AS id,
            CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' END AS gender,
            CASE WHEN c_custkey % 97 <> 0 THEN CAST(DATE '1940-01-01' + CAST(c_custkey % 25000 AS INTEGER) AS DATE) END
                AS birth_date,
            CASE WHEN c_custkey % 22 = 0 THEN TIMESTAMP '2020-03-02 02:30:00' END AS deceased_datetime,
            CASE WHEN c_custkey % 11 = 0 THEN true END AS deceased_bool,
            CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS identifier_value,
            CASE WHEN c_custkey % 10 <> 0 THEN 'urn:mrn' END AS identifier_system,
            CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS city,
            CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS state,
            CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 3 = 0 THEN 'Z' || (c_custkey % 5) END AS zip,
            CASE WHEN c_custkey % 7 <> 0 THEN r_name END AS country,
            CASE c_custkey % 5 WHEN 0 THEN '2106-3' WHEN 1 THEN '2054-5' END AS race,
            CASE WHEN c_custkey % 6 = 0 THEN '2135-2' END AS ethnicity
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "encounters": f"""
        SELECT o_orderkey, {PATIENT_KEY} AS o_custkey, 'E' || o_orderkey AS id, o_orderdate AS started,
            CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY END AS ended,
            'P' || substr(o_orderpriority, 1, 1) AS class_code,
            CASE WHEN o_orderkey % 4 = 0 THEN 'O' || (o_custkey % 25) END AS provider
        FROM orders""",
    "specimens": f"""
        SELECT o_orderkey, {PATIENT_KEY} AS o_custkey, 'S' || o_orderkey AS id, o_orderdate,
            CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate END AS collected,
            'P' || (o_orderkey % 3000) AS type_code,
            CASE WHEN o_orderkey % 6 = 0 THEN 'P' || (o_orderkey % 1000) END AS site_code
        FROM orders""",
    "reports": f"""
        SELECT o_orderkey, {PATIENT_KEY} AS o_custkey, 'E' || ({ENCOUNTER_KEY.format("o_orderkey")}) AS encounter_ref, letter || o_orderkey AS id, o_orderdate AS taken,
            CASE WHEN o_orderstatus <> 'F' THEN o_orderdate + INTERVAL 2 DAY END AS issued,
            'P' || (o_orderkey % 100) AS code, 'Panel ' || (o_orderkey % 100) AS display
        FROM orders, (VALUES ('R'), ('Q')) AS letters(letter)
        WHERE letter = 'R' OR o_orderkey % 50 = 0""",
    "children": """
        SELECT r.id AS report, 'L' || l.l_orderkey || '-' || l.l_linenumber AS oid
        FROM reports r JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l
            ON l.l_orderkey = r.o_orderkey""",
    "versions": f"""
        SELECT 'L' || l_orderkey || '-' || l_linenumber AS oid, * REPLACE ({PATIENT_KEY} AS o_custkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "observations": f"""
        SELECT oid, o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_discount, l_tax,
            l_returnflag IN ('A', 'N') AS is_lab,
            'C' || o_custkey AS patient_ref,
            CASE WHEN l_linenumber <> 6 THEN 'E' || ({ENCOUNTER_KEY.format("l_orderkey")}) END AS encounter_ref,
            'S' || ({SPECIMEN_KEY.format("l_orderkey")}) AS specimen_ref,
            CASE WHEN l_partkey % 5 <> 0 THEN 'P' || l_partkey END AS loinc_code,
            CASE WHEN l_partkey % 3 = 0 THEN 'P' || l_partkey END AS snomed_code,
            'P' || l_partkey AS source_code,
            CASE WHEN l_partkey % 5 <> 0 THEN 'http://loinc.org' ELSE 'urn:lab:local' END AS source_code_system,
            'Test ' || l_partkey AS source_code_display,
            CASE WHEN NOT (l_linenumber = 7 AND l_suppkey % 10 = 0) THEN l_shipdate END AS taken,
            l_linestatus,
            CASE WHEN l_partkey % 17 > 1 THEN l_quantity END AS value_number,
            CASE WHEN l_partkey % 17 > 1 THEN
                CASE l_linenumber WHEN 1 THEN '<' WHEN 2 THEN '<=' WHEN 3 THEN '>' WHEN 4 THEN '>='
                    WHEN 5 THEN '=' WHEN 6 THEN 'ad' END END AS comparator,
            CASE WHEN l_partkey % 17 > 1 THEN
                CASE l_suppkey % 5 WHEN 0 THEN 'mg/dL' WHEN 1 THEN 'MG/DL' WHEN 2 THEN 'x10^9/L'
                    WHEN 3 THEN 'foo' END END AS unit_source,
            CASE WHEN l_partkey % 17 > 1 THEN
                CASE l_suppkey % 5 WHEN 0 THEN 'mg/dL' WHEN 1 THEN 'MG/DL' END END AS unit_ucum_code,
            CASE WHEN l_partkey % 17 > 1 THEN 'http://unitsofmeasure.org' END AS unit_system,
            CASE WHEN l_partkey % 17 = 1 THEN 'P' || (l_partkey % 1000) END AS value_snomed_code,
            CASE WHEN l_partkey % 17 = 1 THEN 'Finding ' || (l_partkey % 1000) END AS value_display,
            CASE WHEN l_partkey % 17 = 0 THEN 'positive' END AS value_string,
            CASE WHEN l_tax > 0.05 THEN 'H' END AS interpretation,
            'D' || l_suppkey AS performer
        FROM (SELECT * FROM versions
            QUALIFY row_number() OVER (PARTITION BY oid ORDER BY {VERSION_ORDER}) = 1)""",
    "concepts": """
        SELECT base + p_partkey AS concept_id, 'the "' || p_name || '" ' || p_partkey AS concept_name, vocab,
            'P' || p_partkey AS code,
            CASE WHEN p_size % 5 <> 0 THEN 'S' WHEN p_size % 10 = 5 THEN 'C' END AS standard,
            CASE WHEN p_size % 7 = 0 THEN 'D' END AS invalid
        FROM part, (VALUES ('LOINC', 1000000), ('SNOMED', 2000000)) AS v(vocab, base)""",
    "all_concepts": f"""
        SELECT concept_id, concept_name, CASE vocab WHEN 'LOINC' THEN 'Measurement' ELSE 'Observation' END AS domain_id,
            vocab AS vocabulary_id, 'Lab Test' AS concept_class_id, standard AS standard_concept, code AS concept_code,
            DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date, invalid AS invalid_reason
        FROM concepts
        UNION ALL SELECT id, name, 'Metadata', vocab, 'Term', 'S', code, DATE '1970-01-01', DATE '2099-12-31', NULL
        FROM (VALUES {", ".join(map(str, FIXED_CONCEPTS))}) AS v(id, name, vocab, code)""",
    "maps": """
        SELECT 1000000 + p_partkey AS source, 1000000 + p_partkey + step AS target
        FROM part, (VALUES (1), (2)) AS s(step)
        WHERE p_size % 5 = 0 AND p_partkey % 11 <> 0 AND (step = 1 OR p_partkey % 13 = 0)""",
    "loinc": """
        SELECT code, concept_id, concept_name FROM concepts WHERE vocab = 'LOINC' AND standard = 'S'
        UNION ALL
        SELECT s.code, t.concept_id, t.concept_name FROM concepts s JOIN maps ON source = s.concept_id
            JOIN concepts t ON t.concept_id = target AND t.standard = 'S'
        WHERE s.vocab = 'LOINC' AND s.standard IS DISTINCT FROM 'S'""",
    "loinc_one": "SELECT code, min(concept_id) AS concept_id FROM loinc GROUP BY code",
    "snomed_standard": """
        SELECT code, min(concept_id) AS concept_id FROM concepts WHERE vocab = 'SNOMED' AND standard = 'S' GROUP BY code""",
    "snomed_value": """
        SELECT code, concept_id FROM concepts WHERE vocab = 'SNOMED' AND standard = 'S' AND invalid IS NULL""",
    "source_codes": """
        SELECT CASE vocab WHEN 'LOINC' THEN 'http://loinc.org' ELSE 'http://snomed.info/sct' END AS system_uri,
            code, concept_id, vocab, standard FROM concepts WHERE invalid IS NULL""",
    "local_tests": """
        SELECT 'P' || p_partkey AS code, 3000000 + p_partkey AS target,
            CASE WHEN p_partkey % 20 = 0 THEN 1000000 + p_partkey END AS source
        FROM part WHERE p_partkey % 10 = 0""",
    "persons": f"SELECT {key('id')} AS person_id, * FROM patients",
    "visits": f"""
        SELECT {key('e.id')} AS visit_occurrence_id, p.person_id, e.* FROM encounters e
            JOIN persons p ON p.c_custkey = e.o_custkey""",
    "person_specimens": f"""
        SELECT {key('s.id')} AS specimen_id, p.person_id, s.* FROM specimens s
            JOIN persons p ON p.c_custkey = s.o_custkey""",
    "first_report": f"SELECT oid, min({key('report')}) AS visit_detail_id FROM children GROUP BY oid",
    "measurements": f"""
        SELECT {key('o.oid')} AS measurement_id, p.person_id,
            CAST(coalesce(l.concept_id, t.target, 0) AS BIGINT) AS measurement_concept_id,
            CAST(o.taken AS DATE) AS measurement_date, o.taken AS measurement_datetime,
            {NULL_TEXT} AS measurement_time, CAST(32856 AS BIGINT) AS measurement_type_concept_id,
            CAST(CASE o.comparator WHEN '<' THEN 4171756 WHEN '<=' THEN 4171754 WHEN '>' THEN 4172704
                WHEN '>=' THEN 4171755 WHEN '=' THEN 4172703 END AS BIGINT) AS operator_concept_id,
            o.value_number AS value_as_number, CAST(v.concept_id AS BIGINT) AS value_as_concept_id,
            CAST(CASE WHEN o.unit_source IN ('mg/dL', 'MG/DL') THEN 8840 WHEN o.unit_source = 'x10^9/L' THEN 8848
                ELSE 0 END AS BIGINT) AS unit_concept_id,
            o.l_discount AS range_low, o.l_tax AS range_high, {NULL_INT} AS provider_id,
            e.visit_occurrence_id, r.visit_detail_id, o.source_code AS measurement_source_value,
            CAST(coalesce(t.source, s.concept_id, 0) AS BIGINT) AS measurement_source_concept_id,
            o.unit_source AS unit_source_value,
            coalesce(CAST(CAST(o.value_number AS BIGINT) AS VARCHAR), o.value_string, o.value_display)
                AS value_source_value,
            sp.specimen_id, o.l_shipdate AS _loaded_at
        FROM observations o
        JOIN persons p ON p.c_custkey = o.o_custkey
        LEFT JOIN loinc_one l ON l.code = o.loinc_code
        LEFT JOIN local_tests t ON t.code = o.source_code AND o.source_code_system = 'urn:lab:local'
        LEFT JOIN snomed_value v ON v.code = o.value_snomed_code
        LEFT JOIN source_codes s ON s.system_uri = o.source_code_system AND s.code = o.source_code
        LEFT JOIN first_report r ON r.oid = o.oid
        LEFT JOIN visits e ON e.id = o.encounter_ref
        LEFT JOIN person_specimens sp ON sp.id = o.specimen_ref
        WHERE o.is_lab""",
    "other_observations": f"""
        SELECT {key('o.oid')} AS observation_id, p.person_id,
            CAST(coalesce(l.concept_id, c.concept_id, 0) AS BIGINT) AS observation_concept_id,
            CAST(o.taken AS DATE) AS observation_date, o.taken AS observation_datetime,
            CAST(38000280 AS BIGINT) AS observation_type_concept_id, o.value_number AS value_as_number,
            coalesce(o.value_string, o.value_display) AS value_as_string,
            CAST(v.concept_id AS BIGINT) AS value_as_concept_id, {NULL_INT} AS qualifier_concept_id,
            CAST(CASE WHEN o.unit_ucum_code IS NOT NULL THEN 8840 ELSE 0 END AS BIGINT) AS unit_concept_id,
            {NULL_INT} AS provider_id, e.visit_occurrence_id, {NULL_INT} AS visit_detail_id,
            o.source_code AS observation_source_value,
            CAST(coalesce(s.concept_id, 0) AS BIGINT) AS observation_source_concept_id,
            o.unit_source AS unit_source_value, {NULL_TEXT} AS qualifier_source_value,
            coalesce(CAST(CAST(o.value_number AS BIGINT) AS VARCHAR), o.value_string, o.value_display)
                AS value_source_value,
            {NULL_INT} AS observation_event_id, {NULL_INT} AS obs_event_field_concept_id
        FROM observations o
        JOIN persons p ON p.c_custkey = o.o_custkey
        LEFT JOIN loinc_one l ON l.code = o.loinc_code
        LEFT JOIN snomed_value c ON c.code = o.snomed_code
        LEFT JOIN snomed_value v ON v.code = o.value_snomed_code
        LEFT JOIN source_codes s ON s.system_uri = o.source_code_system AND s.code = o.source_code
        LEFT JOIN visits e ON e.id = o.encounter_ref
        WHERE NOT o.is_lab""",
    "visit_details": f"""
        SELECT {key('r.id')} AS visit_detail_id, p.person_id, r.*, e.visit_occurrence_id
        FROM reports r JOIN persons p ON p.c_custkey = r.o_custkey
        LEFT JOIN visits e ON e.id = r.encounter_ref""",
    "locations": f"""
        SELECT DISTINCT city, state, zip, country,
            coalesce(city, '') || '|' || coalesce(state, '') || '|' || coalesce(zip, '') || '|' || coalesce(country, '')
                AS address
        FROM patients WHERE coalesce(city, state, zip, country) IS NOT NULL""",
    "links": """
        SELECT measurement_id, specimen_id FROM measurements WHERE specimen_id IS NOT NULL""",
}


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_]+\b", sql))
    return [name for name in RELATIONS if name in words]


def with_relations(body: str) -> str:
    """``body`` preceded by the relations it names, directly or through others."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in _needs(RELATIONS[name]):
            if other != name and other not in wanted:
                add(other)
        if name not in wanted:
            wanted.append(name)

    for name in _needs(body):
        add(name)
    if not wanted:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({RELATIONS[name]})" for name in wanted) + "\n" + body
