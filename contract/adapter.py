"""FHIR landing lines and vocabulary tables derived from the driver's tables.

Every row of the base tables takes part; the expressions below only shape it. References to resources that nobody
has carry a negative key: patients of every fiftieth customer, encounters of every third and specimens of every
second order, as other resources refer to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake import EngineConfig, Workspace
from assaylake.config import ETHNICITY_URL, LOINC_URI, RACE_URL, SNOMED_URI
from assaylake.session import configure
from assaylake.schemas.raw import RUN_DATE as RUN_DATE_COLUMN
from assaylake.sources.ndjson import raw_envelope, timed_once
from assaylake.sources.seeds import default_test_seed

RUN_DATE = "2024-01-02"
EARLIER_RUN_DATE = "2024-01-01"
LANDING = "file:/landing"

# Keys as references name them; negative ones belong to nobody. Spark and SQL read them alike.
PATIENT_KEY = "CASE WHEN o_custkey % 50 = 49 THEN -o_custkey ELSE o_custkey END"
ENCOUNTER_KEY = "CASE WHEN {0} % 3 = 2 THEN -{0} ELSE {0} END"
SPECIMEN_KEY = "CASE WHEN {0} % 2 = 1 THEN -{0} ELSE {0} END"

# Concepts outside the two big vocabularies.
FIXED_CONCEPTS = [
    (8840, "milligram per deciliter", "UCUM", "mg/dL"),
    (9840, "spelled in capitals", "UCUM", "MG/DL"),
    (8848, "thousand per microliter", "UCUM", "10*9/L"),
    (8507, "MALE", "Gender", "MALE"),
    (8532, "FEMALE", "Gender", "FEMALE"),
    (8527, "White", "Race", "2106-3"),
    (38003563, "Hispanic or Latino", "Ethnicity", "2135-2"),
    (9201, "visit class 1", "Visit", "p1"),
    (9202, "visit class 2", "Visit", "p2"),
    (9203, "visit class 3", "Visit", "p3"),
    (9204, "visit class 4", "Visit", "p4"),
    (4171756, "Less than", "Meas Value Operator", "op1"),
    (4171754, "Less than or equal to", "Meas Value Operator", "op2"),
    (4172704, "Greater than", "Meas Value Operator", "op3"),
    (4171755, "Greater than or equal to", "Meas Value Operator", "op4"),
    (4172703, "Equal", "Meas Value Operator", "op5"),
]


def iso(column: str) -> str:
    return f"date_format(cast({column} as timestamp), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def _coding(system: str, code: str, display: str | None = None) -> str:
    shown = f", 'display', {display}" if display else ""
    return f"named_struct('system', {system}, 'code', {code}{shown})"


class Tables:
    """The driver's tables of one folder, as base tables, landing lines, raw rows and a workspace."""

    def __init__(
        self, spark: SparkSession, folder: str, config: EngineConfig | None = None, spread: int | None = None
    ):
        self.spark = configure(spark)
        self.folder = folder
        self.spread = spread
        self._frames: dict[str, DataFrame] = {}
        self.ws = Workspace(
            spark,
            self.timed,
            self.vocabulary,
            config,
            seeds={"test": self.test_seed()},
            raw_counts=self.raw_counts,
        )

    def base(self, name: str) -> DataFrame:
        key = f"base:{name}"
        if key not in self._frames:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            self._frames[key] = df.repartition(self.spread) if self.spread else df
        return self._frames[key]

    # ---- landing lines -------------------------------------------------------------------------

    def lines(self, resource_type: str) -> DataFrame:
        """(line, file_uri, run_date) of one resource type."""
        key = f"lines:{resource_type}"
        if key not in self._frames:
            self._frames[key] = getattr(self, f"_{resource_type.lower()}")()
        return self._frames[key]

    def raw(self, resource_type: str) -> DataFrame:
        key = f"raw:{resource_type}"
        if key not in self._frames:
            self._frames[key] = raw_envelope(self.lines(resource_type), F.col("run_date"))
        return self._frames[key]

    def timed(self, resource_type: str) -> DataFrame:
        """``raw`` for readers that may filter by update time."""
        key = f"timed:{resource_type}"
        if key not in self._frames:
            self._frames[key] = timed_once(self.raw(resource_type))
        return self._frames[key]

    def raw_counts(self, resource_type: str) -> DataFrame:
        """(run date, row_count); counting parses no document."""
        return self.raw(resource_type).groupBy(RUN_DATE_COLUMN).agg(F.count("*").alias("row_count"))

    @staticmethod
    def _emit(df: DataFrame, kind: str, key: str, updated: str, members: str, marker: str = "'0000'") -> DataFrame:
        document = (
            f"to_json(named_struct('resourceType', '{kind}', 'id', {key}, "
            f"'meta', named_struct('lastUpdated', {updated}), {members}))"
        )
        run_date = "run_date" if "run_date" in df.columns else f"'{RUN_DATE}'"
        return df.selectExpr(
            f"{document} as line",
            f"concat('{LANDING}/', {run_date}, '/{kind}-', {marker}, '.ndjson') as file_uri",
            f"{run_date} as run_date",
        )

    def _patient(self) -> DataFrame:
        regions = self.base("nation").join(self.base("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        people = (
            self.base("customer")
            .join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn(
                "run_date",
                F.expr(
                    f"explode(case when c_custkey % 13 = 0 then array('{RUN_DATE}', '{EARLIER_RUN_DATE}') "
                    f"else array('{RUN_DATE}') end)"
                ),
            )
        )
        old = f"run_date = '{EARLIER_RUN_DATE}'"
        extension = (
            "named_struct('url', '{url}', 'extension', array(named_struct('url', 'ombCategory', "
            "'valueCoding', named_struct('code', {code}))))"
        )
        race = extension.format(url=RACE_URL, code="case c_custkey % 5 when 0 then '2106-3' else '2054-5' end")
        ethnicity = extension.format(url=ETHNICITY_URL, code="'2135-2'")
        members = f"""
            'gender', case when {old} then 'unknown' when c_custkey % 4 = 0 then 'male'
                when c_custkey % 4 = 1 then 'female' when c_custkey % 4 = 2 then 'other' end,
            'birthDate', case when {old} then '1900-01-01' when c_custkey % 97 = 0 then '1970-05'
                else cast(date_add(date'1940-01-01', cast(c_custkey % 25000 as int)) as string) end,
            'deceasedBoolean', case when c_custkey % 11 = 0 then true end,
            'deceasedDateTime', case when c_custkey % 22 = 0 then '2020-03-01T23:30:00-03:00' end,
            'identifier', case when c_custkey % 10 <> 0 then
                array(named_struct('system', 'urn:mrn', 'value', c_name)) end,
            'address', case when c_custkey % 7 <> 0 then array(named_struct('city', c_mktsegment,
                'state', n_name, 'postalCode', case when c_custkey % 3 = 0 then concat('Z', c_custkey % 5) end,
                'country', r_name)) end,
            'extension', array(case when c_custkey % 5 in (0, 1) then {race} end,
                case when c_custkey % 6 = 0 then {ethnicity} end)"""
        return self._emit(people, "Patient", "concat('C', c_custkey)", "'2024-01-01T00:00:00Z'", members)

    def _encounter(self) -> DataFrame:
        members = f"""
            'subject', named_struct('reference', concat('Patient/C', {PATIENT_KEY})),
            'period', named_struct('start', {iso('o_orderdate')},
                'end', case when o_orderstatus <> 'O' then {iso("o_orderdate + interval 1 day")} end),
            'class', named_struct('code', concat('P', substr(o_orderpriority, 1, 1)), 'system', 'urn:visit-class'),
            'status', 'finished',
            'serviceProvider', case when o_orderkey % 4 = 0 then
                named_struct('reference', concat('Organization/O', o_custkey % 25)) end"""
        return self._emit(self.base("orders"), "Encounter", "concat('E', o_orderkey)", iso("o_orderdate"), members)

    def _diagnosticreport(self) -> DataFrame:
        # At most seven line numbers per order remain after distinct.
        children = (
            self.base("lineitem")
            .select("l_orderkey", "l_linenumber")
            .distinct()
            .groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_list("l_linenumber")).alias("numbers"))
        )
        reports = (
            self.base("orders")
            .join(children, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .withColumn("letter", F.expr("explode(case when o_orderkey % 50 = 0 then array('R', 'Q') else array('R') end)"))
        )
        panel = _coding(f"'{LOINC_URI}'", "concat('P', o_orderkey % 100)", "concat('Panel ', o_orderkey % 100)")
        members = f"""
            'subject', named_struct('reference', concat('Patient/C', {PATIENT_KEY})),
            'encounter', named_struct('reference', concat('http://h/fhir/Encounter/E', {ENCOUNTER_KEY.format("o_orderkey")})),
            'effectiveDateTime', case when o_orderkey % 2 = 0 then {iso('o_orderdate')} end,
            'effectivePeriod', named_struct('start', {iso('o_orderdate')}),
            'issued', case when o_orderstatus <> 'F' then {iso("o_orderdate + interval 2 day")} end,
            'code', named_struct('coding', array({panel})),
            'result', transform(numbers, n -> named_struct('reference', concat('Observation/L', o_orderkey, '-', n))),
            'status', 'final'"""
        return self._emit(
            reports, "DiagnosticReport", "concat(letter, o_orderkey)", iso("o_orderdate"), members
        )

    def _observation(self) -> DataFrame:
        rows = self.base("lineitem").join(self.base("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        system = f"case when l_partkey % 5 <> 0 then '{LOINC_URI}' else 'urn:lab:local' end"
        first = _coding(system, "concat('P', l_partkey)", "concat('Test ', l_partkey)")
        second = _coding(f"'{SNOMED_URI}'", "concat('P', l_partkey)", "'second'")
        finding = _coding(f"'{SNOMED_URI}'", "concat('P', l_partkey % 1000)", "concat('Finding ', l_partkey % 1000)")
        timed = "not (l_linenumber = 7 and l_suppkey % 10 = 0)"
        no_coding = "cast(null as array<struct<code: string>>)"
        members = f"""
            'status', 'final',
            'category', case l_returnflag
                when 'A' then array(named_struct('coding', array(named_struct('code', 'laboratory')),
                    'text', cast(null as string)))
                when 'N' then array(named_struct('coding', {no_coding}, 'text', 'Laboratory')) end,
            'code', named_struct('coding', case when l_partkey % 3 = 0 then array({first}, {second}) else array({first}) end),
            'subject', named_struct('reference', concat('Patient/C', {PATIENT_KEY})),
            'encounter', case when l_linenumber <> 6 then
                named_struct('reference', concat('Encounter/E', {ENCOUNTER_KEY.format("l_orderkey")})) end,
            'specimen', named_struct('reference', concat('Specimen/S', {SPECIMEN_KEY.format("l_orderkey")})),
            'effectiveDateTime', case when {timed} and l_linestatus = 'F' then {iso('l_shipdate')} end,
            'effectivePeriod', case when {timed} and l_linestatus <> 'F' then named_struct('start', {iso('l_shipdate')}) end,
            'issued', {iso("l_shipdate + interval 1 day")},
            'valueQuantity', case when l_partkey % 17 > 1 then named_struct('value', l_quantity,
                'comparator', element_at(array('<', '<=', '>', '>=', '=', 'ad', null), l_linenumber),
                'unit', element_at(array('mg/dL', 'MG/DL', 'x10^9/L', 'foo', null), cast(l_suppkey % 5 + 1 as int)),
                'code', element_at(array('mg/dL', 'MG/DL', null, null, null), cast(l_suppkey % 5 + 1 as int)),
                'system', 'http://unitsofmeasure.org') end,
            'valueString', case when l_partkey % 17 = 0 then 'positive' end,
            'valueCodeableConcept', case when l_partkey % 17 = 1 then named_struct('coding', array({finding})) end,
            'referenceRange', array(named_struct('low', named_struct('value', l_discount),
                'high', named_struct('value', l_tax))),
            'interpretation', case when l_tax > 0.05 then array(
                named_struct('coding', array()), named_struct('coding', array(named_struct('code', 'H')))) end,
            'performer', array(named_struct('reference', concat('Practitioner/D', l_suppkey)))"""
        members = members.replace(
            "named_struct('coding', array()),", "named_struct('coding', filter(array(named_struct('code', '')), x -> false)),"
        )
        marker = """concat_ws('-', lpad(l_partkey, 8, '0'), lpad(l_suppkey, 6, '0'),
            lpad(cast(l_quantity as bigint), 4, '0'), lpad(cast(round(100 * l_extendedprice) as bigint), 14, '0'),
            lpad(cast(round(100 * l_discount) as bigint), 2, '0'), lpad(cast(round(100 * l_tax) as bigint), 2, '0'),
            l_returnflag, l_linestatus)"""
        key = "concat('L', l_orderkey, '-', l_linenumber)"
        return self._emit(rows, "Observation", key, iso("l_shipdate"), members, marker)

    def _specimen(self) -> DataFrame:
        kind = _coding(f"'{SNOMED_URI}'", "concat('P', o_orderkey % 3000)", "'Specimen'")
        other = _coding("'urn:lab:container'", "'TUBE'", "'Tube'")
        site = _coding(f"'{SNOMED_URI}'", "concat('P', o_orderkey % 1000)")
        members = f"""
            'subject', named_struct('reference', concat('Patient/C', {PATIENT_KEY})),
            'collection', named_struct(
                'collectedDateTime', case when o_orderkey % 4 = 0 then {iso('o_orderdate')} end,
                'collectedPeriod', named_struct('start', {iso('o_orderdate')}),
                'bodySite', case when o_orderkey % 6 = 0 then named_struct('coding', array({site})) end),
            'type', named_struct('coding', array({other}, {kind})),
            'status', 'available'"""
        return self._emit(self.base("orders"), "Specimen", "concat('S', o_orderkey)", iso("o_orderdate"), members)

    def _practitioner(self) -> DataFrame:
        return self._emit(
            self.base("supplier"),
            "Practitioner",
            "concat('D', s_suppkey)",
            "'2024-01-01T00:00:00Z'",
            "'name', array(named_struct('text', s_name))",
        )

    def _organization(self) -> DataFrame:
        return self._emit(
            self.base("nation"), "Organization", "concat('O', n_nationkey)", "'2024-01-01T00:00:00Z'", "'name', n_name"
        )

    def _location(self) -> DataFrame:
        return self._emit(
            self.base("region"), "Location", "concat('A', r_regionkey)", "'2024-01-01T00:00:00Z'", "'name', r_name"
        )

    # ---- vocabulary ----------------------------------------------------------------------------

    def vocabulary(self, table: str) -> DataFrame:
        key = f"vocabulary:{table}"
        if key not in self._frames:
            self._frames[key] = getattr(self, f"_v_{table}")()
        return self._frames[key]

    _VALID = (
        "date'1970-01-01' as valid_start_date",
        "date'2099-12-31' as valid_end_date",
    )

    def _v_concept(self) -> DataFrame:
        def coded(vocabulary_id: str, offset: int, domain: str) -> DataFrame:
            return self.base("part").selectExpr(
                f"{offset} + p_partkey as concept_id",
                "concat('the \"', p_name, '\" ', p_partkey) as concept_name",
                f"'{domain}' as domain_id",
                f"'{vocabulary_id}' as vocabulary_id",
                "'Lab Test' as concept_class_id",
                "case when p_size % 5 <> 0 then 'S' when p_size % 10 = 5 then 'C' end as standard_concept",
                "concat('P', p_partkey) as concept_code",
                *self._VALID,
                "case when p_size % 7 = 0 then 'D' end as invalid_reason",
            )

        literals = self.spark.createDataFrame(
            FIXED_CONCEPTS, "concept_id long, concept_name string, vocabulary_id string, concept_code string"
        ).selectExpr(
            "concept_id",
            "concept_name",
            "'Metadata' as domain_id",
            "vocabulary_id",
            "'Term' as concept_class_id",
            "'S' as standard_concept",
            "concept_code",
            *self._VALID,
            "cast(null as string) as invalid_reason",
        )
        return (
            coded("LOINC", 1_000_000, "Measurement")
            .unionByName(coded("SNOMED", 2_000_000, "Observation"))
            .unionByName(literals)
        )

    def _v_concept_relationship(self) -> DataFrame:
        return (
            self.base("part")
            .filter("p_size % 5 = 0")
            .withColumn("step", F.expr("explode(case when p_partkey % 13 = 0 then array(1, 2) else array(1) end)"))
            .selectExpr(
                "1000000 + p_partkey as concept_id_1",
                "1000000 + p_partkey + step as concept_id_2",
                "'Maps to' as relationship_id",
                *self._VALID,
                "case when p_partkey % 11 = 0 then 'D' end as invalid_reason",
            )
        )

    def _v_concept_ancestor(self) -> DataFrame:
        return self.base("part").selectExpr(
            "1000000 + p_partkey as ancestor_concept_id",
            "1000001 + p_partkey as descendant_concept_id",
            "1L as min_levels_of_separation",
            "1L as max_levels_of_separation",
        )

    def _v_vocabulary(self) -> DataFrame:
        return self.base("region").selectExpr(
            "r_name as vocabulary_id",
            "concat(r_name, ' codes') as vocabulary_name",
            "cast(null as string) as vocabulary_reference",
            "concat('v', r_regionkey) as vocabulary_version",
            "cast(r_regionkey as bigint) as vocabulary_concept_id",
        )

    def _v_domain(self) -> DataFrame:
        return self.base("region").selectExpr(
            "r_name as domain_id", "r_name as domain_name", "cast(r_regionkey as bigint) as domain_concept_id"
        )

    def _v_concept_class(self) -> DataFrame:
        return self.base("nation").selectExpr(
            "n_name as concept_class_id",
            "n_name as concept_class_name",
            "cast(n_nationkey as bigint) as concept_class_concept_id",
        )

    def _v_relationship(self) -> DataFrame:
        return self.base("nation").selectExpr(
            "concat('Relation ', n_nationkey) as relationship_id",
            "n_name as relationship_name",
            "cast(n_nationkey % 2 as string) as is_hierarchical",
            "'0' as defines_ancestry",
            "concat('Relation ', 24 - n_nationkey) as reverse_relationship_id",
            "cast(n_nationkey as bigint) as relationship_concept_id",
        )

    def _v_concept_synonym(self) -> DataFrame:
        return self.base("part").selectExpr(
            "1000000 + p_partkey as concept_id",
            "p_name as concept_synonym_name",
            "4180186L as language_concept_id",
        )

    def _v_drug_strength(self) -> DataFrame:
        return self.base("part").selectExpr(
            "1000000 + p_partkey as drug_concept_id",
            "1000001 + p_partkey as ingredient_concept_id",
            "cast(p_retailprice as decimal(38,9)) as amount_value",
            "8840L as amount_unit_concept_id",
            "cast(null as decimal(38,9)) as numerator_value",
            "cast(null as bigint) as numerator_unit_concept_id",
            "cast(null as decimal(38,9)) as denominator_value",
            "cast(null as bigint) as denominator_unit_concept_id",
            "cast(p_size as bigint) as box_size",
            *self._VALID,
            "cast(null as string) as invalid_reason",
        )

    def test_seed(self) -> DataFrame:
        """The default analyser codes plus local codes of every tenth part."""
        local = (
            self.base("part")
            .filter("p_partkey % 10 = 0")
            .selectExpr(
                "concat('P', p_partkey) as source_code",
                "'URN:lab:local' as source_code_system",
                "3000000 + p_partkey as target_concept_id",
                "case when p_partkey % 20 = 0 then 1000000 + p_partkey else 0 end as source_concept_id",
                "p_name as target_description",
            )
        )
        return local.unionByName(default_test_seed(self.spark))
