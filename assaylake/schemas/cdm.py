"""Catalogue of CDM tables: columns, types, required columns, keys.

The tables this engine writes are declared here. Any further CDM table is taken from the published
field-level CSV of the data model (``catalogue_from_csv``) or from its DDL (``catalogue_from_ddl``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from assaylake.schemas.vocabulary import VOCABULARY_SCHEMAS

# Columns of the CDM v5.4 tables in declared order; ``!`` marks NOT NULL.
# Types follow from the names (``_kind``).
_COLUMNS = {
    "person": """person_id! gender_concept_id! year_of_birth! month_of_birth day_of_birth birth_datetime
        race_concept_id! ethnicity_concept_id! location_id provider_id care_site_id person_source_value
        gender_source_value gender_source_concept_id race_source_value race_source_concept_id
        ethnicity_source_value ethnicity_source_concept_id""",
    "visit_occurrence": """visit_occurrence_id! person_id! visit_concept_id! visit_start_date!
        visit_start_datetime visit_end_date! visit_end_datetime visit_type_concept_id! provider_id
        care_site_id visit_source_value visit_source_concept_id admitted_from_concept_id
        admitted_from_source_value discharged_to_concept_id discharged_to_source_value
        preceding_visit_occurrence_id""",
    "visit_detail": """visit_detail_id! person_id! visit_detail_concept_id! visit_detail_start_date!
        visit_detail_start_datetime visit_detail_end_date! visit_detail_end_datetime
        visit_detail_type_concept_id! provider_id care_site_id visit_detail_source_value
        visit_detail_source_concept_id admitted_from_concept_id admitted_from_source_value
        discharged_to_source_value discharged_to_concept_id preceding_visit_detail_id
        parent_visit_detail_id visit_occurrence_id!""",
    "measurement": """measurement_id! person_id! measurement_concept_id! measurement_date!
        measurement_datetime measurement_time measurement_type_concept_id! operator_concept_id
        value_as_number value_as_concept_id unit_concept_id range_low range_high provider_id
        visit_occurrence_id visit_detail_id measurement_source_value measurement_source_concept_id
        unit_source_value unit_source_concept_id value_source_value measurement_event_id
        meas_event_field_concept_id""",
    "observation": """observation_id! person_id! observation_concept_id! observation_date!
        observation_datetime observation_type_concept_id! value_as_number value_as_string
        value_as_concept_id qualifier_concept_id unit_concept_id provider_id visit_occurrence_id
        visit_detail_id observation_source_value observation_source_concept_id unit_source_value
        qualifier_source_value value_source_value observation_event_id obs_event_field_concept_id""",
    "specimen": """specimen_id! person_id! specimen_concept_id! specimen_type_concept_id! specimen_date!
        specimen_datetime quantity unit_concept_id anatomic_site_concept_id disease_status_concept_id
        specimen_source_id specimen_source_value unit_source_value anatomic_site_source_value
        disease_status_source_value""",
    "fact_relationship": """domain_concept_id_1! fact_id_1! domain_concept_id_2! fact_id_2!
        relationship_concept_id!""",
    "location": """location_id! address_1 address_2 city state zip county location_source_value
        country_concept_id country_source_value latitude longitude""",
    "cdm_source": """cdm_source_name! cdm_source_abbreviation! cdm_holder! source_description
        source_documentation_reference cdm_etl_reference source_release_date! cdm_release_date!
        cdm_version cdm_version_concept_id! vocabulary_version!""",
}
_FLOATS = {"value_as_number", "range_low", "range_high", "quantity", "latitude", "longitude"}
_INTEGERS = {"year_of_birth", "month_of_birth", "day_of_birth", "fact_id_1", "fact_id_2"}
# Integer-keyed columns by ending; these ids of the data model are text instead.
_TEXT_IDS = {"specimen_source_id"}

# Foreign keys that follow the column name, as column -> (table, column).
_TARGETS = {
    "person_id": ("person", "person_id"),
    "location_id": ("location", "location_id"),
    "provider_id": ("provider", "provider_id"),
    "care_site_id": ("care_site", "care_site_id"),
    "visit_occurrence_id": ("visit_occurrence", "visit_occurrence_id"),
    "visit_detail_id": ("visit_detail", "visit_detail_id"),
    "preceding_visit_occurrence_id": ("visit_occurrence", "visit_occurrence_id"),
    "preceding_visit_detail_id": ("visit_detail", "visit_detail_id"),
    "parent_visit_detail_id": ("visit_detail", "visit_detail_id"),
    "vocabulary_id": ("vocabulary", "vocabulary_id"),
    "domain_id": ("domain", "domain_id"),
    "concept_class_id": ("concept_class", "concept_class_id"),
    "relationship_id": ("relationship", "relationship_id"),
}

# CDM tables with a declared primary key. It is ``<table>_id`` for each of them.
PRIMARY_KEY_TABLES = (
    "person observation_period visit_occurrence visit_detail condition_occurrence drug_exposure "
    "procedure_occurrence device_exposure measurement observation note note_nlp specimen location "
    "care_site provider payer_plan_period cost drug_era dose_era condition_era episode metadata "
    "concept vocabulary domain concept_class relationship"
).split()


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Catalogue:
    schemas: dict[str, T.StructType]
    primary_keys: dict[str, str]
    foreign_keys: tuple[ForeignKey, ...]

    def required(self, table: str) -> list[str]:
        return [f.name for f in self.schemas[table].fields if not f.nullable]


def _kind(column: str) -> T.DataType:
    if column in _FLOATS:
        return T.DoubleType()
    if column in _INTEGERS:
        return T.LongType()
    if column.endswith("_datetime"):
        return T.TimestampType()
    if column.endswith("_date"):
        return T.DateType()
    is_id = column.endswith("_id") or "_concept_id" in column
    return T.LongType() if is_id and column not in _TEXT_IDS else T.StringType()


def _schema(columns: str) -> T.StructType:
    fields = [(c.rstrip("!"), not c.endswith("!")) for c in columns.split()]
    return T.StructType([T.StructField(name, _kind(name), nullable) for name, nullable in fields])


def _target(table: str, column: str) -> ForeignKey | None:
    if column in _TARGETS:
        parent, key = _TARGETS[column]
    elif "concept_id" in column:
        parent, key = "concept", "concept_id"
    else:
        return None
    own_key = (parent, key) == (table, column)
    return None if own_key else ForeignKey(table, column, parent, key)


def built_in_catalogue() -> Catalogue:
    schemas = {name: _schema(columns) for name, columns in _COLUMNS.items()} | VOCABULARY_SCHEMAS
    keys = {t: f"{t}_id" for t in PRIMARY_KEY_TABLES}
    links = [_target(t, f.name) for t, s in schemas.items() for f in s.fields]
    return Catalogue(schemas, keys, tuple(link for link in links if link))


def catalogue_from_csv(spark: SparkSession, path: str) -> Catalogue:
    """The whole data model from its published field-level CSV (some hundreds of rows)."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"').collect()
    types = {"integer": T.LongType(), "float": T.DoubleType(), "datetime": T.TimestampType(), "date": T.DateType()}
    fields: dict[str, list[T.StructField]] = {}
    keys: dict[str, str] = {}
    links: list[ForeignKey] = []

    def yes(value: str | None) -> bool:
        return (value or "").strip().lower() == "yes"

    for row in rows:
        table, column = row["cdmTableName"].lower(), row["cdmFieldName"].lower().strip('"`')
        kind = types.get((row["cdmDatatype"] or "").lower(), T.StringType())
        fields.setdefault(table, []).append(T.StructField(column, kind, not yes(row["isRequired"])))
        if yes(row["isPrimaryKey"]):
            keys[table] = column
        if yes(row["isForeignKey"]):
            links.append(ForeignKey(table, column, row["fkTableName"].lower(), row["fkFieldName"].lower()))
    return Catalogue({t: T.StructType(f) for t, f in fields.items()}, keys, tuple(links))


_TABLE = re.compile(r"create\s+table\s+([\w.@`\"]+)\s*\((.*?)\)\s*(?:;|using\b|cluster\b|distribute\b|$)", re.I | re.S)
_COLUMN = re.compile(r"^\s*[`\"]?(\w+)[`\"]?\s+([a-z]\w*)(?:\s*\([^)]*\))?([^,]*)$", re.I)
_KEY = re.compile(r"alter\s+table\s+([\w.@`\"]+)\s+add\s+constraint\s+\w+\s+primary\s+key\s+(?:\w+\s*)?\(\s*[`\"]?(\w+)", re.I)
_LINK = re.compile(
    r"alter\s+table\s+([\w.@`\"]+)\s+add\s+constraint\s+\w+\s+foreign\s+key\s*\(\s*[`\"]?(\w+)[`\"]?\s*\)\s*"
    r"references\s+([\w.@`\"]+)\s*\(\s*[`\"]?(\w+)",
    re.I,
)


def catalogue_from_ddl(spark: SparkSession, *paths: str) -> Catalogue:
    """The whole data model from its published DDL: files of tables, primary keys and constraints, in any order."""
    scripts = [r[0] for p in paths for r in spark.read.text(p, wholetext=True).collect()]  # a few files of a few hundred lines
    text = re.sub(r"--[^\n]*", "", "\n".join(scripts))
    plain = lambda name: name.split(".")[-1].strip('`"@').lower()

    def kind(name: str) -> T.DataType:
        name = name.lower()
        if name.startswith(("int", "bigint")):
            return T.LongType()
        if name.startswith(("float", "double", "numeric", "decimal")):
            return T.DoubleType()
        if name == "date":
            return T.DateType()
        return T.TimestampType() if name.startswith(("datetime", "timestamp")) else T.StringType()

    schemas = {}
    for table, body in _TABLE.findall(text):
        columns = [_COLUMN.match(part) for part in re.split(r",(?![^()]*\))", body)]
        schemas[plain(table)] = T.StructType(
            [T.StructField(c[1].lower(), kind(c[2]), "not null" not in c[3].lower()) for c in columns if c]
        )
    keys = {plain(table): column.lower() for table, column in _KEY.findall(text)}
    links = [ForeignKey(plain(t), c.lower(), plain(p), k.lower()) for t, c, p, k in _LINK.findall(text)]
    return Catalogue(schemas, keys, tuple(links))
