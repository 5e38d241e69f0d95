"""The nine vocabulary tables."""

from __future__ import annotations

from pyspark.sql import types as T

# OMOP CDM v5.4 vocabulary columns in declared order; ``!`` marks a required one.
_COLUMNS = {
    "concept": """concept_id:long! concept_name:text! domain_id:text! vocabulary_id:text! concept_class_id:text!
        standard_concept:text concept_code:text! valid_start_date:date! valid_end_date:date! invalid_reason:text""",
    "concept_relationship": """concept_id_1:long! concept_id_2:long! relationship_id:text! valid_start_date:date!
        valid_end_date:date! invalid_reason:text""",
    "concept_ancestor": """ancestor_concept_id:long! descendant_concept_id:long! min_levels_of_separation:long!
        max_levels_of_separation:long!""",
    "concept_synonym": "concept_id:long! concept_synonym_name:text! language_concept_id:long!",
    "concept_class": "concept_class_id:text! concept_class_name:text! concept_class_concept_id:long!",
    "domain": "domain_id:text! domain_name:text! domain_concept_id:long!",
    "drug_strength": """drug_concept_id:long! ingredient_concept_id:long! amount_value:number
        amount_unit_concept_id:long numerator_value:number numerator_unit_concept_id:long denominator_value:number
        denominator_unit_concept_id:long box_size:long valid_start_date:date! valid_end_date:date!
        invalid_reason:text""",
    "relationship": """relationship_id:text! relationship_name:text! is_hierarchical:text! defines_ancestry:text!
        reverse_relationship_id:text! relationship_concept_id:long!""",
    "vocabulary": """vocabulary_id:text! vocabulary_name:text! vocabulary_reference:text vocabulary_version:text
        vocabulary_concept_id:long!""",
}
_TYPES = {
    "long": T.LongType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "number": T.DecimalType(38, 9),
}


def _schema(columns: str) -> T.StructType:
    fields = []
    for column in columns.split():
        name, kind = column.rstrip("!").split(":")
        fields.append(T.StructField(name, _TYPES[kind], not column.endswith("!")))
    return T.StructType(fields)


VOCABULARY_SCHEMAS: dict[str, T.StructType] = {name: _schema(columns) for name, columns in _COLUMNS.items()}


def required_columns(table: str) -> list[str]:
    """Columns that must be filled; file readers do not enforce it, so a check does."""
    return [f.name for f in VOCABULARY_SCHEMAS[table].fields if not f.nullable]
