"""Settings that change results, kept in one immutable object."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# OMOP concept ids the marts write as constants.
EHR_RECORD = 32817
LAB_RESULT_RECORD = 32879
SPECIMEN_FROM_MEASUREMENT = 581378
OBSERVATION_FROM_EHR = 38000280
MEASUREMENT_DOMAIN = 21
SPECIMEN_DOMAIN = 36
HAS_SPECIMEN = 32676
SPECIMEN_OF = 32677

# Code-system and profile URIs, from the public FHIR R4 and US Core specifications.
LOINC_URI = "http://loinc.org"
SNOMED_URI = "http://snomed.info/sct"
RACE_URL = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-race"
ETHNICITY_URL = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-ethnicity"

# Resource types that are landed, and those that must hold rows.
RESOURCE_TYPES = (
    "Patient",
    "Encounter",
    "DiagnosticReport",
    "Observation",
    "Specimen",
    "Practitioner",
    "Organization",
    "Location",
)
REQUIRED_RESOURCE_TYPES = ("Patient", "Observation", "DiagnosticReport", "Specimen")
REQUIRED_VOCABULARY_TABLES = ("concept", "concept_relationship", "concept_ancestor", "vocabulary")


@dataclass(frozen=True)
class CdmSourceInfo:
    """Free text of the one-row ``cdm_source`` table; every site supplies its own."""

    name: str = "Clinical laboratory CDM"
    abbreviation: str = "lab-cdm"
    holder: str = "Unnamed site"
    description: str = "FHIR R4 bulk exports mapped to OMOP CDM v5.4"
    documentation_reference: str = "Internal"
    cdm_version: str = "v5.4"


@dataclass(frozen=True)
class EngineConfig:
    lab_result_type_concept_id: int = 32856
    unknown_concept_id: int = 0

    hash_person_source_value: bool = False
    person_source_value_pepper: str = ""
    pepper_variable: str = "DBT_PEPPER"

    # How texts become 64-bit keys, see ``functions/scalars.py``: "md5", or "farm" for the ids of warehouses keyed by FarmHash.
    key_hash: str = "md5"

    # US Core sends race and ethnicity as one object; False accepts only an array.
    accept_single_coding_extension: bool = True

    # A lookup is broadcast only when it is proven to hold no more rows than this;
    # beyond it the join shuffles, with hot codes spread over ``salt_buckets``.
    broadcast_row_limit: int = 2_000_000
    salt_buckets: int = 32

    # Most partitions a shuffle may start with; a cluster that handles more small blocks may raise it.
    most_shuffle_partitions: int = 200_000

    # Rows that one hash bucket of a maintained table should hold.
    rows_per_bucket: int = 2_000_000

    cdm_source: CdmSourceInfo = field(default_factory=CdmSourceInfo)

    @property
    def pepper(self) -> str:
        return self.person_source_value_pepper or os.environ.get(self.pepper_variable, "")

    def require_pepper(self) -> str:
        if not self.pepper:
            raise ValueError(
                "hash_person_source_value needs person_source_value_pepper "
                f"or the environment variable {self.pepper_variable}"
            )
        return self.pepper
