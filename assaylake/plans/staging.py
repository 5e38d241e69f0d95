"""Typed, one-row-per-resource staging relations.

Documents are flattened before the newest version is chosen: the shuffle then carries typed columns
instead of whole documents, and columns a consumer does not read are neither extracted nor shuffled.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.config import ETHNICITY_URL, LOINC_URI, RACE_URL, SNOMED_URI
from assaylake.functions import json as j
from assaylake.functions.scalars import reference_id
from assaylake.operators.versions import VERSION_ORDER, latest_version, updated_since
from assaylake.schemas.raw import FILE_URI, RUN_DATE
from assaylake.workspace import Workspace

_REFERENCE = "struct<reference:variant>"
_CODINGS = "struct<coding:array<struct<system:variant,code:variant,display:variant>>>"

PATIENT = {
    "gender": "variant",
    "birthDate": "variant",
    "deceasedDateTime": "variant",
    "deceasedBoolean": "variant",
    "identifier": "array<struct<value:variant,system:variant>>",
    "address": "array<struct<city:variant,state:variant,postalCode:variant,country:variant>>",
    "extension": "array<struct<url:variant,extension:array<struct<valueCoding:variant>>>>",
}
ENCOUNTER = {
    "subject": _REFERENCE,
    "period": "struct<start:variant,end:variant>",
    "class": "struct<code:variant,system:variant>",
    "status": "variant",
    "serviceProvider": _REFERENCE,
}
SPECIMEN = {
    "subject": _REFERENCE,
    "collection": "struct<collectedDateTime:variant,collectedPeriod:struct<start:variant>,"
    "bodySite:struct<coding:array<struct<system:variant,code:variant>>>>",
    "type": _CODINGS,
    "status": "variant",
}
REPORT = {
    "subject": _REFERENCE,
    "encounter": _REFERENCE,
    "effectiveDateTime": "variant",
    "effectivePeriod": "struct<start:variant>",
    "issued": "variant",
    "code": _CODINGS,
    "result": "array<struct<reference:variant>>",
    "status": "variant",
}
OBSERVATION = {
    "category": "array<struct<coding:array<struct<code:variant,display:variant>>,text:variant>>",
    "subject": _REFERENCE,
    "encounter": _REFERENCE,
    "specimen": _REFERENCE,
    "code": _CODINGS,
    "effectiveDateTime": "variant",
    "effectivePeriod": "struct<start:variant>",
    "issued": "variant",
    "valueQuantity": "struct<value:variant,comparator:variant,unit:variant,code:variant,system:variant>",
    "valueCodeableConcept": _CODINGS,
    "valueString": "variant",
    "referenceRange": "array<struct<low:struct<value:variant>,high:struct<value:variant>>>",
    "interpretation": "array<struct<coding:array<struct<code:variant>>>>",
    "performer": "array<struct<reference:variant>>",
    "status": "variant",
}


# Where a version comes from: kept in the stored relation, to bring it up to date by run date.
ORIGIN = (RUN_DATE, FILE_URI)


def _staged(
    source: DataFrame, members: Mapping[str, str], id_name: str, columns: Mapping[str, Column], origin: bool = False
) -> DataFrame:
    shaped = source.select("resource_id", *VERSION_ORDER, *j.shape(F.col("raw"), members))
    typed = shaped.select("resource_id", *VERSION_ORDER, *[c.alias(n) for n, c in columns.items()])
    return latest_version(typed).select(
        F.col("resource_id").alias(id_name), *columns, F.col("last_updated").alias("_loaded_at"), *(ORIGIN if origin else ())
    )


def _referenced(member: str) -> Column:
    return reference_id(j.text(F.col(member)["reference"]))


def stg_patient(ws: Workspace, origin: bool = False) -> DataFrame:
    identifier = j.first(F.col("identifier"))
    address = j.first(F.col("address"))
    single = ws.config.accept_single_coding_extension
    return _staged(
        ws.raw("Patient"),
        PATIENT,
        "fhir_patient_id",
        {
            "gender": j.text(F.col("gender")),
            "birth_date": j.day(F.col("birthDate")),
            "deceased_datetime": j.instant(F.col("deceasedDateTime")),
            "deceased_bool": j.boolean(F.col("deceasedBoolean")),
            "identifier_value": j.strict_text(identifier["value"]),
            "identifier_system": j.strict_text(identifier["system"]),
            "address_city": j.strict_text(address["city"]),
            "address_state": j.strict_text(address["state"]),
            "address_postal_code": j.strict_text(address["postalCode"]),
            "address_country": j.strict_text(address["country"]),
            "race_code": j.extension_code(F.col("extension"), RACE_URL, single),
            "ethnicity_code": j.extension_code(F.col("extension"), ETHNICITY_URL, single),
        },
        origin,
    )


def stg_encounter(ws: Workspace, origin: bool = False) -> DataFrame:
    return _staged(
        ws.raw("Encounter"),
        ENCOUNTER,
        "fhir_encounter_id",
        {
            "patient_ref": _referenced("subject"),
            "period_start": j.instant(F.col("period")["start"]),
            "period_end": j.instant(F.col("period")["end"]),
            "class_code": j.text(F.col("class")["code"]),
            "class_system": j.text(F.col("class")["system"]),
            "status": j.text(F.col("status")),
            "service_provider_ref": _referenced("serviceProvider"),
        },
        origin,
    )


def stg_specimen(ws: Workspace, origin: bool = False) -> DataFrame:
    collection = F.col("collection")
    return _staged(
        ws.raw("Specimen"),
        SPECIMEN,
        "fhir_specimen_id",
        {
            "patient_ref": _referenced("subject"),
            "collection_datetime": j.instant(collection["collectedDateTime"]),
            "collection_period_start": j.instant(collection["collectedPeriod"]["start"]),
            "type_snomed_code": j.code_for_system(F.col("type")["coding"], SNOMED_URI),
            "type_display": j.strict_text(j.first(F.col("type")["coding"])["display"]),
            "body_site_snomed_code": j.code_for_system(collection["bodySite"]["coding"], SNOMED_URI),
            "status": j.text(F.col("status")),
        },
        origin,
    )


def stg_diagnostic_report(ws: Workspace, origin: bool = False) -> DataFrame:
    codings = F.col("code")["coding"]
    # No array holds a NULL element: results without a usable reference are left out.
    children = F.filter(
        F.transform("result", lambda r: reference_id(j.strict_text(r["reference"]))), lambda i: i.isNotNull()
    )
    return _staged(
        ws.raw("DiagnosticReport"),
        REPORT,
        "fhir_report_id",
        {
            "patient_ref": _referenced("subject"),
            "encounter_ref": _referenced("encounter"),
            "effective_datetime": F.coalesce(
                j.instant(F.col("effectiveDateTime")), j.instant(F.col("effectivePeriod")["start"])
            ),
            "issued_datetime": j.instant(F.col("issued")),
            "report_loinc_code": j.code_for_system(codings, LOINC_URI),
            "report_display": j.strict_text(j.first(codings)["display"]),
            "child_observation_ids": F.coalesce(children, F.expr("array()").cast("array<string>")),
            "status": j.text(F.col("status")),
        },
        origin,
    )


def observation_versions(
    ws: Workspace, since: Column | None = None, days: Sequence[str] | None = None, origin: bool = False
) -> DataFrame:
    """Newest version of every observation with the columns of both halves and ``is_lab``.

    ``days`` reads these run dates only, which prunes to their partitions.

    The split by ``is_lab`` comes after the newest version is known: an older laboratory version
    must not survive a newer one of another category.
    """
    raw = updated_since(ws.raw("Observation"), since)
    if days is not None:
        raw = raw.filter(F.col(RUN_DATE).isin([datetime.date.fromisoformat(day) for day in days]))
    codings = F.col("code")["coding"]
    first_coding = j.first(codings)
    quantity = F.col("valueQuantity")
    value_codings = F.col("valueCodeableConcept")["coding"]
    reference_range = j.first(F.col("referenceRange"))
    return _staged(
        raw,
        OBSERVATION,
        "fhir_observation_id",
        {
            "is_lab": j.is_laboratory(F.col("category")),
            "patient_ref": _referenced("subject"),
            "encounter_ref": _referenced("encounter"),
            "specimen_ref": _referenced("specimen"),
            "loinc_code": j.code_for_system(codings, LOINC_URI),
            "snomed_code": j.code_for_system(codings, SNOMED_URI),
            "source_code": j.strict_text(first_coding["code"]),
            "source_code_system": j.strict_text(first_coding["system"]),
            "source_code_display": j.strict_text(first_coding["display"]),
            "effective_datetime": j.instant(F.col("effectiveDateTime")),
            "effective_period_start": j.instant(F.col("effectivePeriod")["start"]),
            "issued_datetime": j.instant(F.col("issued")),
            "value_number": j.number(quantity["value"]),
            "comparator": j.text(quantity["comparator"]),
            "unit_source": j.text(quantity["unit"]),
            "unit_ucum_code": j.text(quantity["code"]),
            "unit_system": j.text(quantity["system"]),
            "value_snomed_code": j.code_for_system(value_codings, SNOMED_URI),
            "value_codeable_display": j.strict_text(j.first(value_codings)["display"]),
            "value_string": j.text(F.col("valueString")),
            "range_low": j.number(reference_range["low"]["value"]),
            "range_high": j.number(reference_range["high"]["value"]),
            "interpretation_code": j.first_nested_code(F.col("interpretation")),
            "performer_ref": reference_id(j.strict_text(j.first(F.col("performer"))["reference"])),
            "status": j.text(F.col("status")),
        },
        origin,
    )


def laboratory_half(versions: DataFrame) -> DataFrame:
    return versions.filter("is_lab").select(
        "fhir_observation_id",
        "patient_ref",
        "encounter_ref",
        "specimen_ref",
        "loinc_code",
        "source_code",
        "source_code_system",
        "source_code_display",
        "effective_datetime",
        "effective_period_start",
        "issued_datetime",
        "value_number",
        "comparator",
        "unit_source",
        "unit_ucum_code",
        "unit_system",
        F.col("value_snomed_code").alias("value_codeable_snomed_code"),
        "value_codeable_display",
        "value_string",
        "range_low",
        "range_high",
        "interpretation_code",
        "performer_ref",
        "status",
        "_loaded_at",
    )


def stg_observation_lab(ws: Workspace) -> DataFrame:
    return laboratory_half(ws.model("observation_versions"))


def stg_observation_nonlab(ws: Workspace) -> DataFrame:
    return other_half(ws.model("observation_versions"))


def other_half(versions: DataFrame) -> DataFrame:
    return versions.filter("not is_lab").select(
        "fhir_observation_id",
        "patient_ref",
        "encounter_ref",
        "loinc_code",
        "snomed_code",
        "source_code",
        "source_code_system",
        "source_code_display",
        "effective_datetime",
        "effective_period_start",
        "value_number",
        "unit_source",
        "unit_ucum_code",
        "value_string",
        "value_codeable_display",
        "value_snomed_code",
        "_loaded_at",
    )
