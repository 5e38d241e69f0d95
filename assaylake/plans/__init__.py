"""Models by name, in dependency order."""

from assaylake.plans import lookups, marts, staging

MODELS = {
    "stg_patient": staging.stg_patient,
    "stg_encounter": staging.stg_encounter,
    "stg_specimen": staging.stg_specimen,
    "stg_diagnostic_report": staging.stg_diagnostic_report,
    "observation_versions": staging.observation_versions,
    "stg_observation_lab": staging.stg_observation_lab,
    "stg_observation_nonlab": staging.stg_observation_nonlab,
    "loinc_lookup": lookups.loinc_lookup,
    "ucum_lookup": lookups.ucum_lookup,
    "snomed_value_lookup": lookups.snomed_value_lookup,
    "operator_lookup": lookups.operator_lookup,
    "source_code_lookup": lookups.source_code_lookup,
    "report_child_obs": lookups.report_child_obs,
    "omop_location": marts.omop_location,
    "omop_person": marts.omop_person,
    "omop_visit_occurrence": marts.omop_visit_occurrence,
    "omop_visit_detail": marts.omop_visit_detail,
    "omop_specimen": marts.omop_specimen,
    "omop_measurement": marts.omop_measurement,
    "omop_observation": marts.omop_observation,
    "omop_fact_relationship": marts.omop_fact_relationship,
    "omop_cdm_source": marts.omop_cdm_source,
}
