"""Schemas of the source tables. Ids are long; moments carry no time zone."""

from __future__ import annotations

SOURCE_SCHEMAS = {
    "person": "person_id long, gender string, birthdate date, voided int",
    "person_name": "person_id long, given_name string, family_name string, creator long, "
    "date_created timestamp_ntz, voided int",
    "person_address": "person_id long, address1 string, address2 string, voided int",
    "person_attribute": "person_id long, person_attribute_type_id long, value string, voided int",
    "patient": "patient_id long, date_created timestamp_ntz, voided int",
    "patient_identifier": "patient_id long, identifier string, identifier_type long, location_id long, voided int",
    "visit": "visit_id long, patient_id long, date_started timestamp_ntz, date_stopped timestamp_ntz, "
    "location_id long, creator long, date_created timestamp_ntz, voided int",
    "encounter": "encounter_id long, encounter_type long, patient_id long, location_id long, form_id long, "
    "encounter_datetime timestamp_ntz, visit_id long, voided int",
    "encounter_provider": "encounter_id long, provider_id long, voided int",
    "obs": "obs_id long, person_id long, concept_id long, encounter_id long, obs_datetime timestamp_ntz, "
    "location_id long, obs_group_id long, value_coded long, value_datetime timestamp_ntz, "
    "value_numeric double, value_text string, comments string, date_created timestamp_ntz, voided int",
    "location": "location_id long, name string",
    "location_attribute": "location_id long, attribute_type_id long, value_reference string",
    "concept": "concept_id long, uuid string",
    "concept_name": "concept_id long, locale string, name string, voided int",
    "encounter_type": "encounter_type_id long, name string, uuid string",
    "patient_identifier_type": "patient_identifier_type_id long, name string, uuid string",
    "person_attribute_type": "person_attribute_type_id long, name string, uuid string",
    "location_attribute_type": "location_attribute_type_id long, name string, uuid string",
}
