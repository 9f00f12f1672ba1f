"""Vaccination history: one row per given vaccine, and the dates of doses 0 to 8 side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import not_voided, round_int
from medloom.operators.eav import Obs, sibling_groups
from medloom.operators.pick import first_and_last
from medloom.sources.codes import resolve
from medloom.sources.dimensions import dimension
from medloom.sources.record import Record

HISTORY, GIVEN, SEQUENCE, GIVEN_ON = 1421, 984, 1418, 1410
DOSES = range(9)


def vaccines(rec: Record) -> DataFrame:
    """The vaccine dictionary with the concept ids of this site."""
    return resolve(dimension(rec.spark, "vaccine"), rec.concept, "uuid", "vaccine_concept_id").select(
        "id", "vaccine_concept_id", "vaccine_name", "uuid"
    )


def patient_immunization(rec: Record) -> DataFrame:
    """Vaccines of the vaccination history. Grain: patient, group, vaccine."""
    groups = sibling_groups(
        rec.obs, [HISTORY],
        {
            "dose": Obs((SEQUENCE,), value="value_numeric", pick="latest", any_voided=True),
            "vaccine_date": Obs((GIVEN_ON,), value="value_datetime", pick="latest", any_voided=True),
        },
    ).filter(F.col("header_concept").isNotNull()).select(
        F.col("group_id").alias("obs_group_id"), "dose", "vaccine_date"
    )
    given = rec.obs.filter((F.col("concept_id") == GIVEN) & F.col("obs_group_id").isNotNull()).select(
        F.col("person_id").alias("patient_id"), "location_id", "encounter_id", "obs_group_id",
        F.col("value_coded").alias("vaccine_concept_id"), F.col("obs_datetime").alias("encounter_date"),
        "voided", "obs_id",
    )
    uuids = rec.concept.select(F.col("concept_id").alias("vaccine_concept_id"), F.col("uuid").alias("vaccine_uuid"))
    rows = first_and_last(
        given.join(groups, "obs_group_id"), ["patient_id", "obs_group_id", "vaccine_concept_id"],
        ["location_id", "encounter_id", "encounter_date", "dose", "vaccine_date"], ["voided"], "obs_id",
    )
    return rows.join(uuids, "vaccine_concept_id").select(
        "patient_id", "location_id", "encounter_id", F.col("obs_group_id").alias("vaccine_obs_group_id"),
        "vaccine_concept_id", "dose", "vaccine_date", "encounter_date", "vaccine_uuid", "voided",
    )


def immunization_dose(patient_immunization: DataFrame) -> DataFrame:
    """Date of each dose number, one row per patient and vaccine; the latest date of a number is kept."""
    rows = patient_immunization.filter(not_voided())
    number = round_int("dose")
    return rows.groupBy("patient_id", "vaccine_concept_id").agg(
        *[F.max(F.when(number == n, F.col("vaccine_date"))).alias(f"dose{n}") for n in DOSES]
    )
