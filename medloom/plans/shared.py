"""Frames that many reports read. Each is built once per run and written to the warehouse.

An encounter belongs to one person and one location, and the members of an observation group share
the encounter of their header; the reports rely on that, as the record does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import live
from medloom.operators.eav import Obs, sibling_groups
from medloom.sources.codes import is_any
from medloom.sources.record import Record

DRUG = 1282
DISPENSED, PRESCRIBED = 163711, 1442
DISPENSED_DATE, POSOLOGY, DAYS, PILLS, RX = 1276, 1444, 159368, 1443, 160742
TREATMENT, PROPHYLAXIS = 138405, 163768


def encounter_context(rec: Record) -> DataFrame:
    """One row per encounter, with its visit when there is one."""
    visit = rec.visit.select(
        "visit_id",
        F.col("patient_id").alias("visit_patient_id"),
        F.col("location_id").alias("visit_location_id"),
        F.col("date_started").alias("visit_date"),
        F.col("date_stopped").alias("visit_stopped"),
        F.col("creator").alias("visit_creator"),
        F.col("date_created").alias("visit_created"),
        F.col("voided").alias("visit_voided"),
        F.lit(True).alias("in_visit"),
    )
    encounter = rec.encounter.select(
        "encounter_id", "encounter_type", "patient_id", "location_id", "form_id", "encounter_datetime",
        "visit_id", F.col("voided").alias("encounter_voided"),
    )
    return encounter.join(visit, "visit_id", "left").withColumn(
        "in_visit", F.coalesce("in_visit", F.lit(False))
    )


def encounter_seen(rec: Record) -> DataFrame:
    """What several reports ask of all observations of an encounter, whatever they are about, from one pass:
    whether any is live, the first and the last one, and whether the last is voided. Grain: encounter, person."""
    return rec.obs.groupBy("encounter_id", "person_id").agg(
        F.max(F.when(live(), F.lit(True))).alias("any_live"),
        F.min("obs_id").alias("first_obs"), F.max("obs_id").alias("last_obs"), F.max_by("voided", "obs_id").alias("last_voided"),
    )


def drug_group(rec: Record) -> DataFrame:
    """One row per observation group that orders or hands out a drug."""
    siblings = (POSOLOGY, DAYS, PILLS, DISPENSED_DATE)
    alt = rec.codes.concept("posology_alt")
    return sibling_groups(
        rec.obs,
        [DISPENSED, PRESCRIBED],
        {
            "detail_time": Obs(siblings, value="obs_datetime", pick="latest", any_voided=True),
            "has_detail": Obs(siblings, any_voided=True),
            "has_order_detail": Obs((RX, *siblings), any_voided=True),
            "handed_time": Obs((DISPENSED_DATE,), value="obs_datetime", pick="latest", at=True),
            "rx": Obs((RX,), value="value_coded", pick="latest", at=True),
            "posology": Obs((POSOLOGY,), value="value_text", pick="latest", at=True),
            "posology_alt": Obs(alt, value="value_text", pick="latest", at=True),
            "days": Obs((DAYS,), value="value_numeric", pick="latest", at=True),
            "pills": Obs((PILLS,), value="value_numeric", pick="latest", at=True),
            "live_details": Obs((RX, *siblings), pick="count"),
            "first_detail_encounter": Obs((RX, *siblings), value="encounter_id", pick="min"),
            "last_detail_encounter": Obs((RX, *siblings), value="encounter_id", pick="max"),
        },
    )


def drug_order(rec: Record, drug_group: DataFrame) -> DataFrame:
    """Every drug named in a group, with what its group says about it."""
    drugs = rec.obs.filter((F.col("concept_id") == DRUG) & F.col("obs_group_id").isNotNull()).select(
        "obs_id", "person_id", "encounter_id", "location_id", "obs_group_id",
        F.col("value_coded").alias("drug_id"), "obs_datetime", "voided",
    )
    return drugs.join(drug_group.withColumnRenamed("group_id", "obs_group_id"), "obs_group_id").withColumn(
        "in_group",
        F.coalesce(
            (F.col("header_person") == F.col("person_id"))
            & (F.col("header_encounter") == F.col("encounter_id")),
            F.lit(False),
        ),
    )


def provider(rec: Record, live_only: bool = True) -> DataFrame:
    """One provider per encounter."""
    rows = rec.encounter_provider.filter(live()) if live_only else rec.encounter_provider
    return rows.groupBy("encounter_id").agg(F.max("provider_id").alias("provider_id"))


def visit_of(context: DataFrame, live_only: bool = False) -> DataFrame:
    """Visit id and date by encounter."""
    rows = context.filter("in_visit")
    if live_only:
        rows = rows.filter(live("visit_voided"))
    return rows.select("encounter_id", "visit_id", "visit_date")


def encounter_day(context: DataFrame) -> DataFrame:
    return context.select("encounter_id", F.to_date("encounter_datetime").alias("encounter_date"))


def of_types(context: DataFrame, types: list[int]) -> DataFrame:
    return context.filter(is_any("encounter_type", types))
