"""Disease surveillance: diagnoses, indicator events and their weekly counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions.scalars import day, live, not_voided
from medloom.operators.eav import Obs, sibling_groups
from medloom.operators.match import may_match
from medloom.operators.pick import first_and_last
from medloom.plans.shared import of_types
from medloom.sources.codes import resolve
from medloom.sources.dimensions import CONFIRMED, SUSPECTED, dimension
from medloom.sources.record import Record

DIAGNOSIS, CERTAINTY, ORDER = 1284, 159394, 159946
PRIMARY, SECONDARY = 159943, 159944


def diagnosis_answer(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Grouped diagnosis answers of primary-care and obstetric visits, with their form."""
    types = rec.codes.encounter(
        "obgyn_initial", "obgyn_followup", "adult_initial", "adult_followup", "ped_initial", "ped_followup"
    )
    forms = of_types(encounter_context, types).select(
        "encounter_id", F.col("location_id").alias("form_location"), "encounter_datetime", "encounter_voided"
    )
    answers = rec.obs.filter(
        (F.col("concept_id") == DIAGNOSIS) & F.col("value_coded").isNotNull() & F.col("obs_group_id").isNotNull()
    ).select("obs_id", "person_id", "encounter_id", "location_id", "obs_group_id", "concept_id", "value_coded", "voided")
    return answers.join(forms, "encounter_id")


def patient_diagnosis(rec: Record, diagnosis_answer: DataFrame) -> DataFrame:
    """Diagnoses. Grain: encounter, location, group concept, concept, answer."""
    # Any concept may head a diagnosis group, so the header is found by its id among all observations;
    # the stored answers are broadcast while they are small, and those that cannot be a header are not shuffled.
    head = rec.obs.select(
        F.col("obs_id").alias("obs_group_id"), F.col("concept_id").alias("concept_group"), "person_id", "encounter_id"
    )
    head = may_match(head, "obs_group_id", diagnosis_answer, "obs_group_id")
    rows = diagnosis_answer.join(head, ["obs_group_id", "person_id", "encounter_id"])
    # A key seen in two groups keeps the group of its first row, as the rest of that row.
    spine = first_and_last(
        rows.withColumnsRenamed({"person_id": "patient_id", "value_coded": "answer_concept_id"}),
        ["encounter_id", "location_id", "concept_group", "concept_id", "answer_concept_id"],
        ["patient_id", "obs_group_id", "form_location", "encounter_datetime", "encounter_voided"], ["voided"], "obs_id",
    )
    details = sibling_groups(
        rec.obs, None,
        {
            "suspected_confirmed": Obs((CERTAINTY,), (CONFIRMED, SUSPECTED), value="value_coded", pick="latest"),
            "primary_secondary": Obs((ORDER,), (PRIMARY, SECONDARY), value="value_coded", pick="latest"),
        },
    ).select(F.col("group_id").alias("obs_group_id"), "suspected_confirmed", "primary_secondary")
    dated = (F.col("form_location") == F.col("location_id")) & live("encounter_voided")
    return spine.join(details, "obs_group_id", "left").select(
        "patient_id", "encounter_id", "location_id",
        F.when(dated, day("encounter_datetime")).alias("encounter_date"), "concept_group", "obs_group_id",
        "concept_id", "answer_concept_id", "suspected_confirmed", "primary_secondary", "voided",
    )


def indicator_rules(spark: SparkSession, concept: DataFrame) -> DataFrame:
    """The rule table, with answers that are known by UUID looked up in the concept dictionary."""
    rules = dimension(spark, "indicator")
    found = resolve(rules, concept, "answer_uuid", "_answer")
    return found.withColumn(
        "answer_concept_id", F.coalesce(F.col("answer_concept_id").cast("long"), F.col("_answer"))
    ).drop("_answer", "answer_uuid").filter(F.col("answer_concept_id").isNotNull())


def indicator_events(patient_diagnosis: DataFrame, patient: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per rule and diagnosis that satisfies it. One join with the rule table does all rules."""
    rule = rules.select("rule_id", "written_type", "answer_concept_id", F.col("certainty").alias("_certainty"), "label")
    known = patient_diagnosis.filter((F.col("concept_id") == DIAGNOSIS) & not_voided()).join(
        patient.select("patient_id"), "patient_id", "left_semi"
    )
    hits = known.join(rule, "answer_concept_id").filter(
        F.col("_certainty").isNull() | (F.col("_certainty") == F.col("suspected_confirmed"))
    )
    return hits.select(
        "rule_id", "written_type", "label", "patient_id", "location_id", "encounter_id",
        F.col("encounter_date").alias("indicator_date"), "answer_concept_id", "obs_group_id", "voided",
    )


def indicators(rec: Record, patient_diagnosis: DataFrame, patient: DataFrame) -> DataFrame:
    """Indicator table. Grain: type written, patient, day.

    Two rules may write the same type (for one of them, the type of another rule); the first rule, then
    the lowest encounter, fills a key.
    """
    events = indicator_events(patient_diagnosis, patient, indicator_rules(rec.spark, rec.concept)).filter(
        F.col("indicator_date").isNotNull()
    )
    order = F.struct(F.col("rule_id").alias("_r"), F.col("encounter_id").alias("_e"), F.col("location_id").alias("_l"))
    return first_and_last(
        events, ["written_type", "patient_id", "indicator_date"], ["rule_id", "location_id", "encounter_id"],
        ["voided"], order,
    ).select(
        "rule_id", F.col("written_type").alias("indicator_type_id"), "patient_id", "location_id", "encounter_id",
        "indicator_date", "voided",
    )


def weekly_indicators(rec: Record, patient_diagnosis: DataFrame, patient: DataFrame) -> DataFrame:
    """Weekly report: patients and events per rule, location and week (weeks start on Monday)."""
    events = indicator_events(patient_diagnosis, patient, indicator_rules(rec.spark, rec.concept)).filter(
        F.col("indicator_date").isNotNull()
    )
    week = F.date_trunc("week", F.col("indicator_date")).cast("date").alias("week_start")
    # One row per patient and day first, so that the count of patients is a plain count of distinct rows.
    days = events.select("rule_id", "label", "location_id", week, "patient_id", "indicator_date").distinct()
    per_patient = days.groupBy("rule_id", "label", "location_id", "week_start", "patient_id").agg(
        F.count("*").alias("_days")
    )
    return per_patient.groupBy("rule_id", "label", "location_id", "week_start").agg(
        F.count("*").alias("patients"), F.sum("_days").alias("patient_days")
    )
