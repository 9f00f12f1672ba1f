"""Demographic and visit marts: patient, location, patient_visit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import POSITIVE, day, filled, live
from medloom.operators.eav import Obs, collect_obs
from medloom.operators.merge import keep_matching
from medloom.operators.pick import first_and_last
from medloom.plans.shared import DISPENSED
from medloom.sources.codes import is_any
from medloom.sources.dimensions import ARV_DRUG_IDS
from medloom.sources.record import Record

NEXT_VISIT, NEXT_REFILL = 5096, 162549


def location(rec: Record) -> DataFrame:
    """Sites that carry a site code. Grain: location."""
    code = rec.location_attribute.filter(
        is_any("attribute_type_id", rec.codes.location_attribute("site_code"))
    )
    codes = code.groupBy("location_id").agg(F.max("value_reference").alias("site_code"))
    return rec.location.join(codes, "location_id").select("location_id", "name", "site_code")


def _names(rec: Record) -> DataFrame:
    latest = first_and_last(
        rec.person_name,
        ["person_id"],
        [],
        ["given_name", "family_name", "creator", "date_created", "voided"],
        F.struct("date_created", "given_name", "family_name"),
    )
    return (
        latest.join(rec.person.select("person_id", "gender", "birthdate"), "person_id")
        .join(rec.patient.select(F.col("patient_id").alias("person_id")), "person_id", "left_semi")
        .withColumnRenamed("person_id", "patient_id")
        .withColumn("date_created", day("date_created"))
    )


def _identifiers(rec: Record) -> DataFrame:
    def of(name: str, must_live: bool = False):
        cond = is_any("identifier_type", rec.codes.identifier(name))
        return cond & live() if must_live else cond

    return rec.patient_identifier.groupBy("patient_id").agg(
        F.max(F.when(of("st_code", True), F.col("identifier"))).alias("st_id"),
        F.max(F.when(of("pc_code", True), F.col("identifier"))).alias("pc_id"),
        F.max(F.when(of("national_id"), F.col("identifier"))).alias("national_id"),
        F.max(F.when(of("main_id"), F.col("identifier"))).alias("identifier"),
        F.max(F.when(of("legacy_id"), F.col("identifier"))).alias("legacy_id"),
        F.max(F.when(of("main_id"), F.col("location_id"))).alias("location_id"),
    )


def _address(rec: Record) -> DataFrame:
    both = F.concat_ws(" ", "address1", "address2")
    text = F.when(filled("address1") & filled("address2"), both)
    text = text.when(filled("address1"), F.col("address1")).otherwise(F.col("address2"))
    return rec.person_address.groupBy(F.col("person_id").alias("patient_id")).agg(
        F.max(text).alias("last_address")
    )


def _attributes(rec: Record) -> DataFrame:
    def of(name: str):
        return F.max(
            F.when(is_any("person_attribute_type_id", rec.codes.person_attribute(name)), F.col("value"))
        )

    return rec.person_attribute.groupBy(F.col("person_id").alias("patient_id")).agg(
        of("birthplace").alias("place_of_birth"),
        of("telephone").alias("telephone"),
        of("mother_name").alias("mother_name"),
    )


def _observed(rec: Record) -> DataFrame:
    moment = F.col("value_datetime")
    facts = collect_obs(
        rec.obs,
        "person_id",
        {
            "marital_status": Obs((1054,), value="value_coded", pick="latest", any_voided=True),
            "occupation": Obs((1542,), value="value_coded", pick="latest", any_voided=True),
            "next_visit_date": Obs((NEXT_VISIT, NEXT_REFILL), value=day("value_datetime")),
            "transferred_in": Obs((159936,), (5622,), any_voided=True),
            "date_transferred_in": Obs(
                rec.codes.concept("first_care_date"), value=day("value_datetime"),
                where=moment.isNotNull(), pick="latest", any_voided=True,
            ),
            "date_started_arv_other_site": Obs(
                (159599,), value=day("value_datetime"), where=moment.isNotNull(), pick="latest",
                any_voided=True,
            ),
        },
    )
    return facts.withColumnRenamed("person_id", "patient_id")


def _contact(rec: Record) -> DataFrame:
    named = rec.obs.filter((F.col("concept_id") == 163258) & filled("value_text"))
    head = rec.obs.filter(F.col("concept_id") == 165210).select(
        F.col("obs_id").alias("obs_group_id"), F.col("person_id").alias("patient_id")
    )
    rows = named.join(head, "obs_group_id").filter(F.col("person_id") == F.col("patient_id"))
    return rows.groupBy("patient_id").agg(
        F.max_by("value_text", F.struct("obs_datetime", "obs_id")).alias("contact_name")
    )


def hiv_positive_forms(rec: Record, encounter: DataFrame) -> DataFrame:
    """Patients with a live HIV form. `encounter` is the source table."""
    types = rec.codes.encounter("first_hiv", "followup_hiv", "ped_first_hiv", "ped_followup_hiv")
    return encounter.filter(is_any("encounter_type", types) & live()).select("patient_id").distinct()


def hiv_positive(rec: Record) -> DataFrame:
    """Patients with a live HIV form, or a live positive HIV test on a live laboratory form."""
    tests = rec.obs.filter(
        F.col("concept_id").isin(1040, 1042) & (F.col("value_coded") == POSITIVE) & live()
    ).select("encounter_id", F.col("person_id").alias("patient_id"))
    labs = rec.encounter.filter(is_any("encounter_type", rec.codes.encounter("lab")) & live())
    tested = keep_matching(labs, tests, ["encounter_id", "patient_id"]).select("patient_id")
    return hiv_positive_forms(rec, rec.encounter).unionByName(tested).distinct()


def _visits(rec: Record) -> DataFrame:
    # The date is kept only when a live visit started at that very moment.
    ends = rec.visit.groupBy("patient_id").agg(
        F.min("date_started").alias("_first"),
        F.min(F.when(live(), F.col("date_started"))).alias("_first_live"),
        F.max("date_started").alias("_last"),
        F.max(F.when(live(), F.col("date_started"))).alias("_last_live"),
    )
    return ends.select(
        "patient_id",
        F.when(F.col("_first") == F.col("_first_live"), F.col("_first")).alias("first_visit_date"),
        F.when(F.col("_last") == F.col("_last_live"), F.col("_last")).alias("last_visit_date"),
    )


def _arv_start(drug_order: DataFrame) -> DataFrame:
    handed = drug_order.filter(
        (F.col("header_concept") == DISPENSED)
        & F.col("has_detail").isNotNull()
        & live()
        & F.col("drug_id").isin(ARV_DRUG_IDS)
    )
    return handed.groupBy(F.col("person_id").alias("patient_id")).agg(
        F.min("obs_datetime").alias("date_started_arv")
    )


def patient(rec: Record, drug_order: DataFrame, location: DataFrame) -> DataFrame:
    """One row per patient. `arv_status` is filled by the status job."""
    on = "patient_id"
    out = _names(rec)
    for part in (
        _identifiers(rec), _address(rec), _attributes(rec), _observed(rec), _contact(rec), _visits(rec),
        _arv_start(drug_order),
        hiv_positive(rec).withColumn("vih_status", F.lit(1)),
    ):
        out = out.join(part, on, "left")
    out = out.join(location.select("location_id", "site_code"), "location_id", "left")
    return out.withColumn("vih_status", F.coalesce("vih_status", F.lit(0))).select(
        "patient_id", "identifier", "st_id", "pc_id", "national_id", "legacy_id", "location_id", "site_code",
        "given_name", "family_name", "gender", "birthdate", "telephone", "last_address", "mother_name",
        "contact_name", "occupation", "marital_status", "place_of_birth", "creator", "date_created",
        "first_visit_date", "last_visit_date", "next_visit_date", "date_started_arv", "transferred_in",
        "date_transferred_in", "date_started_arv_other_site", "vih_status", "voided",
    )


def patient_visit(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Visits at which a next visit was planned. Grain: patient, encounter, location."""
    planned = collect_obs(
        rec.obs, ["encounter_id", "person_id"],
        {"next_visit_date": Obs((NEXT_VISIT,), value=day("value_datetime"), pick="latest")},
    )
    context = encounter_context.filter(
        F.col("in_visit") & (F.col("visit_patient_id") == F.col("patient_id"))
    ).withColumnRenamed("patient_id", "person_id")
    return context.join(planned, ["encounter_id", "person_id"]).select(
        F.col("person_id").alias("patient_id"), "encounter_id",
        F.col("visit_location_id").alias("location_id"), "visit_id", day("visit_date").alias("visit_date"),
        day("visit_date").alias("start_date"), day("visit_stopped").alias("stop_date"),
        F.col("visit_creator").alias("creator"), "encounter_type", "form_id", "next_visit_date",
        F.col("visit_voided").alias("voided"),
    )
