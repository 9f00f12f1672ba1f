"""Recognition of drug regimens from prescriptions, and the patient summary that goes back to the record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import YES, day, not_voided
from medloom.operators.merge import delete_matching, upsert
from medloom.operators.pick import first_and_last

SITE_DAY = ["location_id", "patient_id", "visit_date"]


def regimen_events(prescription: DataFrame, patient: DataFrame, regimen: DataFrame) -> DataFrame:
    """Regimens whose drugs were prescribed together (same site, patient and visit time).

    The drugs of a visit are gathered into a set of catalogue drugs, which the regimen catalogue bounds,
    and compared with the catalogue by membership: one shuffle, and no pairs or triples of drugs.
    """
    catalogue = regimen.select("drug1", "drug2", "drug3", "short_name").distinct()
    listed = (
        catalogue.select(F.explode(F.expr("array(bigint(drug1), bigint(drug2), bigint(drug3))")).alias("drug_id"))
        .filter("drug_id <> 0")
        .distinct()
    )
    valid = (
        prescription.filter(not_voided() & F.col("visit_date").isNotNull())
        .withColumn("drug_id", F.col("drug_id").cast("long"))
        .join(listed, "drug_id", "left_semi")
    )
    sets = valid.groupBy(*SITE_DAY).agg(
        F.collect_set("drug_id").alias("_drugs"),
        F.collect_set(
            F.when(F.col("arv_drug") == YES, F.struct(F.col("drug_id").alias("d"), F.col("rx_or_prophy").alias("rx")))
        ).alias("_first"),
    )
    sets = sets.filter(F.size("_first") > 0).join(patient.select("patient_id"), "patient_id", "left_semi")
    firsts = sets.select(*SITE_DAY, "_drugs", F.explode("_first").alias("_f"))
    matched = firsts.join(catalogue, F.col("_f.d") == F.col("drug1")).filter(
        ((F.col("drug2") == 0) | F.array_contains("_drugs", F.col("drug2").cast("long")))
        & ((F.col("drug3") == 0) | F.array_contains("_drugs", F.col("drug3").cast("long")))
    )
    return matched.select(
        "location_id", "patient_id", day("visit_date").alias("visit_date"), F.col("short_name").alias("regimen"),
        F.col("_f.rx").alias("rx_or_prophy"), F.col("visit_date").alias("visit_time"), "drug1",
    )


def regimen_table(events: DataFrame) -> DataFrame:
    """Grain: location, patient, day, regimen. The latest visit time of the day gives the kind of use."""
    order = F.struct("visit_time", F.coalesce("rx_or_prophy", F.lit(0)), "drug1")
    return first_and_last(
        events, ["location_id", "patient_id", "visit_date", "regimen"], [], ["rx_or_prophy"], order
    )


def regimens(patient_prescription: DataFrame, patient: DataFrame, regimen: DataFrame) -> DataFrame:
    return regimen_table(regimen_events(patient_prescription, patient, regimen))


def merge_regimens(history: DataFrame, prescription: DataFrame, fresh: DataFrame) -> DataFrame:
    """Drop days whose prescription was voided since, then add the fresh rows."""
    voided = prescription.filter(F.col("voided") == 1).select(
        "patient_id", "location_id", day("visit_date").alias("visit_date")
    ).distinct()
    kept = delete_matching(history, voided, ["patient_id", "location_id", "visit_date"])
    return upsert(
        kept, fresh, ["location_id", "patient_id", "visit_date", "regimen"], ["rx_or_prophy"], "rx_or_prophy"
    )


def latest_regimen(table: DataFrame) -> DataFrame:
    """Regimen of each patient's latest day; the last one by name when a day has several."""
    return first_and_last(
        table.select("patient_id", "visit_date", "regimen", "location_id"), ["patient_id"], [], ["regimen", "visit_date"],
        F.struct(F.col("visit_date").alias("_d"), F.col("regimen").alias("_r"), F.col("location_id").alias("_l")),
    ).withColumnsRenamed({"regimen": "arv_regimen", "visit_date": "date_created"})


def patient_summary(
    patient: DataFrame, current_status: DataFrame, regimens: DataFrame, arv_status: DataFrame
) -> DataFrame:
    """Regimen, status label, start of treatment and next visit, one row per patient that has any of them."""
    labels = arv_status.select(F.col("id").alias("arv_status_id"), F.col("name_fr").alias("arv_status"))
    known = (
        patient.select("patient_id", "date_started_arv", "next_visit_date")
        .join(current_status.select("patient_id", F.col("arv_status").alias("arv_status_id")), "patient_id", "left")
        .filter(
            F.col("arv_status_id").isNotNull() | F.col("next_visit_date").isNotNull() | F.col("date_started_arv").isNotNull()
        )
        .join(labels, "arv_status_id", "left")
        .select("patient_id", "arv_status", day("date_started_arv").alias("date_started_arv"), "next_visit_date")
    )
    regimen = latest_regimen(regimens).select("patient_id", "arv_regimen")
    return known.join(regimen, "patient_id", "full_outer").select(
        "patient_id", "arv_status", "arv_regimen", "date_started_arv", "next_visit_date"
    )
