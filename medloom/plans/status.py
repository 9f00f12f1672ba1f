"""Treatment status of patients on a given day, and exposed infants.

Statuses: 1 died, 2 transferred, 3 stopped (on treatment); 4 died, 5 transferred (before treatment);
6 regular, 8 missed appointment, 9 lost (on treatment); 7 recent, 10 lost, 11 active (before treatment).
Rules that read the same rows are one pass that names the status of each row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import (
    NEGATIVE, POSITIVE, YES, day, days_between, labels, live, mysql_num, not_voided, whole_units,
)
from medloom.operators.match import match_next
from medloom.operators.merge import delete_matching
from medloom.operators.pick import latest_per_key
from medloom.plans.programme import ADHERENCE, DIED, PREFERENCE, STOP_DETAIL, STOP_REASON, STOPPED, TRANSFERRED
from medloom.plans.shared import PROPHYLAXIS, of_types
from medloom.sources.codes import is_any
from medloom.sources.record import Record

OUT = ["patient_id", "id_status", "start_date", "encounter_id"]
# The order in which the rules write; of several statuses on a day the last one written is current.
WRITTEN = {s: n for n, s in enumerate((4, 5, 6, 8, 9, 10, 7, 11, 1, 2, 3))}


def _today(as_of) -> Column:
    return F.lit(as_of).cast("date")


def _per_patient(rows: DataFrame) -> DataFrame:
    """One row per patient and status: the latest day, and the highest encounter of that day."""
    best = rows.groupBy("patient_id", "id_status").agg(F.max(F.struct("start_date", "encounter_id")).alias("_b"))
    return best.select("patient_id", "id_status", "_b.start_date", "_b.encounter_id")


def _live_forms(context: DataFrame) -> DataFrame:
    return context.filter(not_voided("encounter_voided"))


def _latest_visits(rec: Record) -> DataFrame:
    return rec.visit.filter(live()).groupBy(F.col("patient_id").alias("visit_patient_id")).agg(
        F.max(day("date_started")).alias("_latest")
    )


def _patients_with(reasons: DataFrame, *codes: int) -> DataFrame:
    return reasons.filter(F.col("reason").isin(*codes)).select("patient_id").distinct()


def _stop_answers(rec: Record, context: DataFrame, any_form: bool = False) -> DataFrame:
    """Reasons given on discontinuation forms."""
    forms = of_types(context if any_form else _live_forms(context), rec.codes.encounter("discontinuation"))
    reasons = rec.obs.filter(
        (F.col("concept_id") == STOP_REASON) & F.col("value_coded").isin(DIED, TRANSFERRED, STOPPED) & not_voided()
    ).select("encounter_id", F.col("person_id").alias("patient_id"), F.col("value_coded").alias("reason"))
    return forms.join(reasons, ["encounter_id", "patient_id"])


def left_on_treatment(rec: Record, context: DataFrame, on_arv: DataFrame) -> DataFrame:
    """Statuses 1, 2 and 3. Stopping counts only with a valid detail on the same form."""
    detail = rec.obs.filter(
        (F.col("concept_id") == STOP_DETAIL) & F.col("value_coded").isin(ADHERENCE, PREFERENCE) & not_voided()
    ).select("encounter_id").distinct().withColumn("_detail", F.lit(True))
    rows = (
        _stop_answers(rec, context)
        .join(on_arv.select("patient_id"), "patient_id", "left_semi")
        .join(detail, "encounter_id", "left")
        .filter((F.col("reason") != STOPPED) | F.col("_detail"))
    )
    return _per_patient(
        rows.select(
            "patient_id", labels("reason", {DIED: 1, TRANSFERRED: 2, STOPPED: 3}).alias("id_status"),
            day("encounter_datetime").alias("start_date"), "encounter_id",
        )
    )


def left_before_treatment(
    rec: Record, context: DataFrame, patient: DataFrame, on_arv: DataFrame, any_state: bool = False
) -> DataFrame:
    """Statuses 4 and 5: the discontinuation form belongs to the patient's latest visit day.

    `any_state` also takes voided forms and voided patients, as the incremental run does.
    """
    people = patient.filter(F.col("vih_status") == 1)
    if not any_state:
        people = people.filter(live())
    rows = (
        _stop_answers(rec, context, any_state)
        .filter(F.col("in_visit") & F.col("reason").isin(DIED, TRANSFERRED))
        .join(_latest_visits(rec), "visit_patient_id")
        .filter(day("visit_date") == F.col("_latest"))
        .join(people.select(F.col("patient_id").alias("visit_patient_id")), "visit_patient_id", "left_semi")
        .join(on_arv.select("patient_id"), "patient_id", "left_anti")
    )
    return _per_patient(
        rows.select(
            F.col("visit_patient_id").alias("patient_id"),
            labels("reason", {DIED: 4, TRANSFERRED: 5}).alias("id_status"),
            day("visit_date").alias("start_date"), "encounter_id",
        )
    )


def refill(
    rec: Record,
    context: DataFrame,
    patient: DataFrame,
    dispensing: DataFrame,
    on_arv: DataFrame,
    reasons: DataFrame,
    as_of,
    require_on_arv: bool = True,
    require_not_voided: bool = True,
    any_state: bool = False,
) -> DataFrame:
    """Statuses 6, 8 and 9 from the date of the next refill.

    `require_on_arv` applies to 6 and 9 (8 always asks for it); `require_not_voided` to the dispensing
    row; `any_state` also takes voided forms. The incremental run switches all three. 6 and 9 ask for an
    antiretroviral, 8 does not.
    """
    types = rec.codes.encounter("dispensing", "ped_dispensing")
    due = dispensing.filter(not_voided() & (F.col("arv_drug") == YES)).groupBy("patient_id").agg(
        F.max("next_dispensation_date").alias("next_dispensation_date")
    )
    treated = on_arv.select("patient_id").distinct()
    forms = (
        of_types(context if any_state else _live_forms(context), types)
        .join(_patients_with(reasons, DIED, STOPPED, TRANSFERRED), "patient_id", "left_anti")
        .join(treated.withColumn("_form_on_arv", F.lit(True)), "patient_id", "left")
        .groupBy("visit_id")
        .agg(F.max(F.coalesce("_form_on_arv", F.lit(False))).alias("_form_on_arv"))
    )
    rows = dispensing.filter(not_voided()) if require_not_voided else dispensing
    rows = (
        rows.join(due, ["patient_id", "next_dispensation_date"], "left_semi")
        .join(forms, "visit_id")
        .join(treated.withColumn("_on_arv", F.lit(True)), "patient_id", "left")
        .join(patient.select("patient_id").withColumn("_known", F.lit(True)), "patient_id", "left")
    )
    late = days_between(_today(as_of), "next_dispensation_date")
    arv, known = F.col("arv_drug") == YES, F.col("_known").isNotNull()
    own, form = F.col("_on_arv").isNotNull(), F.col("_form_on_arv")
    any_arv = F.lit(not require_on_arv)
    status = (
        F.when((late <= 0) & arv & known & (own | any_arv), 6)
        .when(late.between(1, 30) & known & form, 8)
        .when((late > 30) & arv & (form | any_arv), 9)
    )
    return _per_patient(
        rows.withColumn("id_status", status)
        .filter("id_status IS NOT NULL")
        .select("patient_id", "id_status", day("visit_date").alias("start_date"), "encounter_id")
    )


def before_treatment(
    rec: Record, context: DataFrame, patient: DataFrame, on_arv: DataFrame, reasons: DataFrame, as_of,
    any_state: bool = False,
) -> DataFrame:
    """Statuses 10, 7 and 11 from the forms of the latest visit day (`any_state`: voided ones too)."""
    codes = rec.codes
    first = codes.encounter("first_hiv", "ped_first_hiv")
    follow = codes.encounter("followup_hiv", "ped_followup_hiv", "dispensing", "ped_dispensing", "lab")
    people = patient.filter(F.col("vih_status") == 1).select(F.col("patient_id").alias("visit_patient_id")).join(
        on_arv.select(F.col("patient_id").alias("visit_patient_id")), "visit_patient_id", "left_anti"
    )
    forms = context if any_state else _live_forms(context).filter(not_voided("visit_voided"))
    rows = (
        forms.filter("in_visit")
        .join(_latest_visits(rec), "visit_patient_id")
        .filter(day("visit_date") == F.col("_latest"))
        .join(people, "visit_patient_id", "left_semi")
        .join(_patients_with(reasons, DIED, TRANSFERRED), "patient_id", "left_anti")
    )
    months = whole_units("MONTH", "visit_date", _today(as_of))
    status = (
        F.when(is_any("encounter_type", first), F.when(months <= 12, 7))
        .when(is_any("encounter_type", follow), F.when(months <= 12, 11))
        .when(F.col("encounter_type").isNotNull() & (months > 12), 10)
    )
    return _per_patient(
        rows.withColumn("id_status", status)
        .filter("id_status IS NOT NULL")
        .select(
            F.col("visit_patient_id").alias("patient_id"), "id_status", day("visit_date").alias("start_date"),
            "encounter_id",
        )
    )


def attach_reason(rows: DataFrame, reasons: DataFrame) -> DataFrame:
    """The reason given soonest on or after the start; the smallest code of that day.

    The rows are read twice, so hand over a stored table."""
    found = match_next(
        rows, reasons.withColumnRenamed("reason", "dis_reason"), "patient_id", "start_date", "visit_date",
        inclusive=True, payload="dis_reason", name="_on",
    )
    return found.drop("_on")


def status_rows(
    rec: Record,
    encounter_context: DataFrame,
    patient: DataFrame,
    patient_dispensing: DataFrame,
    patient_on_arv: DataFrame,
    discontinuation_reason: DataFrame,
    exposed_infants: DataFrame,
    as_of,
    require_on_arv: bool = True,
    require_not_voided: bool = True,
    any_state: bool = False,
    new_obs: DataFrame | None = None,
) -> DataFrame:
    """Every status that holds on `as_of`, without exposed infants. Grain: patient, status.

    `new_obs`: observations that statuses 1, 2 and 3 read instead of the whole record.
    """
    recent = rec if new_obs is None else rec.replace(obs=new_obs)
    parts = [
        left_before_treatment(rec, encounter_context, patient, patient_on_arv, any_state),
        refill(
            rec, encounter_context, patient, patient_dispensing, patient_on_arv, discontinuation_reason, as_of,
            require_on_arv, require_not_voided, any_state,
        ),
        before_treatment(
            rec, encounter_context, patient, patient_on_arv, discontinuation_reason, as_of, any_state
        ),
        left_on_treatment(recent, encounter_context, patient_on_arv),
    ]
    rows = reduce(DataFrame.unionByName, [p.select(*OUT) for p in parts])
    return delete_matching(rows, exposed_infants, ["patient_id"])


def statuses(status_rows: DataFrame, discontinuation_reason: DataFrame, as_of) -> DataFrame:
    """The statuses of the day with the reason for leaving care. Grain: patient, status."""
    return attach_reason(status_rows, discontinuation_reason).select(
        *OUT, "dis_reason", _today(as_of).alias("date_started_status")
    )


def merge_history(history: DataFrame, fresh: DataFrame, as_of) -> DataFrame:
    """Replace the rows of the day with the fresh ones; rows without a day stay."""
    return history.filter(~day("date_started_status").eqNullSafe(_today(as_of))).unionByName(fresh)


def refresh_history(history: DataFrame, exposed_infants: DataFrame, reasons: DataFrame) -> DataFrame:
    """A history without exposed infants, reasons looked up anew; a row for which none is found keeps its own."""
    kept = delete_matching(history, exposed_infants, ["patient_id"]).withColumnRenamed("dis_reason", "_own")
    found = attach_reason(kept, reasons).withColumn("dis_reason", F.coalesce("dis_reason", "_own"))
    return found.select(*history.columns)


def merge_day_status(history: DataFrame, fresh: DataFrame) -> DataFrame:
    """Incremental merge: drop rows the fresh batch repeats, then add one row per patient.

    The row added is the one the rules wrote last.
    """
    keys = ["patient_id", "id_status", "start_date", "date_started_status"]
    kept = delete_matching(history, fresh, keys)
    rank = F.struct("date_started_status", _written(), "start_date")
    one = fresh.groupBy("patient_id").agg(
        F.max_by(F.struct(*[c for c in fresh.columns if c != "patient_id"]), rank).alias("_r")
    ).select("patient_id", "_r.*")
    return kept.unionByName(one.select(*history.columns))


def _written() -> Column:
    return labels("id_status", WRITTEN)


def current_status(history: DataFrame) -> DataFrame:
    """Status of each patient on the latest day it has one."""
    rank = F.struct(day("date_started_status").alias("d"), _written().alias("w"))
    return history.groupBy("patient_id").agg(F.max_by("id_status", rank).alias("arv_status"))


def with_status(patient: DataFrame, current: DataFrame) -> DataFrame:
    return patient.drop("arv_status").join(current, "patient_id", "left")


def import_legacy(history: DataFrame, legacy: DataFrame, patient: DataFrame, since) -> DataFrame:
    """Add statuses of the older system: (patientID, patientStatus, insertDate), from `since` on.

    One status per patient and moment of entry (the highest code); rows already in the history stay.
    """
    rows = (
        legacy.filter((day("insertDate") >= F.lit(since).cast("date")) & (F.col("patientStatus") > 0))
        .join(
            patient.select("patient_id", F.col("legacy_id").alias("patientID")).filter(F.col("patientID").isNotNull()),
            "patientID",
        )
        .groupBy("patient_id", "insertDate")
        .agg(F.max("patientStatus").alias("id_status"))
        .select(
            "patient_id", "id_status", day("insertDate").alias("start_date"),
            F.col("insertDate").alias("date_started_status"),
        )
    )
    keys = ["patient_id", "id_status", "start_date", "date_started_status"]
    for c in history.columns:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(history.schema[c].dataType))
    rows = rows.withColumn("date_started_status", F.col("date_started_status").cast(history.schema["date_started_status"].dataType))
    return history.unionByName(delete_matching(rows.dropDuplicates(keys), history, keys))


# ----------------------------------------------------------------------------------------- exposed infants

PCR_FORM, PCR_LAB, BREASTFED = 1030, 844, 1401
#: All that `exposed_infants` reads of the observations.
INFANT_CONCEPTS = (PCR_FORM, PCR_LAB, BREASTFED, STOP_DETAIL)
INFANT = ["patient_id", "location_id", "encounter_id", "visit_date", "condition"]


def _negative_pcr(rec: Record, forms: DataFrame) -> DataFrame:
    """Condition 1: negative on the day of the latest paediatric or laboratory PCR."""
    kinds = of_types(forms, rec.codes.encounter("ped_first_hiv", "lab"))
    tests = rec.obs.filter(F.col("concept_id").isin(PCR_FORM, PCR_LAB) & not_voided()).select(
        "obs_id", "person_id", "encounter_id", F.col("location_id").alias("obs_location"), "concept_id", "value_coded"
    )
    seen = tests.join(kinds.select("encounter_id", "patient_id", "encounter_datetime"), "encounter_id")
    latest = seen.groupBy("patient_id").agg(F.max("encounter_datetime").alias("_latest"))
    code, concept = F.col("value_coded"), F.col("concept_id")
    negative = ((concept == PCR_FORM) & (code == NEGATIVE)) | ((concept == PCR_LAB) & (code == 1302))
    rows = seen.filter(negative & (F.col("person_id") == F.col("patient_id"))).join(latest, "patient_id")
    return rows.filter(day("encounter_datetime") == day("_latest")).select(
        "patient_id", F.col("obs_location").alias("location_id"), "encounter_id",
        day("encounter_datetime").alias("visit_date"), F.lit(1).alias("condition"),
    )


def _ticked(rec: Record, forms: DataFrame, types: list[str], concept: int, code: int, condition: int) -> DataFrame:
    answers = rec.obs.filter((F.col("concept_id") == concept) & (F.col("value_coded") == code) & not_voided()).select(
        F.col("person_id").alias("patient_id"), F.col("location_id"), "encounter_id"
    )
    kinds = of_types(forms, rec.codes.encounter(*types)).select("encounter_id", "encounter_datetime")
    return answers.join(kinds, "encounter_id").select(
        "patient_id", "location_id", "encounter_id", day("encounter_datetime").alias("visit_date"),
        F.lit(condition).alias("condition"),
    ).distinct()


def _prophylaxis(dispensing: DataFrame, latest_arv_visit: bool) -> DataFrame:
    """Condition 4: the latest dispensing visit gave an antiretroviral as prophylaxis."""
    rows = dispensing.filter(not_voided())
    base = rows.filter(F.col("arv_drug") == YES) if latest_arv_visit else rows
    latest = latest_per_key(base.select("patient_id", "visit_date").distinct(), "patient_id", "visit_date")
    given = rows.filter((F.col("rx_or_prophy") == PROPHYLAXIS) & (F.col("arv_drug") == YES))
    return given.join(latest, ["patient_id", "visit_date"], "left_semi").select(
        "patient_id", "location_id", "encounter_id", day("visit_date").alias("visit_date"), F.lit(4).alias("condition")
    ).distinct()


def _positive_pcr(rec: Record, forms: DataFrame) -> DataFrame:
    kinds = forms.select("encounter_id", "patient_id", "encounter_type")
    paediatric = is_any("encounter_type", rec.codes.encounter("ped_first_hiv"))
    lab = is_any("encounter_type", rec.codes.encounter("lab"))
    code, concept = F.col("value_coded"), F.col("concept_id")
    rows = rec.obs.filter(concept.isin(PCR_FORM, PCR_LAB) & code.isin(POSITIVE, 1301) & not_voided()).select(
        "encounter_id", F.col("person_id").alias("patient_id"), "concept_id", "value_coded"
    ).join(kinds, ["encounter_id", "patient_id"])
    hit = (paediatric & (concept == PCR_FORM) & (code == POSITIVE)) | (lab & (concept == PCR_LAB) & (code == 1301))
    return rows.filter(hit).select("patient_id")


def _positive_test(laboratory: DataFrame, patient: DataFrame, as_of) -> DataFrame:
    old = patient.filter(whole_units("MONTH", "birthdate", _today(as_of)) >= 18).select("patient_id")
    tests = laboratory.filter(
        (F.col("test_id") == 1040) & (F.col("test_done") == 1) & (mysql_num("test_result") == POSITIVE) & not_voided()
    )
    return tests.join(old, "patient_id", "left_semi").select("patient_id")


def exposed_infants(
    rec: Record,
    encounter_context: DataFrame,
    patient: DataFrame,
    patient_dispensing: DataFrame,
    patient_laboratory: DataFrame,
    as_of,
    incremental: bool = False,
) -> DataFrame:
    """Infants exposed to HIV whose own infection is not established.

    Conditions 1, 3 and 4 are added, infected children removed, then seroreversions (5) added.
    `incremental` follows the incremental run: prophylaxis is looked for at the latest antiretroviral
    visit, and confirmed infections and seroreversions also count on voided forms.
    """
    forms = _live_forms(encounter_context)
    late_forms = encounter_context if incremental else forms
    paediatric = ["ped_first_hiv", "ped_followup_hiv"]
    candidates = (
        _negative_pcr(rec, forms)
        .unionByName(_ticked(rec, forms, paediatric, BREASTFED, 1405, 3))
        .unionByName(_prophylaxis(patient_dispensing, incremental))
    )
    infected = (
        _positive_pcr(rec, forms)
        .unionByName(_positive_test(patient_laboratory, patient, as_of))
        .unionByName(_ticked(rec, late_forms, paediatric, BREASTFED, 163717, 0).select("patient_id"))
        .distinct()
    )
    reverted = _ticked(rec, late_forms, ["discontinuation"], STOP_DETAIL, 165439, 5)
    return delete_matching(candidates, infected, ["patient_id"]).unionByName(reverted).select(*INFANT)
