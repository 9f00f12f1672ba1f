"""HIV programme marts: stop reasons, pregnancy, vaccination schedule, patient_on_art."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import POSITIVE, YES, add_months, day, labels, live, not_voided, round_int, whole_units
from medloom.operators.eav import Obs, collect_obs, sibling_groups, with_header
from medloom.operators.match import match_next_each
from medloom.operators.pick import first_and_last, latest_except_overall
from medloom.plans.clinical import KEY_POPULATIONS, PLANNING, SYMPTOM
from medloom.plans.shared import of_types
from medloom.sources.codes import is_any
from medloom.sources.record import Record

STOP_REASON, STOP_DETAIL = 161555, 1667
DIED, TRANSFERRED, STOPPED = 159, 159492, 1667
ADHERENCE, PREFERENCE = 115198, 159737

# Labels of stop reasons and of their details.
REASON_NAMES = {5240: "Perdu de vue", 159492: "Transfert", 159: "Décès", 1667: "Discontinuations", 1067: "Inconnue"}
DETAIL_NAMES = {
    1754: "ARVs non-disponibles",
    160415: "Patient a déménagé",
    115198: "Adhérence inadéquate",
    159737: "Préférence du patient",
    5622: "Autre raison, préciser",
}


def _stop_answers(rec: Record, context: DataFrame, answer: Column) -> DataFrame:
    forms = of_types(context, rec.codes.encounter("discontinuation")).filter("in_visit").select(
        "encounter_id", "visit_id", "visit_date", F.col("visit_patient_id").alias("patient_id"), "encounter_voided"
    )
    rows = rec.obs.filter(answer & live()).select(
        "obs_id", "encounter_id", F.col("value_coded").alias("reason"), "comments"
    )
    return rows.join(forms, "encounter_id")


def _latest_visit(rows: DataFrame, names: dict, *more: str) -> DataFrame:
    """Per patient and reason, the visit of the latest date (then the highest visit)."""
    latest = first_and_last(
        rows.withColumn("_visit", F.col("visit_id")), ["patient_id", "reason"], [], ["visit_id", "visit_date", *more],
        F.struct("visit_date", "_visit", "obs_id"),
    )
    return latest.withColumn("visit_date", day("visit_date")).withColumn("reason_name", labels("reason", names))


def stopping_reason(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Why treatment was stopped. One row per patient and detail, at the latest visit that gives it."""
    rows = _stop_answers(
        rec, encounter_context, (F.col("concept_id") == STOP_DETAIL) & F.col("value_coded").isin(*DETAIL_NAMES)
    )
    return _latest_visit(rows, DETAIL_NAMES, "comments").select(
        "patient_id", "visit_id", "visit_date", "reason", "reason_name", F.col("comments").alias("other_reason")
    )


def discontinuation_reason(rec: Record, encounter_context: DataFrame, stopping_reason: DataFrame) -> DataFrame:
    """Why patients left care. A stopped treatment counts only with a valid detail at the same visit."""
    rows = _stop_answers(rec, encounter_context, F.col("concept_id") == STOP_REASON).filter(
        not_voided("encounter_voided")
    )
    reasons = _latest_visit(rows, REASON_NAMES).select("patient_id", "visit_id", "visit_date", "reason", "reason_name")
    valid = stopping_reason.filter(F.col("reason").isin(ADHERENCE, PREFERENCE)).select("visit_id").distinct()
    hit = reasons.join(valid.withColumn("_valid", F.lit(True)), "visit_id", "left")
    return hit.filter(
        F.col("reason").isNull() | (F.col("reason") != STOPPED) | F.col("_valid").isNotNull()
    ).select("patient_id", "visit_id", "visit_date", "reason", "reason_name")


# --------------------------------------------------------------------------------------------- pregnancy

# Diagnoses recorded in a pregnancy group.
PREGNANCY_DIAGNOSES = (46, 129251, 132678, 47, 163751, 1449, 118245, 129211, 141631, 158489, 490, 118744)
DUE_DATE, LAST_PERIOD = 5596, 1427


def _pregnancy_signs(rec: Record, context: DataFrame, seen: DataFrame) -> DataFrame:
    """Every entry that says a patient is pregnant, numbered by the source that reports it."""
    concept, code = F.col("concept_id"), F.col("value_coded")
    obs_cols = ["obs_id", "person_id", "encounter_id", "obs_datetime", "obs_group_id", "concept_id", "value_coded",
                "value_datetime", "value_numeric", "comments", "voided"]
    # Sources dated by the answer itself.
    anywhere = (
        F.when((concept == 162225) & (code == 1434), 2)
        .when((concept == 1592) & code.isin(1910, 162186, 5486, 5576, 163106, 1622), 3)
        .when(concept.isin(1945, 45) & (code == POSITIVE), 6)
        .when(concept.isin(163764, 161007, 163765, 163766) & (code == YES), 7)
        .when((concept == SYMPTOM) & code.isin(113377, 159937), 8)
    )
    # Sources that count on an obstetric form and take its day.
    on_form = (
        F.when((concept == 160288) & (code == 1622), 4)
        .when((concept == DUE_DATE) & F.col("value_datetime").isNotNull(), 5)
        .when(
            concept.isin(7957, 159758) & (code == 1589) & F.col("comments").isNotNull() & (F.col("comments") != ""), 10
        )
        .when(concept.isin(1438, 1440, 1439) & (F.col("value_numeric") > 0), 11)
        .when((concept == 163749) & code.isin(5141, 5139), 12)
        .when((concept == 160090) & code.isin(160001, 139814, 112259), 13)
        .when((concept == 163750) & code.isin(163748, 163747), 14)
    )
    out = ["patient_id", "encounter_id", "start_date", "end_date", "voided", "step", "obs_id"]
    no_end = F.lit(None).cast("date")
    obs = rec.obs.select(*obs_cols).withColumnRenamed("person_id", "patient_id")

    plain = (
        obs.filter(concept.isin(162225, 1592, 1945, 45, 163764, 161007, 163765, 163766, SYMPTOM))
        .withColumn("step", anywhere)
        .filter("step IS NOT NULL")
        .withColumns({"start_date": day("obs_datetime"), "end_date": no_end})
    )
    grouped = with_header(
        obs.filter((concept == 1284) & code.isin(*PREGNANCY_DIAGNOSES)),
        rec.obs, rec.codes.concepts_like("pregnancy_group_"), same_encounter=False,
    ).withColumns({"step": F.lit(1), "start_date": day("obs_datetime"), "end_date": no_end})
    forms = of_types(context, rec.codes.encounter("obgyn_initial", "obgyn_followup"))
    obgyn = (
        obs.filter(concept.isin(160288, DUE_DATE, 7957, 159758, 1438, 1440, 1439, 163749, 160090, 163750))
        .withColumn("step", on_form)
        .filter("step IS NOT NULL")
        .join(forms.select("encounter_id", "encounter_datetime"), "encounter_id")
        .withColumns({"start_date": day("encounter_datetime"), "end_date": no_end})
    )
    births = of_types(context, rec.codes.encounter("labor_delivery")).select("encounter_id", "encounter_datetime")
    # Any entry on the form counts: the first one fixes the dates, the last one says whether it is voided.
    entries = seen.select(
        F.col("person_id").alias("patient_id"), "encounter_id", F.col("last_voided").alias("voided"), F.explode(F.array("first_obs", "last_obs")).alias("obs_id")
    )
    labour = entries.join(births, "encounter_id").withColumns(
        {
            "step": F.lit(9),
            "start_date": add_months("encounter_datetime", -9),
            "end_date": day("encounter_datetime"),
        }
    )
    return (
        plain.select(*out).unionByName(grouped.select(*out)).unionByName(obgyn.select(*out)).unionByName(labour.select(*out))
    )


def pregnancy_start(rec: Record, encounter_context: DataFrame, encounter_seen: DataFrame) -> DataFrame:
    """Pregnancies as first reported. The first source that reports one fixes its start."""
    signs = _pregnancy_signs(rec, encounter_context, encounter_seen)
    return first_and_last(
        signs, ["patient_id", "encounter_id"], ["start_date", "end_date"], ["voided"], F.struct("step", "obs_id")
    )


def patient_pregnancy(rec: Record, encounter_context: DataFrame, pregnancy_start: DataFrame, as_of) -> DataFrame:
    """Pregnancies. Grain: patient, encounter.

    An open end takes, in this order: the next due date, the next delivery form, the last period plus
    one year less three months plus seven days, and nine months after a start at least nine months old.
    """
    obs = rec.obs.withColumnRenamed("person_id", "patient_id")
    due = obs.filter((F.col("concept_id") == DUE_DATE) & live())
    births = of_types(encounter_context, rec.codes.encounter("labor_delivery")).filter(live("encounter_voided"))
    end_of_cycle = F.add_months(F.date_add(F.add_months(day("value_datetime"), -3), 7), 12)
    periods = obs.filter((F.col("concept_id") == LAST_PERIOD) & live()).select(
        "patient_id", end_of_cycle.alias("_cycle_end")
    )
    # The last-period rule applies when the patient was seen on or after the start of the pregnancy.
    seen = encounter_context.groupBy("patient_id").agg(F.max(day("encounter_datetime")).alias("_seen"))
    last_cycle = periods.groupBy("patient_id").agg(F.max("_cycle_end").alias("_last_cycle"))

    out = match_next_each(
        pregnancy_start, "patient_id", "start_date",
        {
            "due": (due, "value_datetime", None),
            "birth": (births, "encounter_datetime", None),
            "cycle": (periods, "_cycle_end", None),
        },
    )
    out = out.join(seen, "patient_id", "left").join(last_cycle, "patient_id", "left")
    cycle = F.when(F.col("start_date") <= F.col("_seen"), F.coalesce("cycle", "_last_cycle"))
    old = whole_units("MONTH", "start_date", F.lit(as_of).cast("date")) >= 9
    full_term = F.when(old, add_months("start_date", 9))
    return out.withColumn("end_date", F.coalesce("end_date", "due", "birth", cycle, full_term)).select(
        "patient_id", "encounter_id", "start_date", "end_date", "voided"
    )


# ------------------------------------------------------------------------------------------- vaccination

GIVEN, SEQUENCE = 984, 1418
# Vaccine sets of the two schedules.
COMBINED, COMBINED_LATE = (783, 1423, 83531), (783, 1423)
SEPARATE, SEPARATE_LATE = (781, 782, 783, 5261, 83531), (781, 782, 783, 5261)
MEASLES_MUMPS, MEASLES = 159701, 162586


def _dose_counts(rec: Record) -> DataFrame:
    """Per encounter, how many doses of each set and number were given.

    A group that lists a vaccine and several sequence numbers counts once per number; the numbers are
    counted per group first, so that vaccines and numbers are never paired.
    """
    dose = round_int("value_numeric")
    groups = sibling_groups(
        rec.obs, None,
        {f"_d{n}": Obs((SEQUENCE,), where=dose == n, pick="count", any_voided=True) for n in (1, 2, 3)},
    )
    given = rec.obs.filter((F.col("concept_id") == GIVEN) & live() & F.col("obs_group_id").isNotNull())
    rows = given.join(groups, F.col("obs_group_id") == F.col("group_id"))

    def count(codes: tuple, n: int) -> Column:
        return F.sum(F.when(F.col("value_coded").isin(*codes), F.col(f"_d{n}")).otherwise(0))

    return rows.groupBy("encounter_id").agg(
        count(COMBINED, 1).alias("a1"), count(COMBINED, 2).alias("a2"),
        count(COMBINED_LATE, 2).alias("a2_late"), count(COMBINED_LATE, 3).alias("a3_late"),
        count(SEPARATE, 1).alias("b1"), count(SEPARATE, 2).alias("b2"), count(SEPARATE_LATE, 3).alias("b3_late"),
        (count((MEASLES_MUMPS,), 1) > 0).alias("mm1"), (count((MEASLES_MUMPS,), 2) > 0).alias("mm2"),
        (count((MEASLES,), 1) > 0).alias("m1"),
    )


def _schedule_complete() -> Column:
    """Whether the vaccines due at the age were given, by either schedule."""
    c = F.col
    a1, a2, b1, b2 = c("a1") == 3, c("a2") == 3, c("b1") == 5, c("b2") == 5
    measles = (c("mm1") | c("m1")) & ((c("mm2") & c("mm1")) | c("m1"))
    return (
        F.when(c("age_range") == 45, a1 | b1)
        .when(c("age_range") == 75, (a1 & a2) | (b1 & b2))
        .when(c("age_range") == 105, (a1 & a2 & (c("a2_late") == 2)) | (b1 & b2 & (c("b3_late") == 4)))
        .when(
            c("age_range") == 270,
            (a1 & a2 & measles & (c("a3_late") == 2)) | (b1 & b2 & measles & (c("b3_late") == 4)),
        )
    )


def vaccination(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Vaccination visits and whether the schedule of the age is complete. Grain: patient, encounter, location."""
    rows = rec.obs.filter(F.col("concept_id") == GIVEN).select(
        F.col("person_id").alias("patient_id"), "encounter_id", "location_id", "voided", "obs_id"
    )
    spine = first_and_last(rows, ["patient_id", "encounter_id", "location_id"], [], ["voided"], "obs_id")
    born = rec.person.join(
        rec.patient.select(F.col("patient_id").alias("person_id")), "person_id", "left_semi"
    ).select(F.col("person_id").alias("patient_id"), "birthdate")
    forms = encounter_context.select("encounter_id", day("encounter_datetime").alias("encounter_date"))
    out = (
        spine.join(forms, "encounter_id")
        .join(born, "patient_id", "left")
        .join(_dose_counts(rec), "encounter_id", "left")
    )
    age = whole_units("DAY", "birthdate", "encounter_date")
    ranges = (
        F.when(age.between(0, 45), 45).when(age.between(46, 75), 75)
        .when(age.between(76, 105), 105).when(age.between(106, 270), 270)
    )
    return out.withColumn("age_range", ranges).withColumn(
        "vaccination_done", F.when(_schedule_complete(), 1).otherwise(0)
    ).select("patient_id", "encounter_id", "location_id", "encounter_date", "age_range", "vaccination_done", "voided")


# -------------------------------------------------------------------------------------------- patient_on_art

# Labels of coded answers.
CERVICAL_STATUS = {1115: "NEGATIVE", 1116: "POSTIVE", 1117: "UNKNOWN"}
CERVICAL_TREATMENT = {162812: "CRYOTHERAPY", 162810: "LEEP", 163408: "THERMOCOAGULATION"}
NON_ENROLMENT = {
    127750: "VOLUNTARY", 160432: "DIED", 159: "DIED", 160036: "REFERRED", 159492: "REFERRED", 162591: "MEDICAL",
    155891: "DENIAL", 5622: "OTHER",
}
TB_SCREEN = {142177: "POSTIVE", 1660: "NEGATIVE"}
POSITIVE_LABEL = "POSTIVE"


def _art_facts(rec: Record, intended_screening: bool) -> DataFrame:
    codes = rec.codes
    when, said = day("value_datetime"), day("obs_datetime")
    code = F.col("value_coded")
    lines = {}
    for rank, name in ((1, "first_line"), (2, "second_line"), (3, "third_line")):
        lines |= {i: rank for i in codes.concept(name)}
    line = labels(code, lines) if lines else F.lit(None).cast("int")
    tb_positive = codes.concept("tb_positive_1", "tb_positive_2")

    def last(concepts, value, **kw) -> Obs:
        return Obs(concepts, value=value, pick="latest", **kw)

    def positive(cond) -> Column:
        return F.when(cond, F.lit(POSITIVE_LABEL))

    specs = {
        "_tested_1040": Obs((1040,), (POSITIVE,)),
        "_tested_date": last((1040,), said, codes=(POSITIVE,)),
        "_ordered": Obs((1271,), (1040, 1042), any_voided=True),
        "_entered": Obs((160082,)),
        "_entered_date": Obs((160082,), value=F.struct("obs_id", when.alias("day")), pick="min"),
        "_preventive": last((163284,), when),
        "_preventive_new": last((509166326,), when),
        "cervical_cancer_status": last((160704,), labels(code, CERVICAL_STATUS)),
        "date_started_cervical_cancer_status": last((160704,), said),
        "cervical_cancer_treatment": last((1651,), labels(code, CERVICAL_TREATMENT)),
        "date_cervical_cancer_treatment": last((1651,), said),
        "_screened": Obs((1651,), (151185,)),
        "_screened_date": last((1651,), said, codes=(151185,)),
        "date_started_breast_feeding": last(codes.concept("breast_feeding"), said),
        "key_population": last(codes.concept("key_population"), labels(code, KEY_POPULATIONS)),
        "reason_non_enrollment": last((STOP_DETAIL, STOP_REASON), labels(code, NON_ENROLMENT)),
        "date_non_enrollment": last((STOP_DETAIL, STOP_REASON), said),
        "breast_feeding": last((5632,), F.when(code == YES, 1).otherwise(0)),
        "date_breast_feeding": last((5632,), said),
        "_line": Obs((164432,), tuple(lines), value=line),
        "date_started_regime_treatment": Obs((164432,), tuple(lines), value=said),
        "tb_screened": Obs((1659,), tuple(TB_SCREEN), any_voided=True),
        "date_tb_screened": last((1659,), said, codes=tuple(TB_SCREEN), any_voided=True),
        "tb_status": last((1659,), labels(code, TB_SCREEN), any_voided=True),
        "date_enrolled_on_tb_treatment": last((1113,), when),
        "tb_genexpert_test": Obs(codes.concept("genexpert")),
        "_genexpert_date": last(codes.concept("genexpert"), said),
        "_genexpert": last(codes.concept("genexpert"), positive(code == 1301)),
        "tb_crachat_test": Obs((307,)),
        "_sputum_date": last((307,), said),
        "_sputum": last((307,), positive(code.isin(1362, 1363, 1364))),
        "tb_other_test": Obs((159984, 159982)),
        "_other_date": last((159984, 159982), said),
        "_other": Obs(
            (159984, 159982),
            where=((F.col("concept_id") == 159982) & is_any(code, tb_positive))
            | ((F.col("concept_id") == 159984) & code.isin(162204, 162203)),
        ),
        "viral_load_targeted": Obs(codes.concept("viral_load_type"), codes.concept("viral_load_targeted")),
        "accepted_family_planning_method": last((374,), labels(code, PLANNING)),
        "date_using_family_planning_method": last((374,), said),
        "date_accepted_family_planning_method": Obs((374,), value=said, pick="min"),
        "migrated": last((STOP_REASON,), F.when(code == 160415, 1).otherwise(0), any_voided=True),
    }
    facts = collect_obs(rec.obs, "person_id", specs).withColumnRenamed("person_id", "patient_id")
    screened = F.col("_screened") if intended_screening else F.lit(None).cast("int")
    screened_date = F.col("_screened_date") if intended_screening else F.lit(None).cast("date")
    return facts.withColumns(
        {
            "screened_cervical_cancer": screened,
            "date_screened_cervical_cancer": screened_date,
            "treatment_regime_lines": labels("_line", {1: "FIRST_LINE", 2: "SECOND_LINE", 3: "THIRD_LINE"}),
            "using_family_planning_method": F.col("accepted_family_planning_method"),
            "date_completed_preventive_tb_treatment": F.coalesce("_preventive_new", "_preventive"),
            "date_full_6_months_of_inh_has_px": F.col("_preventive"),
            "date_sample_sent_for_diagnositic_tb": F.coalesce("_other_date", "_sputum_date", "_genexpert_date"),
            "tb_bacteriological_test_status": F.when(F.col("_other").isNotNull(), F.lit(POSITIVE_LABEL))
            .when(F.col("tb_crachat_test").isNotNull(), F.col("_sputum"))
            .otherwise(F.col("_genexpert")),
        }
    )


def _art_visits(rec: Record, context: DataFrame) -> DataFrame:
    """Visit dates by kind of form. The kinds of the first and the later visits are kept as reported."""
    codes = rec.codes
    first = is_any("encounter_type", codes.encounter("first_hiv", "ped_first_hiv"))
    later = is_any("encounter_type", codes.encounter("followup_hiv", "ped_followup_hiv"))
    kept = live("encounter_voided")
    forms = context.filter(first | later).select(
        "patient_id", "encounter_id", "encounter_type", "encounter_datetime", "encounter_voided"
    )
    dates = forms.groupBy("patient_id").agg(
        F.max(F.when(later & kept, day("encounter_datetime"))).alias("first_vist_date"),
        F.max(F.when(first & kept, F.col("encounter_datetime"))).alias("last_folowup_vist_date"),
        F.min(day("encounter_datetime")).alias("_first_form"),
    )
    second = latest_except_overall(
        forms.filter(first & kept), "patient_id", "encounter_datetime", "second_last_folowup_vist_date"
    )
    return dates.join(second, "patient_id", "left")


def _transfer_start(rec: Record, context: DataFrame) -> DataFrame:
    forms = of_types(context, rec.codes.encounter("first_hiv")).select("encounter_id")
    rows = rec.obs.filter((F.col("concept_id") == 159599) & live()).join(forms, "encounter_id", "left_semi")
    return rows.groupBy(F.col("person_id").alias("patient_id")).agg(
        F.max(day("obs_datetime")).alias("date_started_arv_for_transfered")
    )


def patient_on_art(
    rec: Record, encounter_context: DataFrame, patient_on_arv: DataFrame, intended_screening: bool = False
) -> DataFrame:
    """Follow-up of patients tested, enrolled or treated. Grain: patient.

    `intended_screening` fills the cervical-cancer screening columns; the original rule asks two answers
    of one observation and so leaves them empty.
    """
    facts = _art_facts(rec, intended_screening)
    treated = patient_on_arv.select("patient_id").distinct().withColumn("_treated", F.lit(True))
    base = facts.join(treated, "patient_id", "full_outer")
    known = F.col("_treated").isNotNull() | F.col("_ordered").isNotNull()
    base = base.filter(known | F.col("_entered").isNotNull())
    out = base.join(_art_visits(rec, encounter_context), "patient_id", "left").join(
        _transfer_start(rec, encounter_context), "patient_id", "left"
    )
    own_date = F.when(known, F.col("_tested_date")).otherwise(F.col("_entered_date.day"))
    return out.select(
        "patient_id", "date_completed_preventive_tb_treatment", "key_population",
        F.when(known, F.col("_tested_1040")).otherwise(F.lit(1)).alias("tested_hiv_postive"),
        F.coalesce("_first_form", own_date).alias("date_tested_hiv_postive"),
        "reason_non_enrollment", "date_non_enrollment", "date_enrolled_on_tb_treatment", "tb_screened",
        "date_tb_screened", "tb_status", "tb_genexpert_test", "tb_other_test", "tb_crachat_test",
        "date_sample_sent_for_diagnositic_tb", "tb_bacteriological_test_status", "treatment_regime_lines",
        "date_started_regime_treatment", "viral_load_targeted", "accepted_family_planning_method",
        "date_accepted_family_planning_method", "using_family_planning_method", "date_using_family_planning_method",
        "first_vist_date", day("second_last_folowup_vist_date").alias("second_last_folowup_vist_date"),
        day("last_folowup_vist_date").alias("last_folowup_vist_date"), "date_started_arv_for_transfered",
        "screened_cervical_cancer", "date_screened_cervical_cancer", "cervical_cancer_status",
        "date_started_cervical_cancer_status", "cervical_cancer_treatment", "date_cervical_cancer_treatment",
        "breast_feeding", "date_breast_feeding", "date_started_breast_feeding", "date_full_6_months_of_inh_has_px",
        "migrated",
    )
