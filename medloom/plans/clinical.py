"""Marts filled from clinical forms: quality of care, tuberculosis, nutrition, obstetrics, malaria, ..."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import (
    NEGATIVE, POSITIVE, YES, bmi, day, flag, labels, live, round_int, whole_units,
)
from medloom.operators.eav import Obs, collect_obs, facts_of, many_facts, with_header
from medloom.operators.pick import first_and_last
from medloom.plans.shared import DRUG, of_types, provider, visit_of
from medloom.sources.codes import is_any
from medloom.sources.record import Record

WEIGHT, HEIGHT, MUAC = 5089, 5090, 1343
SYMPTOM = 159614
DIAGNOSIS = 1284


def _latest_number(concept: int, at: bool = False) -> Obs:
    return Obs((concept,), value="value_numeric", pick="latest", at=at)


# ---------------------------------------------------------------------------------------------- quality

# Questions that count as a tuberculosis evaluation.
TB_EVALUATION = (
    160265, 1659, 1110, 163283, 162320, 163284, 1633, 1389, 163951, 159431, 1113, 159798, 159398,
)


def quality_specs() -> dict[str, Obs]:
    return {
        "_height": _latest_number(HEIGHT, at=True),
        "_weight": _latest_number(WEIGHT, at=True),
        "_planning": Obs((374,), where=F.col("value_coded").isNotNull()),
        "_adherence": Obs((163710,), value="value_numeric", where=F.col("value_numeric").isNotNull(), pick="latest", at=True),
        "_tb": Obs(TB_EVALUATION, where=F.col("value_coded").isNotNull()),
        "_nutrition": Obs((5314, MUAC)),
        "_active": Obs(
            (160592, 160749),
            where=((F.col("concept_id") == 160592) & (F.col("value_coded") == 113489))
            | ((F.col("concept_id") == 160749) & (F.col("value_coded") == YES)),
        ),
    }


def health_qual_patient_visit(
    rec: Record, encounter_context: DataFrame, encounter_seen: DataFrame, encounter_facts: DataFrame, intended_nutrition: bool = False
) -> DataFrame:
    """Quality-of-care facts of each visited encounter. Grain: patient, encounter, location.

    `intended_nutrition` also counts weight together with height as a nutritional assessment; the
    original rule asks one observation to be both and so never matches.
    """
    facts = facts_of(encounter_facts, "quality", "person_id")
    seen = encounter_seen.filter("any_live").select("encounter_id", "person_id")
    visited = encounter_context.filter(
        F.col("in_visit") & (F.col("visit_patient_id") == F.col("patient_id"))
    ).withColumnRenamed("patient_id", "person_id")
    rows = visited.join(seen, ["encounter_id", "person_id"], "left_semi").join(
        facts, ["encounter_id", "person_id"], "left"
    )
    # Some answers count for every encounter of the visit.
    per_visit = rows.groupBy("visit_id").agg(
        F.max_by("_height", "_height_at").alias("_vh"),
        F.max_by("_weight", "_weight_at").alias("_vw"),
        F.max("_planning").alias("_vp"),
        F.max_by("_adherence", "_adherence_at").alias("_va"),
        F.max("_tb").alias("_vt"),
    )
    out = rows.join(per_visit, "visit_id").join(rec.person.select("person_id", "birthdate"), "person_id", "left")
    nutrition = F.col("_nutrition").isNotNull()
    if intended_nutrition:
        nutrition = nutrition | (F.col("_weight_at").isNotNull() & F.col("_height_at").isNotNull())

    def yes_no(c):
        return F.when(c, F.lit(1)).otherwise(F.lit(0))

    return out.select(
        F.col("person_id").alias("patient_id"), "encounter_id", F.col("visit_location_id").alias("location_id"),
        "visit_id", day("visit_date").alias("visit_date"), "encounter_type",
        bmi("_vw", "_vh").alias("patient_bmi"), round_int("_va").alias("adherence_evaluation"),
        yes_no(F.col("_vp").isNotNull()).alias("family_planning_method_used"),
        yes_no(F.col("_vt").isNotNull()).alias("evaluated_of_tb"),
        yes_no(nutrition).alias("nutritional_assessment_completed"),
        yes_no(F.col("_active").isNotNull()).alias("is_active_tb"),
        whole_units("YEAR", "birthdate", day("visit_date")).cast("int").alias("age_in_years"),
        F.col("visit_voided").alias("voided"),
    )


# ----------------------------------------------------------------------------------------- tuberculosis

TB_DIAGNOSIS, MDR_DIAGNOSIS = 112141, 159345
PAST, PRESENT = 6097, 6042
# Kinds of tuberculosis named as a diagnosis.
TB_KINDS = (42, 159355, 118890, 5042)
TB_ACTIVE_KINDS = (42, 159355, 118890)
# Outcome of a treatment to status (1 cured, 2 completed, 4 failure, 5 died, 8 defaulted, 16 transferred).
TB_OUTCOMES = {159791: 1, 160035: 2, 159874: 4, 5240: 8, 160031: 8, 160034: 5, 159492: 16}
# Sputum control, by month of the treatment.
TB_CONTROLS = {
    "tb_test_result_mon_0": 166136,
    "tb_test_result_mon_2": 166134,
    "tb_test_result_mon_3": 165978,
    "tb_test_result_mon_5": 165999,
    "tb_test_result_end": 165804,
}
# Classification of the disease.
TB_CLASSES = {
    "tb_class_pulmonary": 42,
    "tb_class_extrapulmonary": 5042,
    "tb_extra_meningitis": 111967,
    "tb_extra_genital": 159167,
    "tb_extra_pleural": 111946,
    "tb_extra_miliary": 115753,
    "tb_extra_gangliponic": 111873,
    "tb_extra_intestinal": 161355,
    "tb_extra_other": 5622,
}
# Drugs against tuberculosis.
TB_DRUGS = (75948, 160093, 160096, 160095, 160092, 84360, 163753, 160094, 82900)


def _tb_spine(rec: Record) -> DataFrame:
    code, concept = F.col("value_coded"), F.col("concept_id")
    listed = (
        F.when((concept == 1659) & code.isin(160567, 1662, 1663), 2)
        .when((concept == SYMPTOM) & (code == 159799), 3)
        .when((concept == 159786) & code.isin(159791, 160035, 159874, 160031, 160034), 4)
        .when(concept.isin(PRESENT, PAST) & code.isin(*TB_KINDS), 5)
    )
    plain = rec.obs.filter(concept.isin(1659, SYMPTOM, 159786, PRESENT, PAST)).withColumn("step", listed)
    grouped = with_header(
        rec.obs.filter((concept == DIAGNOSIS) & code.isin(TB_DIAGNOSIS, MDR_DIAGNOSIS)),
        rec.obs, rec.codes.concept("tb_group", "mdr_tb_group"),
    ).withColumn("step", F.lit(1))
    cols = ["person_id", "encounter_id", "location_id", "voided", "obs_id", "step"]
    rows = plain.filter("step IS NOT NULL").select(*cols).unionByName(grouped.select(*cols))
    return first_and_last(
        rows.withColumnRenamed("person_id", "patient_id"),
        ["encounter_id", "location_id"], ["patient_id"], ["voided"], F.struct("step", "obs_id"),
    )


def _tb_groups(rec: Record) -> DataFrame:
    """Flags of diagnosis groups, by encounter."""
    tb, mdr = rec.codes.concept("tb_group"), rec.codes.concept("mdr_tb_group")
    rows = with_header(
        rec.obs.filter(
            (F.col("concept_id") == DIAGNOSIS) & F.col("value_coded").isin(TB_DIAGNOSIS, MDR_DIAGNOSIS) & live()
        ),
        rec.obs, tb + mdr, same_encounter=False,
    )
    code, head = F.col("value_coded"), F.col("header_concept")
    return rows.groupBy("encounter_id").agg(
        F.max(flag(is_any(head, tb) & (code == TB_DIAGNOSIS))).alias("tb_diag"),
        F.max(flag(is_any(head, mdr) & (code == MDR_DIAGNOSIS))).alias("mdr_tb_diag"),
    )


def _tb_controls(rec: Record) -> DataFrame:
    result = labels("value_coded", {POSITIVE: 1, NEGATIVE: 2})
    rows = with_header(
        rec.obs.filter(F.col("concept_id") == 307), rec.obs, list(TB_CONTROLS.values()), same_encounter=False
    )
    return rows.groupBy("encounter_id").agg(
        *[F.max(F.when(F.col("header_concept") == c, result)).alias(n) for n, c in TB_CONTROLS.items()]
    )


def _tb_facts(rec: Record) -> DataFrame:
    moment = F.col("value_datetime")
    specs = {
        "tb_pulmonaire": Obs((PRESENT, PAST), (42,)),
        "tb_multiresistante": Obs((PRESENT, PAST), (159355,)),
        "tb_extrapul_ou_diss": Obs((PRESENT, PAST), (118890, 5042)),
        "tb_new_diag": Obs((1659,), (160567,)),
        "tb_follow_up_diag": Obs((1659,), (1662,)),
        "cough_for_2wks_or_more": Obs((SYMPTOM,), (159799,)),
        "tb_treatment_start_date": Obs((1113,), value=day("value_datetime"), pick="latest"),
        "tb_treatment_stop_date": Obs((159431,), value=day("value_datetime"), pick="latest"),
        "_started": Obs((1113,), where=moment.isNotNull()),
        "dyspnea": Obs((SYMPTOM,), (122496,)),
        "tb_diag_sputum": Obs((163752,), (307,)),
        "tb_diag_xray": Obs((163752,), (12,)),
        "tb_medication_provided": Obs((1111,), TB_DRUGS),
        "tb_hiv_test_result": Obs((1169,), (1402, 664, 703), value=labels("value_coded", {POSITIVE: 4, NEGATIVE: 2})),
        "tb_prophy_cotrimoxazole": Obs((1109,), (105281,)),
        # Any answer but the first one listed counts as 2.
        "on_arv": Obs((160117,), (160119, 1461), value=F.when(F.col("value_coded") == 160119, 1).otherwise(2)),
        # Steps of the treatment status, in the order in which they are written.
        "_outcome": Obs((159786,), value=labels("value_coded", TB_OUTCOMES)),
        "_has_outcome": Obs((159786,)),
        "_kind": Obs(None, TB_KINDS),
        "_present_any": Obs((PRESENT,), TB_ACTIVE_KINDS, any_voided=True),
        "_present_live": Obs((PRESENT,), TB_KINDS),
        "_cured": Obs((PAST,), TB_KINDS),
        "_active": Obs((PRESENT,), TB_ACTIVE_KINDS),
        "_follow": Obs((1659,), value=labels("value_coded", {1663: 2, 1662: 6})),
        "_has_follow": Obs((1659,)),
    }
    specs |= {n: Obs((160040,), (c,)) for n, c in TB_CLASSES.items()}
    return collect_obs(rec.obs, "encounter_id", specs)


def _tb_status():
    known = F.col
    return (
        F.when(known("_has_follow").isNotNull(), known("_follow"))
        .when(known("_active").isNotNull(), F.lit(6))
        .when(known("_cured").isNotNull(), F.lit(1))
        # A kind is named while the present-disease answer was voided: only a live present answer keeps 6.
        .when(
            known("_present_any").isNotNull() & known("_kind").isNotNull(),
            F.when(known("_present_live").isNotNull(), F.lit(6)),
        )
        .when(known("_has_outcome").isNotNull(), known("_outcome"))
        .otherwise(F.lit(0))
    )


def patient_tb_diagnosis(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Tuberculosis facts. Grain: encounter, location."""
    context = encounter_context.filter(live("encounter_voided")).select(
        "encounter_id", F.col("encounter_type").alias("encounter_type_id")
    )
    out = _tb_spine(rec)
    for part in (
        _tb_facts(rec), _tb_groups(rec), _tb_controls(rec), visit_of(encounter_context, live_only=True),
        provider(rec), context,
    ):
        out = out.join(part, "encounter_id", "left")
    out = out.join(
        rec.person.select(F.col("person_id").alias("patient_id"), "birthdate"), "patient_id", "left"
    )
    return out.select(
        "patient_id", "encounter_id", "location_id", "visit_id", "visit_date", "encounter_type_id", "provider_id",
        "tb_diag", "mdr_tb_diag", "tb_new_diag", "tb_follow_up_diag", "cough_for_2wks_or_more", "dyspnea",
        "tb_diag_sputum", "tb_diag_xray", *TB_CONTROLS, *TB_CLASSES,
        whole_units("YEAR", "birthdate", "visit_date").cast("int").alias("age_at_visit_years"),
        whole_units("MONTH", "birthdate", "visit_date").cast("int").alias("age_at_visit_months"),
        "tb_pulmonaire", "tb_multiresistante", "tb_extrapul_ou_diss", "tb_treatment_start_date",
        F.coalesce("_started", "dyspnea").alias("tb_started_treatment"), "tb_medication_provided",
        _tb_status().alias("status_tb_treatment"), "tb_hiv_test_result", "tb_prophy_cotrimoxazole", "on_arv",
        "tb_treatment_stop_date", "voided",
    )


# ------------------------------------------------------------------------------ nutrition and obstetrics


def _form_spine(context: DataFrame, types: list[int]) -> DataFrame:
    return of_types(context, types).select(
        "patient_id", F.col("encounter_type").alias("encounter_type_id"), "encounter_id", "location_id",
        "visit_id", day("encounter_datetime").alias("visit_date"), F.col("encounter_voided").alias("voided"),
    )


def nutrition_specs() -> dict[str, Obs]:
    weight_for_height = labels("value_coded", {1115: 1, 164131: 2, 123815: 2})
    return {
        "weight": _latest_number(WEIGHT), "height": _latest_number(HEIGHT), "edema": Obs((SYMPTOM,), (460,)),
        "weight_for_height": Obs((163515,), value=weight_for_height),
    }


def patient_nutrition(rec: Record, encounter_context: DataFrame, encounter_seen: DataFrame, encounter_facts: DataFrame) -> DataFrame:
    """Growth and nutrition of primary-care visits. Grain: encounter, location."""
    types = rec.codes.encounter("adult_initial", "adult_followup", "ped_initial", "ped_followup")
    spine = _form_spine(encounter_context, types)
    # Whether the form holds anything at all decides the age and the oedema answer.
    any_live = encounter_seen.filter("any_live").select("encounter_id", F.lit(1).alias("_any")).distinct()
    facts = any_live.join(facts_of(encounter_facts, "nutrition"), "encounter_id", "left").withColumn("edema", F.coalesce("edema", F.lit(0)))
    out = spine.join(facts, "encounter_id", "left").join(
        rec.person.select(F.col("person_id").alias("patient_id"), "birthdate"), "patient_id", "left"
    )
    answered = F.col("_any").isNotNull()
    out = out.withColumns(
        {
            "age_at_visit_years": F.when(answered, whole_units("YEAR", "birthdate", "visit_date")).cast("int"),
            "age_at_visit_months": F.when(answered, whole_units("MONTH", "birthdate", "visit_date")).cast("int"),
        }
    )
    adult = (F.col("age_at_visit_years") >= 20) & live()
    return out.withColumn("bmi", F.when(adult, bmi("weight", "height", 1))).select(
        "patient_id", "encounter_type_id", "encounter_id", "location_id", "visit_id", "visit_date",
        "age_at_visit_years", "age_at_visit_months", "weight", "height", "bmi", "edema", "weight_for_height", "voided",
    )


# Answers that make a pregnancy a high-risk one.
HIGH_RISK = (1107, 145777, 148834, 119476, 460, 1053, 163119, 163120)


def ob_gyn_specs() -> dict[str, Obs]:
    number = F.col("value_numeric")
    return {
        "muac": _latest_number(MUAC),
        "pregnant": Obs((160288,), (1622,)),
        "next_visit_date": Obs((5096,), value=day("value_datetime"), pick="latest"),
        "edd": Obs((5596,), value=day("value_datetime"), pick="latest"),
        "birth_plan": Obs((163764, 161007, 160112, 163765, 163766), (YES,)),
        "high_risk": Obs((160079,), HIGH_RISK),
        "gestation_greater_than_12_wks": Obs((1438,), where=number >= 12),
        "iron_supplement": Obs((DRUG,), (5843,)),
        "folic_acid_supplement": Obs((DRUG,), (76613,)),
        "prescribed_iron": Obs((DRUG,), (78218,)),
        "prescribed_folic_acid": Obs((DRUG,), (76613,)),
        "tetanus_toxoid_vaccine": Obs((984,), (84879,)),
        "iron_defiency_anemia": Obs((160079,), (148834,)),
        "_systolic": Obs((5085,), where=number.between(120, 129)),
        "_diastolic": Obs((5086,), where=number < 80),
    }


def patient_ob_gyn(rec: Record, encounter_context: DataFrame, encounter_facts: DataFrame, intended_pressure: bool = False) -> DataFrame:
    """Obstetric follow-up. Grain: encounter, location.

    `intended_pressure` flags a systolic value of 120-129 together with a diastolic value below 80; the
    original rule asks both of one observation and so never matches.
    """
    facts = facts_of(encounter_facts, "ob_gyn")
    spine = _form_spine(encounter_context, rec.codes.encounter("obgyn_initial", "obgyn_followup"))
    pressure = flag(F.col("_systolic").isNotNull() & F.col("_diastolic").isNotNull() & F.lit(intended_pressure))
    out = spine.join(facts, "encounter_id", "left").withColumn("muac", round_int("muac"))
    return out.withColumn("elevated_blood_pressure", pressure).drop("_systolic", "_diastolic").select(
        "patient_id", "encounter_type_id", "encounter_id", "location_id", "visit_id", "visit_date",
        *[c for c in ob_gyn_specs() if not c.startswith("_")], "elevated_blood_pressure", "voided",
    )


# ----------------------------------------------------------------------------------------------- imaging


SHOTS = (12, 309, 307)


def imaging_specs() -> dict[str, Obs]:
    return {
        name: Obs((c,), value="value_coded", pick="latest", at=True)
        for name, c in zip(("radiographie_pul", "radiographie_autre", "crachat_barr"), SHOTS, strict=True)
    }


def patient_imagerie(rec: Record, encounter_context: DataFrame, encounter_facts: DataFrame) -> DataFrame:
    """Imaging results. Grain: location, encounter."""
    context = of_types(encounter_context, rec.codes.encounter("imaging")).filter("in_visit").select(
        "encounter_id", "visit_id", "visit_date", "visit_voided"
    )
    rows = rec.obs.filter(F.col("concept_id").isin(*SHOTS)).select("obs_id", "person_id", "encounter_id", "location_id")
    spine = rows.groupBy("encounter_id", "location_id").agg(F.min_by("person_id", "obs_id").alias("patient_id"))
    facts = facts_of(encounter_facts, "imaging")
    out = spine.join(context, "encounter_id").join(facts, "encounter_id", "left")
    lungs = F.when(F.col("radiographie_pul_at").isNull(), F.lit(0)).otherwise(F.col("radiographie_pul"))
    return out.select(
        "patient_id", "location_id", "visit_id", "encounter_id", "visit_date", lungs.alias("radiographie_pul"),
        "radiographie_autre", "crachat_barr", F.col("visit_voided").alias("voided"),
    )


# ----------------------------------------------------------------------------------------------- malaria


def malaria_specs() -> dict[str, Obs]:
    named = F.col("concept_id") == PAST
    return {
        "fever_for_less_than_2wks": Obs((SYMPTOM,), (163740,)),
        # Every present diagnosis counts, voided or not; a past one only when it is live malaria.
        "suspected_malaria": Obs(
            (PRESENT, PAST), where=(F.col("concept_id") == PRESENT) | (named & (F.col("value_coded") == 116128) & live()),
            any_voided=True,
        ),
        "confirmed_malaria": Obs((PRESENT, PAST), (160148,)),
        "treated_with_chloroquine": Obs((DRUG,), (73300,)),
        "treated_with_primaquine": Obs((DRUG,), (82521,)),
        "treated_with_quinine": Obs((DRUG,), (83023,)),
        "microscopic_test": Obs((1271,), (1366,)),
        "positive_microscopic_test_result": Obs((1366,), (1365, 1364, 1362, 1363)),
        "negative_microscopic_test_result": Obs((1366,), (664,)),
        "positive_plasmodium_falciparum_test_result": Obs((1643,), (161246,)),
        "mixed_positive_test_result": Obs((1643,), (161248,)),
        "positive_plasmodium_vivax_test_result": Obs((1643,), (161247,)),
        "rapid_test": Obs((1271,), (1643,)),
        "positve_rapid_test_result": Obs((1643,), (703,)),
        "severe_malaria": Obs((PRESENT,), (160155,)),
        "hospitallized": Obs((1272,), (5485,)),
        "confirmed_malaria_preganancy": Obs((160168,), (160152,)),
    }


def patient_malaria(rec: Record, encounter_context: DataFrame, encounter_facts: DataFrame) -> DataFrame:
    """Malaria facts of each patient's latest form that may hold them. Grain: patient."""
    types = rec.codes.encounter(
        "adult_initial", "adult_followup", "ped_initial", "ped_followup", "obgyn_followup", "obgyn_initial",
        "first_hiv", "followup_hiv", "ped_first_hiv", "lab",
    )
    forms = of_types(encounter_context, types)
    latest = first_and_last(
        forms, ["patient_id"], [], ["encounter_type", "encounter_id", "location_id", "visit_id", "encounter_datetime", "encounter_voided"],
        F.struct(F.col("encounter_datetime").alias("_t"), F.col("encounter_id").alias("_e")),
    )
    facts = facts_of(encounter_facts, "malaria")
    return latest.join(facts, "encounter_id", "left").select(
        "patient_id", F.col("encounter_type").alias("encounter_type_id"), "encounter_id", "location_id", "visit_id",
        day("encounter_datetime").alias("visit_date"), *malaria_specs(), F.col("encounter_voided").alias("voided"),
    )


# --------------------------------------------------------------------------- small form-by-form marts


def visit_type(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Kind of obstetric visit. Grain: encounter, location, concept, kind."""
    rows = rec.obs.filter(
        (F.col("concept_id") == 160288) & F.col("value_coded").isin(160456, 1622, 1623, 5483)
    ).select(F.col("person_id").alias("patient_id"), "encounter_id", "location_id", "concept_id",
             F.col("value_coded").alias("v_type"), "voided", "obs_id")
    spine = first_and_last(
        rows, ["encounter_id", "location_id", "concept_id", "v_type"], ["patient_id"], ["voided"], "obs_id"
    )
    forms = encounter_context.select("encounter_id", "visit_id", day("encounter_datetime").alias("encounter_date"))
    return spine.join(forms, "encounter_id").select(
        "patient_id", "encounter_id", "location_id", "visit_id", "concept_id", "v_type", "encounter_date", "voided"
    )


def _answers(
    rec: Record, context: DataFrame, types: list[str] | None, concepts: tuple, codes: tuple | None = None
) -> DataFrame:
    """Answers to some questions on some kinds of form, with the day of the form."""
    forms = context if types is None else of_types(context, rec.codes.encounter(*types))
    rows = rec.obs.filter(F.col("concept_id").isin(*concepts))
    if codes is not None:
        rows = rows.filter(F.col("value_coded").isin(*codes))
    return rows.select(
        "obs_id", F.col("person_id").alias("patient_id"), "encounter_id", "location_id", "concept_id",
        "value_coded", "voided",
    ).join(forms.select("encounter_id", "encounter_datetime"), "encounter_id")


def _one_per_form(rows: DataFrame, keys: list[str], first: list[str] = (), last: list[str] = ()) -> DataFrame:
    rows = rows.withColumn("encounter_date", day("encounter_datetime"))
    return first_and_last(rows, keys, [*first, "encounter_date"], [*last, "voided"], "obs_id")


def _by_form(rec: Record, **columns: Obs) -> DataFrame:
    return collect_obs(rec.obs, ["encounter_id", "location_id"], columns)


FORM = ["patient_id", "encounter_id", "location_id"]


def patient_delivery(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Deliveries. Grain: encounter, location."""
    rows = _answers(rec, encounter_context, ["labor_delivery"], (1572,), (163266, 1501, 1502, 5622))
    spine = _one_per_form(
        rows.withColumnRenamed("value_coded", "delivery_location"), ["encounter_id", "location_id"],
        ["patient_id"], ["delivery_location"],
    )
    dates = _by_form(rec, delivery_date=Obs((5599,), value="value_datetime", pick="latest"))
    return spine.join(dates, ["encounter_id", "location_id"], "left").select(
        *FORM, "delivery_location", "delivery_date", "encounter_date", "voided"
    )


def pediatric_hiv_visit(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Paediatric HIV questions. Grain: patient, encounter, location."""
    rows = _answers(rec, encounter_context, ["ped_first_hiv", "ped_followup_hiv"], (163776, 5665, 1401))
    facts = _by_form(
        rec,
        ptme=Obs((163776,), value="value_coded", pick="latest"),
        prophylaxie72h=Obs((5665,), value="value_coded", pick="latest"),
        actual_vih_status=Obs((1401,), value="value_coded", pick="latest"),
    )
    return _one_per_form(rows, FORM).join(facts, ["encounter_id", "location_id"], "left").select(
        *FORM, "ptme", "prophylaxie72h", "actual_vih_status", "encounter_date", "voided"
    )


def patient_menstruation(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Last menstrual period. Grain: patient, encounter, location."""
    rows = _answers(rec, encounter_context, ["obgyn_initial", "obgyn_followup"], (163732, 160597, 1427))
    facts = _by_form(rec, ddr=Obs((1427,), value=day("value_datetime"), pick="latest"))
    return _one_per_form(rows, FORM).join(facts, ["encounter_id", "location_id"], "left").select(
        *FORM, "ddr", "encounter_date", "voided"
    )


# Risk factors given as an answer, and risk questions answered yes.
RISK_ANSWERS = (163290, 163291, 105, 1063, 163273, 163274, 163289, 163275, 5567, 159218)
RISK_QUESTIONS = (123160, 156660, 163276, 163278, 160579, 160580)


def vih_risk_factor(rec: Record, encounter_context: DataFrame) -> DataFrame:
    """Exposure to HIV. Grain: patient, encounter, location, factor."""
    types = ["first_hiv", "ped_first_hiv"]
    named = _answers(rec, encounter_context, types, (1061, 160581), RISK_ANSWERS)
    asked = _answers(rec, encounter_context, types, RISK_QUESTIONS, (YES,))
    rows = named.withColumn("risk_factor", F.col("value_coded")).withColumn("step", F.lit(1)).unionByName(
        asked.withColumn("risk_factor", F.col("concept_id")).withColumn("step", F.lit(2))
    )
    rows = rows.withColumn("encounter_date", day("encounter_datetime"))
    return first_and_last(
        rows, [*FORM, "risk_factor"], ["encounter_date"], ["voided"], F.struct("step", "obs_id")
    ).select(*FORM, "risk_factor", "encounter_date", "voided")


# Family-planning methods and key populations.
PLANNING = {780: "PILLS", 190: "CONDOM", 1359: "IMPLANTS", 5279: "INJECT", 163759: "NECKLACE"}
KEY_POPULATIONS = {
    160578: "MSM", 160579: "SEX PROFESSIONAL", 162277: "CAPTIVE", 124275: "TRANSGENDER", 105: "DRUG USER",
}


def key_populations(rec: Record) -> DataFrame:
    """Key populations named. Grain: patient, encounter, population, voided flag."""
    rows = rec.obs.filter(
        is_any("concept_id", rec.codes.concept("key_population"))
        & F.col("value_coded").isNotNull() & F.col("voided").isNotNull()
    ).select(
        F.col("person_id").alias("patient_id"), "encounter_id", "location_id",
        F.col("value_coded").alias("key_population"), F.col("value_datetime").alias("encounter_date"),
        "voided", "obs_id",
    )
    return first_and_last(
        rows, ["patient_id", "encounter_id", "key_population", "voided"], ["location_id", "encounter_date"], [], "obs_id"
    )


def family_planning(rec: Record) -> DataFrame:
    """Family-planning methods. Grain: patient, encounter, method, voided flag.

    `accepting_or_using_fp` is 1 on the patient's first day with a method and 2 later.
    """
    rows = rec.obs.filter(
        (F.col("concept_id") == 374) & F.col("value_coded").isin(*PLANNING) & live()
    ).select(
        F.col("person_id").alias("patient_id"), "encounter_id", "location_id",
        F.col("value_coded").alias("planning"), F.col("obs_datetime").alias("encounter_date"), "voided", "obs_id",
    )
    methods = first_and_last(
        rows, ["patient_id", "encounter_id", "planning", "voided"], ["location_id", "encounter_date"], [], "obs_id"
    )
    start = methods.groupBy("patient_id").agg(F.min("encounter_date").alias("_first"))
    return methods.join(start, "patient_id").select(
        "patient_id", "encounter_id", "location_id", "planning", "encounter_date",
        labels("planning", PLANNING).alias("family_planning_method_name"),
        F.when(day("encounter_date") == day("_first"), 1).otherwise(2).alias("accepting_or_using_fp"), "voided",
    )


# ------------------------------------------------------------------------------ one pass for many reports


def encounter_facts(rec: Record) -> DataFrame:
    """The columns that five reports take from the observations of an encounter, from one pass over them. Grain: encounter, person."""
    return many_facts(rec.obs, ["encounter_id", "person_id"], {
        "quality": quality_specs(), "nutrition": nutrition_specs(), "ob_gyn": ob_gyn_specs(), "malaria": malaria_specs(), "imaging": imaging_specs(),
    })
