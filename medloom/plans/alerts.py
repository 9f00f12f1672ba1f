"""Clinical alerts: which patients need attention on a given day.

`alerts` is the current rule set (codes 1 to 12); `first_alerts` is the earlier one with its own codes.

`alert_facts` gathers all that the rules ask about a patient in one aggregate over the tables they read, one
row per patient. A rule is then a condition on that row, or on a dispensing, laboratory or observation row
beside it; the rules on one kind of row are columns of one pass, and a row gives as many alerts as hold.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import YES, day, days_between, flag, mysql_num, not_voided, whole_units
from medloom.operators.eav import with_header
from medloom.operators.merge import keep_matching
from medloom.plans.shared import DRUG, PROPHYLAXIS, TREATMENT, of_types
from medloom.sources.codes import is_any
from medloom.sources.record import Record

VIRAL_LOAD, VIRAL_LOAD_CODED = 856, 1305
DETECTED, SUPPRESSED = 1301, 1306
ISONIAZID, RIFAMPICIN = 78280, 767
DRUG_TAKEN = 159367
OUT = ["patient_id", "id_alert", "encounter_id", "date_alert"]


def _test_day() -> Column:
    return F.coalesce(day("date_test_done"), day("visit_date"))


def _viral() -> Column:
    return F.col("test_id").isin(VIRAL_LOAD, VIRAL_LOAD_CODED)


def _any(condition: Column) -> Column:
    """Whether any row of the group satisfies the condition."""
    return F.coalesce(F.max(F.when(condition, F.lit(True))), F.lit(False))


def alert_facts(
    rec: Record, encounter_context: DataFrame, patient_with_status: DataFrame, patient_dispensing: DataFrame,
    patient_laboratory: DataFrame, patient_pregnancy: DataFrame, patient_on_arv: DataFrame, discontinuation_reason: DataFrame,
) -> DataFrame:
    """All that the rules ask about a patient: one row per patient that any of the tables names.

    Every table gives its rows with a tag; one aggregate, combined before the shuffle, makes the facts.
    """
    codes, result = rec.codes, F.col("test_result")
    stop, forms = codes.encounter("discontinuation"), codes.encounter("first_hiv", "followup_hiv", "ped_first_hiv", "ped_followup_hiv")
    live_form = not_voided("encounter_voided")
    handed_out = of_types(encounter_context.filter(live_form), codes.encounter("dispensing", "ped_dispensing"))
    isoniazid = rec.obs.filter((F.col("concept_id") == DRUG) & (F.col("value_coded") == ISONIAZID) & not_voided()).select(
        "encounter_id", F.col("person_id").alias("patient_id")
    )
    tests = rec.obs.filter(F.col("concept_id").isin(VIRAL_LOAD, VIRAL_LOAD_CODED) & not_voided())
    sources = {
        "patient": patient_with_status.select("patient_id", "vih_status", "arv_status", "date_started_arv"),
        "form": of_types(encounter_context, [*stop, *forms]).select("patient_id", "encounter_type", "encounter_datetime", live_form.alias("live_form")),
        "dispensing": patient_dispensing.select(
            "patient_id", "encounter_id", day("visit_date").alias("visit_day"), "next_dispensation_date", "arv_drug", "rx_or_prophy", "voided"
        ),
        "laboratory": patient_laboratory.select("patient_id", "test_id", "test_done", "test_result", _test_day().alias("test_day"), F.col("voided").alias("test_voided")),
        "pregnancy": patient_pregnancy.select("patient_id"),
        "on_arv": patient_on_arv.select("patient_id"),
        "reason": discontinuation_reason.select("patient_id"),
        "protected": keep_matching(handed_out, isoniazid, ["encounter_id", "patient_id"]).select("patient_id"),
        "test": tests.select(F.col("person_id").alias("patient_id"), day("obs_datetime").alias("obs_day")),
    }
    rows = reduce(
        lambda x, y: x.unionByName(y, allowMissingColumns=True), (df.withColumn("tag", F.lit(t)) for t, df in sources.items())
    ).filter("patient_id IS NOT NULL")
    tag = F.col("tag")
    arv, kept = F.col("arv_drug") == YES, not_voided()
    curative = (F.col("rx_or_prophy") != PROPHYLAXIS) | F.col("rx_or_prophy").isNull()
    done, live_test = F.col("test_done") == 1, not_voided("test_voided")
    given, filled = result.isNotNull(), result.isNotNull() & (result != "")
    detected = (F.col("test_id") == VIRAL_LOAD_CODED) & mysql_num(result).isin(float(DETECTED), float(SUPPRESSED))
    return rows.groupBy("patient_id").agg(
        _any(tag == "patient").alias("known"), _any((tag == "patient") & (F.col("vih_status") == 1)).alias("positive"),
        F.max("arv_status").alias("arv_status"), F.max("date_started_arv").alias("date_started_arv"),
        _any(is_any("encounter_type", stop) & F.col("live_form")).alias("stop_form"), _any(is_any("encounter_type", stop)).alias("any_stop_form"),
        F.max(F.when(is_any("encounter_type", forms) & F.col("live_form"), F.col("encounter_datetime"))).alias("last_form"),
        F.min(F.when(arv & kept, F.col("encounter_id"))).alias("first_encounter"), F.min(F.when(arv & kept, F.col("visit_day"))).alias("first_day"),
        F.max(F.when(arv, F.col("encounter_id"))).alias("any_first_encounter"), F.min(F.when(arv, F.col("visit_day"))).alias("any_first_day"),
        F.max(F.when(arv & curative & kept, F.col("next_dispensation_date"))).alias("refill"),
        F.max(F.when(kept & (tag == "dispensing"), F.col("visit_day"))).alias("last_given"),
        _any(_viral() & done & live_test & filled).alias("viral_load"), _any(_viral() & done & live_test & given).alias("any_viral_load"),
        _any(live_test & (((F.col("test_id") == VIRAL_LOAD) & filled) | detected)).alias("tested"),
        F.max(F.when(_viral() & (mysql_num(result) > 0) & live_test, F.col("test_day"))).alias("last_positive_test"),
        F.max(F.when((F.col("test_id") == VIRAL_LOAD) & done & filled & live_test, F.col("test_day"))).alias("last_viral_load"),
        F.max(F.when(_viral() & done & given & live_test, F.col("test_day"))).alias("last_test"),
        F.max("obs_day").alias("last_obs"),
        *[_any(tag == t).alias(t) for t in ("pregnancy", "on_arv", "reason", "protected")],
    )


@dataclass(frozen=True)
class AlertInputs:
    """Tables the rules read; `facts` as `alert_facts` gives them."""

    rec: Record
    context: DataFrame
    dispensing: DataFrame
    laboratory: DataFrame
    facts: DataFrame
    as_of: object

    @property
    def today(self) -> Column:
        return F.lit(self.as_of).cast("date")


def _in_care(*out: int) -> Column:
    """Status known and not one of those that left care."""
    return F.coalesce(~F.col("arv_status").isin(*(out or (1, 2, 3))), F.lit(False))


def _rules(rows: DataFrame, date: str, encounter: str, **rules: Column) -> DataFrame:
    """An alert for each rule that holds on a row; a rule's name is its code, after an underscore, and maybe a letter."""
    hits = F.array(*[F.when(condition, F.lit(name[1:])) for name, condition in rules.items()])
    return rows.select(
        "patient_id", F.explode(F.array_compact(hits)).alias("rule"), F.col(encounter).alias("encounter_id"), day(date).alias("date_alert")
    ).distinct()


def _started(x: AlertInputs) -> DataFrame:
    """Rules on the first dispensation: the recorded start at an age of treatment, without a viral load."""
    months = whole_units("MONTH", "date_started_arv", x.today)
    start = F.col("positive") & (F.col("date_started_arv") == F.col("first_day")) & ~F.col("viral_load")
    left = F.col("stop_form") & F.col("reason")
    return _rules(
        x.facts.filter(F.col("first_day").isNotNull()), "first_day", "first_encounter",
        _1=start & (months >= 6) & ~left,
        _2=start & (months == 5) & ~F.col("stop_form"),
        _3=start & (months >= 4) & F.col("pregnancy") & ~left,
        _10=F.col("positive") & _in_care(1, 2, 3, 4) & ~F.col("tested") & (whole_units("MONTH", "first_day", x.today) >= 3),
    )


def _tested(x: AlertInputs) -> DataFrame:
    """Rules on laboratory rows of the day of the patient's latest test."""
    result = mysql_num("test_result")
    rows = x.laboratory.filter(_viral()).withColumn("test_day", _test_day()).join(x.facts, "patient_id")
    low = ((F.col("test_id") == VIRAL_LOAD) & (result < 1000)) | ((F.col("test_id") == VIRAL_LOAD_CODED) & (result == SUPPRESSED))
    treated = F.col("on_arv") & F.col("positive")
    return _rules(
        rows, "test_day", "encounter_id",
        _4=treated & _in_care() & (F.col("test_day") == F.col("last_positive_test")) & low & (whole_units("MONTH", "test_day", x.today) >= 12),
        _6=treated & ~(F.col("stop_form") & F.col("reason")) & (F.col("test_day") == F.col("last_viral_load")) & (F.col("test_id") == VIRAL_LOAD) & (result > 1000),
    )


def _dispensed(x: AlertInputs) -> DataFrame:
    """Rules on dispensing rows: the next refill is due or overdue, no isoniazid."""
    left = days_between("next_dispensation_date", x.today)
    latest = _in_care() & (F.col("next_dispensation_date") == F.col("refill"))
    return _rules(
        x.dispensing.join(x.facts, "patient_id"), "visit_date", "encounter_id",
        _7=latest & left.between(0, 30),
        _8=latest & (left < 0),
        _11=F.col("positive") & _in_care() & ~F.col("protected") & (F.col("arv_drug") == YES) & (F.col("rx_or_prophy") != PROPHYLAXIS),
    )


def _observed(x: AlertInputs) -> DataFrame:
    """Rules on observations: a high viral load on the day of the latest one, a subscription to community dispensing."""
    concept, subscription = F.col("concept_id"), x.rec.codes.concept("ddp")
    rows = x.rec.obs.filter((concept.isin(VIRAL_LOAD, VIRAL_LOAD_CODED) | is_any("concept_id", subscription)) & not_voided()).select(
        F.col("person_id").alias("patient_id"), "encounter_id", "concept_id", "value_numeric", "value_coded", "obs_datetime"
    ).join(x.facts.select("patient_id", "arv_status", "last_obs"), "patient_id", "left")
    high = ((concept == VIRAL_LOAD) & (F.col("value_numeric") > 1000)) | ((concept == VIRAL_LOAD_CODED) & (F.col("value_coded") == DETECTED))
    return _rules(
        rows, "obs_datetime", "encounter_id",
        _5=high & _in_care() & (day("obs_datetime") == F.col("last_obs")) & (whole_units("MONTH", day("obs_datetime"), x.today) >= 3),
        _12=is_any("concept_id", subscription) & (F.col("value_coded") == YES),
    )


def _both_drugs(rows: DataFrame, **rule: Column) -> DataFrame:
    """Encounters with isoniazid and rifampicin; rows: patient_id, encounter_id, drug_id, given_day."""
    pairs = rows.groupBy("patient_id", "encounter_id", "given_day").agg(
        F.max(flag(F.col("drug_id") == ISONIAZID)).alias("inh"), F.max(flag(F.col("drug_id") == RIFAMPICIN)).alias("rif")
    )
    return _rules(pairs, "given_day", "encounter_id", **{name: F.col("inh").isNotNull() & F.col("rif").isNotNull() for name in rule})


def _tb_dispensed(x: AlertInputs) -> DataFrame:
    """Both tuberculosis drugs at the latest dispensing visit."""
    drug = ((F.col("drug_id") == ISONIAZID) & (F.col("rx_or_prophy") == TREATMENT)) | (F.col("drug_id") == RIFAMPICIN)
    rows = x.dispensing.filter(not_voided() & drug).withColumn("given_day", day("visit_date")).join(x.facts, "patient_id")
    return _both_drugs(rows.filter(F.col("on_arv") & _in_care() & (F.col("given_day") == F.col("last_given"))), _9=F.lit(True))


def _tb_on_form(x: AlertInputs) -> DataFrame:
    """Both tuberculosis drugs ticked as taken on the latest form."""
    codes, obs = x.rec.codes, x.rec.obs.filter(not_voided())
    inh, rif = codes.concept("isoniazid_group"), codes.concept("rifampicin_group")
    types = codes.encounter("first_hiv", "followup_hiv", "ped_first_hiv", "ped_followup_hiv")
    forms = of_types(x.context.filter(not_voided("encounter_voided")), types).select("encounter_id", "patient_id", day("encounter_datetime").alias("given_day"))
    taken = obs.filter((F.col("concept_id") == DRUG_TAKEN) & (F.col("value_coded") == YES)).select("obs_group_id").distinct()
    named = obs.filter((F.col("concept_id") == DRUG) & F.col("value_coded").isin(ISONIAZID, RIFAMPICIN))
    rows = with_header(named, obs, inh + rif, same_encounter=False).filter(
        (is_any("header_concept", inh) & (F.col("value_coded") == ISONIAZID))
        | (is_any("header_concept", rif) & (F.col("value_coded") == RIFAMPICIN))
    ).join(taken, "obs_group_id", "left_semi")
    rows = rows.select(F.col("person_id").alias("patient_id"), "encounter_id", F.col("value_coded").alias("drug_id"))
    on_form = rows.join(forms, ["encounter_id", "patient_id"]).join(x.facts, "patient_id")
    return _both_drugs(on_form.filter(_in_care() & (F.col("given_day") == day("last_form"))), _9f=F.lit(True))


#: The passes, and the rules that each decides; 9 has two.
PASSES = [
    (_started, ("1", "2", "3", "10")), (_tested, ("4", "6")), (_dispensed, ("7", "8", "11")), (_observed, ("5", "12")),
    (_tb_dispensed, ("9",)), (_tb_on_form, ("9f",)),
]


def _coded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("id_alert", F.regexp_replace("rule", "[a-z]", "").cast("int")).select(*OUT)


def rule(name: str):
    """One rule by itself: of its pass, the alerts with its name."""
    def build(x: AlertInputs) -> DataFrame:
        one = next(build for build, names in PASSES if name in names)
        return _coded(one(x).filter(F.col("rule") == name))

    return build


RULES = [rule(n) for n in ("1", "2", "3", "4", "5", "6", "7", "8", "9", "9f", "10", "11", "12")]


def alerts(x: AlertInputs) -> DataFrame:
    """All alerts of the day. The two tuberculosis rules share code 9."""
    return _coded(reduce(DataFrame.unionByName, [build(x) for build, _ in PASSES]))


# ------------------------------------------------------------------------------------------ earlier rule set


def first_alerts(x: AlertInputs) -> DataFrame:
    """The earlier rule set. Code 7 covers refills due and overdue; 8 is five months without a viral load."""
    months = whole_units("MONTH", "date_started_arv", x.today)
    start = F.col("positive") & (F.col("date_started_arv") == F.col("any_first_day")) & ~F.col("any_viral_load")
    left_care = F.col("any_stop_form") & F.col("reason")
    started = _rules(
        x.facts.filter(F.col("any_first_day").isNotNull()), "any_first_day", "any_first_encounter",
        _1=start & (months >= 6) & ~left_care, _2=start & (months >= 4) & F.col("pregnancy") & ~left_care, _8=start & (months == 5) & ~F.col("any_stop_form"),
    )
    rows = x.laboratory.withColumn("test_day", _test_day()).join(x.facts, "patient_id")
    tested = F.col("on_arv") & F.col("positive") & ~left_care & (F.col("test_day") == F.col("last_test"))
    since, above = whole_units("MONTH", "test_day", x.today), mysql_num("test_result") > 1000
    # "More than three months" in whole months is at least four.
    results = _rules(rows, "test_day", "encounter_id", _3=tested & (since >= 12), _4=tested & above & (since >= 4), _5=tested & above)
    due = days_between("next_dispensation_date", x.today)
    latest = F.col("known") & (F.col("next_dispensation_date") == F.col("refill"))
    refills = _rules(
        x.dispensing.join(x.facts, "patient_id"), "visit_date", "encounter_id",
        _7=latest & due.between(0, 30) & ~left_care, _7o=latest & (due < 0) & ~F.col("any_stop_form"),
    )
    return _coded(reduce(DataFrame.unionByName, [started, results, refills]))


def labelled(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Alerts with their messages; codes without a message keep NULL."""
    return rows.join(lookup.withColumnRenamed("id", "id_alert"), "id_alert", "left")
