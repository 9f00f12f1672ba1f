"""Every registered query with its reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.plans import alerts as al, status as st, surveillance
from medloom.plans.increment import Day, obs_of_day
from medloom.sources.warehouse import Warehouse
from oracle.compose import sql
from oracle.spark_record import reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, text: str | None = None):
    """Add a query; `text` is a statement or the name of a composed one."""

    def add(fn):
        QUERIES[name] = fn
        if text is not None:
            ORACLES[name] = sql(text)
        return fn

    return add


def _report(name: str, text: str | None = None, key: str | None = None, **options):
    register(key or name, text or name)(lambda spark, d: reports(spark, d).build(name, **options))


# Report tables, one query each.
_report("location", "location_mart")
_report("patient", "patient_mart")
for _name in (
    "patient_visit", "patient_prescription", "patient_dispensing", "patient_on_arv", "patient_laboratory",
    "virological_tests", "serological_tests", "patient_pcr", "health_qual_patient_visit", "patient_tb_diagnosis",
    "patient_nutrition", "patient_ob_gyn", "patient_imagerie", "patient_malaria", "visit_type", "patient_delivery",
    "pediatric_hiv_visit", "patient_menstruation", "vih_risk_factor", "key_populations", "family_planning",
    "stopping_reason", "discontinuation_reason", "patient_pregnancy", "vaccination", "patient_on_art",
    "patient_diagnosis", "indicators", "weekly_indicators", "patient_immunization", "immunization_dose",
    "exposed_infants", "statuses", "current_status", "regimens", "patient_summary", "alerts", "first_alerts",
):
    _report(_name)
_report("patient_ob_gyn", "ob_gyn_intended", key="patient_ob_gyn_intended_pressure", intended_pressure=True)
_report("health_qual_patient_visit", "health_qual_intended", key="health_qual_intended_nutrition", intended_nutrition=True)
_report("patient_on_art", "art_intended", key="patient_on_art_intended_screening", intended_screening=True)


@register("status_counts", "status_counts")
def _status_counts(spark, d):
    return reports(spark, d).table("statuses").groupBy("id_status").agg(
        F.count("*").alias("patients"), F.min("start_date").alias("first_start"), F.max("start_date").alias("last_start")
    )


# The status rules one by one.
def _rule(key: str, text: str, build):
    register(key, text)(lambda spark, d: build(reports(spark, d)))


_rule("status_left_before_treatment", "status_left_before", lambda r: st.left_before_treatment(
    r.rec, r.table("encounter_context"), r.table("patient"), r.table("patient_on_arv")))
_rule("status_refill", "status_refill", lambda r: st.refill(
    r.rec, r.table("encounter_context"), r.table("patient"), r.table("patient_dispensing"), r.table("patient_on_arv"),
    r.table("discontinuation_reason"), r.as_of))
_rule("status_before_treatment", "status_before", lambda r: st.before_treatment(
    r.rec, r.table("encounter_context"), r.table("patient"), r.table("patient_on_arv"), r.table("discontinuation_reason"), r.as_of))
_rule("status_left_on_treatment", "status_left_on", lambda r: st.left_on_treatment(
    r.rec, r.table("encounter_context"), r.table("patient_on_arv")))
_rule("indicator_totals", "indicator_totals", lambda r: surveillance.indicator_events(
    r.table("patient_diagnosis"), r.table("patient"), surveillance.indicator_rules(r.rec.spark, r.rec.concept),
).groupBy("rule_id", "label", "patient_id").agg(F.count("*").alias("n")).groupBy("rule_id", "label").agg(
    F.sum("n").alias("events"), F.count("*").alias("patients")))

# The alert rules one by one.
for _key, _fn in zip(
    ("alert_1", "alert_2", "alert_3", "alert_4", "alert_5", "alert_6", "alert_7", "alert_8", "alert_9_dispensed",
     "alert_9_form", "alert_10", "alert_11", "alert_12"), al.RULES, strict=True,
):
    _rule(_key, _key, lambda r, fn=_fn: fn(r.table("alert_inputs")))


# The incremental run over the observations entered on the day, one query per job.
#: The tables an incremental run starts from.
STATE = (
    "patient", "patient_laboratory", "virological_tests", "patient_dispensing", "patient_on_arv",
    "discontinuation_reason", "status_history", "regimens",
)
_DAYS: dict[tuple[str, str], Day] = {}


def _day(spark: SparkSession, d: str) -> Day:
    """An incremental run on top of the full load, whose tables are made when they are asked for."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _DAYS:
        full, after = reports(spark, d), Warehouse(spark)
        run = Day(full.rec, full.as_of, full.table, after.write)
        _DAYS[key] = run.start(obs_of_day(full.rec.obs, full.as_of))
    return _DAYS[key]


for _key, _table, _text in (
    ("day_obs", "obs_of_day", "obs_day"),
    ("day_high_water", "high_water", "high_water_day"),
    ("day_patients", "patient", "patients_day"),
    ("day_dispensing", "dispensing_of_day", "dispensing_day"),
    ("day_prescription", "prescription_of_day", "prescription_day"),
    ("day_laboratory", "patient_laboratory", "lab_day"),
    ("day_virology", "virological_tests", "virology_day"),
    ("day_exposed_infants", "infants_of_day", "infants_day"),
    ("day_statuses", "statuses_of_day", "statuses_day"),
    ("day_status_history", "status_history", "history_day"),
    ("day_regimens", "regimens", "regimens_day"),
):
    register(_key, _text)(lambda spark, d, t=_table: _day(spark, d).table(t))
