"""A report run: every table by name, built from the record and from the tables it depends on.

A builder is a function whose parameters name what it reads: `rec` (the record), `as_of` (the day of
the run), `before` (its own table as an earlier run left it, None at first) or other report tables. Tables that others read are written to the warehouse once, so that
lineage stays short, a lost executor costs one stage, and no table is computed twice.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from medloom.plans import (
    alerts as al, clinical, immunisation, laboratory, people, pharmacy, programme, regimens as rg, shared,
    status as st, surveillance,
)
from medloom.sources.dimensions import dimension
from medloom.sources.record import Record
from medloom.sources.warehouse import Warehouse


def regimens(before: DataFrame | None, patient_prescription: DataFrame, patient: DataFrame, rec: Record) -> DataFrame:
    """Regimens of this run added to those of earlier ones, without days whose prescription was voided since."""
    fresh = rg.regimens(patient_prescription, patient, dimension(rec.spark, "regimen"))
    return fresh if before is None else rg.merge_regimens(before, patient_prescription, fresh)


def status_history(
    before: DataFrame | None, statuses: DataFrame, exposed_infants: DataFrame, discontinuation_reason: DataFrame, as_of
) -> DataFrame:
    """The statuses of all runs: the day's rows are replaced, exposed infants leave, reasons are looked up anew."""
    history = statuses if before is None else st.merge_history(before, statuses, as_of)
    return st.refresh_history(history, exposed_infants, discontinuation_reason)


def patient_with_status(patient: DataFrame, current_status: DataFrame) -> DataFrame:
    return st.with_status(patient, current_status)


def current_status(status_history: DataFrame) -> DataFrame:
    return st.current_status(status_history)


def patient_summary(patient: DataFrame, current_status: DataFrame, regimens: DataFrame, rec: Record) -> DataFrame:
    return rg.patient_summary(patient, current_status, regimens, dimension(rec.spark, "arv_status"))


def alert_inputs(
    rec: Record, encounter_context: DataFrame, patient_dispensing: DataFrame, patient_laboratory: DataFrame, alert_facts: DataFrame, as_of,
) -> al.AlertInputs:
    return al.AlertInputs(rec, encounter_context, patient_dispensing, patient_laboratory, alert_facts, as_of)


def alerts(alert_inputs: al.AlertInputs) -> DataFrame:
    return al.alerts(alert_inputs)


def first_alerts(alert_inputs: al.AlertInputs) -> DataFrame:
    return al.first_alerts(alert_inputs)


BUILDERS: dict[str, Callable] = {
    f.__name__: f
    for f in (
        shared.encounter_context, shared.encounter_seen, clinical.encounter_facts, shared.drug_group, shared.drug_order,
        people.location, people.patient, people.patient_visit,
        pharmacy.ordered_drug, pharmacy.doubtful_group, pharmacy.removed_group, pharmacy.patient_prescription, pharmacy.patient_dispensing, pharmacy.patient_on_arv,
        laboratory.laboratory_order, laboratory.patient_laboratory, laboratory.virological_tests, laboratory.serological_tests,
        laboratory.patient_pcr,
        clinical.health_qual_patient_visit, clinical.patient_tb_diagnosis, clinical.patient_nutrition,
        clinical.patient_ob_gyn, clinical.patient_imagerie, clinical.patient_malaria, clinical.visit_type,
        clinical.patient_delivery, clinical.pediatric_hiv_visit, clinical.patient_menstruation,
        clinical.vih_risk_factor, clinical.key_populations, clinical.family_planning,
        programme.stopping_reason, programme.discontinuation_reason, programme.pregnancy_start,
        programme.patient_pregnancy,
        programme.vaccination, programme.patient_on_art,
        surveillance.diagnosis_answer, surveillance.patient_diagnosis, surveillance.indicators, surveillance.weekly_indicators,
        immunisation.patient_immunization, immunisation.immunization_dose,
        st.exposed_infants, st.status_rows, st.statuses, status_history, current_status, patient_with_status,
        regimens, patient_summary, al.alert_facts, alert_inputs, alerts, first_alerts,
    )
}
# The tables a full run leaves behind, in the order in which it writes them.
TABLES = [n for n in BUILDERS if n != "alert_inputs"]


def needs(name: str) -> list[str]:
    """Tables a builder reads."""
    return [p for p in inspect.signature(BUILDERS[name]).parameters if p in BUILDERS]


def waves(names: list[str]) -> list[list[str]]:
    """The named tables and all they need, grouped so that each group needs only earlier groups."""
    depth: dict[str, int] = {}

    def visit(name: str) -> int:
        if name not in depth:
            depth[name] = 1 + max((visit(n) for n in needs(name)), default=-1)
        return depth[name]

    for name in names:
        visit(name)
    groups: dict[int, list[str]] = {}
    for name, d in depth.items():
        if name != "alert_inputs":
            groups.setdefault(d, []).append(name)
    return [groups[d] for d in sorted(groups)]


class Reports:
    """Builds report tables of one run over one record; tables that a table needs are written `at_once` side by side."""

    def __init__(self, rec: Record, as_of, warehouse: Warehouse | None = None, at_once: int = 3):
        self.rec = rec
        self.as_of = as_of
        self.at_once = at_once
        self.warehouse = warehouse or Warehouse(rec.spark)
        self._built: set[str] = set()
        self._before: dict[str, DataFrame | None] = {}

    def build(self, name: str, **options) -> DataFrame:
        """The table as a query over its inputs; the inputs themselves are written first.

        `options` are the keyword switches of the builder.
        """
        self._prepare(waves([name])[:-1], self.at_once)
        builder = BUILDERS[name]
        args = {}
        for p in inspect.signature(builder).parameters:
            if p in options:
                args[p] = options[p]
            elif p == "rec":
                args[p] = self.rec
            elif p == "as_of":
                args[p] = self.as_of
            elif p == "before":
                args[p] = self._earlier(name)
            elif p in BUILDERS:
                args[p] = self.table(p)
        return builder(**args)

    def _earlier(self, name: str) -> DataFrame | None:
        """The table as it was before this run."""
        if name not in self._before:
            self._before[name] = self.warehouse.read(name) if name in self.warehouse else None
        return self._before[name]

    def table(self, name: str):
        """The table, written to the warehouse on first use in this run; what an earlier run left is replaced or, by
        builders that take `before`, added to."""
        if name == "alert_inputs":
            return self.build(name)
        if name not in self._built:
            self.warehouse.write(name, self.build(name))
            self._built.add(name)
        return self.warehouse.read(name)

    def run(self, names: list[str] | None = None, at_once: int = 1) -> dict[str, DataFrame]:
        """Write the named tables (all by default) with what they need, and return them.

        `at_once` tables that do not depend on each other are written side by side, so that the last
        tasks of one do not leave executors idle.
        """
        names = names or TABLES
        self._prepare(waves(names), at_once)
        return {n: self.table(n) for n in names}

    def _prepare(self, groups: list[list[str]], at_once: int) -> None:
        """Write the tables that this run has not written yet, one group after the other."""
        for group in groups:
            missing = [n for n in group if n not in self._built]
            if missing:
                with ThreadPoolExecutor(at_once) as pool:
                    list(pool.map(self.table, missing))
