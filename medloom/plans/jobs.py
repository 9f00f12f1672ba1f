"""Named jobs: what a scheduler calls, one function per job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from medloom.plans import increment, status, surveillance
from medloom.plans.reports import TABLES, Reports
from medloom.sources.record import Record, created_on
from medloom.sources.warehouse import Warehouse


def full_load(rec: Record, as_of, warehouse: Warehouse, at_once: int = 4) -> dict[str, DataFrame]:
    """Every report table from the whole record, in dependency order, `at_once` side by side, histories included."""
    return Reports(rec, as_of, warehouse).run(at_once=at_once)


def status_history(rec: Record, as_of, warehouse: Warehouse) -> DataFrame:
    """Statuses of the day merged into those of earlier runs."""
    return Reports(rec, as_of, warehouse).table("status_history")


def legacy_import(history: DataFrame, legacy: DataFrame, patient: DataFrame, since="2019-09-01") -> DataFrame:
    """Statuses of the older system added to the history."""
    return status.import_legacy(history, legacy, patient, since)


def daily_run(rec: Record, as_of, warehouse: Warehouse) -> DataFrame:
    """One incremental run over the observations entered on the day."""
    return increment.Day(rec, as_of, warehouse.read, warehouse.write).run(created_on(rec.obs, as_of))


def diagnosis(rec: Record, as_of, warehouse: Warehouse) -> DataFrame:
    return Reports(rec, as_of, warehouse).table("patient_diagnosis")


def report_indicators(rec: Record, as_of, warehouse: Warehouse) -> DataFrame:
    """Diagnoses, then indicators."""
    reports = Reports(rec, as_of, warehouse)
    return surveillance.indicators(rec, reports.table("patient_diagnosis"), reports.table("patient"))


JOBS: dict[str, Callable] = {
    "full_load": full_load,
    "daily_run": daily_run,
    "obs_of_day": increment.obs_of_day,
    "patients_of_day": increment.patients_of_day,
    "dispensing_of_day": increment.dispensing_of_day,
    "prescription_of_day": increment.prescription_of_day,
    "laboratory_of_day": increment.laboratory_of_day,
    "virology_of_day": increment.virology_of_day,
    "status_rows_of_day": increment.status_rows_of_day,
    "regimens_of_day": increment.regimens_of_day,
    "diagnosis": diagnosis,
    "report_indicators": report_indicators,
    "status_history": status_history,
    "legacy_import": legacy_import,
}

__all__ = ["JOBS", "TABLES", *JOBS]
