"""The incremental run whose work follows the change, not the record.

`DayTables` keeps the record and the report tables dealt out by ranges of patients. A run first derives from
the new observations, and from the days that have passed, which patients a rule can judge differently than
at the run before; it then reads the ranges of those patients alone, recomputes their rows with the rules
of `increment` and `status`, and replaces them. The rows of all other patients are kept as they are.

Who is affected, besides the patients of new observations and those registered on the day:

* infants: who has come to 18 months of age since, from when a positive test counts as an infection;
* statuses before treatment: who has a visit that has come to lie 13 months back since;
* virology: whose test, dated by the age given, has come to lie in the past since.

Of the observations only those are kept whose concept a rule asks for again after their day.

An encounter belongs to one patient, and so do its observations and its visit. Corrections that leave no new
observation (a voided visit, say) are given to `run` as `also`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import add_days, add_months
from medloom.operators.merge import delete_matching, keep_matching
from medloom.plans import increment as inc, regimens as rg, shared, status as st
from medloom.sources.dimensions import dimension
from medloom.sources.keyed import KeyedTable
from medloom.sources.record import Record, created_on
from medloom.sources.warehouse import STORED, count_rows_larger

#: Patients in a range, where the caller knows no better; `width_for` follows the number of patients.
WIDTH = 1000
#: Ranges into which few patients are dealt out, and the most patients in a range: some ten million observations.
RANGES, MOST = 24, 30_000
#: The record's large tables and the report tables a run starts from, with the patient they are dealt out by.
RECORD = {"obs": "person_id", "encounter": "patient_id", "visit": "patient_id", "person": "person_id", "person_name": "person_id", "patient": "patient_id"}
REPORTS = [
    "patient", "patient_laboratory", "virological_tests", "patient_dispensing", "patient_on_arv", "discontinuation_reason", "regimens",
]
#: Kept besides: infants and the statuses that hold without a new dispensation, with their reasons.
KEPT = ["infants", "standing", "current_status", "patient_summary"]
#: What a run brings up to date, in order, with what of it each needs, ...
NEEDS = {
    "patient": [], "patient_laboratory": [], "virological_tests": [], "infants": ["patient", "patient_laboratory"], "standing": ["patient"],
    "statuses": ["standing", "infants"], "status_history": ["statuses"], "current_status": ["status_history"], "regimens": ["patient"],
    "patient_summary": ["patient", "current_status", "regimens"],
}
#: ... the report tables that it reads as they are, and the tables of the record.
READS = {"infants": ["patient_dispensing"], "standing": ["patient_on_arv", "discontinuation_reason"], "statuses": ["patient_on_arv", "discontinuation_reason"]}
SOURCES = {
    "patient": ["encounter", "person", "person_name", "patient"], "patient_laboratory": ["encounter", "visit"],
    "virological_tests": ["encounter", "visit", "person", "patient"], "infants": ["obs", "encounter", "visit", "person"],
    "standing": ["obs", "encounter", "visit"], "statuses": ["encounter", "visit"], "regimens": ["encounter", "visit"],
}
#: What these read of the observations that are kept; the others read those of the day alone. An edit never changes a concept.
CONCEPTS = {"infants": st.INFANT_CONCEPTS, "standing": (st.STOP_REASON,)}


def led_by(names: list[str]) -> list[str]:
    """The named tables and what a run needs for them, in the order of the run."""
    found = set(names).union(*(led_by(NEEDS[n]) for n in names))
    return [n for n in NEEDS if n in found]


def read_by(names: list[str]) -> list[str]:
    """The report tables from which `DayTables` that keep the named tables start, without the history."""
    run = led_by(names)
    return [t for t in REPORTS if t in run or any(t in READS.get(n, ()) for n in run)]


def width_for(patients: DataFrame, key: str = "patient_id") -> int:
    """Patients in a range, so that there are neither many small ranges nor large ones."""
    low, high = patients.agg(F.min(key), F.max(key)).first()
    return max(1, min(MOST, -(-((high or 0) - (low or 0) + 1) // RANGES)))


def _at_once(steps: dict[str, Callable[[], DataFrame | None]]) -> dict[str, DataFrame | None]:
    """Take steps that do not depend on each other three side by side."""
    with ThreadPoolExecutor(3) as pool:
        taken = {name: pool.submit(step) for name, step in steps.items()}
        return {name: step.result() for name, step in taken.items()}


def _date(day_) -> dt.date:
    return day_ if isinstance(day_, dt.date) else dt.date.fromisoformat(str(day_))


class DayTables:
    """Record and report tables under one root, by ranges of `width` patients; `rec` gives the small tables and the codes.

    `names` are the tables a run has to bring up to date (of `NEEDS`), all by default; only what they need is kept.
    """

    def __init__(self, rec: Record, root: str, width: int = WIDTH, names: list[str] | None = None):
        self.rec, self.root, self.spark = rec, root, rec.spark
        count_rows_larger(rec.spark)
        self.made = led_by(list(NEEDS) if names is None else names)
        keyed = lambda name, by: KeyedTable(rec.spark, f"{root}/{name}", by, width)
        self.source = {t: keyed(f"source_{t}", by) for t, by in RECORD.items() if any(t in SOURCES.get(n, ()) for n in self.made)}
        self.concepts = sorted({c for n in self.made for c in CONCEPTS.get(n, ())})
        self.reports = read_by(self.made)
        self.table = {t: keyed(t, "patient_id") for t in [*REPORTS, *KEPT] if t in self.reports or t in self.made}
        self.history = KeyedTable(rec.spark, f"{root}/status_history", "unix_date(date_started_status)")
        self._by_patient = keyed("patient", "patient_id")

    # ------------------------------------------------------------------------------------------ first state
    def start(
        self, reports: dict[str, DataFrame], history: DataFrame | None, as_of, infants: DataFrame | None = None, standing: DataFrame | None = None
    ) -> None:
        """Keep the record and the report tables of a full run on `as_of`; infants and standing statuses are computed unless given."""
        rec, made = self.rec, self.made
        first = [(table, self._asked(rec.obs) if t == "obs" else getattr(rec, t)) for t, table in self.source.items()] + [(self.table[t], reports[t]) for t in self.reports]
        with ThreadPoolExecutor(3) as pool:
            list(pool.map(lambda pair: pair[0].create(pair[1]), first))
        if ("infants" in made and infants is None) or ("standing" in made and standing is None):
            context = self._store("context", shared.encounter_context(rec))
        steps = {}
        if "infants" in made:
            if infants is None:
                infants = inc.infants_of_day(rec, context, self.table["patient"].read(), reports["patient_dispensing"], reports["patient_laboratory"], as_of)
            steps["infants"] = lambda: self.table["infants"].create(infants)
        if "standing" in made:
            if standing is None:
                standing = self.standing(rec, context, self.table["patient"].read(), reports["patient_on_arv"], reports["discontinuation_reason"], as_of)
            steps["standing"] = lambda: self.table["standing"].create(standing)
        if "status_history" in made:
            steps["status_history"] = lambda: self.history.create(history)
        if "current_status" in made:
            steps["current_status"] = lambda: self.table["current_status"].create(st.current_status(history))
        _at_once(steps)
        if "patient_summary" in made:
            self.table["patient_summary"].create(
                rg.patient_summary(self.table["patient"].read(), st.current_status(history), reports["regimens"], dimension(self.spark, "arv_status"))
            )
        self._stand_at(as_of)

    def _asked(self, obs: DataFrame) -> DataFrame:
        """The observations that a rule of the tables made reads."""
        return obs.filter(F.col("concept_id").isin(self.concepts))

    def add(self, obs: DataFrame) -> list[int]:
        """New and edited observations that a rule reads into the record; returns the ranges rewritten."""
        return self.source["obs"].upsert(self._asked(obs), ["person_id", "obs_id"], inc.OBS_EDITS, "obs_id")

    def day(self) -> dt.date:
        """The day that the tables stand at."""
        return self.spark.read.schema("day date").parquet(f"{self.root}/day").first()["day"]

    def _stand_at(self, as_of) -> None:
        self.spark.createDataFrame([(_date(as_of),)], "day date").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.root}/day")

    # -------------------------------------------------------------------------------------------- one run
    def _store(self, name: str, df: DataFrame) -> DataFrame:
        """Write a frame that several steps read, and read it back."""
        path = f"{self.root}/run/{name}-{uuid.uuid4().hex}"
        df.write.options(**STORED).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def affected(self, obs: DataFrame, before, as_of) -> DataFrame:
        """Patients whose rows the run recomputes: (patient_id), distinct."""
        since, today = F.lit(before).cast("date"), F.lit(as_of).cast("date")

        def between(column: str, months: int, kind: str):
            """A range on the column as it is, so that it prunes the scan; a day wider on both sides than the rule needs."""
            first, last = F.date_sub(F.add_months(since, -months), 2), F.date_add(F.add_months(today, -months), 2)
            return (F.col(column) >= first.cast(kind)) & (F.col(column) < last.cast(kind))

        parts = [obs.select(F.col("person_id").alias("patient_id")), created_on(self.rec.patient, as_of).select("patient_id")]
        if "person" in self.source:
            person = self.source["person"].read().select(F.col("person_id").alias("patient_id"), "birthdate")
        if "infants" in self.made:
            parts.append(person.filter(between("birthdate", 18, "date")).select("patient_id"))
        if "standing" in self.made:
            parts.append(self.source["visit"].read().filter(between("date_started", 13, "timestamp_ntz")).select("patient_id"))
        if "virological_tests" in self.made:
            aged = self.table["virological_tests"].read().filter(F.col("age").isNotNull()).join(person, "patient_id")
            moved = reduce(lambda a, b: a | b, [(d >= since) & (d < today) for d in (add_days("birthdate", "age"), add_months("birthdate", "age"))])
            parts.append(aged.filter(moved).select("patient_id"))
        return reduce(DataFrame.unionByName, parts).filter("patient_id IS NOT NULL").distinct()

    def _record_of(self, patients: DataFrame, parts: list[int]) -> Record:
        """The record of some patients: their ranges are read, and of these their rows."""
        def rows(t: str, by: str) -> DataFrame:
            of = self.source[t].read(parts)
            return of.join(patients.select(F.col("patient_id").alias(by)), by, "left_semi").select(*of.columns)

        return self.rec.replace(**{t: rows(t, by) for t, by in RECORD.items() if t in self.source})

    def _of(self, name: str, patients: DataFrame, parts: list[int]) -> DataFrame:
        rows = self.table[name].read(parts)
        return keep_matching(rows, patients, ["patient_id"]).select(*rows.columns)

    def standing(self, rec: Record, context: DataFrame, patient: DataFrame, on_arv: DataFrame, reasons: DataFrame, as_of) -> DataFrame:
        """Statuses that hold from the forms of a patient's latest visit, with the reason for leaving care."""
        rows = st.left_before_treatment(rec, context, patient, on_arv, any_state=True).select(*st.OUT).unionByName(
            st.before_treatment(rec, context, patient, on_arv, reasons, as_of, any_state=True).select(*st.OUT)
        )
        return st.attach_reason(self._store("standing", rows), reasons).select(*st.OUT, "dis_reason")

    def run(self, obs: DataFrame, as_of, also: DataFrame | None = None) -> DataFrame:
        """Bring every table to `as_of`; `obs` are the observations entered on the day. Returns the affected patients.

        A day may be run again, with more observations: its rows are replaced."""
        before, as_of, made = self.day(), _date(as_of), self.made
        obs = self._store("obs", obs)
        if "obs" in self.source:
            self.add(obs)
        found = self.affected(obs, before, as_of)
        who = self._store("affected", found if also is None else found.unionByName(also.select("patient_id")).distinct())
        parts = self._by_patient.touched(who)
        rec = self._record_of(who, parts)
        own = {t: self._of(t, who, parts) for t in self.reports}
        reasons, on_arv = own.get("discontinuation_reason"), own.get("patient_on_arv")
        if "visit" in self.source:
            context = self._store("context", shared.encounter_context(rec))
        steps = {}
        if "patient" in made:
            steps["patient"] = lambda: self._put("patient", who, inc.patients_of_day(rec, own["patient"], as_of))
        if "statuses" in made or "regimens" in made:
            steps["drugs"] = lambda: self._store("drugs", inc.drugs_of_day(rec, obs))
        if "patient_laboratory" in made:
            steps["tests"] = lambda: self._put("patient_laboratory", who, inc.laboratory_of_day(rec, obs, own["patient_laboratory"], context))
        if "virological_tests" in made:
            steps["virological_tests"] = lambda: self._put("virological_tests", who, inc.virology_of_day(rec, obs, own["virological_tests"], context, as_of))
        new, steps = _at_once(steps), {}
        patient, drugs, tests = (new.get(t) for t in ("patient", "drugs", "tests"))
        if "infants" in made:
            steps["infants"] = lambda: self._put("infants", who, inc.infants_of_day(rec, context, patient, own["patient_dispensing"], tests, as_of))
        if "standing" in made:
            steps["standing"] = lambda: self._put("standing", who, self.standing(rec, context, patient, on_arv, reasons, as_of))
        if "statuses" in made:
            steps["dispensing"] = lambda: self._store("dispensing", inc.dispensing_of_day(drugs, obs, context))
        new = _at_once(steps)
        if "statuses" in made:
            # Statuses that only a dispensation or a discontinuation form of the day gives.
            dispensing = new["dispensing"]
            moving = st.refill(rec, context, patient, dispensing, on_arv, reasons, as_of, False, False, True).select(*st.OUT).unionByName(
                st.left_on_treatment(rec.replace(obs=obs), context, on_arv).select(*st.OUT)
            )
            moving = st.attach_reason(self._store("moving", moving), reasons).select(*st.OUT, "dis_reason")
            fresh = delete_matching(self.table["standing"].read().unionByName(moving), self.table["infants"].read(), ["patient_id"])
            self.statuses = self._store("statuses", fresh.withColumn("date_started_status", F.lit(as_of).cast("date")))
        if "status_history" in made:
            # Only the rows of the day change in the history.
            today = (as_of - dt.date(1970, 1, 1)).days
            history, fresh = self.history.read([today]), self.statuses
            self.history.replace(fresh.select("date_started_status").limit(1), st.merge_day_status(history, fresh.select(*history.columns)), ["date_started_status"])
        if "current_status" in made:
            now = st.current_status(self.history.read([today]))
            changed = self._store("changed", now.join(self.table["current_status"].read(), ["patient_id", "arv_status"], "left_anti"))
            self.table["current_status"].upsert(changed, ["patient_id"], ["arv_status"], "arv_status")
        if "regimens" in made:
            prescription = self._store("prescription", inc.prescription_of_day(drugs, context))
            self._put("regimens", who, inc.regimens_of_day(prescription, patient, own["regimens"]))
        if "patient_summary" in made:
            # The summary of whoever is affected or has another status now.
            again = self._store("again", who.unionByName(changed.select("patient_id")).distinct())
            ranges = self._by_patient.touched(again)
            of = lambda t: self._of(t, again, ranges)
            self._put("patient_summary", again, rg.patient_summary(of("patient"), of("current_status"), of("regimens"), dimension(self.spark, "arv_status")))
        self._stand_at(as_of)
        return who

    def _put(self, name: str, patients: DataFrame, rows: DataFrame) -> DataFrame:
        """Replace the patients' rows of a table; returns the new ones."""
        rows = self._store(name, rows)
        self.table[name].replace(patients, rows, ["patient_id"])
        return rows
