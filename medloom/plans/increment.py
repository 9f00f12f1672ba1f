"""The incremental run: the same reports over the observations entered today.

Each function is one named job of the run; it takes DataFrames and returns the new state of its table.
`Day` runs them in order. A run may be repeated: every job replaces or merges by key, so later edits of
today's rows win and nothing is counted twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import day, live, round_int
from medloom.operators.eav import Obs, collect_obs, sibling_groups
from medloom.operators.merge import update_from, upsert
from medloom.plans import laboratory as lab, pharmacy as ph, regimens as rg, shared, status as st
from medloom.plans.people import hiv_positive_forms
from medloom.sources.dimensions import dimension
from medloom.sources.record import Record, created_on
from medloom.sources.schemas import SOURCE_SCHEMAS

# What a later edit of an observation may change.
OBS_EDITS = ["obs_datetime", "obs_group_id", "value_datetime", "value_coded", "value_numeric", "value_text", "voided"]


def obs_of_day(obs: DataFrame, as_of) -> DataFrame:
    """Observations entered on the day."""
    return created_on(obs, as_of)


def buffer_obs(buffer: DataFrame | None, batch: DataFrame, as_of, sequence: str) -> DataFrame:
    """Merge a batch into the day's buffer by observation id; the later edit wins.

    Rows of other days leave the buffer. `sequence` orders several edits of one observation within the
    batch; equal ones are ordered by their values, so that the result does not depend on the order of
    arrival. It is dropped unless observations have that column.
    """
    today = obs_of_day(batch, as_of)
    kept = obs_of_day(buffer, as_of) if buffer is not None else None
    extra = () if f"{sequence} " in SOURCE_SCHEMAS["obs"] else (sequence,)
    return upsert(kept, today, ["obs_id"], OBS_EDITS, [sequence, *OBS_EDITS], drop=extra)


def high_water(obs: DataFrame) -> DataFrame:
    """Highest observation id of the run, for the audit trail."""
    return obs.agg(F.max("obs_id").alias("obs_id"))


def patients_of_day(rec: Record, patient: DataFrame, as_of) -> DataFrame:
    """Add or refresh patients registered today; those with a live HIV form become HIV positive."""
    names = rec.person_name.select(
        F.col("person_id").alias("patient_id"), "given_name", "family_name", "creator",
        F.col("date_created"), "voided",
    )
    fresh = (
        names.join(created_on(rec.patient, as_of).select("patient_id"), "patient_id", "left_semi")
        .join(rec.person.select(F.col("person_id").alias("patient_id"), "gender", "birthdate"), "patient_id")
        .withColumn("_entered", F.col("date_created"))
        .withColumn("date_created", day("date_created"))
        .withColumn("vih_status", F.lit(0))
    )
    changed = ["given_name", "family_name", "gender", "birthdate", "creator", "date_created", "voided"]
    merged = upsert(patient, fresh, ["patient_id"], changed, ["_entered", "given_name"], drop=("_entered",))
    positive = hiv_positive_forms(rec, rec.encounter).withColumn("_hiv", F.lit(True))
    today = F.col("date_created") == F.lit(as_of).cast("date")
    return (
        merged.join(positive, "patient_id", "left")
        .withColumn("vih_status", F.when(today & F.col("_hiv"), F.lit(1)).otherwise(F.col("vih_status")))
        .drop("_hiv")
    )


def _next_refill(obs: DataFrame) -> DataFrame:
    return collect_obs(
        obs, "encounter_id",
        {"next_dispensation_date": Obs((162549,), value=day("value_datetime"), pick="latest")},
    )


def drugs_of_day(rec: Record, obs: DataFrame) -> DataFrame:
    today = rec.replace(obs=obs)
    return shared.drug_order(today, shared.drug_group(today))


def dispensing_of_day(drugs: DataFrame, obs: DataFrame, encounter_context: DataFrame) -> DataFrame:
    """Drugs handed out today. Grain: encounter, location, drug."""
    out = (
        ph.handed_drugs(drugs)
        .join(_next_refill(obs), "encounter_id", "left")
        .join(shared.visit_of(encounter_context), "encounter_id", "left")
        .join(ph.rx_of_drug(drugs, "patient_id", "location_id"), ["encounter_id", "drug_id", "patient_id", "location_id"], "left")
    )
    return out.select(
        "patient_id", "encounter_id", "location_id", "visit_id", "visit_date", "drug_id",
        day("detail_time").alias("dispensation_date"), "next_dispensation_date", ph.is_arv().alias("arv_drug"),
        "rx_or_prophy", "voided",
    )


def prescription_of_day(drugs: DataFrame, encounter_context: DataFrame) -> DataFrame:
    """Drugs ordered or handed out today. Grain: encounter, location, drug."""
    out = (
        ph.ordered_drug(drugs)
        .join(shared.visit_of(encounter_context), "encounter_id", "left")
        .join(ph.rx_of_drug(drugs), ["encounter_id", "drug_id"], "left")
    )
    return out.select(
        "patient_id", "encounter_id", "location_id", "visit_id", "visit_date", "drug_id",
        F.col("detail_day").alias("dispensation_date"), ph.is_arv().alias("arv_drug"), "dispense", "rx_or_prophy",
        "voided",
    )


# What a test order fills in; an order already in the table keeps its other columns.
LAB_DAY = [
    "patient_id", "encounter_id", "test_id", "location_id", "visit_id", "visit_date", "test_done", "test_result",
    "date_test_done", "comment_test_done", "voided",
]


def laboratory_of_day(rec: Record, obs: DataFrame, laboratory: DataFrame, encounter_context: DataFrame) -> DataFrame:
    """Merge today's test orders, then today's results, into the laboratory table.

    A result of zero or an empty text counts as no value, and still marks the test as done.
    """
    today = rec.replace(obs=obs)
    visits = encounter_context.filter(F.col("in_visit") & live("visit_voided")).select(
        "encounter_id", "visit_id", "visit_date"
    )
    orders = lab.laboratory_order(today, encounter_context, with_cd4=False).join(visits, "encounter_id", "left")
    orders = orders.withColumns(
        {
            "test_done": F.lit(0), "test_result": F.lit(None).cast("string"),
            "date_test_done": F.lit(None).cast("date"), "comment_test_done": F.lit(None).cast("string"),
        }
    ).select(*LAB_DAY)
    merged = upsert(laboratory, orders, lab.KEY, ["voided"], ["voided", "location_id", "visit_id"])
    results = lab.laboratory_results(today, merged, skip_zero=True)
    return update_from(
        merged, results, ["encounter_id", "test_id"],
        {c: c for c in ("test_done", "test_result", "date_test_done", "comment_test_done")}, order_by="test_done",
    )


def virology_of_day(rec: Record, obs: DataFrame, tests: DataFrame, encounter_context: DataFrame, as_of) -> DataFrame:
    """Merge today's PCR tests, then today's answers of any known test, into the table."""
    today = rec.replace(obs=obs)
    found = lab.virological_tests(today, encounter_context, as_of)
    keys = ["encounter_id", "location_id", "obs_group_id", "test_id"]
    merged = upsert(tests, found, keys, ["voided"], ["voided", "patient_id"])
    answers = sibling_groups(
        obs, None,
        {
            "test_result": Obs((1030,), value="value_coded", pick="latest", at=True),
            "age": Obs((lab.AGE,), value="value_numeric", pick="latest", at=True),
            "age_unit": Obs((lab.AGE_UNIT,), value="value_coded", pick="latest", at=True),
        },
    ).select(
        F.col("group_id").alias("obs_group_id"),
        *[F.col(c).alias(f"_{c}") for c in ("test_result", "age", "age_unit")],
        *[f"{c}_at" for c in ("test_result", "age", "age_unit")],
    )
    out = merged.join(answers, "obs_group_id", "left").withColumns(
        {
            c: F.when(F.col(f"{c}_at").isNotNull(), round_int("_age") if c == "age" else F.col(f"_{c}")).otherwise(F.col(c))
            for c in ("test_result", "age", "age_unit")
        }
    )
    born = lab.births(rec)
    dated = F.when(F.col("_known"), lab.test_date(as_of)).otherwise(F.col("test_date"))
    return out.join(born, "patient_id", "left").withColumn("test_date", dated).select(*tests.columns)


def infants_of_day(rec, encounter_context, patient, dispensing, laboratory, as_of) -> DataFrame:
    return st.exposed_infants(rec, encounter_context, patient, dispensing, laboratory, as_of, incremental=True)


def status_rows_of_day(
    rec: Record, obs: DataFrame, encounter_context: DataFrame, patient: DataFrame, dispensing_today: DataFrame,
    on_arv: DataFrame, reasons: DataFrame, infants: DataFrame, as_of,
) -> DataFrame:
    """Statuses seen from today's dispensations and discontinuation forms."""
    return st.status_rows(
        rec, encounter_context, patient, dispensing_today, on_arv, reasons, infants, as_of,
        require_on_arv=False, require_not_voided=False, any_state=True, new_obs=obs,
    )


def regimens_of_day(prescription_today: DataFrame, patient: DataFrame, history: DataFrame | None) -> DataFrame:
    """Merge today's regimens into the regimen table."""
    spark = prescription_today.sparkSession
    fresh = rg.regimens(prescription_today, patient, dimension(spark, "regimen"))
    if history is None:
        return fresh
    return upsert(
        history, fresh, ["location_id", "patient_id", "visit_date", "regimen"], ["rx_or_prophy"], "rx_or_prophy"
    )


@dataclass
class Day:
    """One incremental run over a state of report tables.

    `STATE` names the tables kept between runs. `write(name, df)` stores a table and returns it read back; `read(name)`
    returns a stored one. `run` makes every table; after `start`, `table` makes single ones with what they need.
    """

    rec: Record
    as_of: object
    read: object
    write: object
    done: list[str] = field(default_factory=list)

    def start(self, obs: DataFrame) -> "Day":
        """A run over the observations entered on the day; no table is made yet."""
        self._obs, self._made = obs, {}
        return self

    def run(self, obs: DataFrame, names: list[str] | None = None) -> DataFrame:
        """Make the named tables, all by default, and what they need, in order; returns the last one."""
        self.start(obs)
        return [self.table(n) for n in names or TABLES][-1]

    def table(self, name: str) -> DataFrame:
        """The table after the run, written on first use."""
        if name not in self._made:
            made = JOBS[name](self, *[self.table(n) for n in NEEDS[name]], *[self.read(n) for n in STATE[name]])
            self.done.append(name)
            self._made[name] = self.write(name, made)
        return self._made[name]


#: The jobs of a run, in order; each takes the run, the tables it needs and those of the state that it reads.
JOBS = {
    "obs_of_day": lambda run: run._obs,
    "high_water": lambda run, obs: high_water(obs),
    "encounter_context": lambda run: shared.encounter_context(run.rec),
    "patient": lambda run, patient: patients_of_day(run.rec, patient, run.as_of),
    "drugs_of_day": lambda run, obs: drugs_of_day(run.rec, obs),
    "dispensing_of_day": lambda run, drugs, obs, context: dispensing_of_day(drugs, obs, context),
    "prescription_of_day": lambda run, drugs, context: prescription_of_day(drugs, context),
    "patient_laboratory": lambda run, obs, context, tests: laboratory_of_day(run.rec, obs, tests, context),
    "virological_tests": lambda run, obs, context, tests: virology_of_day(run.rec, obs, tests, context, run.as_of),
    "infants_of_day": lambda run, context, patient, tests, dispensing: infants_of_day(run.rec, context, patient, dispensing, tests, run.as_of),
    "status_rows_of_day": lambda run, obs, context, patient, dispensing, infants, on_arv, reasons: status_rows_of_day(
        run.rec, obs, context, patient, dispensing, on_arv, reasons, infants, run.as_of
    ),
    "statuses_of_day": lambda run, rows, reasons: st.statuses(rows, reasons, run.as_of),
    "status_history": lambda run, fresh, history: st.merge_day_status(history, fresh),
    "current_status": lambda run, history: st.current_status(history),
    "patient_with_status": lambda run, patient, current: st.with_status(patient, current),
    "regimens": lambda run, prescription, patient, regimens: regimens_of_day(prescription, patient, regimens),
    "patient_summary": lambda run, patient, current, regimens: rg.patient_summary(
        patient, current, regimens, dimension(run.rec.spark, "arv_status")
    ),
}
TABLES = list(JOBS)
#: Tables of the run that a job reads.
NEEDS = {n: [] for n in TABLES} | {
    "high_water": ["obs_of_day"],
    "drugs_of_day": ["obs_of_day"],
    "dispensing_of_day": ["drugs_of_day", "obs_of_day", "encounter_context"],
    "prescription_of_day": ["drugs_of_day", "encounter_context"],
    "patient_laboratory": ["obs_of_day", "encounter_context"],
    "virological_tests": ["obs_of_day", "encounter_context"],
    "infants_of_day": ["encounter_context", "patient", "patient_laboratory"],
    "status_rows_of_day": ["obs_of_day", "encounter_context", "patient", "dispensing_of_day", "infants_of_day"],
    "statuses_of_day": ["status_rows_of_day"],
    "status_history": ["statuses_of_day"],
    "current_status": ["status_history"],
    "patient_with_status": ["patient", "current_status"],
    "regimens": ["prescription_of_day", "patient"],
    "patient_summary": ["patient", "current_status", "regimens"],
}
#: Tables kept between runs that a job reads, as the run before left them.
STATE = {n: [] for n in TABLES} | {
    "patient": ["patient"],
    "patient_laboratory": ["patient_laboratory"],
    "virological_tests": ["virological_tests"],
    "infants_of_day": ["patient_dispensing"],
    "status_rows_of_day": ["patient_on_arv", "discontinuation_reason"],
    "statuses_of_day": ["discontinuation_reason"],
    "status_history": ["status_history"],
    "regimens": ["regimens"],
}


def state_of(names: list[str]) -> list[str]:
    """The tables kept between runs that the named ones are made from."""
    found: list[str] = []
    for name in names:
        found += [*state_of(NEEDS[name]), *STATE[name]]
    return list(dict.fromkeys(found))
