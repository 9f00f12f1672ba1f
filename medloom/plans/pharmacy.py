"""Pharmacy marts: patient_dispensing, patient_prescription, patient_on_arv."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import NO, YES, day, labels, live, not_voided, round_int
from medloom.operators.eav import Obs, collect_obs
from medloom.operators.merge import keep_matching
from medloom.operators.pick import first_and_last
from medloom.plans.shared import DISPENSED, PRESCRIBED, TREATMENT, provider, visit_of
from medloom.sources.dimensions import ARV_DRUG_IDS
from medloom.sources.record import Record

COMMUNITY = 1755
REGIMEN_LINE = 164432
KEY = ["encounter_id", "location_id", "drug_id"]


def is_arv(drug: str = "drug_id") -> Column:
    return F.when(F.col(drug).isin(ARV_DRUG_IDS), F.lit(YES)).otherwise(F.lit(NO))


def _encounter_facts(rec: Record) -> DataFrame:
    return collect_obs(
        rec.obs, "encounter_id",
        {
            "next_dispensation_date": Obs((162549,), value=day("value_datetime"), pick="latest"),
            "community": Obs((COMMUNITY,), (YES,)),
            "ddp": Obs(rec.codes.concept("ddp"), (YES,), value=F.lit(YES)),
        },
    )


def _dispensed_amounts(drug_group: DataFrame) -> DataFrame:
    """Days and pills of the encounter's dispensing groups; the latest entry stands for all its drugs."""
    return (
        drug_group.filter(F.col("header_concept") == DISPENSED)
        .groupBy(F.col("header_encounter").alias("encounter_id"))
        .agg(F.max_by("days", "days_at").alias("_days"), F.max_by("pills", "pills_at").alias("_pills"))
    )


def _per_drug(value: str, headers: list[int] | None, name: str) -> Column:
    """Latest group detail of the drug's groups in the encounter, as an aggregate expression."""
    place = F.col(f"{value}_at")
    if headers is not None:
        place = F.when(F.col("header_concept").isin(headers), place)
    return F.max_by(value, place).alias(name)


def regimen_line(rec: Record) -> DataFrame:
    """First, second or third line named in an encounter, by encounter and patient."""
    first, second, third = (rec.codes.concept(f"{n}_line") for n in ("first", "second", "third"))
    names = {i: n for ids, n in ((first, "FIRST_LINE"), (second, "SECOND_LINE"), (third, "THIRD_LINE")) for i in ids}
    if not names:
        return rec.obs.limit(0).select(
            "encounter_id", F.col("person_id").alias("patient_id"), F.lit(None).cast("string").alias("treatment_regime_lines")
        )
    rows = collect_obs(
        rec.obs, ["encounter_id", "person_id"],
        {"line": Obs((REGIMEN_LINE,), tuple(names), value="value_coded", pick="latest", any_voided=True)},
    )
    return rows.select(
        "encounter_id", F.col("person_id").alias("patient_id"), labels("line", names).alias("treatment_regime_lines")
    )


def doubtful_group(ordered_drug: DataFrame) -> DataFrame:
    """Groups of ordered drugs of which fewer than two live observations are known: the drugs themselves and the
    details of the encounter. All others keep their drugs, whatever else they hold."""
    alive = F.when(live(), 1).otherwise(0)
    known = F.greatest(F.sum(alive), F.max(alive + F.coalesce("live_details", F.lit(0))))
    return ordered_drug.groupBy("obs_group_id").agg(known.alias("_known")).filter("_known < 2").select("obs_group_id")


def removed_group(rec: Record, ordered_drug: DataFrame, doubtful_group: DataFrame) -> DataFrame:
    """Groups of ordered drugs that have at most one live observation left: the drug was removed."""
    keys = ["encounter_id", "obs_group_id"]
    orders = ordered_drug.join(doubtful_group, "obs_group_id", "left_semi").groupBy(*keys).agg(F.count("*").alias("_orders"))
    # Only the few doubtful groups are looked up among all observations; stored, they are broadcast while they are small.
    members = (
        rec.obs.filter(live() & F.col("obs_group_id").isNotNull())
        .select(*keys)
        .join(doubtful_group, "obs_group_id", "left_semi")
        .groupBy(*keys)
        .agg(F.count("*").alias("_members"))
    )
    return (
        orders.join(members, keys)
        .groupBy("obs_group_id")
        .agg(F.sum(F.col("_orders") * F.col("_members")).alias("n"))
        .filter("n <= 1")
        .select("obs_group_id")
    )


def _void_removed(df: DataFrame, removed: DataFrame) -> DataFrame:
    hit = df.join(removed.withColumn("_removed", F.lit(True)), "obs_group_id", "left")
    return hit.withColumn(
        "voided", F.when(F.col("_removed") & not_voided(), F.lit(1)).otherwise(F.col("voided"))
    ).drop("_removed")


def ordered_drug(drug_order: DataFrame) -> DataFrame:
    """Drugs named in an order or dispensing group, one row per encounter, location and drug.

    Order rows are entered first and dispensing rows after them; the last entry of a key wins.
    """
    ordered = F.col("header_concept").isNotNull() & F.col("in_group") & F.col("has_order_detail").isNotNull()
    handed = (F.col("header_concept") == DISPENSED) & F.col("in_group") & F.col("has_detail").isNotNull()
    by_order, by_hand = F.when(ordered, F.col("obs_id")), F.when(handed, F.col("obs_id"))

    def last(c: str) -> Column:
        return F.when(F.max(by_hand).isNotNull(), F.max_by(c, by_hand)).otherwise(F.max_by(c, by_order)).alias(c)

    kind = F.when(F.col("header_concept") == DISPENSED, F.lit(YES)).otherwise(F.lit(NO))
    here = (F.col("first_detail_encounter") == F.col("encounter_id")) & (F.col("last_detail_encounter") == F.col("encounter_id"))
    drug_order = drug_order.withColumn("live_details", F.when(here, F.col("live_details")))
    return drug_order.filter(ordered).groupBy(*KEY).agg(
        F.min_by("person_id", "obs_id").alias("patient_id"),
        F.coalesce(F.max(by_hand), F.max(by_order)).alias("obs_id"),
        last("obs_group_id"),
        last("voided"),
        last("live_details"),
        F.when(F.max(by_hand).isNotNull(), F.lit(YES)).otherwise(F.min_by(kind, by_order)).alias("dispense"),
        F.max_by(day("detail_time"), by_hand).alias("detail_day"),
    )


def handed_drugs(drug_order: DataFrame) -> DataFrame:
    """Drugs named in a dispensing group, one row per encounter, location and drug."""
    handed = drug_order.filter(
        (F.col("header_concept") == DISPENSED) & F.col("in_group") & F.col("has_detail").isNotNull()
    )
    return first_and_last(
        handed.withColumn("order_id", F.col("obs_id")).withColumnRenamed("person_id", "patient_id"),
        KEY, ["patient_id"], ["obs_id", "obs_group_id", "detail_time", "voided"], "order_id",
    )


def rx_of_drug(drug_order: DataFrame, *more: str) -> DataFrame:
    """Treatment or prophylaxis, from the order groups that name the drug in the encounter."""
    keys = ["encounter_id", "drug_id", *more]
    return drug_order.withColumn("patient_id", F.col("person_id")).groupBy(*keys).agg(
        _per_drug("rx", [PRESCRIBED], "rx_or_prophy")
    )


def patient_prescription(
    rec: Record, encounter_context: DataFrame, drug_group: DataFrame, drug_order: DataFrame,
    ordered_drug: DataFrame, removed_group: DataFrame,
) -> DataFrame:
    """Drugs ordered or handed out. Grain: encounter, location, drug."""
    details = drug_order.groupBy("encounter_id", "drug_id").agg(
        _per_drug("rx", [PRESCRIBED], "rx_or_prophy"),
        _per_drug("posology", [PRESCRIBED], "posology"),
        _per_drug("posology_alt", [PRESCRIBED], "posology_alt"),
        _per_drug("posology", [DISPENSED], "posology_alt_disp"),
        _per_drug("days", [PRESCRIBED, DISPENSED], "number_day"),
        _per_drug("handed_time", [DISPENSED], "_handed"),
    )
    out = (
        ordered_drug.join(details, ["encounter_id", "drug_id"], "left")
        .join(_encounter_facts(rec), "encounter_id", "left")
        .join(_dispensed_amounts(drug_group), "encounter_id", "left")
        .join(provider(rec, live_only=False), "encounter_id", "left")
        .join(visit_of(encounter_context), "encounter_id", "left")
    )
    out = out.withColumns(
        {
            "arv_drug": is_arv(),
            "dispensation_date": F.coalesce(day("_handed"), F.col("detail_day")),
            "dispensation_location": F.when(F.col("community") == 1, F.lit(COMMUNITY)).otherwise(F.lit(0)),
            "number_day_dispense": round_int("_days"),
            "pills_amount_dispense": F.col("_pills"),
        }
    )
    return _void_removed(out, removed_group).select(
        "patient_id", "encounter_id", "location_id", "visit_id", "visit_date", "obs_id", "obs_group_id",
        "provider_id", "drug_id", "dispensation_date", "next_dispensation_date", "dispensation_location",
        "arv_drug", "dispense", "rx_or_prophy", "posology", "posology_alt", "posology_alt_disp", "number_day",
        "number_day_dispense", "pills_amount_dispense", "voided",
    )


def patient_dispensing(
    rec: Record,
    encounter_context: DataFrame,
    drug_group: DataFrame,
    drug_order: DataFrame,
    removed_group: DataFrame,
) -> DataFrame:
    """Drugs handed out. Grain: encounter, location, drug."""
    spine = handed_drugs(drug_order)
    dates = drug_order.groupBy("encounter_id", "drug_id").agg(
        _per_drug("handed_time", None, "_handed")
    )
    rx = rx_of_drug(drug_order, "patient_id", "location_id")
    out = (
        spine.join(dates, ["encounter_id", "drug_id"], "left")
        .join(rx, ["encounter_id", "drug_id", "patient_id", "location_id"], "left")
        .join(_encounter_facts(rec), "encounter_id", "left")
        .join(_dispensed_amounts(drug_group), "encounter_id", "left")
        .join(provider(rec), "encounter_id", "left")
        .join(visit_of(encounter_context), "encounter_id", "left")
        .join(regimen_line(rec), ["encounter_id", "patient_id"], "left")
    )
    out = out.withColumns(
        {
            "arv_drug": is_arv(),
            "dispensation_date": F.coalesce(day("_handed"), day("detail_time")),
            "dispensation_location": F.when(F.col("community") == 1, F.lit(COMMUNITY)).otherwise(F.lit(0)),
            "dose_day": round_int("_days"),
            "pills_amount": F.col("_pills"),
        }
    ).withColumn("treatment_regime_lines", F.when(F.col("arv_drug") == YES, F.col("treatment_regime_lines")))
    return _void_removed(out, removed_group).select(
        "patient_id", "encounter_id", "location_id", "visit_id", "visit_date", "obs_id", "obs_group_id",
        "provider_id", "drug_id", "dose_day", "pills_amount", "dispensation_date", "next_dispensation_date",
        "dispensation_location", "arv_drug", "ddp", "rx_or_prophy", "treatment_regime_lines", "voided",
    )


def on_treatment(rx: str = "rx_or_prophy") -> Column:
    """Dispensed as treatment, or without saying."""
    return (F.col(rx) == TREATMENT) | F.col(rx).isNull()


def patient_on_arv(patient_dispensing: DataFrame) -> DataFrame:
    """Patients ever given antiretrovirals as treatment, with their first such visit."""
    rows = patient_dispensing.filter((F.col("arv_drug") == YES) & on_treatment() & not_voided())
    first = F.struct(day("visit_date").alias("visit_date"), (-F.col("visit_id")).alias("_minus"))
    start = rows.groupBy("patient_id").agg(F.min(F.when(F.col("visit_date").isNotNull(), first)).alias("_s"))
    return start.select("patient_id", (-F.col("_s._minus")).alias("visit_id"), F.col("_s.visit_date").alias("visit_date"))


def still_on_arv(patient_on_arv: DataFrame, patient_dispensing: DataFrame) -> DataFrame:
    """Drop patients whose antiretroviral dispensations were all corrected since."""
    valid = patient_dispensing.filter((F.col("arv_drug") == YES) & on_treatment() & not_voided())
    return keep_matching(patient_on_arv, valid, ["patient_id"])
