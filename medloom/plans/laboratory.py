"""Laboratory marts: patient_laboratory, virological_tests, serological_tests, patient_pcr."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import add_days, add_months, day, live, mysql_num, round_int, typed_value
from medloom.operators.eav import Obs, collect_obs, sibling_pivot
from medloom.operators.pick import first_and_last
from medloom.plans.shared import of_types, provider
from medloom.sources.codes import is_any
from medloom.sources.record import Record

ORDERED_TEST = 1271
CD4 = (1941, 163544)
VIRAL_LOAD = (856, 1305)
KEY = ["patient_id", "encounter_id", "test_id"]


def laboratory_order(rec: Record, encounter_context: DataFrame, with_cd4: bool = True) -> DataFrame:
    """Ordered tests, one row per patient, encounter and test."""
    codes = rec.codes
    lab = of_types(encounter_context, codes.encounter("lab")).select("encounter_id")
    first = of_types(encounter_context, codes.encounter("first_hiv", "ped_first_hiv")).select("encounter_id")

    def rows(step: int, obs: DataFrame, test: str, forms: DataFrame) -> DataFrame:
        return obs.join(forms, "encounter_id", "left_semi").select(
            F.col("person_id").alias("patient_id"), "encounter_id", F.col(test).alias("test_id"),
            "location_id", "voided", F.struct(F.lit(step).alias("step"), "obs_id").alias("_order"),
        )

    orders = rows(1, rec.obs.filter(F.col("concept_id") == ORDERED_TEST), "value_coded", lab)
    if with_cd4:
        orders = orders.unionByName(rows(2, rec.obs.filter(F.col("concept_id").isin(*CD4)), "concept_id", first))
    return first_and_last(orders, KEY, ["location_id"], ["voided"], "_order")


def laboratory_results(rec: Record, orders: DataFrame, skip_zero: bool = False) -> DataFrame:
    """Latest live result of the ordered tests, by encounter and test.

    Only results of ordered tests are aggregated. Which tests were ever ordered is a part of the concept dictionary, whatever
    the number of orders: it goes to every task, so that other observations drop out before they are shuffled.
    """
    tests = F.broadcast(orders.select("test_id").distinct())
    value = typed_value("value_coded", "value_numeric", "value_text", skip_zero)
    rows = rec.obs.filter(live()).withColumnRenamed("concept_id", "test_id")
    if not skip_zero:
        rows = rows.filter(
            F.col("value_coded").isNotNull() | F.col("value_numeric").isNotNull() | F.col("value_text").isNotNull()
        )
    rows = rows.join(tests, "test_id", "left_semi").select(
        "encounter_id", "test_id", "obs_datetime", "obs_id",
        value.alias("test_result"), day("obs_datetime").alias("date_test_done"),
        F.col("comments").alias("comment_test_done"),
    ).join(orders.select("encounter_id", "test_id").distinct(), ["encounter_id", "test_id"], "left_semi")
    return first_and_last(
        rows, ["encounter_id", "test_id"], [], ["test_result", "date_test_done", "comment_test_done"],
        F.struct("obs_datetime", "obs_id"),
    ).withColumn("test_done", F.lit(1))


def patient_laboratory(rec: Record, encounter_context: DataFrame, laboratory_order: DataFrame) -> DataFrame:
    """Ordered tests with their results. Grain: patient, encounter, test."""
    codes = rec.codes
    destination = collect_obs(
        rec.obs, "encounter_id", {"order_destination": Obs((160632,), value="value_text", pick="latest")}
    )
    kind = collect_obs(
        rec.obs, ["encounter_id", "person_id"],
        {
            "_kind": Obs(
                codes.concept("viral_load_type"), codes.concept("viral_load_routine", "viral_load_targeted"),
                value="value_coded", pick="latest", any_voided=True,
            )
        },
    ).withColumnRenamed("person_id", "patient_id")
    names = (
        rec.concept_name.filter((F.col("locale") == "fr") & live())
        .groupBy(F.col("concept_id").alias("test_id"))
        .agg(F.max("name").alias("test_name"))
    )
    visits = encounter_context.filter(F.col("in_visit") & live("visit_voided")).select(
        "encounter_id", "visit_id", "visit_date", F.col("visit_created").alias("creation_date")
    )
    out = (
        laboratory_order.join(laboratory_results(rec, laboratory_order), ["encounter_id", "test_id"], "left")
        .join(visits, "encounter_id", "left")
        .join(provider(rec), "encounter_id", "left")
        .join(destination, "encounter_id", "left")
        .join(kind, ["encounter_id", "patient_id"], "left")
        .join(names, "test_id", "left")
    )
    targeted = F.when(is_any("_kind", codes.concept("viral_load_targeted")), F.lit(2)).otherwise(F.lit(1))
    return out.select(
        "patient_id", "encounter_id", "test_id", "location_id", "visit_id", "visit_date", "creation_date",
        "provider_id", F.coalesce("test_done", F.lit(0)).alias("test_done"), "test_result", "date_test_done",
        "comment_test_done", "order_destination", "test_name",
        F.when(F.col("test_id").isin(*VIRAL_LOAD), targeted).alias("viral_load_target_or_routine"), "voided",
    )


TEST_GIVEN, AGE, AGE_UNIT = 162087, 163540, 163541
DAYS_OLD, MONTHS_OLD = 1072, 1074


def births(rec: Record) -> DataFrame:
    """Day of birth of the registered patients."""
    registered = rec.patient.select(F.col("patient_id").alias("person_id"))
    return rec.person.join(registered, "person_id", "left_semi").select(
        F.col("person_id").alias("patient_id"), "birthdate", F.lit(True).alias("_known")
    )


def test_date(as_of) -> Column:
    """Day of the test from the age at the test, when that lies before `as_of`; else the form's day."""
    today = F.lit(as_of).cast("date")
    by_days, by_months = add_days("birthdate", "age"), add_months("birthdate", "age")
    return (
        F.when((F.col("age_unit") == DAYS_OLD) & (by_days < today), by_days)
        .when((F.col("age_unit") == MONTHS_OLD) & (by_months < today), by_months)
        .otherwise(F.col("encounter_date"))
    )


def _grouped_tests(
    rec: Record, context: DataFrame, as_of, headers: list[int], answers: tuple, result: int, live_forms: bool
) -> DataFrame:
    answer = (F.col("concept_id") == TEST_GIVEN) & F.col("value_coded").isin(*answers)
    rows = sibling_pivot(
        rec.obs, headers, answer,
        {
            "test_result": Obs((result,), value="value_coded", pick="latest"),
            "age": Obs((AGE,), value="value_numeric", pick="latest"),
            "age_unit": Obs((AGE_UNIT,), value="value_coded", pick="latest"),
        },
    ).withColumnsRenamed({"person_id": "patient_id", "concept_id": "test_id", "header_concept": "concept_group"})
    tests = first_and_last(
        rows.withColumn("answer_concept_id", F.col("value_coded")),
        ["encounter_id", "location_id", "obs_group_id", "test_id"],
        ["patient_id", "concept_group", "answer_concept_id", "test_result", "age", "age_unit"], ["voided"], "obs_id",
    )
    forms = context.filter(live("encounter_voided")) if live_forms else context
    forms = forms.select("encounter_id", "location_id", day("encounter_datetime").alias("encounter_date"))
    out = (
        tests.withColumn("age", round_int("age"))
        .join(forms, ["encounter_id", "location_id"], "left")
        .join(births(rec), "patient_id", "left")
    )
    return out.withColumn("test_date", F.when(F.col("_known"), test_date(as_of))).select(
        "patient_id", "encounter_id", "location_id", "encounter_date", "concept_group", "obs_group_id",
        "test_id", "answer_concept_id", "test_result", "age", "age_unit", "test_date", "voided",
    )


def virological_tests(rec: Record, encounter_context: DataFrame, as_of) -> DataFrame:
    """PCR tests of infants. Grain: encounter, location, group, test."""
    return _grouped_tests(
        rec, encounter_context, as_of, rec.codes.concepts_like("pcr_group_"), (1030,), 1030, live_forms=True
    )


def serological_tests(rec: Record, encounter_context: DataFrame, as_of) -> DataFrame:
    """Antibody tests. Grain: encounter, location, group, test."""
    return _grouped_tests(
        rec, encounter_context, as_of, rec.codes.concepts_like("serology_group_"), (163722, 1042), 163722,
        live_forms=False,
    )


def patient_pcr(patient_laboratory: DataFrame, virological_tests: DataFrame) -> DataFrame:
    """PCR results from laboratory forms and from paediatric forms."""
    number = mysql_num("test_result")
    lab = patient_laboratory.filter(
        (F.col("test_id") == 844) & (F.col("test_done") == 1) & number.isin(1301.0, 1302.0, 1300.0, 1304.0)
    ).select(
        "patient_id", "encounter_id", "location_id", day("visit_date").alias("visit_date"),
        number.cast("long").alias("pcr_result"), F.col("date_test_done").alias("test_date"),
    ).distinct()
    forms = virological_tests.filter(F.col("test_result").isin(664, 703, 1138)).select(
        "patient_id", "encounter_id", "location_id", F.col("encounter_date").alias("visit_date"),
        F.col("test_result").alias("pcr_result"), "test_date",
    ).distinct()
    return lab.unionByName(forms)
