"""Work that follows the input and the table asked for."""

from __future__ import annotations

import datetime as dt
import os

from conftest import rows
from pyspark.sql import functions as F

from medloom.operators import match
from medloom.plans import delta, increment as inc, laboratory, surveillance
from medloom.plans.reports import Reports
from medloom.sources.warehouse import Warehouse
from medloom.streaming import increment as stream
from oracle import spark_record

SF = "/root/testdata/sf0.001"


def test_staging_deals_orders_out_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark_record, "ORDERS_A_TASK", 100)
    os.symlink(SF, tmp_path / "sf")
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    root = spark_record.stage(spark, str(tmp_path / "sf")).removeprefix("file:")
    files = [f for f in os.listdir(f"{root}/obs") if f.startswith("part-")]
    assert len(files) > spark.sparkContext.defaultParallelism and len(files) == -(-orders // 100)


def _lab(chart):
    for pid in (1, 2):
        chart.patient(pid)
        chart.visit(pid, pid, "2001-08-01", "lab")
        chart.obs(pid, 1271, 856)
        chart.obs(pid, 856, number=5.0)
        chart.obs(pid, 1305, 1301)


def test_results_of_tests_never_ordered_are_not_shuffled(spark, chart, monkeypatch):
    _lab(chart)
    rec = chart.record(spark)
    run = Reports(rec, "2001-08-01")
    orders = run.table("laboratory_order")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = laboratory.laboratory_results(rec, orders)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan  # before the exchange by encounter and test
    assert rows(found, "encounter_id", "test_id", "test_result") == [(1, 856, "5"), (2, 856, "5")]


def _state(full):
    return {n: full.table(n) for n in ("patient", "patient_laboratory", "virological_tests", "patient_dispensing", "patient_on_arv",
                                       "discontinuation_reason", "status_history", "regimens")}


def test_a_table_of_the_day_makes_only_what_it_needs(spark, chart):
    _lab(chart)
    rec, after = chart.record(spark), Warehouse(spark)
    full = Reports(rec, "2001-08-01")
    day = inc.Day(rec, "2001-08-01", full.table, after.write).start(inc.obs_of_day(rec.obs, "2001-08-01"))
    assert day.table("patient").count() == 2 and day.done == ["patient"] and "statuses_of_day" not in after
    assert "encounter_context" not in full.warehouse and "patient" in full.warehouse
    state, whole = _state(full), Warehouse(spark)
    every = inc.Day(rec, "2001-08-01", state.get, whole.write)
    every.run(inc.obs_of_day(rec.obs, "2001-08-01"))
    assert every.done == inc.TABLES
    for name in ("patient_laboratory", "status_history"):
        cols = whole.read(name).columns
        assert sorted(map(str, day.table(name).select(*cols).collect())) == sorted(map(str, whole.read(name).select(*cols).collect()))


def test_a_stream_brings_the_named_tables_up_to_date(spark, chart, tmp_path):
    _lab(chart)
    rec, store = chart.record(spark), Warehouse(spark)
    full = Reports(rec.replace(obs=rec.obs.limit(0)), "2001-08-01")
    assert inc.state_of(["patient_laboratory"]) == ["patient_laboratory"]
    store.write("patient_laboratory", full.table("patient_laboratory"))
    rec.obs.coalesce(1).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(rec.obs.schema).parquet(str(tmp_path / "in"))
    stream.start_increment(
        arriving, rec, store, str(tmp_path / "cp"), days=lambda batch: [dt.date(2001, 8, 1)], available_now=True, names=["patient_laboratory"]
    ).awaitTermination()
    assert rows(store.read("patient_laboratory"), "encounter_id", "test_result") == [(1, "5"), (2, "5")]
    assert "statuses_of_day" not in store


def test_a_day_over_affected_patients_keeps_only_what_leads_to_the_named_tables(spark, chart, tmp_path):
    _lab(chart)
    rec = chart.record(spark)
    full = Reports(rec.replace(obs=rec.obs.limit(0)), "2001-07-31")
    assert delta.read_by(["patient_laboratory"]) == ["patient_laboratory"] and delta.led_by(["statuses"]) == [
        "patient", "patient_laboratory", "infants", "standing", "statuses"]
    tables = delta.DayTables(rec, str(tmp_path / "d"), delta.width_for(rec.patient), ["patient_laboratory"])
    tables.start({"patient_laboratory": full.table("patient_laboratory")}, None, dt.date(2001, 7, 31))
    tables.run(inc.obs_of_day(rec.obs, "2001-08-01"), "2001-08-01")
    assert rows(tables.table["patient_laboratory"].read(), "encounter_id", "test_result") == [(1, "5"), (2, "5")]
    kept = {p.name for p in (tmp_path / "d").iterdir()}
    assert kept == {"source_encounter", "source_visit", "patient_laboratory", "day", "run"}


def test_ranges_follow_the_number_of_patients(spark):
    ids = lambda n: spark.range(1, n + 1).withColumnRenamed("id", "patient_id")
    assert [delta.width_for(ids(n)) for n in (0, 1, 24, 15_000, 10_000_000)] == [1, 1, 1, 625, 30_000]


def test_a_day_over_affected_patients_keeps_the_observations_its_rules_read(spark, chart, tmp_path):
    _lab(chart)
    chart.patient(3, "2001-01-01")
    for vid, when in ((31, "2001-07-01"), (32, "2001-08-01")):
        chart.visit(vid, 3, when, "ped_first_hiv")
        chart.obs(vid, 1401, 1405, created=f"{when}T10:00:00")
        chart.obs(vid, 5089, number=7.0, created=f"{when}T10:00:00")
    rec, today = chart.record(spark), dt.date(2001, 8, 1)
    before = Reports(rec.replace(obs=rec.obs.filter("date_created < '2001-08-01'")), "2001-07-31")
    tables = delta.DayTables(rec, str(tmp_path / "d"), 10, ["infants"])
    tables.start({n: before.table(n) for n in tables.reports}, None, dt.date(2001, 7, 31))
    tables.run(inc.obs_of_day(rec.obs, today), today)
    assert rows(tables.source["obs"].read(), "encounter_id", "concept_id") == [(31, 1401), (32, 1401)]
    assert rows(tables.table["infants"].read(), "patient_id", "encounter_id", "condition") == [(3, 31, 3), (3, 32, 3)]


def test_observations_that_head_no_diagnosis_are_not_shuffled(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-07-01", "adult_initial")
    for concept in (159947, 165210):
        head = chart.obs(1, concept)
        chart.obs(1, 1284, 142473, group=head)
    for n in range(50):
        chart.obs(1, 5089, number=float(n))
    rec = chart.record(spark)
    run = Reports(rec, "2001-08-01")
    answers = run.table("diagnosis_answer")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = surveillance.patient_diagnosis(rec, answers)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan  # the bitmap, before the exchange by group
        assert rows(found, "concept_group", "answer_concept_id") == [(159947, 142473), (165210, 142473)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_may_match_hold_all_that_do(spark, monkeypatch):
    asked = spark.range(0, 100_000, 50).select(F.col("id").alias("k")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    found = match.may_match(spark.range(100_000), "id", asked, "k")
    assert found.join(asked, F.col("id") == F.col("k"), "left_semi").count() == 2000 and found.count() < 20_000
    assert match.may_match(spark.range(100), "id", asked.limit(0), "k").count() == 0
    monkeypatch.setattr(match, "MOST_WORDS", match.WORDS_A_ROW)  # a bitmap that is far too full
    full = match.may_match(spark.range(1_000_000), "id", spark.range(1_000_000), "id")
    assert full.count() == 1_000_000
