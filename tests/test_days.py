"""Runs on several days: nothing is lost between batches, days and runs."""

from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from medloom.plans import status as st
from medloom.plans.increment import buffer_obs
from medloom.plans.reports import Reports
from medloom.plans.jobs import JOBS
from medloom.operators import merge
from medloom.sources.warehouse import Warehouse
from medloom.streaming.increment import days_of, merge_into_buffer


def test_edits_of_one_batch_do_not_depend_on_their_order(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-08-01", "lab")
    chart.obs(1, 856, number=1.0, created="2001-08-01T08:00:00")
    one = chart.record(spark).obs
    edits = [one.withColumn("seq", F.lit(n)).withColumn("value_numeric", F.lit(v)) for n, v in ((1, 5.0), (2, 7.0), (2, 6.0))]
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        batch = edits[order[0]].unionByName(edits[order[1]]).unionByName(edits[order[2]])
        assert rows(buffer_obs(None, batch, "2001-08-01", "seq"), "value_numeric") == [(7.0,)]


def test_a_backlog_and_a_late_day_keep_every_row(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-07-30", "lab")
    ids = {d: chart.obs(1, 856, number=1.0, created=f"{d}T08:00:00") for d in ("2001-07-30", "2001-07-31", "2001-08-01")}
    late = chart.obs(1, 856, number=2.0, created="2001-07-30T09:00:00")
    obs, store = chart.record(spark).obs, Warehouse(spark)
    first = obs.filter(F.col("obs_id") != late)
    assert days_of(first) == [dt.date(2001, 7, 30), dt.date(2001, 7, 31), dt.date(2001, 8, 1)]
    for batch in (first, obs.filter(F.col("obs_id") == late)):
        for day in days_of(batch):
            merge_into_buffer(store, "obs_buffer", batch, day, "date_created")
    read = lambda d: rows(store.read(f"obs_buffer_{d.replace('-', '')}"), "obs_id")
    assert read("2001-07-30") == [(ids["2001-07-30"],), (late,)]
    assert read("2001-07-31") == [(ids["2001-07-31"],)] and read("2001-08-01") == [(ids["2001-08-01"],)]


def test_history_keeps_rows_without_a_day(spark):
    kind = "patient_id int, id_status int, date_started_status date"
    old = spark.createDataFrame([(1, 6, None), (2, 6, dt.date(2001, 8, 1)), (3, 6, dt.date(2001, 7, 1))], kind)
    fresh = spark.createDataFrame([(4, 8, dt.date(2001, 8, 1))], kind)
    assert rows(st.merge_history(old, fresh, "2001-08-01"), "patient_id") == [(1,), (3,), (4,)]


def test_a_null_order_keeps_the_rows_values(spark):
    got = merge.upsert(None, spark.createDataFrame([(1, "a", None)], "k int, v string, at int"), ["k"], ["v"], "at", ("at",))
    assert rows(got, "k", "v") == [(1, "a")]


def test_a_second_run_on_another_day_is_built_anew_and_keeps_the_history(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-06-01", "dispensing")
    chart.dispense(1, 84795, "2001-07-01", rx=138405)
    rec, store = chart.record(spark), Warehouse(spark)
    first = Reports(rec, "2001-06-20", store).table("statuses").collect()
    second = Reports(rec, "2001-12-20", store).table("statuses").collect()
    assert {r["id_status"] for r in first} == {6} and {r["id_status"] for r in second} == {9}


def test_full_runs_add_to_the_statuses_and_regimens_of_earlier_ones(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-06-01", "dispensing")
    chart.dispense(1, 84795, "2001-07-01", rx=138405)
    rec, store = chart.record(spark), Warehouse(spark)
    history = JOBS["status_history"]
    assert rows(history(rec, "2001-06-20", store), "patient_id", "id_status") == [(1, 6)]
    for _ in range(2):  # the same day again replaces its own rows
        assert rows(history(rec, "2001-12-20", store), "patient_id", "id_status") == [(1, 6), (1, 9)]
    later = Reports(rec, "2001-12-20", store)
    assert rows(later.table("current_status"), "patient_id", "arv_status") == [(1, 9)]
    fresh = Reports(rec, "2001-12-20").table("regimens")
    old = spark.createDataFrame([(1, 7, dt.date(2000, 1, 1), "AZT", 1)], "location_id int, patient_id int, visit_date date, regimen string, rx_or_prophy int")
    store.write("regimens", old.select(*[F.col(f.name).cast(f.dataType) for f in fresh.schema]))
    assert (7, "AZT") in rows(later.table("regimens"), "patient_id", "regimen")


def test_append_after_a_snapshot_leaves_the_snapshot(spark):
    store = Warehouse(spark)
    store.write("t", spark.range(5))
    saved = store.snapshot(["t"])
    assert store.append("t", spark.range(5, 8)).count() == 8
    assert Warehouse(spark, store.root).read("t").count() == 8
    store.restore(saved)
    assert store.read("t").count() == 5
    store.drop("t")
    assert "t" not in store
    store.write("d", spark.range(6).withColumn("day", F.col("id") % 3), partition_by=["day"])
    saved = store.snapshot(["d"])
    assert store.replace_partition("d", spark.createDataFrame([(9, 1)], "id long, day long"), "day").count() == 5
    store.restore(saved)
    assert store.read("d").count() == 6


def test_replaced_runs_expire(spark, tmp_path):
    store, other = Warehouse(spark, str(tmp_path / "w")), Warehouse(spark, str(tmp_path / "o"))
    other.write("t", spark.range(2))
    store.restore(other.snapshot(["t"]))
    store.write("t", spark.range(5))
    store.append("t", spark.range(1))
    assert store.expire("t", dt.timedelta(days=1)) == 0
    assert store.expire("t", dt.timedelta(seconds=-5)) == 1  # the append went to the current run
    assert store.read("t").count() == 6 and other.read("t").count() == 2
    store.write("t", spark.range(3))
    assert store.expire("t", dt.timedelta(seconds=-5)) == 1 and store.read("t").count() == 3
    assert len(list((tmp_path / "w/t").iterdir())) == 1


def test_an_unfinished_run_does_not_count(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"))
    store.write("t", spark.range(5))
    (tmp_path / "w/t/run=2").mkdir()
    assert store.read("t").count() == 5
    assert store.append("t", spark.range(1)).count() == 6


def test_jobs_name_what_a_scheduler_calls():
    assert all(callable(job) for job in JOBS.values()) and {"full_load", "daily_run", "status_history"} <= set(JOBS)
