"""Warehouse, plans, streaming and the registered queries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import rows
from medloom.plans.increment import buffer_obs
from medloom.plans.reports import BUILDERS, Reports, waves
from medloom.sources.codes import Codes
from medloom.sources.record import store_record
from medloom.sources.warehouse import Warehouse, shared_folder
from medloom.streaming import increment as stream
from oracle import registry
from oracle.check import compare, connect
from oracle.recast import CATALOGUE
from oracle.spark_record import reports, stage

SF = "/root/testdata/sf0.001"


def test_warehouse_rewrites_from_itself_and_restores(spark):
    store = Warehouse(spark)
    store.write("t", spark.range(5))
    saved = store.snapshot(["t"])
    store.write("t", store.read("t").filter("id > 2"))
    assert store.read("t").count() == 2
    assert Warehouse(spark, store.root).read("t").count() == 2  # another process sees the same version
    store.restore(saved)
    assert store.read("t").count() == 5
    with pytest.raises(KeyError):
        store.read("missing")


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_codes_resolve_in_one_bounded_query(spark):
    types = spark.createDataFrame(
        [(n, u) for n, u in enumerate(CATALOGUE["encounter_type"].values(), 40)] + [(99, "other")], "id int, uuid string"
    )
    codes = Codes.resolve(encounter_type=types, concept=types.limit(0))
    assert codes.encounter("first_hiv", "imaging") == [40, 55]
    assert codes.concept("ddp") == []
    with pytest.raises(KeyError):
        codes.encounter("no_such_form")


def test_every_report_is_declarative_and_prunes_its_scan(spark):
    run = reports(spark, SF)
    for name in BUILDERS:
        if name == "alert_inputs":
            continue
        plan = run.build(name)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas"):
            assert bad not in plan, (name, bad)
    plan = run.build("drug_group")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(concept_id" in plan and "comments" not in plan.split("ReadSchema")[1]


def test_waves_respect_dependencies():
    order = [n for wave in waves(["alerts"]) for n in wave]
    assert order.index("drug_group") < order.index("drug_order") < order.index("patient_dispensing") < order.index("alerts")


def test_buffer_keeps_the_later_edit_and_one_day(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-08-01", "lab")
    first = chart.obs(1, 856, number=1.0, created="2001-08-01T08:00:00")
    chart.obs(1, 856, number=2.0, created="2001-07-31T08:00:00")
    rec = chart.record(spark)
    buffer = buffer_obs(None, rec.obs, "2001-08-01", "date_created")
    assert rows(buffer, "obs_id") == [(first,)]
    edit = rec.obs.filter(F.col("obs_id") == first).withColumn("voided", F.lit(1)).withColumn("comments", F.lit("x"))
    got = buffer_obs(buffer, edit, "2001-08-01", "date_created").first()
    assert (got["voided"], got["comments"]) == (1, None)  # comments are not among the editable columns
    assert buffer_obs(buffer, edit.limit(0), "2001-08-02", "date_created").count() == 0


def test_stream_of_two_batches_equals_one_batch_run(spark, chart, tmp_path):
    for pid in (1, 2):
        chart.patient(pid)
        chart.visit(pid, pid, "2001-08-01", "dispensing")
        chart.dispense(pid, 84795, "2001-08-15")
    rec = chart.record(spark)
    obs = rec.obs
    source = str(tmp_path / "in")
    # The first file lacks the sibling of the first drug; it arrives with the second file.
    late = F.col("concept_id") == 1276
    obs.filter(~late).coalesce(1).write.parquet(source)
    obs.filter(late).coalesce(1).write.mode("append").parquet(source)

    full = Reports(rec.replace(obs=obs.limit(0)), "2001-08-01")
    store = full.warehouse
    for name in ("patient", "patient_laboratory", "virological_tests", "patient_dispensing", "patient_on_arv",
                 "discontinuation_reason", "status_history", "regimens"):
        full.table(name)
    reader = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):  # the second start finds nothing new
        stream.start_increment(reader, rec, store, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert rows(store.read("dispensing_of_day"), "patient_id", "next_dispensation_date") == [
        (1, dt.date(2001, 8, 15)), (2, dt.date(2001, 8, 15))
    ]
    assert rows(store.read("status_history"), "patient_id", "id_status") == [(1, 6), (2, 6)]


# One query per family; `python -m oracle.check` runs all of them at a larger scale.
FAMILIES = [
    "patient", "patient_prescription", "patient_dispensing", "patient_laboratory", "health_qual_patient_visit",
    "patient_tb_diagnosis", "patient_pregnancy", "vaccination", "patient_on_art", "indicators", "immunization_dose",
    "exposed_infants", "statuses", "alerts", "first_alerts", "regimens", "patient_summary", "day_statuses", "upsert",
    "range_match_next", "diff_values", "warehouse_writes", "stream_daily_counts",
]


@pytest.mark.parametrize("name", FAMILIES)
def test_query_agrees_with_sql(spark, name):
    ok, message = compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name])
    assert ok, message


def test_every_clinical_query_has_sql():
    assert set(registry.ORACLES) == set(registry.QUERIES) <= set(entry.queries())
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_and_record_stage(spark):
    assert entry.entry(spark).count() > 0
    assert stage(spark, SF) == stage(spark, SF)


def test_store_record_copies_every_table(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-05-01", "lab")
    chart.obs(1, 856, number=3.0)
    rec = chart.record(spark)
    store = Warehouse(spark)
    copy = store_record(rec, store.write)
    assert copy.obs.collect() == rec.obs.collect()
    assert "source_visit" in store


def test_a_hot_patient_gets_the_same_rows(spark, chart):
    """One patient holds more than a third of all entries."""
    for pid in range(1, 21):
        chart.patient(pid)
        for n in range(40 if pid == 1 else 2):
            vid = pid * 100 + n
            chart.visit(vid, pid, f"2000-{n % 12 + 1:02d}-{n % 28 + 1:02d}", "dispensing")
            chart.dispense(vid, 84795, f"2001-{n % 12 + 1:02d}-01", rx=138405)
    run = Reports(chart.record(spark), "2001-08-01").run(["patient_dispensing", "status_rows"], at_once=4)
    handed = run["patient_dispensing"]
    assert handed.count() == 40 + 19 * 2 == handed.select("encounter_id").distinct().count()
    latest = {1: "2001-12-01"} | {p: "2001-02-01" for p in range(2, 21)}
    got = dict(rows(handed.groupBy("patient_id").agg(F.max("next_dispensation_date").cast("string").alias("d")), "patient_id", "d"))
    assert got == latest
    assert dict(rows(run["status_rows"], "patient_id", "id_status")) == {1: 6} | {p: 9 for p in range(2, 21)}
