"""What grows with the tables: staging, sizes the planner goes by, the state of streams."""

from __future__ import annotations

import datetime as dt
import os

import pyarrow.parquet as pq
from conftest import rows
from pyspark.sql import functions as F

from medloom.plans.reports import Reports
from medloom.sources.warehouse import Warehouse
from medloom.streaming import increment as stream
from oracle import spark_record

SF = "/root/testdata/sf0.001"


def test_staged_observations_are_in_order_and_stored_as_differences(spark, tmp_path):
    os.symlink(SF, tmp_path / "sf")
    root = spark_record.stage(spark, str(tmp_path / "sf")).removeprefix("file:")
    files = [f"{root}/obs/{f}" for f in os.listdir(f"{root}/obs") if f.startswith("part-")]
    for f in files:
        order = pq.read_table(f, columns=["concept_id", "encounter_id"]).to_pylist()
        pairs = [(r["concept_id"], r["encounter_id"]) for r in order]
        assert pairs == sorted(pairs)
        group = pq.ParquetFile(f).metadata.row_group(0)
        kinds = {group.column(i).path_in_schema: group.column(i).encodings for i in range(group.num_columns)}
        assert all("DELTA_BINARY_PACKED" in kinds[c] for c in ("obs_id", "encounter_id"))


def test_a_table_is_broadcast_by_the_size_of_its_rows(spark):
    store = Warehouse(spark)
    small = store.write("small", spark.range(1000).withColumn("v", F.rand(1)))
    large = store.write("large", spark.range(500_000).withColumn("v", F.rand(1)))  # 4 MB stored, 12 MB and more as rows

    def plan(table):
        other = store.write("other", spark.range(2_000_000).withColumn("w", F.rand(2)))
        return other.join(table, "id")._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in plan(small) and "BroadcastHashJoin" not in plan(large)


def test_a_factor_of_the_session_stays(spark):
    factor = "spark.sql.sources.fileCompressionFactor"
    spark.conf.set(factor, "3.0")
    try:
        Warehouse(spark)
        assert spark.conf.get(factor) == "3.0"
    finally:
        spark.conf.unset(factor)


def test_a_batch_runs_its_day_once_with_state_outside_the_heap(spark, chart, tmp_path):
    for pid in (1, 2):
        chart.patient(pid)
        chart.visit(pid, pid, "2001-08-01", "lab")
        chart.obs(pid, 1271, 856)
        chart.obs(pid, 856, number=5.0)
    rec, store, asked = chart.record(spark), Warehouse(spark), []
    store.write("patient_laboratory", Reports(rec.replace(obs=rec.obs.limit(0)), "2001-08-01").table("patient_laboratory"))
    rec.obs.coalesce(1).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(rec.obs.schema).parquet(str(tmp_path / "in"))
    kept = {key: spark.conf.get(key, None) for key in stream.STATE}

    def days(batch):
        asked.append(batch.count())
        return [dt.date(2001, 8, 1)]

    query = stream.start_increment(arriving, rec, store, str(tmp_path / "cp"), days=days, available_now=True, names=["patient_laboratory"])
    query.awaitTermination()
    assert asked == [4]  # no second run without rows once the watermark has moved
    assert any(name.startswith("rocksdb") for name in query.lastProgress["stateOperators"][0]["customMetrics"])
    assert {key: spark.conf.get(key, None) for key in stream.STATE} == kept
    assert rows(store.read("patient_laboratory"), "encounter_id", "test_result") == [(1, "5"), (2, "5")]
