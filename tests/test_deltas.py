"""Changes that touch only what they have to."""

from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from medloom.operators import diff, merge
from medloom.plans import increment as inc
from medloom.plans.delta import REPORTS, DayTables
from medloom.plans.reports import Reports
from medloom.sources.keyed import KeyedTable
from medloom.sources.warehouse import Warehouse
from medloom.streaming import increment as stream


def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def test_an_upsert_rewrites_the_ranges_of_its_rows_alone(spark, tmp_path):
    old = spark.range(1000).select("id", (F.col("id") % 7).alias("v"), F.lit("old").alias("w"))
    table = KeyedTable(spark, str(tmp_path / "t"), "id", 100)
    table.create(old)
    before = files(tmp_path / "t")
    change = spark.createDataFrame([(150, 1, "new", 1), (150, 2, "newer", 2), (1050, 3, "new", 1), (None, 4, "none", 1)], "id long, v long, w string, n int")
    want = merge.upsert(old, change, ["id"], ["v"], "n", ("n",))
    assert len(table.upsert(change, ["id"], ["v"], "n", ("n",))) == 3
    assert set(table.read().collect()) == set(want.collect())
    kept = {f for f in before if "part=1/" not in f and "part=-" not in f}
    assert kept <= files(tmp_path / "t") and not {f for f in before if "part=1/" in f} & files(tmp_path / "t")
    plan = table.read([1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part" in plan


def test_a_range_without_rows_is_emptied(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id", 10)
    table.create(spark.range(30))
    assert table.replace(spark.range(10, 20), spark.range(0), ["id"]) == [1]
    assert rows(table.read(), "id") == [(i,) for i in (*range(10), *range(20, 30))]
    table.replace(spark.range(10, 20), spark.range(12, 13), ["id"])
    assert table.read([1]).count() == 1 and table.expire(2) == 2 and rows(table.read(), "id") == [(i,) for i in range(20, 30)]


def test_a_difference_reads_the_ranges_that_differ(spark, tmp_path):
    rows_ = spark.range(100).select("id", (F.col("id") * 2).alias("v"), F.when(F.col("id") % 3 == 0, F.lit("x")).alias("w"))
    one, two = (KeyedTable(spark, str(tmp_path / n), "id", 10) for n in "ab")
    one.create(rows_)
    two.create(rows_.filter("id <> 55").withColumn("w", F.when(F.col("id") == 12, F.lit(None)).when(F.col("id") == 13, F.lit("y")).otherwise(F.col("w"))))
    got = diff.keyed_diff(one, two, ["id"], ["v", "w"])
    assert set(got.collect()) == set(diff.table_diff(one.read(), two.read(), ["id"], ["v", "w"]).collect())
    assert rows(got, "id") == [(12,), (13,), (55,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("part#") and all(part not in plan for part in ("part=2", "part=9"))
    assert diff.keyed_diff(one, one, ["id"], ["v", "w"]).count() == 0


def test_an_empty_table_can_be_read_and_filled(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id", 10)
    table.create(spark.range(0))
    assert table.read().count() == 0 and table.upsert(spark.range(3), ["id"], [], "id") == [0]
    assert rows(table.read(), "id") == [(0,), (1,), (2,)]


def _edits(spark, path, name, data):
    kind = "obs_id long, person_id long, date_created timestamp_ntz, value_numeric double, voided int, sequence int"
    spark.createDataFrame([(*r[:2], dt.datetime.fromisoformat(r[2]), *r[3:]) for r in data], kind).coalesce(1).write.parquet(f"{path}/{name}")


def test_edits_in_any_order_and_expired_days(spark, tmp_path):
    source, buffer = str(tmp_path / "in"), stream.obs_buffer(spark, str(tmp_path))
    kind = "obs_id long, person_id long, date_created timestamp_ntz, value_numeric double, voided int, sequence int"

    def go():
        arriving = spark.readStream.schema(kind).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(source)
        query = stream.start_buffer(arriving, buffer, str(tmp_path / "c"), "sequence", age="2 days", available_now=True)
        query.awaitTermination()

    _edits(spark, source, "a", [(1, 9, "2001-08-01T08:00:00", 3.0, 1, 3), (2, 9, "2001-08-01T09:00:00", 1.0, 0, 1)])
    go()
    _edits(spark, source, "b", [(1, 8, "2001-08-01T08:00:00", 1.0, 0, 1), (2, 9, "2001-08-01T09:00:00", 2.0, 0, 2)])
    go()  # a new query on the same state: what came first stays known
    assert rows(buffer.read(), "obs_id", "person_id", "value_numeric", "voided") == [(1, 8, 3.0, 1), (2, 9, 2.0, 0)]
    _edits(spark, source, "c", [(3, 9, "2001-08-09T08:00:00", 5.0, 0, 1)])
    go()
    _edits(spark, source, "d", [(2, 9, "2001-08-01T09:00:00", 7.0, 0, 9), (4, 9, "2001-08-09T09:00:00", 6.0, 0, 1)])
    go()  # the state of the first day has expired: its edit is dropped
    assert rows(buffer.read(), "obs_id", "value_numeric") == [(1, 3.0), (2, 2.0), (3, 5.0), (4, 6.0)]
    assert stream.expire_days(buffer, "2 days") == 1 and rows(buffer.read(), "obs_id") == [(3,), (4,)]


def test_a_day_over_the_affected_patients_equals_one_over_all(spark, chart, tmp_path):
    """Infants and statuses after a day: new forms, a birthday that counts, an old visit; others keep their rows."""
    for pid, born in ((1, "1980-01-01"), (2, "2000-02-01"), (3, "2001-01-01"), (4, "1970-01-01"), (5, "1970-01-01")):
        chart.patient(pid, born)
    chart.visit(11, 1, "2001-07-01", "dispensing")
    chart.dispense(11, 84795, "2001-07-20", rx=138405)
    for vid, pid in ((21, 2), (31, 3)):
        chart.visit(vid, pid, "2001-05-01", "ped_first_hiv")
        chart.obs(vid, 1401, 1405)
    chart.visit(22, 2, "2001-05-02", "lab")
    chart.obs(22, 1271, 1040)
    chart.obs(22, 1040, 703)
    chart.visit(41, 4, "2000-07-01", "followup_hiv")
    chart.visit(51, 5, "2001-07-01", "followup_hiv")
    today = dt.date(2001, 8, 1)
    chart.visit(32, 3, "2001-08-01", "discontinuation")
    chart.obs(32, 1667, 165439, created="2001-08-01T10:00:00")
    chart.visit(12, 1, "2001-08-01", "dispensing")
    chart.dispense(12, 84795, "2001-09-20", rx=138405)
    rec = chart.record(spark)
    new = inc.obs_of_day(rec.obs, today)
    earlier = rec.replace(obs=rec.obs.join(new.select("obs_id"), "obs_id", "left_anti").select(*rec.obs.columns))
    before = Reports(earlier, "2001-07-31")
    tables = DayTables(rec, str(tmp_path / "d"), width=2)
    tables.start({n: before.table(n) for n in REPORTS}, before.table("status_history"), dt.date(2001, 7, 31))
    who = tables.run(new, today)
    assert {1, 3} <= {r[0] for r in who.collect()} and 5 not in {r[0] for r in who.collect()}
    after = Warehouse(spark)
    inc.Day(rec, "2001-08-01", lambda n: after.read(n) if n in after else before.table(n), after.write).run(new)
    for name, got in (("infants_of_day", tables.table["infants"].read()), ("statuses_of_day", tables.statuses), ("patient_laboratory", tables.table["patient_laboratory"].read()),
                      ("status_history", tables.history.read()), ("regimens", tables.table["regimens"].read()), ("patient_summary", tables.table["patient_summary"].read())):
        cols = got.columns
        assert sorted(map(str, after.read(name).select(*cols).collect())) == sorted(map(str, got.collect())), name
