"""Queries for what follows a change: upserts by range, and the day's run over the affected patients."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from medloom.operators import diff
from medloom.plans import increment as inc
from medloom.plans.delta import DayTables, led_by, read_by, width_for
from medloom.plans.reports import Reports
from medloom.sources.keyed import KeyedTable
from medloom.sources.warehouse import Warehouse, shared_folder
from medloom.streaming import increment as stream
from oracle.operators import obs_stream, table
from oracle.recast import AS_OF
from oracle.registry import register
from oracle.spark_record import reports

#: Orders in a range.
WIDTH = 500
_ONE = "SELECT DISTINCT ON (o_orderkey) o_orderkey, o_totalprice AS price, o_orderpriority AS urgency FROM orders"
_TOP = "(SELECT max(o_orderkey) FROM orders)"
_A_ROWS = f"SELECT * FROM ({_ONE}) WHERE 1000 * o_orderkey <= 999 * {_TOP}"
_A_ROWS_CHANGED = f"""SELECT o_orderkey, CASE WHEN 100 * o_orderkey > 99 * {_TOP} AND o_orderkey % 7 = 0 THEN price + 1 ELSE price END AS price, urgency
FROM ({_ONE}) WHERE 1000 * o_orderkey <> 995 * {_TOP}"""


@register("upsert_touched", f"""
WITH top AS (SELECT max(o_orderkey) AS m FROM orders),
o AS (SELECT DISTINCT ON (o_orderkey) o_orderkey, o_totalprice, o_orderpriority FROM orders),
n AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM o, top WHERE 100 * o_orderkey > 99 * m
  UNION ALL SELECT o_orderkey + m + 1, o_totalprice FROM o, top WHERE 200 * o_orderkey < m)
SELECT o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
  CASE WHEN o.o_orderkey IS NULL THEN 'new' ELSE o.o_orderpriority END AS o_orderpriority,
  (SELECT count(DISTINCT o_orderkey // {WIDTH}) FROM n) AS rewritten, (SELECT count(DISTINCT o_orderkey // {WIDTH}) FROM o) AS ranges
FROM o FULL JOIN n USING (o_orderkey)""")
def _upsert_touched(spark, d):
    """The last hundredth of the orders gets new prices and as many are added: only their ranges are rewritten."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").dropDuplicates(["o_orderkey"])
    stored = KeyedTable(spark, f"{shared_folder(spark)}/keyed-{uuid.uuid4().hex}", "o_orderkey", WIDTH)
    stored.create(orders)
    ranges = stored.touched(stored.read())
    top, known, key = orders.agg(F.max("o_orderkey")).scalar(), stored.read(), F.col("o_orderkey")
    new = known.filter(100 * key > 99 * top).withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(
        known.filter(200 * key < top).withColumns({"o_orderkey": key + top + 1, "o_orderpriority": F.lit("new")})
    )
    rewritten = stored.upsert(new, ["o_orderkey"], ["o_totalprice"], "o_totalprice")
    return stored.read().withColumns({"rewritten": F.lit(len(rewritten)), "ranges": F.lit(len(ranges))})


@register("diff_by_digest", f"""
WITH a AS ({_A_ROWS}), b AS ({_A_ROWS_CHANGED})
SELECT o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'changed' END AS difference,
  CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'price' END AS columns,
  a.price AS a_price, b.price AS b_price, a.urgency AS a_urgency, b.urgency AS b_urgency
FROM a FULL JOIN b USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.price IS DISTINCT FROM b.price""")
def _diff_by_digest(spark, d):
    """Two versions of the orders that differ in the last hundredth and in what came after."""
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("urgency")).dropDuplicates(["o_orderkey"])
    top, key = orders.agg(F.max("o_orderkey")).scalar(), F.col("o_orderkey")
    root = f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}"
    one, two = (KeyedTable(spark, f"{root}/{n}", "o_orderkey", WIDTH) for n in "ab")
    one.create(orders.filter(1000 * key <= 999 * top))
    two.create(orders.filter(1000 * key != 995 * top).withColumn("price", F.when((100 * key > 99 * top) & (key % 7 == 0), F.col("price") + 1).otherwise(F.col("price"))))
    return diff.keyed_diff(one, two, ["o_orderkey"], ["price", "urgency"])


_RUNS: dict[tuple, DayTables] = {}


def _yesterday(spark, d: str, names: list[str]) -> DayTables:
    """Tables that stand at the day before and have not seen the day's observations; only those that lead to the named ones."""
    full, yesterday = reports(spark, d), dt.date.fromisoformat(AS_OF) - dt.timedelta(days=1)
    rec, made = full.rec, led_by(names)
    earlier = Reports(rec.replace(obs=rec.obs.filter(F.col("date_created") < F.lit(AS_OF).cast("date").cast("timestamp_ntz"))), yesterday, Warehouse(spark))
    t = earlier.table
    tables = DayTables(rec, f"{shared_folder(spark)}/day-{uuid.uuid4().hex}", width_for(rec.patient), names)
    with ThreadPoolExecutor(2) as pool:  # the two runs side by side
        runs = [pool.submit(full.run, read_by(names) + ["status_history"] * ("status_history" in made), at_once=3)]
        if "infants" in made:
            state = ["patient", "patient_dispensing", "patient_laboratory", "patient_on_arv", "discontinuation_reason"]
            runs.append(pool.submit(earlier.run, state, at_once=3))
        for run in runs:
            run.result()
    infants = standing = None
    if "infants" in made:
        infants = inc.infants_of_day(earlier.rec, t("encounter_context"), t("patient"), t("patient_dispensing"), t("patient_laboratory"), yesterday)
    if "standing" in made:
        standing = tables.standing(earlier.rec, t("encounter_context"), t("patient"), t("patient_on_arv"), t("discontinuation_reason"), yesterday)
    history = full.table("status_history") if "status_history" in made else None
    tables.start({n: full.table(n) for n in read_by(names)}, history, yesterday, infants=infants, standing=standing)
    return tables


def after_a_day(spark, d: str, name: str, streamed: bool = False) -> DayTables:
    """The tables that lead to the named one, after a run over the patients that the day's observations affect, given at once or as a stream."""
    key = (spark.sparkContext.applicationId, d, name, streamed)
    if key not in _RUNS:
        today, tables = dt.date.fromisoformat(AS_OF), _yesterday(spark, d, [name])
        if streamed:
            query = stream.start_day_tables(obs_stream(spark, d), tables, f"{tables.root}/stream", days=lambda batch: [today], available_now=True)
            query.awaitTermination()
        else:
            tables.run(inc.obs_of_day(reports(spark, d).rec.obs, today), today)
        _RUNS[key] = tables
    return _RUNS[key]


for _name, _made, _text in (
    ("delta_exposed_infants", "infants", "infants_day"),
    ("delta_statuses", "statuses", "statuses_day"),
    ("delta_status_history", "status_history", "history_day"),
    ("delta_laboratory", "patient_laboratory", "lab_day"),
    ("delta_patients", "patient", "patients_day"),
    ("delta_regimens", "regimens", "regimens_day"),
    ("delta_virology", "virological_tests", "virology_day"),
):
    register(_name, _text)(lambda spark, d, made=_made: _read(after_a_day(spark, d, made), made))


def _read(tables: DayTables, name: str):
    return tables.statuses if name == "statuses" else tables.history.read() if name == "status_history" else tables.table[name].read()


register("stream_delta_statuses", "statuses_day")(lambda spark, d: after_a_day(spark, d, "statuses", streamed=True).statuses)
