"""Queries for the operators themselves, mostly on the driver's tables as they are."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions import scalars as fn
from medloom.operators import diff, match, merge, pick
from medloom.operators.eav import count_codes
from medloom.plans import alerts as al, immunisation, regimens as rg, status as st
from medloom.plans.increment import state_of
from medloom.plans.jobs import JOBS
from medloom.plans.pharmacy import still_on_arv
from medloom.plans.reports import Reports
from medloom.sources.codes import Codes
from medloom.sources.dimensions import dimension, rows as dimension_rows
from medloom.sources.record import DICTIONARY_TABLES, created_on, parquet_reader, snapshot
from medloom.sources.warehouse import Warehouse, shared_folder
from medloom.streaming import increment as stream
from oracle.compose import sql
from oracle.marts_sql import TODAY, c
from oracle.recast import AS_OF, CATALOGUE, IDS
from oracle.registry import ORACLES, STATE, _rule, register
from oracle.spark_record import reports, stage

SPLIT = "2000-01-01"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ------------------------------------------------------------------------------------- scans and sources
STATUS_CONCEPTS = [1030, 844, 1401, 161555, 1667, 856, 1305, 1282, 159367]
PRUNED = ["obs_id", "person_id", "encounter_id", "concept_id", "value_coded", "value_numeric", "value_datetime",
          "obs_datetime", "obs_group_id", "location_id", "voided"]
_rule(
    "snapshot_obs",
    f"SELECT {', '.join(PRUNED)} FROM obs WHERE concept_id IN ({', '.join(map(str, STATUS_CONCEPTS))}, {c('ddp')}) AND voided <> 1",
    lambda r: snapshot(r.rec.obs, STATUS_CONCEPTS + r.rec.codes.concept("ddp"), PRUNED, "not_voided"),
)
_rule(
    "snapshot_grouped_obs", "SELECT concept_id, count(*) AS n FROM obs WHERE obs_group_id IS NOT NULL GROUP BY 1",
    lambda r: snapshot(r.rec.obs, grouped_only=True).groupBy("concept_id").agg(F.count("*").alias("n")),
)
_rule(
    "snapshot_encounters", "SELECT encounter_id, patient_id, visit_id, encounter_type, encounter_datetime, voided FROM encounter WHERE voided <> 1",
    lambda r: snapshot(r.rec.encounter, columns=["encounter_id", "patient_id", "visit_id", "encounter_type", "encounter_datetime", "voided"], not_void="not_voided"),
)
_rule(
    "patients_created_on_day", f"SELECT patient_id FROM patient WHERE date_created::DATE = {TODAY}",
    lambda r: created_on(r.rec.patient, r.as_of).select("patient_id"),
)


@register("resolve_codes", "SELECT t.name, count(*) AS encounters FROM encounter n JOIN encounter_type t ON t.encounter_type_id = n.encounter_type GROUP BY 1")
def _resolve_codes(spark, d):
    read = parquet_reader(spark, stage(spark, d))
    codes = Codes.resolve(**{kind: read(t) for kind, t in DICTIONARY_TABLES.items()})
    assert codes.ids == {k: {n: IDS[k][n] for n in CATALOGUE[k]} for k in CATALOGUE}
    names = {i: n for n in CATALOGUE["encounter_type"] for i in codes.encounter(n)}
    return read("encounter").filter(F.col("encounter_type").isin(*names)).groupBy(
        fn.labels("encounter_type", names).alias("name")
    ).agg(F.count("*").alias("encounters"))


# ------------------------------------------------------------------------------------------- dimensions
_labels = ", ".join(f"({r[0]}, '{r[1]}', '{r[2]}')" for r in dimension_rows("arv_status"))
_rule(
    "status_labels", f"SELECT id_status, name_en, name_fr, count(*) AS patients FROM statuses JOIN (VALUES {_labels}) AS t(id, name_en, name_fr) ON id = id_status GROUP BY ALL",
    lambda r: r.table("statuses").join(
        dimension(r.rec.spark, "arv_status"), F.col("id") == F.col("id_status")
    ).groupBy("id_status", "name_en", "name_fr").agg(F.count("*").alias("patients")),
)
_alerts = ", ".join(f"({r[0]}, '{r[1]}', '{r[2]}')" for r in dimension_rows("alert_lookup"))
_rule(
    "alert_labels", f"SELECT id_alert, message_en, message_fr, count(*) AS n FROM alerts LEFT JOIN (VALUES {_alerts}) AS t(id, message_en, message_fr) ON id = id_alert GROUP BY ALL",
    lambda r: al.labelled(
        r.table("alerts").groupBy("id_alert").agg(F.count("*").alias("n")), dimension(r.rec.spark, "alert_lookup")
    ),
)
_text = lambda v: "'" + str(v).replace("'", "''") + "'"
_drugs = ", ".join(f"({r[2]}, {_text(r[4])}, {_text(r[5])})" for r in dimension_rows("drug_lookup") if r[2])
_rule(
    "drug_use", f"SELECT drug_id, label, drug_group, count(*) AS n FROM patient_dispensing JOIN (VALUES {_drugs}) AS t(concept_id, label, drug_group) ON concept_id = drug_id GROUP BY ALL",
    lambda r: r.table("patient_dispensing").join(
        dimension(r.rec.spark, "drug_lookup"), F.col("concept_id") == F.col("drug_id")
    ).groupBy("drug_id", "label", "drug_group").agg(F.count("*").alias("n")),
)
_rule(
    "vaccine_use", "SELECT v.id, v.vaccine_name, v.vaccine_concept_id, count(i.patient_id) AS n FROM vaccine_dictionary v LEFT JOIN patient_immunization i USING (vaccine_concept_id) GROUP BY ALL",
    lambda r: immunisation.vaccines(r.rec).join(
        r.table("patient_immunization").groupBy("vaccine_concept_id").agg(F.count("*").alias("n")), "vaccine_concept_id", "left"
    ).na.fill(0, ["n"]).select("id", "vaccine_name", "vaccine_concept_id", "n"),
)


# ----------------------------------------------------------------------------------- writes and merges
def _customer_orders(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("cust"), "o_orderkey", "o_orderdate", F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("urgency"),
    )


def _state(orders: DataFrame) -> DataFrame:
    return pick.latest_per_key(orders, "cust", ["o_orderdate", "o_orderkey"], ties="one").select(
        "cust", "price", "state", "urgency"
    )


_OLD = f"""SELECT o_custkey AS cust, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS state,
  arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS urgency FROM orders WHERE o_orderdate < DATE '{SPLIT}' GROUP BY 1"""


@register("upsert", f"""
WITH old AS ({_OLD}), n AS (SELECT o_custkey AS cust, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS p1, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS sz,
  arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS u1, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS uz FROM orders WHERE o_orderdate >= DATE '{SPLIT}' GROUP BY 1)
SELECT cust, coalesce(price, p1) AS price, coalesce(sz, state) AS state, coalesce(uz, urgency) AS urgency FROM old FULL JOIN n USING (cust)""")
def _upsert(spark, d):
    orders = _customer_orders(spark, d)
    old, new = orders.filter(F.col("o_orderdate") < SPLIT), orders.filter(F.col("o_orderdate") >= SPLIT)
    return merge.upsert(
        _state(old), new, ["cust"], ["state", "urgency"], ["o_orderdate", "o_orderkey"], drop=("o_orderdate", "o_orderkey")
    )


@register("upsert_keep_first", f"""
WITH old AS ({_OLD}), n AS (SELECT o_custkey AS cust, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS p, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS s,
  arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS u FROM orders WHERE o_orderdate >= DATE '{SPLIT}' GROUP BY 1)
SELECT cust, coalesce(price, p) AS price, coalesce(state, s) AS state, coalesce(urgency, u) AS urgency FROM old FULL JOIN n USING (cust)""")
def _upsert_keep_first(spark, d):
    orders = _customer_orders(spark, d)
    old, new = orders.filter(F.col("o_orderdate") < SPLIT), orders.filter(F.col("o_orderdate") >= SPLIT)
    return merge.upsert(_state(old), new, ["cust"], [], ["o_orderdate", "o_orderkey"], drop=("o_orderdate", "o_orderkey"))


@register("update_from_join", """
WITH l AS (SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS p, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders GROUP BY 1)
SELECT c_custkey, c_mktsegment, CASE WHEN l.p IS NULL THEN c_acctbal ELSE l.p END AS c_acctbal, l.s AS last_status FROM customer LEFT JOIN l ON o_custkey = c_custkey""")
def _update_from(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return merge.update_from(
        customers, orders, ["c_custkey"], {"c_acctbal": "o_totalprice", "last_status": "o_orderstatus"}, ["o_orderdate", "o_orderkey"]
    )


@register("update_where", "SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_totalprice > 250000 THEN round(o_totalprice / 2, 1) ELSE o_totalprice END AS o_totalprice FROM orders")
def _update_where(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return merge.update_where(
        orders, F.col("o_totalprice") > 250000, o_orderstatus=F.lit("X"), o_totalprice=F.round(F.col("o_totalprice") / 2, 1)
    )


_DISCOUNTED = "SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40"


def _returned(spark, d):
    return table(spark, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40)).select(
        F.col("l_orderkey").alias("o_orderkey")
    )


@register("delete_by_join", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN ({_DISCOUNTED})")
def _delete(spark, d):
    return merge.delete_matching(table(spark, d, "orders").select("o_orderkey", "o_custkey"), _returned(spark, d), ["o_orderkey"])


@register("keep_by_join", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN ({_DISCOUNTED})")
def _keep(spark, d):
    return merge.keep_matching(table(spark, d, "orders").select("o_orderkey", "o_custkey"), _returned(spark, d), ["o_orderkey"])


@register("warehouse_writes", f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, CASE WHEN o_orderdate >= DATE '{SPLIT}' THEN o_totalprice * 2 ELSE o_totalprice END AS price, NULL::VARCHAR AS note FROM orders""")
def _warehouse(spark, d):
    """Create, append, snapshot, replace a day's partition, upsert, restore, drop, replace by predicate."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy").alias("year"), F.col("o_totalprice").alias("price")
    )
    recent = F.col("year") >= SPLIT[:4]
    store = Warehouse(spark)
    store.write("orders", orders.filter(~recent), sort_within=["o_orderkey"])
    store.append("orders", orders.filter(recent))
    saved = store.snapshot(["orders"])
    store.upsert("orders", orders.withColumn("price", F.lit(0.0)), ["o_orderkey"], ["price"], "o_orderkey")
    store.restore(saved)
    store.write("by_year", store.read("orders"), partition_by=["year"])
    store.replace_partition("by_year", store.read("orders").filter(recent).withColumn("price", F.col("price") * 2), "year")
    both = store.read("by_year").select("o_orderkey", F.col("year").cast("string").alias("year"), "price")
    out = store.replace_where("orders", ~recent, both.filter(recent))
    store.drop("by_year")
    assert "by_year" not in store
    return merge.ensure_column(out, "note", "string")


_rule(
    "still_on_arv", "SELECT * FROM patient_on_arv",
    # As many patients again who never got a drug: all of them must go.
    lambda r: still_on_arv(
        r.table("patient_on_arv").unionByName(r.table("patient_on_arv").withColumn("patient_id", F.col("patient_id") + 1_000_000)),
        r.table("patient_dispensing")),
)
_rule(
    "legacy_import", f"""
WITH l AS (SELECT p.patient_id, max(patientstatus) AS id_status, insertdate FROM legacy_status JOIN patient_mart p ON p.legacy_id = patientid
  WHERE insertdate::DATE >= DATE '2001-06-01' AND patientstatus > 0 GROUP BY p.patient_id, insertdate)
SELECT patient_id, id_status, start_date, encounter_id, dis_reason, date_started_status FROM statuses
UNION ALL
SELECT patient_id, id_status, insertdate::DATE, NULL, NULL, insertdate::DATE FROM l WHERE NOT EXISTS (FROM statuses s
  WHERE s.patient_id = l.patient_id AND s.id_status = l.id_status AND s.start_date = l.insertdate::DATE AND s.date_started_status = l.insertdate::DATE)""",
    lambda r: st.import_legacy(
        r.table("statuses"),
        r.rec.spark.read.parquet(f"{_ROOT(r)}/legacy_status").toDF("patientID", "patientStatus", "insertDate"),
        r.table("patient"), "2001-06-01",
    ),
)


# The jobs a scheduler calls, each on a warehouse of its own.
for _job, _text, _call in (
    ("status_history", "statuses", lambda r, s: JOBS["status_history"](r.rec, r.as_of, s)),
    ("diagnosis", "patient_diagnosis", lambda r, s: JOBS["diagnosis"](r.rec, r.as_of, s)),
    ("report_indicators", "indicators", lambda r, s: JOBS["report_indicators"](r.rec, r.as_of, s)),
    ("daily_run", "regimens_day", lambda r, s: _after_day(r, s).read("regimens")),
    ("full_load", "alerts", lambda r, s: JOBS["full_load"](r.rec, r.as_of, s)["alerts"]),
):
    _rule(f"job_{_job}", _text, lambda r, call=_call: call(r, Warehouse(r.rec.spark)))


def _after_day(r, store):
    """A warehouse with the tables the day's run needs, after the run."""
    for name in STATE:
        store.write(name, r.table(name))
    JOBS["daily_run"](r.rec, r.as_of, store)
    return store


def _ROOT(r):
    return stage(r.rec.spark, next(d for (app, d), v in _reports().items() if v is r))


def _reports():
    from oracle import spark_record

    return spark_record._REPORTS


_rule(
    "merge_status_history", f"""
SELECT patient_id, id_status, start_date, encounter_id, dis_reason, {TODAY} - 1 AS date_started_status FROM statuses
UNION ALL SELECT * FROM statuses""",
    lambda r: st.merge_history(
        r.table("statuses").withColumn("date_started_status", F.date_sub("date_started_status", 1)).unionByName(
            r.table("statuses").withColumn("id_status", F.lit(99))),
        r.table("statuses"), r.as_of),
)
#: The day of an earlier run.
EARLIER = "2001-06-15"


@register("two_day_history")
def _two_days(spark, d):
    """Two full runs on one warehouse: the statuses of both days, without patients found to be exposed infants since."""
    rec, store = reports(spark, d).rec, Warehouse(spark)
    Reports(rec, EARLIER, store).table("status_history")
    return Reports(rec, AS_OF, store).table("status_history")


ORACLES["two_day_history"] = f"""
SELECT * FROM ({sql("statuses").replace(TODAY, f"DATE '{EARLIER}'")}) WHERE patient_id NOT IN (SELECT patient_id FROM ({sql("exposed_infants")}))
UNION ALL SELECT * FROM ({sql("statuses")})"""

_rule(
    "merge_regimens", """
SELECT r.* FROM regimens r""",
    lambda r: rg.merge_regimens(
        # Half of the rows are missing, and every day with a voided prescription has one too many.
        r.table("regimens").filter("patient_id % 2 = 0").unionByName(_withdrawn(r)),
        r.table("patient_prescription"), r.table("regimens")),
)


def _withdrawn(r):
    """A regimen on each day of a voided prescription."""
    days = r.table("patient_prescription").filter("voided = 1").select("patient_id", "location_id", F.to_date("visit_date").alias("visit_date")).distinct()
    table_ = r.table("regimens")
    extra = [
        F.col(c).cast(t).alias(c) if c in days.columns else F.lit("withdrawn" if c == "regimen" else None).cast(t).alias(c) for c, t in table_.dtypes
    ]
    return days.select(*extra)


# ------------------------------------------------------------------------------------------------ picks
_O = "o_custkey, o_orderkey, o_orderdate"


@register("latest_all_ties", f"SELECT {_O} FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1")
def _latest_all(spark, d):
    return pick.latest_per_key(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", "o_orderdate")


@register("latest_one", f"SELECT {_O} FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _latest_one(spark, d):
    return pick.latest_per_key(
        table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], ties="one"
    )


@register("first_one", f"SELECT {_O} FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def _first_one(spark, d):
    return pick.first_per_key(
        table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], ties="one"
    )


@register("second_latest", "SELECT DISTINCT o_custkey, o_orderdate FROM orders QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 2")
def _second(spark, d):
    return pick.nth_latest(table(spark, d, "orders"), "o_custkey", "o_orderdate", 2)


@register("latest_except_overall", "SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders WHERE o_orderdate <> (SELECT max(o_orderdate) FROM orders) GROUP BY 1")
def _except(spark, d):
    return pick.latest_except_overall(table(spark, d, "orders"), "o_custkey", "o_orderdate")


# ------------------------------------------------------------------------------------- joins and matching
@register("range_match_next", "SELECT o_orderkey, o_custkey, (SELECT min(n.o_orderdate::DATE) FROM orders n WHERE n.o_custkey = o.o_custkey AND n.o_orderdate > o.o_orderdate) AS next_order FROM orders o")
def _next_order(spark, d):
    orders = table(spark, d, "orders")
    return match.match_next(
        orders.select("o_orderkey", "o_custkey", "o_orderdate"), orders, "o_custkey", "o_orderdate", "o_orderdate", name="next_order"
    ).select("o_orderkey", "o_custkey", "next_order")


@register("range_match_payload", """
SELECT o_orderkey, s.d AS shipped, s.q AS quantity FROM orders o LEFT JOIN LATERAL (
  SELECT l_shipdate::DATE AS d, min(l_quantity) AS q FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate::DATE >= o.o_orderdate::DATE GROUP BY 1 ORDER BY 1 LIMIT 1) s ON TRUE""")
def _next_shipment(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", F.col("l_quantity").alias("quantity"))
    return match.match_next(
        table(spark, d, "orders").select("o_orderkey", "o_orderdate"), lines, "o_orderkey", "o_orderdate", "l_shipdate",
        inclusive=True, payload="quantity", name="shipped",
    ).select("o_orderkey", "shipped", "quantity")


@register("left_lookup", "SELECT o_orderkey, n_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey")
def _left_lookup(spark, d):
    customers = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return table(spark, d, "orders").join(customers, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "o_orderkey", "n_name", "c_mktsegment"
    )


@register("nested_exists", """
SELECT c_custkey FROM customer c WHERE NOT EXISTS (FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT'
  AND EXISTS (FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R'))""")
def _nested_exists(spark, d):
    urgent = table(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    returned = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.delete_matching(
        table(spark, d, "customer").select("c_custkey"), merge.keep_matching(urgent, returned, ["o_orderkey"]), ["c_custkey"]
    )


@register("pair_in_group", "SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag = 'R') AND bool_or(l_returnflag = 'A')")
def _pair(spark, d):
    marks = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.col("l_returnflag") == "R").alias("r"), F.max(F.col("l_returnflag") == "A").alias("a")
    )
    return marks.filter("r AND a").select("l_orderkey")


# ----------------------------------------------------------------------------------------- aggregations
@register("code_counts", """
SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber = 1) AS n1, count(*) FILTER (WHERE l_linenumber IN (2, 3)) AS n23,
  count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity > 25) AS big_returns FROM lineitem GROUP BY 1""")
def _code_counts(spark, d):
    return count_codes(
        table(spark, d, "lineitem"), ["l_orderkey"],
        {"n1": F.col("l_linenumber") == 1, "n23": F.col("l_linenumber").isin(2, 3),
         "big_returns": (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)},
    )


@register("count_having", "SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) <= 1")
def _count_having(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n")).filter("n <= 1")


@register("priority_label", "SELECT o_custkey, CASE min(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END) WHEN 1 THEN 'URGENT' WHEN 2 THEN 'HIGH' ELSE 'OTHER' END AS level FROM orders GROUP BY 1")
def _priority(spark, d):
    rank = F.coalesce(fn.labels("o_orderpriority", {"1-URGENT": 3, "2-HIGH": 2}), F.lit(1))
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max(rank).alias("r")).select(
        "o_custkey", fn.labels("r", {3: "URGENT", 2: "HIGH", 1: "OTHER"}).alias("level")
    )


@register("pivot_columns", """
SELECT o_custkey, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS "F", max(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS "O",
  max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _pivot(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.max("o_totalprice"))


@register("sorted_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _limit(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


# --------------------------------------------------------------------------------------------- scalars
_A = f"DATE '{AS_OF}'"


@register("whole_units", f"""
SELECT o_orderkey,
  (date_part('year', {_A}) - date_part('year', d)) - CASE WHEN (date_part('month', {_A}), date_part('day', {_A})) < (date_part('month', d), date_part('day', d)) THEN 1 ELSE 0 END AS years,
  (date_part('year', {_A}) - date_part('year', d)) * 12 + date_part('month', {_A}) - date_part('month', d) - CASE WHEN date_part('day', {_A}) < date_part('day', d) THEN 1 ELSE 0 END AS months,
  {_A} - d AS days, ({_A} - d) * 86400000000 AS microseconds FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def _units(spark, d):
    today = F.lit(AS_OF).cast("date")
    return table(spark, d, "orders").select(
        "o_orderkey", fn.whole_units("YEAR", "o_orderdate", today).alias("years"),
        fn.whole_units("MONTH", "o_orderdate", today).alias("months"), fn.days_between(today, "o_orderdate").alias("days"),
        fn.whole_units("MICROSECOND", "o_orderdate", today).alias("microseconds"),
    )


@register("date_arithmetic", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate::DATE + l_linenumber * 10 AS by_days, (l_shipdate::DATE + to_months(l_linenumber))::DATE AS by_months,
  (l_shipdate::DATE - INTERVAL 9 MONTH)::DATE AS nine_before, (((l_shipdate::DATE - INTERVAL 3 MONTH)::DATE + 7) + INTERVAL 1 YEAR)::DATE AS due FROM lineitem""")
def _dates(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.add_days("l_shipdate", F.col("l_linenumber") * 10).alias("by_days"),
        fn.add_months("l_shipdate", "l_linenumber").alias("by_months"), fn.add_months("l_shipdate", -9).alias("nine_before"),
        F.add_months(F.date_add(F.add_months(fn.day("l_shipdate"), -3), 7), 12).alias("due"),
    )


@register("number_rules", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_quantity / 4) AS INT) AS rounded, round(l_extendedprice / (l_quantity / 100 * l_quantity / 100), 1) AS index,
  CASE WHEN l_quantity / 4 = floor(l_quantity / 4) THEN CAST(CAST(l_quantity / 4 AS BIGINT) AS VARCHAR) ELSE CAST(l_quantity / 4 AS VARCHAR) END AS text FROM lineitem""")
def _numbers(spark, d):
    quarter = F.col("l_quantity") / 4
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.round_int(quarter).alias("rounded"),
        fn.bmi("l_extendedprice", "l_quantity", 1).alias("index"), fn.number_text(quarter).alias("text"),
    )


@register("text_as_number", """
SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS DOUBLE) AS level, 0.0 AS state FROM orders WHERE CAST(left(o_orderpriority, 1) AS INT) > 2""")
def _text_number(spark, d):
    return table(spark, d, "orders").filter(fn.mysql_num("o_orderpriority") > 2).select(
        "o_orderkey", fn.mysql_num("o_orderpriority").alias("level"), fn.mysql_num("o_orderstatus").alias("state")
    )


@register("typed_values", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END, CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_totalprice = floor(o_totalprice)
  THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END END, o_orderpriority) AS value,
  CASE WHEN o_orderstatus = 'F' AND o_custkey <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END AS nonzero FROM orders""")
def _typed(spark, d):
    coded = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    numeric = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
    return table(spark, d, "orders").select(
        "o_orderkey", fn.typed_value(coded, numeric, "o_orderpriority").alias("value"),
        fn.typed_value(coded, numeric * 0, "o_orderpriority", skip_zero=True).alias("nonzero"),
    )


# ------------------------------------------------------------------------------------------------ diff
# The second version of the orders: early ones are gone, large ones have another price, finished ones no priority.
_B = f"SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS urgency FROM orders WHERE o_orderdate >= DATE '1996-01-01'"
_A_ROWS = "SELECT o_orderkey, o_totalprice AS price, o_orderpriority AS urgency FROM orders WHERE o_orderdate < DATE '2001-01-01'"


def _versions(spark, d):
    orders = table(spark, d, "orders")
    a = orders.filter(F.col("o_orderdate") < "2001-01-01").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("urgency")
    )
    b = orders.filter(F.col("o_orderdate") >= "1996-01-01").select(
        "o_orderkey", F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("urgency"),
    )
    return a, b


_AB = f"WITH a AS ({_A_ROWS}), b AS ({_B})"


@register("diff_keys", f"{_AB} SELECT o_orderkey, 'a' AS side FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b) UNION ALL SELECT o_orderkey, 'b' FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)")
def _diff_keys(spark, d):
    return diff.keys_apart(*_versions(spark, d), ["o_orderkey"])


@register("diff_values", f"""
{_AB} SELECT o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'changed' END AS difference,
  CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN concat_ws(',', CASE WHEN a.price IS DISTINCT FROM b.price THEN 'price' END, CASE WHEN a.urgency IS DISTINCT FROM b.urgency THEN 'urgency' END) END AS columns,
  a.price AS a_price, b.price AS b_price, a.urgency AS a_urgency, b.urgency AS b_urgency
FROM a FULL JOIN b USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.price IS DISTINCT FROM b.price OR a.urgency IS DISTINCT FROM b.urgency""")
def _diff_values(spark, d):
    return diff.table_diff(*_versions(spark, d), ["o_orderkey"], ["price", "urgency"])


@register("diff_attribute", f"{_AB} SELECT o_orderkey, a.price AS a_price, b.price AS b_price FROM a JOIN b USING (o_orderkey) WHERE a.price <> b.price")
def _diff_attribute(spark, d):
    return diff.attribute_diff(*_versions(spark, d), ["o_orderkey"], "price")


@register("diff_rows", f"{_AB} (SELECT *, 'a' AS side FROM (FROM a EXCEPT ALL FROM b)) UNION ALL (SELECT *, 'b' FROM (FROM b EXCEPT ALL FROM a))")
def _diff_rows(spark, d):
    return diff.row_diff(*_versions(spark, d))


@register("diff_counts", f"{_AB} SELECT 'orders' AS table_name, (SELECT count(*) FROM a) AS rows_a, (SELECT count(*) FROM b) AS rows_b, (SELECT count(*) FROM a) - (SELECT count(*) FROM b) AS difference UNION ALL SELECT 'customer', count(*), count(*), 0 FROM customer")
def _diff_counts(spark, d):
    customers = table(spark, d, "customer")
    return diff.count_summary({"orders": _versions(spark, d), "customer": (customers, customers)})


@register("diff_by_type", f"{_AB}, x AS (SELECT urgency, count(*) AS n FROM a GROUP BY 1), y AS (SELECT urgency, count(*) AS n FROM b WHERE urgency IS NOT NULL GROUP BY 1) SELECT urgency, coalesce(x.n, 0) AS rows_a, coalesce(y.n, 0) AS rows_b, coalesce(x.n, 0) - coalesce(y.n, 0) AS difference FROM x FULL JOIN y USING (urgency)")
def _diff_by_type(spark, d):
    a, b = _versions(spark, d)
    return diff.count_by(a, b.filter(F.col("urgency").isNotNull()), "urgency")


# ------------------------------------------------------------------------------------------- streaming
def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    events = spark.readStream.schema(table(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return events.select(
        F.col("event_id").alias("obs_id"), F.col("user_id").alias("person_id"), F.col("event_type").alias("concept"),
        F.col("value").alias("value_numeric"), "ts",
    )


@register("stream_daily_counts", "SELECT ts::DATE AS day, event_type AS concept, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _stream_daily(spark, d):
    store = Warehouse(spark)
    counts = stream.daily_counts(_event_stream(spark, d), "ts", "concept")
    stream.start_upsert(
        counts, store, "daily", ["day", "concept"], ["n", "total"], "n", f"{store.root}/stream", available_now=True, mode="update"
    ).awaitTermination()
    return store.read("daily").withColumn("total", F.round("total", 4))


@register("stream_distinct_rows", "SELECT event_type AS concept, count(*) AS n FROM events GROUP BY 1")
def _stream_distinct(spark, d):
    """Every event is delivered twice and kept once."""
    store = Warehouse(spark)
    once = _event_stream(spark, d)
    twice = stream.distinct_rows(once.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy"), "ts", "40 days")
    stream.start_upsert(
        twice, store, "events", ["obs_id"], [], "ts", f"{store.root}/stream", available_now=True
    ).awaitTermination()
    return store.read("events").groupBy("concept").agg(F.count("*").alias("n"))


@register("stream_late_edits", """
SELECT event_id AS obs_id, event_type AS concept, CASE WHEN value > 80 THEN 2 * value WHEN value > 50 THEN -1.0 ELSE value END AS value_numeric,
  CASE WHEN value > 50 AND value <= 80 THEN 1 ELSE 0 END AS voided FROM events""")
def _stream_edits(spark, d):
    """Rows and up to two edits of each come in three batches in the wrong order; the highest sequence wins."""
    return _edited(spark, d)[0].read().select("obs_id", "concept", "value_numeric", "voided")


@register("stream_high_water", """
SELECT 0 AS batch, max(event_id) AS obs_id, count(*) AS changed FROM events WHERE event_id % 2 = 1 OR value > 50
UNION ALL SELECT 1, max(event_id), count(*) FROM events WHERE value > 80
UNION ALL SELECT 2, max(event_id), count(*) FROM events WHERE event_id % 2 = 0 OR value > 50""")
def _stream_high_water(spark, d):
    """What the three batches of edits held, observed while they were written."""
    return stream.high_waters(spark, _edited(spark, d)[1])


_EDITED: dict = {}


def _edited(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _EDITED:
        _EDITED[key] = _edit_in_three_batches(spark, d)
    return _EDITED[key]


def _edit_in_three_batches(spark, d):
    rows = table(spark, d, "events").select(
        F.col("event_id").alias("obs_id"), F.col("event_type").alias("concept"), F.col("ts").alias("date_created"), F.col("value").alias("value_numeric"),
    )
    value, even = F.col("value_numeric"), F.col("obs_id") % 2 == 0
    edit = lambda n, number, voided, batch: F.struct(F.lit(n).alias("sequence"), number.alias("value_numeric"), F.lit(voided).alias("voided"), batch.alias("batch"))
    edits = rows.withColumn("edit", F.explode(F.filter(F.array(
        edit(0, value, 0, F.when(even, 3).otherwise(1)), edit(1, F.lit(-1.0), 1, F.when(even, 1).otherwise(3)), edit(2, 2 * value, 0, F.lit(2)),
    ), lambda e: (e["sequence"] == 0) | ((e["sequence"] == 1) & (value > 50)) | (value > 80)))).select("obs_id", "concept", "date_created", "edit.*")
    root = f"{shared_folder(spark)}/edits-{uuid.uuid4().hex}"
    for batch in (1, 2, 3):
        edits.filter(F.col("batch") == batch).drop("batch").coalesce(1).write.mode("append").parquet(f"{root}/in")
    arriving = spark.readStream.schema(edits.drop("batch").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    buffer = stream.obs_buffer(spark, root)
    stream.start_buffer(arriving, buffer, f"{root}/stream", "sequence", age="60 days", audit=f"{root}/audit", available_now=True).awaitTermination()
    return buffer, f"{root}/audit"


def obs_stream(spark: SparkSession, d: str) -> DataFrame:
    root = stage(spark, d)
    rows = spark.readStream.schema(spark.read.parquet(f"{root}/obs").schema).parquet(f"{root}/obs")
    return rows.filter(F.col("date_created") >= F.lit(AS_OF).cast("date").cast("timestamp_ntz"))  # the record's earlier days are loaded


_STREAMED: dict[tuple[str, str, str], Warehouse] = {}


def _streamed(spark: SparkSession, d: str, name: str) -> Warehouse:
    """The incremental run up to one table, fed by a stream of the record's observations."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _STREAMED:
        full, store, state = reports(spark, d), Warehouse(spark), state_of([name])
        if state:
            full.run(state, at_once=3)
        for kept in state:
            store.write(kept, full.table(kept))
        stream.start_increment(
            obs_stream(spark, d), full.rec, store, f"{store.root}/stream", days=lambda batch: [dt.date.fromisoformat(AS_OF)],
            available_now=True, names=[name],
        ).awaitTermination()
        _STREAMED[key] = store
    return _STREAMED[key]


for _key, _name, _text in (
    ("stream_day_dispensing", "dispensing_of_day", "dispensing_day"),
    ("stream_day_laboratory", "patient_laboratory", "lab_day"),
    ("stream_day_statuses", "statuses_of_day", "statuses_day"),
    ("stream_day_status_history", "status_history", "history_day"),
):
    register(_key, _text)(lambda spark, d, n=_name: _streamed(spark, d, n).read(n))


@register("stream_indicators", f"""
SELECT first(rule_id ORDER BY rule_id, encounter_id, location_id) AS rule_id, written_type AS indicator_type_id, patient_id,
  first(location_id ORDER BY rule_id, encounter_id, location_id) AS location_id, first(encounter_id ORDER BY rule_id, encounter_id, location_id) AS encounter_id,
  encounter_date AS indicator_date, last(voided ORDER BY rule_id, encounter_id, location_id) AS voided
FROM events_found WHERE encounter_date IS NOT NULL AND encounter_id IN (SELECT encounter_id FROM obs WHERE date_created::DATE = {TODAY}) GROUP BY written_type, patient_id, encounter_date""")
def _stream_indicators(spark, d):
    full, store = reports(spark, d), Warehouse(spark)
    store.write("patient", full.table("patient"))
    stream.start_surveillance(
        obs_stream(spark, d), full.rec, store, f"{store.root}/stream", days=lambda batch: [dt.date.fromisoformat(AS_OF)],
        available_now=True,
    ).awaitTermination()
    return store.read("indicators")
