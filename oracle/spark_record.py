"""The recast record for Spark: written once per application and folder, then read as source tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from medloom.plans.reports import Reports
from medloom.sources.record import RECORD_TABLES, Record, load_record, parquet_reader
from medloom.sources.schemas import SOURCE_SCHEMAS
from medloom.sources.warehouse import STORED, Warehouse, shared_folder
from oracle.recast import AS_OF, CODES, TABLES

_BASE = ("orders", "customer", "nation")
#: Orders that a task turns into observations and sorts: about a million rows of 200 bytes, which fit its memory.
ORDERS_A_TASK = 25_000
#: Rules ask for few concepts: rows are ordered so that the scan skips the others. Concept and encounter make one number,
#: which sorts without looking at the rows; ids too large for that only order the rows less well.
BY_CONCEPT = "shiftleft(concept_id, 40) + encounter_id"
_DONE: dict[tuple[str, str], str] = {}
_REPORTS: dict[tuple[str, str], Reports] = {}


def _spark_text(table: str) -> str:
    return TABLES[table].replace("TIMESTAMP_AS_OF", f"TIMESTAMP_NTZ '{AS_OF} 00:00:00'")


def tasks_for(orders: int, cores: int) -> int:
    """Tasks among which to deal out the orders: every core gets one, and none has to spill what it sorts."""
    return max(cores, -(-orders // ORDERS_A_TASK))


def stage(spark: SparkSession, sf_dir: str) -> str:
    """Write the record's tables as Parquet under the shared folder; returns their root."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DONE:
        root = f"{shared_folder(spark)}/recast-{spark.sparkContext.applicationId}-{len(_DONE)}"
        views = spark.newSession()  # its own temporary views
        for t in _BASE:
            base = views.read.parquet(f"{sf_dir}/{t}.parquet")
            if t == "orders":
                # Each order becomes dozens of observations: spread the orders before they grow, over as many tasks as they need.
                base = base.repartition(tasks_for(base.count(), spark.sparkContext.defaultParallelism), "o_orderkey")
            base.createOrReplaceTempView(t)
        for t in ("encounter", "form_template"):
            views.sql(_spark_text(t)).createOrReplaceTempView(t)

        def write(t: str) -> None:
            df = views.sql(_spark_text(t))
            if t in SOURCE_SCHEMAS:
                fields = [f.strip().split(" ") for f in SOURCE_SCHEMAS[t].split(",")]
                df = df.selectExpr(*[f"CAST({n} AS {k}) AS {n}" for n, k in fields])
            if t == "obs":
                df = df.sortWithinPartitions(F.expr(BY_CONCEPT))
            df.write.options(**STORED).parquet(f"{root}/{t}")

        # The observations first, which take most of the time; the other tables beside them.
        with ThreadPoolExecutor(3) as pool:
            list(pool.map(write, sorted((t for t in TABLES if t != "form_template"), key=lambda t: t != "obs")))
        _DONE[key] = root
    return _DONE[key]


def record(spark: SparkSession, sf_dir: str) -> Record:
    return load_record(parquet_reader(spark, stage(spark, sf_dir)), CODES)


def reports(spark: SparkSession, sf_dir: str) -> Reports:
    """The report run over the recast record; its shared tables are kept for the application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REPORTS or _REPORTS[key].rec.spark is not spark:
        _REPORTS[key] = Reports(record(spark, sf_dir), AS_OF, Warehouse(spark))
    return _REPORTS[key]


__all__ = ["RECORD_TABLES", "record", "reports", "stage"]
