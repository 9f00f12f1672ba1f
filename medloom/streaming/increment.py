"""The incremental run as a Structured Streaming query.

New and edited observations arrive as a stream in any order. A keyed state holds, per observation, its first
row and its latest edit by sequence; every ten minutes the observations that changed go to the buffer, which
is dealt out by day of entry, and the jobs of the run are repeated over the day's part of it (stream-static:
encounters, visits and history are read as tables). A batch that holds several days, as after an outage, runs
once per day in ascending order. A day's observations leave the state `age` after the newest one seen, and
the buffer `keep` after it; edits that come later are dropped. The state settles every order, so a micro-batch
that is replayed after a failure leaves the same tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medloom.functions.scalars import day
from medloom.operators.merge import upsert
from medloom.plans import shared, surveillance
from medloom.plans.delta import DayTables
from medloom.plans.increment import OBS_EDITS, Day, buffer_obs
from medloom.sources.keyed import KeyedTable
from medloom.sources.record import Record
from medloom.sources.schemas import SOURCE_SCHEMAS
from medloom.sources.warehouse import Warehouse

EVERY = "10 minutes"
#: The state of a stream is kept in RocksDB on the executors' disks, in a bounded part of their memory: as objects it
#: takes several hundred bytes of heap for every observation of the days that can still be edited.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def days_of(batch: DataFrame, ts_col: str = "date_created") -> list[dt.date]:
    """The days of entry in a batch, ascending: a row per day, whatever the size of the batch."""
    days = batch.select(day(ts_col).alias("d")).filter("d IS NOT NULL").distinct()
    return [r["d"] for r in days.orderBy("d").collect()]


def merge_into_buffer(warehouse: Warehouse, name: str, batch: DataFrame, as_of: dt.date, sequence: str) -> DataFrame:
    """The observations entered on a day so far, this batch included; each day has a buffer of its own."""
    table = f"{name}_{as_of:%Y%m%d}"
    buffer = warehouse.read(table) if table in warehouse else None
    return warehouse.write(table, buffer_obs(buffer, batch, as_of, sequence))


#: How long after the newest observation a day's ones can still be edited.
AGE = "7 days"


def latest_edits(obs_stream: DataFrame, sequence: str = "date_created", age: str = AGE) -> DataFrame:
    """Observations as their latest edit leaves them, from a stream of rows and edits in any order.

    The first row by (sequence, values) fills every column, the last one those that an edit may change. Both are
    kept in state by day of entry and observation, with their sequence, until the watermark has passed the day
    by `age`. Rows without a day of entry belong to no run and are left out. For output mode `update`: a batch
    then has the observations that changed, each once and whole. `sequence` is dropped unless observations have it.
    """
    edits = [c for c in OBS_EDITS if c in obs_stream.columns]
    own = [c for c in obs_stream.columns if c != sequence or f"{sequence} " in SOURCE_SCHEMAS["obs"]]
    first = [c for c in own if c not in edits and c != "obs_id"]
    order = F.struct(sequence, *edits)
    stamped = obs_stream.withColumn("_at", F.col("date_created").cast("timestamp")).withWatermark("_at", age)
    kept = stamped.groupBy(F.window("_at", "1 day").alias("_day"), "obs_id").agg(
        F.min_by(F.struct(*first), order).alias("_first"), F.max_by(F.struct(*edits), order).alias("_last")
    )
    return kept.select("obs_id", "_first.*", "_last.*").select(*own)


def obs_buffer(spark: SparkSession, root: str, name: str = "obs_buffer") -> KeyedTable:
    """The observations of late days, dealt out by day of entry."""
    return KeyedTable(spark, f"{root}/{name}", "unix_date(cast(date_created as date))")


def day_number(day_: dt.date) -> int:
    return (day_ - dt.date(1970, 1, 1)).days


def keep_in_buffer(buffer: KeyedTable, batch: DataFrame) -> list[int]:
    """Put observations that `latest_edits` settled into the buffer; returns the days rewritten."""
    return buffer.upsert(batch, ["obs_id"], [c for c in batch.columns if c != "obs_id"], "obs_id")


def start_buffer(
    obs_stream: DataFrame, buffer: KeyedTable, checkpoint: str, sequence: str = "date_created", age: str = AGE,
    after: Callable[[DataFrame], None] | None = None, audit: str | None = None, available_now: bool = False, every: str = EVERY,
) -> StreamingQuery:
    """Keep the buffer up to date with a stream of observations and edits; `after` is called with each batch that
    changes it, and with the first.

    A batch is written once, beside the buffer, and read from there. While it is written it is observed: with
    `audit`, a row per batch goes to that folder (`high_waters` reads it): the highest observation and how many changed.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        seen, spark, path = Observation(f"batch {batch_id}"), buffer.spark, f"{buffer.path}-batch"
        watched = batch.observe(seen, F.max("obs_id").alias("obs_id"), F.count("*").alias("changed"))
        watched.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        settled = spark.read.schema(batch.schema).parquet(path)
        keep_in_buffer(buffer, settled)
        if audit:
            row = spark.createDataFrame([(seen.get["obs_id"], seen.get["changed"])], "obs_id long, changed long")
            row.write.mode("overwrite").parquet(f"{audit}/batch={batch_id}")  # a replayed batch writes its row again
        # A batch without rows, which Spark adds when the watermark has moved, changes no day: its state expires, no job is repeated.
        if after and (seen.get["changed"] or batch_id == 0):
            after(settled)

    return _start(latest_edits(obs_stream, sequence, age), on_batch, checkpoint, available_now, every, "update")


def high_waters(spark: SparkSession, audit: str) -> DataFrame:
    """(batch, obs_id, changed): the audit rows of `start_buffer`."""
    return spark.read.schema("obs_id long, changed long, batch long").parquet(audit).select("batch", "obs_id", "changed")


def _trigger(writer, available_now: bool, every: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)


def _start(stream: DataFrame, on_batch, checkpoint: str, available_now: bool, every: str, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    conf = stream.sparkSession.conf
    own = {key: conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        conf.set(key, value)
    try:
        return _trigger(writer, available_now, every).start()  # takes a copy of the session's settings
    finally:
        for key, value in own.items():
            conf.unset(key) if value is None else conf.set(key, value)


def start_increment(
    obs_stream: DataFrame,
    rec: Record,
    warehouse: Warehouse,
    checkpoint: str,
    days: Callable[[DataFrame], list[dt.date]] = days_of,
    sequence: str = "date_created",
    available_now: bool = False,
    every: str = EVERY,
    keep: dt.timedelta = dt.timedelta(days=1),
    age: str = AGE,
    names: list[str] | None = None,
) -> StreamingQuery:
    """Run the chain of jobs on every micro-batch, or the jobs that lead to the tables `names`.

    `warehouse` holds the report tables of the last full run and receives the new ones. `days` names the
    days of a batch to run, all by default. `sequence` orders edits of one observation, in whatever batches
    they come. Versions of tables that were replaced longer than `keep` ago are removed after a batch, and
    days of the buffer that lie further back than `age` before the newest one.
    """
    buffer = obs_buffer(rec.spark, warehouse.root)

    def after(batch: DataFrame) -> None:
        for as_of in days(batch):
            run = Day(rec, as_of, warehouse.read, warehouse.write)
            run.run(buffer.read([day_number(as_of)]), names)
            for name in run.done:
                warehouse.expire(name, keep)
        expire_days(buffer, age)

    return start_buffer(obs_stream, buffer, checkpoint, sequence, age, after, available_now=available_now, every=every)


def start_day_tables(
    obs_stream: DataFrame, tables: DayTables, checkpoint: str, days: Callable[[DataFrame], list[dt.date]] = days_of,
    sequence: str = "date_created", available_now: bool = False, every: str = EVERY, age: str = AGE,
) -> StreamingQuery:
    """`start_increment` whose work follows the change: each micro-batch recomputes the patients it affects.

    Observations of a day before the one that the tables stand at are judged on that later day.
    """
    buffer = obs_buffer(tables.spark, tables.root)

    def after(batch: DataFrame) -> None:
        for as_of in days(batch):
            tables.run(buffer.read([day_number(as_of)]), max(as_of, tables.day()))
        expire_days(buffer, age)

    return start_buffer(obs_stream, buffer, checkpoint, sequence, age, after, f"{tables.root}/audit", available_now, every)


def expire_days(buffer: KeyedTable, age: str) -> int:
    """Remove the days that lie further back than `age` before the newest one; returns how many."""
    if not buffer.exists():
        return 0
    newest = max(buffer.parts())
    before = buffer.spark.range(1).select(F.floor((F.lit(newest) * 86400 - F.unix_seconds(F.lit(0).cast("timestamp") + F.expr(f"INTERVAL {age}"))) / 86400))
    return buffer.expire(before.first()[0])


def refresh_surveillance(rec: Record, obs: DataFrame, warehouse: Warehouse) -> None:
    """Merge the diagnoses found in some observations, and their indicators, into the report tables."""
    today = rec.replace(obs=obs)
    answers = warehouse.write("diagnosis_answer_of_day", surveillance.diagnosis_answer(today, shared.encounter_context(rec)))
    found = surveillance.patient_diagnosis(today, answers)
    keys = ["encounter_id", "location_id", "concept_group", "concept_id", "answer_concept_id"]
    old = warehouse.read("patient_diagnosis") if "patient_diagnosis" in warehouse else None
    details = ["suspected_confirmed", "primary_secondary", "encounter_date", "voided"]
    diagnosis = warehouse.write("patient_diagnosis", upsert(old, found, keys, details, "obs_group_id"))
    fresh = surveillance.indicators(rec, diagnosis, warehouse.read("patient"))
    warehouse.upsert(
        "indicators", fresh, ["indicator_type_id", "patient_id", "indicator_date"], ["voided"], "rule_id"
    )


def start_surveillance(
    obs_stream: DataFrame, rec: Record, warehouse: Warehouse, checkpoint: str,
    days: Callable[[DataFrame], list[dt.date]] = days_of, sequence: str = "date_created",
    available_now: bool = False, every: str = EVERY, age: str = AGE,
) -> StreamingQuery:
    """Keep diagnoses and indicators up to date with the stream; options as for `start_increment`."""
    buffer = obs_buffer(rec.spark, warehouse.root, "surveillance_buffer")

    def after(batch: DataFrame) -> None:
        for as_of in days(batch):
            refresh_surveillance(rec, buffer.read([day_number(as_of)]), warehouse)
        expire_days(buffer, age)

    return start_buffer(obs_stream, buffer, checkpoint, sequence, age, after, available_now=available_now, every=every)


def daily_counts(obs_stream: DataFrame, ts_col: str, key: str, late: str = "1 day") -> DataFrame:
    """Rows and total value per day and key, in tumbling one-day windows that close `late` after the day."""
    return (
        obs_stream.withColumn("_at", F.col(ts_col).cast("timestamp"))
        .withWatermark("_at", late)
        .groupBy(F.window("_at", "1 day").alias("w"), key)
        .agg(F.count("*").alias("n"), F.sum("value_numeric").alias("total"))
        .select(F.to_date("w.start").alias("day"), key, "n", "total")
    )


def distinct_rows(obs_stream: DataFrame, ts_col: str, late: str = "1 day") -> DataFrame:
    """Each observation once, for sources that deliver immutable rows more than once."""
    stamped = obs_stream.withColumn("_at", F.col(ts_col).cast("timestamp")).withWatermark("_at", late)
    return stamped.dropDuplicatesWithinWatermark(["obs_id"]).drop("_at")


def start_upsert(
    stream: DataFrame, warehouse: Warehouse, table: str, keys: list[str], update_cols: list[str], order_by,
    checkpoint: str, drop: tuple[str, ...] = (), available_now: bool = False, every: str = EVERY,
    mode: str = "append",
) -> StreamingQuery:
    """Merge every micro-batch of a stream into a table by key."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        warehouse.upsert(table, batch, keys, update_cols, order_by, drop)

    writer = stream.writeStream.outputMode(mode).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, every).start()
