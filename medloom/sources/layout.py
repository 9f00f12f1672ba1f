"""Observations, encounters and their providers side by side by encounter.

Most reports aggregate observations by encounter and join the result to encounters. Stored in buckets of the
encounter, all three meet without a shuffle: each bucket of one is read by the task that reads the same
bucket of the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from medloom.sources.record import LAYOUT, Record

TOGETHER = ("obs", "encounter", "encounter_provider")


def by_encounter(rec: Record, root: str, prefix: str, buckets: int) -> Record:
    """Copies of the tables in `buckets` buckets under `root`, named `<prefix>_<table>` in the catalog, and a record that reads them.

    The catalog is what tells Spark of the buckets, so a session without a shared one calls `registered`. Choose
    `buckets` so that one of them holds some hundred MB of observations; inside a bucket rows are ordered by
    concept, as in `store_record`.
    """
    for t in TOGETHER:
        rows: DataFrame = getattr(rec, t)
        # A task per bucket, so that a bucket is one file.
        writer = rows.repartition(buckets, "encounter_id").write.mode("overwrite").format("parquet").option("path", f"{root}/{t}")
        writer.bucketBy(buckets, "encounter_id").sortBy(*LAYOUT.get(t, ["encounter_id"])).saveAsTable(f"{prefix}_{t}")
    return registered(rec, prefix)


def registered(rec: Record, prefix: str) -> Record:
    """The record that reads the tables of `by_encounter`."""
    return rec.replace(**{t: rec.spark.table(f"{prefix}_{t}") for t in TOGETHER})
