"""Report tables on shared storage: write, read, append, upsert, replace a day, snapshot and restore."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.operators.merge import upsert

#: Columns of ids, most of whose values differ: a dictionary of them is built in vain.
_IDS = ("obs_id", "encounter_id", "obs_group_id", "person_id", "patient_id", "visit_id")
#: How tables are stored: half to two thirds of the bytes of Spark's default, numbers as differences, for less time.
STORED = {"compression": "zstd", "parquet.writer.version": "v2"} | {f"parquet.enable.dictionary#{c}": "false" for c in _IDS}


#: How many times larger rows are in memory than in the files they are `STORED` in.
GROWTH = 8


def count_rows_larger(spark: SparkSession) -> None:
    """Tell Spark's planner of `GROWTH`, unless the session has a factor of its own.

    By the size of compressed files alone, tables of hundreds of MB pass for small ones, which the driver collects
    to send them to every executor.
    """
    factor = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(factor)) == 1:
        spark.conf.set(factor, str(GROWTH))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Without that setting, a folder beside the session's own tables.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/medloom-stored"


class Warehouse:
    """Parquet tables under one root, a folder per run that wrote them: `<root>/<table>/run=<n>`.

    A table is rewritten into the next run's folder, which counts once Spark's writer has completed it; so a table
    may be rewritten from a query that reads it, and a failed run leaves the one before. Appends and replaced
    partitions change the folder of the current run in place. One writer per table is assumed.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/medloom-{uuid.uuid4().hex}"
        count_rows_larger(spark)

    def __contains__(self, name: str) -> bool:
        return bool(self._runs(name, complete=True))

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _runs(self, name: str, complete: bool) -> list[tuple[int, int]]:
        """(number, moment of completion) of the table's runs, ascending; the incomplete ones too unless `complete`."""
        folder, fs = self._files(f"{self.root}/{name}")
        numbers = sorted(int(s.getPath().getName()[4:]) for s in fs.listStatus(folder)) if fs.exists(folder) else []
        out = []
        for n in numbers:
            done, _ = self._files(f"{self._path(name, n)}/_SUCCESS")
            if fs.exists(done):
                out.append((n, fs.getFileStatus(done).getModificationTime()))
            elif not complete:
                out.append((n, 0))
        return out

    def _path(self, name: str, run: int) -> str:
        return f"{self.root}/{name}/run={run}"

    def _current(self, name: str) -> str | None:
        runs = self._runs(name, complete=True)
        return self._path(name, runs[-1][0]) if runs else None

    def read(self, name: str) -> DataFrame:
        path = self._current(name)
        if path is None:
            raise KeyError(f"no table {name} under {self.root}")
        return self.spark.read.parquet(path)

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: list[str] | None = None,
        sort_within: list[str] | None = None,
    ) -> DataFrame:
        """Replace the table. `sort_within` orders rows inside each file so that filters skip row groups."""
        path = self._path(name, max((n for n, _ in self._runs(name, complete=False)), default=0) + 1)
        if sort_within:
            df = df.sortWithinPartitions(*sort_within)
        writer = df.write.mode("errorifexists").options(**STORED)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.parquet(path)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        path = self._current(name)
        if path is None:
            return self.write(name, df)
        df.write.mode("append").options(**STORED).parquet(path)
        return self.read(name)

    def upsert(self, name: str, source: DataFrame, keys, update_cols, order_by, drop=()) -> DataFrame:
        target = self.read(name) if name in self else None
        return self.write(name, upsert(target, source, keys, update_cols, order_by, drop))

    def replace_where(self, name: str, keep: Column, rows: DataFrame) -> DataFrame:
        """Keep the old rows that satisfy `keep` and add `rows`."""
        if name not in self:
            return self.write(name, rows)
        return self.write(name, self.read(name).filter(keep).unionByName(rows))

    def replace_partition(self, name: str, rows: DataFrame, partition: str) -> DataFrame:
        """Replace only the partitions (for example days) that occur in `rows`, of a table written by that partition."""
        path = self._current(name)
        if path is None:
            return self.write(name, rows, partition_by=[partition])
        old = self.read(name)
        rows = rows.withColumn(partition, F.col(partition).cast(old.schema[partition].dataType)).select(*old.columns)
        rows.write.mode("overwrite").options(**STORED, partitionOverwriteMode="dynamic").partitionBy(partition).parquet(path)
        return self.read(name)

    def drop(self, name: str) -> None:
        folder, fs = self._files(f"{self.root}/{name}")
        fs.delete(folder, True)

    def expire(self, name: str, older_than: dt.timedelta) -> int:
        """Remove runs of a table that were replaced longer ago than `older_than`, but never the current one; returns how many."""
        runs = self._runs(name, complete=True)
        limit = (time.time() - older_than.total_seconds()) * 1000
        gone = [n for (n, _), (_, replaced) in zip(runs, runs[1:]) if replaced < limit]
        for n in gone:
            folder, fs = self._files(self._path(name, n))
            fs.delete(folder, True)
        return len(gone)

    def snapshot(self, names: list[str]) -> dict[str, str]:
        """Copies of tables as they are now, by name."""
        paths = {n: f"{self.root}/_copies/{uuid.uuid4().hex}" for n in names if n in self}
        for n, path in paths.items():
            self.read(n).write.options(**STORED).parquet(path)
        return paths

    def restore(self, saved: dict[str, str]) -> None:
        """Make copies the current tables, of this warehouse or another one's."""
        for name, path in saved.items():
            self.write(name, self.spark.read.parquet(path))
