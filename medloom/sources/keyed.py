"""Tables dealt out by ranges of a key, of which a change reads and rewrites only the ranges it touches.

A table is a plain Parquet folder partitioned by `part`, the number of the range its rows lie in. A change
first finds the ranges of its own rows, then merges them with the old rows of those ranges alone, and writes
them with Spark's dynamic partition overwrite: the other ranges are neither read nor written, and readers see
a range as it was until the job has committed. One writer per table is assumed.

A range that a change leaves without rows is still overwritten, by one dead row that readers skip.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from medloom.operators.merge import merge_reduced, reduce_batch
from medloom.sources.warehouse import STORED

#: Columns that a table has besides its rows'.
PART, LIVE = "part", "live"
#: The range of rows without a key.
NO_PART = -(1 << 62)


class KeyedTable:
    """`by` is a column, or an SQL expression over columns that a row never changes, with integer values, of
    which `width` make a range; rows without a value share a range of their own. Keep `width` so that a range
    is some hundred MB: a range is the least that a change rewrites, and the ranges a change touches are
    listed on the driver, one number each."""

    def __init__(self, spark: SparkSession, path: str, by: str, width: int = 1):
        self.spark, self.path, self.by, self.width = spark, path, by, width
        self._kind: StructType | None = None

    def part(self) -> Column:
        return F.coalesce(F.floor(F.expr(self.by).cast("decimal(20,0)") / F.lit(self.width)).cast("long"), F.lit(NO_PART))

    def exists(self) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_SUCCESS")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _write(self, rows: DataFrame, dead: list[int], how: str) -> None:
        nothing = self.spark.createDataFrame([(p,) for p in dead], f"{PART} long").withColumn(LIVE, F.lit(False))
        live = rows.withColumns({LIVE: F.lit(True), PART: self.part()})
        # One task writes a range, or several where the range is large.
        writer = live.unionByName(nothing, allowMissingColumns=True).hint("rebalance", PART).write
        writer.mode("overwrite").options(**STORED, partitionOverwriteMode=how).partitionBy(PART).parquet(self.path)

    def create(self, rows: DataFrame) -> None:
        """The table anew; `rows` must not read it."""
        self._kind = None
        self._write(rows, [NO_PART], "static")

    def _stored(self) -> DataFrame:
        if self._kind is None:  # looked up once: the columns of a table stay
            self._kind = StructType([f if f.name != PART else StructField(PART, LongType()) for f in self.spark.read.parquet(self.path).schema])
        return self.spark.read.schema(self._kind).parquet(self.path)

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """The rows, of some ranges or of all; those of other ranges are not listed in the scan."""
        rows = self._stored()
        return (rows if parts is None else rows.filter(F.col(PART).isin(parts))).filter(LIVE).drop(LIVE, PART)

    def parts(self) -> list[int]:
        """The ranges that have a folder."""
        return sorted(r[0] for r in self._stored().select(PART).distinct().collect())

    def digests(self, cols: list[str]) -> DataFrame:
        """(part, rows, one, two): per range, how many rows and two sums of hashes of their values, whatever their order."""
        rows = self._stored().filter(LIVE)
        total = lambda *seed: F.sum(F.xxhash64(*cols, *map(F.lit, seed)).cast("decimal(38,0)"))
        # A hash skips NULL: say which values are.
        nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
        rows = rows.withColumn("_nulls", nulls)
        cols = [*cols, "_nulls"]
        return rows.groupBy(PART).agg(F.count("*").alias("rows"), total().alias("one"), total("two").alias("two"))

    def touched(self, *changes: DataFrame) -> list[int]:
        """The ranges that some rows lie in: a number per range, however many rows there are."""
        found = reduce(DataFrame.unionByName, [rows.select(self.part().alias(PART)).distinct() for rows in changes])
        return sorted({r[0] for r in found.collect()})

    def upsert(self, source: DataFrame, keys: list[str], update_cols: list[str], order_by, drop: tuple[str, ...] = ()) -> list[int]:
        """Merge `source` by key, as `merge.upsert` does; returns the ranges rewritten. Rows of one key lie in one range."""
        batch = reduce_batch(source, keys, [c for c in update_cols if c not in keys], order_by).drop(*drop)
        # Written beside the table, since it is read twice.
        batch.write.mode("overwrite").options(**STORED, partitionOverwriteMode="static").parquet(f"{self.path}-change")
        batch = self.spark.read.schema(batch.schema).parquet(f"{self.path}-change")
        parts = self.touched(batch)
        if parts and not self.exists():
            self.create(batch)
        elif parts:
            self._write(merge_reduced(self.read(parts), batch, keys, update_cols), parts, "dynamic")
        return parts

    def replace(self, gone: DataFrame, rows: DataFrame, on: list[str]) -> list[int]:
        """Remove the rows whose `on` columns are in `gone` and add `rows`; returns the ranges rewritten.

        `gone` has the columns that deal out the table. Hand over small or stored frames: both are read twice.
        """
        parts = self.touched(gone, rows)
        if parts:
            kept = self.read(parts).join(gone.select(*on).distinct(), on, "left_anti")
            self._write(kept.unionByName(rows.select(*kept.columns)), parts, "dynamic")
        return parts

    def expire(self, before: int) -> int:
        """Remove the ranges below `before`; returns how many. For tables dealt out by day."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        old = [p for p in self.parts() if NO_PART < p < before]
        for p in old:
            folder = path(f"{self.path}/{PART}={p}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return len(old)
