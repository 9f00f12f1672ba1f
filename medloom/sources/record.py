"""The medical record a report run reads: one DataFrame per source table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions.scalars import live, not_voided
from medloom.sources.codes import Codes, is_any
from medloom.sources.schemas import SOURCE_SCHEMAS


@dataclass(frozen=True)
class Record:
    obs: DataFrame
    encounter: DataFrame
    visit: DataFrame
    encounter_provider: DataFrame
    person: DataFrame
    patient: DataFrame
    person_name: DataFrame
    person_address: DataFrame
    person_attribute: DataFrame
    patient_identifier: DataFrame
    location: DataFrame
    location_attribute: DataFrame
    concept: DataFrame
    concept_name: DataFrame
    codes: Codes

    @property
    def spark(self) -> SparkSession:
        return self.obs.sparkSession

    def replace(self, **frames: DataFrame) -> "Record":
        values = {f.name: getattr(self, f.name) for f in fields(self)}
        return Record(**{**values, **frames})


RECORD_TABLES = [f.name for f in fields(Record) if f.name != "codes"]
DICTIONARY_TABLES = {
    "encounter_type": "encounter_type",
    "concept": "concept",
    "identifier_type": "patient_identifier_type",
    "person_attribute_type": "person_attribute_type",
    "location_attribute_type": "location_attribute_type",
}


def parquet_reader(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    """Tables as Parquet directories under one root."""

    def read(table: str) -> DataFrame:
        reader = spark.read
        if table in SOURCE_SCHEMAS:
            reader = reader.schema(SOURCE_SCHEMAS[table])
        return reader.parquet(f"{root}/{table}")

    return read


def jdbc_reader(
    spark: SparkSession, url: str, split: dict[str, tuple[str, int, int, int]], **options: str
) -> Callable[[str], DataFrame]:
    """Tables of a database schema over JDBC.

    `split` gives, per large table, (id column, lowest, highest, partitions) so that executors read
    ranges in parallel; a table without an entry is read by one task and should be a dictionary.
    """

    def read(table: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
        if table in split:
            column, low, high, parts = split[table]
            reader = reader.options(
                partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
            )
        return reader.load()

    return read


def load_record(read: Callable[[str], DataFrame], codes: Codes | None = None) -> Record:
    """Build a record from a reader; codes are resolved from its dictionaries unless given."""
    if codes is None:
        codes = Codes.resolve(**{kind: read(table) for kind, table in DICTIONARY_TABLES.items()})
    return Record(**{t: read(t) for t in RECORD_TABLES}, codes=codes)


def snapshot(
    table: DataFrame,
    concepts: list[int] | None = None,
    columns: list[str] | None = None,
    not_void: str | None = None,
    grouped_only: bool = False,
) -> DataFrame:
    """A pruned view of a source table; filters and columns reach the Parquet scan.

    not_void: "live" keeps voided = 0, "not_voided" keeps voided <> 1.
    """
    df = table
    if concepts is not None:
        df = df.filter(is_any("concept_id", concepts))
    if not_void:
        df = df.filter({"live": live, "not_voided": not_voided}[not_void]())
    if grouped_only:
        df = df.filter(F.col("obs_group_id").isNotNull())
    return df.select(*columns) if columns else df


def created_on(table: DataFrame, as_of, ts_col: str = "date_created") -> DataFrame:
    """Rows entered on one day. Written as a range on the raw column so that it prunes the scan."""
    start = F.lit(as_of).cast("date").cast("timestamp_ntz")
    return table.filter((F.col(ts_col) >= start) & (F.col(ts_col) < start + F.expr("INTERVAL 1 DAY")))


# Rules ask for a few concepts at a time: rows ordered by concept let the scan skip row groups.
LAYOUT = {"obs": ["concept_id", "encounter_id"], "encounter": ["encounter_type", "encounter_id"]}


def store_record(rec: Record, write: Callable[..., DataFrame]) -> Record:
    """Copy the source tables once (for example from a database) and read the copies from then on.

    `write(name, df, sort_within=...)` stores a table and returns it read back. The order is made inside
    each file only, so the copy needs no shuffle.
    """
    stored = {
        t: write(f"source_{t}", getattr(rec, t), sort_within=LAYOUT.get(t)) for t in RECORD_TABLES
    }
    return rec.replace(**stored)
