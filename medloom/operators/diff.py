"""Compare two versions of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.sources.keyed import KeyedTable


def only_in(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of `a` that `b` does not have."""
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), keys, "left_anti")


def keys_apart(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found on one side only, with the side."""
    return only_in(a, b, keys).withColumn("side", F.lit("a")).unionByName(
        only_in(b, a, keys).withColumn("side", F.lit("b"))
    )


def table_diff(a: DataFrame, b: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Keys whose rows differ: `difference` is only_a, only_b or changed, `columns` names what changed.

    NULL equals NULL and differs from any value. Keys must be unique on each side.
    """
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols], F.lit(1).alias("_a"))
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(1).alias("_b"))
    joined = left.join(right, keys, "full_outer")
    changed = [F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in cols]
    kind = (
        F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").otherwise("changed")
    )
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return (
        joined.withColumn("difference", kind)
        .withColumn("columns", F.when(both, F.concat_ws(",", *changed)))
        .filter(~both | (F.col("columns") != ""))
        .select(*keys, "difference", "columns", *[f"{s}_{c}" for c in cols for s in "ab"])
    )


def keyed_diff(a: KeyedTable, b: KeyedTable, keys: list[str], cols: list[str]) -> DataFrame:
    """`table_diff` of two large tables dealt out alike: ranges whose digests agree are not compared row by row.

    A digest is one aggregate over a table, a row per range; only the ranges that differ are read again and joined.
    """
    one, two = (t.digests([*keys, *cols]).select("part", F.struct("rows", "one", "two").alias(n)) for t, n in ((a, "x"), (b, "y")))
    apart = one.join(two, "part", "full_outer").filter(~F.col("x").eqNullSafe(F.col("y"))).select("part").collect()
    parts = sorted(r[0] for r in apart)
    return table_diff(a.read(parts), b.read(parts), keys, cols)


def attribute_diff(a: DataFrame, b: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Matched keys whose attribute differs (NULLs are not compared)."""
    left = a.select(*keys, F.col(col).alias(f"a_{col}"))
    right = b.select(*keys, F.col(col).alias(f"b_{col}"))
    return left.join(right, keys).filter(F.col(f"a_{col}") != F.col(f"b_{col}"))


def row_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Whole rows found more often on one side, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(
        b.exceptAll(a).withColumn("side", F.lit("b"))
    )


def count_summary(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of each table on both sides."""
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n")
        for name, ab in pairs.items()
        for side, df in zip("ab", ab, strict=True)
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table_name")
        .pivot("side", ["a", "b"])
        .agg(F.first("n"))
        .select("table_name", F.col("a").alias("rows_a"), F.col("b").alias("rows_b"))
        .withColumn("difference", F.col("rows_a") - F.col("rows_b"))
    )


def count_by(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows per value of `key`, side by side."""
    left = a.groupBy(key).agg(F.count("*").alias("rows_a"))
    right = b.groupBy(key).agg(F.count("*").alias("rows_b"))
    return (
        left.join(right, key, "full_outer")
        .na.fill(0, ["rows_a", "rows_b"])
        .withColumn("difference", F.col("rows_a") - F.col("rows_b"))
    )
