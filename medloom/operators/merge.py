"""Insert-or-update, update-from-join and delete-by-match, as DataFrame to DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.operators.pick import first_and_last


def _order(order_by) -> Column:
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return F.struct(*cols)  # a NULL in it still orders the row, first


def reduce_batch(source: DataFrame, keys: list[str], update_cols: list[str], order_by) -> DataFrame:
    """One row per key: what inserting the batch row by row would leave behind.

    The first row of a key fills every column; later rows change only `update_cols`.
    """
    fixed = [c for c in source.columns if c not in keys and c not in update_cols]
    listed = [c for c in source.columns if c in update_cols]
    return first_and_last(source, keys, fixed, listed, _order(order_by)).select(*source.columns)


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str],
    order_by,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Merge `source` into `target` on `keys`.

    New keys take all columns. Existing keys change only `update_cols`; with an empty list the first
    writer wins. `order_by` puts several source rows of one key in order; `drop` names columns that
    serve only for the order. Both sides of the merge have one row per key.
    """
    batch = reduce_batch(source, keys, [c for c in update_cols if c not in keys], order_by).drop(*drop)
    return batch if target is None else merge_reduced(target, batch, keys, update_cols)


def merge_reduced(target: DataFrame, batch: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """`upsert` of a batch that has one row per key already."""
    t, s = target.alias("t"), batch.alias("s")
    joined = t.withColumn("_old", F.lit(True)).alias("t").join(
        s.withColumn("_new", F.lit(True)).alias("s"), keys, "full_outer"
    )
    out = [F.col(k) for k in keys]
    for c in target.columns:
        if c in keys:
            continue
        if c not in batch.columns:
            out.append(F.col(f"t.{c}").alias(c))
        elif c in update_cols:
            out.append(F.when(F.col("_new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("_old"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return joined.select(*out).select(*target.columns)


def update_from(
    target: DataFrame, source: DataFrame, on: list[str], set_cols: dict[str, Column | str], order_by
) -> DataFrame:
    """Set columns of the target rows that have a match; leave the others alone.

    When several source rows match, the one with the greatest `order_by` is used. `set_cols` maps a
    target column to a source column or expression. A matched NULL is written, as any other value.
    """
    values = [
        (F.col(e) if isinstance(e, str) else e).alias(f"_set_{c}") for c, e in set_cols.items()
    ]
    chosen = source.groupBy(*on).agg(F.max_by(F.struct(*values), _order(order_by)).alias("_v")).select(*on, "_v.*")
    joined = target.join(chosen.withColumn("_hit", F.lit(True)), on, "left")
    for c in set_cols:
        old = F.col(c) if c in target.columns else F.lit(None)
        joined = joined.withColumn(c, F.when(F.col("_hit"), F.col(f"_set_{c}")).otherwise(old))
    added = [c for c in set_cols if c not in target.columns]
    return joined.select(*target.columns, *added)


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Change columns of the rows that satisfy the condition."""
    return df.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}
    )


def delete_matching(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Target rows without a match in the source.

    Source keys are made distinct first (with map-side combine): a join can split a large key of the
    target over tasks, but not one of the source.
    """
    return target.join(source.select(*on).distinct(), on, "left_anti")


def keep_matching(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Target rows with a match in the source; see `delete_matching` for the distinct keys."""
    return target.join(source.select(*on).distinct(), on, "left_semi")


def ensure_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Add a NULL column when the table does not have it yet."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))
