"""Latest, first and n-th rows per key.

Everything here is an aggregate (with map-side combine) and, where whole rows must come back, a join to
the aggregate. No window sorts a whole key in one task, so one very large key does not stall a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _extreme(df: DataFrame, keys, order, ties: str, latest: bool) -> DataFrame:
    keys = _keys(keys)
    order = [order] if isinstance(order, str) else list(order)
    if ties == "one":
        pick = F.max_by if latest else F.min_by
        rest = [c for c in df.columns if c not in keys]
        rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
        best = df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("_row"))
        return best.select(*keys, "_row.*").select(*df.columns)
    if len(order) != 1:
        raise ValueError("ties='all' compares one order column")
    agg = F.max if latest else F.min
    best = df.groupBy(*keys).agg(agg(order[0]).alias(order[0]))
    return df.join(best, [*keys, order[0]], "left_semi")


def latest_per_key(df: DataFrame, keys, order, ties: str = "all") -> DataFrame:
    """Rows holding the greatest `order` value of their key: all of them, or one (`ties='one'`).

    With `ties='one'` give `order` enough columns to decide every tie.
    """
    return _extreme(df, keys, order, ties, latest=True)


def first_per_key(df: DataFrame, keys, order, ties: str = "all") -> DataFrame:
    """Rows holding the smallest `order` value of their key."""
    return _extreme(df, keys, order, ties, latest=False)


def nth_latest(df: DataFrame, keys, order: str, n: int, name: str | None = None) -> DataFrame:
    """The n-th greatest distinct `order` value of every key that has that many."""
    keys = _keys(keys)
    rows = df.select(*keys, order).filter(F.col(order).isNotNull())
    for _ in range(n - 1):
        top = rows.groupBy(*keys).agg(F.max(order).alias("_top"))
        rows = rows.join(top, keys).filter(F.col(order) < F.col("_top")).drop("_top")
    return rows.groupBy(*keys).agg(F.max(order).alias(name or order))


def latest_except_overall(df: DataFrame, keys, order: str, name: str | None = None) -> DataFrame:
    """Greatest `order` value per key once the single greatest value of the whole table is left out."""
    overall = df.agg(F.max(order)).scalar()
    return df.filter(F.col(order) != overall).groupBy(*_keys(keys)).agg(F.max(order).alias(name or order))


def first_and_last(
    df: DataFrame, keys: list[str], first: list[str], last: list[str], order: str | Column
) -> DataFrame:
    """One row per key: `first` columns from its first row, `last` columns from its last row."""
    order = F.col(order) if isinstance(order, str) else order
    picked = [*[F.min_by(c, order).alias(c) for c in first], *[F.max_by(c, order).alias(c) for c in last]]
    return df.groupBy(*keys).agg(*picked) if picked else df.select(*keys).distinct()
