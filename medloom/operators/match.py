"""Range joins on calendar days without pairing every event of a key with every other, and rows that may match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom.functions.scalars import day

Target = tuple[DataFrame, str | Column, str | None]


def match_next_each(
    left: DataFrame, on: str, left_date: str, targets: dict[str, Target], inclusive: bool = False
) -> DataFrame:
    """For every left row and every target, the earliest target day after (or on) the row's own day.

    A target is (rows, date, payload): the day found becomes a column of the target's name and the
    smallest payload of that day (when a payload is named) a column of the payload's name.

    Both sides are first reduced to distinct days per key, so a key holds at most one row per calendar
    day and target whatever the number of events. One window over those days serves all targets. `left`
    is read twice: hand over a stored table when it is expensive to compute.
    """
    asks = (
        left.select(on, day(left_date).alias("_day"))
        .filter(F.col("_day").isNotNull())
        .distinct()
        .withColumns({"_target": F.lit(None).cast("string"), "_payload": F.lit(None).cast("long")})
    )
    parts = [asks]
    for name, (rows, date, payload) in targets.items():
        when = day(date)
        value = F.col(payload).cast("long") if payload else F.lit(None).cast("long")
        parts.append(
            rows.select(on, when.alias("_day"), value.alias("_payload"))
            .filter(F.col("_day").isNotNull())
            .groupBy(on, "_day")
            .agg(F.min("_payload").alias("_payload"))
            .withColumn("_target", F.lit(name))
        )
    # Walking the days backwards lets the frame only grow, so the minimum is kept incrementally.
    both = reduce(DataFrame.unionByName, parts).withColumn("_back", -F.unix_date("_day"))
    ahead = (
        Window.partitionBy(on)
        .orderBy("_back")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    hit = F.struct("_day", "_payload")
    found = (
        both.withColumns({f"_{n}": F.min(F.when(F.col("_target") == n, hit)).over(ahead) for n in targets})
        .filter(F.col("_target").isNull())
        .select(on, F.col("_day").alias("_left_day"), *[f"_{n}" for n in targets])
    )
    out = left.withColumn("_left_day", day(left_date)).join(found, [on, "_left_day"], "left")
    for name, (rows, _, payload) in targets.items():
        out = out.withColumn(name, F.col(f"_{name}._day"))
        if payload:
            out = out.withColumn(payload, F.col(f"_{name}._payload").cast(rows.schema[payload].dataType))
    return out.drop("_left_day", *[f"_{n}" for n in targets])


def match_next(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_date: str,
    right_date: str | Column,
    inclusive: bool = False,
    payload: str | None = None,
    name: str = "next_date",
) -> DataFrame:
    """For every left row, the earliest right day after (or on) its own day, as `name`.

    `payload`: also bring the smallest value of that (numeric) right column on the matched day.
    """
    return match_next_each(left, on, left_date, {name: (right, right_date, payload)}, inclusive)


#: 64-bit words of a bitmap in one row, and in all at most: 64 MB, whatever the number of keys.
WORDS_A_ROW, MOST_WORDS = 512, 1 << 23


def may_match(rows: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """The rows whose `key` occurs in `others`, and a few of the rest: a filter ahead of a join that would shuffle all rows.

    A bitmap of the hashed keys of `others` goes to every task, 16 bits a key until it has its greatest size; a
    fuller one lets more rows pass and never drops one that matches. `others` is read twice: hand over a stored table.
    """
    words = min(MOST_WORDS, WORDS_A_ROW * max(1, -(-others.count() // (4 * WORDS_A_ROW))))
    place = lambda column: F.pmod(F.xxhash64(column), F.lit(words * 64).cast("long"))
    bit = lambda at: F.expr(f"shiftleft(1L, CAST({at} % 64 AS INT))")
    marks = others.filter(F.col(other_key).isNotNull()).select(place(other_key).alias("_at"))
    # Words without a key are there too, so that a word is found by its place.
    marks = marks.select(F.floor(F.col("_at") / 64).alias("_word"), bit("_at").alias("_bits")).unionByName(
        rows.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    ).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    bitmap = marks.groupBy(F.floor(F.col("_word") / WORDS_A_ROW).alias("_row")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_word", "_bits"))), lambda w: w["_bits"]).alias("_words")
    )
    at = rows.withColumn("_at", place(key)).withColumn("_row", F.floor(F.col("_at") / (64 * WORDS_A_ROW)))
    word = F.expr(f"_words[CAST(floor(_at / 64) % {WORDS_A_ROW} AS INT)]")
    return at.join(F.broadcast(bitmap), "_row").filter(word.bitwiseAND(bit("_at")) != 0).select(*rows.columns)
