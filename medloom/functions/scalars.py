"""Column helpers. All of them are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

YES, NO = 1065, 1066
POSITIVE, NEGATIVE = 703, 664


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def live(voided: str | Column = "voided") -> Column:
    """Explicitly not voided. An unknown flag drops the row."""
    return _col(voided) == 0


def not_voided(voided: str | Column = "voided") -> Column:
    """Not marked as voided. An unknown flag drops the row too."""
    return _col(voided) != 1


def whole_units(unit: str, start: str | Column, end: str | Column) -> Column:
    """Completed units (YEAR, MONTH, DAY, MICROSECOND ...) between two moments; time of day counts."""
    return F.timestamp_diff(unit, _col(start), _col(end))


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """Calendar days from `earlier` to `later`; time of day is ignored."""
    return F.datediff(F.to_date(_col(later)), F.to_date(_col(earlier)))


def day(c: str | Column) -> Column:
    return F.to_date(_col(c))


def round_int(c: str | Column) -> Column:
    """Half away from zero, as an integer."""
    return F.round(_col(c)).cast("int")


def number_text(c: str | Column) -> Column:
    """A number as text, without a trailing `.0` for whole numbers."""
    x = _col(c).cast("double")
    whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
    return F.when(whole, x.cast("long").cast("string")).otherwise(x.cast("string"))


def mysql_num(c: str | Column) -> Column:
    """The leading number of a text, 0 when there is none, NULL for NULL. Never fails."""
    text = _col(c).cast("string")
    prefix = F.regexp_extract(text, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    return F.when(text.isNotNull(), F.coalesce(prefix.try_cast("double"), F.lit(0.0)))


def typed_value(
    coded: str | Column, numeric: str | Column, text: str | Column, skip_zero: bool = False
) -> Column:
    """First of coded, numeric and text value that is present, as text.

    With `skip_zero`, zeros and empty texts count as absent.
    """
    coded, numeric, text = _col(coded), _col(numeric), _col(text)
    if skip_zero:
        coded = F.when(coded != 0, coded)
        numeric = F.when(numeric != 0, numeric)
        text = F.when(text != "", text)
    return F.coalesce(coded.cast("string"), number_text(numeric), text)


def filled(c: str | Column) -> Column:
    """Neither NULL nor empty."""
    return _col(c).isNotNull() & (_col(c) != "")


def bmi(weight_kg: str | Column, height_cm: str | Column, digits: int | None = None) -> Column:
    """Body mass index; NULL when the height is zero or unknown.

    Rounded values divide by the square of the metres, unrounded ones by the square of the centimetres
    over 10,000, as the two reports do; the two may differ in the last bits.
    """
    weight, height = _col(weight_kg).cast("double"), _col(height_cm).cast("double")
    if digits is None:
        return F.try_divide(weight, height * height / 10000)
    return F.round(F.try_divide(weight, height / 100 * height / 100), digits)


def add_days(d: str | Column, n: str | Column) -> Column:
    return F.date_add(day(d), _col(n).cast("int"))


def add_months(d: str | Column, n: str | Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else _col(n).cast("int")
    return F.add_months(day(d), n)


def labels(c: str | Column, mapping: dict) -> Column:
    """Code to label (or code to code); NULL when the code is not listed."""
    items = list(mapping.items())
    first = F.when(_col(c) == items[0][0], F.lit(items[0][1]))
    return reduce(lambda acc, kv: acc.when(_col(c) == kv[0], F.lit(kv[1])), items[1:], first)


def flag(cond: Column) -> Column:
    """1 where the condition holds, else NULL."""
    return F.when(cond, F.lit(1))
