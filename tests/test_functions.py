import datetime as dt

from pyspark.sql import functions as F

from medloom.functions import scalars as fn


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_whole_units_counts_completed_units(spark):
    def units(unit, a, b):
        return one(spark, fn.whole_units(unit, F.lit(dt.datetime.fromisoformat(a)), F.lit(dt.datetime.fromisoformat(b))))

    assert units("MONTH", "2004-01-31", "2004-02-29") == 0
    assert units("YEAR", "1984-02-29", "2004-02-28") == 19
    assert units("MONTH", "2000-08-01T10:00:00", "2001-08-01T00:00:00") == 11
    assert units("DAY", "2001-01-01T10:00:00", "2001-01-02T09:59:59") == 0


def test_mysql_num_takes_the_leading_number(spark):
    data = [("1200 copies", 1200.0), ("12.5", 12.5), ("-3e2x", -300.0), (" 7", 7.0), ("abc", 0.0), ("", 0.0), (None, None)]
    df = spark.createDataFrame(data, "t string, want double")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", fn.mysql_num("t")).collect())


def test_typed_value_order_and_zero_skip(spark):
    df = spark.createDataFrame(
        [(5, 1.0, "x"), (None, 1200.0, "x"), (None, 45.5, None), (None, None, "x"), (0, 0.0, "x")], "c long, n double, t string"
    )
    got = [tuple(r) for r in df.select(fn.typed_value("c", "n", "t"), fn.typed_value("c", "n", "t", skip_zero=True)).collect()]
    assert got == [("5", "5"), ("1200", "1200"), ("45.5", "45.5"), ("x", "x"), ("0", "x")]


def test_rounding_and_dates(spark):
    assert one(spark, fn.round_int(F.lit(1.5))) == 2
    assert one(spark, fn.round_int(F.lit(-1.5))) == -2
    assert one(spark, fn.bmi(F.lit(70.0), F.lit(0.0))) is None
    assert one(spark, fn.bmi(F.lit(70.0), F.lit(175.0), 1)) == 22.9
    assert one(spark, fn.add_months(F.lit("2001-01-31").cast("date"), 1)) == dt.date(2001, 2, 28)
    assert one(spark, fn.days_between(F.lit("2001-01-02 00:00:01").cast("timestamp_ntz"), F.lit("2001-01-01 23:59:59").cast("timestamp_ntz"))) == 1


def test_voided_predicates_drop_unknown(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "voided int")
    assert df.filter(fn.live()).count() == 1
    assert df.filter(fn.not_voided()).count() == 1
