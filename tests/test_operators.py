import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from medloom.operators import diff, eav, match, merge, pick
from medloom.operators.eav import Obs


def d(n):
    return dt.date(2001, 1, 1) + dt.timedelta(days=n)


def test_upsert_first_row_fills_last_row_updates(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, v int")
    source = spark.createDataFrame(
        [(2, "x", 21, 1), (2, "y", 22, 2), (3, "c", 30, 1), (3, "z", 31, 2)], "k int, name string, v int, at int"
    )
    got = rows(merge.upsert(target, source, ["k"], ["v"], "at", drop=("at",)), "k", "name", "v")
    assert got == [(1, "a", 10), (2, "b", 22), (3, "c", 31)]


def test_upsert_writes_nulls_and_keeps_first_writer(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, None, 1), (2, "n", 1), (2, "m", 2)], "k int, v string, at int")
    assert rows(merge.upsert(target, source, ["k"], ["v"], "at", ("at",)), "k", "v") == [(1, None), (2, "m")]
    assert rows(merge.upsert(target, source, ["k"], [], "at", ("at",)), "k", "v") == [(1, "a"), (2, "n")]


def test_update_from_leaves_unmatched_rows(spark):
    target = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    source = spark.createDataFrame([(1, 7, 1), (1, None, 2)], "k int, w int, at int")
    assert sorted(map(tuple, merge.update_from(target, source, ["k"], {"v": "w"}, "at").collect()), key=str) == [(1, None), (2, 6)]


def test_latest_keeps_or_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 9), (2, 1, 1)], "k int, t int, id int")
    assert rows(pick.latest_per_key(df, "k", "t"), "k", "id") == [(1, 1), (1, 2), (2, 1)]
    assert rows(pick.latest_per_key(df, "k", ["t", "id"], ties="one"), "k", "id") == [(1, 2), (2, 1)]
    assert rows(pick.first_per_key(df, "k", ["t", "id"], ties="one"), "k", "id") == [(1, 9), (2, 1)]
    assert rows(pick.nth_latest(df, "k", "t", 2), "k", "t") == [(1, 4)]
    assert rows(pick.latest_except_overall(df, "k", "t"), "k", "t") == [(1, 4), (2, 1)]


@pytest.mark.parametrize("inclusive", [False, True])
def test_match_next_against_brute_force_with_a_hot_key(spark, inclusive):
    rng = random.Random(3)
    # Key 0 holds a third of all rows.
    key = lambda: 0 if rng.random() < 0.34 else rng.randint(1, 40)
    left = [(i, key(), d(rng.randint(0, 300))) for i in range(900)] + [(900, 5, None)]
    right = [(key(), d(rng.randint(0, 300)), rng.randint(1, 9)) for _ in range(900)] + [(0, None, 1)]
    lf, rf = spark.createDataFrame(left, "id int, k int, a date"), spark.createDataFrame(right, "k int, b date, p int")
    got = {r["id"]: (r["next_date"], r["p"]) for r in match.match_next(lf, rf, "k", "a", "b", inclusive, payload="p").collect()}
    for i, k, a in left:
        later = [(b, p) for kk, b, p in right if kk == k and a and b and (b > a or (inclusive and b == a))]
        assert got[i] == (min(later) if later else (None, None))
    assert len(got) == len(left)


def test_collect_obs_ties_flags_and_voided(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-01-01", "lab")
    chart.obs(1, 5089, number=60.0)
    chart.obs(1, 5089, number=61.0)  # same moment, higher id
    chart.obs(1, 5089, number=70.0, at="2000-12-31")
    chart.obs(1, 5089, number=99.0, voided=1)
    chart.obs(1, 5089, number=98.0, voided=None)
    chart.obs(1, 160288, 1622, voided=1)
    got = eav.collect_obs(
        chart.record(spark).obs, "encounter_id",
        {
            "w": Obs((5089,), value="value_numeric", pick="latest"), "n": Obs((5089,), pick="count"),
            "p": Obs((160288,), (1622,)), "p_any": Obs((160288,), (1622,), any_voided=True),
        },
    ).first()
    assert (got["w"], got["n"], got["p"], got["p_any"]) == (61.0, 3, None, 1)


def test_sibling_pivot_needs_header_and_same_encounter(spark, chart):
    chart.patient(1)
    for v in (1, 2):
        chart.visit(v, 1, f"2001-01-0{v}", "lab")
    good, other = chart.obs(1, 900), chart.obs(1, 901)
    kept = chart.obs(1, 10, 5, group=good)
    chart.obs(1, 11, 7, group=good)
    chart.obs(1, 10, 5, group=other)  # another header
    chart.obs(2, 10, 5, group=good)  # another encounter
    chart.obs(1, 10, 5)  # no group
    got = eav.sibling_pivot(
        chart.record(spark).obs, [900], F.col("concept_id") == 10, {"s": Obs((11,), value="value_coded")}
    )
    assert rows(got, "obs_id", "s") == [(kept, 7)]


def test_diff_is_null_safe(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (4, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, None), (5, "n")], "k int, v string")
    assert rows(diff.table_diff(a, b, ["k"], ["v"]), "k", "difference") == [(2, "changed"), (3, "only_a"), (5, "only_b")]
    assert rows(diff.keys_apart(a, b, ["k"]), "k", "side") == [(3, "a"), (5, "b")]
    assert rows(diff.count_summary({"t": (a, b)}), "table_name", "rows_a", "rows_b", "difference") == [("t", 4, 4, 0)]
