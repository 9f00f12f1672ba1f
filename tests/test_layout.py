"""Plans over the layout by encounter, and how often a run reads the observations."""

from __future__ import annotations

import pytest

from medloom.plans.reports import Reports
from medloom.sources.layout import by_encounter
from medloom.sources.warehouse import Warehouse

@pytest.fixture
def charted(spark, chart):
    for pid in (1, 2):
        chart.patient(pid)
        chart.visit(pid, pid, "2001-07-01", "followup_hiv")
        chart.obs(pid, 5089, number=60.0)
    return chart.record(spark)


def test_observations_in_buckets_are_not_shuffled_to_their_encounter(spark, charted, tmp_path):
    rec = by_encounter(charted, str(tmp_path / "l"), "layout_test", 4)
    assert sorted(map(tuple, rec.obs.collect()), key=str) == sorted(map(tuple, charted.obs.select(*rec.obs.columns).collect()), key=str)
    plain, stored = Reports(charted, "2001-08-01"), Reports(rec, "2001-08-01")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("encounter_seen", "encounter_facts"):
            text = stored.build(name)._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in text and "Exchange" not in text, name
            assert "Exchange" in plain.build(name)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("health_qual_patient_visit", "patient_nutrition"):
        assert sorted(map(str, stored.table(name).collect())) == sorted(map(str, plain.table(name).collect()))


def test_five_reports_read_the_observations_by_one_pass(spark, charted):
    """Their facts come from two stored tables; their own plans scan no observations (imaging has its spine)."""
    reports = Reports(charted, "2001-08-01", Warehouse(spark))
    seen = charted.obs.columns
    for name in ("health_qual_patient_visit", "patient_nutrition", "patient_ob_gyn", "patient_malaria"):
        text = reports.build(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "concept_id" not in text and set(seen) >= {"concept_id"}, name
