"""One positive and one near miss per rule, on hand-made charts."""

import datetime as dt

import pytest

from conftest import rows
from medloom.plans import alerts as al, status as st
from medloom.plans.reports import Reports
from medloom.sources.dimensions import dimension
from medloom.plans import regimens as rg

AS_OF = "2001-08-01"
TDF, LAMIVUDINE, EFAVIRENZ = 84795, 78643, 75523


@pytest.fixture(autouse=True)
def small_data(spark):
    """Charts of a few rows: compiling code for them would take longer than running them."""
    settings = {
        "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def run(spark, chart, name):
    return Reports(chart.record(spark), AS_OF).run([name], at_once=8)[name]


def status(spark, chart):
    return dict(rows(run(spark, chart, "statuses"), "patient_id", "id_status"))


def test_refill_statuses_by_days_late(spark, chart):
    for pid, due in ((1, "2001-08-01"), (2, "2001-07-31"), (3, "2001-07-02"), (4, "2001-07-01"), (5, "2001-09-01")):
        chart.patient(pid)
        chart.visit(pid, pid, "2001-05-01", "dispensing")
        chart.dispense(pid, TDF, due)
    # Left care: the discontinuation form removes the regular status and gives status 1.
    chart.visit(50, 5, "2001-06-01", "discontinuation")
    chart.obs(50, 161555, 159)
    # Prophylaxis only: never on treatment, an exposed infant.
    chart.patient(6)
    chart.visit(6, 6, "2001-05-01", "dispensing")
    chart.dispense(6, TDF, "2001-09-01", rx=163768)
    assert status(spark, chart) == {1: 6, 2: 8, 3: 8, 4: 9, 5: 1}


def test_statuses_before_treatment(spark, chart):
    for pid, when, kind in (
        (1, "2000-08-01", "first_hiv"), (2, "2000-07-31", "first_hiv"), (3, "2001-01-01", "followup_hiv"),
        (4, "1999-01-01", "followup_hiv"), (5, "2001-01-01", "first_hiv"),
    ):
        chart.patient(pid)
        chart.visit(pid, pid, when, kind)
    chart.visit(10, 2, "2000-07-01", "first_hiv")
    # Patient 2: twelve months and a day is still twelve completed months.
    # Patient 4: an old follow-up visit is neither active nor lost (known kind of form).
    chart.patient(6)
    chart.visit(6, 6, "1999-01-01", "first_hiv")
    chart.visit(16, 6, "1999-06-01", "", code=17)  # latest form of an unknown kind, long ago
    chart.visit(15, 5, "2001-06-01", "discontinuation")
    chart.obs(15, 161555, 159492)
    assert status(spark, chart) == {1: 7, 2: 7, 3: 11, 5: 5, 6: 10}


def test_stopped_needs_a_valid_detail(spark, chart):
    for pid, detail in ((1, 115198), (2, 5622)):
        chart.patient(pid)
        chart.visit(pid, pid, "2001-01-01", "dispensing")
        chart.dispense(pid, TDF, "2001-02-01")
        chart.visit(pid + 10, pid, "2001-03-01", "discontinuation")
        chart.obs(pid + 10, 161555, 1667)
        chart.obs(pid + 10, 1667, detail)
    got = run(spark, chart, "statuses")
    assert rows(got, "patient_id", "id_status", "dis_reason") == [(1, 3, 1667), (2, 9, None)]


def test_infected_children_are_not_exposed(spark, chart):
    for pid in (1, 2, 3):
        chart.patient(pid, born="2000-06-01")
        chart.visit(pid, pid, "2001-01-01", "ped_first_hiv")
        chart.obs(pid, 1401, 1405)
    chart.obs(2, 1030, 703)
    chart.obs(3, 1401, 163717)
    chart.visit(13, 3, "2001-02-01", "discontinuation")
    chart.obs(13, 1667, 165439)
    assert rows(run(spark, chart, "exposed_infants"), "patient_id", "condition") == [(1, 3), (3, 5)]


def test_current_status_takes_the_last_one_written(spark):
    day = dt.date(2001, 8, 1)
    history = spark.createDataFrame(
        [(1, 9, day, 1, None, day), (1, 2, day, 1, None, day), (1, 6, day, 1, None, dt.date(2001, 7, 1)), (2, 11, day, 1, None, day), (2, 7, day, 1, None, day)],
        "patient_id int, id_status int, start_date date, encounter_id int, dis_reason int, date_started_status date",
    )
    assert rows(st.current_status(history), "patient_id", "arv_status") == [(1, 2), (2, 11)]
    merged = st.merge_history(history, history.filter("patient_id = 2"), "2001-08-01")
    assert rows(merged, "patient_id", "id_status") == [(1, 6), (2, 7), (2, 11)]
    daily = st.merge_day_status(history, history.filter("patient_id = 2"))
    assert rows(daily, "patient_id", "id_status") == [(1, 2), (1, 6), (1, 9), (2, 11)]


def test_viral_load_alerts(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-01-15", "dispensing")
    chart.dispense(1, TDF, "2001-09-30", rx=138405)
    chart.visit(2, 1, "2001-01-16", "first_hiv")
    chart.patient(2)
    chart.visit(3, 2, "2001-02-01", "dispensing")
    chart.dispense(3, TDF, "2001-08-20", rx=138405)
    chart.visit(4, 2, "2001-02-02", "first_hiv")
    chart.visit(5, 2, "2001-03-01", "lab")
    chart.obs(5, 1271, 856)
    chart.obs(5, 856, number=1000.5)
    got = set(rows(run(spark, chart, "alerts"), "patient_id", "id_alert"))
    # 1: six months without a test (code 1 and 10), no isoniazid (11). 2: high load (5, 6), refill in 19 days (7).
    assert got == {(1, 1), (1, 10), (1, 11), (2, 5), (2, 6), (2, 7), (2, 11)}


def test_voided_viral_load_does_not_count(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-03-01", "dispensing")
    chart.dispense(1, TDF, "2001-09-30")
    chart.visit(2, 1, "2001-03-02", "first_hiv")
    chart.visit(3, 1, "2001-04-01", "lab")
    chart.obs(3, 1271, 856, voided=1)
    chart.obs(3, 856, number=20.0)
    assert (1, 2) in rows(run(spark, chart, "alerts"), "patient_id", "id_alert")


def test_regimen_sets(spark, chart):
    for pid, drugs in ((1, (TDF, LAMIVUDINE, EFAVIRENZ)), (2, (TDF, LAMIVUDINE)), (3, (817,)), (4, (630, EFAVIRENZ))):
        chart.patient(pid)
        chart.visit(pid, pid, "2001-05-01", "dispensing")
        for drug in drugs:
            chart.dispense(pid, drug, rx=138405)
    got = rows(run(spark, chart, "regimens"), "patient_id", "regimen")
    # The catalogue names this triple in one order of its drugs; two of them alone are no regimen.
    assert got == [(1, "3TC-TNF-EFV"), (3, "ZDV-3TC-ABC"), (4, "AZT+3TC+EFV")]


def test_regimens_of_voided_prescriptions_are_dropped(spark):
    day = dt.date(2001, 5, 1)
    history = spark.createDataFrame([(1, 1, day, "A", 1), (1, 2, day, "B", 1)], "location_id long, patient_id long, visit_date date, regimen string, rx_or_prophy long")
    presc = spark.createDataFrame([(1, 1, dt.datetime(2001, 5, 1, 9), 1)], "location_id long, patient_id long, visit_date timestamp_ntz, voided int")
    assert rows(rg.merge_regimens(history, presc, history.limit(0)), "patient_id") == [(2,)]


def test_removed_drug_is_voided(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-05-01", "dispensing")
    head = chart.obs(1, 163711)
    chart.obs(1, 1282, TDF, group=head)
    chart.obs(1, 1276, group=head, voided=1)  # one live member left
    chart.dispense(1, LAMIVUDINE)
    assert rows(run(spark, chart, "patient_dispensing"), "drug_id", "voided") == [(LAMIVUDINE, 0), (TDF, 1)]


def test_only_groups_with_fewer_than_two_known_live_members_are_looked_up(spark, chart):
    chart.patient(1)
    heads = {}
    for visit, name in enumerate(("removed", "detailed", "other member", "two drugs", "detail elsewhere"), 1):
        chart.visit(visit, 1, f"2001-05-0{visit}", "dispensing")
        heads[name] = chart.obs(visit, 163711)
        chart.obs(visit, 1282, TDF, group=heads[name])
        chart.obs(visit, 1276, group=heads[name], voided=int(name != "detailed"))
    chart.obs(3, 5089, number=1.0, group=heads["other member"])
    chart.obs(4, 1282, LAMIVUDINE, group=heads["two drugs"])
    chart.obs(1, 1443, number=1.0, group=heads["detail elsewhere"])  # of another encounter: does not count
    reports = Reports(chart.record(spark), "2001-08-01")
    looked_up = sorted(heads[n] for n in ("removed", "other member", "detail elsewhere"))
    assert rows(reports.table("doubtful_group"), "obs_group_id") == [(h,) for h in looked_up]
    gone = sorted(heads[n] for n in ("removed", "detail elsewhere"))
    assert rows(reports.table("removed_group"), "obs_group_id") == [(h,) for h in gone]


def test_pregnancy_end_takes_the_next_due_date(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-01-01", "first_hiv")
    chart.obs(1, 162225, 1434)
    chart.visit(2, 1, "2001-02-01", "obgyn_followup")
    chart.obs(2, 5596, when="2001-06-15")
    chart.obs(2, 5596, when="2000-12-01")  # before the start
    chart.patient(2)
    chart.visit(3, 2, "2000-10-01", "first_hiv")
    chart.obs(3, 162225, 1434)
    chart.patient(3)
    chart.visit(4, 3, "2001-07-01", "labor_delivery")
    chart.obs(4, 1572, 1501)
    got = rows(run(spark, chart, "patient_pregnancy"), "patient_id", "encounter_id", "start_date", "end_date")
    assert got == [
        (1, 1, dt.date(2001, 1, 1), dt.date(2001, 6, 15)), (1, 2, dt.date(2001, 2, 1), dt.date(2001, 6, 15)),
        (2, 3, dt.date(2000, 10, 1), dt.date(2001, 7, 1)), (3, 4, dt.date(2000, 10, 1), dt.date(2001, 7, 1)),
    ]


@pytest.mark.parametrize(("extra", "done"), [((83531, 1), 1), ((83531, 2), 0)])
def test_vaccination_schedule(spark, chart, extra, done):
    chart.patient(1, born="2001-05-01")
    chart.visit(1, 1, "2001-06-01", "ped_initial")
    for vaccine, dose in ((783, 1), (1423, 1), extra):
        head = chart.obs(1, 1421)
        chart.obs(1, 984, vaccine, group=head)
        chart.obs(1, 1418, number=float(dose), group=head)
    assert rows(run(spark, chart, "vaccination"), "age_range", "vaccination_done") == [(45, done)]


def test_indicator_rules(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-05-01", "adult_initial")
    for answer, certainty in ((114190, 159393), (122604, 159392), (142474, None)):
        head = chart.obs(1, 159947)
        chart.obs(1, 1284, answer, group=head)
        if certainty:
            chart.obs(1, 159394, certainty, group=head)
    assert [r[0] for r in rows(run(spark, chart, "indicators"), "indicator_type_id")] == [2, 21]


def test_immunisation_doses_round_and_void(spark, chart):
    chart.patient(1)
    chart.visit(1, 1, "2001-05-01", "ped_initial")
    for dose, day, voided in ((0.4, "2001-01-01", 0), (0.5, "2001-02-01", 0), (2.0, "2001-03-01", 1)):
        head = chart.obs(1, 1421)
        chart.obs(1, 984, 886, group=head, voided=voided)
        chart.obs(1, 1418, number=dose, group=head)
        chart.obs(1, 1410, when=day, group=head)
    rec = chart.record(spark)
    concept = spark.createDataFrame([(886, "886AAA")], "concept_id long, uuid string")
    got = Reports(rec.replace(concept=concept), AS_OF).build("immunization_dose").first()
    assert (got["dose0"], got["dose1"], got["dose2"]) == (dt.datetime(2001, 1, 1), dt.datetime(2001, 2, 1), None)


def test_labels_exist_for_every_status(spark):
    assert {r["id"] for r in dimension(spark, "arv_status").collect()} >= set(st.WRITTEN)
    assert len(al.RULES) == 13
