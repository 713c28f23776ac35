"""The whole job over exports written for it: one person, odd exports, a fleet, arrivals."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import BURNT, EXPORT, PULSE, RECORDS, SCALE, SESSIONS, WALKED, document, measured, put, session, slept
from vitals.config import Layout
from vitals.plans import jobs, serving
from vitals.streaming import arrivals

FEB28, FEB29, MAR1 = dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)
OVERVIEW = (3, 250.0, 57.0, 69.9, 2533.0, FEB28, MAR1)
COUNTERS = {
    "bronze_records": 29, "bronze_workouts": 4, "malformed_records": 0, "malformed_workouts": 0,
    "silver_records": 17, "silver_sleep_intervals": 6, "silver_workouts": 3, "invalid_numeric_value": 2, "invalid_timestamp": 2,
    "gold_daily_heart_rate": 3, "gold_daily_resting_hr": 0, "gold_daily_hrv": 0, "gold_daily_respiratory_rate": 0, "gold_vo2max": 0,
    "gold_weight": 3, "gold_daily_activity": 3, "gold_daily_calendar": 3, "gold_daily_sleep": 2, "gold_workouts": 3,
    "gold_workout_summary": 3, "gold_summary": 1,
}


def rows(df):
    return [tuple(r) for r in df.collect()]


def counters(report):
    return {k: v for k, v in report["counters"].items() if not k.endswith("_local_day")}


@pytest.fixture(scope="module")
def layout(export_run):
    return Layout(export_run["root"])


def test_counters_report_and_checks(spark, export_run, layout):
    report = export_run["report"]
    assert counters(report) == COUNTERS
    assert report["date_range"] == ["2024-02-28", "2024-03-01"]
    bad = ["invalid numeric values below 1% of bronze", "invalid timestamps below 1% of bronze"]
    assert report["warnings"] == bad
    assert [c["status"] for c in report["checks"]] == ["pass", "pass", "warn", "warn"]
    stored = serving.latest_quality(spark, layout).collect()
    assert [(r["run_at"], r["warnings"]) for r in stored] == [("2024-03-02T00:00:00+00:00", bad)]


def test_bronze_keeps_text_and_drops_what_is_inside_workouts(spark, layout):
    bronze = jobs.bronze_records(spark, layout).collect()
    values = [r["value"] for r in bronze if r["type"] == PULSE]
    assert sorted(values) == sorted(["58", "58.0", "64", "64", "49", " 61 ", "n/a", "71", "?"])  # no 150, 151, 999
    assert {r["source_name"] for r in bronze} == {"Band", "Ring", "Pocket & Co", "a > b"}
    assert sum(r["unit"] is None for r in bronze) == 7  # the nights
    assert "55" in [r["value"] for r in jobs.bronze_records(spark, layout, (), "other").collect()]
    workouts = {r["duration_min"]: r for r in spark.read.parquet(layout.bronze_workouts).collect()}
    swim, yoga, odd = workouts["41.25"], workouts["20"], workouts["5.05"]
    assert (swim["active_energy_kcal"], swim["distance_km"], swim["indoor"]) == ("250.0", "1.75", "1")
    assert (yoga["active_energy_kcal"], yoga["distance_km"], yoga["indoor"]) == (None, None, None)
    assert (odd["active_energy_kcal"], odd["distance_km"], odd["source_name"]) == (None, None, "Ring")


def test_silver_types_and_days(spark, layout):
    silver = spark.read.parquet(layout.silver_records)
    pulses = sorted((r["local_date"], r["value"], r["ts_utc"]) for r in silver.where(F.col("type") == PULSE).collect())
    assert [(d, v) for d, v, _ in pulses] == [(FEB28, 58.0), (FEB28, 64.0), (FEB28, 64.0), (FEB29, 49.0), (MAR1, 61.0)]
    assert pulses[3][2] == dt.datetime(2024, 2, 28, 15, 30)  # half past midnight in +0900
    assert pulses[4][2] == dt.datetime(2024, 2, 29, 21, 5)
    assert sorted(r["minutes"] for r in spark.read.parquet(layout.silver_sleep).collect()) == [-2, 10, 30, 30, 90, 420]
    reasons = sorted(tuple(r["reasons"]) for r in spark.read.parquet(layout.quarantine).collect())
    assert reasons == [("invalid_numeric_value",), ("invalid_numeric_value", "invalid_timestamp"), ("invalid_timestamp",)]


@pytest.mark.parametrize(
    "name, want",
    [
        ("heart-rate", [(FEB28, 62.0, 58.0, 64.0, 3), (FEB29, 49.0, 49.0, 49.0, 1), (MAR1, 61.0, 61.0, 61.0, 1)]),
        ("weight", [(FEB28, 70.1), (FEB29, 70.15), (MAR1, 69.9)]),
        ("hrv", []),
        ("activity", [(FEB28, 5100.0, 120.0, None, None), (FEB29, 0.0, 311.0, None, None), (MAR1, 2500.0, None, None, None)]),
        ("calendar", [(FEB28, 5100.0, 120.0, None, 1, 2), (FEB29, 0.0, 311.0, None, 2, 0), (MAR1, 2500.0, None, None, 0, 1)]),
        ("sleep", [(FEB28, 30, None, None, None), (FEB29, 118, -2, 30, 10)]),
        ("workouts", [("Swimming", FEB28, 41.3, 250.0, 1.75, True), ("Yoga", FEB29, 20.0, None, None, None), ("", MAR1, 5.1, None, None, None)]),
        ("workout-summary", [("", 1, 5.1, None, None), ("Swimming", 1, 41.3, 250.0, 1.75), ("Yoga", 1, 20.0, None, None)]),
    ],
)
def test_gold_tables_as_served(spark, layout, name, want):
    assert rows(serving.metric(spark, layout, name)) == want


def test_served_overview_and_bundle(spark, layout, scratch):
    assert rows(serving.summary(spark, layout)) == [OVERVIEW]
    bundle = serving.dashboard(spark, layout)
    assert sorted(bundle) == ["calendar", "heartRate", "summary", "weight", "workouts"]
    assert rows(bundle["heartRate"])[0] == ("2024-02-28", 62.0) and rows(bundle["weight"])[-1] == ("2024-03-01", 69.9)
    assert ("Swimming", 1, 250.0) in rows(bundle["workouts"]) and rows(bundle["calendar"])[1][:2] == ("2024-02-29", 0.0)
    assert serving.metric(spark, layout, "no such table") is None and len(serving.metric_names()) == 11
    assert serving.ready(spark, layout) and not serving.ready(spark, Layout(f"{scratch}/nowhere"))


def test_rerun_changes_nothing(spark, export_path, export_run, layout):
    before = {t: sorted(map(str, spark.read.parquet(layout.gold(t)).collect())) for t in jobs.GOLD_TABLES}
    again = jobs.run_export(spark, export_path, export_run["root"], run_at="2024-03-03T00:00:00+00:00")
    assert again["counters"] == export_run["report"]["counters"]
    assert {t: sorted(map(str, spark.read.parquet(layout.gold(t)).collect())) for t in jobs.GOLD_TABLES} == before


def test_built_in_source_gives_the_same_gold(spark, export_path, scratch):
    root = f"{scratch}/dom"
    assert counters(jobs.run_export(spark, export_path, root, mode="dom")) == COUNTERS
    assert rows(serving.summary(spark, Layout(root))) == [OVERVIEW]


def test_missing_export(spark, scratch):
    with pytest.raises(FileNotFoundError):
        jobs.run_export(spark, f"{scratch}/no-such.xml", f"{scratch}/x")


@pytest.mark.parametrize(
    "elements, some",
    [
        ([], {}),
        ([measured(WALKED, "10", "2024-05-05 10:00:00")], {"bronze_records": 1, "silver_records": 1, "gold_daily_activity": 1, "gold_daily_calendar": 1}),
        ([slept("AsleepCore", "2024-05-05 01:00:00", "2024-05-05 02:00:00")], {"bronze_records": 1, "silver_sleep_intervals": 1, "gold_daily_sleep": 1}),
        ([session("Golf", "90", "2024-05-05 10:00:00")], {"bronze_workouts": 1, "silver_workouts": 1, "gold_workouts": 1, "gold_workout_summary": 1}),
    ],
    ids=["empty", "steps", "sleep", "workouts"],
)
def test_exports_without_most_kinds(spark, scratch, elements, some, request):
    root = f"{scratch}/{request.node.callspec.id}"
    report = jobs.run_export(spark, put(f"{root}.xml", document(*elements)), root)
    assert counters(report) == {**dict.fromkeys(COUNTERS, 0), **some, "gold_summary": 1}
    assert sum(k.startswith("gold_") for k in report["counters"]) == 12
    (overview,) = rows(serving.summary(spark, Layout(root)))
    assert overview[0] == some.get("gold_workouts", 0) and overview[2:4] == (None, None)
    for name in serving.metric_names():
        assert serving.metric(spark, Layout(root), name).count() == some.get(serving.METRIC_TABLES[name], 0)


def test_malformed_elements_are_kept_apart_and_counted(spark, scratch):
    text = document(
        measured(PULSE, "61", "2024-05-05 10:00:00"), f'<Record type="{PULSE} value="62"/>', '<Record type="a" type="b" value="1"/>',
        '<Record type="a&nbsp;" value="1"/>', session("Golf", "9", "2024-05-05 10:00:00"), '<Workout duration="5 a="b"><WorkoutStatistics sum="1"/></Workout>',
    )
    root = f"{scratch}/malformed"
    found = counters(jobs.run_export(spark, put(f"{root}.xml", text), root))
    assert (found["bronze_records"], found["malformed_records"], found["bronze_workouts"], found["malformed_workouts"]) == (1, 3, 1, 1)
    kept = jobs.elements(spark, Layout(root)).where(F.col("kind") == "malformed_record").select("value").collect()
    assert any('value="62"/>' in r["value"] for r in kept)


def test_sums_keep_every_digit(spark, scratch):
    tiny = [measured(WALKED, "1e-7", f"2024-05-05 10:{i // 60:02}:{i % 60:02}") for i in range(1000)]
    text = document(*tiny, measured(BURNT, "1e35", "2024-05-06 10:00:00"), measured(SCALE, "+nan", "2024-05-07 10:00:00"), measured(SCALE, "-inf", "2024-05-08 10:00:00"))
    root = f"{scratch}/sums"
    jobs.run_export(spark, put(f"{root}.xml", text), root)
    from vitals.config import HEALTH
    from vitals.operators import gold

    totals = gold.per_source_totals(spark.read.parquet(Layout(root).silver_records), HEALTH).collect()
    assert sorted(r["total"] for r in totals) == [pytest.approx(1e-4, rel=1e-12), 1e35]
    assert [str(r["value"]) for r in serving.metric(spark, Layout(root), "weight").collect()] == ["nan", "-inf"]


USER = ("user_id",)


@pytest.fixture(scope="module")
def fleet(spark, scratch):
    """Four people in key folders, one job: a full export, one without workouts and rejects, one more, an empty one."""
    landing = f"{scratch}/landing"
    put(f"{landing}/user_id=01/export.xml", EXPORT)
    put(f"{landing}/user_id=1/export.xml", document(measured(WALKED, "10", "2024-05-05 10:00:00")))
    put(f"{landing}/user_id=x y/export.xml", document(session("Golf", "90", "2024-05-05 10:00:00")))
    put(f"{landing}/user_id=none/export.xml", document())
    root = f"{scratch}/fleet"
    return Layout(root), jobs.run_export(spark, landing, root, run_at="t", keys=USER)


def test_each_entity_is_as_if_alone(spark, fleet, scratch):
    layout, out = fleet
    assert (out["entities"], out["entities_warned"]) == (4, 4)
    reports = {r["user_id"]: r.asDict(recursive=True) for r in serving.latest_quality(spark, layout, USER).collect()}
    assert set(reports) == {"01", "1", "x y", "none"}  # an empty export has its report, too
    assert {k: v for k, v in counters(reports["01"]).items()} == COUNTERS
    alone = jobs.run_export(spark, put(f"{scratch}/alone.xml", document(measured(WALKED, "10", "2024-05-05 10:00:00"))), f"{scratch}/alone", run_at="t")
    one = reports["1"]
    assert counters(one) == {**counters(alone), "gold_summary": 1}
    assert (one["checks"], one["warnings"], one["date_range"]) == (alone["checks"], alone["warnings"], alone["date_range"])
    assert one["warnings"] == ["workouts survived silver"]
    overviews = {r[0]: r[1:] for r in rows(serving.summary(spark, layout, keys=USER))}
    assert overviews["01"] == OVERVIEW and overviews["1"][0] == 0 and overviews["x y"][0] == 1


def test_fleet_serving_keeps_the_entity(spark, fleet):
    layout, _ = fleet
    everyone = serving.dashboard(spark, layout, keys=USER)
    assert all(df.columns[0] == "user_id" for df in everyone.values())
    assert [r["user_id"] for r in everyone["calendar"].collect()] == ["01"] * 3 + ["1"]
    mine = serving.dashboard(spark, layout, keys=USER, entity={"user_id": "01"})
    assert rows(mine["heartRate"])[0] == ("01", "2024-02-28", 62.0)
    assert rows(serving.metric(spark, layout, "activity", keys=USER, entity={"user_id": "1"})) == [("1", dt.date(2024, 5, 5), 10.0, None, None, None)]
    plan = serving.metric(spark, layout, "activity", keys=USER, entity={"user_id": "1"})._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,1)" in plan


def test_command_line_runs_a_fleet(spark, fleet, scratch, capsys):
    jobs.main(["--input", f"{scratch}/landing", "--root", f"{scratch}/by-command", "--keys", "user_id"])
    assert json.loads(capsys.readouterr().out)["entities"] == 4


def test_arrivals_rebuild_one_export_or_one_entity(spark, scratch):
    once = {"availableNow": True}
    landing, root = f"{scratch}/arrive", f"{scratch}/arrived"
    put(f"{landing}/user_id=01/first.xml", EXPORT)
    put(f"{landing}/user_id=1/first.xml", document(measured(WALKED, "10", "2024-05-05 10:00:00")))
    query = arrivals.watch_exports(spark, landing, root, f"{scratch}/progress", trigger=once, keys=USER)
    query.awaitTermination(600)
    assert query.exception() is None
    assert rows(serving.summary(spark, Layout(f"{root}/user_id=01"))) == [OVERVIEW]
    put(f"{landing}/user_id=1/second.xml", document(measured(WALKED, "20", "2024-05-06 10:00:00")))
    arrivals.watch_exports(spark, landing, root, f"{scratch}/progress", trigger=once, keys=USER).awaitTermination(600)
    assert rows(serving.metric(spark, Layout(f"{root}/user_id=1"), "activity")) == [(dt.date(2024, 5, 6), 20.0, None, None, None)]
    assert rows(serving.summary(spark, Layout(f"{root}/user_id=01"))) == [OVERVIEW]
    with pytest.raises(ValueError):
        arrivals.entity_root(root, f"{landing}/export.xml", USER)


def test_fixture_has_what_it_says():
    assert len(RECORDS) == 31 and len(SESSIONS) == 4


def test_malformed_children_of_workouts_are_kept_apart_and_counted(spark, scratch):
    bad = ['<WorkoutStatistics type="a & b" sum="1"/>', '<MetadataEntry key="k" key="l" value="1"/>', '<WorkoutStatistics type="t sum="1"/>']
    text = document(session("Golf", "9", "2024-05-05 10:00:00", "".join(bad)), session("Golf", "8", "2024-05-06 10:00:00"))
    root = f"{scratch}/malformed_children"
    found = counters(jobs.run_export(spark, put(f"{root}.xml", text), root))
    kept = jobs.elements(spark, Layout(root)).where(F.col("kind").startswith("malformed")).select("kind", "value").collect()
    want = [r["value"].strip() for r in kept if r["kind"] == "malformed_statistics"]
    assert found["bronze_workouts"] == 2 and found["malformed_workouts"] == 0
    assert (found.get("malformed_statistics"), found.get("malformed_metadata")) == (len(want), 1) and want
    assert any('sum="1"/>' in v for v in want) and len(kept) == len(want) + 1
