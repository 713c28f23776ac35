"""Runs as a whole: gold as a set, counters that come with the writes, empty exports, failed arrivals, views."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import EXPORT, PULSE, WALKED, document, measured, put
from tests.test_export import COUNTERS, OVERVIEW, counters, rows
from vitals.config import Layout
from vitals.plans import jobs, serving, snapshots
from vitals.streaming import arrivals

USER = ("user_id",)


def test_readers_see_the_old_run_until_the_new_one_is_whole(spark, scratch, monkeypatch):
    root = f"{scratch}/snapshots"
    layout = Layout(root)
    jobs.run_export(spark, put(f"{root}.xml", EXPORT), root)
    first, before = snapshots.current_run(layout), rows(serving.metric(spark, layout, "activity"))
    held = serving.metric(spark, layout, "calendar")
    seen = []
    write = jobs._write

    def watching(df, path, *rest):
        write(df, path, *rest)
        if "/gold/" in path:
            seen.append((rows(serving.metric(spark, layout, "activity")), rows(serving.summary(spark, layout))))

    monkeypatch.setattr(jobs, "_write", watching)
    jobs.run_export(spark, put(f"{root}.xml", document(measured(WALKED, "10", "2024-05-05 10:00:00"))), root)
    monkeypatch.undo()
    assert len(seen) == 7 and all(s == (before, [OVERVIEW]) for s in seen)
    assert rows(serving.metric(spark, layout, "activity")) == [(dt.date(2024, 5, 5), 10.0, None, None, None)]
    assert snapshots.current_run(layout) != first and len(held.collect()) == 3  # begun before the switch


def test_a_run_that_dies_leaves_gold_alone_and_old_runs_go(spark, scratch, monkeypatch):
    root = f"{scratch}/dying"
    layout, source = Layout(root), put(f"{scratch}/dying.xml", EXPORT)
    jobs.run_export(spark, source, root)
    first = snapshots.current_run(layout)

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs.gold, "summary", fail)
    with pytest.raises(RuntimeError):
        jobs.run_export(spark, put(f"{scratch}/other.xml", document()), root)
    monkeypatch.undo()
    assert snapshots.current_run(layout) == first and rows(serving.summary(spark, layout)) == [OVERVIEW]
    for _ in range(2):
        jobs.run_export(spark, source, root)
    import os

    runs = [n for n in os.listdir(f"{root}/gold") if n.startswith("run-")]
    assert len(runs) == 2 and snapshots.current_run(layout) == max(runs)


def test_counters_of_one_export_come_with_its_writes(spark, scratch, monkeypatch):
    def fail(*_):
        raise AssertionError("rows are counted again")

    monkeypatch.setattr(jobs.quality, "count_rows", fail)
    root = f"{scratch}/observed"
    assert counters(jobs.run_export(spark, put(f"{root}.xml", EXPORT), root)) == COUNTERS


def test_an_empty_export_of_a_fleet_has_a_report(spark, scratch):
    landing, root = f"{scratch}/with-empty", f"{scratch}/with-empty-layers"
    put(f"{landing}/user_id=2/export.xml", document(measured(PULSE, "61", "2024-05-05 10:00:00")))
    put(f"{landing}/user_id=3/export.xml", "")
    out = jobs.run_export(spark, landing, root, run_at="t", keys=USER)
    assert (out["entities"], out["entities_warned"]) == (2, 2)
    reports = {r["user_id"]: r for r in serving.latest_quality(spark, Layout(root), USER).collect()}
    empty = reports["3"]["counters"]
    assert set(empty.values()) == {0} and set(COUNTERS) <= set(empty) | {"gold_summary"}
    assert reports["3"]["warnings"][:2] == ["records survived silver", "workouts survived silver"]
    assert reports["2"]["counters"]["silver_records"] == 1


def test_a_broken_arrival_leaves_the_others_alone(spark, scratch, monkeypatch):
    once = {"availableNow": True}
    landing, root = f"{scratch}/three", f"{scratch}/three-layers"
    for user in ("1", "2", "3"):
        put(f"{landing}/user_id={user}/export.xml", document(measured(WALKED, user, "2024-05-05 10:00:00")))
    put(f"{landing}/nobody/export.xml", EXPORT)
    run, tried = jobs.run_export, []

    def breaking(spark, path, place, *rest):
        tried.append(path)
        if "user_id=2" in path:
            raise ValueError("not well-formed (invalid token): line 1, column 0")
        return run(spark, path, place, *rest)

    monkeypatch.setattr(jobs, "run_export", breaking)
    for _ in range(2):  # a restart repeats nothing
        query = arrivals.watch_exports(spark, landing, root, f"{scratch}/three-progress", trigger=once, keys=USER)
        query.awaitTermination(600)
        assert query.exception() is None
    assert len(tried) == 4  # the broken one twice
    for user in ("1", "3"):
        assert rows(serving.metric(spark, Layout(f"{root}/user_id={user}"), "activity"))[0][1] == float(user)
    assert not serving.ready(spark, Layout(f"{root}/user_id=2"))
    failed = {r["path"].split("/")[-2]: (r["attempts"], r["error"]) for r in arrivals.failures(spark, root).collect()}
    assert failed["user_id=2"] == (2, "ValueError: not well-formed (invalid token): line 1, column 0")
    assert failed["nobody"][0] == 1 and len(failed) == 2
    assert arrivals.failures(spark, f"{scratch}/nowhere").count() == 0


def test_views_and_list_of_names(spark, export_run):
    layout = Layout(export_run["root"])
    names = serving.register_views(spark, layout)
    assert {"bronze_records", "silver_records", "silver_sleep", "silver_workouts", "gold_daily_activity", "gold_daily_heart_rate"} <= set(names)
    found = spark.sql("SELECT count(*) AS n, (SELECT count(*) FROM silver_sleep) AS m FROM silver_records").first()
    assert tuple(found) == (17, 6)
    listed = {r["name"]: r["n_rows"] for r in serving.metric_list(spark, layout).collect()}
    assert sorted(listed) == serving.metric_names() and listed["heart-rate"] == 3 and listed["hrv"] == 0
    for name in names:
        spark.catalog.dropTempView(name)
    assert rows(spark.read.parquet(layout.silver_records).agg(F.count(F.lit(1)))) == [(17,)]
