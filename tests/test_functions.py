"""Edge cases of the shared expressions and properties of the operators."""

from __future__ import annotations

import datetime as dt
import math
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vitals.functions import (
    day_text,
    full_sum,
    local_day,
    minute_boundaries,
    ntile_bucket,
    parse_double,
    parse_instant,
    round_half_away,
)


def col1(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


NUMBERS = [
    "60", "60.0", " 60 ", "\t5\n", "-1.5e3", ".5", "5.", "+.5", "1E+5", "1e400", "1e-400", "00012", "1_000", "1_0.5_5", "1e1_0", "nan", "+NaN", "-nan",
    "inf", "+inf", "-Infinity", "60d", "60f", "0x1p3", "1__0", "_1", "1_", "1._5", "1e_1", ".", "1e", "--1", "- 5", "1 2", "1,000", "bogus", "", "  ", None,
]
TIMES = [
    "2025-12-01 08:00:00 +0530", "2025-12-01 08:00:00 -0800", "2025-12-01 08:00:00 +05:30", "2025-12-01 08:00:00 +05", "2025-1-2  8:0:0 -08:30",
    " 2025-12-01 08:00:00 +0530\n", "99-1-1 0:0:0 +00", "2025-12-01 08:00:00 +9959", "2025-12-01 08:00:00+0530", "2025-12-01T08:00:00 +0530", "2025-12-01 08:00:00 Z",
    "2025-12-01 08:00:00 +5", "2025-12-01 08:00 +0530", "2025-13-01 08:00:00 +0530", "2025-2-30 08:00:00 +05", "2025-12-01 24:00:00 +0530", "2025-12-01 08:00:00 +053",
    "-2025-12-01 08:00:00 +0530", "12025-12-01 08:00:00 +0530", "not a time", "", None,
]


def duck(text, values):
    import duckdb

    with duckdb.connect() as con:
        con.execute("SET TimeZone='UTC'")
        return [con.execute(f"SELECT {text}", [v]).fetchone()[0] for v in values]


def test_numbers_read_as_the_reference_engine_does(spark):
    got = col1(spark, NUMBERS, "string", parse_double)
    assert list(map(str, got)) == list(map(str, duck("TRY_CAST(? AS DOUBLE)", NUMBERS)))
    assert got[12] == 1000.0 and math.isnan(got[16]) and got[21:24] == [None] * 3


def test_times_read_as_the_reference_engine_does(spark):
    got = col1(spark, TIMES, "string", lambda c: F.unix_seconds(parse_instant(c)))
    assert got == duck("CAST(epoch(TRY_STRPTIME(?, '%Y-%m-%d %H:%M:%S %z')) AS BIGINT)", TIMES)
    assert got[0] == got[2] and got[8:] == [None] * 14


def test_local_day_is_wall_clock(spark):
    texts = ["2025-12-01 02:00:00 +0530", "2025-12-31 23:00:00 -0800", " 2025-3-1  2:00:00 +05", "soon"]
    got = col1(spark, texts, "string", local_day)
    assert got == [dt.date(2025, 12, 1), dt.date(2025, 12, 31), dt.date(2025, 3, 1), None]


def test_minute_boundaries(spark):
    rows = [
        ("2025-12-01 00:00:59 +0000", "2025-12-01 00:01:01 +0000", 1),
        ("2025-12-01 23:59:59 +0530", "2025-12-02 00:01:01 +0530", 2),
        ("2025-12-01 01:00:00 +0000", "2025-12-01 00:59:00 +0000", -1),
        ("2025-12-01 01:00:00 +0000", "2025-12-01 01:00:30 +0000", 0),
        ("1969-12-31 23:59:59 +0000", "1970-01-01 00:00:01 +0000", 1),
    ]
    df = spark.createDataFrame(rows, "a string, b string, want long")
    got = df.select(minute_boundaries(parse_instant("a"), parse_instant("b")).alias("m"), "want").collect()
    assert [r["m"] for r in got] == [r["want"] for r in got]


@pytest.mark.parametrize(
    "x,n,want",
    [(1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13), (63.333, 1, 63.3), (1e308, 2, 1e308)],
)
def test_round_half_away(spark, x, n, want):
    assert col1(spark, [x], "double", lambda c: round_half_away(c, n)) == [want]


def test_round_special_values(spark):
    got = col1(spark, [float("nan"), float("inf"), None], "double", lambda c: round_half_away(c, 2))
    assert math.isnan(got[0]) and got[1] == math.inf and got[2] is None


def test_full_sum_is_rounded_once_in_any_order(spark):
    import random

    random.seed(4)
    values = [random.choice([0.1, 0.07, 1e-7, 123456.78, -0.05, 3e9, random.random()]) for _ in range(2000)]
    sums = {spark.createDataFrame([(v,) for v in random.sample(values, 2000)], "x double").repartition(n).agg(full_sum("x")).first()[0] for n in (1, 3, 7)}
    assert sums == {math.fsum(values)}


def test_full_sum_of_special_values(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(full_sum("x")).first()[0]

    assert total(*[1e-7] * 1000) == pytest.approx(1e-4, rel=1e-12) and total(1e35, 1e35) == 2e35 and total(1e308, 1e308) == math.inf
    assert math.isnan(total(1.0, math.nan)) and total(1.0, math.inf) == math.inf and math.isnan(total(math.inf, -math.inf))
    assert total(None, None) is None and total(None, 2.5) == 2.5 and total(5e-324, 5e-324) == 1e-323


def test_ntile_bucket_matches_ntile(spark):
    rows = [(n, i) for n in range(0, 23) for i in range(n)]
    df = spark.createDataFrame(rows, "n int, i int")
    w = Window.partitionBy("n").orderBy("i")
    got = df.select(
        F.ntile(4).over(w).cast("bigint").alias("want"),
        ntile_bucket(F.row_number().over(w), F.count(F.lit(1)).over(Window.partitionBy("n")), 4).alias("got"),
    ).collect()
    assert all(r["want"] == r["got"] for r in got)


def test_levels_without_keys_match_a_window(spark):
    from vitals.operators.ranking import positive_ntile

    special = [None, 0.0, -3.0, float("nan"), float("inf"), 1e-300, 1e300]
    rows = [(i, special[i % 50] if i % 50 < len(special) else float(i * 7919 % 113)) for i in range(900)]
    df = spark.createDataFrame(rows, "day int, v double")
    got = {r["day"]: r["level"] for r in positive_ntile(df, "v", "day", 4, (), "level").collect()}
    w = Window.partitionBy(F.col("v") > 0).orderBy("v", "day")
    want = df.withColumn("level", F.when(F.col("v") > 0, F.ntile(4).over(w)).otherwise(0))
    assert got == {r["day"]: r["level"] for r in want.collect()} and len(got) == 900


def test_levels_of_several_columns_share_one_pass(spark):
    from vitals.operators.ranking import positive_ntiles

    rows = [(i, None if i % 11 == 0 else float(i * 31 % 17), float(i * 7 % 5) - 1, f"x{i}", i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "day int, a double, b double, note string, k int")
    for keys in ((), ("k",)):
        got = positive_ntiles(df, {"la": "a", "lb": "b"}, "day", 4, keys)
        w = lambda c: Window.partitionBy(F.col(c) > 0, *keys).orderBy(c, "day")
        level = lambda c: F.when(F.col(c) > 0, F.ntile(4).over(w(c))).otherwise(0).cast("bigint")
        want = df.withColumns({"la": level("a"), "lb": level("b")})
        assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert positive_ntiles(df.limit(0), {"la": "a"}, "day", 4).collect() == []


def test_levels_derive_their_source_once(spark):
    from vitals.config import EVENTS
    from vitals.operators import gold, silver
    from vitals.sources import staging

    s = silver.clean_quantities(staging.raw_records(spark, SF_SMALL).drop("user_id"), EVENTS)
    levels = gold.calendar_levels(gold.daily_activity(s, EVENTS), EVENTS)
    levels.collect()
    final = levels._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_overview_of_one_pass_equals_that_of_the_tables(spark):
    from vitals.config import EVENTS
    from vitals.operators import gold, silver
    from vitals.sources import staging

    workouts = spark.createDataFrame([], "user_id bigint, activity string, n_workouts bigint, total_kcal double")
    for keys in ((), ("user_id",)):
        s = silver.clean_quantities(staging.raw_records(spark, SF_SMALL), EVENTS, keys)
        stored = gold.stored_days(gold.daily_stats(s, EVENTS, keys), gold.daily_activity(s, EVENTS, keys), EVENTS, keys)
        one, two = (gold.summary(d, workouts, EVENTS, keys).collect() for d in (gold.overview_days(s, EVENTS, keys), stored))
        assert sorted(one, key=str) == sorted(two, key=str) and len(one) >= 1
        none = gold.summary(gold.overview_days(s.limit(0), EVENTS, keys), workouts, EVENTS, keys).collect()
        assert [r["total_workouts"] for r in none] == ([] if keys else [0])


def test_levels_start_no_job_and_gather_no_rows(spark):
    from vitals.operators.ranking import positive_ntile

    tracker, group = spark.sparkContext.statusTracker(), "levels-plan"
    df = spark.range(100).select(F.col("id").cast("double").alias("v"), "id")
    spark.sparkContext.setJobGroup(group, "")
    plan = positive_ntile(df, "v", "id", 4, (), "level")
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext._jsc.clearJobGroup()
    assert plan.count() == 100


def test_day_text(spark):
    rows = [(dt.date(2025, 12, 1), 1000.0, 150.4, 2.5), (dt.date(2025, 12, 2), 0.0, None, 3.0),
            (dt.date(2026, 1, 9), None, None, None)]
    df = spark.createDataFrame(rows, "d date, s double, k double, km double")
    got = [r[0] for r in df.select(day_text("d", "s", "k", "km")).collect()]
    assert got == ["1,000 steps · 150 kcal · 2.5 km on Dec 1, 2025", "3 km on Dec 2, 2025", "No activity on Jan 9, 2026"]


def test_month_labels_suppress_clipped_month(spark):
    from vitals.operators import calendar

    cal = spark.createDataFrame(
        [(dt.date(2024, 1, 29), 1.0, 1.0, 1.0, 1, 1)],
        "local_date date, steps double, active_kcal double, distance_km double, level_kcal long, level_steps long",
    )
    grid = calendar.calendar_grid(cal, "last-year", "kcal")
    assert grid.where("local_date IS NOT NULL").count() == 365
    labels = {r["week"]: r["label"] for r in calendar.month_labels(grid).collect()}
    # the period starts on Mon 2023-01-30: January holds two days of week 0 only
    assert labels[0] is None and labels[1] == "Feb"
    assert [v for v in labels.values() if v][-1] == "Jan"
    assert calendar.active_days(grid).first()[0] == 1


def tree_of(path):
    """Records outside workouts, all records, and workouts, read with the standard library's parser."""
    import xml.etree.ElementTree as ET

    records, every, workouts, depth = [], [], [], 0
    for event, e in ET.iterparse(path, events=("start", "end")):
        if event == "start":
            depth += e.tag == "Workout"
        elif e.tag == "Workout":
            depth -= 1
            children = [[(c.get(a), c.get(b)) for c in e if c.tag == t] for t, a, b in (("MetadataEntry", "key", "value"), ("WorkoutStatistics", "type", "sum"))]
            workouts.append((e.get("workoutActivityType"), e.get("duration"), *children))
        elif e.tag == "Record":
            row = tuple(e.get(a) for a in ("type", "sourceName", "unit", "startDate", "value"))
            every.append(row)
            if depth == 0:
                records.append(row)
    return sorted(records, key=str), sorted(every, key=str), sorted(workouts, key=str)


def scanned(spark, path, mode="split"):
    from vitals.sources import xml

    columns = ("type", "source_name", "unit", "start_date", "value")
    records, workouts = xml.read_export(spark, path, mode)
    every = xml.scan_records(spark, path, mode)
    pairs = lambda array: [tuple(c) for c in array or []]
    sessions = [(r["_workoutActivityType"], r["_duration"], pairs(r["MetadataEntry"]), pairs(r["WorkoutStatistics"])) for r in workouts.collect()]
    return (*(sorted((tuple(r) for r in df.select(*columns).collect()), key=str) for df in (records, every)), sorted(sessions, key=str))


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], "1")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def nested_export(seed, n):
    """Workouts in workouts, records at any depth, comments and CDATA with tag text, line breaks in tags."""
    import random

    pick = random.Random(seed)

    def record(i, end="/>"):
        return f'<Record type="T{i % 3}" sourceName="S &amp; {i}" startDate="a>b" value="{i}"{end}'

    def child(i):
        return pick.choice([
            record(i), f'<WorkoutEvent><Meta>{record(i)}</Meta><MetadataEntry key="no" value="no"/></WorkoutEvent>',
            f'<MetadataEntry key="indoor" value="{i}"/>', f'<WorkoutStatistics type="energy" sum="{i}.5"/>', '<!-- <MetadataEntry key="x" value="y"/> -->',
            f'<Workout workoutActivityType="Inner" duration="{i}">{record(i)}<WorkoutStatistics type="energy" sum="7"/></Workout>',
            record(i, ">") + '<MetadataEntry key="in" value="1"/></Record>',
        ])

    out = ['<?xml version="1.0"?>', "<!DOCTYPE H [ <!ELEMENT Record ANY> ]>", "<H>"]
    for i in range(n):
        pad = "pad " * pick.randrange(200)
        out.append(pick.choice([
            record(i), record(i), record(i, ">") + '<MetadataEntry key="k" value="v"/></Record>', f"<!-- {record(i)} <Workout> <![CDATA[ {pad} -->",
            f'<Note><![CDATA[ {record(i)} <Workout a="b"> <!-- </Note> {pad} ]]></Note>', f"<Workout\n workoutActivityType='W{i}' duration=\"{i}\"/>",
            f'<Workout workoutActivityType="W{i}" duration="{i}">{"".join(child(i * 10 + j) for j in range(pick.randrange(30)))}</Workout>',
        ]))
    return "\n".join([*out, "</H>", ""])


@pytest.mark.parametrize("seed, size", [(1, "128m"), (1, "900"), (2, "4k")])
def test_scan_is_exact_wherever_the_file_is_split(spark, scratch, small_splits, seed, size):
    from tests.conftest import put

    path = put(f"{scratch}/nested-{seed}-{size}.xml", nested_export(seed, 60))
    small_splits(size)
    assert scanned(spark, path) == tree_of(path)


def test_scan_of_the_fixture_in_both_modes(spark, export_path):
    assert scanned(spark, export_path) == tree_of(export_path)
    assert scanned(spark, export_path, "dom") == tree_of(export_path)


def test_text_rows_stay_small(spark, scratch, small_splits):
    from tests.conftest import PULSE, document, measured, put, session
    from vitals.sources import xml

    records = [measured(PULSE, str(i), "2024-05-05 10:00:00") for i in range(12_000)]
    path = put(f"{scratch}/long.xml", document(*records, *(session("Golf", str(i), "2024-05-05 10:00:00") for i in range(20))))
    small_splits("1m")
    text = xml._text(spark, path)
    assert text.rdd.getNumPartitions() > 2 and text.agg(F.max(F.length("value"))).first()[0] < 1000
    records, workouts = xml.read_export(spark, path)
    assert (records.count(), workouts.count()) == (12_000, 20)


def test_shuffled_input_gives_same_gold(spark):
    from vitals.config import EVENTS
    from vitals.operators import gold, silver
    from vitals.sources import staging

    b = staging.raw_records(spark, SF_SMALL).drop("user_id")
    a1 = gold.daily_activity(silver.clean_quantities(b, EVENTS), EVENTS)
    a2 = gold.daily_activity(silver.clean_quantities(b.repartition(13, "value"), EVENTS), EVENTS)
    assert a1.exceptAll(a2).count() == 0 and a2.exceptAll(a1).count() == 0


def test_levels_are_quartiles(spark):
    from vitals.config import EVENTS
    from vitals.operators import gold, silver
    from vitals.sources import staging

    keys = ("user_id",)
    s = silver.clean_quantities(staging.raw_records(spark, SF_SMALL), EVENTS, keys)
    cal = gold.calendar_levels(gold.daily_activity(s, EVENTS, keys), EVENTS, keys)
    assert cal.where("level_steps NOT BETWEEN 0 AND 4 OR level_kcal NOT BETWEEN 0 AND 4").count() == 0
    sizes = cal.where("steps > 0").groupBy("user_id", "level_steps").count()
    spread = sizes.groupBy("user_id").agg((F.max("count") - F.min("count")).alias("d"))
    assert spread.agg(F.max("d")).first()[0] <= 1
    assert cal.where("NOT steps > 0 AND level_steps <> 0").count() == 0


def test_best_source_at_most_sum_of_sources(spark):
    from vitals.config import EVENTS
    from vitals.operators import gold, silver
    from vitals.sources import staging

    s = silver.clean_quantities(staging.raw_records(spark, SF_SMALL).drop("user_id"), EVENTS)
    per = gold.per_source_totals(s, EVENTS)
    best = gold.best_source(per)
    total = per.groupBy("type", "local_date").agg(F.sum("total").alias("all"))
    assert best.join(total, ["type", "local_date"]).where("total > all + 1e-6").count() == 0


def test_parse_double_round_trips_python_floats(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=200))
    def check(xs):
        texts = [repr(x) for x in xs] + [f"{x:.3e}" for x in xs]
        got = col1(spark, texts, "string", parse_double)
        assert got == [float(t) for t in texts]

    check()


def test_round_half_away_matches_exact_decimal_rounding(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    def expected(x: float, n: int) -> float:
        p = x * 10.0**n
        r = float(Decimal(p).quantize(Decimal(1), rounding=ROUND_HALF_UP))
        return r / 10.0**n

    values = st.one_of(
        st.floats(min_value=-1e9, max_value=1e9, allow_nan=False),
        st.integers(-10**6, 10**6).map(lambda i: i / 200.0),  # many exact ties
    )

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(values, min_size=1, max_size=300))
    def check(xs):
        for n in (0, 1, 2):
            got = col1(spark, xs, "double", lambda c: round_half_away(c, n))
            assert got == [expected(x, n) for x in xs]

    check()


def test_attributes_in_any_legal_spelling(spark, scratch):
    from tests.conftest import put

    text = "\n".join([
        "<H>", ' <Record type="T" sourceName="x>y" value="1"/>', """ <Record type="T" sourceName="it's" value="2"/>""",
        """ <Record type='T' sourceName='q"q' value='3'/>""", ' <Record\ttype="T"\n sourceName = "tab" value="4"></Record>',
        ' <Record type="T" sourceName=" spaced " value=" 5 "/>', ' <Record note="a sourceName=" type="T" value="&#65;&#x42;&lt;&apos;"/>', "</H>", "",
    ])
    path = put(f"{scratch}/spelled.xml", text)
    assert scanned(spark, path) == tree_of(path)
    assert scanned(spark, path, "dom") == tree_of(path)


def test_no_private_folder_on_a_cluster(spark):
    from vitals import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session)
    assert session.is_local("local[4]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]")


def test_dedup_is_idempotent_under_duplicated_input(spark):
    from vitals.config import EVENTS
    from vitals.operators import silver
    from vitals.sources import staging

    b = staging.raw_records(spark, SF_SMALL).drop("user_id")
    once = silver.clean_quantities(b, EVENTS)
    twice = silver.clean_quantities(b.unionByName(b), EVENTS)
    assert once.count() == twice.count()
    assert once.exceptAll(twice).count() == 0
    # cleaning silver-shaped text again changes nothing either
    assert once.distinct().count() == once.count()


def test_checks_skip_missing_counters(spark):
    from vitals.operators import quality

    counters = spark.createDataFrame(
        [("bronze_records", 1000), ("silver_records", 5), ("invalid_numeric_value", 9), ("invalid_timestamp", 10)],
        "counter string, value long",
    )
    got = {r["check"]: (r["value"], r["status"]) for r in quality.checks(counters).collect()}
    assert got == {
        "records survived silver": (5, "pass"),
        "workouts survived silver": (None, "skipped"),
        "invalid numeric values below 1% of bronze": (9, "pass"),
        "invalid timestamps below 1% of bronze": (10, "warn"),
    }
    rep = quality.report(counters, "t").first()
    assert rep["warnings"] == ["invalid timestamps below 1% of bronze"]
    assert rep["date_range"] == ["None", "None"]


def test_counters_of_a_fleet_are_dealt_before_they_are_grouped(spark):
    """Zeros of many entities are not held in memory in front of the shuffle (F6-F8); a later stage still wins."""
    from vitals.operators import quality

    entities = spark.createDataFrame([("a",), ("b",), (None,)], "user_id string")
    later = spark.createDataFrame([("a", "x", 5), (None, "y", 7)], "user_id string, counter string, value bigint")
    merged = quality.merge_counters([quality.zero_counters(entities, ["x", "y"], ("user_id",)), later], ("user_id",))
    rows = {(r["user_id"], r["counter"]): r["value"] for r in merged.collect()}
    assert rows == {("a", "x"): 5, ("a", "y"): 0, ("b", "x"): 0, ("b", "y"): 0, (None, "x"): 0, (None, "y"): 7}
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(user_id" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning(user_id" in x and "counter" in x], plan
