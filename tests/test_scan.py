"""The positional scan: its state along many splits, what is no markup, its plan; times parsed once."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import PULSE, SF_SMALL, document, measured, put, session
from tests.test_functions import TIMES
from vitals.functions.parse import local_day, parse_instant, parse_time
from vitals.session import scratch_path
from vitals.sources import xml


def random_moves(draw, n):
    return [(row, *draw.choice([("W", 0), ("W", 0), ("x", 0), ("x", 0), ("w", 0), ("C", 0), ("D", 0), ("P", 0), ("-", 1), ("-", 2), ("-", 4), ("x", 3)])) for row in range(n)]


def plain_state(moves, block, mode, stack):
    """The state behind ``moves``, one move after the other."""
    for row, action, ends in moves:
        if mode != "N":
            mode = "N" if ends & {"C": 1, "D": 2, "P": 4}[mode] else mode
        elif action == "W":
            stack = [*stack, f"{block}:{row}"]
        elif action == "x":
            stack = stack[:-1]
        elif action in "CDP":
            mode = action
    return mode, stack


def test_summaries_are_associative_and_exact():
    draw = random.Random(1)
    for _ in range(300):
        runs = [random_moves(draw, draw.randrange(8)) for _ in range(3)]
        a, b, c = (xml.Summary.of(i, m) for i, m in enumerate(runs))
        assert a.then(b).then(c) == a.then(b.then(c))
        for mode in "NCDP":
            state = (mode, ["1:1", "1:2"])
            for i, m in enumerate(runs):
                state = plain_state(m, i, *state)
            assert a.then(b).then(c).after(mode, ["1:1", "1:2"]) == state


def test_ten_thousand_splits_of_one_file(spark):
    draw = random.Random(2)
    size, rows, want, state = 1000, [], {}, ("N", [])
    for i in range(10_000):
        moves = random_moves(draw, draw.randrange(3))
        rows.append((7, i * size, json.dumps(xml.Summary.of(i * size, moves))))
        want[i * size] = state
        state = plain_state(moves, i * size, *state)
    draw.shuffle(rows)
    splits = spark.createDataFrame(rows, "file bigint, block bigint, summary string")
    found = {r["block"]: (r["mode"], r["stack"]) for r in xml.starts_of(splits, 256 * size).collect()}
    assert found == want
    starts = xml.starts_of(splits.where("block < 0"), 256)
    assert starts.collect() == []


def test_spans_are_the_rows_inside():
    draw = random.Random(3)
    for _ in range(300):
        moves = random_moves(draw, 12)
        mode, stack = draw.choice("NNCDP"), draw.choice([[], [], ["9:9"], ["9:9", "9:10"]])
        inside = {}
        for lo, hi, outer in xml.spans_of(5, 0, 14, moves, mode, stack):
            for row in range(lo, hi + 1):
                assert row not in inside
                inside[row] = outer
        for row in range(15):
            before_mode, before = plain_state([m for m in moves if m[0] < row], 5, mode, stack)
            action = moves[row][1] if row < len(moves) else "-"
            if before_mode != "N":
                want = [None]
            elif before:
                want = [before[0]]
            elif action in "Ww":
                want = [f"5:{row}"]
            else:
                want = []
            assert ([inside[row]] if row in inside else []) == want, (moves, mode, stack, row)


def test_what_is_no_markup_and_references_to_no_character(spark, scratch):
    from vitals.config import Layout
    from vitals.plans import jobs

    text = document(
        measured(PULSE, "61", "2024-05-05 10:00:00"),
        f"<?note {measured(PULSE, '9', '2024-05-05 10:00:00')} <Workout> ?>",
        f"<?note?>{measured(PULSE, '62', '2024-05-05 10:01:00')}",
        '<Record type="T" value="&#xD800;"/>', '<Record type="T" value="&#0;"/>', '<Record type="T" value="&#x110000;"/>',
        '<Record type="T" sourceName="&#128512; &#x41;" value="1"/>', '<Record type="T" value="&lt;&quot;&amp;lt;"/>',
        session("Golf", "9", "2024-05-05 10:00:00", '<MetadataEntry key="&#xDFFF;" value="1"/><?x <MetadataEntry key="k" value="v"/> ?>'),
    )
    path, root = put(f"{scratch}/no-markup.xml", text), f"{scratch}/no-markup"
    found = jobs.run_export(spark, path, root)["counters"]
    assert (found["bronze_records"], found["malformed_records"], found["bronze_workouts"], found["malformed_metadata"]) == (4, 3, 1, 1)
    values = {r["value"]: r["source_name"] for r in jobs.bronze_records(spark, Layout(root)).collect()}
    assert values == {"61": "Band", "62": "Band", "1": "\U0001f600 A", '<"&lt;': None}


def test_python_sees_no_record_and_nothing_is_broadcast_by_force(spark, export_path):
    before = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")}
    records, _ = xml.read_export(spark, export_path)
    plan = records._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "Python" not in plan and "hint" not in plan.lower()
    assert records.count() == 29
    assert {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")} == before


def test_rows_of_text_are_not_shuffled(spark, export_path):
    """Placing a row costs no join and no shuffle, however many rows are inside workouts."""
    records, _ = xml.read_export(spark, export_path)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan, plan


def test_dom_holds_and_writes_no_record_outside_workouts(spark, export_path, monkeypatch):
    """Records that no workout has stream past the hashes of those inside: one shuffle, no sort, no aggregation."""
    written = {}
    monkeypatch.setattr(xml, "scratch_path", lambda s, name: written.setdefault(name, scratch_path(s, name)))
    records, _ = xml.read_export(spark, export_path, mode="dom")
    plan = records._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    streamed = plan.children().apply(0)
    while streamed.nodeName() != "Join":
        assert streamed.nodeName() == "Project", plan.toString()
        streamed = streamed.children().apply(0)
    assert "LeftAnti" in streamed.toString().splitlines()[0]
    assert "Aggregate" not in streamed.children().apply(0).toString(), plan.toString()
    assert records.count() == 29
    final = records._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final, final
    assert spark.read.parquet(written["tags"]).where(F.col("lane") == xml.Walk.OUTSIDE).count() == 0


def test_difference_is_a_multiset_difference(spark):
    schema = "a string, b string"
    draw = random.Random(5)
    rows = [(draw.choice(["x", "y", None, ""]), draw.choice(["1", "x", None, ""])) for _ in range(200)]
    gone = draw.sample(rows, 60)
    # None and a text change places: other rows with the same hash
    rows += [("swap", None), (None, "swap"), ("swap", None), ("only", "here"), ("only", "here")]
    gone += [("swap", None)]
    found = xml._difference(spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame(gone, schema)).collect()
    assert Counter(map(tuple, found)) == Counter(rows) - Counter(gone)
    assert xml._difference(spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)).count() == len(rows)
    assert xml._difference(spark.createDataFrame(rows, schema), spark.createDataFrame(rows, schema)).count() == 0


def test_staged_records_need_no_statistics(spark):
    from vitals.sources import staging

    plan = staging.export_records(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "l_orderkey" not in plan, plan


@pytest.mark.parametrize("value", ["a", "", "x>y", "it's", "  two  ", "&lt;&lt;HK&gt;, name:W&gt;", "ä 日本", "'", "=", " type=", "/>", "a=b c=d"])
def test_fast_and_slow_reading_agree(spark, scratch, value):
    # one blank more makes a tag unlike those that exports write, so the XML parser reads it
    tags = [f'<Record type="T" sourceName="{value}" device="&lt;d&gt;" value="{value}"{end}' for end in ("/>", ' />text "q" type="5"', " \n/>", "></Record>")]
    tags += [f'<Record  type="T" sourceName="{value}" value="{value}"/>']
    path = put(f"{scratch}/agree-{abs(hash(value))}.xml", document(*tags))
    rows = {(r["type"], r["source_name"], r["value"]) for r in xml.scan_records(spark, path).collect()}
    import html

    assert rows == {("T", html.unescape(value), html.unescape(value))}
    assert xml.scan_records(spark, path).count() == len(tags)


def test_one_reading_gives_instant_and_day(spark):
    df = spark.createDataFrame([(t,) for t in [*TIMES, "2024-03-01 6:05:00 +0900", "+12024-01-01 10:00:00 +0900", "0000-01-01 00:00:00 +0000"]], "x string")
    rows = df.select(F.unix_seconds(parse_instant("x")).alias("a"), local_day("x").cast("string").alias("b"), F.unix_seconds(parse_time("x")["instant"]).alias("c"), parse_time("x")["day"].cast("string").alias("d")).collect()
    assert all(r["a"] == r["c"] for r in rows)
    assert all(r["b"] == r["d"] for r in rows if r["a"] is not None)
    assert any(r["d"] == "2024-03-01" for r in rows)


def test_times_are_parsed_once(spark):
    from vitals.config import EVENTS
    from vitals.operators import silver
    from vitals.sources import staging

    stored = staging.raw_records(spark, SF_SMALL).drop("user_id")
    for clean, columns in ((silver.clean_quantities, 1), (silver.clean_intervals, 2)):
        plan = clean(stored, EVENTS)._jdf.queryExecution().optimizedPlan().toString()
        source = stored._jdf.queryExecution().optimizedPlan().toString()
        parses = plan.lower().count("gettimestamp(") - source.lower().count("gettimestamp(")
        assert 0 < parses <= 2 * columns, plan


def test_hot_steps_have_no_interpreted_functions(spark):
    """Functions of higher order are interpreted with the whole step they are in: none stands where every row passes (F1)."""
    from vitals.config import EVENTS
    from vitals.operators import silver
    from vitals.sources import staging

    stored = staging.raw_records(spark, SF_SMALL).drop("user_id")
    for clean in (silver.clean_quantities, silver.clean_intervals):
        assert "lambda" not in clean(stored, EVENTS)._jdf.queryExecution().optimizedPlan().toString()
    plan = silver.quarantine(stored, EVENTS)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last = max(i for i, line in enumerate(plan) if "lambda" in line)
    rejects = next(i for i, line in enumerate(plan) if "Filter" in line and "_invalid_timestamp" in line)
    assert last < rejects, plan  # above the filter


def test_lines_of_orders_are_dealt_once(spark):
    """Sums, arrays and the join read one shuffle of the lines and one of the orders (F1)."""
    from vitals.sources import staging

    plan = staging.raw_workouts(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2, plan


def test_usual_tags_are_read_without_patterns(spark):
    """Tags as exports write them are told by their pieces; all others go the long way, with the same result (F1)."""
    long = '<Workout workoutActivityType="W" duration="5" durationUnit="min" sourceName="a &amp; b" sourceVersion="1" device="d" totalDistance="3" startDate="s" endDate="e">\n'
    usual = [
        ('<Record type="T" sourceName="B" device="d" unit="n" startDate="s" value="1"/>\n ', ("T", "B", "1")),
        ('<Record type="T" sourceName="" value=" a=b c"/>', ("T", "", " a=b c")),
        ("<Record/>", (None, None, None)),
        ('<WorkoutStatistics type="T" startDate="s" endDate="e" sum="2" unit="kcal" />\n', ("T", None, "2")),
        ('<MetadataEntry key="k" value="v"/>', ("k", None, "v")),
        (long, ("W", "a & b", "5")),
    ]
    others = [
        ('<Record type="T" more="x" value="1"/>', ("T", None, "1")),
        ('<Record type="T" sourceName="a>b" value="1"/>', ("T", "a>b", "1")),
        ('<Record type="T" sourceName=" value=" value="1"/>', ("T", " value=", "1")),
        ('<Record type="T" sourceName="a\tb" value="1"/>', ("T", "a b", "1")),
        ("<Record type='T' value='1'/>", ("T", None, "1")),
        ('<Record\n type="T" value="1"/>', ("T", None, "1")),
        ('<Record type="T" sourceName="&#65;" value="1"/>', ("T", "A", "1")),
        ('<Record type="T" value="1"/>"quoted"', ("T", None, "1")),
        ('<Record type="T" device="a" device="b" value="1"/>', None),
        ('<Record type="T" type="U" value="1"/>', None),
        # a doubled name whose second place a value that reads like a name would fill
        ('<Record type="T" sourceName=" device=" value="1" value="2"/>', None),
        ('<Record type="T" value="a & b"/>', None),
    ]
    rows = spark.createDataFrame([(i, text[1:]) for i, (text, _) in enumerate([*usual, *others])], "i int, value string")
    rows = rows.withColumn("name", xml._name(F.col("value")))
    elements = list(xml.ELEMENT_FIELDS)
    told = []
    found = xml._with_fields(rows, F.col("name"), elements, ["i"]).collect()
    for (_, want), r in zip([*usual, *others], sorted(found, key=lambda r: r["i"])):
        told.append((r["field_type"], r["field_source_name"], r["field_value"]) if r["good"] else None)
        assert told[-1] == want, r
    flagged, _ = xml._usual(rows, F.col("name"), elements, lambda of: {f: _place(of, f, elements) for f in xml.RECORD_FIELDS})
    assert {r["i"] for r in flagged.where("usual").collect()} == set(range(len(usual)))


def _place(of, field, elements):
    out = F.lit(0)
    for e in elements:
        for a, target in xml.ELEMENT_FIELDS[e].items():
            if target == field:
                out = F.when(F.col("name") == e, F.coalesce(F.array_position(of, f" {a}="), F.lit(0)).cast("int")).otherwise(out)
    return out


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_every_part_of_the_staged_export_is_a_document(spark, scratch, batch):
    import glob

    from vitals.sources import staging

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        path = staging.write_export(spark, SF_SMALL, f"{scratch}/documents-{batch}")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    parts = [open(p).read() for p in glob.glob(f"{path}/part-*")]
    assert parts and all(p.startswith(staging.HEADER + "\n") and p.endswith(f"\n{staging.FOOTER}\n") for p in parts)
    assert all(p.count(staging.HEADER) == p.count(staging.FOOTER) == 1 for p in parts)
    found = Counter(line for p in parts for line in p[len(staging.HEADER) + 1 : -len(staging.FOOTER) - 1].splitlines())
    assert found == Counter(line for r in staging.export_lines(spark, SF_SMALL).collect() for line in r["value"].splitlines())
