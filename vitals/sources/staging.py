"""Raw, export-shaped inputs derived from the driver's tables.

No health data ships with the test tables, so raw inputs are derived by fixed
expressions, and every oracle query repeats the same expressions in SQL:

* records   <- ``events``: one quantity record and one sleep interval per
  event; text values, offsets ``+0530``/``-0800``/``+0000`` on the timestamps.
* workouts  <- ``orders`` with ``lineitem`` statistics as nested children.
* XML text  <- both of the above, written as an export document.

Planted traits (chosen by id arithmetic so that both engines agree): a value
``bogus``, a start ``not a time``, an end ``unparseable``, exact duplicates, a
statistic ``n/a``, workouts without statistics or metadata; times and numbers in
other spellings that are still read (blanks, one-digit parts, short and colon offsets,
signs, underscores); tiny, huge, infinite and nan values on days of their own; in the
XML, records at depth 1 and 2 inside workouts, comments and CDATA sections that hold
tag text, a line break after a tag's name, and source names with an entity. Every row of
the inputs is used; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.functions.parse import once
from vitals.schemas import RECORD_FIELDS

WALL_CLOCK = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _offset(id_col: Column) -> Column:
    k = id_col % 3
    return F.when(k == 0, F.lit(" +0530")).when(k == 1, F.lit(" -0800")).otherwise(F.lit(" +0000"))


def _source(user: Column) -> Column:
    return F.concat(F.lit("src_"), (user % 3).cast("string"))


def _spelled(ts: Column, event: Column) -> Column:
    """A time as the export spells it; some events are spelled in another way."""
    off = _offset(event)
    plain = F.date_format(ts, WALL_CLOCK)
    return (
        F.when(event % 59 == 0, F.concat(F.lit("  "), plain, off, F.lit(" ")))
        .when(event % 47 == 0, F.concat(F.date_format(ts, "yyyy-M-d  H:m:s"), off))
        .when(event % 43 == 0, F.concat(plain, F.substring(off, 1, 4), F.lit(":"), F.substring(off, 5, 2)))
        .when(event % 41 == 0, F.concat(plain, F.substring(off, 1, 4)))
        .otherwise(F.concat(plain, off))
    )


# Values of the days 2001-01-01 to 2001-01-04
SPECIAL_VALUES = ("1e-7", "1e35", "+nan", "-inf")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped records: ``user_id`` plus the 7 text columns."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    event = F.col("event_id")
    start = _spelled(F.col("ts"), event)
    end = _spelled(F.timestamp_add("SECOND", F.floor(F.col("value") * 60), F.col("ts")), event)
    source = _source(F.col("user_id"))
    special = (event % 401 == 0) & (F.col("event_type") == "view")
    which = F.floor(event / 401) % len(SPECIAL_VALUES)
    own_day = F.concat(F.lit("2001-01-0"), (which + 1).cast("string"), F.date_format("ts", " HH:mm:ss"), _offset(event))
    time = F.when(special, own_day).when(event % 89 == 0, F.lit("not a time")).otherwise(start)
    number = F.col("value").cast("string")
    value = (
        F.when(special, F.get(F.array(*map(F.lit, SPECIAL_VALUES)), which.cast("int")))
        .when(event % 97 == 0, F.lit("bogus"))
        .when(event % 61 == 0, F.concat(F.lit(" "), number, F.lit(" ")))
        .when(event % 67 == 0, F.concat(F.lit("+"), number))
        .when(event % 71 == 0, F.regexp_replace(number, "^([0-9])([0-9])", "$1_$2"))
        .otherwise(number)
    )
    quantity = ev.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("type"),
        source.alias("source_name"),
        F.lit("count").alias("unit"),
        *(time.alias(name) for name in ("creation_date", "start_date", "end_date")),
        value.alias("value"),
    )
    sleep = ev.select(
        "event_id",
        "user_id",
        F.lit("sleep").alias("type"),
        source.alias("source_name"),
        F.lit(None).cast("string").alias("unit"),
        start.alias("creation_date"),
        start.alias("start_date"),
        F.when(event % 83 == 0, F.lit("unparseable")).otherwise(end).alias("end_date"),
        F.col("event_type").alias("value"),
    )
    both = quantity.unionByName(sleep)
    # exact duplicates, as re-imported exports carry them
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return both.select("user_id", *RECORD_FIELDS, F.explode(copies).alias("_copy")).drop("_copy")


def _cents_text(cents: Column) -> Column:
    return F.concat(
        (cents / 100).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def workout_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, one statistic per return flag: ``(l_orderkey, stats array)``.

    Pre-aggregated per (order, flag) before the array is built, so an array
    holds at most one entry per flag whatever the line count of an order. The lines
    are dealt by order once; sums, arrays and the join with orders need no other shuffle.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", F.floor(F.col("l_extendedprice") * 100).alias("line_cents"))
    stat_type = F.when(F.col("l_returnflag") == "A", F.lit("energy")).otherwise(
        F.concat(F.lit("dist_"), F.col("l_returnflag"))
    )
    per_flag = li.repartition("l_orderkey").groupBy("l_orderkey", stat_type.alias("_type")).agg(F.sum("line_cents").alias("cents"))
    text = F.when((F.col("l_orderkey") % 11 == 0) & (F.col("_type") == "dist_R"), F.lit("n/a")).otherwise(
        _cents_text(F.col("cents"))
    )
    texts = per_flag.select("l_orderkey", once(F.col("_type"), text.alias("_sum")))
    return texts.groupBy("l_orderkey").agg(F.collect_list(F.struct("_type", "_sum")).alias("WorkoutStatistics"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )


def _workout_columns() -> list[Column]:
    """What an order alone tells of its workout: attributes, metadata and, last, nested records."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    begin = F.timestamp_add("MINUTE", (cust % 24) * 60 + key % 60, F.col("o_orderdate"))
    off = _offset(key)
    meta = (
        F.when(F.col("o_orderstatus") == "F", F.array(F.struct(F.lit("indoor").alias("_key"), F.lit("1").alias("_value"))))
        .when(
            F.col("o_orderstatus") == "O",
            F.array(
                F.struct(F.lit("indoor").alias("_key"), F.lit("0").alias("_value")),
                F.struct(F.lit("weather").alias("_key"), F.lit("dry").alias("_value")),
            ),
        )
    )
    nested = F.when(
        key % 13 == 0,
        F.array(
            F.struct(
                F.lit("click").alias("_type"),
                _source(cust).alias("_sourceName"),
                F.lit("count").alias("_unit"),
                F.concat(F.date_format(begin, WALL_CLOCK), off).alias("_creationDate"),
                F.concat(F.date_format(begin, WALL_CLOCK), off).alias("_startDate"),
                F.concat(F.date_format(begin, WALL_CLOCK), off).alias("_endDate"),
                (key % 100).cast("string").alias("_value"),
            )
        ),
    )
    return [
        cust.alias("user_id"),
        key.alias("workout_id"),
        F.concat(F.lit("Prio"), F.col("o_orderpriority")).alias("_workoutActivityType"),
        F.concat((key % 90 + 10).cast("string"), F.lit("."), (cust % 10).cast("string")).alias("_duration"),
        F.lit("min").alias("_durationUnit"),
        _source(cust).alias("_sourceName"),
        F.concat(F.date_format(begin, WALL_CLOCK), off).alias("_startDate"),
        F.concat(F.date_format(F.timestamp_add("MINUTE", F.lit(30), begin), WALL_CLOCK), off).alias("_endDate"),
        meta.alias("MetadataEntry"),
        nested.alias("Record"),
    ]


def raw_workouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workouts as the XML scan yields them: attributes plus child arrays."""
    o, stats = _orders(spark, sf_dir), workout_statistics(spark, sf_dir)
    w = o.join(stats, o.o_orderkey == stats.l_orderkey, "left")
    *attributes, nested = _workout_columns()
    return w.select(*attributes, "WorkoutStatistics", nested)


# ---------------------------------------------------------------- XML text


def _xml_escape(c: Column) -> Column:
    special, out = F.lit(False), c
    for raw, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        special = special | c.contains(raw)
        out = F.replace(out, F.lit(raw), F.lit(ent))
    return F.when(special, out).otherwise(c)  # most text has nothing to escape


def _attr(name: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.concat(F.lit(f' {name}="'), _xml_escape(c), F.lit('"'))).otherwise(F.lit(""))


def _record_tag(cols: list[Column]) -> Column:
    names = ("type", "sourceName", "unit", "creationDate", "startDate", "endDate", "value")
    return F.concat(F.lit("<Record"), *[_attr(n, c) for n, c in zip(names, cols)], F.lit("/>"))


def export_source_name(user: Column) -> Column:
    """Source names of the XML export; user ids divisible by 7 carry an ``&``."""
    return F.concat(_source(user), F.when(user % 7 == 0, F.lit(" & co")).otherwise(F.lit("")))


def export_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as they appear outside workouts in the XML export (7 text columns).

    Equals ``raw_records`` with the XML source name, plus one outer copy of
    every nested workout record of an order divisible by 26, so that the
    context filter must remove exactly the nested copy.
    """
    r = raw_records(spark, sf_dir).withColumn("source_name", export_source_name(F.col("user_id")))
    nested = (
        _orders(spark, sf_dir)
        .select(*_workout_columns())
        .where(F.col("workout_id") % 26 == 0)
        .select(F.explode("Record").alias("r"))
        .select(*[F.col(f"r._{a}").alias(n) for a, n in zip(
            ("type", "sourceName", "unit", "creationDate", "startDate", "endDate", "value"), RECORD_FIELDS)])
    )
    return r.select(*RECORD_FIELDS).unionByName(nested)


def export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export document as text blocks: records, then workouts with children."""
    recs = export_records(spark, sf_dir).select(
        F.concat(F.lit(" "), _record_tag([F.col(c) for c in RECORD_FIELDS])).alias("value")
    )
    w = raw_workouts(spark, sf_dir)
    meta = F.transform(
        F.coalesce(F.col("MetadataEntry"), F.array().cast("array<struct<_key:string,_value:string>>")),
        lambda m: F.concat(F.lit("\n  <MetadataEntry"), _attr("key", m["_key"]), _attr("value", m["_value"]), F.lit("/>")),
    )
    stats = F.transform(
        F.coalesce(F.col("WorkoutStatistics"), F.array().cast("array<struct<_type:string,_sum:string>>")),
        lambda s: F.concat(
            F.lit("\n  <WorkoutStatistics"), _attr("type", s["_type"]), _attr("sum", s["_sum"]), F.lit(' unit="x"/>')
        ),
    )
    key = F.col("workout_id")
    nested = F.transform(
        F.coalesce(F.col("Record"), F.array().cast(w.schema["Record"].dataType)),
        lambda r: _record_tag([r[f"_{a}"] for a in ("type", "sourceName", "unit", "creationDate", "startDate", "endDate", "value")]),
    )
    inner = F.transform(
        nested,
        lambda tag: F.when(key % 26 == 0, F.concat(F.lit("\n  "), tag)).otherwise(
            F.concat(F.lit('\n  <WorkoutEvent type="lap"><Lap>'), tag, F.lit('<MetadataEntry key="indoor" value="9"/></Lap></WorkoutEvent>'))
        ),
    )
    head = F.concat(
        F.when(key % 5 == 0, F.lit(" <Workout\n ")).otherwise(F.lit(" <Workout")),
        _attr("workoutActivityType", F.col("_workoutActivityType")),
        _attr("duration", F.col("_duration")),
        _attr("durationUnit", F.col("_durationUnit")),
        _attr("sourceName", F.col("_sourceName")),
        _attr("startDate", F.col("_startDate")),
        _attr("endDate", F.col("_endDate")),
    )
    commented = F.when(key % 4 == 0, F.lit('\n  <!-- <WorkoutStatistics type="energy" sum="1"/> </Workout> -->')).otherwise("")
    body = F.concat(F.array_join(meta, ""), F.array_join(stats, ""), F.array_join(inner, ""))
    w, body = w.select("*", once(body.alias("body"))), F.col("body")
    block = F.when(body == "", F.concat(head, F.lit("/>"))).otherwise(
        F.concat(head, F.lit(">"), commented, body, F.lit("\n </Workout>"))
    )
    before = (
        F.when(key % 7 == 0, F.lit(' <!-- <Record type="click" value="1"/> <Workout duration="1"> -->\n'))
        .when(key % 17 == 0, F.lit(' <Note><![CDATA[ <Workout duration="1"> <Record type="click" value="1"/> <!-- ]]></Note>\n'))
        .otherwise("")
    )
    block = F.concat(before, block)
    return recs.unionByName(w.select(block.alias("value")))


HEADER = '<?xml version="1.0" encoding="UTF-8"?>\n<HealthData locale="en_US">\n <ExportDate value="2024-02-01 00:00:00 +0000"/>'
FOOTER = "</HealthData>"


def write_export(spark: SparkSession, sf_dir: str, dest: str) -> str:
    """Write the export as text part files under ``dest`` (overwritten); each
    part file is one complete document."""
    @F.arrow_udf("int")
    def ends(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # 1 for the first block of a partition, 2 for the last one, 3 for both, 0 for others
        # (a nested function travels to the workers by value)
        import numpy as np
        import pyarrow as pa

        held = None
        for batch in batches:
            if len(batch):
                if held is not None:
                    yield pa.array(held)
                held, begins = np.zeros(len(batch), "int32"), held is None
                held[0] += begins
        if held is not None:
            held[-1] += 2
            yield pa.array(held)

    # prolog and root element around the partition's blocks; Python sees numbers, no text
    end = F.col("end")
    lines = export_lines(spark, sf_dir).select("value", ends.asNondeterministic()(F.octet_length("value")).alias("end"))
    document = F.concat(F.when(end % 2 == 1, f"{HEADER}\n").otherwise(""), F.coalesce("value", F.lit("")), F.when(end >= 2, f"\n{FOOTER}").otherwise(""))
    lines.select(document.alias("value")).write.mode("overwrite").text(dest)
    return dest
