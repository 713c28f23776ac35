"""Batch jobs: export -> bronze -> silver -> gold -> quality report.

Every stage reads what the previous stage wrote (declared schemas, Parquet
with zstd) and writes in overwrite mode, so a rerun rebuilds the same layers
and a lost executor costs one stage, not the whole lineage. Row counters of one export
come with its writes; those of a fleet are counted by entity from the written files.

    spark-submit vitals/plans/jobs.py --input export.xml --root <shared folder>
    spark-submit vitals/plans/jobs.py --input landing --root <shared folder> --keys user_id
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import logging
import os
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# submitted as a file, the package lies two folders up
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from vitals import schemas
from vitals.config import HEALTH, Layout, MetricConfig
from vitals.operators import bronze, gold, quality, silver
from vitals.plans import snapshots
from vitals.session import apply_settings
from vitals.sources import xml

log = logging.getLogger("vitals.jobs")
# independent table writes submitted at once
WRITE_THREADS = 4
# bytes of a row group in partitioned tables
ROW_GROUP = 32 << 20

GOLD_TABLES = (
    "gold_daily_activity",
    "gold_daily_calendar",
    "gold_daily_sleep",
    "gold_workouts",
    "gold_workout_summary",
    "gold_summary",
)
# counters of each stage that an entity has even if it has no such row
INGEST_COUNTERS = ["bronze_records", "bronze_workouts", "malformed_records", "malformed_workouts"]
TRANSFORM_COUNTERS = ["bronze_records", "silver_records", "silver_sleep_intervals", "silver_workouts", "invalid_numeric_value", "invalid_timestamp"]


class Counted:
    """Row counters that come with the writes of one export, as observed metrics of the last stage, where
    each partition counts once however often its task is tried. Nothing is read again."""

    def __init__(self):
        self.observed: list[Observation] = []

    def on(self, df: DataFrame, **counters: Column) -> DataFrame:
        """``df``, whose write will give the ``counters`` (aggregates; None if there is no value)."""
        one = Observation()
        self.observed.append(one)
        return df.observe(one, *[c.cast("bigint").alias(name) for name, c in counters.items()])

    def rows(self, spark: SparkSession, names: list[str]) -> DataFrame:
        """(counter, value) of the writes so far; ``names`` are 0 if a write had no task to count in."""
        found = dict.fromkeys(names, 0) | {name: value for one in self.observed for name, value in one.get.items() if value is not None}
        items = [F.struct(F.lit(name).alias("counter"), F.lit(value).cast("bigint").alias("value")) for name, value in found.items()]
        return spark.range(1).select(F.inline(F.array(*items)))


def _write(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    t0 = time.perf_counter()
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        # a task has a writer for each folder open: small row groups bound what they hold
        w = w.partitionBy(*partition_by).option("parquet.block.size", ROW_GROUP)
    w.parquet(path)
    log.info("wrote %s in %.2fs", path.rsplit("/", 2)[-2:], time.perf_counter() - t0)


def write_all(outputs: list[tuple]) -> None:
    """Write independent outputs as concurrent Spark jobs (one driver thread
    each); the scheduler interleaves their tasks, so small jobs do not leave
    cores idle. Errors surface here."""
    if len(outputs) == 1:
        _write(*outputs[0])
        return
    with ThreadPoolExecutor(max_workers=min(len(outputs), WRITE_THREADS)) as pool:
        for f in [pool.submit(_write, *o) for o in outputs]:
            f.result()


def _layer(spark: SparkSession, path: str, schema, keys: tuple[str, ...] = ()) -> DataFrame:
    """A written layer with its declared columns; entity keys are text."""
    return spark.read.schema(schemas.keyed(schema, keys)).parquet(path)


def elements(spark: SparkSession, layout: Layout, keys: tuple[str, ...] = ()) -> DataFrame:
    """What the scan of the export has left in bronze, all kinds."""
    return _layer(spark, layout.elements, schemas.ELEMENTS, keys)


def bronze_records(spark: SparkSession, layout: Layout, keys: tuple[str, ...] = (), wanted: str | None = None) -> DataFrame:
    """Bronze records, of one class (``quantity``, ``interval`` or ``other``) if given:
    a filter on partition columns, so other files are not read."""
    own = elements(spark, layout, keys).where(F.col("kind") == "record")
    if wanted is not None:
        own = own.where(F.col("class") == wanted)
    return own.select(*keys, *schemas.RECORD_FIELDS)


def gold_table(spark: SparkSession, layout: Layout, table: str, cfg: MetricConfig = HEALTH, keys: tuple[str, ...] = ()) -> DataFrame:
    return _layer(spark, layout.gold(table), schemas.gold_tables(cfg)[table], keys)


# ------------------------------------------------------------------ stages


def ingest(
    spark: SparkSession, source: str, layout: Layout, cfg: MetricConfig = HEALTH, mode: str = "split", keys: tuple[str, ...] = ()
) -> DataFrame:
    """Bronze: records outside workouts and flattened workouts, as text.

    The scan's elements are written once, partitioned by kind and, for records, by the
    class that the cleaners ask for. Workouts are put together from the written rows.
    Malformed elements are a kind of their own: kept with their text, counted, and left
    out of the layers above (children of workouts have a counter only where there are any).
    ``keys`` are columns of a partitioned folder layout
    (``source/user_id=7/...``): many exports in one job. ``mode="dom"`` takes the records
    from the built-in XML source.
    """
    _write(xml.manifest(spark, source).select(schemas.keyed(schemas.MANIFEST, keys).names), layout.manifest)
    found = xml.scan_elements(spark, source)
    if mode == "dom":
        records, _ = xml.read_export(spark, source, "dom")
        rest = found.where(~F.col("kind").isin("record", "nested"))
        found = rest.unionByName(records.withColumn("kind", F.lit("record")), allowMissingColumns=True)
    interval, quantity = F.col("type") == cfg.sleep_type, F.col("type").isin(*cfg.quantity_types)
    place = F.when(F.col("kind") != "record", "none").when(quantity, "quantity").when(interval, "interval").otherwise("other")
    stored = found.withColumn("class", place).select(schemas.keyed(schemas.ELEMENTS, keys).names)
    names = {
        "record": "bronze_records", "malformed_record": "malformed_records", "malformed_workout": "malformed_workouts",
        "malformed_metadata": "malformed_metadata", "malformed_statistics": "malformed_statistics",
    }
    counted = Counted()
    if not keys:
        kinds = {n: F.count_if(F.col("kind") == k) for k, n in names.items()}
        of_children = ("malformed_metadata", "malformed_statistics")  # only where there are any
        stored = counted.on(stored, **{n: F.when(c > 0, c) if n in of_children else c for n, c in kinds.items()})
    _write(stored, layout.elements, ("kind", "class"))
    written = elements(spark, layout, keys)
    flat = bronze.flatten_workouts(xml.workouts_of(written), cfg, keys)
    if not keys:
        _write(counted.on(flat, bronze_workouts=F.count(F.lit(1))), layout.bronze_workouts)
        return counted.rows(spark, INGEST_COUNTERS)
    _write(flat, layout.bronze_workouts)
    counter = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("kind")]
    by_kind = written.where(F.col("kind").isin(*names)).groupBy(*keys, counter.alias("counter")).agg(F.count(F.lit(1)).alias("value"))
    workouts = quality.count_rows(_layer(spark, layout.bronze_workouts, schemas.BRONZE_WORKOUTS, keys), "bronze_workouts", keys)
    return quality.merge_counters([_zeros(spark, layout, INGEST_COUNTERS, keys), by_kind, workouts], keys)


def _zeros(spark: SparkSession, layout: Layout, names: list[str], keys: tuple[str, ...]) -> DataFrame:
    """The counters of a stage at 0, for each entity that has an export, be it empty."""
    return quality.zero_counters(_layer(spark, layout.manifest, schemas.MANIFEST, keys), names, keys)


def transform(
    spark: SparkSession, layout: Layout, cfg: MetricConfig = HEALTH, keys: tuple[str, ...] = (), count_bronze: bool = True
) -> DataFrame:
    """Silver: typed records, sleep intervals and workouts, and the quarantine. ``count_bronze``: the counters
    hold the bronze records too, which the ingest of the same run has counted already."""
    quantities = bronze_records(spark, layout, keys, "quantity")
    intervals = bronze_records(spark, layout, keys, "interval")
    bw = _layer(spark, layout.bronze_workouts, schemas.BRONZE_WORKOUTS, keys)
    clean, counted, n = silver.clean_quantities(quantities, cfg, keys), Counted(), F.count(F.lit(1))
    sleep, workouts, rejected = silver.clean_intervals(intervals, cfg, keys), silver.clean_workouts(bw, cfg, keys), silver.quarantine(quantities, cfg, keys)
    if not keys:
        day = {"first_local_day": F.unix_date(F.min("local_date")), "last_local_day": F.unix_date(F.max("local_date"))}
        clean = counted.on(clean, silver_records=n, **day)
        sleep, workouts = counted.on(sleep, silver_sleep_intervals=n), counted.on(workouts, silver_workouts=n)
        reasons = ("invalid_numeric_value", "invalid_timestamp")
        rejected = counted.on(rejected, **{r: F.count_if(F.array_contains("reasons", r)) for r in reasons})
    write_all(
        [
            (clean, layout.silver_records),
            (sleep, layout.silver_sleep),
            (workouts, layout.silver_workouts),
            (rejected, layout.quarantine),
        ]
    )
    if not keys:
        found = counted.rows(spark, TRANSFORM_COUNTERS[1:])
        return found.unionByName(quality.count_rows(bronze_records(spark, layout), "bronze_records")) if count_bronze else found
    # reject counters from the (small) quarantine rather than another bronze pass
    rejects = silver.reject_counts_from_quarantine(_layer(spark, layout.quarantine, schemas.QUARANTINE, keys), keys)
    records = _layer(spark, layout.silver_records, schemas.SILVER_RECORDS, keys)
    days = records.groupBy(*keys).agg(
        F.unix_date(F.min("local_date")).alias("first_local_day"),
        F.unix_date(F.max("local_date")).alias("last_local_day"),
    )
    return quality.merge_counters(
        [
            _zeros(spark, layout, TRANSFORM_COUNTERS, keys),
            quality.count_rows(bronze_records(spark, layout, keys), "bronze_records", keys),
            quality.count_rows(records, "silver_records", keys),
            quality.count_rows(_layer(spark, layout.silver_sleep, schemas.SILVER_SLEEP, keys), "silver_sleep_intervals", keys),
            quality.count_rows(_layer(spark, layout.silver_workouts, schemas.SILVER_WORKOUTS, keys), "silver_workouts", keys),
            quality.counter_rows(
                rejects,
                {"invalid_numeric_value": "invalid_numeric_value", "invalid_timestamp": "invalid_timestamp"},
                keys,
            ),
            quality.counter_rows(
                days, {"first_local_day": "first_local_day", "last_local_day": "last_local_day"}, keys
            ).where(F.col("value").isNotNull()),
        ],
        keys,
    )


def build(spark: SparkSession, layout: Layout, cfg: MetricConfig = HEALTH, keys: tuple[str, ...] = ()) -> DataFrame:
    """Gold: all rollups. Point and sparse metrics come out of one aggregation
    and are stored together, partitioned by metric; each later table reads the
    written tables it depends on, by their declared schemas (a table may be empty).
    Readers are switched to the tables of this run when all of them are written."""
    recs = _layer(spark, layout.silver_records, schemas.SILVER_RECORDS, keys)
    sleep = _layer(spark, layout.silver_sleep, schemas.SILVER_SLEEP, keys)
    wk = _layer(spark, layout.silver_workouts, schemas.SILVER_WORKOUTS, keys)
    run = replace(layout, run=snapshots.new_run())
    names, counted = [name for name, _ in (*cfg.point, *cfg.sparse)], Counted()

    def table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> tuple:
        if not keys:
            counters = {f"gold_{n}": F.count_if(F.col("metric") == n) for n in names} if partition_by else {name: F.count(F.lit(1))}
            df = counted.on(df, **counters)
        return df, run.gold(name), partition_by

    write_all(
        [
            table(gold.daily_stats(recs, cfg, keys), "daily_metrics", ("metric",)),
            table(gold.daily_activity(recs, cfg, keys), "gold_daily_activity"),
            table(gold.daily_sleep(sleep, cfg, keys), "gold_daily_sleep"),
            table(gold.gold_workouts(wk, keys), "gold_workouts"),
            table(gold.workout_summary(wk, keys), "gold_workout_summary"),
        ]
    )
    inputs = ("daily_metrics", "gold_daily_activity", "gold_workout_summary")
    daily, activity, totals = (gold_table(spark, run, t, cfg, keys) for t in inputs)
    s = gold.summary(gold.stored_days(daily, activity, cfg, keys), totals, cfg, keys)
    levels = gold.calendar_levels(activity, cfg, keys)
    write_all([table(levels, "gold_daily_calendar"), table(s, "gold_summary")])
    snapshots.publish(spark, layout, run.run)
    every = [f"gold_{n}" for n in names] + list(GOLD_TABLES)
    if not keys:
        return counted.rows(spark, every)

    zeros = _zeros(spark, layout, every, keys)
    by_metric = daily.where(F.col("metric").isin(*names)).groupBy(*keys, "metric").agg(F.count(F.lit(1)).alias("value"))
    metrics = by_metric.select(*keys, F.concat(F.lit("gold_"), "metric").alias("counter"), "value")
    counts = [quality.count_rows(gold_table(spark, run, t, cfg, keys), t, keys) for t in GOLD_TABLES]
    return quality.merge_counters([zeros, metrics, *counts], keys)


def metric_frame(spark: SparkSession, layout: Layout, name: str, cfg: MetricConfig = HEALTH, keys: tuple[str, ...] = ()) -> DataFrame:
    """One point/sparse gold table out of the metric-partitioned store."""
    daily = gold_table(spark, layout, "daily_metrics", cfg, keys).where(F.col("metric") == name)
    if name in dict(cfg.point):
        return daily.select(*keys, "local_date", "avg_value", "min_value", "max_value", "n_samples")
    return daily.select(*keys, "local_date", "value")


def write_report(report_df: DataFrame, layout: Layout, stamp: str, keys: tuple[str, ...] = ()) -> str:
    """JSON report: a time-stamped copy plus ``latest`` (both overwritten on rerun)."""
    text = quality.report_json(report_df.select(*keys, *[c for c in report_df.columns if c not in keys]))
    if not keys:
        text = text.coalesce(1)  # one row: a single small file
    path = f"{layout.quality_dir}/dq_{stamp}"
    text.write.mode("overwrite").text(path)
    _read_text = report_df.sparkSession.read.text(path)
    _read_text.write.mode("overwrite").text(layout.latest_report)
    return path


def run_export(
    spark: SparkSession,
    source: str,
    root: str,
    cfg: MetricConfig = HEALTH,
    mode: str = "split",
    run_at: str | None = None,
    keys: tuple[str, ...] = (),
) -> dict:
    """Export(s) -> bronze -> silver -> gold -> report; returns the report.

    With ``keys`` (a partitioned folder of exports, one per entity) every
    layer carries the keys and the report has one row per entity; the
    return value then says where it is and how many entities warned.
    """
    apply_settings(spark)
    layout = Layout(root)
    run_at = run_at or _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds")
    counters = quality.merge_counters(
        [
            ingest(spark, source, layout, cfg, mode, keys),
            transform(spark, layout, cfg, keys, count_bronze=False),
            build(spark, layout, cfg, keys),
        ],
        keys,
    )
    rep = quality.report(counters, run_at, keys)
    path = write_report(rep, layout, run_at.replace(":", "-"), keys)
    if keys:
        stats = spark.read.schema(schemas.keyed(schemas.REPORT, keys)).json(path).agg(
            F.count(F.lit(1)).alias("entities"), F.count_if(F.size("warnings") > 0).alias("entities_warned")
        ).first()
        return {"run_at": run_at, "report": path, **stats.asDict()}
    row = spark.read.schema(schemas.REPORT).json(path).first()  # the one written row
    return {
        "run_at": row["run_at"],
        "counters": dict(row["counters"]),
        "checks": [c.asDict() for c in row["checks"]],
        "warnings": list(row["warnings"]),
        "date_range": list(row["date_range"]),
    }


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="export -> bronze/silver/gold")
    p.add_argument("--input", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--mode", default="split", choices=("split", "dom"))
    p.add_argument("--keys", default="", help="comma-separated key folders of --input, one export per entity")
    a = p.parse_args(argv)
    keys = tuple(k for k in a.keys.split(",") if k)
    spark = SparkSession.builder.getOrCreate()
    print(json.dumps(run_export(spark, a.input, a.root, mode=a.mode, keys=keys), indent=2, default=str))


if __name__ == "__main__":
    main()
