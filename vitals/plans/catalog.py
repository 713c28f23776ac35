"""Registered queries: one per operator group, on inputs derived from the
driver's tables (``vitals.sources.staging``). Each takes ``(spark, sf_dir)``
and returns a DataFrame; instants leave as epoch seconds so that every engine
prints them alike. ``vitals.plans.oracle`` holds the equivalent SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.config import EVENTS as CFG
from vitals.functions import round_half_away
from vitals.operators import bronze, calendar, gold, quality, silver
from vitals.session import apply_settings, scratch_path
from vitals.sources import staging, xml

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
USER = ("user_id",)


def query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return register


# ------------------------------------------------------------ shared inputs


def bronze_records(spark, d, keys=()):
    r = staging.raw_records(spark, d)
    return r if keys else r.drop("user_id")


def silver_records(spark, d, keys=()):
    return silver.clean_quantities(bronze_records(spark, d, keys), CFG, keys)


def silver_sleep(spark, d, keys=()):
    return silver.clean_intervals(bronze_records(spark, d, keys), CFG, keys)


def bronze_workouts(spark, d, keys=()):
    w = staging.raw_workouts(spark, d)
    return bronze.flatten_workouts(w, CFG, keys)


def silver_workouts(spark, d, keys=()):
    return silver.clean_workouts(bronze_workouts(spark, d, keys), CFG, keys)


def _epoch(c: str):
    return F.unix_seconds(F.col(c)).alias(c)


# ------------------------------------------------------------ silver


@query("clean_quantities")
def q_clean_quantities(spark, d):
    """Whitelisted, typed, valid, de-duplicated records."""
    s = silver_records(spark, d)
    return s.select("type", "source_name", "unit", "value", _epoch("ts_utc"), "local_date")


@query("reject_counts")
def q_reject_counts(spark, d):
    """A1: rows the cleaner drops, by reason."""
    return silver.reject_counts(bronze_records(spark, d), CFG)


@query("quarantine")
def q_quarantine(spark, d):
    """The rejected rows with their reasons."""
    q = silver.quarantine(bronze_records(spark, d), CFG)
    return q.select("type", "source_name", "start_date", "value", F.array_join("reasons", ",").alias("reasons"))


@query("clean_intervals")
def q_clean_intervals(spark, d):
    """Sleep intervals with minute boundaries."""
    s = silver_sleep(spark, d)
    return s.select("stage", "source_name", _epoch("start_utc"), _epoch("end_utc"), "local_date", "minutes")


@query("workout_flatten")
def q_workout_flatten(spark, d):
    """Nested statistics to bronze text columns."""
    return bronze_workouts(spark, d)


@query("clean_workouts")
def q_clean_workouts(spark, d):
    """Typed workouts."""
    s = silver_workouts(spark, d)
    return s.select(
        "activity", "source_name", "duration_min", "active_energy_kcal", "distance_km", "indoor",
        _epoch("ts_utc"), "local_date",
    )


@query("date_range")
def q_date_range(spark, d):
    """A10: first and last local day of silver."""
    return silver.date_range(silver_records(spark, d))


# ------------------------------------------------------------ gold


@query("daily_point")
def q_daily_point(spark, d):
    """Daily avg/min/max/count of the point metrics."""
    return gold.daily_point(silver_records(spark, d), CFG)


@query("daily_sparse")
def q_daily_sparse(spark, d):
    """A4: daily 2-decimal average of the sparse metrics."""
    return gold.daily_sparse(silver_records(spark, d), CFG)


@query("per_source_totals")
def q_per_source_totals(spark, d):
    """A5: daily total per (type, source)."""
    t = gold.per_source_totals(silver_records(spark, d), CFG)
    return t.select("type", "local_date", "source_name", round_half_away("total", 2).alias("total"))


@query("best_source")
def q_best_source(spark, d):
    """Largest single-source total per (type, day)."""
    b = gold.best_source(gold.per_source_totals(silver_records(spark, d), CFG))
    return b.select("type", "local_date", round_half_away("total", 2).alias("total"))


@query("daily_activity")
def q_daily_activity(spark, d):
    """Best-source totals pivoted per metric."""
    return gold.daily_activity(silver_records(spark, d), CFG)


@query("calendar_levels")
def q_calendar_levels(spark, d):
    """Quartile levels of active days."""
    return gold.calendar_levels(gold.daily_activity(silver_records(spark, d), CFG), CFG)


@query("daily_sleep")
def q_daily_sleep(spark, d):
    """Minutes per stage and night."""
    return gold.daily_sleep(silver_sleep(spark, d), CFG)


@query("workouts")
def q_workouts(spark, d):
    """O2: rounded workouts (sort column left out)."""
    return gold.gold_workouts(silver_workouts(spark, d)).drop("ts_utc")


@query("workout_summary")
def q_workout_summary(spark, d):
    """Per activity count and sums."""
    return gold.workout_summary(silver_workouts(spark, d))


def _summary(spark, d, keys=()):
    s = silver_records(spark, d, keys)
    w = silver_workouts(spark, d, keys)
    return gold.summary(gold.overview_days(s, CFG, keys), gold.workout_summary(w, keys), CFG, keys)


@query("summary")
def q_summary(spark, d):
    """The one-row overview."""
    return _summary(spark, d)


# ------------------------------------------------------------ fleet form


@query("daily_point_by_user")
def q_daily_point_by_user(spark, d):
    return gold.daily_point(silver_records(spark, d, USER), CFG, USER)


@query("daily_activity_by_user")
def q_daily_activity_by_user(spark, d):
    return gold.daily_activity(silver_records(spark, d, USER), CFG, USER)


@query("calendar_levels_by_user")
def q_calendar_levels_by_user(spark, d):
    act = gold.daily_activity(silver_records(spark, d, USER), CFG, USER)
    return gold.calendar_levels(act, CFG, USER)


@query("daily_sleep_by_user")
def q_daily_sleep_by_user(spark, d):
    return gold.daily_sleep(silver_sleep(spark, d, USER), CFG, USER)


@query("summary_by_user")
def q_summary_by_user(spark, d):
    return _summary(spark, d, USER)


# ------------------------------------------------------------ XML sources

_EXPORTS: dict[str, str] = {}


def staged_export(spark, d) -> str:
    """The XML export of the staged inputs, written once per process."""
    if d not in _EXPORTS:
        _EXPORTS[d] = staging.write_export(spark, d, scratch_path(spark, "export"))
    return _EXPORTS[d]


@query("record_scan_xml")
def q_record_scan_xml(spark, d):
    """Every <Record> of the export by the positional text scan."""
    return xml.scan_records(spark, staged_export(spark, d))


@query("record_context_filter")
def q_record_context_filter(spark, d):
    """S3: records outside workouts, by their position."""
    records, _ = xml.read_export(spark, staged_export(spark, d))
    return records


@query("record_scan_dom")
def q_record_scan_dom(spark, d):
    """The built-in XML source, less the records inside workouts (multiset difference)."""
    records, _ = xml.read_export(spark, staged_export(spark, d), mode="dom")
    return records


@query("workout_scan_xml")
def q_workout_scan_xml(spark, d):
    """S4 + A12, A13: workouts by the positional scan, flattened."""
    return bronze.flatten_workouts(xml.scan_workouts(spark, staged_export(spark, d)), CFG)


# ------------------------------------------------------------ calendar


def _calendar(spark, d, keys=()):
    return gold.calendar_levels(gold.daily_activity(silver_records(spark, d, keys), CFG, keys), CFG, keys)


@query("calendar_grid")
def q_calendar_grid(spark, d):
    """The last-year grid coloured by energy."""
    return calendar.calendar_grid(_calendar(spark, d), "last-year", "kcal")


@query("calendar_grid_year")
def q_calendar_grid_year(spark, d):
    """C2 (calendar year) and C3 (steps)."""
    return calendar.calendar_grid(_calendar(spark, d), "2024", "steps")


@query("active_days")
def q_active_days(spark, d):
    """Active days of the last-year period."""
    return calendar.active_days(calendar.calendar_grid(_calendar(spark, d), "last-year", "kcal"))


@query("active_years")
def q_active_years(spark, d):
    """Years with data."""
    return calendar.active_years(_calendar(spark, d))


@query("month_labels")
def q_month_labels(spark, d):
    """Month labels of the last-year grid."""
    return calendar.month_labels(calendar.calendar_grid(_calendar(spark, d), "last-year", "kcal"))


@query("day_text")
def q_day_text(spark, d):
    """the text of every calendar day."""
    from vitals.functions.text import day_text

    c = _calendar(spark, d)
    return c.select("local_date", day_text("local_date", "steps", "active_kcal", "distance_km").alias("text"))


@query("month_labels_by_user")
def q_month_labels_by_user(spark, d):
    g = calendar.calendar_grid(_calendar(spark, d, USER), "last-year", "steps", USER)
    return calendar.month_labels(g, USER)


# ------------------------------------------------------------ quality


def _stored(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each frame written once to the shared folder (concurrent jobs) and read back, so
    that many counters do not derive it many times."""
    from vitals.plans.jobs import write_all

    spark = next(iter(frames.values())).sparkSession
    paths = {name: scratch_path(spark, name) for name in frames}
    write_all([(df, paths[name]) for name, df in frames.items()])
    return {name: spark.read.schema(df.schema).parquet(paths[name]) for name, df in frames.items()}


def _counters(spark, d, keys=()):
    b, bw = bronze_records(spark, d, keys), bronze_workouts(spark, d, keys)
    silver_layer = {
        "records": silver.clean_quantities(b, CFG, keys),
        "sleep": silver.clean_intervals(b, CFG, keys),
        "workouts": silver.clean_workouts(bw, CFG, keys),
    }
    t = _stored(silver_layer)
    daily = gold.daily_stats(t["records"], CFG, keys).groupBy(*keys, "metric").agg(F.count(F.lit(1)).alias("value"))
    names = [f"gold_{n}" for n, _ in (*CFG.point, *CFG.sparse)]
    days = t["records"].where(F.col("type").isin(*CFG.cumulative_types)).select(*keys, "local_date").distinct()
    rejects = {c: c for c in ("invalid_numeric_value", "invalid_timestamp")}
    activities = t["workouts"].select(*keys, "activity").distinct()
    counted = {
        "bronze_records": b, "bronze_workouts": bw, "silver_records": t["records"], "silver_sleep_intervals": t["sleep"],
        "silver_workouts": t["workouts"], "gold_daily_activity": days, "gold_daily_calendar": days,
        "gold_daily_sleep": gold.daily_sleep(t["sleep"], CFG, keys), "gold_workouts": t["workouts"], "gold_workout_summary": activities,
    }
    entities = b.select(*keys).union(bw.select(*keys)) if keys else spark.range(1)
    stages = [
        quality.zero_counters(entities, [*counted, *rejects, *names], keys),
        quality.counter_rows(silver.reject_counts(b, CFG, keys), rejects, keys),
        daily.select(*keys, F.concat(F.lit("gold_"), "metric").alias("counter"), "value"),
        *(quality.count_rows(df, name, keys) for name, df in counted.items()),
    ]
    return quality.merge_counters(stages, keys)


@query("quality_counters")
def q_quality_counters(spark, d):
    """Stage counters."""
    return _counters(spark, d)


@query("quality_checks")
def q_quality_checks(spark, d):
    """Q1, Q2: the named checks and their status."""
    return quality.checks(_counters(spark, d))


def _report(spark, d, keys=()):
    r = quality.report(_counters(spark, d, keys), "", keys)
    return r.select(
        *keys,
        F.size("counters").alias("n_counters"),
        F.array_join(F.transform("checks", lambda c: F.concat(c["check"], F.lit("="), c["status"])), ";").alias("checks"),
        F.array_join("warnings", ";").alias("warnings"),
    )


@query("quality_report")
def q_quality_report(spark, d):
    """The report row (run time left out), checks as text."""
    return _report(spark, d)


@query("quality_counters_by_user")
def q_quality_counters_by_user(spark, d):
    return _counters(spark, d, USER)


@query("quality_checks_by_user")
def q_quality_checks_by_user(spark, d):
    return quality.checks(_counters(spark, d, USER), USER)


@query("quality_report_by_user")
def q_quality_report_by_user(spark, d):
    return _report(spark, d, USER)


# ------------------------------------------------------------ serving


def _metric(spark, d, name, keys=()):
    daily = gold.daily_stats(silver_records(spark, d, keys), CFG, keys)
    columns = daily.drop("value") if name == CFG.summary_point else daily.select(*keys, "metric", "local_date", "value")
    return gold.metric_table(columns, name, keys)


def _serving(name, docs, build):
    """Register the serving form of a table, for one export and for a fleet."""

    def one(spark, d):
        return build(spark, d, ())

    def fleet(spark, d):
        return build(spark, d, USER)

    one.__doc__ = docs
    query(name)(one)
    query(f"{name}_by_user")(fleet)


def _serve():
    from vitals.plans import serving

    _serving(
        "serve_heart_rate", "V7, P10, F8: the heart-rate series of the dashboard.",
        lambda spark, d, k: serving.heart_rate_series(_metric(spark, d, CFG.summary_point, k), k),
    )
    _serving(
        "serve_weight", "V7, P10, F8: the weight series.",
        lambda spark, d, k: serving.weight_series(_metric(spark, d, CFG.summary_sparse, k), k),
    )
    _serving(
        "serve_workouts", "V7, P10, O3: the workout bars.",
        lambda spark, d, k: serving.workout_bars(gold.workout_summary(silver_workouts(spark, d, k), k), k),
    )
    _serving("serve_calendar", "V7, F8: the calendar days.", lambda spark, d, k: serving.calendar_days(_calendar(spark, d, k), k))


_serve()


# ------------------------------------------------------------ storage and jobs


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, d):
    """Silver written as zstd Parquet, read back with its schema."""
    from vitals.schemas import SILVER_RECORDS

    path = scratch_path(spark, "silver")
    silver_records(spark, d).write.mode("overwrite").option("compression", "zstd").parquet(path)
    s = spark.read.schema(SILVER_RECORDS).parquet(path)
    return s.select("type", "source_name", "unit", "value", _epoch("ts_utc"), "local_date")


_ROOTS: dict[str, str] = {}


def _job_root(spark, d) -> str:
    """The layers of the whole job on the staged export, built once per process."""
    from vitals.plans.jobs import run_export

    if d not in _ROOTS:
        root = scratch_path(spark, "layers")
        run_export(spark, staged_export(spark, d), root, CFG, run_at="1970-01-01T00:00:00+00:00")
        _ROOTS[d] = root
    return _ROOTS[d]


@query("medallion_run")
def q_medallion_run(spark, d):
    """The whole job on the XML export; its counters
    read back from the written report."""
    from vitals.config import Layout
    from vitals.plans.serving import latest_quality

    rep = latest_quality(spark, Layout(_job_root(spark, d)))
    return rep.select(F.explode("counters").alias("counter", "value")).select(
        "counter", F.col("value").cast("bigint").alias("value")
    )


@query("served_summary")
def q_served_summary(spark, d):
    """The summary as the job has stored it."""
    from vitals.config import Layout
    from vitals.plans import serving

    layout = Layout(_job_root(spark, d))
    return serving.summary(spark, layout, CFG).withColumn("ready", F.lit(serving.ready(spark, layout)))


@query("served_calendar")
def q_served_calendar(spark, d):
    """A whitelisted table of the job by its name."""
    from vitals.config import Layout
    from vitals.plans import serving

    return serving.metric(spark, Layout(_job_root(spark, d)), "calendar", CFG)


@query("served_sleep")
def q_served_sleep(spark, d):
    """Another whitelisted table; every name of the list is served."""
    from vitals.config import Layout
    from vitals.plans import serving

    return serving.metric(spark, Layout(_job_root(spark, d)), "sleep", CFG)


@query("served_metrics")
def q_served_metrics(spark, d):
    """The list of names, with the rows that each table of the job has."""
    from vitals.config import Layout
    from vitals.plans import serving

    return serving.metric_list(spark, Layout(_job_root(spark, d)), CFG)


@query("views_over_layers")
def q_views_over_layers(spark, d):
    """The job's layers as named views, joined in SQL."""
    from vitals.config import Layout
    from vitals.plans import serving

    serving.register_views(spark, Layout(_job_root(spark, d)), CFG)
    return spark.sql("""
        SELECT r.type, count(*) AS n_records, count(DISTINCT r.local_date) AS n_days, count(DISTINCT a.local_date) AS walked_days
        FROM silver_records r LEFT JOIN (SELECT local_date FROM gold_daily_activity WHERE steps > 0) a ON a.local_date = r.local_date
        GROUP BY r.type""")


@query("daily_sparse_by_user")
def q_daily_sparse_by_user(spark, d):
    return gold.daily_sparse(silver_records(spark, d, USER), CFG, USER)


@query("workout_summary_by_user")
def q_workout_summary_by_user(spark, d):
    return gold.workout_summary(silver_workouts(spark, d, USER), USER)


@query("calendar_grid_by_user")
def q_calendar_grid_by_user(spark, d):
    return calendar.calendar_grid(_calendar(spark, d, USER), "last-year", "steps", USER)
