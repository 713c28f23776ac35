"""Gold: daily rollups, best-source totals, levels, sleep, workouts, summary.

Every function takes silver (or gold) DataFrames and optional entity
``keys``: ``keys=()`` is one person's export, ``keys=("user_id",)`` runs the
same rollups for a whole fleet in one job. Aggregations are pre-aggregated
map-side by Spark, so a hot key or day costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.config import MetricConfig
from vitals.functions.numeric import full_avg, full_parts, full_sum, round_half_away
from vitals.operators.ranking import positive_ntiles


def _metric_names(cfg: MetricConfig, kinds: tuple[str, ...]):
    pairs = []
    if "point" in kinds:
        pairs += list(cfg.point)
    if "sparse" in kinds:
        pairs += list(cfg.sparse)
    return pairs


def daily_stats(silver: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """One pass for all point and sparse metrics: per (metric, day) the rounded
    avg/min/max/count (point tables) and the 2-decimal average (sparse tables).

    Long form with a ``metric`` column; ``metric_table`` cuts one table out.
    """
    pairs = _metric_names(cfg, ("point", "sparse"))
    types = sorted({t for _, t in pairs})
    g = (
        silver.where(F.col("type").isin(*types))
        .groupBy(*keys, "type", "local_date")
        .agg(
            full_avg("value").alias("_avg"),
            F.min("value").alias("_min"),
            F.max("value").alias("_max"),
            F.count(F.lit(1)).alias("n_samples"),
        )
    )
    # a type may serve more than one metric: one output row per metric
    names = F.filter(F.array(*[F.when(F.col("type") == t, F.lit(n)) for n, t in pairs]), lambda x: x.isNotNull())
    return g.select(
        *keys,
        F.explode(names).alias("metric"),
        "local_date",
        round_half_away("_avg", 1).alias("avg_value"),
        round_half_away("_min", 1).alias("min_value"),
        round_half_away("_max", 1).alias("max_value"),
        "n_samples",
        round_half_away("_avg", 2).alias("value"),
    )


def daily_point(silver: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    names = [n for n, _ in cfg.point]
    return daily_stats(silver, cfg, keys).where(F.col("metric").isin(*names)).select(
        *keys, "metric", "local_date", "avg_value", "min_value", "max_value", "n_samples"
    )


def daily_sparse(silver: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    names = [n for n, _ in cfg.sparse]
    return daily_stats(silver, cfg, keys).where(F.col("metric").isin(*names)).select(
        *keys, "metric", "local_date", "value"
    )


def metric_table(daily: DataFrame, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """One gold metric table out of the long form (point or sparse columns)."""
    t = daily.where(F.col("metric") == name).drop("metric")
    if "avg_value" in daily.columns:
        return t.select(*keys, "local_date", "avg_value", "min_value", "max_value", "n_samples")
    return t.select(*keys, "local_date", "value")


def per_source_totals(silver: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Daily total per (type, source) of the cumulative types."""
    return (
        silver.where(F.col("type").isin(*cfg.cumulative_types))
        .groupBy(*keys, "type", "local_date", "source_name")
        .agg(full_sum("value").alias("total"))
    )


def best_source(per_source: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per (type, day) the largest single-source total: devices that report the
    same activity are not added up."""
    return per_source.groupBy(*keys, "type", "local_date").agg(F.max("total").alias("total"))


def daily_activity(silver: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Best-source totals pivoted to one column per cumulative metric.

    The best-source max and the pivot are one aggregation over the per-source
    totals (max over sources of one type is the best source), so the plan has
    two small shuffles after partial aggregation.
    """
    per_source = per_source_totals(silver, cfg, keys)
    cols = [
        round_half_away(F.max(F.when(F.col("type") == t, F.col("total"))), d).alias(name)
        for name, t, d in cfg.cumulative
    ]
    return per_source.groupBy(*keys, "local_date").agg(*cols)


def calendar_levels(activity: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Quartile level 1-4 of each active day (value > 0), 0 for other days.

    Ties in the value are broken by the day. A day without a value for the
    metric (the reference's unmatched left join) gets level 0.
    """
    days = activity.select(*keys, "local_date", *cfg.calendar_columns)
    return positive_ntiles(days, dict(cfg.levels), "local_date", 4, keys)


def daily_sleep(sleep: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Minutes per stage and night; nights with no asleep minutes are left out.
    Stages with no interval are NULL. Sources are added up, as in the export."""
    m = F.col("minutes")
    stage = F.col("stage")
    g = sleep.groupBy(*keys, "local_date").agg(
        F.sum(F.when(stage.isin(*cfg.asleep_stages), m)).alias("asleep_min"),
        F.sum(F.when(stage == cfg.deep_stage, m)).alias("deep_min"),
        F.sum(F.when(stage == cfg.rem_stage, m)).alias("rem_min"),
        F.sum(F.when(stage == cfg.awake_stage, m)).alias("awake_min"),
    )
    return g.where(F.col("asleep_min") > 0)


def gold_workouts(workouts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rounded workouts; ``ts_utc`` is kept as the serving sort column."""
    return workouts.select(
        *keys,
        "activity",
        "local_date",
        round_half_away("duration_min", 1).alias("duration_min"),
        round_half_away("active_energy_kcal", 1).alias("active_energy_kcal"),
        round_half_away("distance_km", 2).alias("distance_km"),
        "indoor",
        "ts_utc",
    )


def workout_summary(workouts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per activity: count and rounded sums (NULL when every value is NULL)."""
    return workouts.groupBy(*keys, "activity").agg(
        F.count(F.lit(1)).alias("n_workouts"),
        round_half_away(full_sum("duration_min"), 1).alias("total_min"),
        round_half_away(full_sum("active_energy_kcal"), 1).alias("total_kcal"),
        round_half_away(full_sum("distance_km"), 2).alias("total_km"),
    )


SUMMARY_COLUMNS = (
    "total_workouts",
    "workout_kcal",
    "avg_heart_rate",
    "latest_weight",
    "avg_daily_steps",
    "first_date",
    "last_date",
)


def overview_days(silver: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """What the overview needs of each day, from one pass over silver: ``avg_value`` of its point
    metric, ``value`` of its sparse metric and the best source's total of its steps.

    Sums by (type, day, source) serve both the best source and, summed again, the averages.
    Days with other cumulative types only stay as rows of NULLs, so their entity has an overview.
    """
    point, sparse = dict(cfg.point)[cfg.summary_point], dict(cfg.sparse)[cfg.summary_sparse]
    steps, digits = next((t, d) for name, t, d in cfg.cumulative if name == cfg.summary_steps)
    multiples, rests = full_parts("value")
    sums = (
        silver.where(F.col("type").isin(*sorted({point, sparse, *cfg.cumulative_types})))
        .groupBy(*keys, "type", "local_date", "source_name")
        .agg(multiples.alias("multiples"), rests.alias("rests"), F.count("value").alias("n"))
    )

    def average(name: str, places: int):
        of = {c: F.sum(F.when(F.col("type") == name, F.col(c))) for c in ("multiples", "rests", "n")}
        return round_half_away(F.try_divide(of["multiples"] + of["rests"], of["n"]), places)

    best = F.max(F.when(F.col("type") == steps, F.col("multiples") + F.col("rests")))
    return sums.groupBy(*keys, "local_date").agg(
        average(point, 1).alias("avg_value"),
        average(sparse, 2).alias("value"),
        round_half_away(best, digits).alias(cfg.summary_steps),
    )


def stored_days(daily: DataFrame, activity: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """``overview_days`` from the gold tables, stacked: one row per day and table."""
    metric = F.col("metric")
    readings = daily.where(metric.isin(cfg.summary_point, cfg.summary_sparse)).select(
        *keys,
        "local_date",
        F.when(metric == cfg.summary_point, F.col("avg_value")).alias("avg_value"),
        F.when(metric == cfg.summary_sparse, F.col("value")).alias("value"),
    )
    return readings.unionByName(activity.select(*keys, "local_date", cfg.summary_steps), allowMissingColumns=True)


def summary(days: DataFrame, workout_sum: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """The one-row overview (one row per entity with ``keys``).

    ``days`` comes from ``overview_days`` or ``stored_days``, ``workout_sum`` from ``workout_summary``.
    Instead of joining one-row results, each input becomes a partial row, the
    partial rows are unioned and folded by one group-by: one shuffle, no join.
    Without keys the global aggregate always yields one row (NULLs, 0 workouts).
    """
    day = F.col("local_date")
    read, weighed = F.col("avg_value").isNotNull(), F.col("value").isNotNull()
    parts = [
        workout_sum.groupBy(*keys).agg(
            F.sum("n_workouts").alias("total_workouts"),
            round_half_away(full_sum("total_kcal"), 0).alias("workout_kcal"),
        ),
        days.groupBy(*keys).agg(
            round_half_away(full_avg("avg_value"), 0).alias("avg_heart_rate"),
            F.min(F.when(read, day)).alias("first_date"),
            F.max(F.when(read, day)).alias("last_date"),
            # the day is unique per entity, so max_by is the latest reading
            F.max_by("value", F.when(weighed, day)).alias("latest_weight"),
            round_half_away(full_avg(cfg.summary_steps), 0).alias("avg_daily_steps"),
        ),
    ]
    u = parts[0].unionByName(parts[1], allowMissingColumns=True)
    folded = u.groupBy(*keys).agg(*[F.max(c).alias(c) for c in SUMMARY_COLUMNS])
    return folded.select(
        *keys,
        F.coalesce(F.col("total_workouts"), F.lit(0)).alias("total_workouts"),
        *SUMMARY_COLUMNS[1:],
    )
