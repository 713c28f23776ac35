"""Read side: whitelisted metric tables, the summary, the dashboard bundle and
the latest quality report. Nothing is aggregated at read time; order is
applied here because stored order is no contract.

On a fleet's root every function takes the entity ``keys``, which stay in the
result, and an ``entity`` (key -> value) to read one entity's rows only.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals import schemas
from vitals.config import HEALTH, METRIC_TABLES, Layout, MetricConfig
from vitals.functions.text import iso_date
from vitals.plans.jobs import GOLD_TABLES, _layer, bronze_records, gold_table, metric_frame
from vitals.plans.snapshots import current_run

Keys = tuple[str, ...]
Entity = dict[str, str]


def metric_names() -> list[str]:
    return sorted(METRIC_TABLES)


def served(cfg: MetricConfig = HEALTH) -> list[str]:
    """The names whose tables ``cfg`` has, sorted."""
    own = {*(f"gold_{n}" for n, _ in (*cfg.point, *cfg.sparse)), *GOLD_TABLES}
    return sorted(name for name, table in METRIC_TABLES.items() if table in own)


def metric_list(spark: SparkSession, layout: Layout, cfg: MetricConfig = HEALTH, keys: Keys = ()) -> DataFrame:
    """The list of names that can be asked for, with the rows that each has now."""
    counts = [
        _table(spark, layout, METRIC_TABLES[name], cfg, keys).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"))
        for name in served(cfg)
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("name")


def register_views(spark: SparkSession, layout: Layout, cfg: MetricConfig = HEALTH, keys: Keys = ()) -> list[str]:
    """The layers as temporary views for ``spark.sql``, each by its name; returns the names. Gold views are
    those of the run that is current now."""
    pinned = replace(layout, run=layout.run or current_run(layout))
    layers = {
        "bronze_records": bronze_records(spark, layout, keys),
        "bronze_workouts": _layer(spark, layout.bronze_workouts, schemas.BRONZE_WORKOUTS, keys),
        "silver_records": _layer(spark, layout.silver_records, schemas.SILVER_RECORDS, keys),
        "silver_sleep": _layer(spark, layout.silver_sleep, schemas.SILVER_SLEEP, keys),
        "silver_workouts": _layer(spark, layout.silver_workouts, schemas.SILVER_WORKOUTS, keys),
        "quarantine": _layer(spark, layout.quarantine, schemas.QUARANTINE, keys),
    }
    for table in (*(f"gold_{n}" for n, _ in (*cfg.point, *cfg.sparse)), *GOLD_TABLES):
        layers[table] = _table(spark, pinned, table, cfg, keys)
    for name, df in layers.items():
        df.createOrReplaceTempView(name)
    return list(layers)


def _of(df: DataFrame, entity: Entity | None) -> DataFrame:
    """The rows of one entity; the comparison is pushed down to the files."""
    for key, value in (entity or {}).items():
        df = df.where(F.col(key) == str(value))
    return df


def _table(spark: SparkSession, layout: Layout, table: str, cfg: MetricConfig, keys: Keys) -> DataFrame:
    name = table.removeprefix("gold_")
    if name in dict(cfg.point) or name in dict(cfg.sparse):
        return metric_frame(spark, layout, name, cfg, keys)
    return gold_table(spark, layout, table, cfg, keys)


def order_for_serving(table: str, df: DataFrame, keys: Keys = ()) -> DataFrame:
    """The order that the reference serves in (stored order is no contract);
    with entity keys, each entity's rows together."""
    if table == "gold_workouts":
        return df.orderBy(*keys, "ts_utc").drop("ts_utc")
    if table == "gold_workout_summary":
        return df.orderBy(*keys, F.desc("n_workouts"), "activity")
    return df.orderBy(*keys, "local_date")


def metric(
    spark: SparkSession, layout: Layout, name: str, cfg: MetricConfig = HEALTH, keys: Keys = (), entity: Entity | None = None
) -> DataFrame | None:
    """All rows of one whitelisted gold table, or None for an unknown name."""
    table = METRIC_TABLES.get(name)
    if table is None:
        return None
    return order_for_serving(table, _of(_table(spark, layout, table, cfg, keys), entity), keys)


def summary(spark: SparkSession, layout: Layout, cfg: MetricConfig = HEALTH, keys: Keys = (), entity: Entity | None = None) -> DataFrame:
    return _of(gold_table(spark, layout, "gold_summary", cfg, keys), entity)


def heart_rate_series(heart_rate: DataFrame, keys: Keys = ()) -> DataFrame:
    return heart_rate.orderBy(*keys, "local_date").select(
        *keys, iso_date("local_date").alias("date"), F.col("avg_value").alias("value")
    )


def weight_series(weight: DataFrame, keys: Keys = ()) -> DataFrame:
    return weight.orderBy(*keys, "local_date").select(*keys, iso_date("local_date").alias("date"), "value")


def workout_bars(workout_summary: DataFrame, keys: Keys = ()) -> DataFrame:
    return workout_summary.orderBy(*keys, F.desc("n_workouts"), "activity").select(
        *keys, F.col("activity").alias("name"), F.col("n_workouts").alias("value"), "total_kcal"
    )


def calendar_days(calendar: DataFrame, keys: Keys = ()) -> DataFrame:
    return calendar.orderBy(*keys, "local_date").select(
        *keys, iso_date("local_date").alias("date"), "steps", "active_kcal", "distance_km", "level_kcal", "level_steps"
    )


def dashboard(
    spark: SparkSession, layout: Layout, cfg: MetricConfig = HEALTH, keys: Keys = (), entity: Entity | None = None
) -> dict[str, DataFrame]:
    """The five parts of the dashboard bundle, lazily."""

    def read(table: str) -> DataFrame:
        return _of(_table(spark, layout, table, cfg, keys), entity)

    return {
        "summary": summary(spark, layout, cfg, keys, entity),
        "heartRate": heart_rate_series(read(cfg.summary_point), keys),
        "weight": weight_series(read(cfg.summary_sparse), keys),
        "workouts": workout_bars(read("gold_workout_summary"), keys),
        "calendar": calendar_days(read("gold_daily_calendar"), keys),
    }


def ready(spark: SparkSession, layout: Layout) -> bool:
    """Is there a gold layer to serve?"""
    try:
        return bool(spark.read.parquet(layout.gold("gold_summary")).columns)
    except AnalysisException:
        return False


def latest_quality(spark: SparkSession, layout: Layout, keys: Keys = (), entity: Entity | None = None) -> DataFrame:
    return _of(spark.read.schema(schemas.keyed(schemas.REPORT, keys)).json(layout.latest_report), entity)
