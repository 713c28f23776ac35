"""Activity calendar: a date spine laid out in weeks, levels per day, month
labels, active days and years. Per entity with ``keys``; every window is
partitioned by key and covers one period (at most 53 weeks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitals.config import MONTH_NAMES
from vitals.functions.text import day_text

LEVEL_COLUMNS = {"kcal": "level_kcal", "steps": "level_steps"}


def period_bounds(calendar: DataFrame, period: str = "last-year", keys: tuple[str, ...] = ()) -> DataFrame:
    """``(keys, start, end)``: the 365 days ending on the last day with data,
    or one calendar year (``period="2024"``). Entities without data get none."""
    if period == "last-year":
        b = calendar.groupBy(*keys).agg(F.max("local_date").alias("end"))
        return b.withColumn("start", F.date_sub("end", 364)).select(*keys, "start", "end")
    year = int(period)
    b = calendar.select(*keys).distinct() if keys else calendar.groupBy().agg(F.count(F.lit(1)).alias("_n"))
    return b.select(
        *keys,
        F.make_date(F.lit(year), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.lit(year), F.lit(12), F.lit(31)).alias("end"),
    )


def spine(bounds: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per grid cell: weeks start on the Sunday on or before the start;
    ``local_date`` is NULL for the cells before the start (empty cells)."""
    grid_start = F.date_sub(F.col("start"), F.dayofweek("start") - 1)
    cells = bounds.select(*keys, "start", grid_start.alias("grid_start"), F.explode(F.sequence(grid_start, F.col("end"))).alias("day"))
    return cells.select(
        *keys,
        F.when(F.col("day") >= F.col("start"), F.col("day")).alias("local_date"),
        "day",
        F.floor(F.datediff("day", "grid_start") / 7).cast("bigint").alias("week"),
        (F.dayofweek("day") - 1).cast("bigint").alias("weekday"),
    )


def calendar_grid(
    calendar: DataFrame, period: str = "last-year", metric: str = "kcal", keys: tuple[str, ...] = ()
) -> DataFrame:
    """Grid cells with the level of the chosen metric (0 without data) and the
    day's text. The day look-up is a left join of the spine with the days."""
    level_col = LEVEL_COLUMNS[metric]
    cells = spine(period_bounds(calendar, period, keys), keys)
    days = calendar.select(*keys, "local_date", "steps", "active_kcal", "distance_km", F.col(level_col).alias("_level"))
    g = cells.join(days, [*keys, "local_date"], "left")
    return g.select(
        *keys,
        "local_date",
        "week",
        "weekday",
        F.when(F.col("local_date").isNotNull(), F.coalesce(F.col("_level"), F.lit(0))).cast("bigint").alias("level"),
        F.when(
            F.col("local_date").isNotNull(), day_text("local_date", "steps", "active_kcal", "distance_km")
        ).alias("text"),
    )


def active_days(grid: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Days of the period with level > 0."""
    return grid.groupBy(*keys).agg(
        F.count_if(F.col("local_date").isNotNull() & (F.col("level") > 0)).alias("active_days")
    )


def active_years(calendar: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Distinct years with data, newest first."""
    years = calendar.select(*keys, F.year("local_date").alias("year")).distinct()
    return years.orderBy(*keys, F.desc("year"))


def month_labels(grid: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per week the month name where the month of the week's first day differs
    from the previous week's, dropped when one of the next two weeks carries a
    label too (so labels never overlap). NULL for unlabelled weeks."""
    weeks = grid.where(F.col("local_date").isNotNull()).groupBy(*keys, "week").agg(
        F.month(F.min("local_date")).alias("month")
    )
    w = Window.partitionBy(*keys).orderBy("week")
    prev = F.lag("month").over(w)
    labelled = weeks.withColumn(
        "_label", F.when(prev.isNull() | (prev != F.col("month")), F.col("month"))
    )
    ahead = F.max(F.col("_label").isNotNull().cast("int")).over(w.rowsBetween(1, 2))
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    keep = F.col("_label").isNotNull() & (F.coalesce(ahead, F.lit(0)) == 0)
    return labelled.select(
        *keys, "week", F.when(keep, F.element_at(names, F.col("_label"))).alias("label")
    )
