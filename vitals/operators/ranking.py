"""Quartile levels without a window over all rows in one task.

With entity keys the window is partitioned by key (one task sees one entity's
days). Without keys the rows are split into ranges of the value: the bucket is an
eighth of a power of two, so it grows with the value and a double has 17,000 of
them at most. Rows are counted by bucket; the running total over that bounded
table gives each bucket's first number, and a window numbers the rows inside a
bucket. One path for every size, without a job before the caller's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitals.functions.numeric import ntile_bucket

STEPS_PER_DOUBLING = 8


def value_bucket(value: Column) -> Column:
    """A range number that does not fall as a positive ``value`` grows (NaN is the largest)."""
    top = STEPS_PER_DOUBLING * 1100
    step = F.floor(F.log2(value) * STEPS_PER_DOUBLING)
    return F.when(F.isnan(value), top + 1).when(value == float("inf"), top).otherwise(step).cast("int")


SPREAD = 64  # ranges for the rows that have no level


def positive_ntile(df: DataFrame, value: str, tie: str, buckets: int, keys: tuple[str, ...], out: str) -> DataFrame:
    """``positive_ntiles`` of one column."""
    return positive_ntiles(df, {out: value}, tie, buckets, keys)


def positive_ntiles(df: DataFrame, values: dict[str, str], tie: str, buckets: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """For each ``out: value`` of ``values`` a column ``out`` = ntile(``buckets``) of ``value``
    among rows with ``value > 0`` (ordered by ``value``, then ``tie``), 0 for other rows; per ``keys``.

    ``tie`` is unique (within ``keys``). Without keys, all columns are ranked in one long form, a
    row for each of them, from one distribution: (column, range) counts. The long form carries all of
    ``df``, so rows and counts read the very same exchange below it, and ``df`` is derived once.
    """
    return _ranked_by_key(df, values, tie, buckets, keys) if keys else _ranked_by_range(df, values, tie, buckets)


def _ranked_by_key(df: DataFrame, values: dict[str, str], tie: str, buckets: int, keys: tuple[str, ...]) -> DataFrame:
    w = Window.partitionBy(*keys)
    levels = {}
    for out, value in values.items():
        positive = F.coalesce(F.col(value) > 0, F.lit(False))
        row = F.row_number().over(w.orderBy(F.when(positive, F.lit(0)).otherwise(F.lit(1)), value, tie))
        level = ntile_bucket(row, F.count_if(positive).over(w), buckets)
        levels[out] = F.when(positive, level).otherwise(F.lit(0)).cast("bigint")
    return df.withColumns(levels)


def _ranked_by_range(df: DataFrame, values: dict[str, str], tie: str, buckets: int) -> DataFrame:
    spread = -SPREAD * 1000 - F.pmod(F.xxhash64(tie), F.lit(SPREAD)).cast("int")
    entries = []
    for out, value in values.items():
        number = F.col(value).cast("double")
        bucket = F.when(number > 0, value_bucket(number)).otherwise(spread)
        entries.append(F.struct(F.lit(out).alias("out"), number.alias("value"), bucket.alias("bucket"), F.struct(*df.columns).alias("row")))
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    counts = long.where(F.col("value") > 0).groupBy("out", "bucket").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("out").orderBy("bucket")  # one row per range
    offsets = counts.select(
        "out",
        "bucket",
        (F.sum("n").over(running) - F.col("n")).alias("offset"),
        F.sum("n").over(Window.partitionBy("out")).alias("total"),
    )
    inside = F.row_number().over(Window.partitionBy("out", "bucket").orderBy("value", f"row.{tie}"))
    ranked = long.withColumn("inside", inside).join(F.broadcast(offsets), ["out", "bucket"], "left")
    level = ntile_bucket(F.col("offset") + F.col("inside"), F.col("total"), buckets)
    level = F.when(F.col("value") > 0, level).otherwise(F.lit(0)).cast("bigint")
    levels = [F.max(F.when(F.col("out") == out, level)).alias(out) for out in values]
    return ranked.groupBy(F.col(f"row.{tie}").alias("tie")).agg(F.any_value("row").alias("row"), *levels).select("row.*", *values)
