"""Data-quality report: stage counters, named checks, the report row.

Counters are a long DataFrame ``(keys..., counter, value)``; the checks are
column expressions over its pivot, so one report covers one export or, with
keys, every entity of a fleet. A warning never drops data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.config import QUALITY_CHECKS


def counter_rows(df: DataFrame, counters: dict[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Long counter rows out of a wide one-row-per-key aggregate."""
    items = F.array(*[F.struct(F.lit(name).alias("counter"), F.col(col).cast("bigint").alias("value"))
                      for name, col in counters.items()])
    return df.select(*keys, F.inline(items))


def count_rows(df: DataFrame, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(keys, counter, value)``: the row count of ``df``. Without keys an empty table
    counts 0; with keys an entity without rows has none, see ``zero_counters``."""
    return df.groupBy(*keys).agg(F.lit(name).alias("counter"), F.count(F.lit(1)).alias("value"))


def zero_counters(entities: DataFrame, names: list[str], keys: tuple[str, ...]) -> DataFrame:
    """A counter 0 of each name for each entity: the first stage of a merge, so that an
    entity without rows of a kind still has its counter."""
    every = F.explode(F.array(*map(F.lit, names)))
    return entities.select(*keys).distinct().select(*keys, every.alias("counter"), F.lit(0).cast("bigint").alias("value"))


def merge_counters(stages: list[DataFrame], keys: tuple[str, ...] = ()) -> DataFrame:
    """Counters of all stages; a later stage wins when it reports the same name.

    With keys the rows are dealt by entity before they are grouped, in as many parts as the session shuffles
    into: a stage has hardly two rows of one entity and counter, so grouping them in front of the shuffle saves
    nothing and holds every row of a task in memory.
    """
    u = None
    for i, s in enumerate(stages):
        s = s.select(*keys, "counter", "value", F.lit(i).alias("_stage"))
        u = s if u is None else u.unionByName(s)
    if keys:
        u = u.repartition(int(u.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return u.groupBy(*keys, "counter").agg(F.max_by("value", "_stage").alias("value"))


def _wide(counters: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per key: the counter map plus one column per checked counter.
    A key has a bounded number of counters (one per stage output)."""
    names = sorted({c for c, _ in QUALITY_CHECKS} | {"bronze_records", "first_local_day", "last_local_day"})
    return counters.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("counter", "value"))).alias("counters"),
        *[F.max(F.when(F.col("counter") == n, F.col("value"))).alias(n) for n in names],
    )


def _check_items() -> F.Column:
    limit = F.greatest(F.lit(1.0), F.coalesce(F.col("bronze_records"), F.lit(0)) * F.lit(0.01))
    tests = {
        "silver_records": F.col("silver_records") > 0,
        "silver_workouts": F.col("silver_workouts") > 0,
        "invalid_numeric_value": F.col("invalid_numeric_value") < limit,
        "invalid_timestamp": F.col("invalid_timestamp") < limit,
    }
    items = []
    for counter, label in QUALITY_CHECKS:
        v = F.col(counter)
        status = F.when(v.isNull(), F.lit("skipped")).when(tests[counter], F.lit("pass")).otherwise(F.lit("warn"))
        items.append(F.struct(F.lit(label).alias("check"), v.alias("value"), status.alias("status")))
    return F.array(*items)


def checks(counters: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(keys, check_no, check, value, status)`` for the four named checks.

    ``skipped`` when the counter is missing, else ``pass`` or ``warn``; the
    invalid-row thresholds are ``max(1, 1% of bronze records)``, strict ``<``.
    """
    return _wide(counters, keys).select(*keys, F.posexplode(_check_items()).alias("check_no", "c")).select(
        *keys, "check_no", "c.check", "c.value", "c.status"
    )


def report(counters: DataFrame, run_at, keys: tuple[str, ...] = ()) -> DataFrame:
    """One report row per key: run time, counters (a map), checks, warnings."""
    items = _check_items()
    return _wide(counters, keys).select(
        *keys,
        F.lit(run_at).cast("string").alias("run_at"),
        "counters",
        items.alias("checks"),
        F.transform(F.filter(items, lambda x: x["status"] == "warn"), lambda x: x["check"]).alias("warnings"),
        F.array(_day_text("first_local_day"), _day_text("last_local_day")).alias("date_range"),
    )


def _day_text(counter: str) -> F.Column:
    """A day counter (days since 1970-01-01) as ``yyyy-MM-dd``; ``None`` if absent."""
    return F.coalesce(F.date_from_unix_date(F.col(counter)).cast("string"), F.lit("None"))


def report_json(report_df: DataFrame) -> DataFrame:
    """The report as JSON text (NULL fields kept)."""
    return report_df.select(
        F.to_json(F.struct(*report_df.columns), {"ignoreNullFields": "false"}).alias("value")
    )
