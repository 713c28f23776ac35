"""Silver: typed, de-duplicated, validated rows, plus what was rejected.

De-duplication is ``distinct`` on exactly the typed output columns (value
compared after parsing, so ``60`` and ``60.0`` are one row; end and creation
time are not part of the key). Spark pre-aggregates ``distinct`` map-side,
so a record copied many times costs one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.config import MetricConfig
from vitals.functions.parse import minute_boundaries, once, parse_double, parse_instant, parse_time


def _quantity_rows(bronze: DataFrame, cfg: MetricConfig, keys: tuple[str, ...]) -> DataFrame:
    return bronze.where(F.col("type").isin(*cfg.quantity_types))


def clean_quantities(bronze: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Whitelisted quantity records with a numeric value and a parseable start.

    The type crosses the de-duplication shuffle as its position in the
    whitelist (an int instead of a ~35-character identifier) and is decoded
    after it; the dedup key is unchanged (the mapping is one-to-one).
    """
    whitelist = F.array(*[F.lit(t) for t in cfg.quantity_types])
    typed = _quantity_rows(bronze, cfg, keys).select(
        *keys,
        F.array_position(whitelist, F.col("type")).cast("int").alias("_type"),
        "source_name",
        "unit",
        once(parse_double("value").alias("value"), parse_time("start_date").alias("_start")),
    )
    start = F.col("_start")
    valid = typed.where(F.col("value").isNotNull() & start["instant"].isNotNull() & start["day"].isNotNull()).select(
        *keys, "_type", "source_name", "unit", "value", start["instant"].alias("ts_utc"), start["day"].alias("local_date")
    )
    decoded = None
    for i, t in enumerate(cfg.quantity_types, start=1):
        decoded = (F.when if decoded is None else decoded.when)(F.col("_type") == i, F.lit(t))
    return valid.distinct().select(
        *keys,
        decoded.alias("type"),
        "source_name",
        "unit",
        "value",
        "ts_utc",
        "local_date",
    )


def reject_counts(bronze: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows the quantity cleaner drops, by reason, before de-duplication.

    A row bad in both ways counts in both. One aggregate, one pass.
    """
    q = _quantity_rows(bronze, cfg, keys)
    return q.groupBy(*keys).agg(
        F.count_if(parse_double("value").isNull()).alias("invalid_numeric_value"),
        F.count_if(parse_instant("start_date").isNull()).alias("invalid_timestamp"),
    )


def reject_counts_from_quarantine(quarantined: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The same counters as ``reject_counts``, from the written quarantine."""
    r = F.col("reasons")
    return quarantined.groupBy(*keys).agg(
        F.count_if(F.array_contains(r, "invalid_numeric_value")).alias("invalid_numeric_value"),
        F.count_if(F.array_contains(r, "invalid_timestamp")).alias("invalid_timestamp"),
    )


def quarantine(bronze: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """The rejected quantity rows themselves, with an array of reasons."""
    q = _quantity_rows(bronze, cfg, keys)
    found = {
        "invalid_numeric_value": parse_double("value").isNull(),
        "invalid_timestamp": parse_instant("start_date").isNull(),
    }
    told = q.select(*bronze.columns, once(*[bad.alias(f"_{reason}") for reason, bad in found.items()]))
    rejected = told.where(F.col("_invalid_numeric_value") | F.col("_invalid_timestamp"))
    # the array is made for rejected rows only: it is a function of higher order, which is interpreted
    reasons = F.array_compact(F.array(*[F.when(F.col(f"_{reason}"), F.lit(reason)) for reason in found]))
    return rejected.select(*bronze.columns, reasons.alias("reasons"))


def clean_intervals(bronze: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sleep intervals: both ends parse; the night is the local day of the end."""
    typed = bronze.where(F.col("type") == cfg.sleep_type).select(
        *keys,
        F.col("value").alias("stage"),
        "source_name",
        once(parse_time("start_date").alias("_start"), parse_time("end_date").alias("_end")),
    )
    begin, end = F.col("_start.instant"), F.col("_end.instant")
    valid = typed.where(begin.isNotNull() & end.isNotNull()).select(
        *keys, "stage", "source_name", begin.alias("start_utc"), end.alias("end_utc"), F.col("_end.day").alias("local_date")
    )
    # the minutes follow from the ends, so they need not be part of the key
    return valid.distinct().withColumn("minutes", minute_boundaries("start_utc", "end_utc"))


def clean_workouts(bronze_workouts: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Typed workouts; ``indoor`` is three-valued (absent -> NULL)."""
    typed = bronze_workouts.select(
        *keys,
        F.replace(F.col("activity_type"), F.lit(cfg.workout_prefix), F.lit("")).alias("activity"),
        "source_name",
        parse_double("duration_min").alias("duration_min"),
        parse_double("active_energy_kcal").alias("active_energy_kcal"),
        parse_double("distance_km").alias("distance_km"),
        (F.col("indoor") == "1").alias("indoor"),
        once(parse_time("start_date").alias("_start")),
    )
    start = F.col("_start")
    valid = typed.where(F.col("activity").isNotNull() & start["instant"].isNotNull())
    return valid.select(
        *keys, "activity", "source_name", "duration_min", "active_energy_kcal", "distance_km", "indoor",
        start["instant"].alias("ts_utc"), start["day"].alias("local_date"),
    ).distinct()


def date_range(silver_records: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """First and last local day as text; ``None`` when there is no row."""
    return silver_records.groupBy(*keys).agg(
        F.coalesce(F.min("local_date").cast("string"), F.lit("None")).alias("first_date"),
        F.coalesce(F.max("local_date").cast("string"), F.lit("None")).alias("last_date"),
    )
