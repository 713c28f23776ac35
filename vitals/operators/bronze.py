"""Bronze: flatten workouts, keep every value as exported text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.config import MetricConfig
from vitals.functions.parse import once, parse_double
from vitals.schemas import WORKOUT_FIELDS, XML_WORKOUT

_STATS = XML_WORKOUT["WorkoutStatistics"].dataType
_META = XML_WORKOUT["MetadataEntry"].dataType


def _sum_of(stats, keep) -> F.Column:
    """Sum of the parseable ``sum`` attributes of the statistics ``keep`` selects."""
    chosen = F.filter(stats, lambda s: keep(F.coalesce(s["_type"], F.lit(""))))
    return F.aggregate(chosen, F.lit(0.0), lambda acc, s: acc + F.coalesce(parse_double(s["_sum"]), F.lit(0.0)))


def flatten_workouts(workouts: DataFrame, cfg: MetricConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """``XML_WORKOUT`` rows -> bronze workout rows (8 text columns).

    Energy is the sum over the energy statistics, distance over every
    statistic whose type starts with the distance prefix; unparseable sums
    are skipped and a total of 0 becomes NULL. ``indoor`` is the value of
    the last metadata entry with the indoor key. No shuffle: all of it is
    array functions on one row.
    """
    stats = F.coalesce(F.col("WorkoutStatistics"), F.array().cast(_STATS))
    meta = F.coalesce(F.col("MetadataEntry"), F.array().cast(_META))
    energy = _sum_of(stats, lambda t: t == F.lit(cfg.energy_stat))
    distance = _sum_of(stats, lambda t: t.startswith(cfg.distance_prefix))
    indoor = F.try_element_at(F.filter(meta, lambda m: m["_key"] == F.lit(cfg.indoor_key)), F.lit(-1))["_value"]
    as_text = lambda x: F.when(x != 0, x.cast("string"))
    summed = workouts.select("*", once(energy.alias("_energy"), distance.alias("_distance")))
    out = summed.select(
        *keys,
        F.col("_workoutActivityType").alias("activity_type"),
        F.col("_sourceName").alias("source_name"),
        F.col("_duration").alias("duration_min"),
        F.col("_startDate").alias("start_date"),
        F.col("_endDate").alias("end_date"),
        as_text(F.col("_energy")).alias("active_energy_kcal"),
        as_text(F.col("_distance")).alias("distance_km"),
        indoor.alias("indoor"),
    )
    return out.select(*keys, *WORKOUT_FIELDS)
