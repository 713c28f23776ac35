"""Declared schemas of every layer, keyed or not; nothing is inferred."""

from pyspark.sql import types as T

from vitals.config import MetricConfig

S = T.StringType()

# Bronze: exactly what the export says, as text.
RECORD_FIELDS = ("type", "source_name", "unit", "creation_date", "start_date", "end_date", "value")
BRONZE_RECORDS = T.StructType([T.StructField(n, S) for n in RECORD_FIELDS])

WORKOUT_FIELDS = (
    "activity_type",
    "source_name",
    "duration_min",
    "start_date",
    "end_date",
    "active_energy_kcal",
    "distance_km",
    "indoor",
)
BRONZE_WORKOUTS = T.StructType([T.StructField(n, S) for n in WORKOUT_FIELDS])

# XML attribute names of a <Record>, in bronze column order.
RECORD_ATTRIBUTES = ("type", "sourceName", "unit", "creationDate", "startDate", "endDate", "value")
XML_RECORD = T.StructType([T.StructField("_" + a, S) for a in RECORD_ATTRIBUTES])

# Parse schema of the built-in XML source: the fields plus the raw text of a malformed element.
CORRUPT = "_corrupt_record"
XML_RECORD_PARSE = T.StructType(list(XML_RECORD.fields) + [T.StructField(CORRUPT, S)])

XML_WORKOUT = T.StructType(
    [
        T.StructField("_workoutActivityType", S),
        T.StructField("_duration", S),
        T.StructField("_durationUnit", S),
        T.StructField("_sourceName", S),
        T.StructField("_startDate", S),
        T.StructField("_endDate", S),
        T.StructField(
            "MetadataEntry",
            T.ArrayType(T.StructType([T.StructField("_key", S), T.StructField("_value", S)])),
        ),
        T.StructField(
            "WorkoutStatistics",
            T.ArrayType(T.StructType([T.StructField("_type", S), T.StructField("_sum", S)])),
        ),
    ]
)

# The scanned elements as stored: the record columns shared by all kinds, their place,
# and the partition columns.
ELEMENTS = T.StructType(
    [
        *BRONZE_RECORDS.fields,
        T.StructField("workout", S),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("file", T.LongType()),
        T.StructField("kind", S),
        T.StructField("class", S),
    ]
)

# The files that a run has read.
MANIFEST = T.StructType([T.StructField("path", S)])

# Silver.
SILVER_RECORDS = T.StructType(
    [
        T.StructField("type", S),
        T.StructField("source_name", S),
        T.StructField("unit", S),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts_utc", T.TimestampType()),
        T.StructField("local_date", T.DateType()),
    ]
)
SILVER_SLEEP = T.StructType(
    [
        T.StructField("stage", S),
        T.StructField("source_name", S),
        T.StructField("start_utc", T.TimestampType()),
        T.StructField("end_utc", T.TimestampType()),
        T.StructField("local_date", T.DateType()),
        T.StructField("minutes", T.LongType()),
    ]
)
SILVER_WORKOUTS = T.StructType(
    [
        T.StructField("activity", S),
        T.StructField("source_name", S),
        T.StructField("duration_min", T.DoubleType()),
        T.StructField("active_energy_kcal", T.DoubleType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("indoor", T.BooleanType()),
        T.StructField("ts_utc", T.TimestampType()),
        T.StructField("local_date", T.DateType()),
    ]
)

QUARANTINE = T.StructType([*BRONZE_RECORDS.fields, T.StructField("reasons", T.ArrayType(S))])


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Gold: the point and sparse metrics in one table, partitioned by metric, and the others.
D, L = T.DoubleType(), T.LongType()
DAILY_METRICS = _table(local_date=T.DateType(), avg_value=D, min_value=D, max_value=D, n_samples=L, value=D, metric=S)


def gold_tables(cfg: MetricConfig) -> dict[str, T.StructType]:
    """Schemas of the gold tables; activity and calendar take their columns from the catalogue."""
    return {
        "daily_metrics": DAILY_METRICS,
        "gold_daily_activity": _table(local_date=T.DateType(), **{name: D for name, _, _ in cfg.cumulative}),
        "gold_daily_calendar": _table(
            local_date=T.DateType(), **dict.fromkeys(cfg.calendar_columns, D), **{level: L for level, _ in cfg.levels}
        ),
        "gold_daily_sleep": _table(local_date=T.DateType(), asleep_min=L, deep_min=L, rem_min=L, awake_min=L),
        "gold_workouts": _table(
            activity=S, local_date=T.DateType(), duration_min=D, active_energy_kcal=D, distance_km=D,
            indoor=T.BooleanType(), ts_utc=T.TimestampType(),
        ),
        "gold_workout_summary": _table(activity=S, n_workouts=L, total_min=D, total_kcal=D, total_km=D),
        "gold_summary": _table(
            total_workouts=L, workout_kcal=D, avg_heart_rate=D, latest_weight=D, avg_daily_steps=D,
            first_date=T.DateType(), last_date=T.DateType(),
        ),
    }


def keyed(schema: T.StructType, keys: tuple[str, ...]) -> T.StructType:
    """``schema`` of a fleet's table: entity keys, as text, and the columns."""
    return T.StructType([*(T.StructField(k, S) for k in keys), *schema.fields])


# Quality report as written to JSON.
REPORT = T.StructType(
    [
        T.StructField("run_at", S),
        T.StructField("counters", T.MapType(S, T.LongType())),
        T.StructField(
            "checks",
            T.ArrayType(
                T.StructType(
                    [T.StructField("check", S), T.StructField("value", T.LongType()), T.StructField("status", S)]
                )
            ),
        ),
        T.StructField("warnings", T.ArrayType(S)),
        T.StructField("date_range", T.ArrayType(S)),
    ]
)
