"""Metric catalogue and storage layout.

Everything the operators need to know about *which* record types mean what is
held in one frozen ``MetricConfig``; the operators themselves are generic.
``HEALTH`` describes a wearable health export, ``EVENTS`` re-maps the same
roles onto the driver's ``events`` table (see ``vitals.sources.staging``).
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values of the export format (must equal the source data) -------
# Quantity record types promoted from bronze to silver.
HEALTH_QUANTITY_TYPES = (
    "HKQuantityTypeIdentifierHeartRate",
    "HKQuantityTypeIdentifierRestingHeartRate",
    "HKQuantityTypeIdentifierHeartRateVariabilitySDNN",
    "HKQuantityTypeIdentifierVO2Max",
    "HKQuantityTypeIdentifierBodyMass",
    "HKQuantityTypeIdentifierStepCount",
    "HKQuantityTypeIdentifierActiveEnergyBurned",
    "HKQuantityTypeIdentifierBasalEnergyBurned",
    "HKQuantityTypeIdentifierDistanceWalkingRunning",
    "HKQuantityTypeIdentifierAppleExerciseTime",
    "HKQuantityTypeIdentifierRespiratoryRate",
    "HKQuantityTypeIdentifierTimeInDaylight",
)
HEALTH_SLEEP_TYPE = "HKCategoryTypeIdentifierSleepAnalysis"
HEALTH_ASLEEP_STAGES = (
    "HKCategoryValueSleepAnalysisAsleepCore",
    "HKCategoryValueSleepAnalysisAsleepDeep",
    "HKCategoryValueSleepAnalysisAsleepREM",
    "HKCategoryValueSleepAnalysisAsleepUnspecified",
)
HEALTH_DEEP_STAGE = "HKCategoryValueSleepAnalysisAsleepDeep"
HEALTH_REM_STAGE = "HKCategoryValueSleepAnalysisAsleepREM"
HEALTH_AWAKE_STAGE = "HKCategoryValueSleepAnalysisAwake"
HEALTH_WORKOUT_PREFIX = "HKWorkoutActivityType"
HEALTH_ENERGY_STAT = "HKQuantityTypeIdentifierActiveEnergyBurned"
HEALTH_DISTANCE_PREFIX = "HKQuantityTypeIdentifierDistance"
HEALTH_INDOOR_KEY = "HKIndoorWorkout"
# Timestamp layout of the export: local wall clock plus UTC offset.
EXPORT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss xx"
# Serving whitelist: metric name -> gold table.
METRIC_TABLES = {
    "heart-rate": "gold_daily_heart_rate",
    "resting-hr": "gold_daily_resting_hr",
    "hrv": "gold_daily_hrv",
    "respiratory-rate": "gold_daily_respiratory_rate",
    "vo2max": "gold_vo2max",
    "weight": "gold_weight",
    "activity": "gold_daily_activity",
    "calendar": "gold_daily_calendar",
    "sleep": "gold_daily_sleep",
    "workouts": "gold_workouts",
    "workout-summary": "gold_workout_summary",
}
# Data-quality checks: (counter, label). Thresholds live in vitals.operators.quality.
QUALITY_CHECKS = (
    ("silver_records", "records survived silver"),
    ("silver_workouts", "workouts survived silver"),
    ("invalid_numeric_value", "invalid numeric values below 1% of bronze"),
    ("invalid_timestamp", "invalid timestamps below 1% of bronze"),
)
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class MetricConfig:
    """Roles of record types. Table names follow ``gold_<name>``."""

    quantity_types: tuple[str, ...]
    # point metrics: daily avg/min/max/count, rounded to 1 decimal
    point: tuple[tuple[str, str], ...]
    # sparse metrics: daily average, rounded to 2 decimals
    sparse: tuple[tuple[str, str], ...]
    # cumulative metrics: (activity column, type, decimals), best source per day
    cumulative: tuple[tuple[str, str, int], ...]
    sleep_type: str
    asleep_stages: tuple[str, ...]
    deep_stage: str
    rem_stage: str
    awake_stage: str
    workout_prefix: str
    energy_stat: str
    distance_prefix: str
    indoor_key: str
    # calendar: (level column, activity column) and the columns it carries
    levels: tuple[tuple[str, str], ...] = (("level_kcal", "active_kcal"), ("level_steps", "steps"))
    calendar_columns: tuple[str, ...] = ("steps", "active_kcal", "distance_km")
    # summary row inputs
    summary_point: str = "daily_heart_rate"
    summary_sparse: str = "weight"
    summary_steps: str = "steps"

    @property
    def cumulative_types(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(t for _, t, _ in self.cumulative))


HEALTH = MetricConfig(
    quantity_types=HEALTH_QUANTITY_TYPES,
    point=(
        ("daily_heart_rate", "HKQuantityTypeIdentifierHeartRate"),
        ("daily_resting_hr", "HKQuantityTypeIdentifierRestingHeartRate"),
        ("daily_hrv", "HKQuantityTypeIdentifierHeartRateVariabilitySDNN"),
        ("daily_respiratory_rate", "HKQuantityTypeIdentifierRespiratoryRate"),
    ),
    sparse=(
        ("vo2max", "HKQuantityTypeIdentifierVO2Max"),
        ("weight", "HKQuantityTypeIdentifierBodyMass"),
    ),
    cumulative=(
        ("steps", "HKQuantityTypeIdentifierStepCount", 0),
        ("active_kcal", "HKQuantityTypeIdentifierActiveEnergyBurned", 0),
        ("basal_kcal", "HKQuantityTypeIdentifierBasalEnergyBurned", 0),
        ("distance_km", "HKQuantityTypeIdentifierDistanceWalkingRunning", 2),
    ),
    sleep_type=HEALTH_SLEEP_TYPE,
    asleep_stages=HEALTH_ASLEEP_STAGES,
    deep_stage=HEALTH_DEEP_STAGE,
    rem_stage=HEALTH_REM_STAGE,
    awake_stage=HEALTH_AWAKE_STAGE,
    workout_prefix=HEALTH_WORKOUT_PREFIX,
    energy_stat=HEALTH_ENERGY_STAT,
    distance_prefix=HEALTH_DISTANCE_PREFIX,
    indoor_key=HEALTH_INDOOR_KEY,
)

# The driver's ``events`` table re-mapped onto the same roles: event types play
# record types, one type ("error") is left out of the whitelist, as unpromoted
# types are in a real export.
EVENTS = MetricConfig(
    quantity_types=("click", "view", "signup", "purchase"),
    point=(("daily_heart_rate", "click"), ("daily_resting_hr", "view")),
    sparse=(("weight", "signup"),),
    cumulative=(
        ("steps", "purchase", 0),
        ("active_kcal", "click", 0),
        ("basal_kcal", "view", 0),
        ("distance_km", "signup", 2),
    ),
    sleep_type="sleep",
    asleep_stages=("click", "view", "purchase"),
    deep_stage="view",
    rem_stage="purchase",
    awake_stage="error",
    workout_prefix="Prio",
    energy_stat="energy",
    distance_prefix="dist_",
    indoor_key="indoor",
)


@dataclass(frozen=True)
class Layout:
    """Medallion layout below one root (a shared file system URI on a cluster).

    The gold tables of a run lie together in a folder of that run; ``run`` names it, or else
    the pointer that a run switches when all its tables are written (``vitals.plans.snapshots``).
    """

    root: str
    run: str | None = None

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def elements(self) -> str:
        """What the scan of the export yields, partitioned by kind and class."""
        return self._p("bronze", "elements")

    @property
    def bronze_records(self) -> str:
        return self._p("bronze", "elements", "kind=record")

    @property
    def bronze_workouts(self) -> str:
        return self._p("bronze", "workouts")

    @property
    def silver_records(self) -> str:
        return self._p("silver", "records")

    @property
    def silver_sleep(self) -> str:
        return self._p("silver", "sleep")

    @property
    def silver_workouts(self) -> str:
        return self._p("silver", "workouts")

    @property
    def quarantine(self) -> str:
        return self._p("silver", "quarantine")

    @property
    def manifest(self) -> str:
        """The input files with their key folders."""
        return self._p("bronze", "manifest")

    @property
    def gold_dir(self) -> str:
        return self._p("gold")

    def gold(self, table: str) -> str:
        from vitals.plans.snapshots import current_run

        run = self.run or current_run(self)
        return self._p("gold", run, table) if run else self._p("gold", table)

    @property
    def quality_dir(self) -> str:
        return self._p("quality")

    @property
    def latest_report(self) -> str:
        return self._p("quality", "latest")
