"""Column-expression helpers (all JVM-side, no UDFs)."""

from vitals.functions.numeric import full_avg, full_parts, full_sum, ntile_bucket, round_half_away
from vitals.functions.parse import local_day, minute_boundaries, parse_double, parse_instant
from vitals.functions.text import day_text, iso_date, js_number

__all__ = [
    "day_text",
    "full_avg",
    "full_parts",
    "full_sum",
    "iso_date",
    "js_number",
    "local_day",
    "minute_boundaries",
    "ntile_bucket",
    "parse_double",
    "parse_instant",
    "round_half_away",
]
