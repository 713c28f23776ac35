"""Output formatting: ISO texts, JSON rows, the calendar's day text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitals.functions.parse import _col


def iso_date(c: Column | str) -> Column:
    """DATE -> ``yyyy-MM-dd`` text."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def js_number(c: Column | str) -> Column:
    """A double as a script engine prints it: ``3`` not ``3.0``, ``2.5`` stays."""
    return F.regexp_replace(_col(c).cast("string"), r"\.0$", "")


def grouped_round(c: Column | str) -> Column:
    """Rounded to an integer (half up), with thousands marks: ``1,000``."""
    c = _col(c)
    return F.format_number(F.floor(c + F.lit(0.5)), 0)


def day_text(local_date: Column | str, steps: Column | str, kcal: Column | str, km: Column | str) -> Column:
    """``"1,000 steps · 150 kcal · 2.5 km on Dec 1, 2025"``.

    Zero or missing parts are left out; with none left the text reads
    ``No activity``. A day without a row passes NULLs.
    """
    steps, kcal, km = _col(steps), _col(kcal), _col(km)
    nonzero = lambda x: x.isNotNull() & (x != 0)
    parts = F.concat_ws(
        " · ",
        F.when(nonzero(steps), F.concat(grouped_round(steps), F.lit(" steps"))),
        F.when(nonzero(kcal), F.concat(grouped_round(kcal), F.lit(" kcal"))),
        F.when(nonzero(km), F.concat(js_number(km), F.lit(" km"))),
    )
    head = F.when(parts == "", F.lit("No activity")).otherwise(parts)
    return F.concat(head, F.lit(" on "), F.date_format(_col(local_date), "MMM d, yyyy"))
