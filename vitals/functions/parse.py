"""Typed views of exported text, as JVM-side column expressions.

All helpers return ``Column`` objects built from ``pyspark.sql.functions``, so
they stay inside whole-stage codegen; none of them is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitals.config import EXPORT_TIME_FORMAT

# Numeric text the cleaner accepts: decimal or exponent form, a sign, single underscores
# between digits, infinities and nan, and white space around it. Spark's own cast also
# takes "60d" and hex floats, which an export never means as numbers, and no underscores.
_DIGITS = "[0-9]+(?:_[0-9]+)*"
NUMERIC_TEXT = rf"(?i)^[+-]?(?:{_DIGITS}[.]?(?:{_DIGITS})?|[.]{_DIGITS})(?:e[+-]?{_DIGITS})?$|^[+-]?inf(?:inity)?$"
NAN_TEXT = r"(?i)^[+-]?nan$"
# The same with every part of the clock in its range; the group is the day
LOOSE_DAY = r"^\s*([0-9]{1,4}-[0-9]{1,2}-[0-9]{1,2})\s+(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]\s+[+-][0-9]{2}(?::?[0-9]{2})?\s*$"
# A time as the export format says, with every part but the day of the month in its range
PLAIN_TIME = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2} (?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9] [+-](?:0[0-9]|1[0-7])[0-5][0-9]\z"
SPACES = " \t\n\x0b\f\r"
# Times that are not spelled as the export format says, but mean one instant: one-digit
# parts, more white space, and offsets as +HH:MM or +HH
LOOSE_TIME = r"^\s*([0-9]{1,4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})\s+([+-][0-9]{2}(?::?[0-9]{2})?)\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(c: Column | str) -> Column:
    """Text -> double, NULL when the text is no number (never raises)."""
    text = F.btrim(_col(c), F.lit(SPACES))
    digits = F.when(text.contains("_"), F.replace(text, F.lit("_"), F.lit(""))).otherwise(text)
    number = F.when(text.rlike(NUMERIC_TEXT), digits.try_cast("double"))
    return F.coalesce(number, F.when(text.rlike(NAN_TEXT), F.lit(float("nan"))))


def _wall_clock(c: Column) -> Column:
    """A loosely spelled day and time, as if it were UTC; NULL for other text."""
    text = F.regexp_replace(F.regexp_extract(c, LOOSE_TIME, 1), r"\s+", " ")
    return F.try_to_timestamp(text, F.lit("y-M-d H:m:s"))


def _offset_seconds(c: Column) -> Column:
    """The offset of a loosely spelled time; NULL for other text."""
    text = F.replace(F.regexp_extract(c, LOOSE_TIME, 2), F.lit(":"), F.lit(""))
    hhmm = F.rpad(text, 5, "0").try_cast("int")  # +05 is +0500; the sign holds for both parts
    return (hhmm / 100).cast("int") * 3600 + hhmm % 100 * 60


def _loose_day(c: Column) -> Column:
    """The day of a loosely spelled time whose clock is in its range, without parsing the time; NULL for other text."""
    parts = F.split(F.regexp_extract(c, LOOSE_DAY, 1), "-")
    padded = [F.lpad(F.get(parts, F.lit(i)), width, "0") for i, width in enumerate((4, 2, 2))]
    return F.concat(padded[0], F.lit("-"), padded[1], F.lit("-"), padded[2]).try_cast("date")


def _cast_instant(c: Column) -> Column:
    """The instant of a ``PLAIN_TIME``; NULL for a day that is not in the calendar."""
    iso = F.concat(F.substring(c, 1, 19), F.substring(c, 21, 3), F.lit(":"), F.substring(c, 24, 2))
    return iso.try_cast("timestamp")


def parse_instant(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss +HHMM`` -> instant (TimestampType, UTC session).

    The export's own layout is tried first (times of usual years and offsets are cast, which needs
    no formatter); other spellings (``LOOSE_TIME``) are put together from the wall clock and the offset.
    """
    c = _col(c)
    plain = F.when(~c.startswith("-"), F.try_to_timestamp(c, F.lit(EXPORT_TIME_FORMAT)))  # no years before 0
    return F.coalesce(F.when(c.rlike(PLAIN_TIME), _cast_instant(c)), plain, F.timestamp_seconds(F.unix_seconds(_wall_clock(c)) - _offset_seconds(c)))


def local_day(c: Column | str) -> Column:
    """Wall-clock day of an export timestamp, as it is spelled.

    Never derived from the instant: 02:00 +0530 is the previous day in UTC.
    """
    c = _col(c)
    plain = F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
    return F.coalesce(plain, _wall_clock(c).cast("date"))


def parse_time(c: Column | str) -> Column:
    """``instant`` and ``day`` of an export timestamp: ``parse_instant`` and ``local_day`` of one reading.

    Times of usual years and offsets are cast, which needs no formatter; the loose spellings are looked at only where
    the export's own layout does not fit. No step is a function of higher order, which would be interpreted.
    """
    c = _col(c)
    day = F.substring(c, 1, 10).try_cast("date")  # the layout begins with it
    plain = F.when(~c.startswith("-"), F.try_to_timestamp(c, F.lit(EXPORT_TIME_FORMAT)))
    loose = F.timestamp_seconds(F.unix_seconds(_wall_clock(c)) - _offset_seconds(c))

    def both(instant: Column, day: Column) -> Column:
        return F.struct(instant.alias("instant"), day.alias("day"))

    usual = F.when(c.rlike(PLAIN_TIME) & day.isNotNull(), both(_cast_instant(c), day))
    return usual.otherwise(both(F.coalesce(plain, loose), _loose_day(c)))


def once(*columns: Column) -> Column:
    """For ``select``: the named ``columns``, made once. The generator is a step of its own in the plan,
    so a filter on them, or a projection, does not make them again."""
    return F.inline(F.array(F.struct(*columns)))


def minute_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end`` (bigint).

    00:00:59 -> 00:01:01 is 1, unlike ``timestampdiff(MINUTE)``; may be negative.
    """
    lo = F.unix_seconds(F.date_trunc("minute", _col(start)))
    hi = F.unix_seconds(F.date_trunc("minute", _col(end)))
    return ((hi - lo) / 60).cast("bigint")
