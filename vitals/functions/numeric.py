"""Rounding, sums and ntile arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitals.functions.parse import _col


def round_half_away(c: Column | str, digits: int = 0) -> Column:
    """Round the scaled binary value half away from zero.

    ``round(1.005, 2)`` is 1.0 here (1.005 * 100 is 100.49999...), where
    Spark's ``round`` works on the decimal text and gives 1.01. NaN and
    infinities pass through; a scaled value that overflows returns the input.
    """
    c = _col(c).cast("double")
    if digits == 0:
        return F.round(c)
    p = float(10**digits)
    r = F.round(c * F.lit(p)) / F.lit(p)
    return F.when(F.isnan(r) | (F.abs(r) == F.lit(float("inf"))), c).otherwise(r)


GRID = 1024.0  # sums of multiples of 1 / GRID are exact up to 2 ** 43


def full_parts(c: Column | str) -> tuple[Column, Column]:
    """The two sums that make up ``full_sum``: of the multiples, and of the rests.

    Each may be summed again over the groups of a finer aggregation before they are added.
    """
    c = _col(c)
    small = F.abs(c) < 2.0**42
    multiple = F.when(small, F.rint(c * GRID) / GRID).otherwise(c)
    return F.sum(multiple), F.sum(F.when(small, c - multiple).when(c.isNotNull(), 0.0))


def full_sum(c: Column | str) -> Column:
    """Sum of doubles, nearly as if it were rounded once, whatever order partial sums meet in.

    A value is split, without loss, into the nearest multiple of 1 / 1024 and the rest.
    Multiples add up without rounding while the total stays below 2 ** 43, and the rests
    are so small that their rounding does not reach the last bit of the total. So a
    rounded result that is an exact tie falls on the same side on every run. Values from
    2 ** 42 on, infinities and nan are added as they are.
    """
    multiples, rests = full_parts(c)
    return multiples + rests


def full_avg(c: Column | str) -> Column:
    """``full_sum / count`` of the non-NULL values (NULL when there are none)."""
    return F.try_divide(full_sum(c), F.count(_col(c)))


def ntile_bucket(rn: Column, n_rows: Column, buckets: int) -> Column:
    """``ntile(buckets)`` of the row numbered ``rn`` (1-based) out of ``n_rows``.

    The first ``n_rows % buckets`` buckets hold one row more, as in SQL.
    """
    q = F.floor(n_rows / buckets)
    r = n_rows - q * buckets
    big = r * (q + 1)
    first = F.floor((rn - 1) / (q + 1)) + 1
    rest = r + F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + 1
    return F.when(rn <= big, first).otherwise(rest).cast("bigint")
