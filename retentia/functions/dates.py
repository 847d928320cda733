"""Calendar helpers, all JVM-side column expressions.

A *month index* is ``year * 12 + month - 1``. Every gold reference date is a month start and every window bound is a
whole number of months, so "purchase date in [m - k months, m)" is "month index in [i - k, i - 1]", which lets the
gold features use integer ``rangeBetween`` frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_index(d: Column | str) -> Column:
    d = F.col(d) if isinstance(d, str) else d
    return (F.year(d) * 12 + F.month(d) - 1).cast("int")


def month_start(idx: Column | str) -> Column:
    """Inverse of :func:`month_index`: the first day of that month as DATE."""
    idx = F.col(idx) if isinstance(idx, str) else idx
    return F.make_date(F.floor(idx / 12).cast("int"), (F.pmod(idx, F.lit(12)) + 1).cast("int"), F.lit(1))


def month_diff(end: Column | str, start: Column | str) -> Column:
    """Calendar-month boundaries crossed from ``start`` to ``end`` (Jan 31 -> Feb 1 is 1).

    This is the month difference of the reference, not ``months_between`` and not ``timestampdiff(MONTH)``.
    """
    return (month_index(end) - month_index(start)).cast("long")


def parse_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text to DATE (fails on malformed text, like the reference's strict parse)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(c, "yyyy-MM-dd")
