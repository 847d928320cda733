"""Numeric helpers shared by operators and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, places: int) -> Column:
    """Round a double half away from zero at ``places`` decimals, as a double.

    The value is first snapped to 10 decimals through DECIMAL(38,10), so two engines whose doubles differ in the last
    bit (different summation order) still round the same way; plain ``round`` on a double would round 1.005 by its
    binary value.
    """
    x = _c(c)
    # NaN, infinities and magnitudes beyond DECIMAL(38,10) are passed through unchanged instead of failing the job
    return F.coalesce(F.round(x.try_cast(T.DecimalType(38, 10)), places).cast("double"), x)


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Division that yields NULL for a zero or NULL denominator instead of failing the job (ANSI mode)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    """``round(part * 100 / whole, places)`` with double arithmetic."""
    return round_half_up(_c(part).cast("double") * F.lit(100.0) / _c(whole).cast("double"), places)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every DOUBLE column of ``df`` (used to compare results across engines)."""
    cols = [round_half_up(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def money_sum(c: Column | str) -> Column:
    """Sum of an amount, returned as DOUBLE: exact to 10 decimals (DECIMAL accumulation) where all amounts and the total
    fit DECIMAL(38,10), else the plain double sum.

    The exact form is order-independent, so every engine and every partitioning gives the same total.
    """
    x = _c(c).cast("double")
    exact = x.try_cast(T.DecimalType(38, 10))
    all_fit = F.count(x) == F.count(exact)
    return F.coalesce(F.when(all_fit, F.try_sum(exact).cast("double")), F.sum(x))


def money_avg(c: Column | str) -> Column:
    """Average of an amount from ``money_sum`` (NULLs ignored, like AVG)."""
    return F.try_divide(money_sum(c), F.count(_c(c)).cast("double"))
