"""Time joins: the latest row before (as-of), and points inside intervals (range).

The gold panel needs neither, because its two sides share the month grid; these are the general forms for tables that don't.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one key that a window may hold; a key with more is cut into time slices.
MOST_ROWS = 1_000_000


def _no_clash(left: list[str], right: list[str]) -> None:
    if both := sorted(set(left) & set(right)):
        raise ValueError(f"columns on both sides, rename them: {both}")


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, payload: list[str],
              tie: str, strict: bool = False, most_rows: int = MOST_ROWS) -> DataFrame:
    """Every row of ``left`` with ``payload`` of the row of ``right`` with equal ``on`` and the latest time not after its own.

    ``strict`` asks for an earlier time. Of rows of ``right`` with one time, the one with the greatest ``tie`` counts. Left rows without a
    match, with a null key or with a null time have a null payload; repeated left rows stay; right rows with a null key or time match nothing.

    Both sides are put under each other and each left row takes the last right row above it, in one window per key. Keys with more
    than ``most_rows`` rows are cut into time slices at quantiles of their own times, and what the slices before hand over is an extra right row at
    the head of a slice. Those keys are counted first; there can't be more than (rows / ``most_rows``) of them.
    """
    _no_clash(left.columns, payload)
    keys = [f"__k{i}" for i in range(len(on))]
    given = F.struct(*[F.col(c) for c in payload])
    whole = F.lit(True)
    for c in on:
        whole = whole & F.col(c).isNotNull()
    lefts = left.select(*[F.col(c).alias(k) for c, k in zip(on, keys)], F.col(left_time).alias("__t"), F.struct(*[F.col(c) for c in left.columns]).alias("__l"),
                        (whole & F.col(left_time).isNotNull()).alias("__ok"))
    rights = right.where(whole & F.col(right_time).isNotNull()).select(*[F.col(c).alias(k) for c, k in zip(on, keys)], F.col(right_time).alias("__t"),
                                                                      F.col(tie).alias("__tie"), given.alias("__r"))
    # at one time, right rows stand above left rows unless only earlier ones count
    rows = (lefts.where("__ok").drop("__ok").withColumn("__side", F.lit(0 if strict else 1))
            .unionByName(rights.withColumn("__side", F.lit(1 if strict else 0)), allowMissingColumns=True))
    rows = _sliced(rows, keys, most_rows)
    order = Window.partitionBy(*keys, "__slice").orderBy(F.col("__t").asc_nulls_first(), "__side", "__tie")
    found = F.last("__r", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    matched = rows.withColumn("__m", found).where("__l IS NOT NULL").select("__l.*", *[F.col("__m")[c].alias(c) for c in payload])
    kinds = {c: right.schema[c].dataType for c in payload}
    rest = lefts.where(~F.col("__ok")).select("__l.*", *[F.lit(None).cast(kinds[c]).alias(c) for c in payload])
    return matched.unionByName(rest)


def _sliced(rows: DataFrame, keys: list[str], most_rows: int) -> DataFrame:
    """``rows`` with ``__slice``, and for the slices of large keys one more right row that holds what came before."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    largest = counts.agg(F.max("__n")).first()[0] or 0
    if largest <= most_rows:
        return rows.withColumn("__slice", F.lit(0))
    slices = 2 * math.ceil(largest / most_rows)
    hot = counts.where(F.col("__n") > most_rows).select(*keys, F.lit(True).alias("__hot"))
    rows = rows.join(F.broadcast(hot), keys, "left")  # rows / most_rows keys at most
    shares = [i / slices for i in range(1, slices)]
    cuts = rows.where("__hot").agg(F.percentile_approx("__t", shares, 10_000)).first()[0]
    at = F.lit(0)
    for cut in sorted(set(cuts)):
        at = at + F.when(F.col("__t") >= F.lit(cut), 1).otherwise(0)
    rows = rows.withColumn("__slice", F.when(F.col("__hot"), at).otherwise(0))
    last = F.max_by(F.col("__r"), F.when(F.col("__r").isNotNull(), F.struct("__t", "__tie")))
    ends = rows.where("__hot").groupBy(*keys, "__slice").agg(last.alias("__r"))  # a row per slice
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    heads = ends.withColumn("__r", F.last("__r", ignorenulls=True).over(earlier)).where("__r IS NOT NULL").withColumn("__side", F.lit(-1))
    return rows.drop("__hot").unionByName(heads, allowMissingColumns=True)


def _units(df: DataFrame, column: str) -> Column:
    """A date (days), timestamp (microseconds) or whole number as a long."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    return c.cast("long")


def range_join(left: DataFrame, right: DataFrame, on: list[str], start: str, end: str, point: str, width: int | None = None) -> DataFrame:
    """Pairs of a left interval [``start``, ``end``) and a right ``point`` inside it, with equal ``on``: all left columns, and the right ones but ``on``.

    Time is cut into bins of ``width`` units (days, microseconds or numbers; default: the mean length of the intervals). A left row is
    repeated for the bins it touches and meets the points of each bin by equality of key and bin; the exact bounds are checked on the
    pairs. A point lies in one bin, so a pair is found once, and the rows of one key are spread over its bins. An interval takes
    length / ``width`` + 2 rows at most. Empty and null intervals, null points and null keys give no pairs.
    """
    others = [c for c in right.columns if c not in on]
    _no_clash(left.columns, others)
    lo, hi = _units(left, start), _units(left, end)
    spans = left.where(hi > lo)
    if width is None:
        width = max(1, round(spans.agg(F.avg(hi - lo)).first()[0] or 1))
    keys = [f"__k{i}" for i in range(len(on))]
    named = [F.col(c).alias(k) for c, k in zip(on, keys)]
    bins = F.explode(F.sequence(F.floor(lo / width), F.floor((hi - 1) / width)))
    ls = spans.select(*named, lo.alias("__lo"), hi.alias("__hi"), F.struct(*[F.col(c) for c in left.columns]).alias("__l"), bins.alias("__bin"))
    at = _units(right, point)
    rs = right.select(*named, at.alias("__at"), F.struct(*[F.col(c) for c in others]).alias("__r"), F.floor(at / width).alias("__bin"))
    pairs = ls.join(rs, [*keys, "__bin"]).where((F.col("__at") >= F.col("__lo")) & (F.col("__at") < F.col("__hi")))
    return pairs.select("__l.*", "__r.*")
