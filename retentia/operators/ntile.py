"""Distributed NTILE over a whole table (no PARTITION BY).

``global_ntiles`` finds the keys at the tile borders of several orders at once, by exact selection, and gives each row its tiles as a
function of its own key and id: nothing is sorted or shuffled but counts. ``global_ntile`` and ``global_row_number`` number all rows instead:

``ntile(k).over(Window.orderBy(...))`` without a partition key moves every row into one task. Here the global row
number is built from range partitions instead:

1. ``repartitionByRange`` on the sort keys + ``sortWithinPartitions``: partition p holds the p-th slice of the order.
   The result is checkpointed (to ``spark.checkpoint.dir``) so the partition contents are fixed for the two uses
   below and survive executor loss.
2. Per-partition row counts (one row per partition) give each partition's offset; that table is bounded by the
   partition count and is broadcast.
3. Row number = offset + position inside the partition (from ``monotonically_increasing_id``, whose low 33 bits are
   the position within the partition). NTILE's bucket follows arithmetically from the row number and the total.

The sort keys should end with a unique column (e.g. the client id) so ties are broken deterministically and a hot
value can still be split across range partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.session import ensure_checkpoint_dir


def _order_cols(keys: list[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in keys]


def global_row_number(df: DataFrame, keys: list[tuple[str, bool]], out: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based row number in the order of ``keys`` ([(column, ascending), ...]) without a global window."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _order_cols(keys)
    staged = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__pos", F.monotonically_increasing_id() - F.shiftleft(F.col("__pid").cast("long"), 33))
              .persist(StorageLevel.DISK_ONLY))
    # persisted first so the checkpoint write reads the computed partitions instead of recomputing them
    ranged = staged.checkpoint(eager=True)
    staged.unpersist()
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"))
    return (ranged.join(F.broadcast(offsets), "__pid")
            .withColumn(out, F.coalesce(F.col("__off"), F.lit(0)) + F.col("__pos") + 1)
            .drop("__pid", "__pos", "__off"))


def ntile_of(row_number: Column, total: Column, k: int) -> Column:
    """Bucket 1..k of a 1-based row number, with the first ``total % k`` buckets one row larger (SQL NTILE)."""
    q = F.floor(total / k)
    rem = total - q * k
    big = rem * (q + 1)
    return (F.when(row_number <= big, F.floor((row_number - 1) / (q + 1)) + 1)
            .otherwise(rem + F.floor((row_number - 1 - big) / q) + 1)).cast("int")


def global_ntile(df: DataFrame, k: int, keys: list[tuple[str, bool]], out: str,
                 num_partitions: int | None = None) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY keys)`` for the whole DataFrame, computed without a single-partition window."""
    numbered = global_row_number(df, keys, "__rn", num_partitions)
    total = numbered.agg(F.count(F.lit(1)).alias("__total"))
    return (numbered.crossJoin(F.broadcast(total))
            .withColumn(out, ntile_of(F.col("__rn"), F.col("__total"), k))
            .drop("__rn", "__total"))


# ------------------------------------------------------------------------------------------ several orders at once
#: Rows around a tile border that are brought to the driver; beyond, the candidates are narrowed by further counts.
MOST_CANDIDATES = 20_000
#: Parts that a narrowing step cuts the candidates into.
PARTS = 256
_ID_BYTES = 6  # as a number exact in a double, in which Spark's approximate quantiles reckon


@dataclass
class _Border:
    """The row of rank ``rank`` (from 1) among the ``count`` rows of an order that meet the conditions."""
    order: str
    rank: int
    count: int
    kind: int
    level: int = 0
    conditions: list[Column] = field(default_factory=list)
    path: tuple = ()  # which conditions these are, so that borders with equal ones share their candidates


class _Order:
    """A sort key as comparable parts: kind (nulls, values, NaN in their places), value (turned round if descending), then the id.

    ``made`` are the expressions for kind and value over the table; ``kind``, ``value`` and ``id`` refer to them once projected.
    """

    def __init__(self, df: DataFrame, name: str, key: str, ascending: bool, row_id: str):
        x, kind = F.col(key), df.schema[key].dataType.typeName()
        if kind in ("byte", "short", "integer", "long"):
            value, strange = (x if ascending else F.bitwise_not(x)), F.lit(False)
        elif kind in ("float", "double"):
            value, strange = (x if ascending else -x), F.isnan(x)
        else:
            raise ValueError(f"{key}: keys are whole numbers or doubles, not {kind}")
        first, last = (F.lit(0), F.lit(2)) if ascending else (F.lit(2), F.lit(0))
        kinds = F.when(x.isNull(), first).when(strange, last).otherwise(F.lit(1))
        self.made = [kinds.alias(f"__kind_{name}"), F.when(~strange, value).alias(f"__value_{name}")]
        self.kind, self.value, self.id = F.col(f"__kind_{name}"), F.col(f"__value_{name}"), F.col("__id")
        self.whole = kind not in ("float", "double")
        self.text = df.schema[row_id].dataType.typeName() == "string"
        self.of_value = self._halves(self.value) if kind == "long" else [self.value]

    @staticmethod
    def _halves(x: Column) -> list[Column]:
        """A long in two parts that are exact as doubles."""
        return [F.shiftright(x.cast("long"), 32), x.cast("long").bitwiseAND(0xFFFFFFFF)]

    def part(self, level: int) -> Column:
        """What a border is narrowed by: the value, then the id (texts by six bytes at a time, as a number)."""
        if level < len(self.of_value):
            return self.of_value[level]
        level -= len(self.of_value)
        if not self.text:
            return self._halves(self.id)[level]
        chunk = F.substring(F.encode(self.id, "utf-8"), level * _ID_BYTES + 1, _ID_BYTES)
        return F.conv(F.rpad(F.hex(chunk), 2 * _ID_BYTES, "0"), 16, 10).cast("long")

    def above(self, border: tuple) -> Column:
        kind, value, row_id = border
        inside = self.id > F.lit(row_id)
        if value is not None:
            inside = (self.value > F.lit(value)) | ((self.value == F.lit(value)) & inside)
        return (self.kind > kind) | ((self.kind == kind) & inside)


def _borders(df: DataFrame, k: int, orders: dict[str, _Order], most: int) -> dict[str, list[tuple]]:
    """(kind, value, id) of the last row of each tile but the last, per order; ``df`` has the orders' projected columns."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(o.kind == c).alias(f"{name}_{c}") for name, o in orders.items() for c in (0, 1, 2)]).first()
    n = counts["n"]
    todo: list[_Border] = []
    for name, o in orders.items():
        for tile in range(1, k):
            rank = tile * (n // k) + min(tile, n % k)
            if not 0 < rank < n:
                continue
            for c in (0, 1, 2):
                own = counts[f"{name}_{c}"]
                if rank <= own:
                    todo.append(_Border(name, rank, own, c, 0 if c == 1 else len(o.of_value), [o.kind == c], (c,)))
                    break
                rank -= own
    while large := [b for b in todo if b.count > most]:
        _narrow(df, large, orders)
    if not todo:
        return {name: [] for name in orders}

    # one job for all orders; whole numbers and doubles have a column each
    groups = list({(b.order, b.path): b for b in todo}.values())

    def candidate(i: int, b: _Border) -> Column:
        o = orders[b.order]
        value = o.value if o.whole else F.lit(None)
        return F.when(_all(b.conditions), F.struct(F.lit(i).alias("i"), value.cast("long").alias("whole"),
                                                   (F.lit(None) if o.whole else o.value).cast("double").alias("broken"), o.id.alias("id")))

    # a group has ``most`` rows at most, and there are as many groups as borders at most
    found = df.select(F.explode(F.array(*[candidate(i, b) for i, b in enumerate(groups)])).alias("c")).where("c IS NOT NULL").select("c.*").toArrow()
    out: dict[str, list[tuple]] = {name: [] for name in orders}
    of_group: dict[int, list[tuple]] = {i: [] for i in range(len(groups))}
    for i, whole, broken, row_id in zip(*(found.column(c).to_pylist() for c in ("i", "whole", "broken", "id"))):
        of_group[i].append((broken if whole is None else whole, row_id))
    for i, group in enumerate(groups):
        of_group[i].sort(key=lambda r: (0 if r[0] is None else r[0], r[1].encode() if isinstance(r[1], str) else r[1]))
        for b in todo:
            if (b.order, b.path) == (group.order, group.path):
                out[b.order].append((b.kind, *of_group[i][b.rank - 1]))
    return out


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _narrow(df: DataFrame, borders: list[_Border], orders: dict[str, _Order]) -> None:
    """One step for all borders: approximate quantiles cut their candidates into parts, exact counts tell the part that holds the rank."""
    shares = [i / PARTS for i in range(1, PARTS)]
    parts = [orders[b.order].part(b.level) for b in borders]
    cuts = df.agg(*[F.percentile_approx(F.when(_all(b.conditions), x), shares, 10_000).alias(f"c{i}") for i, (b, x) in enumerate(zip(borders, parts))]).first()
    at = [sorted(set(cuts[f"c{i}"])) for i in range(len(borders))]

    def place(i: int) -> Column:
        own = F.array(*[F.lit(c) for c in at[i]])
        # even numbers lie between cuts, odd ones are a cut itself
        number = 2 * F.size(F.filter(own, lambda c: c < parts[i])) + F.when(F.array_contains(own, parts[i]), 1).otherwise(0)
        return F.when(_all(borders[i].conditions), F.struct(F.lit(i).alias("i"), number.alias("part")))

    rows = df.select(F.explode(F.array(*map(place, range(len(borders))))).alias("c")).where("c IS NOT NULL")
    counts = {(r.i, r.part): r.n for r in rows.groupBy("c.i", "c.part").agg(F.count(F.lit(1)).alias("n")).collect()}  # 2 x PARTS per border at most
    for i, b in enumerate(borders):
        for part in range(2 * len(at[i]) + 1):
            own = counts.get((i, part), 0)
            if b.rank <= own:
                break
            b.rank -= own
        b.count = own
        b.path += (part, *at[i])
        if part % 2:
            b.conditions.append(parts[i] == F.lit(at[i][part // 2]))
            b.level += 1
            continue
        if part:
            b.conditions.append(parts[i] > F.lit(at[i][part // 2 - 1]))
        if part // 2 < len(at[i]):
            b.conditions.append(parts[i] < F.lit(at[i][part // 2]))


def global_ntiles(df: DataFrame, k: int, orders: dict[str, tuple[str, bool]], row_id: str, most: int = MOST_CANDIDATES) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY key, row_id)`` for several orders {new column: (key, ascending)} of the whole table.

    Keys are whole numbers or doubles (nulls come first in ascending and last in descending order, NaN above all numbers); ``row_id`` is unique and breaks
    ties, ascending. ``df`` is read a few times (counted, narrowed, and once for the border rows), so it should be stored or cheap; the
    result is a projection of it. ``most``: candidates per border that the driver may hold; more are narrowed by counting first.
    """
    made = {name: _Order(df, name, key, ascending, row_id) for name, (key, ascending) in orders.items()}
    parts = [F.col(row_id).alias("__id"), *[c for o in made.values() for c in o.made]]
    borders = _borders(df.select(*parts), k, made, most)
    tiles = {}
    for name, o in made.items():
        tile = F.lit(1)
        for border in borders[name]:
            tile = tile + F.when(o.above(border), 1).otherwise(0)
        tiles[name] = tile.cast("int")
    return df.select("*", *parts).withColumns(tiles).drop("__id", *[f"__{x}_{name}" for name in made for x in ("kind", "value")])
