"""Helpers shared by the corpus operators: stored intermediates, gapless ranks, connected components, ASCII rules."""

from __future__ import annotations

import itertools
import string
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retentia.session import ensure_checkpoint_dir

#: bytes.translate table that lower-cases A-Z and leaves every other byte alone.
ASCII_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also touch other scripts)."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed once, lineage cut, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_worker(key: tuple, build: Callable[[], Any]) -> Any:
    """One object per Python worker process, kept over the tasks that it runs (functions themselves come anew with each task)."""
    held = sys.__dict__.setdefault("_retentia_held", {})
    if key not in held:
        held[key] = build()
    return held[key]


#: Rows per Arrow batch. Texts are some kilobytes each, so Spark's default of 10,000 rows makes large batches.
BATCH_ROWS = 2000


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows, so that workers hold few texts at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete a query's shuffle files when the query ends; what later steps need is stored, so nothing reads them again."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def text_pieces(batch: pa.RecordBatch, column: str | int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text in ``column``, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


#: Rows up to which a stored table is broadcast; beyond, joins shuffle and AQE splits skewed partitions.
BROADCAST_ROWS = 1 << 20


def broadcast_if_small(stored: DataFrame, weight: Column | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a stored table for broadcast if its rows (or the sum of ``weight``) are counted and found to be few."""
    n = stored.agg(F.coalesce(F.sum(weight if weight is not None else F.lit(1)), F.lit(0))).first()[0]
    return F.broadcast(stored) if n <= most else stored


def frequent_from(counted: DataFrame, most: int = BROADCAST_ROWS) -> int:
    """The power of two from which on rows of ``counted`` (n) count as frequent, so that these are ``most`` at most."""
    power = F.floor(F.log2("n")).cast("int")
    cut, held = 62, 0
    for r in counted.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("power")).collect():  # 63 at most
        held += r.rows
        if held > most:
            break
        cut = r.power
    return 1 << cut


def salts_for(spark: SparkSession) -> int:
    """Parts that a hot group is dealt into: as many as there are shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def gapless_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, salts: int) -> DataFrame:
    """Number the rows of each group 0, 1, ... without sorting a whole group in one task.

    Rows are dealt to ``salts`` parts of their group by a hash of the order columns; each part is numbered on its
    own and shifted by the rows in the parts before it. The table of shifts has at most groups x salts rows. Rows equal in
    all order columns are numbered in any order. ``df`` is read twice.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")
    dealt = df.withColumn("__part", part)
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (dealt.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    within = Window.partitionBy(*group, "__part").orderBy(*order)
    ranked = dealt.withColumn("__row", F.row_number().over(within))
    return (ranked.join(shifts, [*group, "__part"])
            .withColumn(out, F.col("__row") - 1 + F.col("__shift")).drop("__part", "__row", "__shift"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of the graph with edges (a long, b long): rows (node, component), component = smallest node.

    Alternating large-star and small-star steps. Every step is a partially aggregated minimum per node and a join of
    the edges with those minima, so a node with very many edges is aggregated map-side and its join partition can be
    split. Each round is stored in the shared folder; rounds end when a round changes nothing. Nodes without an edge
    to another node are not returned. No edges: no rows.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())

    links = store(links, "components")
    before = mark(links)
    while before[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(low).distinct())
        links = store(small, "components")
        after = mark(links)
        if after == before:
            break
        before = after
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)


def grouped(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """(key, rows) of each group of rows that arrive sorted by ``keys``; a group may reach over several batches."""
    rest = None
    for pdf in itertools.chain(batches, [None]):
        if pdf is not None and len(pdf):
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            ready = False
        elif pdf is None and rest is not None:
            ready = True
        else:
            continue
        values = [rest[k].to_numpy() for k in keys]
        change = np.zeros(len(rest), dtype=bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), len(rest)]
        last = len(edges) - 1 if ready else len(edges) - 2
        for lo, hi in zip(edges[:last], edges[1:last + 1]):
            yield tuple(v[lo] for v in values), rest.iloc[lo:hi]
        rest = None if ready else rest.iloc[edges[last]:]
