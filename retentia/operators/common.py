"""Small DataFrame building blocks shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.numeric import pct
from retentia.session import ensure_checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder (``spark.checkpoint.dir``) and read back: computed once, and its lineage ends there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share_of_total(df: DataFrame, col: str, out: str, places: int = 2) -> DataFrame:
    """Add ``round(col * 100 / SUM(col) OVER (), places)``.

    The grand total is a one-row aggregate joined back by broadcast (its size is one row by construction), so the
    groups stay distributed instead of being pulled into the single partition an unpartitioned window needs.
    """
    total = df.agg(F.sum(col).alias("__total"))
    return (df.crossJoin(F.broadcast(total))
            .withColumn(out, pct(F.col(col), F.col("__total"), places))
            .drop("__total"))


def bool_count(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as BIGINT."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")
