"""Wiring of the medallion layers (bronze -> silver -> gold) over one input.

With ``materialize`` (the default) the silver tables and the gold panel are written as Parquet under
``spark.checkpoint.dir`` when first used, gold partitioned by month, and read back, like the stored tables of the
production pipeline: the lineage is cut (a lost executor recomputes from the files, not from the raw tables), and
month-bounded reports prune partitions. The shuffle files of a layer's build are deleted once it is stored. A stored
layer is kept per application, input and input state (paths, lengths and modification times of its files), so all queries
over one input share one copy; changed files give a new one. ``dispose`` deletes the copies. (``Dataset.checkpoint`` would
compute each table twice, once for the action and once for the checkpoint write.)
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from retentia.operators import gold as G
from retentia.operators import silver as S
from retentia.session import ensure_checkpoint_dir
from retentia.sources import testdata as TD
from retentia.sources.bronze import save_table

# Fixed processing timestamp for reproducible silver tables in checks (CURRENT_TIMESTAMP in the reference).
CHECK_PROCESSED_AT = "2001-09-01 00:00:00"


#: (application, input key, layer) -> path of its stored copy.
_STORED: dict[tuple[str, str, str], str] = {}


def input_key(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the raw tables' files: path, length, modification time (read through Hadoop's file systems)."""
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for name in TD.TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)]
    return hashlib.sha256(repr((sf_dir, sorted(found))).encode()).hexdigest()


def dispose(spark: SparkSession, key: str | None = None) -> int:
    """Delete this application's stored layers (of one input, if ``key`` is given); how many there were."""
    own = [k for k in _STORED if k[0] == spark.sparkContext.applicationId and key in (None, k[1])]
    for k in own:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STORED.pop(k))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(own)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of a query run meanwhile when the query ends, not when the driver happens to collect its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class Layers:
    def __init__(self, spark: SparkSession, bronze: tuple[DataFrame, DataFrame, DataFrame],
                 as_of: str | None = TD.TESTDATA_AS_OF, sentinel: str = TD.TESTDATA_SENTINEL,
                 processed_at: str | None = CHECK_PROCESSED_AT, materialize: bool = True, key: str | None = None):
        self.spark = spark
        self.key = key or uuid.uuid4().hex
        self.materialize = materialize
        self.bronze_clientes, self.bronze_transacciones, self.bronze_devoluciones = bronze
        self.as_of = as_of
        self.sentinel = sentinel
        self.processed_at = processed_at

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Layers":
        key = input_key(spark, sf_dir) + repr(sorted((k, str(v)) for k, v in kw.items()))
        return cls(spark, TD.bronze_tables(spark, sf_dir), key=key, **kw)

    def _keep(self, build: Callable[[], DataFrame], name: str, partition_by: str | None = None,
              rebalance: Callable[[], bool] = lambda: True) -> DataFrame:
        if not self.materialize:
            return build()
        at = (self.spark.sparkContext.applicationId, self.key, name)
        if at not in _STORED:
            path = os.path.join(ensure_checkpoint_dir(self.spark), f"layer-{name}-{uuid.uuid4().hex}")
            with _shuffles_freed(self.spark):  # the layer is read from its files alone
                save_table(build(), path=path, partition_by=[partition_by] if partition_by else None, rebalance=rebalance())
            _STORED[at] = path
        return self.spark.read.parquet(_STORED[at])

    @cached_property
    def silver_clientes(self) -> DataFrame:
        return self._keep(lambda: S.silver_clientes(self.bronze_clientes, as_of=self.as_of, processed_at=self.processed_at),
                          "silver_clientes")

    @cached_property
    def silver_transacciones(self) -> DataFrame:
        return self._keep(lambda: S.silver_transacciones(self.bronze_transacciones, self.silver_clientes,
                                                 processed_at=self.processed_at), "silver_transacciones")

    @cached_property
    def silver_devoluciones(self) -> DataFrame:
        return self._keep(lambda: S.silver_devoluciones(self.bronze_devoluciones, self.silver_transacciones,
                                                processed_at=self.processed_at), "silver_devoluciones")

    @cached_property
    def client_months(self) -> DataFrame:
        return self._keep(lambda: G.client_month_purchases(self.silver_transacciones), "client_months")

    @cached_property
    def panel_partitions(self) -> int | None:
        return G.panel_partitions(self.client_months)

    @cached_property
    def gold(self) -> DataFrame:
        # a large panel is written from its window tasks, a file a month each: shuffling it by month would move the whole of it
        return self._keep(lambda: G.gold_panel(self.client_months, G.client_month_returns(self.silver_devoluciones), self.sentinel, self.panel_partitions),
                          "gold", "fecha_referencia", lambda: self.panel_partitions is None).select(*G.GOLD_COLUMNS)
