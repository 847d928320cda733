"""File-source streaming load of bronze CSV drops: only new files are appended, exactly once."""

import os

from retentia.sources import testdata as TD
from retentia.sources.bronze import write_csv
from retentia.streaming import ingest_bronze
from tests.conftest import SF_SMALL


def _drop(df, staging, landing, tag):
    """Write ``df`` as CSV in a staging folder, then publish its files into the landing folder."""
    write_csv(df, staging)
    os.makedirs(landing, exist_ok=True)
    for f in os.listdir(staging):
        if f.endswith(".csv"):
            os.link(os.path.join(staging, f), os.path.join(landing, f"{tag}-{f}"))


def test_incremental_bronze_load(spark, tmp_path):
    landing, lake, ckpt, stage = (str(tmp_path / d) for d in ("landing", "lake", "ckpt", "stage"))
    c, t, d = TD.bronze_tables(spark, SF_SMALL)
    first, second = t.randomSplit([0.5, 0.5], seed=1)
    _drop(c, f"{stage}/c", f"{landing}/bronze_clientes", "c")
    _drop(d, f"{stage}/d", f"{landing}/bronze_devoluciones", "d")
    _drop(first, f"{stage}/t1", f"{landing}/bronze_transacciones", "t1")
    n1 = ingest_bronze(spark, landing, lake, ckpt)
    assert n1["bronze_transacciones"] == first.count()
    _drop(second, f"{stage}/t2", f"{landing}/bronze_transacciones", "t2")
    n2 = ingest_bronze(spark, landing, lake, ckpt)
    assert n2["bronze_transacciones"] == second.count()
    assert n2["bronze_clientes"] == 0
    assert spark.read.parquet(f"{lake}/bronze_transacciones").count() == t.count()
    assert sorted(spark.read.parquet(f"{lake}/bronze_clientes").collect()) == sorted(c.collect())
