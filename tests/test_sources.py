"""Bronze CSV sources and the table sink."""

from retentia.sources.bronze import read_bronze_clientes, save_table, write_csv
from tests.fixtures import client, frames


def test_csv_roundtrip_keeps_blanks_and_nulls(spark, tmp_path):
    c, _, _ = frames(spark, [client("C1", email=" A@B.COM ", ciudad="Sevilla "), client("C2", email=None)], [], [])
    write_csv(c, str(tmp_path / "c"))
    back = sorted(read_bronze_clientes(spark, str(tmp_path / "c")).collect())
    assert back == sorted(c.collect())


def test_save_table_partitions(spark, tmp_path, small_layers):
    path = str(tmp_path / "gold")
    save_table(small_layers.gold, path=path, partition_by="fecha_referencia", sort_within=["fecha_referencia"])
    back = spark.read.parquet(path)
    assert back.count() == 12000
    assert back.select("fecha_referencia").distinct().count() == 80
