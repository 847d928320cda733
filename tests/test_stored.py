"""Named tables, partitions, the metrics table, the model registry, observed loads, and scans of the panel and of the evaluation."""

import uuid

import pytest
from pyspark.sql import functions as F

from retentia.operators import checks as B
from retentia.operators import gold as G
from retentia.operators import models as MD
from retentia.operators import reports as RP
from retentia.operators import silver as S
from retentia.sources import bronze as BR


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_a_failed_write_leaves_the_old_table(spark, tmp_path, name):
    first = spark.range(5).withColumn("p", F.col("id") % 2)
    for parts in (None, ["p"]):
        own = f"{name}_{bool(parts)}"
        old = BR.replace_table(first, own, parts, str(tmp_path))
        failing = first.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long"))
        with pytest.raises(Exception, match="broken"):
            BR.replace_table(failing, own, parts, str(tmp_path))
        assert sorted(r.id for r in spark.table(own).collect()) == [0, 1, 2, 3, 4]
        new = BR.replace_table(first.withColumn("id", F.col("id") + 10), own, parts, str(tmp_path))
        assert sorted(r.id for r in spark.table(own).collect()) == [10, 11, 12, 13, 14]
        assert new != old and spark.read.parquet(old).count() == 5  # readers of the old version can finish
        BR.replace_table(first.withColumn("more", F.lit("x")), own, parts, str(tmp_path))
        assert set(spark.table(own).columns) == {"id", "p", "more"}
        BR.replace_table(first.limit(0), own, parts, str(tmp_path))
        assert spark.table(own).count() == 0


def test_save_table_by_name_replaces_and_appends(spark, name):
    BR.save_table(spark.range(3), name=name)
    BR.save_table(spark.range(4), name=name)
    assert spark.table(name).count() == 4
    BR.save_table(spark.range(2), name=name, mode="append")
    assert spark.table(name).count() == 6


def test_one_month_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "x int, m string")
    BR.save_table(rows, path=path, partition_by="m")
    BR.replace_partitions(spark.createDataFrame([(9, "a"), (8, "c")], "x int, m string"), path, ["m"])
    assert sorted((r.x, r.m) for r in spark.read.parquet(path).collect()) == [(3, "b"), (8, "c"), (9, "a")]


def record(spark, at, auc):
    row = spark.createDataFrame([(0.5, 0.5, 0.5, 0.5, 0.7, auc)], ", ".join(f"{c} double" for c in RP.METRIC_COLUMNS))
    return RP.metrics_record(row, "m", at)


def test_metrics_table_keeps_runs_once(spark, tmp_path):
    path = str(tmp_path / "metrics")
    RP.store_metrics(record(spark, "2001-01-01 00:00:00", 0.95), path, "r1")
    RP.store_metrics(record(spark, "2001-02-01 00:00:00", 0.65), path, "r2")
    table = RP.store_metrics(record(spark, "2001-02-01 00:00:00", 0.75), path, "r2")  # the run is repeated
    assert [(r.fecha_evaluacion.month, r.roc_auc) for r in RP.list_metrics(table).collect()] == [(2, 0.75), (1, 0.95)]
    assert RP.interpret_metrics(table).first().evaluacion_roc_auc == "Bueno (0.70-0.80)"


def test_registry_row_is_extended(spark, tmp_path):
    path = str(tmp_path / "registry")
    data = spark.range(7).withColumn("a", F.lit(1.0))
    entry = lambda n, model, at: MD.registry_entry(data.where(F.col("id") < n), model, "T", f"at-{at[:4]}", ["a"], created=at, options={"k": n})
    for e in (entry(5, "m", "2002-01-01 00:00:00"), entry(1, "o", "2001-01-01 00:00:00"), entry(7, "m", "2003-01-01 00:00:00"), entry(7, "m", "2003-01-01 00:00:00")):
        table = MD.register_run(e, path)
    rows = {r.model_name: r for r in table.collect()}
    assert set(rows) == {"m", "o"} and table.count() == 2
    assert [(r.start_time.year, r.options["training_rows"], r.options["k"]) for r in rows["m"].training_run] == [(2002, "5", "5"), (2003, "7", "7")]
    assert rows["m"].location == "at-2002" and rows["m"].creation_time.year == 2002
    info = RP.model_info(table, "m").first()
    assert (info.num_training_runs, info.features_usadas) == (2, ["a"])


def test_loads_are_observed(spark, small_layers, tmp_path):
    got = B.load_observed(small_layers.bronze_transacciones, "t", str(tmp_path / "t"), ["transaccion_id", "cliente_id"], "importe_neto").first()
    want = B.check_bronze_transacciones(small_layers.bronze_transacciones).first()
    assert got[1:] == (want.total_filas, want.transacciones_unicas, want.clientes_distintos, want.ventas_totales)
    none = B.load_observed(small_layers.bronze_clientes.limit(0), "c", str(tmp_path / "c"), ["cliente_id"]).first()
    assert none[1:] == (0, 0, None)


def test_pivot_loses_no_channel(spark):
    rows = spark.createDataFrame([(1, "Web", 1.5), (1, "Fax", 2.0), (1, None, 4.0), (2, "App", 8.0)], "mes int, canal string, importe_neto double")
    got = sorted(map(tuple, S.sales_pivot(rows, ["mes"], values=("Web", "App")).collect()))
    assert got == [(1, 1.5, 0.0, 6.0), (2, 0.0, 8.0, 0.0)]
    assert S.sales_pivot(rows.limit(0), ["mes"]).count() == 0


def test_panel_reads_the_purchases_once(spark, small_layers, tmp_path):
    import re
    t = small_layers.silver_transacciones
    months = G.client_month_purchases(t)
    assert len(re.findall("FileScan", months._jdf.queryExecution().executedPlan().toString())) == 1
    panel = G.gold_features(t, small_layers.silver_devoluciones, "1990-01-01")
    plan = panel._jdf.queryExecution().executedPlan().toString()
    assert "importe_neto" not in plan  # the monthly rows are stored; the purchases themselves are not read again
    assert len(re.findall("Exchange hashpartitioning", plan)) <= 4


def test_null_dates_leave_clients_and_months_alike(spark):
    t = spark.createDataFrame([("a", None), ("b", "2001-01-05"), ("b", None)], "cliente_id string, d string").select("cliente_id", F.to_date("d").alias("fecha_transaccion"))
    assert [r[0] for r in G.active_clients(t).collect()] == ["b"] and G.client_month_spine(t).count() == 1


def test_evaluation_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(i % 2, (i % 7) / 7, i % 3 // 2) for i in range(300)], f"fuga_combinada_1m int, {RP.PROB} double, {RP.PRED} int")
    out = RP.evaluate(rows.mapInArrow(touch, rows.schema)).first()
    plain = RP.evaluate(rows).first()
    assert seen.value == 300 and out == plain
