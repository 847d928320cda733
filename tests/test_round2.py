"""Amounts, one-class metrics, the model registry and stored layers."""

import pytest
from pyspark.sql import functions as F

from retentia.functions.numeric import money_avg, money_sum
from retentia.operators import models as MD
from retentia.operators import reports as RP
from retentia.plans import layers as LY
from tests.conftest import SF_SMALL


def test_money_is_not_cut_to_cents_or_limited(spark):
    small = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (None,)], "x double")
    assert small.agg(money_sum("x"), money_avg("x")).first()[:] == (0.012, 0.004)
    for huge in (1e17, 1e30):
        total = spark.createDataFrame([(huge,), (huge,)], "x double").agg(money_sum("x")).first()[0]
        assert total == pytest.approx(2 * huge)
    assert small.limit(0).agg(money_sum("x"), money_avg("x")).first()[:] == (None, None)


@pytest.mark.parametrize("y", [0, 1])
def test_metrics_of_one_class(spark, y):
    rows = [(y, 0.2 + 0.1 * i, int(i > 2)) for i in range(6)]
    out = RP.evaluate(spark.createDataFrame(rows, f"fuga_combinada_1m int, {RP.PROB} double, {RP.PRED} int")).first()
    assert out.roc_auc is None and out.accuracy == 0.5 and out.log_loss > 0


def test_registry_gathers_the_runs_of_a_model(spark):
    training = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double")
    first = MD.registry_entry(training, "m", "T", "x", ["a"], created="2001-01-01 00:00:00")
    again = MD.registry_entry(training, "m", "T", "y", ["a", "b"], created="2002-01-01 00:00:00", options={"k": 1})
    other = MD.registry_entry(training.limit(0), "o", "T", "z", ["a"], created="2001-01-01 00:00:00")
    rows = RP.model_info(again.union(first).union(other), "m").collect()
    assert [(r.location, r.num_training_runs, r.features_usadas) for r in rows] == [("x", 2, ["a"])]
    run = again.first().training_run[0]
    assert run.options == {"k": "1", "training_rows": "5"}
    assert other.first().training_run[0].options["training_rows"] == "0"


def test_unknown_tree_layout_is_an_error(spark, monkeypatch, tmp_path):
    class Model:
        def write(self):
            return self

        def overwrite(self):
            return self

        def save(self, path):
            spark.range(3).write.parquet(f"{path}/data")

    monkeypatch.setattr(MD, "_gbt", lambda model: Model())
    with pytest.raises(ValueError, match="layout"):
        MD.feature_importance(None, model_dir=f"{tmp_path}/m")


def test_layers_are_stored_once_per_input(spark):
    a, b = LY.Layers.from_testdata(spark, SF_SMALL), LY.Layers.from_testdata(spark, SF_SMALL)
    assert a.gold.inputFiles() and sorted(a.gold.inputFiles()) == sorted(b.gold.inputFiles())
    month = a.gold.agg(F.max("fecha_referencia")).first()[0]
    plan = a.gold.where(F.col("fecha_referencia") == F.lit(month))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha_referencia" in plan
    other = LY.Layers.from_testdata(spark, SF_SMALL, sentinel="1991-01-01")
    assert other.key != a.key
    other.silver_clientes.count()
    stored = [p for k, p in LY._STORED.items() if k[1] == other.key]
    assert LY.dispose(spark, other.key) == len(stored) == 1 and LY._STORED
    path = stored[0]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def test_cluster_sessions_need_a_shared_folder(monkeypatch):
    from retentia import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
