"""Model checks on planted-signal data (the test tables are random, so no lift is expected on them)."""

import random

import pytest
from pyspark.sql import functions as F

from retentia.operators import features as FT
from retentia.operators import models as MD
from retentia.operators import reports as RP


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        days = rnd.randint(1, 700)
        y = 1 if (days > 120) != (rnd.random() < 0.1) else 0
        vals = [float(days)] + [float(rnd.randint(0, 9)) for _ in range(len(FT.CHURN_FEATURES) - 1)]
        rows.append((f"C{i}", f"2001-0{1 + i % 6}-01", *vals, y))
    schema = ", ".join(["cliente_id string", "fecha_referencia string"]
                       + [f"{c} double" for c in FT.CHURN_FEATURES] + ["fuga_combinada_1m long"])
    return spark.createDataFrame(rows, schema).withColumn("fecha_referencia", F.to_date("fecha_referencia"))


def test_churn_model_learns_planted_signal(planted):
    model = MD.fit_churn_model(planted, maxIter=5)
    pred = MD.evaluation_predictions(model, planted)
    m = RP.evaluate(pred).first()
    assert m.roc_auc > 0.8 and 0 <= m.precision <= 1 and m.log_loss > 0
    probs = pred.agg(F.min(RP.PROB).alias("lo"), F.max(RP.PROB).alias("hi")).first()
    assert 0.0 <= probs.lo <= probs.hi <= 1.0
    fi = MD.feature_importance(model).collect()
    assert len(fi) == len(FT.CHURN_FEATURES)
    top = max(fi, key=lambda r: r.importance_weight)
    assert top.feature == "dias_desde_ultima_compra"
    gbt = MD._gbt(model)
    internal = sum(t.numNodes - (t.numNodes + 1) // 2 for t in gbt.trees)
    assert sum(r.importance_weight for r in fi) == internal


def test_segments_k5_sorted_distances(spark, planted):
    data = planted.select("cliente_id", *[F.col(c) for c in FT.CLUSTER_FEATURES if c in planted.columns])
    for c in FT.CLUSTER_FEATURES:
        if c not in data.columns:
            data = data.withColumn(c, F.lit(1.0))
    data = data.withColumn("coef_variacion_valor_6m",
                           F.when(F.col("num_compras_6m") == 1, None).otherwise(F.col("coef_variacion_valor_6m")))
    model = MD.fit_segments(data)
    out = MD.assign_segments(model, data)
    assert out.select("cluster_id").distinct().count() == 5
    assert out.where(F.col("cluster_id") != F.col("nearest_cluster")).count() == 0
    assert out.where(F.col("distance_to_centroid") < 0).count() == 0
    prof = RP.profile_segments(out).collect()
    assert sum(r.num_clientes for r in prof) == data.count()
    assert "VIP / Champions" in {r.nombre_segmento for r in prof}
