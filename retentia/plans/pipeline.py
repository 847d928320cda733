"""The production pipeline: every layer is written as a table and the next layer reads it back.

This mirrors the reference's chain of ``CREATE OR REPLACE TABLE`` statements and is what runs at scale:

* Each write cuts the lineage, so a lost executor only recomputes the current layer from stored files.
* Downstream plans start at Parquet scans, so filters and column pruning reach the files (``PushedFilters``,
  ``ReadSchema``) and gold's month filters prune directories (gold is partitioned by ``fecha_referencia``).
* Gold's per-(client, month) aggregation starts from the stored silver table, so it is partially aggregated before
  its shuffle; a very active client does not end up as one oversized task.

Usage::

    python -m retentia.plans.pipeline --sf-dir /root/testdata/sf0.01 --out <shared-folder>/retail
"""

from __future__ import annotations

import argparse
import json
import os
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from retentia.operators import boosting as BT
from retentia.operators import features as FT
from retentia.operators import gold as G
from retentia.operators import models as MD
from retentia.operators import reports as RP
from retentia.operators import silver as S
from retentia.sources import testdata as TD
from retentia.sources.bronze import save_table


@dataclass
class PipelineResult:
    root: str
    paths: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.paths[name])


class Pipeline:
    def __init__(self, spark: SparkSession, root: str, as_of: str | None = None,
                 sentinel: str = G.REFERENCE_SENTINEL):
        self.spark = spark
        self.result = PipelineResult(root)
        self.as_of = as_of
        self.sentinel = sentinel

    def _write(self, name: str, df: DataFrame, **kw) -> DataFrame:
        path = os.path.join(self.result.root, name)
        t0 = time.time()
        save_table(df, path=path, **kw)
        self.result.seconds[name] = time.time() - t0
        self.result.paths[name] = path
        return self.spark.read.parquet(path)

    def _save_model(self, model, model_id: str) -> str:
        path = os.path.join(self.result.root, "models", model_id)
        t0 = time.time()
        MD.save_model(model, path)
        self.result.seconds["save_" + model_id] = time.time() - t0
        self.result.paths["model_" + model_id] = path
        return path

    def bronze(self, clientes: DataFrame, transacciones: DataFrame, devoluciones: DataFrame):
        return (self._write("bronze_clientes", clientes), self._write("bronze_transacciones", transacciones),
                self._write("bronze_devoluciones", devoluciones))

    def silver(self, bronze_c: DataFrame, bronze_t: DataFrame, bronze_d: DataFrame):
        sc = self._write("silver_clientes", S.silver_clientes(bronze_c, as_of=self.as_of))
        st = self._write("silver_transacciones", S.silver_transacciones(bronze_t, sc))
        sd = self._write("silver_devoluciones", S.silver_devoluciones(bronze_d, st))
        return sc, st, sd

    def gold(self, st: DataFrame, sd: DataFrame) -> DataFrame:
        months = self._write("compras_mensuales", G.client_month_purchases(st))
        parts = G.panel_partitions(months)
        g = G.gold_panel(months, G.client_month_returns(sd), self.sentinel, parts)
        # Sorting each task's rows by month first lets the partitioned writer stream one month directory at a time.
        return self._write("gold_caracterizacion_mensual_clientes", g, partition_by="fecha_referencia",
                           sort_within=["fecha_referencia", "cliente_id"], rebalance=parts is None)

    def churn_model(self, gold: DataFrame, model_id: str = "modelo_churn_xgboost"):
        training = self._write("datos_entrenamiento_churn", FT.training_set(gold))
        t0 = time.time()
        model = BT.fit_churn_trees(training)
        self.result.seconds["fit_churn_model"] = time.time() - t0
        model_path = os.path.join(self.result.root, "models", model_id)
        t0 = time.time()
        BT.save_trees(model, self.spark, model_path)
        self.result.seconds["save_" + model_id] = time.time() - t0
        self.result.paths["model_" + model_id] = model_path
        # the held-out predictions are stored once; the metrics read them instead of re-scoring in every branch
        held_out = self._write("predicciones_evaluacion", BT.evaluation_predictions(model, training))
        t0 = time.time()
        evaluation = RP.evaluate(held_out)
        self.result.seconds["evaluate"] = time.time() - t0
        run = uuid.uuid4().hex
        for name, add in (("metricas_modelo_churn", lambda path: RP.store_metrics(RP.metrics_record(evaluation, model_id), path, run)),
                          ("model_registry", lambda path: MD.register_run(MD.registry_entry(training, model_id, "BOOSTED_TREE_CLASSIFIER", model_path,
                                                                                            FT.CHURN_FEATURES, options=BT.PARAMS), path))):
            self.result.paths[name] = os.path.join(self.result.root, name)
            t0 = time.time()
            add(self.result.paths[name])
            self.result.seconds[name] = time.time() - t0
        scoring = self._write("clientes_scoring_actual", FT.scoring_set(gold))
        predictions = self._write("predicciones_churn", BT.predict_churn(model, scoring))
        return model, predictions

    def segments(self, gold: DataFrame, model_id: str = "modelo_clustering_kmeans"):
        data = self._write("datos_clustering", FT.clustering_set(gold))
        t0 = time.time()
        model = MD.fit_segments(data)
        self.result.seconds["fit_segments"] = time.time() - t0
        model_path = self._save_model(model, model_id)
        segmented = self._write("clientes_segmentados", MD.assign_segments(model, data))
        return model, segmented


def run_testdata(spark: SparkSession, sf_dir: str, root: str, with_models: bool = True) -> PipelineResult:
    """Whole pipeline on the generated test tables (bronze derived with the FIXTURES.md mapping)."""
    p = Pipeline(spark, root, as_of=TD.TESTDATA_AS_OF, sentinel=TD.TESTDATA_SENTINEL)
    bc, bt, bd = p.bronze(*TD.bronze_tables(spark, sf_dir))
    sc, st, sd = p.silver(bc, bt, bd)
    gold = p.gold(st, sd)
    if with_models:
        p.churn_model(gold)
        p.segments(gold)
    return p.result


def main() -> None:
    from retentia.session import build_session, ensure_checkpoint_dir
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", default=None, help="output folder (default: a new folder under spark.checkpoint.dir)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--no-models", action="store_true")
    a = ap.parse_args()
    spark = build_session(a.master)
    root = a.out or os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{int(time.time())}")
    res = run_testdata(spark, a.sf_dir, root, with_models=not a.no_models)
    print(json.dumps({"root": res.root, "seconds": res.seconds}))


if __name__ == "__main__":
    main()
