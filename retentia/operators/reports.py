"""Scores, metrics, segment profiles and dashboard datasets.

Every function here takes the score or segment as a column of its input, so it works the same on a trained model's
output and on any deterministic stand-in score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.functions import labels as LB
from retentia.functions.numeric import money_avg, money_sum, pct, round_half_up as r
from retentia.operators.common import bool_count, share_of_total, stored
from retentia.sources.bronze import replace_partitions
from retentia.operators.gold import previous_month

PROB = "probabilidad_churn"
PRED = "prediccion_churn"
BAND = "nivel_riesgo"
LOG_LOSS_EPS = 1e-15


# ------------------------------------------------------------------------------------------------ M7: evaluation
def roc_auc(df: DataFrame, label: str, score: str, buckets: int | None = None, times: str | None = None) -> DataFrame:
    """Exact ROC AUC (ties count one half) as a one-row DataFrame, without a global sort in one task.

    Rows are first reduced to one row per distinct score with positive/negative counts (map-side combine, so one
    score shared by many rows is one row). Distinct scores are cut into ``buckets`` ranges by approximate quantiles
    (a one-row aggregate, broadcast); the negatives below each score are the sum over lower buckets (a table of at most
    ``buckets`` rows) plus a running sum inside its own bucket (a window partitioned by bucket). ``times``: how often a row counts.
    """
    if buckets is None:
        buckets = max(256, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    y, n = F.col(label).cast("double"), F.col(times) if times else F.lit(1)
    d = df.groupBy(F.col(score).cast("double").alias("__s")).agg(
        F.sum(F.when(y == 1, n).otherwise(0)).cast("double").alias("__pos"),
        F.sum(F.when(y == 1, 0).otherwise(n)).cast("double").alias("__neg"))
    qs = [i / buckets for i in range(1, buckets)]
    bounds = d.agg(F.percentile_approx("__s", qs, 10000).alias("__b"))
    d = (d.crossJoin(F.broadcast(bounds))
         .withColumn("__k", F.size(F.filter("__b", lambda b: b <= F.col("__s"))))
         .drop("__b"))
    per_bucket = d.groupBy("__k").agg(F.sum("__neg").alias("__bn"))
    offsets = per_bucket.select(
        "__k", F.coalesce(F.sum("__bn").over(Window.orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)),
                          F.lit(0.0)).alias("__off"))
    inside = Window.partitionBy("__k").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    d = (d.withColumn("__in", F.coalesce(F.sum("__neg").over(inside), F.lit(0.0)))
         .join(F.broadcast(offsets), "__k"))
    # NULL when one class is missing
    return d.agg((F.sum(F.col("__pos") * (F.col("__off") + F.col("__in") + F.lit(0.5) * F.col("__neg")))
                  ).alias("__a"), (F.sum("__pos") * F.sum("__neg")).alias("__pn")).select(
        F.try_divide("__a", "__pn").alias("roc_auc"))


def evaluate(pred: DataFrame, label: str = "fuga_combinada_1m", prob: str = PROB, prediction: str = PRED) -> DataFrame:
    """M7. precision, recall, accuracy, f1_score, log_loss, roc_auc of a binary classifier (positive class 1). ``pred`` is read once."""
    # the rows of one label, prediction and score are alike: they are counted once, and everything else reads the counts
    alike = stored(pred.groupBy(label, prediction, F.col(prob).cast("double").alias(prob)).agg(F.count(F.lit(1)).alias("__n")), "evaluation")
    y, yhat, n = F.col(label) == 1, F.col(prediction) == 1, F.col("__n")
    p = F.least(F.greatest(F.col(prob), F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    loss = -F.when(y, F.log(p)).otherwise(F.log(1 - p))

    def rows_with(cond: Column) -> Column:
        return F.sum(F.when(cond, n).otherwise(0)).cast("long")

    counts = alike.agg(
        rows_with(y & yhat).alias("tp"), rows_with(~y & yhat).alias("fp"), rows_with(y & ~yhat).alias("fn"), rows_with(~y & ~yhat).alias("tn"),
        F.try_divide(F.sum(n * loss), F.sum(F.when(loss.isNotNull(), n))).alias("log_loss"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    return (counts.crossJoin(roc_auc(alike, label, prob, times="__n"))
            .select(precision.alias("precision"), recall.alias("recall"),
                    F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                    F.try_divide(2 * precision * recall, precision + recall).alias("f1_score"),
                    "log_loss", "roc_auc"))


# ------------------------------------------------------------------------------------------- M8-M12: predictions
def churn_predictions(scored: DataFrame, prob: Column | str, prediction: Column | str) -> DataFrame:
    """M8 output shape + M9 band: keys, four features, prediction, probability, risk band."""
    prob = F.col(prob) if isinstance(prob, str) else prob
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    return scored.select("cliente_id", "fecha_referencia", "dias_desde_ultima_compra", "num_compras_6m",
                         "valor_compras_6m", "engagement_score",
                         prediction.cast("long").alias(PRED), prob.cast("double").alias(PROB),
                         LB.risk_band(prob).alias(BAND))


def prediction_summary(p: DataFrame) -> DataFrame:
    """M10 (also the churn split and clients-per-band datasets of the model dashboard)."""
    churn = F.col(PRED) == 1
    return p.agg(
        F.lit("RESUMEN DE PREDICCIONES").alias("seccion"),
        F.count(F.lit(1)).alias("total_clientes_evaluados"),
        bool_count(churn).alias("predichos_churn"),
        r(F.avg(F.when(churn, 1).otherwise(0)) * 100, 2).alias("tasa_churn_predicha_pct"),
        r(F.avg(PROB) * 100, 2).alias("probabilidad_churn_promedio_pct"),
        *[bool_count(F.col(BAND) == b).alias(a) for b, a in [
            ("MUY_ALTO", "clientes_muy_alto_riesgo"), ("ALTO", "clientes_alto_riesgo"),
            ("MEDIO", "clientes_medio_riesgo"), ("BAJO", "clientes_bajo_riesgo"),
            ("MUY_BAJO", "clientes_muy_bajo_riesgo")]])


def top_risk_clients(p: DataFrame, n: int = 20) -> DataFrame:
    """M11. Predicted churners with the highest probability (ties by client id)."""
    return (p.where(F.col(PRED) == 1)
            .orderBy(F.desc(PROB), "cliente_id").limit(n)
            .select("cliente_id", r(F.col(PROB) * 100, 2).alias("prob_churn_pct"), BAND,
                    "dias_desde_ultima_compra", "num_compras_6m", r("valor_compras_6m", 2).alias("valor_6m"),
                    r("engagement_score", 2).alias("engagement")))


def high_value_at_risk(p: DataFrame, min_value: float = 1000.0, n: int = 50,
                       bands: tuple[str, ...] = ("MUY_ALTO", "ALTO")) -> DataFrame:
    """M12. Predicted churners in the top bands with more than ``min_value`` spent in 6 months, by spend."""
    return (p.where((F.col(PRED) == 1) & F.col(BAND).isin(*bands) & (F.col("valor_compras_6m") > min_value))
            .orderBy(F.desc("valor_compras_6m"), "cliente_id").limit(n)
            .select("cliente_id", r(F.col(PROB) * 100, 2).alias("prob_churn_pct"),
                    r("valor_compras_6m", 2).alias("valor_6m"), "num_compras_6m", "dias_desde_ultima_compra"))


def probability_histogram(p: DataFrame, bins: int = 10) -> DataFrame:
    """P8. Clients per probability decile (the last bin includes 1.0)."""
    b = F.least(F.floor(F.col(PROB) * bins), F.lit(bins - 1)).cast("int")
    return (p.where(F.col(PROB).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("num_clientes"))
            .select("bin", (F.col("bin") / F.lit(float(bins))).alias("prob_desde"),
                    ((F.col("bin") + 1) / F.lit(float(bins))).alias("prob_hasta"), "num_clientes")
            .orderBy("bin"))


# ------------------------------------------------------------------------------------------- M16-M19: metrics
METRIC_COLUMNS = ["precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc"]


def metrics_record(evaluation: DataFrame, model_id: str, evaluated_at: str | None = None) -> DataFrame:
    """M16. One metrics row with model id and evaluation time (``store_metrics`` adds it to the metrics table, which keeps the history that
    the reference queries it for)."""
    ts = F.current_timestamp() if evaluated_at is None else F.lit(evaluated_at).cast("timestamp")
    return evaluation.select(F.lit(model_id).alias("modelo_id"), ts.alias("fecha_evaluacion"), *METRIC_COLUMNS)


def store_metrics(record: DataFrame, path: str, run_id: str) -> DataFrame:
    """M16. Adds one evaluation to the metrics table at ``path`` and returns the whole table, read back from storage.

    A run is a partition of its own that is replaced if it is written again, so a repeated or retried run counts once and the other
    runs' history stays.
    """
    spark = record.sparkSession
    replace_partitions(record.withColumn("ejecucion_id", F.lit(run_id)), path, ["ejecucion_id"])
    return spark.read.parquet(path)


def list_metrics(m: DataFrame) -> DataFrame:
    """M17. Stored metrics rounded to 4 places, newest first."""
    return (m.select("modelo_id", "fecha_evaluacion",
                     *[r(c, 4).alias(c) for c in ["roc_auc", "f1_score", "precision", "recall", "accuracy",
                                                  "log_loss"]])
            .orderBy(F.desc("fecha_evaluacion"), "modelo_id"))


def interpret_metrics(m: DataFrame) -> DataFrame:
    """M18. Text bands for the newest evaluation."""
    newest = m.orderBy(F.desc("fecha_evaluacion"), "modelo_id").limit(1)
    return newest.select(
        F.lit("INTERPRETACIÓN DE MÉTRICAS").alias("seccion"),
        LB.banded("roc_auc", LB.METRIC_BANDS_AUC, LB.METRIC_DEFAULT_AUC).alias("evaluacion_roc_auc"),
        LB.banded("f1_score", LB.METRIC_BANDS, LB.METRIC_DEFAULT).alias("evaluacion_f1_score"),
        LB.banded("precision", LB.METRIC_BANDS, LB.METRIC_DEFAULT).alias("evaluacion_precision"),
        LB.banded("recall", LB.METRIC_BANDS, LB.METRIC_DEFAULT).alias("evaluacion_recall"))


def model_info(registry: DataFrame, model_name: str) -> DataFrame:
    """M19. Model type, creation time, location, number of training runs, features of the first run: one row per model.

    The registry is appended to at every training; a model's rows are gathered, their runs in order of time (bounded by
    the number of trainings), and type, creation time and location are those of its first row.
    """
    rows = registry.where(F.col("model_name") == model_name)
    first = F.min_by(F.struct("model_type", "creation_time", "location"), "creation_time").alias("first")
    runs = F.array_sort(F.flatten(F.collect_list("run"))).alias("runs")
    run = F.transform("training_run", lambda x: F.struct(x["start_time"].alias("start_time"), x["input_feature_columns"].alias("features")))
    return (rows.withColumn("run", run).groupBy("model_name").agg(first, runs)
            .select("first.*", F.size("runs").alias("num_training_runs"), F.element_at("runs", 1)["features"].alias("features_usadas")))


# ------------------------------------------------------------------------------------- M13a, M14: importance
def importance_ranking(fi: DataFrame) -> DataFrame:
    """M13 ranking columns: global RANK by weight and by gain (one row per feature, a bounded table)."""
    return (fi.withColumn("ranking_weight", F.rank().over(Window.orderBy(F.desc("importance_weight"))))
            .withColumn("ranking_gain", F.rank().over(Window.orderBy(F.desc("importance_gain"))))
            .orderBy(F.desc("importance_weight"), "feature"))


def top_features(fi: DataFrame, n: int = 10) -> DataFrame:
    """M13a. Top features by weight with a plain-language reading."""
    return (fi.orderBy(F.desc("importance_weight"), "feature").limit(n)
            .select("feature", r("importance_weight", 2).alias("weight"), r("importance_gain", 2).alias("gain"),
                    LB.feature_interpretation("feature").alias("interpretacion")))


def importance_by_category(fi: DataFrame) -> DataFrame:
    """M14. Importance summed per feature category, with each category's share of the total weight."""
    g = (fi.withColumn("categoria", LB.feature_category("feature"))
         .groupBy("categoria")
         .agg(F.count(F.lit(1)).alias("num_features"),
              F.sum("importance_weight").alias("__w"),
              r(F.sum("importance_gain"), 2).alias("gain_total"),
              r(F.avg("importance_weight"), 2).alias("weight_promedio")))
    total = g.agg(F.sum("__w").alias("__t"))
    return (g.crossJoin(F.broadcast(total))
            .select("categoria", "num_features", r("__w", 2).alias("weight_total"), "gain_total", "weight_promedio",
                    pct(F.col("__w"), F.col("__t"), 2).alias("pct_weight_total"))
            .orderBy(F.desc("weight_total"), "categoria"))


# --------------------------------------------------------------------------------------------- M23: segments
def profile_segments(s: DataFrame) -> DataFrame:
    """M23. Per cluster: size, share, four rounded averages and a name from RANKs of the unrounded averages.

    After the group-by there is one row per cluster (k rows), so the unpartitioned rank windows are bounded by k.
    """
    g = s.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("num_clientes"),
        F.avg("dias_desde_ultima_compra").alias("__d"), F.avg("num_compras_6m").alias("__n"),
        money_avg("valor_compras_6m").alias("__v"), F.avg("engagement_score").alias("__e"))
    g = share_of_total(g, "num_clientes", "porcentaje")
    name = (F.when(F.rank().over(Window.orderBy(F.desc("__e"))) == 1, LB.SEGMENT_TOP_ENGAGEMENT)
            .when(F.rank().over(Window.orderBy(F.desc("__d"))) == 1, LB.SEGMENT_TOP_RECENCY_DAYS)
            .when(F.rank().over(Window.orderBy(F.desc("__n"))).between(2, 3), LB.SEGMENT_FREQUENT)
            .otherwise(LB.SEGMENT_OTHER))
    return (g.select("cluster_id", "num_clientes", "porcentaje",
                     r("__d", 1).alias("dias_ultima_compra_avg"), r("__n", 2).alias("compras_6m_avg"),
                     r("__v", 2).alias("valor_6m_avg"), r("__e", 2).alias("engagement_avg"),
                     name.alias("nombre_segmento"))
            .orderBy(F.desc("engagement_avg"), "cluster_id"))


def segment_value(s: DataFrame, profiles: DataFrame, recovery_rate: float = 0.2) -> DataFrame:
    """P11. Six-month value per segment, its share of the total, and the value won back if ``recovery_rate`` of it
    were recovered (the dashboard quotes 20% for the at-risk segment)."""
    g = s.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("num_clientes"),
                                    money_sum("valor_compras_6m").alias("valor_total_6m"))
    total = g.agg(F.sum("valor_total_6m").alias("__t"))
    names = profiles.select("cluster_id", "nombre_segmento")
    return (g.crossJoin(F.broadcast(total)).join(F.broadcast(names), "cluster_id", "left")
            .select("cluster_id", "nombre_segmento", "num_clientes", r("valor_total_6m", 2).alias("valor_total_6m"),
                    pct(F.col("valor_total_6m"), F.col("__t"), 2).alias("pct_valor_total"),
                    r(F.col("valor_total_6m") * F.lit(recovery_rate), 2).alias("valor_recuperable"))
            .orderBy(F.desc("valor_total_6m"), "cluster_id"))


# ------------------------------------------------------------------------------------------- P1-P6, P10: sales
def sales_kpis(t: DataFrame) -> DataFrame:
    """P1. Sales, purchases, clients and mean ticket."""
    return t.agg(r(money_sum("importe_neto"), 2).alias("ventas_totales"),
                 F.count(F.lit(1)).alias("num_transacciones"),
                 F.countDistinct("cliente_id").alias("num_clientes"),
                 r(money_sum("importe_neto") / F.count("importe_neto"), 2).alias("ticket_medio"))


def clients_by_profile(c: DataFrame) -> DataFrame:
    """P3."""
    g = c.groupBy("perfil").agg(F.count(F.lit(1)).alias("num_clientes"))
    return share_of_total(g, "num_clientes", "porcentaje").orderBy(F.desc("num_clientes"), "perfil")


def sales_by_quarter(t: DataFrame) -> DataFrame:
    """P4."""
    return (t.groupBy("anio", "trimestre")
            .agg(F.count(F.lit(1)).alias("num_transacciones"), r(money_sum("importe_neto"), 2).alias("ventas_totales"))
            .orderBy("anio", "trimestre"))


def sales_by_channel(t: DataFrame) -> DataFrame:
    """P5."""
    g = t.groupBy("canal").agg(F.count(F.lit(1)).alias("num_transacciones"),
                               money_sum("importe_neto").alias("ventas_totales"))
    total = g.agg(F.sum("ventas_totales").alias("__t"))
    return (g.crossJoin(F.broadcast(total))
            .select("canal", "num_transacciones", r("ventas_totales", 2).alias("ventas_totales"),
                    pct(F.col("ventas_totales"), F.col("__t"), 2).alias("porcentaje_ventas"))
            .orderBy(F.desc("ventas_totales"), "canal"))


def top_months(monthly: DataFrame, n: int = 10) -> DataFrame:
    """P6. Best months by sales (input: ``monthly_sales``)."""
    return monthly.orderBy(F.desc("ventas_totales"), "anio", "mes").limit(n)


# FIXED VALUES: inactivity alert bands of the dashboard recommendation (days without buying).
INACTIVITY_BANDS = [(60, 90, "60-90 dias"), (91, None, "mas de 90 dias")]


def inactivity_alert(gold: DataFrame) -> DataFrame:
    """P10. Clients 60-90 days and more than 90 days without buying, on the latest complete month."""
    d = F.col("dias_desde_ultima_compra")
    band = F.when(d.between(60, 90), INACTIVITY_BANDS[0][2]).when(d > 90, INACTIVITY_BANDS[1][2])
    return (gold.where(F.col("fecha_referencia") == previous_month(gold))
            .withColumn("alerta", band).where(F.col("alerta").isNotNull())
            .select("cliente_id", "fecha_referencia", "alerta", "dias_desde_ultima_compra", "num_compras_6m",
                    "valor_compras_6m", "engagement_score"))


def feature_profile_importance(training: DataFrame, features: list[str]) -> DataFrame:
    """A data-derived, model-free importance table with the layout of ``models.feature_importance``:
    weight = rows where the feature is non-zero, gain = mean value, cover = mean absolute value.

    One distributed aggregate (one output row), unpivoted to one row per feature with ``stack``.
    """
    aggs = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggs += [F.count(F.when(x != 0, 1)).cast("double").alias(f"w{i}"), F.avg(x).alias(f"g{i}"),
                 F.avg(F.abs(x)).alias(f"c{i}")]
    wide = training.agg(*aggs)
    pairs = ", ".join(f"'{f}', w{i}, g{i}, c{i}" for i, f in enumerate(features))
    return wide.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, importance_weight, importance_gain, "
                           f"importance_cover)")
