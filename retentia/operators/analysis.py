"""Exploratory analysis over the gold panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.functions.labels import month_name, rfm_label
from retentia.functions.numeric import money_avg, money_sum
from retentia.functions.numeric import round_half_up as r
from retentia.operators.gold import before_latest, previous_month
from retentia.operators.ntile import global_ntiles


def churn_by_profile(gold: DataFrame, clientes: DataFrame) -> DataFrame:
    """A1. Gold joined to the client profile; all months but the last.

    The panel is first reduced to one row per client (counts and sums, with map-side combine), so the join with the
    client table moves one row per client instead of one per client and month; the profile averages are then
    recombined as sums over counts, which is the same average.
    """
    per_client = before_latest(gold).groupBy("cliente_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("fuga_combinada_1m").alias("s_fuga"),
        F.sum("dias_desde_ultima_compra").alias("s_dias"),
        F.sum("num_compras_6m").alias("s_n6"),
        money_sum("valor_compras_6m").alias("s_v6"),
        F.sum("engagement_score").alias("s_eng"))
    c = clientes.select("cliente_id", "perfil")
    n = F.sum("n").cast("double")
    return (per_client.join(c, "cliente_id")
            .groupBy("perfil")
            .agg(F.sum("n").alias("total_registros"),
                 F.sum("s_fuga").cast("long").alias("casos_churn"),
                 r(F.sum("s_fuga") / n * 100, 2).alias("tasa_churn_pct"),
                 r(F.sum("s_dias") / n, 1).alias("dias_ultima_compra_avg"),
                 r(F.sum("s_n6") / n, 2).alias("compras_6m_avg"),
                 r(money_sum("s_v6") / n, 2).alias("valor_6m_avg"),
                 r(F.sum("s_eng") / n, 2).alias("engagement_avg"))
            .orderBy(F.desc("tasa_churn_pct"), "perfil"))


def churn_over_time(gold: DataFrame) -> DataFrame:
    """A2. Monthly churn series (all months but the last)."""
    return (before_latest(gold)
            .groupBy("fecha_referencia")
            .agg(F.count("cliente_id").alias("clientes_activos"),
                 F.sum("fuga_combinada_1m").cast("long").alias("casos_churn"),
                 r(F.avg("fuga_combinada_1m") * 100, 2).alias("tasa_churn_pct"),
                 r(money_avg("valor_compras_6m"), 2).alias("valor_promedio_6m"),
                 r(F.avg("engagement_score"), 2).alias("engagement_promedio"))
            .orderBy("fecha_referencia"))


def rfm_scores(gold: DataFrame, high_is_good: bool = False) -> DataFrame:
    """Quintile scores on the second-latest month. The reference's directions are kept by default: ascending days
    (score 1 = most recent), descending counts and values (score 1 = most frequent / highest). ``high_is_good`` flips
    them to the conventional reading. Ties are broken by client id."""
    snap = gold.where(F.col("fecha_referencia") == previous_month(gold)).select(
        "cliente_id", "dias_desde_ultima_compra", "num_compras_6m", "valor_compras_6m", "fuga_combinada_1m")
    asc = not high_is_good
    orders = {"recency_score": ("dias_desde_ultima_compra", asc), "frequency_score": ("num_compras_6m", not asc), "monetary_score": ("valor_compras_6m", not asc)}
    return global_ntiles(snap, 5, orders, "cliente_id")


def rfm_segments(gold: DataFrame, min_size: int = 10, n: int = 20, high_is_good: bool = False) -> DataFrame:
    """A3. Clients per (R, F, M) score triple with at least ``min_size`` members, labelled, largest first."""
    scores = rfm_scores(gold, high_is_good)
    return (scores.groupBy("recency_score", "frequency_score", "monetary_score")
            .agg(F.count(F.lit(1)).alias("num_clientes"),
                 r(F.avg("fuga_combinada_1m") * 100, 2).alias("tasa_churn_pct"))
            .where(F.col("num_clientes") >= min_size)
            .withColumn("segmento_rfm", rfm_label("recency_score", "frequency_score", "monetary_score"))
            .orderBy(F.desc("num_clientes"), "recency_score", "frequency_score", "monetary_score")
            .limit(n))


def churn_vs_retained(gold: DataFrame) -> DataFrame:
    """A4."""
    return (before_latest(gold)
            .withColumn("tipo", F.when(F.col("fuga_combinada_1m") == 1, "Churn").otherwise("No Churn"))
            .groupBy("tipo")
            .agg(F.count(F.lit(1)).alias("num_casos"),
                 r(F.avg("dias_desde_ultima_compra"), 1).alias("dias_ultima_compra"),
                 r(F.avg("num_compras_6m"), 2).alias("compras_6m"),
                 r(money_avg("valor_compras_6m"), 2).alias("valor_6m"),
                 r(F.avg("engagement_score"), 2).alias("engagement"),
                 r(money_avg("tendencia_valor_6m"), 2).alias("tendencia_valor"),
                 r(F.avg("coef_variacion_valor_6m"), 2).alias("coef_variacion"),
                 r(F.avg("ratio_actividad_reciente"), 2).alias("ratio_actividad"),
                 r(F.avg("tasa_devolucion_mes") * 100, 2).alias("tasa_devolucion_pct"))
            .orderBy("tipo"))


def seasonality(gold: DataFrame) -> DataFrame:
    """A5."""
    return (before_latest(gold)
            .withColumn("nombre_mes", month_name("mes_del_anio"))
            .groupBy("trimestre", "mes_del_anio", "nombre_mes")
            .agg(F.count(F.lit(1)).alias("total_registros"),
                 r(F.avg("fuga_combinada_1m") * 100, 2).alias("tasa_churn_pct"),
                 r(F.avg("num_compras_6m"), 2).alias("compras_6m_avg"),
                 r(money_avg("valor_compras_6m"), 2).alias("valor_6m_avg"))
            .orderBy("trimestre", "mes_del_anio"))


CORRELATED_FEATURES = [
    ("dias_desde_ultima_compra", "corr_dias_ultima_compra"),
    ("num_compras_6m", "corr_compras_6m"),
    ("valor_compras_6m", "corr_valor_6m"),
    ("engagement_score", "corr_engagement"),
    ("tendencia_valor_6m", "corr_tendencia"),
    ("coef_variacion_valor_6m", "corr_variacion"),
    ("tasa_devolucion_mes", "corr_devolucion"),
]


def churn_correlations(gold: DataFrame) -> DataFrame:
    """M15. Pearson correlation of seven features with the target (pairs with a NULL are skipped per pair)."""
    return before_latest(gold).agg(
        F.lit("ANÁLISIS DE CORRELACIÓN CON CHURN").alias("seccion"),
        *[F.corr(F.col(c).cast("double"), F.col("fuga_combinada_1m").cast("double")).alias(a)
          for c, a in CORRELATED_FEATURES])
