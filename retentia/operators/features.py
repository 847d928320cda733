"""Model inputs derived from the gold panel.

The month bounds are scalar subqueries (``DataFrame.scalar()``), so when gold is stored partitioned by month the bound
reaches the scan as a partition filter instead of joining the whole table against a one-row aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.operators.gold import latest_month, previous_month

# FIXED VALUES: model inputs in the reference's order, the inactivity cut, the return-rate flag and the
# frequency bucket bounds.
CHURN_FEATURES = [
    "dias_desde_ultima_compra", "num_compras_3m", "num_compras_6m", "valor_compras_3m", "valor_compras_6m",
    "ticket_promedio_6m", "tendencia_valor_6m", "coef_variacion_valor_6m", "engagement_score",
    "ratio_actividad_reciente", "tasa_devolucion_mes", "mes_del_anio", "trimestre", "meses_desde_primera_compra",
    "promedio_descuento_mes", "log_dias_ultima_compra", "log_valor_compras", "categoria_frecuencia", "inactivo_3m",
    "sin_compras_6m", "sin_gasto_6m", "alta_devolucion",
]
CLUSTER_FEATURES = [
    "dias_desde_ultima_compra", "num_compras_6m", "valor_compras_6m", "ticket_promedio_6m", "engagement_score",
    "tendencia_valor_6m", "coef_variacion_valor_6m", "ratio_actividad_reciente", "meses_desde_primera_compra",
]
LABEL = "fuga_combinada_1m"
MAX_RECENCY_DAYS = 730
INACTIVE_DAYS = 90
HIGH_RETURN_RATE = 0.2
DEFAULT_RECENCY_DAYS = 365


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0).cast("long")


def model_features(gold: DataFrame) -> DataFrame:
    """M1. Keys + the 22 model inputs (one definition shared by training and scoring)."""
    g = F.col
    zero = F.lit(0)
    n6 = g("num_compras_6m")
    return gold.select(
        "cliente_id", "fecha_referencia",
        F.coalesce(g("dias_desde_ultima_compra"), F.lit(DEFAULT_RECENCY_DAYS).cast("long"))
         .alias("dias_desde_ultima_compra"),
        F.coalesce(g("num_compras_3m"), zero.cast("long")).alias("num_compras_3m"),
        F.coalesce(n6, zero.cast("long")).alias("num_compras_6m"),
        *[F.coalesce(g(c), F.lit(0.0)).alias(c) for c in [
            "valor_compras_3m", "valor_compras_6m", "ticket_promedio_6m", "tendencia_valor_6m",
            "coef_variacion_valor_6m", "engagement_score", "ratio_actividad_reciente", "tasa_devolucion_mes"]],
        "mes_del_anio", "trimestre",
        F.coalesce(g("meses_desde_primera_compra"), zero.cast("long")).alias("meses_desde_primera_compra"),
        F.coalesce(g("promedio_descuento_mes"), F.lit(0.0)).alias("promedio_descuento_mes"),
        F.log(F.greatest(g("dias_desde_ultima_compra").cast("double"), F.lit(1.0))).alias("log_dias_ultima_compra"),
        F.log(F.greatest(g("valor_compras_6m"), F.lit(1.0))).alias("log_valor_compras"),
        F.when(n6 == 0, 0).when(n6 <= 2, 1).when(n6 <= 5, 2).otherwise(3).cast("long").alias("categoria_frecuencia"),
        _flag(g("dias_desde_ultima_compra") > INACTIVE_DAYS).alias("inactivo_3m"),
        _flag(n6 == 0).alias("sin_compras_6m"),
        _flag(g("valor_compras_6m") == 0).alias("sin_gasto_6m"),
        _flag(g("tasa_devolucion_mes") > HIGH_RETURN_RATE).alias("alta_devolucion"),
        *([LABEL] if LABEL in gold.columns else []),
    )


def training_set(gold: DataFrame, max_recency: int = MAX_RECENCY_DAYS) -> DataFrame:
    """M2. Every month but the last (no target there), clients seen within ``max_recency`` days."""
    g = gold.where((F.col("fecha_referencia") < latest_month(gold))
                   & (F.col("dias_desde_ultima_compra") <= max_recency))
    return model_features(g)


def scoring_set(gold: DataFrame, max_recency: int = MAX_RECENCY_DAYS) -> DataFrame:
    """M3. The second-latest month (the latest one with a complete following month), without the target."""
    g = gold.where((F.col("fecha_referencia") == previous_month(gold))
                   & (F.col("dias_desde_ultima_compra") <= max_recency))
    return model_features(g).drop(LABEL)


def clustering_set(gold: DataFrame, max_recency: int = MAX_RECENCY_DAYS) -> DataFrame:
    """M20. Nine behaviour features on the second-latest month; NULLs are kept (imputed by the model pipeline)."""
    return (gold.where((F.col("fecha_referencia") == previous_month(gold))
                       & (F.col("dias_desde_ultima_compra") <= max_recency))
            .select("cliente_id", *CLUSTER_FEATURES))


def split_train_eval(df: DataFrame, eval_fraction: float = 0.2, seed: int = 42,
                     keys: tuple[str, ...] = ("cliente_id", "fecha_referencia"), out: str = "is_eval",
                     portable: bool = False) -> DataFrame:
    """M4. Random row split by a hash of the row key: stable across recomputation and executor loss (unlike
    ``rand``), and like the reference a client's months may fall on both sides.

    ``portable`` takes the first 32 bits of an MD5 digest, which other engines can compute too, instead of XXH64."""
    if not portable:
        h = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(1_000_000))
        return df.withColumn(out, h < F.lit(int(round(eval_fraction * 1_000_000))))
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.withColumn(out, h < F.lit(int(round(eval_fraction * 2 ** 32))))


def class_weights(df: DataFrame, label: str = LABEL, out: str = "class_weight") -> DataFrame:
    """M5. Inverse-frequency weights ``n / (k * n_class)``; the per-class table has k rows and is broadcast."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    totals = counts.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    w = (counts.crossJoin(totals)
         .select(label, (F.col("__n").cast("double") / (F.col("__k") * F.col("__nc"))).alias(out)))
    return df.join(F.broadcast(w), label, "left")
