"""Label and banding expressions (ordered CASE chains as ``F.when`` columns).

All literal texts, thresholds and patterns that results must reproduce are gathered in the FIXED VALUES block below,
in the order the rules are evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's texts, thresholds and patterns for identical results)
# ---------------------------------------------------------------------------------------------------------------
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
               "November", "December"]

# Return type by share of the original purchase amount, checked top to bottom.
RETURN_TYPES = [(0.95, "Completa"), (0.50, "Parcial Alta")]
RETURN_TYPE_POSITIVE = "Parcial Baja"
RETURN_TYPE_NONE = "Sin Importe"
QUICK_RETURN_DAYS = 7

# Churn risk band by probability, checked top to bottom; anything else (including NULL) is the last band.
RISK_BANDS = [(0.8, "MUY_ALTO"), (0.6, "ALTO"), (0.4, "MEDIO"), (0.2, "BAJO")]
RISK_BAND_DEFAULT = "MUY_BAJO"

# RFM segment rules, checked top to bottom.
RFM_CHAMPIONS = "Champions"            # R >= 4 and F >= 4 and M >= 4
RFM_LOYAL = "Loyal Customers"          # R >= 4 and F >= 3
RFM_RECENT = "Recent Customers"        # R >= 4
RFM_BIG_SPENDERS = "Big Spenders"      # F >= 4 and M >= 4
RFM_AT_RISK = "At Risk"                # R <= 2 and F <= 2
RFM_ABOUT_TO_SLEEP = "About to Sleep"  # R <= 2
RFM_NEEDS_ATTENTION = "Needs Attention"

# k-means segment names by rank of the per-cluster averages, checked top to bottom.
SEGMENT_TOP_ENGAGEMENT = "VIP / Champions"          # rank 1 by average engagement (desc)
SEGMENT_TOP_RECENCY_DAYS = "En Riesgo / Hibernating"  # rank 1 by average days since purchase (desc)
SEGMENT_FREQUENT = "Activos / Loyal"                # rank 2..3 by average purchases in 6 months (desc)
SEGMENT_OTHER = "Ocasionales / Potencial"

# Feature reading for the top-features report: (LIKE pattern, text), first match wins.
FEATURE_INTERPRETATION = [
    ("%dias_desde_ultima_compra%", "Recency - Días sin comprar"),
    ("%num_compras%", "Frequency - Número de compras"),
    ("%valor_compras%", "Monetary - Valor gastado"),
    ("%engagement%", "Engagement - Compromiso del cliente"),
    ("%tendencia%", "Tendencia - Evolución del comportamiento"),
    ("%coef_variacion%", "Variabilidad - Estabilidad de compras"),
    ("%mes_del_anio%", "Temporal - Estacionalidad"),
    ("%descuento%", "Descuentos - Sensibilidad al precio"),
    ("%devolucion%", "Devoluciones - Satisfacción"),
]
FEATURE_INTERPRETATION_DEFAULT = "Otras métricas"

# Feature category for the importance-by-category report: (LIKE patterns joined by OR, category), first match wins.
# LIKE's "_" is a single-character wildcard, exactly as in the reference.
FEATURE_CATEGORIES = [
    (["%dias_desde_ultima_compra%"], "RFM - Recency"),
    (["%num_compras%"], "RFM - Frequency"),
    (["%valor_compras%", "%ticket%"], "RFM - Monetary"),
    (["%engagement%", "%ratio_actividad%"], "Engagement"),
    (["%tendencia%", "%coef_variacion%"], "Tendencias"),
    (["%mes%", "%trimestre%"], "Temporales"),
    (["%descuento%"], "Descuentos"),
    (["%devolucion%"], "Devoluciones"),
    (["%inactivo%", "%sin_%", "%alta_%"], "Flags"),
    (["%log_%", "%categoria_%"], "Transformadas"),
]
FEATURE_CATEGORY_DEFAULT = "Otras"

# Metric interpretation bands: (threshold, text), checked top to bottom, then the default text.
METRIC_BANDS_AUC = [(0.9, "Excelente (>0.90)"), (0.8, "Muy Bueno (0.80-0.90)"), (0.7, "Bueno (0.70-0.80)"),
                    (0.6, "Aceptable (0.60-0.70)")]
METRIC_DEFAULT_AUC = "Mejorable (<0.60)"
METRIC_BANDS = [(0.9, "Excelente (>0.90)"), (0.8, "Muy Bueno (0.80-0.90)"), (0.7, "Bueno (0.70-0.80)")]
METRIC_DEFAULT = "Mejorable (<0.70)"
# ---------------------------------------------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_name(month: Column | str) -> Column:
    """English month name for a month number 1..12 (NULL otherwise)."""
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), _c(month).cast("int"))


def banded(value: Column | str, bands: list[tuple[float, str]], default: str) -> Column:
    """``CASE WHEN v >= t1 THEN l1 WHEN v >= t2 THEN l2 ... ELSE default END``."""
    v = _c(value)
    expr = None
    for threshold, label in bands:
        expr = F.when(v >= threshold, label) if expr is None else expr.when(v >= threshold, label)
    return expr.otherwise(default)


def risk_band(prob: Column | str) -> Column:
    return banded(prob, RISK_BANDS, RISK_BAND_DEFAULT)


def return_type(returned: Column | str, original: Column | str) -> Column:
    """Return class by returned share. A NULL original amount falls through to the amount-only test."""
    r, o = _c(returned), _c(original)
    expr = None
    for share, label in RETURN_TYPES:
        cond = r >= o * F.lit(share)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when(r > 0, RETURN_TYPE_POSITIVE).otherwise(RETURN_TYPE_NONE)


def rfm_label(r: Column | str, f: Column | str, m: Column | str) -> Column:
    r, f, m = _c(r), _c(f), _c(m)
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), RFM_CHAMPIONS)
            .when((r >= 4) & (f >= 3), RFM_LOYAL)
            .when(r >= 4, RFM_RECENT)
            .when((f >= 4) & (m >= 4), RFM_BIG_SPENDERS)
            .when((r <= 2) & (f <= 2), RFM_AT_RISK)
            .when(r <= 2, RFM_ABOUT_TO_SLEEP)
            .otherwise(RFM_NEEDS_ATTENTION))


def _like_chain(feature: Column, rules: list[tuple[list[str], str]], default: str) -> Column:
    expr = None
    for patterns, label in rules:
        cond = None
        for p in patterns:
            cond = feature.like(p) if cond is None else (cond | feature.like(p))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def feature_category(feature: Column | str) -> Column:
    return _like_chain(_c(feature), FEATURE_CATEGORIES, FEATURE_CATEGORY_DEFAULT)


def feature_interpretation(feature: Column | str) -> Column:
    return _like_chain(_c(feature), [([p], t) for p, t in FEATURE_INTERPRETATION], FEATURE_INTERPRETATION_DEFAULT)
