"""Gold layer: the client x month feature panel.

The reference computes each rolling feature with a correlated subquery per (client, month) row. Here the whole panel is
one pass of window functions:

1. Purchases and returns are first reduced to one row per (client, month) with partial aggregation, i.e. map-side
   combine before the shuffle. A client holding a large share of all purchases therefore contributes at most one row
   per month and map task, and after this step every client has at most one purchase row and one return row per
   month.
2. The spine (every active client x every month that has a purchase) is a cross join with the month calendar, which is
   bounded by the number of distinct months (12 per year) and broadcast.
3. Spine, purchase-month and return-month rows are unioned and windowed once, partitioned by client and ordered by a
   month index. "Date in [m - k months, m)" equals "month index in [i - k, i - 1]", so every subquery becomes an
   integer ``rangeBetween`` frame; the two left joins of the current-month metrics become the frame (0, 0) and the
   NOT EXISTS target becomes the frame (1, 1). A window partition holds at most 3 x months rows, whatever the
   client's purchase volume.

The rolling sample standard deviation is combined from per-month (count, sum, squared deviations) with a per-client
shift, which keeps it numerically stable without keeping raw purchases in the window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.functions.dates import month_index, month_start
from retentia.operators.common import stored
from retentia.operators.joins import asof_join, range_join

# FIXED VALUE: the reference's fallback date for clients with no purchase before the month (a parameter here).
REFERENCE_SENTINEL = "2020-01-01"

#: Panel rows that one task sorts in memory, for the windows and again for a write by month.
PANEL_ROWS_PER_TASK = 1_250_000
#: Panels from this many rows on have a number of partitions of their own and are written where they are.
LARGE_PANEL_ROWS = 15_000_000

GOLD_COLUMNS = [
    "cliente_id", "fecha_referencia",
    "dias_desde_ultima_compra", "num_compras_3m", "num_compras_6m", "valor_compras_3m", "valor_compras_6m",
    "ticket_promedio_6m", "tendencia_valor_6m", "coef_variacion_valor_6m",
    "num_compras_mes", "valor_compras_mes", "ticket_promedio_mes", "promedio_descuento_mes",
    "num_devoluciones_mes", "importe_devuelto_mes", "tasa_devolucion_mes", "engagement_score",
    "ratio_actividad_reciente", "mes_del_anio", "trimestre", "meses_desde_primera_compra", "fuga_combinada_1m",
]


# ---------------------------------------------------------------------------------------------------- G1, G2, G3
def months_calendar(transacciones: DataFrame) -> DataFrame:
    """G1. Month starts that have at least one purchase (not a dense calendar)."""
    return (transacciones.select(F.trunc("fecha_transaccion", "MM").alias("fecha_referencia"))
            .where(F.col("fecha_referencia").isNotNull()).distinct())


def active_clients(transacciones: DataFrame) -> DataFrame:
    """G2. Clients with at least one purchase (with a date, as everywhere in gold)."""
    return transacciones.where(F.col("fecha_transaccion").isNotNull()).select("cliente_id").distinct()


def client_month_spine(transacciones: DataFrame) -> DataFrame:
    """G3. Every active client x every calendar month. The calendar holds at most 12 rows per year of data."""
    return active_clients(transacciones).crossJoin(F.broadcast(months_calendar(transacciones)))


# ---------------------------------------------------------------------------------------------------------- G4, G5
def client_month_purchases(transacciones: DataFrame) -> DataFrame:
    """One row per client and month (``mi``, see ``month_index``) with a purchase: what G4 and the panel are made of."""
    t = transacciones.where(F.col("fecha_transaccion").isNotNull())
    return (t.groupBy("cliente_id", month_index("fecha_transaccion").alias("mi"))
            .agg(F.count(F.lit(1)).alias("p_n"),
                 F.sum("importe_neto").alias("p_s"),
                 # population variance * n = squared deviations from the month mean (stable central moments)
                 (F.var_pop("importe_neto") * F.count("importe_neto")).alias("p_m2"),
                 F.sum("porcentaje_descuento").alias("p_dsum"),
                 F.count("porcentaje_descuento").alias("p_dn"),
                 F.max("fecha_transaccion").alias("p_last"),
                 F.min("fecha_transaccion").alias("p_first")))


def client_month_returns(devoluciones: DataFrame) -> DataFrame:
    """One row per client and month of the *return* date."""
    d = devoluciones.where(F.col("fecha_devolucion").isNotNull() & F.col("cliente_id").isNotNull())
    return (d.groupBy("cliente_id", month_index("fecha_devolucion").alias("mi"))
            .agg(F.count(F.lit(1)).alias("r_n"), F.sum("importe_devuelto").alias("r_s")))


def purchases_by_month(transacciones: DataFrame) -> DataFrame:
    """G4. Per client and month: count, sum, average, average discount %, last purchase date."""
    return client_month_purchases(transacciones).select(
        "cliente_id", month_start("mi").alias("fecha_referencia"), F.col("p_n").alias("num_compras_mes"), F.col("p_s").alias("valor_compras_mes"),
        (F.col("p_s") / F.col("p_n")).alias("ticket_promedio_mes"), F.try_divide("p_dsum", "p_dn").alias("promedio_descuento_mes"),
        F.col("p_last").alias("fecha_ultima_compra_mes"))


def returns_by_month(devoluciones: DataFrame) -> DataFrame:
    """G5. Per client and month of the *return* date: count and returned amount."""
    return client_month_returns(devoluciones).select("cliente_id", month_start("mi").alias("fecha_referencia"), F.col("r_n").alias("num_devoluciones_mes"),
                                                     F.col("r_s").alias("importe_devuelto_mes"))


# ------------------------------------------------------------------------------------------------------ the panel
def gold_features(transacciones: DataFrame, devoluciones: DataFrame,
                  sentinel_date: str = REFERENCE_SENTINEL, num_partitions: int | None = None) -> DataFrame:
    """The 23-column client x month panel (G6-G20 assembled).

    The monthly purchases are written to the shared folder first, so the purchases are scanned and aggregated once, whatever reads the
    monthly rows after (the panel, its clients and its calendar).
    """
    return gold_panel(stored(client_month_purchases(transacciones), "client-months"), client_month_returns(devoluciones), sentinel_date, num_partitions)


def panel_partitions(purchases: DataFrame) -> int | None:
    """The partitions of a large panel, in proportion to its rows (clients x months and the monthly rows); None for a small one.

    With a fixed number, the sorts of a growing panel would outgrow the memory of their tasks and spill.
    """
    size = purchases.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("cliente_id").alias("clients"), F.collect_set("mi").alias("months")).first()
    rows = size["n"] + size["clients"] * len(size["months"])
    return math.ceil(rows / PANEL_ROWS_PER_TASK) if rows >= LARGE_PANEL_ROWS else None


def gold_panel(purchases: DataFrame, returns: DataFrame, sentinel_date: str = REFERENCE_SENTINEL, num_partitions: int | None = None) -> DataFrame:
    """G21 from the monthly rows of ``client_month_purchases`` (stored: it is read four times) and ``client_month_returns``.

    ``sentinel_date`` replaces the last purchase date when a client has none before the month (the reference uses
    2020-01-01; pass a date earlier than the data, see SURVEY D5). Output is not globally sorted; use
    ``save_table(..., sort_within=[...])`` when writing.
    """
    # The monthly rows are small (at most one per client and month) and are hash-partitioned by client with one
    # partition count. The distinct clients are aggregated on that same client partitioning, the spine inherits it
    # through the broadcast cross join, and the union of the three keeps it, so the window needs no further exchange
    # and the spine rows (clients x months, the size of the output) are never shuffled.
    parts = num_partitions or panel_partitions(purchases) or int(purchases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pm = purchases.repartition(parts, "cliente_id")
    rm = returns.repartition(parts, "cliente_id")
    months = purchases.agg(F.collect_set("mi").alias("mi")).select(F.explode("mi").alias("mi"))  # at most 12 a year
    clients = pm.select("cliente_id").distinct()
    spine = clients.crossJoin(F.broadcast(months)).withColumn("is_spine", F.lit(True))

    rows = (spine.unionByName(pm, allowMissingColumns=True)
            .unionByName(rm, allowMissingColumns=True))

    by_client = Window.partitionBy("cliente_id")
    ordered = by_client.orderBy("mi")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    # Per-client shift for the rolling variance: the mean of the client's first purchase month.
    rows = rows.withColumn("shift", F.first(F.col("p_s") / F.col("p_n"), ignorenulls=True).over(everything))
    rows = rows.withColumn("p_q", F.col("p_m2") + F.col("p_n") * F.pow(F.col("p_s") / F.col("p_n") - F.col("shift"), 2))

    def frame(lo, hi):
        return ordered.rangeBetween(lo, hi)

    f3, f6, f6_4 = frame(-3, -1), frame(-6, -1), frame(-6, -4)
    cur, nxt, before = frame(0, 0), frame(1, 1), frame(Window.unboundedPreceding, -1)

    def zsum(c: str, w) -> Column:
        return F.coalesce(F.sum(c).over(w), F.lit(0))

    n3, n6 = zsum("p_n", f3).cast("long"), zsum("p_n", f6).cast("long")
    s3, s6 = F.sum("p_s").over(f3), F.sum("p_s").over(f6)
    q6 = F.sum("p_q").over(f6)
    s6_4 = F.sum("p_s").over(f6_4)
    ref = month_start("mi")

    panel = rows.select(
        "cliente_id", "mi", "is_spine", "shift",
        ref.alias("fecha_referencia"),
        F.datediff(ref, F.coalesce(F.max("p_last").over(before), F.lit(sentinel_date).cast("date")))
         .cast("long").alias("dias_desde_ultima_compra"),
        n3.alias("num_compras_3m"),
        n6.alias("num_compras_6m"),
        F.coalesce(s3, F.lit(0.0)).alias("valor_compras_3m"),
        F.coalesce(s6, F.lit(0.0)).alias("valor_compras_6m"),
        s6.alias("_s6"), q6.alias("_q6"),
        (F.coalesce(s3, F.lit(0.0)) - F.coalesce(s6_4, F.lit(0.0))).alias("tendencia_valor_6m"),
        zsum("p_n", cur).cast("long").alias("num_compras_mes"),
        F.coalesce(F.sum("p_s").over(cur), F.lit(0.0)).alias("valor_compras_mes"),
        F.sum("p_dsum").over(cur).alias("_dsum"), F.sum("p_dn").over(cur).alias("_dn"),
        zsum("r_n", cur).cast("long").alias("num_devoluciones_mes"),
        F.coalesce(F.sum("r_s").over(cur), F.lit(0.0)).alias("importe_devuelto_mes"),
        (F.col("mi") - month_index(F.min("p_first").over(everything))).cast("long")
         .alias("meses_desde_primera_compra"),
        F.when(zsum("p_n", nxt) == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("fuga_combinada_1m"),
    ).where(F.col("is_spine"))

    n6c, s6c = F.col("num_compras_6m"), F.col("_s6")
    mean6 = s6c / n6c
    var6 = (F.col("_q6") - F.pow(s6c - n6c * F.col("shift"), 2) / n6c) / (n6c - 1)
    std6 = F.when(n6c >= 2, F.sqrt(F.greatest(var6, F.lit(0.0))))
    v6, days = F.col("valor_compras_6m"), F.col("dias_desde_ultima_compra")
    vm, nm = F.col("valor_compras_mes"), F.col("num_compras_mes")

    return panel.select(
        "cliente_id", "fecha_referencia", "dias_desde_ultima_compra", "num_compras_3m", "num_compras_6m",
        "valor_compras_3m", "valor_compras_6m",
        F.when(n6c > 0, mean6).otherwise(F.lit(0.0)).alias("ticket_promedio_6m"),
        "tendencia_valor_6m",
        F.when((n6c > 0) & (mean6 > 0), std6 / mean6).otherwise(F.lit(0.0)).alias("coef_variacion_valor_6m"),
        "num_compras_mes", "valor_compras_mes",
        F.when(nm > 0, vm / nm).otherwise(F.lit(0.0)).alias("ticket_promedio_mes"),
        F.when(F.col("_dn") > 0, F.col("_dsum") / F.col("_dn")).otherwise(F.lit(0.0)).alias("promedio_descuento_mes"),
        "num_devoluciones_mes", "importe_devuelto_mes",
        F.when(vm > 0, F.col("importe_devuelto_mes") / vm).otherwise(F.lit(0.0)).alias("tasa_devolucion_mes"),
        F.when((n6c > 0) & (v6 > 0),
               n6c * F.lit(0.4) + F.log10(v6 + F.lit(1.0)) * F.lit(0.3)
               + (F.lit(365.0) / F.greatest(days, F.lit(1))) * F.lit(0.3)).otherwise(F.lit(0.0))
         .alias("engagement_score"),
        F.when(n6c > 0, F.col("num_compras_3m").cast("double") / n6c).otherwise(F.lit(0.0))
         .alias("ratio_actividad_reciente"),
        F.month("fecha_referencia").alias("mes_del_anio"),
        F.quarter("fecha_referencia").alias("trimestre"),
        "meses_desde_primera_compra", "fuga_combinada_1m",
    )


def gold_summary(gold: DataFrame) -> DataFrame:
    """G22."""
    from retentia.functions.numeric import money_avg
    from retentia.functions.numeric import round_half_up as r
    return gold.agg(
        F.lit("RESUMEN GOLD LAYER").alias("seccion"),
        F.count(F.lit(1)).alias("total_filas"),
        F.countDistinct("cliente_id").alias("clientes_unicos"),
        F.countDistinct("fecha_referencia").alias("meses_unicos"),
        r(F.avg("dias_desde_ultima_compra"), 1).alias("avg_dias_ultima_compra"),
        r(F.avg("num_compras_6m"), 2).alias("avg_compras_6m"),
        r(money_avg("valor_compras_6m"), 2).alias("avg_valor_6m"),
        r(F.avg("engagement_score"), 2).alias("avg_engagement"),
        F.sum("fuga_combinada_1m").cast("long").alias("casos_churn"),
        r(F.avg("fuga_combinada_1m") * 100, 2).alias("tasa_churn_pct"))


# ------------------------------------------------------------- the same features by joins and subqueries
def rolling_purchases(spine: DataFrame, transacciones: DataFrame) -> DataFrame:
    """G7-G13 by a range join: each month's purchases of the six months before it, matched by client and time bin.

    ``spine``: cliente_id, fecha_referencia (unique). The panel gets these numbers from one window; this form doesn't need a month grid.
    """
    begin = F.add_months("fecha_referencia", -6)
    months = spine.select(F.col("cliente_id"), "fecha_referencia", begin.alias("desde"))
    bought = transacciones.select("cliente_id", "fecha_transaccion", "importe_neto")
    near = range_join(months, bought, ["cliente_id"], "desde", "fecha_referencia", "fecha_transaccion")
    recent = F.col("fecha_transaccion") >= F.add_months("fecha_referencia", -3)
    v = F.col("importe_neto")
    sums = near.groupBy("cliente_id", "fecha_referencia").agg(
        F.count_if(recent).alias("n3"), F.count(F.lit(1)).alias("n6"), F.sum(F.when(recent, v)).alias("v3"), F.sum(v).alias("v6"),
        F.sum(F.when(~recent, v)).alias("before"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"))
    rows = spine.select("cliente_id", "fecha_referencia").join(sums, ["cliente_id", "fecha_referencia"], "left")
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    return rows.select("cliente_id", "fecha_referencia", F.coalesce("n3", zero).alias("num_compras_3m"), F.coalesce("n6", zero).alias("num_compras_6m"),
                       F.coalesce("v3", none).alias("valor_compras_3m"), F.coalesce("v6", none).alias("valor_compras_6m"),
                       F.coalesce("mean", none).alias("ticket_promedio_6m"), (F.coalesce("v3", none) - F.coalesce("before", none)).alias("tendencia_valor_6m"),
                       F.when(F.col("mean") > 0, F.col("sd") / F.col("mean")).otherwise(none).alias("coef_variacion_valor_6m"))


def churn_target(spine: DataFrame, transacciones: DataFrame) -> DataFrame:
    """G20 as the reference states it: 1 where no purchase of the client exists in the month after.

    A correlated NOT EXISTS, which Spark turns into an anti join by itself; client and month are compared for equality, so a client with
    very many purchases is spread over its months.
    """
    bought = transacciones.where(F.col("fecha_transaccion").isNotNull()).select(
        F.col("cliente_id").alias("comprador"), F.trunc("fecha_transaccion", "MM").alias("mes_compra"))
    # outer names that the purchases don't have: Spark would take a purchase's own column, even one not selected, for the outer one
    keys = spine.select(F.col("cliente_id").alias("cliente_del_panel"), F.col("fecha_referencia").alias("mes_del_panel"))
    again = bought.where((F.col("comprador") == F.col("cliente_del_panel").outer())
                         & (F.col("mes_compra") == F.add_months(F.col("mes_del_panel").outer(), 1))).exists()
    gone = keys.where(~again).withColumn("fuga_combinada_1m", F.lit(1))
    rows = gone.unionByName(keys.where(again).withColumn("fuga_combinada_1m", F.lit(0)))
    return rows.withColumnsRenamed({"cliente_del_panel": "cliente_id", "mes_del_panel": "fecha_referencia"})


def returns_with_last_purchase(devoluciones: DataFrame, transacciones: DataFrame) -> DataFrame:
    """G6's lookup for days that are no month starts: each return with the client's latest purchase before the return date."""
    d = devoluciones.select("devolucion_id", "cliente_id", "fecha_devolucion")
    t = transacciones.select("cliente_id", F.col("transaccion_id").alias("ultima_transaccion"), F.col("fecha_transaccion").alias("fecha_ultima_compra"))
    found = asof_join(d, t, ["cliente_id"], "fecha_devolucion", "fecha_ultima_compra", ["ultima_transaccion", "fecha_ultima_compra"],
                      tie="ultima_transaccion", strict=True)
    return found.withColumn("dias_desde_ultima_compra", F.datediff("fecha_devolucion", "fecha_ultima_compra").cast("long"))


# ------------------------------------------------------------------------------------------ month-bound helpers
def latest_month(gold: DataFrame) -> Column:
    """``(SELECT MAX(fecha_referencia) FROM gold)`` as a scalar subquery column."""
    return gold.select(F.max("fecha_referencia")).scalar()


def previous_month(gold: DataFrame) -> Column:
    """The second-latest month: ``MAX(fecha_referencia) WHERE fecha_referencia < MAX(fecha_referencia)``."""
    return gold.where(F.col("fecha_referencia") < latest_month(gold)).select(F.max("fecha_referencia")).scalar()


def before_latest(gold: DataFrame) -> DataFrame:
    """Rows of every month but the last (whose target has no following month)."""
    return gold.where(F.col("fecha_referencia") < latest_month(gold))
