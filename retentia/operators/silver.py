"""Silver layer: cleaning, enrichment and quality reports.

Joins carry no broadcast hint: the client and purchase tables grow with the data, so AQE decides at run time from
the real shuffle sizes (broadcast below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, sort-merge above), and its
skew-join splitting handles a client that owns a large share of the purchases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.dates import month_diff, parse_date
from retentia.functions.labels import QUICK_RETURN_DAYS, month_name, return_type
from retentia.functions.numeric import money_avg, money_sum, round_half_up, safe_div
from retentia.operators.common import bool_count, share_of_total

# FIXED VALUE: e-mail validity pattern, tested on the raw (untrimmed, mixed-case) e-mail.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# Java's "$" also matches before a final line break; "\z" keeps the whole-string meaning of the pattern.
_EMAIL_PATTERN_JAVA = EMAIL_PATTERN[:-1] + r"\z"


def _ts(processed_at: str | None) -> Column:
    return F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")


# --------------------------------------------------------------------------------------------------- clients
def silver_clientes(bronze: DataFrame, as_of: str | None = None, processed_at: str | None = None) -> DataFrame:
    """S1. ``as_of`` stands for CURRENT_DATE (a parameter, so results are reproducible)."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    first = parse_date("fecha_primera_compra")
    return (bronze
            .where(F.col("cliente_id").isNotNull() & F.col("email").isNotNull())
            .select("cliente_id",
                    F.trim(F.lower("email")).alias("email"),
                    F.trim("ciudad").alias("ciudad"),
                    F.trim("pais").alias("pais"),
                    parse_date("fecha_registro").alias("fecha_registro"),
                    first.alias("fecha_primera_compra"),
                    "perfil",
                    F.datediff(today, first).cast("long").alias("dias_desde_primera_compra"),
                    month_diff(today, first).alias("meses_desde_primera_compra"),
                    F.coalesce(F.col("email").rlike(_EMAIL_PATTERN_JAVA), F.lit(False)).alias("email_valido"),
                    F.col("fecha_primera_compra").isNotNull().alias("tiene_compras"),
                    _ts(processed_at).alias("fecha_procesamiento")))


def quality_clientes(silver: DataFrame) -> DataFrame:
    """S2."""
    def profile_count(p: str) -> Column:
        return F.count(F.when(F.col("perfil") == p, 1))

    return silver.agg(
        F.lit("CALIDAD DE DATOS - SILVER CLIENTES").alias("seccion"),
        F.count(F.lit(1)).alias("total_clientes"),
        F.countDistinct("cliente_id").alias("clientes_unicos"),
        bool_count(F.col("email_valido")).alias("emails_validos"),
        bool_count(F.col("tiene_compras")).alias("clientes_con_compras"),
        profile_count("VIP").alias("clientes_vip"),
        profile_count("Activo").alias("clientes_activos"),
        profile_count("Ocasional").alias("clientes_ocasionales"),
        profile_count("Churned").alias("clientes_churned"),
        round_half_up(F.avg("dias_desde_primera_compra"), 1).alias("promedio_dias_antiguedad"),
        round_half_up(F.avg("meses_desde_primera_compra"), 1).alias("promedio_meses_antiguedad"))


def top_cities(silver: DataFrame, n: int = 10) -> DataFrame:
    """S3. Ties on the count are broken by city name."""
    counts = silver.groupBy("ciudad").agg(F.count(F.lit(1)).alias("num_clientes"))
    return (share_of_total(counts, "num_clientes", "porcentaje")
            .orderBy(F.desc("num_clientes"), F.asc_nulls_first("ciudad"))
            .limit(n))


# ------------------------------------------------------------------------------------------------ purchases
def silver_transacciones(bronze: DataFrame, clientes: DataFrame, processed_at: str | None = None) -> DataFrame:
    """S4. Purchases enriched with the client's profile and city, calendar parts and season flags."""
    t = bronze.where(F.col("transaccion_id").isNotNull() & F.col("cliente_id").isNotNull()
                     & (F.col("importe_neto") >= 0))
    c = clientes.select("cliente_id", F.col("perfil").alias("perfil_cliente"),
                        F.col("ciudad").alias("ciudad_cliente"))
    d = parse_date("fecha_transaccion")
    month, day = F.month(d), F.dayofmonth(d)
    return (t.join(c, "cliente_id", "left")
            .select("transaccion_id", "cliente_id",
                    d.alias("fecha_transaccion"),
                    "producto", "categoria", "cantidad", "precio_unitario", "descuento", "importe_neto", "canal",
                    "metodo_pago", "perfil_cliente", "ciudad_cliente",
                    F.year(d).alias("anio"), month.alias("mes"), F.quarter(d).alias("trimestre"),
                    month_name(month).alias("nombre_mes"),
                    F.date_format(d, "EEEE").alias("dia_semana"),
                    round_half_up(safe_div(F.col("descuento"), F.col("precio_unitario") * F.col("cantidad"))
                                  * F.lit(100.0), 2).alias("porcentaje_descuento"),
                    (F.col("cantidad") * F.col("precio_unitario")).alias("importe_bruto"),
                    F.coalesce(F.col("descuento") > 0, F.lit(False)).alias("con_descuento"),
                    F.coalesce((month == 11) & day.between(20, 30), F.lit(False)).alias("es_black_friday"),
                    F.coalesce((month == 12) & day.between(1, 26), F.lit(False)).alias("es_navidad"),
                    F.coalesce(month.isin(1, 7), F.lit(False)).alias("es_rebajas"),
                    _ts(processed_at).alias("fecha_procesamiento")))


def quality_transacciones(silver: DataFrame, channels: tuple[str, str, str] = ("Web", "App", "Tienda")) -> DataFrame:
    """S5. Channel sums are conditional aggregates (a fixed-column pivot)."""
    def channel_sum(ch: str) -> Column:
        return money_sum(F.when(F.col("canal") == ch, F.col("importe_neto")).otherwise(F.lit(0.0)))

    web, app, store = channels
    return silver.agg(
        F.lit("RESUMEN TRANSACCIONES - SILVER").alias("seccion"),
        F.count(F.lit(1)).alias("total_transacciones"),
        F.countDistinct("transaccion_id").alias("transacciones_unicas"),
        F.countDistinct("cliente_id").alias("clientes_distintos"),
        round_half_up(money_sum("importe_neto"), 2).alias("ventas_totales"),
        round_half_up(money_avg("importe_neto"), 2).alias("ticket_promedio"),
        round_half_up(money_avg("porcentaje_descuento"), 2).alias("descuento_promedio_pct"),
        channel_sum(web).alias("ventas_web"),
        channel_sum(app).alias("ventas_app"),
        channel_sum(store).alias("ventas_tienda"),
        bool_count(F.col("es_black_friday")).alias("transacciones_black_friday"),
        bool_count(F.col("es_navidad")).alias("transacciones_navidad"),
        bool_count(F.col("con_descuento")).alias("transacciones_con_descuento"))


def sales_pivot(silver: DataFrame, by: list[str], column: str = "canal", values: tuple[str, ...] = ("Web", "App", "Tienda"),
                other: str = "otros") -> DataFrame:
    """S5's channel columns in general: sales of each of ``values`` of a column, per group, one column ``ventas_<value>`` each.

    Given values make the pivot one aggregation (Spark needn't look for them first). Values not given, and nulls, are
    summed in ``ventas_<other>``, so the columns add up to the total.
    """
    known = F.when(F.col(column).isin(*values), F.col(column)).otherwise(F.lit(other))
    wide = silver.groupBy(*by, known.alias("__v")).agg(money_sum("importe_neto").alias("__s")).groupBy(*by).pivot("__v", [*values, other]).agg(F.sum("__s"))
    return wide.select(*by, *[F.coalesce(F.col(f"`{v}`"), F.lit(0.0)).alias(f"ventas_{v.lower()}") for v in [*values, other]])


def monthly_sales(silver: DataFrame) -> DataFrame:
    """S6 (also dashboard P2)."""
    return (silver.groupBy("anio", "mes", "nombre_mes")
            .agg(F.count(F.lit(1)).alias("num_transacciones"),
                 round_half_up(money_sum("importe_neto"), 2).alias("ventas_totales"),
                 round_half_up(money_avg("importe_neto"), 2).alias("ticket_promedio"))
            .orderBy("anio", "mes"))


# -------------------------------------------------------------------------------------------------- returns
def silver_devoluciones(bronze: DataFrame, transacciones: DataFrame, processed_at: str | None = None) -> DataFrame:
    """S7. Returns joined to their original purchase; an unknown purchase leaves the joined columns NULL."""
    d = bronze.where(F.col("devolucion_id").isNotNull() & F.col("transaccion_id").isNotNull())
    t = transacciones.select("transaccion_id", "fecha_transaccion",
                             F.col("importe_neto").alias("importe_transaccion_original"), "perfil_cliente", "canal")
    fd = parse_date("fecha_devolucion")
    days = F.datediff(fd, F.col("fecha_transaccion"))
    return (d.join(t, "transaccion_id", "left")
            .select("devolucion_id", "transaccion_id", "cliente_id",
                    fd.alias("fecha_devolucion"), "motivo", "productos_devueltos", "importe_devuelto",
                    "fecha_transaccion", "importe_transaccion_original", "perfil_cliente", "canal",
                    days.cast("long").alias("dias_hasta_devolucion"),
                    round_half_up(safe_div(F.col("importe_devuelto"), F.col("importe_transaccion_original"))
                                  * F.lit(100.0), 2).alias("porcentaje_devolucion"),
                    return_type("importe_devuelto", "importe_transaccion_original").alias("tipo_devolucion"),
                    F.coalesce(days <= QUICK_RETURN_DAYS, F.lit(False)).alias("devolucion_rapida"),
                    _ts(processed_at).alias("fecha_procesamiento")))


def quality_devoluciones(silver: DataFrame) -> DataFrame:
    """S8."""
    return silver.agg(
        F.lit("RESUMEN DEVOLUCIONES - SILVER").alias("seccion"),
        F.count(F.lit(1)).alias("total_devoluciones"),
        F.countDistinct("devolucion_id").alias("devoluciones_unicas"),
        F.countDistinct("cliente_id").alias("clientes_con_devoluciones"),
        round_half_up(money_sum("importe_devuelto"), 2).alias("importe_total_devuelto"),
        round_half_up(money_avg("importe_devuelto"), 2).alias("importe_promedio_devolucion"),
        round_half_up(money_avg("porcentaje_devolucion"), 2).alias("porcentaje_promedio"),
        round_half_up(F.avg("dias_hasta_devolucion"), 1).alias("dias_promedio_hasta_devolucion"),
        bool_count(F.col("devolucion_rapida")).alias("devoluciones_rapidas_7dias"),
        bool_count(F.col("tipo_devolucion") == "Completa").alias("devoluciones_completas"),
        bool_count(F.col("tipo_devolucion").like("Parcial%")).alias("devoluciones_parciales"))


def returns_by_reason(silver: DataFrame) -> DataFrame:
    """S9."""
    g = silver.groupBy("motivo").agg(F.count(F.lit(1)).alias("num_devoluciones"),
                                     round_half_up(money_avg("importe_devuelto"), 2).alias("importe_promedio"))
    return (share_of_total(g, "num_devoluciones", "porcentaje")
            .select("motivo", "num_devoluciones", "porcentaje", "importe_promedio")
            .orderBy(F.desc("num_devoluciones"), "motivo"))


def returns_by_profile(silver: DataFrame) -> DataFrame:
    """S10. A NULL profile (unknown purchase or client) is a group of its own."""
    return (silver.groupBy("perfil_cliente")
            .agg(F.count(F.lit(1)).alias("num_devoluciones"),
                 round_half_up(money_avg("porcentaje_devolucion"), 2).alias("porcentaje_promedio_devuelto"),
                 round_half_up(F.avg("dias_hasta_devolucion"), 1).alias("dias_promedio"))
            .orderBy(F.desc("num_devoluciones"), "perfil_cliente"))
