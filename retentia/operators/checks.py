"""Bronze load checks (B4-B7): row counts, distinct keys and rounded totals after each load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from retentia.functions.numeric import money_sum, round_half_up
from retentia.sources.bronze import save_table


def check_bronze_clientes(df: DataFrame) -> DataFrame:
    """B4."""
    return df.agg(F.lit("bronze_clientes").alias("tabla"), F.count(F.lit(1)).alias("total_filas"),
                  F.countDistinct("cliente_id").alias("clientes_unicos"))


def check_bronze_transacciones(df: DataFrame) -> DataFrame:
    """B5. Two distinct counts in one aggregate (Catalyst expands the rows once per distinct column)."""
    return df.agg(F.lit("bronze_transacciones").alias("tabla"), F.count(F.lit(1)).alias("total_filas"),
                  F.countDistinct("transaccion_id").alias("transacciones_unicas"),
                  F.countDistinct("cliente_id").alias("clientes_distintos"),
                  round_half_up(money_sum("importe_neto"), 2).alias("ventas_totales"))


def check_bronze_devoluciones(df: DataFrame) -> DataFrame:
    """B6."""
    return df.agg(F.lit("bronze_devoluciones").alias("tabla"), F.count(F.lit(1)).alias("total_filas"),
                  F.countDistinct("devolucion_id").alias("devoluciones_unicas"),
                  round_half_up(money_sum("importe_devuelto"), 2).alias("importe_total_devuelto"))


def bronze_summary(clientes: DataFrame, transacciones: DataFrame, devoluciones: DataFrame) -> DataFrame:
    """B7. Three one-row counts side by side (cross join of one-row aggregates)."""
    c = clientes.agg(F.count(F.lit(1)).alias("clientes"))
    t = transacciones.agg(F.count(F.lit(1)).alias("transacciones"))
    d = devoluciones.agg(F.count(F.lit(1)).alias("devoluciones"))
    return (c.crossJoin(t).crossJoin(d)
            .select(F.lit("RESUMEN BRONZE LAYER").alias("seccion"), "clientes", "transacciones", "devoluciones"))


def load_observed(df: DataFrame, name: str, path: str, keys: list[str], amount: str | None = None) -> DataFrame:
    """B4-B6 gathered while the table is written: row count and total come from the write itself, by an ``Observation``.

    One row: tabla, total_filas, one column ``<key>_distintos`` per key, importe_total. Spark can't observe distinct counts; those
    read the key columns alone of the Parquet just written.
    """
    seen = Observation(f"load-{name}")
    total = money_sum(amount) if amount else F.max(F.lit(None).cast("double"))
    save_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), total.alias("total")), path=path)
    got = seen.get
    distinct = df.sparkSession.read.schema(df.schema).parquet(path).agg(*[F.countDistinct(k).alias(f"{k}_distintos") for k in keys])
    return distinct.select(F.lit(name).alias("tabla"), F.lit(got["rows"]).cast("long").alias("total_filas"), *[f"{k}_distintos" for k in keys],
                           round_half_up(F.lit(got["total"]).cast("double"), 2).alias("importe_total"))
