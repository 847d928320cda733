"""Adapters from the generated star-schema tables to the bronze contract (FIXTURES.md §2).

The test tables are TPC-H-like (``customer``, ``orders``, ``lineitem``, ``nation``, ``region``); the engine's input is
three bronze tables (clients, purchases, returns) whose columns follow what the silver layer reads. These functions
derive the bronze tables with DataFrame operations only, so their cost grows with the input:

* ``nation`` and ``region`` have a fixed, spec-bounded size (25 and 5 rows) and are broadcast.
* ``lineitem`` is reduced to one row per order with a partial (map-side) aggregation before its shuffle; the join with
  ``orders`` then reuses that hash partitioning on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

# Parameters that go with this mapping (FIXTURES.md §2): the test dates run 1995-01 .. 2001-08.
TESTDATA_SENTINEL = "1990-01-01"
TESTDATA_AS_OF = "2001-08-31"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _date_text(ts_col: str) -> F.Column:
    return F.date_format(F.col(ts_col).cast("date"), "yyyy-MM-dd")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: line count, returned-line count, quantity, extended price, discount amount, min part."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("nr"),
                 F.sum("l_quantity").alias("qty"),
                 F.sum("l_extendedprice").alias("ext"),
                 F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("dsc"),
                 F.min("l_partkey").alias("pk")))


def bronze_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    first = (read_table(spark, sf_dir, "orders")
             .groupBy("o_custkey").agg(F.min("o_orderdate").alias("f")))
    k = F.col("c_custkey")
    email = F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.when(k % 10 == 0, " ").otherwise(""),
                 F.upper(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                 F.when(k % 50 == 7, "").otherwise("@mail.com")))
    perfil = (F.when(F.col("c_mktsegment") == "BUILDING", "VIP")
              .when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), "Activo")
              .when(F.col("c_mktsegment") == "FURNITURE", "Ocasional")
              .otherwise("Churned"))
    return (cust
            .join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
            .join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey, "left")
            .join(first, cust.c_custkey == first.o_custkey, "left")
            .select(F.concat(F.lit("CLI_"), k.cast("string")).alias("cliente_id"),
                    email.alias("email"),
                    F.concat(F.col("n_name"), F.lit(" ")).alias("ciudad"),
                    F.col("r_name").alias("pais"),
                    F.lit("1995-01-01").alias("fecha_registro"),
                    _date_text("f").alias("fecha_primera_compra"),
                    perfil.alias("perfil")))


def bronze_transacciones(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    lines = lines if lines is not None else order_lines(spark, sf_dir)
    k = F.col("o_orderkey")
    canal = F.when(F.col("o_orderstatus") == "F", "Web").when(F.col("o_orderstatus") == "O", "App").otherwise("Tienda")
    pago = F.when(k % 3 == 0, "Tarjeta").when(k % 3 == 1, "PayPal").otherwise("Transferencia")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
            .select(F.concat(F.lit("TXN_"), k.cast("string")).alias("transaccion_id"),
                    F.concat(F.lit("CLI_"), F.col("o_custkey").cast("string")).alias("cliente_id"),
                    _date_text("o_orderdate").alias("fecha_transaccion"),
                    F.col("pk").cast("string").alias("producto"),
                    F.col("o_orderpriority").alias("categoria"),
                    F.col("qty").alias("cantidad"),
                    F.try_divide(F.col("ext"), F.col("qty")).alias("precio_unitario"),
                    F.col("dsc").alias("descuento"),
                    F.col("o_totalprice").alias("importe_neto"),
                    canal.alias("canal"),
                    pago.alias("metodo_pago")))


# FIXED VALUES: return reasons of the generator, indexed by order key modulo 6.
RETURN_REASONS = ["Producto defectuoso", "No cumple expectativas", "Talla/especificaciones incorrectas",
                  "Llegó dañado", "Cambio de opinión", "Incompatibilidad técnica"]


def bronze_devoluciones(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Every order with a returned line becomes a return, 3..30 days after the order (FIXTURES.md §2)."""
    orders = read_table(spark, sf_dir, "orders")
    lines = lines if lines is not None else order_lines(spark, sf_dir)
    k = F.col("o_orderkey")
    reason = F.element_at(F.array(*[F.lit(r) for r in RETURN_REASONS]), (k % 6 + 1).cast("int"))
    amount = F.round((F.col("o_totalprice") * F.col("nr") / F.col("n")).cast("decimal(38,10)"), 2).cast("double")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "inner")
            .where(F.col("nr") > 0)
            .select(F.concat(F.lit("DEV_"), k.cast("string")).alias("devolucion_id"),
                    F.concat(F.lit("TXN_"), k.cast("string")).alias("transaccion_id"),
                    F.concat(F.lit("CLI_"), F.col("o_custkey").cast("string")).alias("cliente_id"),
                    F.date_format(F.date_add(F.col("o_orderdate").cast("date"), (3 + k % 28).cast("int")),
                                  "yyyy-MM-dd").alias("fecha_devolucion"),
                    F.col("nr").cast("long").alias("productos_devueltos"),
                    amount.alias("importe_devuelto"),
                    reason.alias("motivo")))


def bronze_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clients, purchases, returns) in the bronze contract."""
    lines = order_lines(spark, sf_dir)
    return (bronze_clientes(spark, sf_dir), bronze_transacciones(spark, sf_dir, lines),
            bronze_devoluciones(spark, sf_dir, lines))
