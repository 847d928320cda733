"""Bronze sources and the table sink.

The raw files are CSV with one header row. Schemas are declared, never inferred: dates stay text so that the silver
layer's strict ``yyyy-MM-dd`` parse sees exactly what was delivered.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()

BRONZE_CLIENTES_SCHEMA = T.StructType([
    T.StructField("cliente_id", S), T.StructField("email", S), T.StructField("ciudad", S), T.StructField("pais", S),
    T.StructField("fecha_registro", S), T.StructField("fecha_primera_compra", S), T.StructField("perfil", S),
])

BRONZE_TRANSACCIONES_SCHEMA = T.StructType([
    T.StructField("transaccion_id", S), T.StructField("cliente_id", S), T.StructField("fecha_transaccion", S),
    T.StructField("producto", S), T.StructField("categoria", S), T.StructField("cantidad", D),
    T.StructField("precio_unitario", D), T.StructField("descuento", D), T.StructField("importe_neto", D),
    T.StructField("canal", S), T.StructField("metodo_pago", S),
])

BRONZE_DEVOLUCIONES_SCHEMA = T.StructType([
    T.StructField("devolucion_id", S), T.StructField("transaccion_id", S), T.StructField("cliente_id", S),
    T.StructField("fecha_devolucion", S), T.StructField("productos_devueltos", L),
    T.StructField("importe_devuelto", D), T.StructField("motivo", S),
])


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # FAILFAST: a malformed file stops the load instead of silently turning values into NULLs.
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("encoding", "UTF-8").csv(path))


def read_bronze_clientes(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, BRONZE_CLIENTES_SCHEMA)


def read_bronze_transacciones(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, BRONZE_TRANSACCIONES_SCHEMA)


def read_bronze_devoluciones(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, BRONZE_DEVOLUCIONES_SCHEMA)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with a header row (the generator's output format)."""
    # Leading/trailing blanks are data here (the silver layer trims them), so the writer must keep them.
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def save_table(df: DataFrame, name: str | None = None, path: str | None = None,
               partition_by: list[str] | str | None = None, sort_within: list[str] | None = None,
               mode: str = "overwrite", rebalance: bool = True) -> None:
    """``CREATE OR REPLACE TABLE ... AS`` as a Parquet write.

    ``path`` writes files; otherwise ``name`` is saved in the session catalog. ``partition_by`` gives directory
    partitions (gold by month, so month filters prune files); the rows are rebalanced on those columns first, unless
    ``rebalance`` is off (for a table whose partitions each fill a file per value, which then isn't shuffled). The
    reference's global ``ORDER BY`` is replaced by a sort within each output partition, which needs no range shuffle.
    """
    if isinstance(partition_by, str):
        partition_by = [partition_by]
    if partition_by and rebalance:
        # Without this every task would write one file per partition value it holds (tasks x months files for gold).
        # REBALANCE sends each value's rows together and lets AQE split big values / merge small ones to the advisory
        # partition size, so each directory gets a few files of a sensible size.
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer.save(path)
    elif name:
        if mode == "overwrite":
            replace_table(df, name, partition_by)
        else:
            writer.saveAsTable(name)
    else:
        raise ValueError("save_table needs a name or a path")


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None, root: str | None = None) -> str:
    """``CREATE OR REPLACE TABLE name AS df``: a new version is written beside the old one, then the name is pointed at it.

    Spark's own overwrite drops the old table before it writes, so a failed job leaves nothing. Here a failure leaves the old table as it
    was, and readers that have begun keep their files. Versions lie under ``root``/name (default root: the warehouse folder) and stay until
    somebody deletes them. A version with the schema of the one before is swapped in by one catalog change; another schema
    takes a drop and a create, both of the catalog entry alone. Returns the new version's folder.
    """
    spark = df.sparkSession
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/{name.replace('.', '/')}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    parts = list(partition_by or [])
    columns = sorted(((f.name, f.dataType) for f in df.schema), key=lambda c: c[0] in parts and 1 + parts.index(c[0]))  # partition columns are last in a table
    exists = spark.catalog.tableExists(name)
    if exists and [(f.name, f.dataType) for f in spark.table(name).schema] == columns and _partition_columns(spark, name) == parts:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        if exists:
            spark.sql(f"DROP TABLE {name}")  # the files of a version written here are not the catalog's and stay
        _create_table(spark, name, path, columns, parts)
    spark.catalog.refreshTable(name)
    return path


def _create_table(spark: SparkSession, name: str, path: str, columns: list[tuple[str, T.DataType]], parts: list[str]) -> None:
    """A table over a folder whose partitions are found in the folder, not listed in the catalog, so that a new location brings its own."""
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        listed = ", ".join(f"`{c}` {kind.simpleString()}" for c, kind in columns)
        by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet {by} LOCATION '{path}'")
    finally:
        spark.conf.set(setting, before)


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Writes ``df`` over the partitions that it has rows for (a re-run month); the others stay. Spark stages the files and moves them at the end."""
    df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
