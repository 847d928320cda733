"""Incremental bronze loading with Structured Streaming.

The reference reloads each bronze table in full from a landing folder of CSV files. Where files keep arriving in that
folder, the same load is a file-source stream: each run picks up only the files not seen before (tracked in the
checkpoint), applies the declared schema, and appends them to the bronze Parquet table with exactly-once file-sink
semantics. ``availableNow`` processes everything present and stops, so it runs as a scheduled batch job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retentia.sources.bronze import (BRONZE_CLIENTES_SCHEMA, BRONZE_DEVOLUCIONES_SCHEMA,
                                     BRONZE_TRANSACCIONES_SCHEMA)

SCHEMAS = {
    "bronze_clientes": BRONZE_CLIENTES_SCHEMA,
    "bronze_transacciones": BRONZE_TRANSACCIONES_SCHEMA,
    "bronze_devoluciones": BRONZE_DEVOLUCIONES_SCHEMA,
}


def ingest_csv(spark: SparkSession, landing_dir: str, schema: T.StructType, table_path: str,
               checkpoint_path: str, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream from ``landing_dir`` (CSV with header) into the Parquet table at
    ``table_path``; returns the running query (call ``awaitTermination()``)."""
    reader = (spark.readStream.schema(schema).option("header", True)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.csv(landing_dir).writeStream.format("parquet")
            .option("path", table_path).option("checkpointLocation", checkpoint_path)
            .outputMode("append").trigger(availableNow=True).start())


def ingest_bronze(spark: SparkSession, landing_root: str, lake_root: str, checkpoint_root: str) -> dict[str, int]:
    """Run the three bronze streams once (``<landing_root>/<table>/*.csv`` -> ``<lake_root>/<table>``) and return
    the number of rows each run appended."""
    appended = {}
    for name, schema in SCHEMAS.items():
        before = _rows(spark, f"{lake_root}/{name}")
        q = ingest_csv(spark, f"{landing_root}/{name}", schema, f"{lake_root}/{name}", f"{checkpoint_root}/{name}")
        q.awaitTermination()
        appended[name] = _rows(spark, f"{lake_root}/{name}") - before
    return appended


def _rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table; 0 if it does not exist yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.parquet(path).count() if exists else 0
