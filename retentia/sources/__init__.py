from retentia.sources.bronze import (BRONZE_CLIENTES_SCHEMA, BRONZE_DEVOLUCIONES_SCHEMA,
                                     BRONZE_TRANSACCIONES_SCHEMA, read_bronze_clientes, read_bronze_devoluciones,
                                     read_bronze_transacciones, save_table, write_csv)
from retentia.sources.testdata import (TESTDATA_AS_OF, TESTDATA_SENTINEL, bronze_clientes, bronze_devoluciones,
                                       bronze_tables, bronze_transacciones, order_lines, read_table)

__all__ = ["BRONZE_CLIENTES_SCHEMA", "BRONZE_DEVOLUCIONES_SCHEMA", "BRONZE_TRANSACCIONES_SCHEMA",
           "read_bronze_clientes", "read_bronze_devoluciones", "read_bronze_transacciones", "save_table", "write_csv",
           "TESTDATA_AS_OF", "TESTDATA_SENTINEL", "bronze_clientes", "bronze_devoluciones", "bronze_tables",
           "bronze_transacciones", "order_lines", "read_table"]
