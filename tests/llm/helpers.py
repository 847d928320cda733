"""Tables for tests."""

import os

import duckdb
import pyarrow as pa

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EMPTY = "SELECT * FROM {} WHERE false"


def documents(spark, rows, extra=""):
    """rows: (doc_id, text) or (doc_id, text, source); ``extra``: names of further columns that clash with inner names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    names = extra.split()
    schema = DOC_SCHEMA + "".join(f", `{n}` string" for n in names)
    return spark.createDataFrame([r + ("x",) * len(names) for r in full], schema)


CLASHES = "row component fp p keys key n bag state items spans words shard slot number length lines base class pid keeper __part"


def write(tmp_path, **tables):
    """Write DataFrames as a directory of tables; its path."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def oracle(sql, sf_dir):
    """Rows of a DuckDB query over a directory of tables, by column name, as a sorted list of tuples."""
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        path = f"{sf_dir}/{f}"
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    found = c.execute(sql).to_arrow_table()
    return rows_of(found)


def rows_of(found):
    if not isinstance(found, pa.Table):
        found = found.toArrow()
    return sorted((tuple(r[c] for c in sorted(r)) for r in found.to_pylist()), key=repr)
