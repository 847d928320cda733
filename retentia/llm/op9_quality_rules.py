"""Operator 9, quality rules: cross-document line frequency, after a few rules on single documents.

Lines are normalised (words joined by one blank, A-Z lower-cased) and hashed. For each host (the documents' source) the
distinct documents that hold a line are counted, where documents of one host with equal texts count once, so that
exact copies don't make their own lines look like boilerplate. Lines above the host's limit are removed:
more than ``min_docs`` documents and more than ``share`` of the host's distinct texts. A document is rejected if it
fails a rule of its own or if too little of it is left.

Counts are partially aggregated; the table of frequent lines is written to the shared folder, one row per host, and
then joined with the documents. Its rows are bounded by lines per document / share, so its size follows the number of
hosts: Spark broadcasts it while it is small and otherwise shuffles, with hot hosts split by AQE.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import ascii_lower, bounded_batches, store, table

#: Characters counted as symbols, fixed by the contract.
SYMBOLS = "#*$%&|<>"
WHITESPACE = " \t\n\x0b\x0c\r"

MIN_DOCS = 20
SHARE = 0.05
MIN_WORDS = 10
LEFT_OVER = 0.5

BASE_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The five counts of one text (null: as empty)."""
    text = text or ""
    words = text.encode().split()  # splits at exactly the ASCII white space
    word_chars = len(text) - sum(map(text.count, WHITESPACE))
    lines = [x for x in text.split("\n") if x.strip(WHITESPACE)]
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        first: dict[tuple, int] = {}
        marked = bytearray(len(words))
        for i, w in enumerate(windows):
            j = first.setdefault(w, i)
            if j != i:
                marked[j:j + 5] = marked[i:i + 5] = b"\x01" * 5
        repeated = sum(marked)
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def base_column(text: Column) -> Column:
    @F.pandas_udf(BASE_SCHEMA)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            rows = [base_counts(t) for t in s]
            yield pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], dtype="int64")

    return run.asNondeterministic()(text)  # computed once, also below filters on its result


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _normal(line: Column) -> Column:
    return F.trim(ascii_lower(F.regexp_replace(line, "[\\x09-\\x0D ]+", " ")))


def frequent_lines(docs: DataFrame, host_col: str, text_col: str, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """(host, lines array<long>): hashes of the normalised lines above the host's limit. A null host is a host."""
    host, text = F.col(host_col).cast("string"), F.col(text_col)
    hashed = F.transform(F.filter(F.transform(_lines(text), _normal), lambda x: x != ""), lambda x: F.xxhash64(x))
    held = docs.where(text.isNotNull()).select(host.alias("host"), F.xxhash64(text).alias("doc"), F.array_distinct(hashed).alias("lines"))
    sizes = held.select("host", "doc").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    counts = (held.select("host", "doc", F.explode("lines").alias("line")).distinct()
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs))
    over = (counts.alias("c").join(sizes.alias("s"), F.expr("c.host <=> s.host"))
            .where(F.col("n") > F.col("n_host") * share))
    return store(over.groupBy(F.col("c.host").alias("host")).agg(F.collect_set("line").alias("lines")), "frequent-lines")


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    min_docs: int = MIN_DOCS, share: float = SHARE, min_words: int = MIN_WORDS,
                    left_over: float = LEFT_OVER) -> DataFrame:
    """One row per input row: (row struct of all input columns, base counts, clean_text, base_failed, kept).

    ``clean_text`` is the text without the lines above the limits (the text itself if there are none). Null text
    has no words, fails the base rules, stays null and is none of its host's texts; empty text is one. Documents with a null
    host share one host. Repeated rows are judged alike and count once in line frequencies. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    frequent = frequent_lines(docs, host_col, text_col, min_docs, share)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"), F.col(host_col).cast("string").alias("host"))
    rows = rows.alias("d").join(frequent.alias("f"), F.expr("d.host <=> f.host"), "left").select("row", "doc_id", "text", "f.lines")
    rows = rows.withColumn("base", base_column(F.col("text")))
    over = F.coalesce(F.col("lines"), F.array().cast("array<bigint>"))
    is_over = lambda x: F.array_contains(over, F.xxhash64(_normal(x)))
    n_line = lambda x: F.when(_normal(x) == "", 0).otherwise(F.size(F.split(_normal(x), " ")))
    cut = F.filter(_lines(F.col("text")), is_over)
    rows = rows.withColumn("cut_words", F.when(F.size(over) == 0, 0).otherwise(F.aggregate(F.transform(cut, n_line), F.lit(0), lambda a, b: a + b)))
    left = F.col("base.n_words") - F.col("cut_words")
    clean = F.when(F.col("cut_words") == 0, F.col("text")).otherwise(
        F.array_join(F.filter(_lines(F.col("text")), lambda x: ~is_over(x)), "\n"))
    failed = (F.col("base.n_words") < min_words) | (100 * F.col("base.n_repeat_words") > 20 * F.col("base.n_words"))
    return rows.select("row", "doc_id", "base.*", clean.alias("clean_text"), failed.alias("base_failed"),
                       (~failed & (left >= min_words) & (left >= left_over * F.col("base.n_words"))).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge_documents(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                 string_split(text, chr(10)) AS lines FROM docs),
pos AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM split WHERE len(words) >= 5),
win AS (SELECT doc_id, p, array_to_string(words[p:p + 4], ' ') AS w FROM pos),
twice AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win),
marked AS (SELECT DISTINCT doc_id, unnest(range(p, p + 5)) AS at FROM twice WHERE n > 1),
repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM marked GROUP BY doc_id),
each_line AS (SELECT doc_id, source, text, unnest(lines) AS line FROM split),
normal AS (SELECT doc_id, source, text, line, trim(translate(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS norm FROM each_line),
worded AS (SELECT * FROM normal WHERE norm <> ''),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS n_host FROM documents GROUP BY source),
freq AS (SELECT source, norm, count(DISTINCT text) AS n FROM worded GROUP BY source, norm),
over_limit AS (SELECT f.source, f.norm FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE f.n > 20 AND f.n > 0.05 * h.n_host),
cut AS (SELECT w.doc_id, sum(len(string_split(w.norm, ' '))) AS n_cut
        FROM worded w JOIN over_limit o ON w.source IS NOT DISTINCT FROM o.source AND w.norm = o.norm GROUP BY w.doc_id),
base AS (SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words,
                CAST(length(array_to_string(s.words, '')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(s.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(coalesce(d.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
                CAST(coalesce(r.n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(c.n_cut, 0) AS n_cut
         FROM split s LEFT JOIN dups d USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN cut c USING (doc_id)),
ruled AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - n_cut >= 10 AND n_words - n_cut >= 0.5 * n_words AS kept
FROM ruled
"""
