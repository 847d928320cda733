"""Corpus pipeline: quality rules, SimHash near-dedup, substring dedup, benchmark decontamination, best-fit packing."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from retentia.llm import op2_packing, op5_decontamination, op6_substring_dedup, op7_simhash, op9_quality_rules  # noqa: E402
from retentia.llm.common import store, table  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents; frequent lines leave the texts of the others (n_chars follows)."""
    judged = op9_quality_rules.judge_documents(docs).where("kept")
    return judged.select(*[_changed(c, "clean_text") for c in docs.columns])


def _changed(column: str, text: str):
    """A column of the packed row, with the text replaced and n_chars recounted where the text changed."""
    old = F.col("row").getField(column)
    if column == "text":
        return F.col(text).alias(column)
    if column == "n_chars":
        same = F.col("row.text").eqNullSafe(F.col(text))
        return F.when(same, old).otherwise(F.char_length(F.col(text)).cast("long")).alias(column)
    return old.alias(column)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the smallest id."""
    return op7_simhash.one_per_component(op7_simhash.simhash_documents(docs)).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs and passages that other documents keep leave the texts (n_chars follows); a document that has no word left goes."""
    rows = op6_substring_dedup.deduplicate(docs, passage=op6_substring_dedup.PASSAGE)
    empty = (F.col("removed").isNotNull() | F.col("passages").isNotNull()) & ~F.col("clean_text").rlike("[^\\x20\\x09-\\x0D]")
    return rows.where(~empty).select(*[_changed(c, "clean_text") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    return op5_decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their sequences and offsets."""
    return op2_packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("simhash near-dedup", near_dedup), ("substring dedup", substring_dedup),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: Tokenised packing can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
