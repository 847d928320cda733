"""Distributed NTILE and exact AUC against Spark's single-partition / RDD implementations."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from retentia.operators.ntile import global_ntile, global_row_number
from retentia.operators.reports import roc_auc


@pytest.mark.parametrize("n", [1, 4, 11, 1000])
def test_global_ntile_matches_builtin(spark, n):
    rnd = random.Random(n)
    df = spark.createDataFrame([(i, rnd.randint(0, 5)) for i in range(n)], "id long, x long")
    ours = global_ntile(df, 5, [("x", False), ("id", True)], "t")
    ref = df.withColumn("t", F.ntile(5).over(Window.orderBy(F.desc("x"), "id")))
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_eleven_rows_into_five_tiles(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "id long")
    sizes = sorted(global_ntile(df, 5, [("id", True)], "t").groupBy("t").count().collect())
    assert [r["count"] for r in sizes] == [3, 2, 2, 2, 2]


def test_ties_broken_by_id(spark):
    df = spark.createDataFrame([(i, 7) for i in range(10)], "id long, x long")
    rows = sorted(global_ntile(df, 5, [("x", True), ("id", True)], "t").collect())
    assert [r.t for r in rows] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_row_number_is_a_permutation(spark):
    df = spark.range(0, 5000).withColumn("k", F.col("id") % 97)
    rn = global_row_number(df, [("k", True), ("id", True)], "rn", num_partitions=7)
    got = [r.rn for r in rn.orderBy("k", "id").collect()]
    assert got == list(range(1, 5001))


def test_auc_exact_with_ties(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 1)), round(rnd.random(), 2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label double, score double")
    ours = roc_auc(df, "label", "score", buckets=16).first().roc_auc
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC",
                                        numBins=0).evaluate(df)
    assert ours == pytest.approx(ref, abs=1e-12)
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert ours == pytest.approx(brute, abs=1e-12)
