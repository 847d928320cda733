"""NTILE of several orders at once against Spark's single-partition windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retentia.operators import analysis as A
from retentia.operators import ntile as N

ORDERS = {"t1": ("x", True), "t2": ("y", False), "t3": ("z", True), "t4": ("x", False), "t5": ("z", False)}


def rows_of(n, seed):
    rng = random.Random(seed)
    values = lambda: rng.choice([None, float("nan"), 0.0, -0.0, 7.5, rng.random(), rng.random()])
    ids = rng.sample([f"{p}{i}" for p in ("CLI_", "a", "é", "a-long-common-prefix-") for i in range(n)], n)
    return [(i, rng.choice([None, 1, 2, 2, 2, rng.randrange(10**9)]), values(), rng.choice([None, -3, 5, -(2**63)])) for i in ids]


@pytest.mark.parametrize("n,most", [(0, 5), (3, 5), (700, 20_000), (240, 6)])
def test_tiles_match_windows(spark, monkeypatch, n, most):
    if most < 20:
        monkeypatch.setattr(N, "PARTS", 16)
    df = spark.createDataFrame(rows_of(n, n + most), "id string, x long, y double, z long").repartition(4).cache()
    k, orders = (5, ORDERS) if most > 20 else (2, dict(list(ORDERS.items())[:3]))
    got = N.global_ntiles(df, k, orders, "id", most)

    def tile(key, ascending):
        return F.ntile(k).over(Window.orderBy(F.col(key).asc_nulls_first() if ascending else F.col(key).desc_nulls_last(), "id"))

    want = df.select("id", *[tile(*o).alias(t) for t, o in orders.items()])
    assert sorted(got.select("id", *orders).collect()) == sorted(want.collect())
    df.unpersist()


def test_number_ids_and_unknown_keys(spark):
    df = spark.range(1000).withColumn("x", F.lit(1))
    got = N.global_ntiles(df, 3, {"t": ("x", False)}, "id", most=10)
    assert [r["count"] for r in sorted(got.groupBy("t").count().collect())] == [334, 333, 333]
    assert got.where("t = 1").agg(F.max("id")).first()[0] == 333
    with pytest.raises(ValueError, match="whole numbers"):
        N.global_ntiles(df.withColumn("x", F.lit("a")), 3, {"t": ("x", True)}, "id")


def test_rfm_plan_has_no_sort_and_directions_turn(small_layers):
    low = A.rfm_scores(small_layers.gold)
    plan = low._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange rangepartitioning" not in plan and "Window" not in plan
    high = {r.cliente_id: r for r in A.rfm_scores(small_layers.gold, high_is_good=True).collect()}
    rows = low.collect()
    by_days = sorted(rows, key=lambda r: (-r.dias_desde_ultima_compra, r.cliente_id))
    n = len(rows)
    for i, r in enumerate(by_days):  # conventional reading: the most recent clients have 5
        q, more = divmod(n, 5)
        want = i // (q + 1) + 1 if i < more * (q + 1) else more + (i - more * (q + 1)) // q + 1
        assert high[r.cliente_id].recency_score == want
    assert max(r.recency_score for r in rows) == 5
