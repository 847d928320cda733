"""As-of join, range join and the correlated target against DuckDB and plain loops, with hot keys."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.operators import gold as G
from retentia.operators import joins as J


def day(n):
    return None if n is None else dt.date(2001, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    key = lambda: rng.choice(["hot"] * 6 + [None, "a", "b", "c", "only"])
    left = [(i, key(), day(rng.choice([None, *range(300)]))) for i in range(900)] + [(1, "hot", day(5))] * 2 + [(2000, "only-left", day(3))]
    right = [(1000 + i, rng.choice(["hot"] * 6 + [None, "a", "b", "c", "only-right"]), day(rng.choice([None, *range(0, 300, 3)])), rng.random()) for i in range(900)]
    return (spark.createDataFrame(left, "id long, k string, t date").repartition(3),
            spark.createDataFrame(right, "rid long, k string, at date, v double").repartition(3), left, right)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("most_rows", [10**6, 40])
def test_asof_join_matches_duckdb(sides, strict, most_rows):
    ls, rs, left, right = sides
    got = J.asof_join(ls, rs, ["k"], "t", "at", ["rid", "v"], tie="rid", strict=strict, most_rows=most_rows)
    assert got.columns == ["id", "k", "t", "rid", "v"]
    lp = pd.DataFrame(left, columns=["id", "k", "t"])
    rp = pd.DataFrame(right, columns=["rid", "k", "d", "v"])
    want = duckdb.connect().execute(f"""
      WITH r AS (SELECT k, CAST(d AS DATE) on_day, max(rid) rid, arg_max(v, rid) v FROM rp WHERE k IS NOT NULL AND d IS NOT NULL GROUP BY ALL)
      SELECT id, l.k, CAST(t AS DATE) t, r.rid, r.v FROM lp l ASOF LEFT JOIN r ON l.k = r.k AND CAST(l.t AS DATE) {'>' if strict else '>='} r.on_day""").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert len(want) == len(left)


def test_hot_keys_are_cut_into_slices(sides):
    ls, rs, left, _ = sides
    rows = ls.select(F.col("k").alias("__k0"), F.col("t").alias("__t"), F.lit(None).cast("struct<rid: long>").alias("__r"), F.lit(None).cast("long").alias("__tie"),
                     F.lit(1).alias("__side")).where("__t IS NOT NULL")
    sizes = J._sliced(rows, ["__k0"], 100).groupBy("__k0", "__slice").count().collect()
    hot = sum(r[1] == "hot" and r[2] is not None for r in left)
    assert hot > 400 and max(r["count"] for r in sizes if r["__k0"] == "hot") < 0.3 * hot
    assert all(r["__slice"] == 0 for r in sizes if r["__k0"] != "hot")


def test_columns_on_both_sides_are_refused(sides):
    with pytest.raises(ValueError, match="both sides"):
        J.asof_join(sides[0], sides[1].withColumnRenamed("v", "t"), ["k"], "t", "at", ["t"], tie="rid")


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_range_join_finds_each_pair_once(spark, width):
    rng = random.Random(2)
    left = [(i, rng.choice(["hot", "hot", "a", None]), day(lo), day(hi)) for i in range(150) for lo in [rng.randrange(200)] for hi in [rng.choice([None, lo - 3, lo, lo + 1, lo + 40])]]
    right = [(1000 + i, rng.choice(["hot", "hot", "a", None]), day(rng.choice([None, *range(250)]))) for i in range(300)]
    got = J.range_join(spark.createDataFrame(left, "id long, k string, lo date, hi date"), spark.createDataFrame(right, "rid long, k string, at date"), ["k"], "lo", "hi", "at", width)
    want = sorted((i, r) for i, k, lo, hi in left for r, q, at in right if k is not None and k == q and hi is not None and at is not None and lo <= at < hi)
    assert sorted((x.id, x.rid) for x in got.collect()) == want and len(want) > 400
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_range_join_of_numbers_and_timestamps(spark):
    left = spark.createDataFrame([(1, 0, 10), (2, -5, 1)], "id int, lo long, hi long")
    right = spark.createDataFrame([(-5,), (0,), (9,), (10,)], "at long")
    assert sorted(map(tuple, J.range_join(left, right, [], "lo", "hi", "at", 4).collect())) == [(1, 0, 10, 0), (1, 0, 10, 9), (2, -5, 1, -5), (2, -5, 1, 0)]
    times = lambda df, *cs: df.select(*[F.timestamp_seconds(c).alias(c) for c in cs])
    assert J.range_join(times(left, "lo", "hi"), times(right, "at"), [], "lo", "hi", "at").count() == 4


def test_not_exists_becomes_an_anti_join(spark, small_layers):
    t = small_layers.silver_transacciones
    spine = G.client_month_spine(t)
    got = G.churn_target(spine, t)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "comprador" in plan
    want = small_layers.gold.select("cliente_id", "fecha_referencia", "fuga_combinada_1m")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
