"""Steps whose partitions, jobs and memory follow the input."""

import glob
import os
import random
import time

import numpy as np
import pytest

from retentia.functions.numeric import round_doubles

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def large_panel(monkeypatch):
    """Every panel counts as a large one, of 1,500 rows a task."""
    from retentia.operators import gold as G
    monkeypatch.setattr(G, "LARGE_PANEL_ROWS", 0)
    monkeypatch.setattr(G, "PANEL_ROWS_PER_TASK", 1500)


def test_large_panel_has_partitions_by_its_rows_and_is_not_shuffled(spark, small_layers, large_panel):
    from retentia.operators import gold as G
    from retentia.plans import layers
    assert small_layers.gold.count() > 4500
    large = layers.Layers.from_testdata(spark, SF_SMALL)
    large.key += "-large"
    rows = large.gold
    path = layers._STORED[(spark.sparkContext.applicationId, large.key, "gold")].removeprefix("file:")
    parts = G.panel_partitions(large.client_months)
    assert parts > 8  # the session's shuffle partitions
    # each window task writes its own file a month
    months = glob.glob(os.path.join(path, "fecha_referencia=*"))
    assert max(len(glob.glob(os.path.join(m, "*.parquet"))) for m in months) > 4
    assert rows.exceptAll(small_layers.gold).isEmpty() and small_layers.gold.exceptAll(rows).isEmpty()
    panel = G.gold_panel(large.client_months, G.client_month_returns(large.silver_devoluciones), "1990-01-01")
    assert panel.rdd.getNumPartitions() == parts


def shuffle_blocks(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}


def test_layers_leave_no_shuffle_files(spark, large_panel):
    from retentia.plans import layers
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = shuffle_blocks(spark), spark.conf.get(setting)
    new = layers.Layers.from_testdata(spark, SF_SMALL)
    new.key += "-freed"
    assert len(new.gold.select("mes_del_anio").collect()) > 4500 and spark.conf.get(setting) == kept
    until = time.time() + 20  # Spark deletes them in the background
    while (left := shuffle_blocks(spark) - before) and time.time() < until:
        time.sleep(0.5)
    assert not left


def test_month_of_a_large_panel_is_replaced_without_a_shuffle_of_the_panel(spark, small_layers, large_panel, tmp_path, monkeypatch):
    from retentia.plans import layers, registry
    large = layers.Layers.from_testdata(spark, SF_SMALL)
    large.key += "-replaced"
    monkeypatch.setattr(layers.Layers, "from_testdata", lambda spark, sf_dir: large)
    monkeypatch.setattr(registry, "_scratch", lambda spark, name: str(tmp_path / name))
    first = []  # the table as it stands before the month is replaced
    replace = registry._BR.replace_partitions
    monkeypatch.setattr(registry._BR, "replace_partitions", lambda df, path, by: (first.extend(spark.read.parquet(path).collect()), replace(df, path, by)))
    files = lambda month: glob.glob(str(tmp_path / "gold" / month / "*.parquet"))
    got = registry.QUERIES["replace_month"](spark, SF_SMALL)
    months = sorted(m for m in os.listdir(tmp_path / "gold") if m.startswith("fecha_referencia="))
    # tasks write the files they have read; a shuffle by month leaves one file a month
    assert max(len(files(m)) for m in months[:-1]) > 1 and len(files(months[-1])) == 1
    last = max(r.fecha_referencia for r in first)
    assert all((r.engagement_score == -1) == (r.fecha_referencia == last) for r in first) and len(first) == got.count()
    want = round_doubles(small_layers.gold, 6)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_small_panel_keeps_few_files(small_layers):
    from retentia.operators import gold as G
    assert G.panel_partitions(small_layers.client_months) is None


def test_training_rows_are_stored_in_blocks(spark, monkeypatch):
    from pyspark.sql import functions as F
    from retentia.operators import boosting as BT
    monkeypatch.setattr(BT, "BLOCK_ROWS", 300)
    df = spark.range(2000).repartition(2).select(
        (F.col("id") % 7).cast("double").alias("a"), F.when(F.col("id") % 5 != 0, F.col("id").cast("double")).alias("b"),
        F.col("id").cast("double").alias("y"), F.lit(1.0).alias("w"), (F.col("id") % 4 == 0).alias("is_eval"), F.col("id").alias("row_hash"))
    blocks = BT.binned(df, {"a": [2.0, 5.0], "b": [100.0]}).collect()
    assert len(blocks) <= 4 + 2000 // 300 and sum(b.n for b in blocks) == 2000
    seen = {}
    for b in blocks:
        bins = np.frombuffer(b.bins, dtype=np.uint8).reshape(2, b.n)
        for j, i in enumerate(np.frombuffer(b.row_hash, dtype=np.int64)):
            assert b.is_eval == (i % 4 == 0) and np.frombuffer(b.y)[j] == i and np.frombuffer(b.w)[j] == 1
            seen[int(i)] = tuple(bins[:, j])
    assert seen == {i: ((i % 7 >= 2) + (i % 7 >= 5), 255 if i % 5 == 0 else int(i >= 100)) for i in range(2000)}


@pytest.mark.parametrize("depth", [1, 3, 4, 6])
def test_rows_reach_the_leaves_of_a_plain_walk(depth):
    from retentia.operators import boosting as BT
    rng = random.Random(depth)
    edges = {f: [float(i) for i in range(1, 254)] for f in "abc"}

    def grow(tree, at, left):
        if left and (at == 0 or rng.random() < 0.9):
            tree[at] = BT.Node(0, at, rng.choice("abc"), float(rng.randrange(1, 254)), rng.random() < 0.5, 2 * at + 1, 2 * at + 2)
            grow(tree, 2 * at + 1, left - 1)
            grow(tree, 2 * at + 2, left - 1)
        else:
            tree[at] = BT.Node(0, at, value=float(at))
        return tree

    trees = [grow({}, 0, depth) for _ in range(5)]
    flat = BT._Flat(trees, ["a", "b", "c"], edges)
    bins = np.array([[rng.choice([0, 252, 253, 255, rng.randrange(254)]) for _ in range(400)] for _ in range(3)], dtype=np.uint8)
    want = np.zeros(400)
    for tree in trees:
        for j in range(400):
            n = tree[0]
            while n.feature is not None:
                code = bins["abc".index(n.feature), j]
                n = tree[n.left if (n.missing_left if code == 255 else code <= n.threshold - 1) else n.right]
            want[j] += n.value
    assert (flat.margins(bins, 5) == want).all()


def test_segments_are_fitted_in_tasks_of_bounded_rows(spark, monkeypatch):
    from retentia.operators import models as MD
    monkeypatch.setattr(MD, "SEGMENT_ROWS_PER_TASK", 100)
    rows = spark.range(0, 950, 1, 1).selectExpr("cast(id AS string) AS cliente_id", *[f"cast(id % {i + 2} AS double) AS {c}" for i, c in enumerate(MD.CLUSTER_FEATURES)])
    out = MD.spread(rows)
    sizes = [len(p) for p in out.rdd.glom().collect()]
    assert len(sizes) == 10 and max(sizes) < 200 and sorted(out.collect()) == sorted(rows.collect())
    assert MD.assign_segments(MD.fit_segments(rows), rows).count() == 950
