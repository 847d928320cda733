"""Regularised boosted trees against a plain numpy version, and the effect of each option."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentia.operators import boosting as BT
from retentia.operators import features as FT
from retentia.operators import reports as RP

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(800):
        a, b, c = rng.randrange(12), rng.random(), rng.choice([None, float("nan"), 1.0, 2.0, 3.0])
        y = int((a > 7) != (rng.random() < 0.2)) if c != 2.0 else int(b > 0.5)
        out.append((i, float(a), b, c, y, rng.choice([1.0, 2.5]), i % 5 == 0))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int, w double, held boolean").repartition(5)


EDGES = {"a": [2.0, 5.0, 8.0, 10.0], "b": [0.25, 0.5, 0.75], "c": [1.5, 2.5]}


def plain_tree(x, g, h, depth, l1, l2, child, rate, at=0):
    """{node: (feature, threshold, missing left, gain, cover) or (leaf value, cover)}, from the rows themselves."""
    def shrunk(s):
        return np.sign(s) * max(abs(s) - l1, 0)

    def score(m):
        return shrunk(g[m].sum()) ** 2 / (h[m].sum() + l2)

    every = np.ones(len(g), dtype=bool)
    found = []
    for i, f in enumerate(FEATURES) if depth else ():
        for t in EDGES[f]:
            for missing_left in (True, False):
                with np.errstate(invalid="ignore"):
                    left = np.where(np.isnan(x[:, i]), missing_left, x[:, i] < t)
                if left.any() and not left.all() and min(h[left].sum(), h[~left].sum()) >= child:
                    found.append((round(score(left) + score(~left) - score(every), 7), -i, -t, missing_left, f, left))
    best = max(found, key=lambda s: s[:4], default=None)
    if best is None or best[0] <= 0:
        return {at: (-shrunk(g.sum()) / (h.sum() + l2) * rate, h.sum())}
    gain, _, t, missing_left, f, left = best
    out = {at: (f, -t, missing_left, gain, h.sum())}
    for k, side in ((1, left), (2, ~left)):
        out |= plain_tree(x[side], g[side], h[side], depth - 1, l1, l2, child, rate, 2 * at + k)
    return out


def plain_margin(tree, x):
    def one(v, at=0):
        n = tree[at]
        if len(n) == 2:
            return n[0]
        i = FEATURES.index(n[0])
        return one(v, 2 * at + (1 if (n[2] if np.isnan(v[i]) else v[i] < n[1]) else 2))
    return np.array([one(v) for v in x])


@pytest.mark.parametrize("options", [dict(l1_reg=0.0, l2_reg=0.0, min_tree_child_weight=0.0), dict(l1_reg=3.0, l2_reg=5.0, min_tree_child_weight=12.0)])
def test_trees_match_a_plain_version(table, rows, options):
    o = dict(max_tree_depth=3, subsample=1.0, max_iterations=3, learn_rate=0.3, **options)
    model = BT.fit_boosted_trees(table, FEATURES, "y", "w", "held", edges=EDGES, min_rel_progress=-9.0, **o)
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows])
    y, w, held = (np.array([r[i] for r in rows]) for i in (4, 5, 6))
    margin, losses = np.zeros(len(rows)), []
    for tree in [*model.trees(), None]:
        p = 1 / (1 + np.exp(-margin))
        losses.append((w * -np.log(np.where(y == 1, p, 1 - p)))[held].sum() / w[held].sum())
        if tree is None:
            break
        want = plain_tree(x[~held], (w * (p - y))[~held], (w * p * (1 - p))[~held], 3, o["l1_reg"], o["l2_reg"], o["min_tree_child_weight"], 0.3)
        assert set(tree) == set(want)
        for k, n in tree.items():
            if n.feature is None:
                assert (n.value, n.cover) == pytest.approx(want[k])
            else:
                assert (n.feature, n.threshold) == want[k][:2] and (n.gain, n.cover) == pytest.approx(want[k][3:], abs=1e-6)
        margin = margin + plain_margin(want, x)
    assert model.losses == pytest.approx(losses) and len(model.trees()) == 3
    got = {r.id: r.p for r in table.select("id", model.probability().alias("p")).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx(list(1 / (1 + np.exp(-margin))))


def test_options_act(table):
    def leaves(**o):
        m = BT.fit_boosted_trees(table, FEATURES, "y", edges=EDGES, max_iterations=1, **{"subsample": 1.0, "l1_reg": 0.0, "l2_reg": 0.0, "min_tree_child_weight": 0.0, **o})
        return m, [n.value for n in m.nodes if n.feature is None]

    plain, values = leaves()
    assert max(map(abs, leaves(l2_reg=100.0)[1])) < max(map(abs, values))
    assert leaves(l1_reg=1e6)[0].nodes == []  # nothing gains
    heavy, _ = leaves(min_tree_child_weight=40.0)
    assert min(n.cover for n in heavy.nodes) >= 40 > min(n.cover for n in plain.nodes)
    some, _ = leaves(subsample=0.5)
    assert 0.35 < some.nodes[0].cover / plain.nodes[0].cover < 0.65
    assert leaves(subsample=0.5)[0] == some
    assert max(n.node for n in leaves(max_tree_depth=1)[0].nodes) == 2


def test_early_stop_and_empty_tables(table):
    noise = table.withColumn("y", (F.xxhash64("id") % 2 == 0).cast("int"))
    stopped = BT.fit_boosted_trees(noise, FEATURES, "y", is_eval="held", max_iterations=20)
    assert len(stopped.trees()) < 20 and len(stopped.losses) <= len(stopped.trees()) + 2
    for none in (table.limit(0), table.withColumn("y", F.lit(None).cast("int"))):
        model = BT.fit_boosted_trees(none, FEATURES, "y")
        assert model.nodes == [] and {r.p for r in table.select(model.probability().alias("p")).collect()} == {0.5}
    one = BT.fit_boosted_trees(table.withColumn("y", F.lit(1)), FEATURES, "y", max_iterations=2)
    assert all(0.5 <= r.p <= 1 for r in table.select(one.probability().alias("p")).collect())


def test_quantile_edges_are_few_and_inside(table):
    edges = BT.quantile_edges(table, FEATURES, max_bins=8)
    assert edges["a"] == sorted(set(edges["a"])) and len(edges["b"]) == 7 and edges["c"] == [2.0, 3.0]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        days = rng.randint(1, 700)
        y = 1 if (days > 120) != (rng.random() < 0.1) else 0
        rows.append((f"C{i}", f"2001-0{1 + i % 6}-01", float(days), *[float(rng.randint(0, 9)) for _ in FT.CHURN_FEATURES[1:]], y))
    schema = ", ".join(["cliente_id string", "fecha_referencia string", *[f"{c} double" for c in FT.CHURN_FEATURES], "fuga_combinada_1m long"])
    return spark.createDataFrame(rows, schema).withColumn("fecha_referencia", F.to_date("fecha_referencia"))


def test_churn_trees_learn_and_are_stored(spark, planted, tmp_path):
    model = BT.fit_churn_trees(planted, max_iterations=5)
    m = RP.evaluate(BT.evaluation_predictions(model, planted)).first()
    assert m.roc_auc > 0.75 and m.accuracy > 0.85
    importance = BT.feature_importance(model, spark).collect()
    assert [r.feature for r in sorted(importance, key=lambda r: -r.importance_gain)][0] == "dias_desde_ultima_compra" and len(importance) == 22
    assert sum(r.importance_weight for r in importance) == sum(n.feature is not None for n in model.nodes)
    again = BT.load_trees(spark, BT.save_trees(model, spark, str(tmp_path / "m")))
    assert again == model
    plan = planted.select(model.probability().alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
