"""Boosted trees with second-order gains and L1/L2 regularisation (M6, M8, M13), grown from distributed histograms.

Spark's own ``GBTClassifier`` fits first-order trees without regularisation. Here every tree follows the regularised
second-order objective: with G and H the sums of gradients and hessians of the logistic loss in a node,

    T(G) = sign(G) * max(|G| - l1, 0),   score = T(G)^2 / (H + l2),   leaf = -T(G) / (H + l2) * learning rate,
    gain = score(left) + score(right) - score(node),   and H of either side is at least ``min_tree_child_weight``.

Training data are written once as Parquet, in blocks of rows: one byte per feature (its bin), label, class weight, split flag and a row hash.
A level of a tree is one Spark job: a task finds the rows' nodes, computes their margins under the trees so far, and sums gradients
and hessians per (node, feature, bin) with numpy; Spark adds the partial sums. Evaluation rows have blocks of their own and are read once a tree. Only histograms (nodes x features x
bins, whatever the rows) reach the driver, which picks the splits. A pass keeps no state but the trees, so a lost
executor costs its tasks alone. The bins of a feature are cut at approximate quantiles, or at given edges.

Missing values have a bin of their own, and every split sends them to the side with the larger gain.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.operators.common import stored
from retentia.operators.features import CHURN_FEATURES, LABEL, class_weights, split_train_eval
from retentia.operators.reports import PRED, PROB, churn_predictions

# functions of this module travel to the executors by value, so nodes need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# FIXED VALUES: the reference's training options.
PARAMS = dict(max_tree_depth=4, subsample=0.8, l1_reg=0.001, l2_reg=0.1, min_tree_child_weight=1.0, min_rel_progress=0.01,
              eval_fraction=0.2, max_iterations=20, learn_rate=0.3)
MAX_BINS = 64
MISSING = 255
#: Rows from which on a block of the training data is closed.
BLOCK_ROWS = 65_536
#: Trees of at most so many inner nodes have a table from the outcomes of all their tests to the leaf.
MOST_TESTS = 15
NODE_SCHEMA = ("tree int, node int, feature string, threshold double, missing_left boolean, left int, right int, value double, "
               "gain double, cover double")


@dataclass
class Node:
    """An inner node (feature and threshold: values below it go left) or a leaf (value)."""
    tree: int
    node: int
    feature: str | None = None
    threshold: float | None = None
    missing_left: bool | None = None
    left: int | None = None
    right: int | None = None
    value: float | None = None
    gain: float | None = None
    cover: float = 0.0


@dataclass
class BoostedTrees:
    """A fitted model: the nodes of its trees, its features, and the evaluation loss after each tree."""
    features: list[str]
    nodes: list[Node]
    losses: list[float] = field(default_factory=list)

    def trees(self) -> list[dict[int, Node]]:
        return [{n.node: n for n in own} for _, own in itertools.groupby(sorted(self.nodes, key=lambda n: (n.tree, n.node)), key=lambda n: n.tree)]

    def margin(self) -> Column:
        """Sum of the leaves that a row reaches, as one column expression (no Python at scoring)."""
        def walk(tree: dict[int, Node], at: int) -> Column:
            n = tree[at]
            if n.feature is None:
                return F.lit(n.value)
            x = F.col(n.feature).cast("double")
            below = (x < n.threshold) | F.isnan(x) if n.missing_left else x < n.threshold  # NaN is above every number
            return F.when(F.coalesce(below, F.lit(n.missing_left)), walk(tree, n.left)).otherwise(walk(tree, n.right))

        total = F.lit(0.0)
        for tree in self.trees():
            total = total + walk(tree, 0)
        return total

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(asdict(n).values()) for n in self.nodes], NODE_SCHEMA)


# ------------------------------------------------------------------------------------------------------- binning
def quantile_edges(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> dict[str, list[float]]:
    """Ascending cut points of each feature, at most ``max_bins`` - 1, from one aggregation."""
    shares = [i / max_bins for i in range(1, max_bins)]
    value = {f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in features}
    # one task adds up the sketches of all others, so these are as many as the cluster has use for, not as the table has files
    row = df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism).agg(*[F.percentile_approx(value[f], shares, 10_000).alias(f"q{i}") for i, f in enumerate(features)],
                 *[F.min(value[f]).alias(f"m{i}") for i, f in enumerate(features)]).first()
    # a cut at the least value would leave its left side empty
    return {f: sorted({float(e) for e in row[f"q{i}"] or [] if e > row[f"m{i}"]}) for i, f in enumerate(features)}


def binned(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Blocks of the rows of ``df`` (features, y, w, is_eval, row_hash), each all ``is_eval`` or not: ``n`` rows, and their columns as bytes.

    ``bins`` has one byte per feature and row, feature by feature: the number of the feature's edges that the value reaches (255: no value).
    """
    if any(len(e) >= MISSING for e in edges.values()):
        raise ValueError(f"a feature can have {MISSING - 1} edges at most")
    cuts = [np.array(e, dtype=float) for e in edges.values()]
    names = [f"x{i}" for i in range(len(cuts))]
    rows = df.select("y", "w", "is_eval", "row_hash", *[F.col(f).cast("double").alias(x) for f, x in zip(edges, names)])
    schema = pa.schema([("n", pa.int32()), ("is_eval", pa.bool_()), *[(c, pa.binary()) for c in ("bins", "y", "w", "row_hash")]])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = {False: [], True: []}

        def block(held: bool) -> pa.RecordBatch:
            columns = [np.concatenate(c, axis=-1) for c in zip(*waiting[held])]
            waiting[held] = []
            return pa.RecordBatch.from_arrays([pa.array([len(columns[1])], pa.int32()), pa.array([held]), *[pa.array([c.tobytes()], pa.binary()) for c in columns]], schema=schema)

        for batch in batches:
            found = np.empty((len(cuts), batch.num_rows), dtype=np.uint8)
            for i, cut in enumerate(cuts):
                x = batch.column(names[i]).to_numpy(zero_copy_only=False)  # null is NaN here
                found[i] = np.where(np.isnan(x), MISSING, np.searchsorted(cut, x, side="right"))
            is_eval, *others = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("is_eval", "y", "w", "row_hash"))
            for held in (False, True):
                at = np.flatnonzero(is_eval == held)
                if len(at):
                    waiting[held].append([found.take(at, axis=1), *[c[at] for c in others]])
                if sum(len(part[1]) for part in waiting[held]) >= BLOCK_ROWS:
                    yield block(held)
        for held in (False, True):
            if waiting[held]:
                yield block(held)

    return rows.mapInArrow(code, "n int, is_eval boolean, bins binary, y binary, w binary, row_hash binary")


# --------------------------------------------------------------------------------------------------------- trees
class _Flat:
    """Trees as arrays, for numpy: which leaf value or node each row of bins ([feature, row]) reaches."""

    def __init__(self, trees: list[dict[int, Node]], features: list[str], edges: dict[str, list[float]]):
        self.trees, self.tables = [], {}
        for tree in trees:
            ids = sorted(tree)
            at = {n: i for i, n in enumerate(ids)}
            nodes = [tree[n] for n in ids]
            inner = np.array([n.feature is not None for n in nodes])
            self.trees.append((
                np.array(ids), inner, np.array([features.index(n.feature) if n.feature is not None else 0 for n in nodes]),
                np.array([edges[n.feature].index(n.threshold) if n.feature is not None else 0 for n in nodes]),
                np.array([bool(n.missing_left) for n in nodes]), np.array([at.get(n.left, 0) for n in nodes]), np.array([at.get(n.right, 0) for n in nodes]),
                np.array([n.value or 0.0 for n in nodes])))

    def _walk(self, k: int, n: int, goes_left) -> np.ndarray:
        """The node that each of ``n`` rows ends in; ``goes_left`` tells for the nodes where the rows are."""
        inner, left, right = self.trees[k][1], *self.trees[k][5:7]
        at = np.zeros(n, dtype=np.int64)
        while inner[at].any():
            at = np.where(inner[at], np.where(goes_left(at), left[at], right[at]), at)
        return at

    def _table(self, k: int) -> np.ndarray:
        """The node reached, by the outcomes of the tree's tests as the bits of a number."""
        if k not in self.tables:
            inner = self.trees[k][1]
            bit, codes = np.cumsum(inner) - inner, np.arange(1 << int(inner.sum()))
            self.tables[k] = self._walk(k, len(codes), lambda at: codes >> bit[at] & 1 > 0)
        return self.tables[k]

    def reach(self, k: int, bins: np.ndarray, value: np.ndarray) -> np.ndarray:
        """``value`` (one per node of tree ``k``) of the node that each row reaches."""
        _, inner, feature, edge, missing_left, *_ = self.trees[k]
        n, tests = bins.shape[1], np.flatnonzero(inner)
        if not len(tests):
            return np.full(n, value[0])
        if len(tests) > MOST_TESTS:
            rows = np.arange(n)

            def goes_left(at):
                code = bins[feature[at], rows]
                return np.where(code == MISSING, missing_left[at], code <= edge[at])

            return value[self._walk(k, n, goes_left)]
        outcomes = np.zeros((2, n), dtype=np.uint8)
        for i, t in enumerate(tests):
            x, e = bins[feature[t]], int(edge[t])
            # a missing value is 255, beyond every edge; one more makes it 0, below every edge
            test = (x + np.uint8(1) <= e + 1 if missing_left[t] else x <= e).view(np.uint8)
            outcomes[i // 8] |= np.left_shift(test, i % 8, out=test)
        code = outcomes[0] if len(tests) <= 8 else outcomes[1].astype(np.uint16) << np.uint16(8) | outcomes[0]
        return value[self._table(k)].take(code)

    def margins(self, bins: np.ndarray, n: int) -> np.ndarray:
        return sum((self.reach(k, bins, self.trees[k][-1]) for k in range(n)), np.zeros(bins.shape[1]))


def _sampled(row_hash: np.ndarray, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees: a function of the row's hash and the tree's number, so a repeated task sees the same ones."""
    with np.errstate(over="ignore"):
        x = row_hash.view(np.uint64) + np.uint64(tree + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / 2.0 ** 53 < share


def histograms(rows: DataFrame, trees: list[dict[int, Node]], growing: dict[int, Node], open_nodes: list[int], features: list[str],
               edges: dict[str, list[float]], subsample: float) -> tuple[np.ndarray, float | None]:
    """(gradients and hessians as [open node, feature, bin, 2], mean loss of the evaluation rows under ``trees``; None below the root)."""
    done, n_features, slots = len(trees), len(features), len(open_nodes)
    flat = _Flat([*trees, growing] if open_nodes else trees, features, edges)
    # the loss is that of the trees before: the first level tells it
    rows = rows if open_nodes == [0] else rows.where("NOT is_eval" if open_nodes else "is_eval")
    slot_of = np.full(len(flat.trees[done][0]), slots) if open_nodes else None  # the others are finished leaves
    if open_nodes:
        slot_of[np.searchsorted(flat.trees[done][0], open_nodes)] = np.arange(slots)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((slots, n_features, 256, 2))
        loss, weight = 0.0, 0.0
        for batch in batches:
            for i in range(batch.num_rows):
                bins, y, w, row_hash = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=kind)
                                        for c, kind in (("bins", np.uint8), ("y", float), ("w", float), ("row_hash", np.int64)))
                bins = bins.reshape(n_features, len(y))
                if batch.column("is_eval")[i].as_py():
                    margin = flat.margins(bins, done)
                    loss += float((w * np.logaddexp(0, np.where(y > 0, -margin, margin))).sum())
                    weight += float(w.sum())
                    continue
                slot = flat.reach(done, bins, slot_of)
                use = np.flatnonzero(_sampled(row_hash, done, subsample) & (slot < slots))
                if not len(use):
                    continue
                bins, y, w, slot = bins.take(use, axis=1), y[use], w[use], slot[use] * 256
                p = 1 / (1 + np.exp(-flat.margins(bins, done)))
                g, h = w * (p - y), w * p * (1 - p)
                for f in range(n_features):
                    at = slot + bins[f]
                    for k, value in enumerate((g, h)):
                        total[:, f, :, k] += np.bincount(at, value, minlength=slots * 256).reshape(slots, 256)
        at = np.flatnonzero(total[..., 1].ravel())
        values = total.reshape(-1, 2)[at]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(values[:, 0], loss)), pa.array(np.append(values[:, 1], weight))], names=["at", "g", "h"])

    out = np.zeros((slots * n_features * 256, 2))
    loss = None
    for r in rows.mapInArrow(add, "at long, g double, h double").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
        if r.at >= 0:
            out[r.at] = r.g, r.h
        elif r.h:
            loss = r.g / r.h
    return out.reshape(slots, n_features, 256, 2), loss


def _shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def best_split(sums: np.ndarray, edges: list[list[float]], l1: float, l2: float, min_child: float) -> tuple | None:
    """(feature, edge, missing left, gain, (G, H) left, (G, H) right) of a node's histogram [feature, bin, 2]; None if no split gains.

    Gains within a part in 10^9 of the best are ties (sums differ in their last bits by the order of partitions): the first feature, then the
    lowest edge, then missing values to the left.
    """
    total = sums[0].sum(axis=0)

    def score(s):
        return _shrunk(s[..., 0], l1) ** 2 / np.maximum(s[..., 1] + l2, 1e-300)

    found = []
    for f, own in enumerate(edges):
        if not own:
            continue
        below, missing = np.cumsum(sums[f, :len(own)], axis=0), sums[f, MISSING]
        for missing_left in (True, False):
            left = below + missing if missing_left else below
            right = total - left
            gain = score(left) + score(right) - score(total)
            gain[(left[:, 1] < min_child) | (right[:, 1] < min_child) | (np.minimum(left[:, 1], right[:, 1]) <= 1e-12)] = -np.inf
            found += [(f, e, missing_left, float(gain[e]), tuple(left[e]), tuple(right[e])) for e in range(len(own))]
    best = max((x[3] for x in found), default=-np.inf)
    if not best > 1e-9:
        return None
    return min((x for x in found if x[3] >= best * (1 - 1e-9)), key=lambda x: (x[0], x[1], not x[2]))


def fit_boosted_trees(df: DataFrame, features: list[str], label: str, weight: str | None = None, is_eval: str | None = None,
                      row_hash: Column | None = None, edges: dict[str, list[float]] | None = None, **options) -> BoostedTrees:
    """Regularised boosted trees for a label of 0 and 1.

    ``options`` override ``PARAMS``. ``is_eval`` marks rows that are not trained on and whose loss ends the training once it falls by less than
    ``min_rel_progress`` of itself (a tree that raises it is dropped). ``row_hash`` (default: a hash of the features and the label) chooses the
    rows of each tree. ``edges`` replace the quantile cuts. Rows with a null label are left out; without any row there is no tree.
    """
    o = {**PARAMS, **options}
    edges = {f: list(e) for f, e in (edges or quantile_edges(df, features)).items()}
    rows = df.where(F.col(label).isNotNull()).select(
        *features, F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        (F.coalesce(F.col(is_eval), F.lit(False)) if is_eval else F.lit(False)).alias("is_eval"),
        (row_hash if row_hash is not None else F.xxhash64(*features, label)).alias("row_hash"))
    rows = stored(binned(rows, edges), "boosting-rows")
    model, trees = BoostedTrees(list(features), []), []
    for k in range(o["max_iterations"] + 1):
        last = k == o["max_iterations"]
        root = {0: Node(k, 0, value=0.0)}
        sums, loss = histograms(rows, trees, root, [] if last else [0], features, edges, o["subsample"])
        if loss is not None:
            model.losses.append(loss)
            if k and model.losses[-2] - loss < o["min_rel_progress"] * model.losses[-2]:
                if loss > model.losses[-2]:
                    trees.pop()
                break
        if last or not sums.any():
            break
        tree = _grow(rows, trees, root, sums, features, edges, o)
        if len(tree) == 1:
            break
        trees.append(tree)
    model.nodes = [n for tree in trees for _, n in sorted(tree.items())]
    return model


def _grow(rows: DataFrame, trees: list, tree: dict[int, Node], sums: np.ndarray, features: list[str], edges: dict, o: dict) -> dict[int, Node]:
    """One tree, level by level; nodes are numbered like a heap."""
    l1, l2 = o["l1_reg"], o["l2_reg"]
    per_feature = [edges[f] for f in features]
    total = sums[0, 0].sum(axis=0)
    tree[0].cover, tree[0].value = float(total[1]), float(-_shrunk(total[0], l1) / (total[1] + l2) * o["learn_rate"])
    open_nodes = [0]
    for depth in range(o["max_tree_depth"]):
        if depth:
            sums, _ = histograms(rows, trees, tree, open_nodes, features, edges, o["subsample"])
        following = []
        for at, own in zip(open_nodes, sums):
            split = best_split(own, per_feature, l1, l2, o["min_tree_child_weight"])
            if split is None:
                continue
            f, e, missing_left, gain, *sides = split
            n = tree[at]
            n.feature, n.threshold, n.missing_left, n.gain, n.value = features[f], per_feature[f][e], missing_left, gain, None
            n.left, n.right = 2 * at + 1, 2 * at + 2
            for child, (g, h) in zip((n.left, n.right), sides):
                tree[child] = Node(n.tree, child, value=float(-_shrunk(g, l1) / (h + l2) * o["learn_rate"]), cover=float(h))
                following.append(child)
        open_nodes = following
        if not open_nodes:
            break
    return tree


# ---------------------------------------------------------------------------------------------------- churn model
def fit_churn_trees(training: DataFrame, seed: int = 42, features: list[str] = CHURN_FEATURES, **options) -> BoostedTrees:
    """M6. Trees on the 80 % split with inverse-frequency class weights; the other rows end the training."""
    share = options.get("eval_fraction", PARAMS["eval_fraction"])
    df = class_weights(split_train_eval(training, share, seed))
    return fit_boosted_trees(df, features, LABEL, "class_weight", "is_eval", F.xxhash64("cliente_id", "fecha_referencia", F.lit(seed)), **options)


def predict_churn(model: BoostedTrees, scoring: DataFrame) -> DataFrame:
    """M8 + M9. Probability, prediction and risk band of every row."""
    scored = scoring.withColumn("__p", model.probability())
    return churn_predictions(scored, F.col("__p"), F.when(F.col("__p") >= 0.5, 1).otherwise(0))


def evaluation_predictions(model: BoostedTrees, training: DataFrame, eval_fraction: float = PARAMS["eval_fraction"], seed: int = 42) -> DataFrame:
    """The held-out rows of the training split, scored (input of ``reports.evaluate``)."""
    held = split_train_eval(training, eval_fraction, seed).where("is_eval").withColumn("__p", model.probability())
    return held.select(LABEL, F.col("__p").alias(PROB), F.when(F.col("__p") >= 0.5, 1).otherwise(0).cast("long").alias(PRED))


def feature_importance(model: BoostedTrees, spark: SparkSession) -> DataFrame:
    """M13. Per feature: number of splits (weight), mean gain, and mean cover (sum of hessians in the split nodes)."""
    names = spark.createDataFrame([(f,) for f in model.features], "feature string")
    splits = (model.node_table(spark).where("feature IS NOT NULL").groupBy("feature")
              .agg(F.count(F.lit(1)).cast("double").alias("importance_weight"), F.avg("gain").alias("importance_gain"), F.avg("cover").alias("importance_cover")))
    return (names.join(F.broadcast(splits), "feature", "left")  # a row per feature
            .select("feature", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("importance_weight", "importance_gain", "importance_cover")]))


def save_trees(model: BoostedTrees, spark: SparkSession, path: str) -> str:
    model.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    about = [(model.features, [float(x) for x in model.losses])]
    spark.createDataFrame(about, "features array<string>, losses array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    return path


def load_trees(spark: SparkSession, path: str) -> BoostedTrees:
    about = spark.read.parquet(f"{path}/about").first()
    nodes = [Node(**r.asDict()) for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()]  # trees x 2^(depth + 1) at most
    return BoostedTrees(list(about.features), nodes, list(about.losses))
