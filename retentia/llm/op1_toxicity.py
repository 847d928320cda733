"""Operator 1, toxicity: non-negative positive-unlabelled (nnPU) learning.

Confirmed toxic documents (P) and unlabelled documents (U) train numpy classifiers; labels that say "not toxic" are not used
as examples. With class prior pi and logistic loss l the risk is

    pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)]),

and while the second part is negative the step goes against it. The prior is a parameter; by default it is the share of
toxic rows among the labelled training rows.

A document is the set of its words (A-Z lower-cased, punctuation stripped) and of their first four and five bytes,
hashed. Each classifier keeps the features that are more frequent in P than in U by ``min_z`` standard errors (4096 at
most, the strongest) and learns weights for them. Classifiers are trained in Spark tasks, one per bag of U; their weights are averaged.

P and U are hash samples of at most about ``max_positive`` and ``max_unlabelled`` documents of the training rows (crc32 of
the id as text, mod 5, is not 0), so training doesn't grow with the corpus. Scoring covers every whole text where
it is stored; no document is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import ASCII_LOWER, bounded_batches, table

MAX_POSITIVE = 8000
MAX_UNLABELLED = 16000
BAGS = 2
DIMENSIONS = 1 << 20
MAX_FEATURES = 4096
MIN_Z = 5.0
STEPS = 250
RATE = 0.05
L2 = 1e-4
PUNCTUATION = b".,;:!?\"'()[]"
MAX_CACHED = 500_000


def fold(doc_id: Column) -> Column:
    """0 for held-out rows, 1 to 4 for training rows; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def word_features(word: bytes) -> list[int]:
    """Hashed features of one word: itself and its beginnings."""
    found = [word] + [b"<" + word[:n] for n in (4, 5) if len(word) > n]
    return [xxhash.xxh32_intdigest(f) % DIMENSIONS for f in found]


def words_of(text: str | None) -> set[bytes]:
    return {w.strip(PUNCTUATION) for w in (text or "").encode().translate(ASCII_LOWER).split()} - {b""}


def features(text: str | None) -> np.ndarray:
    return np.array(sorted({f for w in words_of(text) for f in word_features(w)}), dtype=np.int32)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature numbers, weights, bias) of one classifier."""
    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.zeros(0, np.int32), *rows]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    (pf, pr), (uf, ur) = flat(positive), flat(unlabelled)
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    in_p, in_u = np.bincount(pf, minlength=DIMENSIONS), np.bincount(uf, minlength=DIMENSIONS)
    both = (in_p + in_u) / (n_p + n_u)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / n_p + 1 / n_u))
    kept = np.flatnonzero((z > MIN_Z) & (in_p >= max(3, 0.004 * n_p)))
    kept = np.sort(kept[np.argsort(-z[kept], kind="stable")][:MAX_FEATURES])
    number = np.full(DIMENSIONS, -1)
    number[kept] = np.arange(len(kept))
    (pf, pr), (uf, ur) = ((number[f][number[f] >= 0], r[number[f] >= 0]) for f, r in ((pf, pr), (uf, ur)))
    w, bias = np.zeros(len(kept)), 0.0
    mean, square = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    for step in range(1, STEPS + 1):
        g_p = np.bincount(pr, weights=w[pf], minlength=n_p)[:n_p] + bias
        g_u = np.bincount(ur, weights=w[uf], minlength=n_u)[:n_u] + bias
        negative = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        if negative >= 0:
            c_p, c_u = -prior * (sigmoid(-g_p) + sigmoid(g_p)) / n_p, sigmoid(g_u) / n_u
        else:  # climb back on the part that must not be negative
            c_p, c_u = prior * sigmoid(g_p) / n_p, -sigmoid(g_u) / n_u
        slope = np.bincount(pf, weights=c_p[pr], minlength=len(kept)) + np.bincount(uf, weights=c_u[ur], minlength=len(kept)) + L2 * w
        slope = np.append(slope, c_p.sum() + c_u.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope ** 2  # Adam
        move = RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return kept, w, float(bias)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float | None = None,
        max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, bags: int = BAGS) -> tuple[dict[int, float], float]:
    """(weight by feature, bias). Without confirmed toxic training rows: no weights, and the prior's log odds as bias."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    prior = prior if prior is not None else toxic / n if n else 0.0
    prior = min(max(prior, 1e-4), 0.9)
    if not toxic:
        return {}, float(np.log(prior / (1 - prior)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(fold(F.col("doc_id")) != 0)

    def sample(df: DataFrame, size: int, most: int) -> DataFrame:
        """Rows whose id's hash falls below the rate that gives ``most`` rows."""
        return df if size <= most else df.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 24)) < int((1 << 24) * most / size))

    ids = sample(known.where("toxic = 1").select("doc_id").distinct(), toxic, max_positive)
    p = rows.join(F.broadcast(ids), "doc_id").withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(bags - 1)))).withColumn("positive", F.lit(True))
    u = sample(rows, rows.select("doc_id").count(), max_unlabelled)
    u = u.withColumn("bag", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(bags)).cast("int")).withColumn("positive", F.lit(False))

    @F.pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(features)

    def train_bag(group: pd.DataFrame) -> pd.DataFrame:
        kept, w, bias = train(list(group.loc[group["positive"], "f"]), list(group.loc[~group["positive"], "f"]), prior)
        return pd.DataFrame({"feature": np.append(kept, -1), "weight": np.append(w, bias)})

    both = p.select("bag", "positive", "text").union(u.select("bag", "positive", "text"))
    trained = both.select("bag", "positive", hashed("text").alias("f")).groupBy("bag").applyInPandas(train_bag, "feature long, weight double")
    mean = {r.feature: r.w / bags for r in trained.groupBy("feature").agg(F.sum("weight").alias("w")).collect()}  # bags x 4097 rows at most
    bias = mean.pop(-1)
    return mean, bias


def score_column(text: Column, weights: dict[int, float], bias: float) -> Column:
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[bytes, tuple] = {}  # word -> its features that have a weight
        for texts in batches:
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                found: set[int] = set()
                for w in words_of(text):
                    own = known.get(w)
                    if own is None:
                        if len(known) > MAX_CACHED:
                            known.clear()
                        own = known[w] = tuple(f for f in word_features(w) if f in weights)
                    found.update(own)
                out[i] = bias + sum(weights[f] for f in sorted(found))
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -700, 700))))

    return run(text.cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= 0.5).

    Null and empty texts have no features and get the bias alone; repeated rows score alike; a null id is held out; an
    empty table gives no rows. Columns other than id and text are never read.
    """
    bounded_batches(docs.sparkSession)
    weights, bias = fit(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), (fold(F.col(id_col)) == 0).alias("held_out"),
                       score_column(F.col(text_col), weights, bias).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
