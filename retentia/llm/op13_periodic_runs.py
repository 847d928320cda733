"""Operator 13, periodic run detection: Baier grouping.

A run is a maximal stretch of words with a smallest period. By the runs theorem every run contains, under one of the two
opposite orders of the alphabet, a Lyndon root that is the longest Lyndon word starting at its place. So both Lyndon arrays
give all candidates, at most two for each word:

1. the first phase of Baier's suffix sorter puts suffixes into groups by their longest Lyndon prefix. Groups are
   handled from the highest to the lowest; the members of a group are complete, so their distance to the next word that is
   still alive is their Lyndon length. They are then folded into the alive word before them, which moves up inside its own
   group, the higher the more equal members were folded into it. No suffix array is needed (``lyndon_array``);
2. the same with the alphabet turned round;
3. every root [i, i + p) is extended to both sides by the longest common extensions of i and i + p (``extension``, compared in
   blocks of growing size), once for each stretch; what is long enough is a run (``runs_of``).

A text is worked on in one task, in linear space; Spark deals texts over tasks and nothing is shuffled. Python sees a text
once, and only runs and the collapsed text come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, table

#: Words that a run has at least; it also holds its period twice.
LEAST = 12
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
RUN = "struct<start: long, length: long, period: long>"
_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
#: Most words compared beside all roots at once, before any extension is computed.
_NEAR = 3


def lyndon_array(codes: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place, by phase one of Baier's suffix sorter.

    ``at`` lists the suffixes by group, lowest group first; a group is named by its first place in ``at``. ``before`` and
    ``after`` link the words that are alive, that is, not folded into one before them.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    first = np.flatnonzero(np.diff(codes[order], prepend=codes[order[0]] - 1))
    sizes = np.diff(np.append(first, n))
    by_place = np.empty((2, n), dtype=np.int64)
    by_place[0, order], by_place[1, order] = np.repeat(first, sizes), np.arange(n)
    group, place = by_place.tolist()
    size = np.zeros(n, dtype=np.int64)
    size[first] = sizes
    size, at = size.tolist(), order.tolist()
    before, after, length = list(range(-1, n)), list(range(1, n + 2)), [0] * n  # place -1 is a dummy at the end of after
    top = n - 1
    while top >= 0:
        s = at[top]
        g = group[s]
        if g == top:  # a group of one
            p, t = before[s], after[s]
            length[s] = t - s
            after[p], before[t] = t, p
            top -= 1
            if p >= 0:
                gp = group[p]
                left = size[gp] - 1
                if left:  # p becomes a group of its own above the others
                    size[gp] = left
                    last, here = gp + left, place[p]
                    q = at[last]
                    at[here], at[last] = q, p
                    place[q], place[p] = here, last
                    group[p], size[last] = last, 1
            continue
        # adjacent members are folded together into the word before them
        folds: dict[int, list[int]] = {}
        root = count = -1
        end = None
        for s in sorted(at[g:top + 1]):
            p, t = before[s], after[s]
            length[s] = t - s
            if end == s:
                count += 1
            else:
                if end is not None:
                    after[root], before[end] = end, root
                    folds.setdefault(count, []).append(root)
                root, count = p, 1
            end = t
        after[root], before[end] = end, root
        folds.setdefault(count, []).append(root)
        for count in sorted(folds, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in folds[count]:
                if p >= 0:
                    gp = group[p]
                    size[gp] = left = size[gp] - 1
                    last, here = gp + left, place[p]
                    q = at[last]
                    at[here], at[last] = q, p
                    place[q], place[p] = here, last
                    moved.setdefault(gp, []).append(p)
            for gp, members in moved.items():
                new = gp + size[gp]
                size[new] = len(members)
                for p in members:
                    group[p] = new
        top = g - 1
    return np.array(length, dtype=np.int64)


def extension(a: np.ndarray, x: int, y: int) -> int:
    """How many words from x and from y > x on are equal."""
    k, step, most = 0, 16, len(a) - y
    while k < most:
        m = min(step, most - k)
        differ = a[x + k:x + k + m] != a[y + k:y + k + m]
        if differ.any():
            return k + int(differ.argmax())
        k += m
        step *= 4
    return most


def runs_of(codes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` words and two periods, by start, then period."""
    n = len(codes)
    least = max(least, 2)
    if n < least:
        return []
    turned = codes[::-1].copy()
    # out of reach: -1 before the words, -2 behind them
    reach = np.concatenate([np.full(_NEAR, -1), codes, np.full(_NEAR, -2)])
    near = min(_NEAR, (least + 3) // 4)  # beside one side of the root at least so many words are equal
    found = set()
    for code in (codes, codes.max() - codes):
        length = lyndon_array(code)
        i = np.arange(n)
        right, left = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        for k in range(near):
            right &= reach[i + _NEAR + k] == reach[i + length + _NEAR + k]
            left &= reach[i + _NEAR - 1 - k] == reach[i + length + _NEAR - 1 - k]
        at = np.flatnonzero(right | left)
        covered: dict[int, int] = {}  # period: end of the last stretch with it
        for s, p in zip(at.tolist(), length[at].tolist()):
            if s + p <= covered.get(p, 0):
                continue
            stop = s + p + extension(codes, s, s + p)
            start = s - extension(turned, n - s - p, n - s) if s else 0
            covered[p] = stop
            if stop - start >= max(least, 2 * p):
                found.add((start, stop - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    ``collapsed``: the words outside repetitions, joined by one blank; a run keeps its first period. Words lie between ASCII white
    space. Null, empty and wordless texts have no words, no runs and an empty collapsed text. Repeated rows and null ids are kept,
    an empty table gives no rows, other columns are ignored whatever their names.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    @F.arrow_udf(f"struct<n_words: long, runs: array<{RUN}>, collapsed: string>")
    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts, every, texts = [], [], []
            for text in batch:  # one text at a time
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                number = {w: i for i, w in enumerate(dict.fromkeys(words))}
                runs = runs_of(np.array([number[w] for w in words], dtype=np.int64), least)
                counts.append(len(words))
                every.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                if runs:
                    words = [w for w, r in zip(words, repeated_words(len(words), runs).tolist()) if not r]
                texts.append(b" ".join(words))
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(every, _RUNS), pa.array(texts, pa.binary()).view(pa.string())], names=["n_words", "runs", "collapsed"])

    return rows.select("doc_id", detect("text").alias("r")).select("doc_id", "r.*")


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with repetitions planted into every tenth document by the checksum of its id; the others stay as they are.

    With h the checksum, n the words, g = h div 10, a = g mod n and p = 1 + (n - a) div (3 + g mod 8), every word from a on becomes the
    word a + (i - a) mod p. A null id has no checksum.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.when(h % 10 == 0, F.filter(F.split(F.col(text_col).cast("string"), WORD_BREAK, -1), lambda w: w != ""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))

    def word(i: Column) -> Column:
        return F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))

    planted = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(plant(table(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("shorter"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length = -F.col("b.shorter")
    return rows.select("doc_id", "n_runs", F.col("b.start").alias("start"), length.alias("length"), F.col("b.period").alias("period"),
                       F.expr("-1000 * b.shorter div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
