import hashlib
import random
import zlib

import numpy as np
import pytest

from retentia.llm import op13_periodic_runs as R
from tests.llm import brute
from tests.llm.helpers import CLASHES, documents, write


def plain_lyndon(w):
    return [next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w)) - i for i in range(len(w))]


def plain_runs(w, least=12):
    """Every maximal stretch of every period, kept if no smaller period fits it."""
    found = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            s = w[i:j + p]
            if len(s) >= max(least, 2 * p) and not any(s[q:] == s[:-q] for q in range(1, p)):
                found.append((i, len(s), p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The query's columns by the words of its contract."""
    w = brute.words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if w and h is not None and h % 10 == 0:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    kept = [x for i, x in enumerate(w) if not any(s + p <= i < s + n for s, n, p in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(kept)))


def repetitive(rng):
    n, k = rng.randrange(1, 70), rng.choice([1, 2, 2, 3, 5])
    w = [rng.randrange(k) for _ in range(n)]
    if rng.random() < 0.5:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_lyndon_arrays_and_runs_match_plain_versions():
    rng = random.Random(0)
    for _ in range(1500):
        w = repetitive(rng)
        a = np.array(w)
        assert R.lyndon_array(a).tolist() == plain_lyndon(w)
        for least in (2, 5, 12, 15):
            assert R.runs_of(a, least) == plain_runs(w, least), w
    assert R.runs_of(np.array([], dtype=np.int64)) == []


@pytest.mark.parametrize("unit", [[0], [0, 1], list(range(7)), [0, 1, 0]])
def test_long_repetitions(unit):
    n = 60_000
    a = np.array((unit * (n // len(unit) + 1))[:n] + [9])
    assert (0, n, len(unit)) in R.runs_of(a, 12)


def test_query_matches_the_plain_version(spark, tmp_path):
    rng = random.Random(1)
    rows = [(d, " ".join(f"w{x}" for x in repetitive(rng))) for d in range(400)]
    rows += [(400 + d, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(200)))) for d in range(200)]
    rows += [(700, None), (701, ""), (702, " \t\n"), (None, "a " * 30), (None, None), (703, "É é\x0bb \x00c " * 9), (703, "É é\x0bb \x00c " * 9), (704, "a b " * 12), (705, "x " * 2_000)]
    got = R.query(spark, write(tmp_path, documents=documents(spark, rows, CLASHES + " runs collapsed g a r b best")))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.dtypes[1:6] == [(c, "bigint") for c in got.columns[1:6]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(plain_row(*r)) for r in rows)
    assert R.query(spark, write(tmp_path / "e", documents=documents(spark, rows).limit(0))).count() == 0


def test_query_on_the_generated_texts(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, R.query(spark, sf).collect()))) == sorted(str(plain_row(*r)) for r in rows)


def test_operator_returns_runs_and_collapsed_texts(spark):
    text = "so it was " + "very " * 14 + "good"
    row = R.find_runs(documents(spark, [(1, text)])).first()
    assert [tuple(r) for r in row.runs] == [(3, 14, 1)] and row.n_words == 18 and row.collapsed == "so it was very good"
    assert R.find_runs(documents(spark, [(1, text)]), least=15).first().collapsed == text
