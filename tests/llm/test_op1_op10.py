import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from retentia.llm import op1_toxicity as T
from retentia.llm import op10_lm_scoring as L
from tests.llm import brute
from tests.llm.helpers import CLASHES, documents, write


def sentence(rng, n, words):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(words)}" for _ in range(n))


def toxic_corpus(n=3000, seed=1):
    rng = random.Random(seed)
    bad = ["vile", "scumbag", "idiotic", "lowlife"]
    rows, labels = [], []
    for d in range(n):
        w = sentence(rng, rng.randint(5, 200), 300).split(" ")
        toxic = rng.random() < 0.1
        for _ in range(rng.randint(2, 5) * toxic):
            w.insert(rng.randrange(len(w) + 1), rng.choice(bad))
        rows.append((d, " ".join(w)))
        if rng.random() < 0.5:
            labels.append((d, 1, int(toxic)))
        rows[-1] += (toxic,)
    return rows, labels


def auc(scores, truth):
    order = np.argsort(np.argsort(scores, kind="stable"))
    t = np.array(truth, dtype=bool)
    return (order[t].mean() - (t.sum() - 1) / 2) / (~t).sum()


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    docs = documents(spark, [r[:2] for r in rows], CLASHES + " toxic bag positive f")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in T.score_documents(docs, lab).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert {d for d, r in got.items() if r.held_out} == {r[0] for r in held}
    assert auc([got[r[0]].score for r in held], [r[2] for r in held]) > 0.97
    assert sum(got[r[0]].predicted == r[2] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_are_never_used(spark):
    rows, labels = toxic_corpus(800)
    docs = documents(spark, [r[:2] for r in rows])
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    a, b = (T.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert a == b


def test_risk_is_corrected():
    """With the prior, unlabelled positives don't turn the classifier against their words."""
    rng = np.random.default_rng(0)
    bad = [np.array(sorted({1, *rng.integers(10, 200, 5)}), dtype=np.int32) for _ in range(200)]
    good = [np.array(sorted(rng.integers(10, 200, 5)), dtype=np.int32) for _ in range(800)]
    kept, w, bias = T.train(bad[:100], bad[100:] + good, prior=0.1)
    assert w[list(kept).index(1)] + bias > 0 > bias


def test_toxicity_edge_cases(spark, tmp_path):
    rows = [(1, None), (1, ""), (None, "x"), (2, "word " * 100_000), (3, "퟿ \0 é")]
    docs = documents(spark, rows)
    none = spark.createDataFrame([(1, 1, None), (None, None, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, none.limit(0)):
        got = T.score_documents(docs, labels).collect()
        assert len(got) == 5 and all(0 <= r.score < 0.5 and r.predicted == 0 for r in got)
        assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert T.query(spark, write(tmp_path, documents=docs.limit(0), labels=none)).count() == 0


def test_lm_scores_prefer_the_target(spark, tmp_path):
    rng = random.Random(4)
    rows = [(d, sentence(rng, 30, 4) if d % 2 else sentence(rng, 30, 400)) for d in range(300)]
    got = L.score_documents(documents(spark, rows), spark.range(1, 100, 2).withColumnRenamed("id", "doc_id")).collect()
    rest = [r for r in got if r.doc_id >= 100]
    assert auc([-r.score for r in rest], [r.doc_id % 2 for r in rest]) > 0.99
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert L.query(spark, write(tmp_path, documents=documents(spark, rows).limit(0), labels=labels)).count() == 0
    nothing = L.query(spark, write(tmp_path / "n", documents=documents(spark, rows), labels=labels.limit(0)))
    assert nothing.count() == 300


@pytest.mark.parametrize("most", [1 << 20, 5])
def test_lm_models_are_not_capped(spark, monkeypatch, most):
    """More words than 2^16 and every bigram counted by itself; ``most`` 5: nearly all bigrams go the way of the rare ones."""
    rng = random.Random(5)
    rows = [(d, sentence(rng, rng.randrange(40), 6 if d % 4 else 30)) for d in range(200)]
    rows += [(300, None), (301, ""), (302, " \t"), (303, "\u00c9 \u00e9 A b\nA\x0bb"), (304, "a1 " * 3_000), (None, "a1 b2"), (305, "a1"), (305, "a1"), (306, "once")]
    rows += [(1000 + d, " ".join(f"{w}" for i in range(700) for w in (f"v{700 * (d // 2) + i}",) * (1 + i % 2))) for d in range(200)]
    target = [0, 4, 8, 12, 16, 16, 303, None, 999, 1000, 1001]
    default = L.text_losses
    monkeypatch.setattr(L, "text_losses", lambda texts, losses: default(texts, losses, most))
    got = L.score_documents(documents(spark, rows, CLASHES), spark.createDataFrame([(t,) for t in target], "doc_id long")).collect()
    texts = [(d, brute.words((t or "").translate(brute.LOWER))) for d, t in rows]
    counts = Counter(w for _, ws in texts for w in ws)
    vocabulary = {w for w in counts if counts[w] > 1}
    assert len(vocabulary) > 1 << 16 > 0 < len(counts) - len(vocabulary)
    models = []
    for chosen in (texts, [x for x in texts if x[0] in set(target) - {None}]):
        uni, ctx, bi = Counter(), Counter(), Counter()
        for _, ws in chosen:
            ids = [w if w in vocabulary else "" for w in ws]
            uni.update(ids)
            ctx.update([None, *ids][:len(ids)])
            bi.update(zip([None, *ids], ids))
        models.append((uni, ctx, bi, sum(uni.values())))
    want = {}
    for d, ws in texts:
        ids = [w if w in vocabulary else "" for w in ws]
        row = [len(ws)]
        for uni, ctx, bi, n in reversed(models):
            loss = sum(-math.log((bi[h, w] + L.MU * (uni[w] + 1) / (n + len(vocabulary) + 2)) / (ctx[h] + L.MU)) for h, w in zip([None, *ids], ids))
            row.append(loss / len(ws) if ws else 0.0)
        want[d] = row
    assert len(got) == len(rows)
    for r in got:
        assert r.n_tokens == want[r.doc_id][0]
        assert [r.loss_target, r.loss_background] == pytest.approx(want[r.doc_id][1:], abs=1e-8)


@pytest.mark.parametrize("words,bits", [(0, 27), (3, 27), (40, 27), (40, 6)])
def test_lm_losses_don_t_depend_on_what_is_sent_out(spark, monkeypatch, words, bits):
    """Few or no numbered words, and a filter so small that it is full: the joins give the same losses."""
    rng = random.Random(6)
    rows = [(d, sentence(rng, rng.randrange(60), 4 if d % 3 else 40)) for d in range(150)] + [(400 + d, "a1 b2 once%d a1 b2 c3" % d) for d in range(3)]
    rows += [(500 + d, "copied words b2 c3 copied words") for d in range(4)] + [(None, "a1 b2"), (600, None), (601, " ")]
    docs, target = documents(spark, rows), spark.createDataFrame([(t,) for t in (0, 3, 6, 400, 500, 501)], "doc_id long")
    whole = Counter((r.doc_id, r.n_tokens, round(r.loss_target, 8), round(r.loss_background, 8)) for r in L.score_documents(docs, target).collect())
    monkeypatch.setattr(L, "FREQUENT_WORDS", words)
    monkeypatch.setattr(L, "FILTER_BITS", bits)
    default = L.text_losses
    monkeypatch.setattr(L, "text_losses", lambda texts, model: default(texts, model, 10))
    got = Counter((r.doc_id, r.n_tokens, round(r.loss_target, 8), round(r.loss_background, 8)) for r in L.score_documents(docs, target).collect())
    assert got == whole and sum(got.values()) == len(rows)


@pytest.mark.parametrize("tokens,bits", [(4 << 20, 27), (64, 27), (64, 0)])
def test_lm_numbered_bigrams_stay_with_their_texts(spark, monkeypatch, tokens, bits):
    """Bigrams of numbered words are counted where their texts' shares meet, in one bucket or many; what is stored of them grows with the texts alone."""
    rng = random.Random(9)
    rows = [(d, sentence(rng, 300, 12)) for d in range(60)] + [(100, "a1 " * 50), (101, "a1 " * 50), (102, "a1 " * 50), (103, None), (104, "b2")]
    target, most = {0, 1, 2, 100, 103}, 9
    monkeypatch.setattr(L, "BUCKET_TOKENS", tokens)
    monkeypatch.setattr(L, "FILTER_BITS", bits)
    stored, default, store = {}, L.text_losses, L.store

    def watched(df, name):
        stored[name] = store(df, name)
        return stored[name]

    monkeypatch.setattr(L, "store", watched)
    monkeypatch.setattr(L, "text_losses", lambda texts, model: default(texts, model, most))
    got = L.score_documents(documents(spark, rows), spark.createDataFrame([(t,) for t in target], "doc_id long")).collect()
    sizes = {name: df.count() for name, df in stored.items()}
    assert sum(n for name, n in sizes.items() if name not in ("lm-words", "lm-target")) <= 3 * len(rows) + most
    texts = [(d, (t or "").split()) for d, t in rows]
    chosen = [Counter(p for d, ws in texts if d in own for p in zip([None, *ws], ws)) for own in ({d for d, _ in texts}, target)]
    assert len(chosen[0]) > 10 * len(rows)
    counted = {(r.x, r.y) for r in stored["lm-numbered"].where("counted").collect()}
    assert 0 < len(counted) <= most and counted <= {(chosen[1][p], n) for p, n in chosen[0].items()}
    vocabulary = Counter(w for _, ws in texts for w in ws)
    assert min(vocabulary.values()) >= L.MIN_COUNT
    for r, (d, ws) in zip(sorted(got, key=lambda r: r.doc_id), texts):
        for loss, pairs in ((r.loss_background, chosen[0]), (r.loss_target, chosen[1])):
            uni, context = Counter(), Counter()
            for (h, w), n in pairs.items():
                uni[w] += n
                context[h] += n
            size = sum(uni.values()) + len(vocabulary) + 2
            want = [-math.log((pairs[h, w] + L.MU * (uni[w] + 1) / size) / (context[h] + L.MU)) for h, w in zip([None, *ws], ws)]
            assert r.doc_id == d and loss == pytest.approx(sum(want) / len(ws) if ws else 0.0, abs=1e-8)


def test_lm_packed_numbers():
    for values in ([0], [5, -3, 2 ** 62, -2 ** 62], list(range(1000)), [0] * 70_000):
        assert L._unpacked(L._packed(np.array(values)), len(values)).tolist() == values


def test_lm_words_of_sliced_arrays():
    a = pa.array(["zero one", None, "Two  THREE", "", "four"])
    words, starts = L.split_words(a.slice(1, 3))
    assert words.to_pylist() == ["two", "three"] and starts.tolist() == [0, 0, 2, 2]
    many = pa.array([f"x{i} y{i} " * (i % 5) for i in range(40)])
    assert L.split_words(many.slice(10, 20))[0].to_pylist() == " ".join(many.to_pylist()[10:30]).split()
    batch = pa.RecordBatch.from_arrays([pa.array([f"a{i} b{i}" for i in range(9)] + [None])], names=["text"])
    assert sum((L.split_words(b.column(0))[0].to_pylist() for b in L._pieces([batch.slice(3)])), []) == [f"{c}{i}" for i in range(3, 9) for c in "ab"]


def test_lm_word_hashes():
    """A word's hash depends on its bytes alone, wherever it stands; no two of many words share one."""
    words = ["", "a", "aa", "a" * 8, "a" * 9, "a" * 16, "\0", "\0\0", "a\0", "\u00e9", "x" * 255, "x" * 256, "x" * 257, "x" * 100_000 + "y", "x" * 100_000 + "z"]
    words += [f"w{i}" for i in range(50_000)] + [f"a longer word {i} with an end" for i in range(50_000)]
    column = pa.array(words, pa.large_string()).cast(pa.large_binary())
    hashes = L.word_hashes(column)
    assert hashes.dtype == np.int64 and len(set(hashes.tolist())) == len(words)
    order = random.Random(8).sample(range(len(words)), 3_000)
    assert L.word_hashes(column.take(pa.array(order))).tolist() == hashes[order].tolist()
    assert L.word_hashes(column.slice(3, 40)).tolist() == hashes[3:43].tolist()
    assert L.word_hashes(column.slice(0, 0)).tolist() == [] == L.word_hashes(pa.array([], pa.large_binary())).tolist()


def plain_train(positive, unlabelled, prior):
    """nnPU by loops over documents; also how often the second part of the risk was negative."""
    n_p, n_u = len(positive), len(unlabelled)
    kept = []
    for f in sorted({int(f) for d in positive for f in d}):
        a, b = sum(f in d for d in positive), sum(f in d for d in unlabelled)
        share = (a + b) / (n_p + n_u)
        error = math.sqrt(max(share * (1 - share), 1e-9) * (1 / n_p + 1 / n_u))
        if (a / n_p - b / n_u) / error > T.MIN_Z and a >= max(3, 0.004 * n_p):
            kept.append(f)
    w = {f: 0.0 for f in [*kept, -1]}  # -1: the bias
    mean, square, below = dict.fromkeys(w, 0.0), dict.fromkeys(w, 0.0), 0
    docs_p, docs_u = ([[f for f in d if f in w] + [-1] for d in docs] for docs in (positive, unlabelled))
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    for step in range(1, T.STEPS + 1):
        g_p, g_u = ([sum(w[f] for f in d) for d in docs] for docs in (docs_p, docs_u))
        second = sum(math.log1p(math.exp(g)) for g in g_u) / n_u - prior * sum(math.log1p(math.exp(g)) for g in g_p) / n_p
        slope = {f: T.L2 * v if f >= 0 else 0.0 for f, v in w.items()}
        sign = 1 if second >= 0 else -1  # climb back on the second part alone
        for d, g in zip(docs_p, g_p):
            own = -sign * prior * sigmoid(g) / n_p - (prior * sigmoid(-g) / n_p if second >= 0 else 0)
            for f in d:
                slope[f] += own
        for d, g in zip(docs_u, g_u):
            for f in d:
                slope[f] += sign * sigmoid(g) / n_u
        below += second < 0
        for f in w:
            mean[f] = 0.9 * mean[f] + 0.1 * slope[f]
            square[f] = 0.999 * square[f] + 0.001 * slope[f] ** 2
            w[f] -= T.RATE * mean[f] / (1 - 0.9 ** step) / (math.sqrt(square[f] / (1 - 0.999 ** step)) + 1e-8)
    return kept, [w[f] for f in kept], w[-1], below


@pytest.mark.parametrize("prior,every,negative", [(0.02, 5, False), (0.8, 5, True), (0.1, 40, True)])
def test_training_matches_a_plain_version(prior, every, negative):
    """Both branches: with a prior above the share of U that looks toxic (one in ``every``), the corrected part becomes negative."""
    rng = np.random.default_rng(3)
    positive = [np.array(sorted({int(rng.integers(1, 4)), *rng.integers(10, 40, 4).tolist()}), dtype=np.int32) for _ in range(120)]
    other = [np.array(sorted({*([1 + i % 3] if i % every == 0 else []), *rng.integers(10, 40, 4).tolist()}), dtype=np.int32) for i in range(300)]
    kept, w, bias, below = plain_train([set(d.tolist()) for d in positive], [set(d.tolist()) for d in other], prior)
    assert (below > 0) == negative and len(kept) >= 2
    got = T.train(positive, other, prior)
    assert got[0].tolist() == kept
    assert [*got[1], got[2]] == pytest.approx([*w, bias], abs=1e-6)


def test_toxicity_of_repeated_rows(spark):
    rows, labels = toxic_corpus(600)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = T.score_documents(documents(spark, [r[:2] for r in rows] * 2), lab).collect()
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id, []).append((r.held_out, r.score, r.predicted))
    assert all(len(s) == 2 and s[0] == s[1] for s in scores.values()) and len(scores) == 600
