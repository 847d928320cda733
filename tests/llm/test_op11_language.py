import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from retentia.llm import op11_language_id as L
from tests.llm.helpers import CLASHES, documents, write


def plain_grams(text, lengths=(3, 4)):
    words = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower()).split(" ")
    return {f" {w} "[i:i + n] for w in words if w for n in lengths for i in range(len(w) + 3 - n)}


def learnt(rows, share=L.SHARE):
    """rows: (doc_id, text, lang) -> {lang: grams}, without filters."""
    n, counts = Counter(), defaultdict(Counter)
    for d, text, lang in rows:
        if lang is not None and d is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            n[lang] += 1
            counts[lang].update(plain_grams(text))
    return {lang: {g for g, c in counts[lang].items() if c >= max(2, share * n[lang])} for lang in n}, n


def plain(rows):
    """{doc_id: (language, score)} by exact sets."""
    sets, n = learnt(rows)
    out = {}
    for d, text, _ in rows:
        if not any(unicodedata.category(c)[0] == "L" for c in text or "") or not sets:
            out[d] = "und", 0.0
            continue
        hits = sorted(((len(plain_grams(text) & sets[x]), x) for x in sets), key=lambda h: (-h[0], h[1]))
        if not hits[0][0]:
            out[d] = max(sorted(n), key=n.__getitem__), 0.0
        else:
            out[d] = hits[0][1], hits[0][0] / (hits[0][0] + sum(h for h, _ in hits[1:2]))
    return out


def table(spark, rows, extra=""):
    names = extra.split()
    return spark.createDataFrame([r + ("x",) * len(names) for r in rows], "doc_id long, text string, lang string" + "".join(f", `{c}` string" for c in names))


SYLLABLES = {"aa": "ka mo ri tu", "bb": "ka sel ün dra", "cc": "жо ри ка лу", "dd": "क मि लु ता"}


def corpus(rng, n):
    return [(d, " ".join("".join(rng.choice(SYLLABLES[x].split()) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 40))).capitalize() + rng.choice(".!? "), x)
            for d in range(n) for x in [rng.choice(list(SYLLABLES))]]


def test_grams_match_the_plain_version():
    rng = random.Random(0)
    texts = ["".join(rng.choice("abÄé क़ि́ 1.\n'x") for _ in range(rng.randrange(30))) for _ in range(300)] + [None, "", " ", "İstanbul", "a", "ab", "\U0001F600 \U00020000x", "ß\0ß"]
    for lengths in ((3, 4), (4,), (3, 5)):
        grams, letters = L.letter_grams(texts, lengths)
        assert [len(g) for g in grams] == [len(plain_grams(t, lengths)) for t in texts]
        assert letters.tolist() == [any(unicodedata.category(c)[0] == "L" for c in t or "") for t in texts]
        one_by_one = [L.letter_grams([t], lengths)[0][0].tolist() for t in texts]
        assert [g.tolist() for g in grams] == one_by_one
    assert L.letter_grams([])[0] == []


def test_predictions_match_exact_sets(spark):
    rng = random.Random(1)
    rows = corpus(rng, 600) + [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !", None), (1003, "zzz", None), (1004, "kamo", None), (1005, "kamo", None), (1006, "ри " * 30_000, "cc")]
    got = {r.doc_id: r for r in L.identify(table(spark, rows, CLASHES + " gram part mask"), L.fit(table(spark, rows).where(~L.held_out(L.F.col("doc_id"))))).collect()}
    want = plain(rows)
    assert {d: r.lang_pred for d, r in got.items()} == {d: w[0] for d, w in want.items()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and abs(r.score - want[d][1]) < 0.05 for d, r in got.items())
    assert got[1000].lang_pred == got[1002].lang_pred == "und" and got[1003].score == 0


def test_filters_contain_every_gram_and_few_others(spark):
    rng = random.Random(2)
    names = [f"l{i:03d}" for i in range(150)]  # more than two masks of 64
    rows = [(i, f"{chr(0x4E00 + 40 * (i % 150))}{chr(0x4E00 + 40 * (i % 150) + rng.randrange(9))}{chr(0x4E00 + i % 150)}", names[i % 150]) for i in range(1500)]
    filters = L.fit(table(spark, rows))
    assert filters.languages == names and filters.masks.shape[0] == 3
    counts = defaultdict(Counter)
    for _, t, lang in rows:
        counts[lang].update(L.letter_grams([t])[0][0].tolist())
    for i, lang in enumerate(names):
        kept = np.array([g for g, c in counts[lang].items() if c >= 2], dtype=np.uint64)
        assert filters.contained(kept)[:, i].all()
    foreign = filters.contained(np.random.default_rng(0).integers(0, 1 << 63, 20_000).astype(np.uint64))
    assert np.allclose(foreign.mean(0), filters.passing, atol=0.01)


def test_false_positives_are_corrected():
    """A language with a nearly full filter doesn't win by what its filter lets through."""
    rng = np.random.default_rng(1)
    texts = [" ".join("".join(rng.choice(list("abcdefghij"), 4)) for _ in range(100))]
    own = L.letter_grams(texts)[0][0]
    masks = np.zeros((1, 1 << 14), dtype="<u1")
    low, high = own & np.uint64(0xFFFFFFFF), own >> np.uint64(32) | np.uint64(1)
    for k in range(L.HASHES):
        masks[0, (low + np.uint64(k) * high)[: len(own) * 8 // 10] & np.uint64(masks.shape[1] - 1)] |= 1  # contains four fifths
    masks[0, rng.random(1 << 14) < 0.97] |= 2  # contains nothing of the text, but is full
    passing = np.array([(masks[0] & 1).mean(), (masks[0] >> 1 & 1).mean()]) ** L.HASHES
    filters = L.Filters(["own", "noise"], "noise", masks, passing)
    assert filters.contained(own).sum(0)[1] > filters.contained(own).sum(0)[0]
    assert filters.predict(texts, L.LENGTHS)[0] == ["own"]


def test_labels_of_held_out_rows_are_never_used(spark):
    rows = corpus(random.Random(3), 300)
    flipped = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 4 == 2 else x) for d, t, x in rows]
    answers = []
    for data in (rows, flipped):
        docs = table(spark, data)
        answers.append(sorted((r.doc_id, r.lang_pred, r.score) for r in L.identify(docs, L.fit(docs.where(~L.held_out(L.F.col("doc_id"))))).collect()))
    assert answers[0] == answers[1]


def test_edge_cases(spark, tmp_path):
    rows = [(1, None), (1, ""), (None, "x y z"), (2, "word " * 50_000), (2, "word " * 50_000), (3, "퟿ \0 é")]
    docs = documents(spark, rows, CLASHES)
    got = L.query(spark, write(tmp_path / "a", documents=docs)).collect()
    assert len(got) == 6 and {r.lang_pred for r in got if r.doc_id in (2, 3)} == {"en"}
    assert [(r.held_out, r.lang_pred) for r in got if r.doc_id is None] == [(True, "en")]
    assert {(r.lang_pred, r.score) for r in got if r.doc_id == 1} == {("und", 0.0)}
    unlabelled = docs.withColumn("lang", L.F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.query(spark, write(tmp_path / "b", documents=unlabelled)).collect()} == {"und"}
    assert L.query(spark, write(tmp_path / "c", documents=docs.limit(0))).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, sf):
    path = f"/root/testdata/{sf}"
    truth = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang")
    rows = L.query(spark, path).where("held_out").join(truth, "doc_id").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.998 * len(rows) > 200
