import random

import pyarrow as pa
import pytest

from retentia.llm import op5_decontamination as B
from retentia.llm import op9_quality_rules as Q
from tests.llm import brute
from tests.llm.helpers import CLASHES, documents, oracle, rows_of, write


def text(rng, n, vocabulary=30):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def leaks(seed=2):
    rng = random.Random(seed)
    items = [(i, text(rng, rng.choice([1, 2, 3, 9, 10, 11, 40]), 400)) for i in range(40)]
    items += [(40, items[0][1]), (41, None), (42, ""), (42, "w1, w2; W3"), (10, items[3][1]), (None, text(rng, 15, 400)), (43, "the the the the the the the the the the the the")]
    rows = []
    for d in range(120):
        parts = [text(rng, rng.randrange(40), 400)]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(items)[1] or "").split()
            lo = rng.randrange(max(1, len(w)))
            parts += [" ".join(w[lo:lo + rng.choice([9, 10, 50])]).upper(), text(rng, rng.randrange(8), 400)]
        rows.append((d, rng.choice([" ", "-", "\n"]).join(parts)))
    rows += [(200, None), (201, ""), (202, "..."), (203, items[-1][1]), (204, "the " * 30_000), (205, items[5][1] + "é")]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_contamination_matches_plain_search(spark, block_bytes):
    rows, items = leaks()
    docs = documents(spark, rows, CLASHES)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in B.find_contamination(docs, bench, block_bytes=block_bytes).collect()}
    want = brute.contamination(rows, items)
    assert got == want
    assert sum(n > 0 for _, n, _ in got.values()) > 20


def test_contamination_edge_cases(spark, tmp_path):
    rows = [(1, "a b c"), (1, "a b c"), (None, "x a b")]
    docs, bench = documents(spark, rows), spark.createDataFrame([(7, "A, b")], "item_id long, text string")
    got = B.query(spark, write(tmp_path, documents=docs, benchmark=bench)).collect()
    assert sorted((str(r.doc_id), r.n_hit, r.n_items, r.contaminated, r.items_sha256) for r in got) == sorted(
        (d, 2, 1, True, brute.sha256(["7"])) for d in ("1", "1", "None"))
    none = B.query(spark, write(tmp_path / "a", documents=docs, benchmark=bench.limit(0))).collect()
    assert [(r.n_hit, r.contaminated, r.items_sha256) for r in none] == [(0, False, brute.sha256([]))] * 3
    assert B.query(spark, write(tmp_path / "b", documents=docs.limit(0), benchmark=bench)).count() == 0


def test_texts_after_wordless_ones_keep_their_first_shingle(spark):
    """A batch that begins with null, empty and wordless texts (or a single word), then a document equal to a short item."""
    items = [(1, "alpha beta"), (2, "gamma delta epsilon zeta"), (3, "one two three four five six seven eight nine ten eleven")]
    index = B.build_index(items)
    B.choose_prefixes(index, {k: B.np.zeros(len(c), dtype=B.np.int64) for k, c in index.shingles.items()})
    for first in ([None], [""], ["..."], [None, "", "..."], ["word"], ["", "word", None], []):
        for item, text in items:
            got = B.scan(index, pa.array([*first, text, "", text], pa.string()), None).to_pylist()
            assert [x["items"] for x in got] == [[]] * len(first) + [[str(item)], [], [str(item)]]
    rows = [(0, None), (1, ""), (2, "..."), (3, items[0][1]), (4, "x"), (5, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = B.find_contamination(documents(spark, rows).coalesce(1), bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in got} == brute.contamination(rows, items)


def test_oracles(spark):
    for module, sf in ((B, "/root/testdata/sf0.001"), (Q, "/root/testdata/sf0.001")):
        assert rows_of(module.query(spark, sf)) == oracle(module.ORACLE_SQL, sf)


def test_sliced_arrays_keep_their_words():
    a = pa.array(["zero one", None, "Two  THREE", "", "four"])
    words, starts = B.split_words(a.slice(1, 3))
    assert words.to_pylist() == ["two", "three"] and starts.tolist() == [0, 0, 2, 2]


def boilerplate():
    rng = random.Random(6)
    rows = []
    for d in range(300):
        host = ["big", "big", "big", "small", None][d % 5]
        lines = [text(rng, rng.randint(8, 30), 5000) for _ in range(rng.randint(1, 4))]
        if d % 3 == 0:
            lines.append("Common  line of the HOST with a good many words in it")
        if d % 7 == 0:
            lines = lines[:1] + ["common line of the host with a good many words in it"] * 3
        rows.append((d, "\n".join(lines), host))
    rows += [(d, "copy copy2 copy3 copy4 copy5 copy6 copy7 copy8 copy9 copy10\n\n ", "big") for d in range(300, 360)]
    rows += [(400, None, "big"), (401, "", "big"), (402, "a b c d e f g\x0bh\x0ci\rj\tk # | <>", "small"), (403, "x y z u v " * 30, "small"),
             (404, "é ü " * 20_000 + "\n\n a\n a\n", "big"), (405, "a b c d e a b c d e f g h i j k", None), (406, "a b\x85c d", "small")]
    return rows


def test_quality_matches_plain_rules(spark):
    rows = boilerplate()
    got = Q.judge_documents(documents(spark, rows, CLASHES)).collect()
    want = brute.quality(rows)
    assert len(got) == len(rows)
    for r in got:
        counts, failed, kept, clean = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts, r.doc_id
        assert (r.base_failed, r.kept) == (failed, kept), r.doc_id
        if kept:
            assert r.clean_text == clean
    assert 0 < sum(not k and not f for _, f, k, _ in want.values())
    assert all(want[d][2] for d in range(300, 360))  # exact copies are one document


def test_quality_repeated_rows_and_oracle(spark, tmp_path):
    rows = boilerplate()
    unique = write(tmp_path, documents=documents(spark, rows))
    assert rows_of(Q.query(spark, unique)) == oracle(Q.ORACLE_SQL, unique)
    twice = Q.judge_documents(documents(spark, rows + [(None, rows[0][1], "big")] * 2 + rows)).collect()
    want = brute.quality(rows)
    assert all((r.kept == want[r.doc_id][2]) for r in twice if r.doc_id is not None) and len(twice) == 2 * len(rows) + 2
    empty = write(tmp_path / "e", documents=documents(spark, rows).limit(0))
    assert Q.query(spark, empty).count() == 0


def test_quality_null_hosts_and_null_texts(spark, tmp_path):
    """Rows without a host share one, whose common line goes; null texts are no texts, which decides at the border of the share."""
    rng = random.Random(12)
    common = "this line of fourteen words stands in twenty one documents of the one host"
    for empty, over in ((None, True), ("", False)):
        rows = [(d, " ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) + ("\n" + common if d < 21 else ""), None) for d in range(419)]
        rows += [(1000 + d, empty, None) for d in range(5)]  # 419 texts: 21 > 20.95; with an empty one as well, 21 = 0.05 * 420
        path = write(tmp_path / str(over), documents=documents(spark, rows))
        got = rows_of(Q.query(spark, path))
        assert got == oracle(Q.ORACLE_SQL, path)
        want = brute.quality(rows)
        judged = {r.doc_id: r.kept for r in Q.judge_documents(documents(spark, rows)).collect()}
        assert judged == {d: want[d][2] for d in judged}
        assert [judged[d] for d in range(21)] == [not over] * 21 and all(judged[d] for d in range(21, 419))
