import random

import numpy as np
import pytest

from retentia.llm import op6_substring_dedup as D
from retentia.llm import op7_simhash as H
from retentia.llm.common import connected_components
from tests.llm import brute
from tests.llm.helpers import CLASHES, documents, write


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(25)] + [(i, i + 1) for i in range(100, 112)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    joined = {frozenset(e) for e in edges}
    assert got == brute.components(nodes, lambda a, b: frozenset((a, b)) in joined)


def near(rng, fp, bits):
    for b in rng.sample(range(64), bits):
        fp ^= 1 << b
    return fp


def families(rng, n_families, size):
    out = []
    for _ in range(n_families):
        center = rng.getrandbits(64)
        out += [center] + [near(rng, rng.choice([center, *out[-3:]]), rng.randint(1, 3)) for _ in range(size)]
    return sorted(set(out))


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_bit_sliced_links_match_all_pairs(radius):
    rng = random.Random(radius)
    fps = families(rng, 6, 60)
    links = H.links_within(np.array(fps, dtype=np.uint64), radius)
    joined = {frozenset((fps[i], fps[j])) for i, j in links}
    assert all((a ^ b).bit_count() <= radius for a, b in map(tuple, joined))
    want = brute.components(set(fps), lambda a, b: (a ^ b).bit_count() <= radius)
    assert brute.components(set(fps), lambda a, b: frozenset((a, b)) in joined) == want


@pytest.mark.parametrize("max_group", [8])
def test_components_of_fingerprints(spark, max_group):
    """Small max_group: hot groups are dealt again, and nothing is lost."""
    rng = random.Random(7)
    center = rng.getrandbits(64)
    fps = families(rng, 15, 12) + sorted({near(rng, center, rng.randint(1, 4)) for _ in range(120)} | {0, 1, 3})
    rows = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in H.near_duplicates(rows, "doc_id", "fp", 2, max_group).collect()}
    assert got == brute.components(set(range(len(fps))), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)


EDGE = [(5, "A b c d e"), (3, "a B c d e"), (3, "a B c d e"), (None, "a b c d e"), (7, None), (8, ""), (9, " \n\t"), (10, "one"), (11, "One two"),
        (12, "é è ü"), (13, "É è ü"), (14, "w " * 90_000), (15, "x\x00y z \x85 q\u00a0r")]


def test_simhash_documents(spark, tmp_path):
    docs = documents(spark, EDGE, CLASHES)
    got = H.simhash_documents(docs).collect()
    assert len(got) == len(EDGE) and got[0]["row"].component == "x"
    fps = {}
    for r in got:
        fp = brute.fingerprint(r["row"].text) if len(r["row"].text or "") < 1000 else H.fingerprint(r["row"].text)
        assert r.fp % (1 << 64) == fp
        fps.setdefault(fp, []).append(r)
    names = brute.components(set(fps), lambda a, b: (a ^ b).bit_count() <= 2)
    for fp, rows in fps.items():
        ids = [r.doc_id for f, n in names.items() if n == names[fp] for r in fps[f] if r.doc_id is not None]
        assert {r.component_id for r in rows} == {min(ids)}
    kept = H.one_per_component(H.simhash_documents(docs)).select("row.doc_id").collect()
    assert len(kept) == len(set(names.values()))
    assert sorted(r.doc_id for r in kept).count(3) == 1
    nulls = H.one_per_component(H.simhash_documents(documents(spark, [(None, "p q r s t"), (None, "p q r s t"), (None, "u v w x")]))).count()
    assert nulls == 2
    empty = write(tmp_path, documents=docs.select("doc_id", "text").limit(0))
    assert H.query(spark, empty).count() == 0


def text(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))


def edited(rng, line, n):
    w = line.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = "".join(rng.choices("xyz", k=5))
    return " ".join(w)


def corpus(seed=3):
    rng = random.Random(seed)
    shared = [text(rng, n) for n in (26, 60, 80, 200)]
    rows = []
    for d in range(70):
        lines = [text(rng, rng.randint(5, 60)) for _ in range(rng.randint(1, 4))]
        if d % 3 == 0:
            line = rng.choice(shared)
            lines.insert(rng.randrange(len(lines) + 1), edited(rng, line, rng.randint(0, 3)).upper())
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("max_bucket", [5])
def test_substring_dedup_matches_all_pairs(spark, max_bucket):
    rows = corpus()
    same = text(random.Random(9), 30)
    rows += [(100, same + "\n" + same), (101, "short line\n\n" + "once " * 24 + "more"), (102, ""), (104, text(random.Random(10), 4000))]
    docs = documents(spark, rows + [(103, None)], CLASHES)
    got = D.deduplicate(docs, max_bucket=max_bucket, recall=0.99999).collect()
    removed = {(r.doc_id, x.paragraph) for r in got for x in r.removed or ()}
    assert removed == brute.substring_dedup(rows)
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + 1 and by[103].clean_text is None
    for d, t in rows:
        left = [x for i, x in enumerate(t.split("\n")) if (d, i) not in removed]
        assert by[d].clean_text == "\n".join(left)
    assert any(removed) and 100 not in {d for d, _ in removed}


def test_substring_dedup_edge_cases(spark, tmp_path):
    p = text(random.Random(4), 55)
    rows = [(2, p), (2, p), (1, "a\n" + p + "\nb"), (None, p), (2, "other\n" + p)]
    got = D.deduplicate(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.clean_text) for r in got) == sorted([("2", ""), ("2", ""), ("1", "a\n" + p + "\nb"), ("None", ""), ("2", "other")])
    assert {(x.keeper_doc_id, x.keeper_paragraph) for r in got for x in r.removed or ()} == {(1, 1)}
    sf = write(tmp_path, documents=documents(spark, rows).limit(0))
    assert D.query(spark, sf).count() == 0


def test_bands_are_tuned():
    b = D.tune_bands(0.8, 0.998, 3)
    assert 1 - (1 - 0.8 ** 3) ** b >= 0.998 > 1 - (1 - 0.8 ** 3) ** (b - 1)
    rng = random.Random(5)
    lines = [text(rng, 40).encode() for _ in range(50)]
    together = D.signatures(lines, b)
    assert (together == np.concatenate([D.signatures([x], b) for x in lines])).all()


def windows_of(rows, n=50):
    return {(d, t): [tuple(w[i:i + n]) for i in range(len(w) - n + 1)] for d, t in rows for w in [brute.words((t or "").translate(brute.LOWER))]}


def plain_passages(rows, n=50):
    """{(doc_id, text): numbers of the words in runs of n that stand in an earlier document}."""
    found, first = windows_of(rows, n), {}
    for key in sorted(found):
        for w in found[key]:
            first.setdefault(w, key)
    return {key: {i + k for i, w in enumerate(ws) if first[w] != key for k in range(n)} for key, ws in found.items()}


def check_passages(spark, rows):
    got = D.deduplicate(documents(spark, rows, CLASHES), passage=50).collect()
    lines = {r.doc_id: r.clean_text for r in D.deduplicate(documents(spark, rows)).collect()}
    want = plain_passages([(d, lines[d]) for d, _ in rows])
    assert len(got) == len(rows)
    for r in got:
        cut = want[r.doc_id, lines[r.doc_id]]
        assert {x.word + i for x in r.passages or () for i in range(x.words)} == cut
        assert brute.words(r.clean_text) == [w for i, w in enumerate(brute.words(lines[r.doc_id])) if i not in cut]
    return {r.doc_id: r for r in got}


@pytest.mark.parametrize("piece", [4 << 20, 5000])
def test_passages_inside_longer_lines(spark, monkeypatch, piece):
    monkeypatch.setattr(D, "PIECE_BYTES", piece)
    rng = random.Random(21)
    shared = [text(rng, n) for n in (50, 71, 120, 49)]
    rows = [(d, " ".join([text(rng, rng.randint(1, 400)), shared[d % 4].upper() if d % 3 else shared[d % 4], text(rng, rng.randint(1, 400))])) for d in range(40)]
    rows += [(100, ""), (101, text(rng, 49)), (102, "once " * 300), (103, "once " * 200), (104, text(rng, 300) + "\n" + shared[1] + "\nend")]
    got = check_passages(spark, rows)
    assert all(not got[d].passages for d in range(40) if d % 4 == 3 or d < 3) and all(got[d].passages for d in range(4, 40) if d % 4 != 3)
    assert got[104].clean_text.endswith("\nend") and got[104].clean_text.count("\n") == 1


def test_passages_wrapped_over_short_lines(spark):
    """Lines of under 25 words are no paragraphs, but passages run over line ends, wrapped otherwise in each document."""
    rng = random.Random(22)

    def wrapped(words):
        out = []
        while words:
            n = rng.randint(5, 24)
            out, words = out + [" ".join(words[:n])], words[n:]
        return "\n".join(out)

    shared = [text(rng, n).split(" ") for n in (61, 53, 49)]
    rows = [(d, text(rng, 20) + "\n" + wrapped(shared[d % 3]) + "\n" * (1 + d % 2) + text(rng, 20)) for d in range(30)]
    got = check_passages(spark, rows)
    assert all(bool(got[d].passages) == (d >= 3 and d % 3 < 2) for d in range(30))
    assert not any(r.removed for r in got.values())
