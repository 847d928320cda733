import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from retentia.llm import op12_token_alignment as A
from tests.llm.helpers import CLASHES, documents, write

# bytes of a byte-level vocabulary's letters: printable ones stand for themselves, the others for 256, 257, ...
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTERS = {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in PRINTED)}


@pytest.fixture(scope="module")
def tokens():
    """text -> (ids, bytes) of both tokenizers, by their own libraries."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def both(text):
        e = a.encode(" " + text, add_special_tokens=False)
        ids = b.encode(text)
        pieces = [b.id_to_piece(i) for i in ids]
        return ((e.ids, [bytes(LETTERS[c] for c in a.id_to_token(i)) for i in e.ids]),
                (ids, [bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode() for p in pieces]))
    return both


def plain(rows, tokens):
    """The query's rows by set intersection of the ends."""
    found, counts = [], Counter()
    for d, text in rows:
        (a, ab), (b, bb) = tokens(text) if text else (([], []), ([], []))
        if text and not b"".join(ab) == b"".join(bb) == (" " + text).encode():
            a, ab, b, bb = [], [], [], []
        ends = []
        for x in (ab, bb):
            at, n = [], 0
            for t in x:
                n += len(t)
                at.append(n)
            ends.append(at)
        common = sorted(set(ends[0]) & set(ends[1]))
        at_a, at_b = ({e: i for i, e in enumerate(x)} for x in ends)
        links = [(a[at_a[e]], b[at_b[e]]) for e in common]
        groups, i, j = [], 0, 0
        for e in common:
            groups.append(",".join(map(str, a[i:at_a[e] + 1])) + "|" + ",".join(map(str, b[j:at_b[e] + 1])))
            i, j = at_a[e] + 1, at_b[e] + 1
        counts.update(links)
        found.append((d, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(str((d, na, nb, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha))
                  for d, na, nb, g, links, sha in found)


def odd_rows():
    rng = random.Random(2)
    words = ["the", "Straße", "naïve", "été", "unbelievable", "x", "日本語", "\U0001F600", "don't", "3.14", "\u00a0", "\u2028", "É"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\t", " \n", "\r\n", "   "]
    rows = [(d, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(30)))) for d in range(150)]
    rows += [(d, "".join(chr(rng.choice([32, 32, 97, 98, 10, 233, 0x2581, 0x4E2D, 0, 9])) for _ in range(rng.randrange(12)))) for d in range(200, 300)]
    return rows + [(300, None), (301, ""), (302, " "), (303, "\n"), (304, "a▁b"), (305, "<|endoftext|> and <s> </s> <unk> <0x41>"), (None, "null id"), (306, "same same"),
                   (306, "same same"), (307, "long " * 300 + "\u0301" * 50), (308, " leading"), (309, "<|endoftext|>")]


@pytest.mark.parametrize("frequent", [1 << 20, 40, 0])
def test_digests_match_the_plain_version(spark, tokens, frequent):
    rows = odd_rows()
    got = A.alignment_digests(A.align_documents(documents(spark, rows, CLASHES + " a b a_ids rest pair best")), frequent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {t for _, t in got.dtypes[:7]} == {"bigint"}
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows, tokens)


def test_query_on_the_generated_texts(spark, tokens):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(str(tuple(r)) for r in A.query(spark, sf).collect()) == plain(rows, tokens)


def test_groups_of_random_ends():
    rng = random.Random(3)
    for _ in range(2000):
        n = rng.randrange(1, 60)
        share = rng.random()
        a, b = (sorted({n, *(x for x in range(1, n) if rng.random() < p)}) for p in (share, rng.choice([share, 0.9])))
        if rng.random() < 0.3:
            b = list(a) if rng.random() < 0.5 else sorted({*a, n} - {rng.choice(a[:-1] or [0])})
        common = sorted(set(a) & set(b))
        want = [[sum(lo < x <= hi for x in ends) for lo, hi in zip([0, *common], common)] for ends in (a, b)]
        ones, in_a, in_b = map(np.array, A.diagonal_runs(a, b))
        assert [A.group_sizes(ones, x).tolist() for x in (in_a, in_b)] == want


def test_alignment_is_whole_and_empty_tables(spark, tmp_path):
    text = "Alignment of tokenizers: naïve, überraschend."
    r = A.align_documents(documents(spark, [(1, text), (2, None)])).orderBy("doc_id").collect()
    assert sum(r[0].ones) + sum(r[0].a_sizes) == len(r[0].a_ids) and sum(r[0].ones) + sum(r[0].b_sizes) == len(r[0].b_ids)
    assert r[1][1:] == ([], [], [], [], [])
    assert A.query(spark, write(tmp_path, documents=documents(spark, [(1, text)]).limit(0))).count() == 0
