import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retentia.llm import op2_packing as P
from tests.llm import brute
from tests.llm.helpers import CLASHES, documents, write

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a b", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \nb", "\n", "  ", "\t\ta b\tc", "don't we'll 's", "é ü x\x1cy\x85z", "x" * 5000,
         "w1 w2\nw3, w4!\r\nw5", "a <|endoftext|> b", "<|endoftext|>", "日本語 テキスト\n한국어", "😀 😀😀", "a\0b c\0 d", "123 45,6\n7", "", "q r s", " \n x"]


def test_ids_are_the_tokenizers(spark):
    plain = Tokenizer.from_file(PATH)
    tokens = P.TokenIds(PATH)
    rng = random.Random(1)
    mixed = ["".join(rng.choices([" ", "\n", "ab", "c", "'s", "9", ".", "\t", "é"], k=30)) for _ in range(300)]
    for t in TEXTS + mixed:
        ids = plain.encode(t, add_special_tokens=False).ids
        assert tokens.ids(t) == b"".join(i.to_bytes(4, "little") for i in ids), repr(t)


def check_plan(histogram, runs, sequences, capacity):
    used, places = Counter(), defaultdict(list)
    for r in runs:
        used[r.length] += r.count
        for i in range(r.count):
            places[r.sequence + i // r.each].append((r.offset + i % r.each * r.length, r.length))
    assert used == Counter(histogram) and len(places) == sequences
    for at in places.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= capacity


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_valid_and_tight(seed):
    rng = random.Random(seed)
    lengths = [min(2048, max(1, int(rng.lognormvariate(6.4, 0.9)))) for _ in range(rng.choice([0, 1, 7, 300, 5000]))]
    lengths += [700] * rng.choice([0, 2000])
    histogram = Counter(lengths)
    runs, sequences = P.plan(dict(histogram))
    check_plan(histogram, runs, sequences, 2048)
    bins = []  # best fit in descending order, piece by piece
    for n in sorted(lengths, reverse=True):
        room = min((b for b in bins if b >= n), default=None)
        if room is not None:
            bins.remove(room)
        bins.append((room or 2048) - n)
    assert sequences <= len(bins)


def check_rows(rows, docs, capacity):
    plain = Tokenizer.from_file(PATH)
    places, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for at in places.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= capacity
    want = defaultdict(list)
    for d, t in docs:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or min(len(ids), capacity)
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want[d] += [(i, a, b - a, brute.crc32(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {d: sorted(x) for d, x in pieces.items()} == {d: sorted(x) for d, x in want.items()}


def test_packed_documents(spark, tmp_path):
    rows = list(enumerate(TEXTS)) + [(3, "again"), (3, "again"), (None, None), (None, "n"), (77, "long text " * 7000), (78, "a" * 3)]
    docs = documents(spark, rows, CLASHES + " length number")
    check_rows(P.pack_documents(docs).collect(), rows, 2048)
    small = P.pack_documents(docs, capacity=16).collect()
    check_rows(small, rows, 16)
    assert P.query(spark, write(tmp_path, documents=docs.select("doc_id", "text").limit(0))).count() == 0
