"""Operator 2, best-fit packing: linear grouping scheme.

Texts are tokenised and cut where they are; only (id, piece, length, checksum) rows go on. The packing itself depends on the
lengths alone, and there are at most ``capacity`` different ones, so it is planned from their histogram, whose size does
not follow the corpus:

1. large lengths, in descending order, are dealt into groups of equal cardinality and rounded up to their group's maximum;
2. a linear program over configurations of the few rounded sizes (column generation: a knapsack over the duals
   prices new configurations) gives how often each configuration is used; these numbers are rounded down;
3. actual lengths take the places of the rounded ones;
4. what is left over, and all small lengths, go best-fit in descending order into the gaps, opening sequences as needed.

Plans are kept as runs ("so many pieces of this length, so many per sequence, from this sequence on"), never as single
pieces. Pieces are then numbered within their length (hot lengths are dealt into parts, see ``gapless_rank``) and look up
their run by number, so a length that holds a third of all rows spreads over many tasks.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, gapless_rank, per_worker, salts_for, store, table

CAPACITY = 2048
#: (share of the capacity from which a length is large, number of groups); the plan with the fewest sequences is taken.
SCHEMES = ((1 / 3, 64), (0.4, 200), (0.5, 200))
SPECIAL = "<|endoftext|>"
END_ID = 0
MAX_CACHED = 200_000


# ---------------------------------------------------------------- tokens

class _Known(dict):
    """Ids of words with ``before`` in front of them, found once and kept; emptied when full."""

    def __init__(self, encode, before: str):
        super().__init__()
        self.encode, self.before = encode, before

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MAX_CACHED:
            self.clear()
        ids = self[word] = array("I", self.encode(self.before + word)).tobytes()
        return ids


class TokenIds:
    """Token ids of texts as bytes (little-endian unsigned 32-bit), the same that the tokenizers library gives.

    The tokenizer's pre-tokens never reach across a single blank or line break between two printing characters, except
    that the blank belongs to the word after it. Texts are cut there, and the ids of the parts are cached. New
    parts are encoded with the same vocabulary in the form of merge ranks, which is several times as fast; texts with
    special tokens in them go through the tokenizer whole.
    """

    _cuts = regex.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str | None = None, ranks_path: str | None = None):
        import public_tokenizers
        import tiktoken
        self.path, self.tokenizer = path or public_tokenizers.path("byte_bpe_50k.json"), None
        with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.parts, self.after_blank = _Known(encode, ""), _Known(encode, " ")

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if SPECIAL in text:
            if self.tokenizer is None:
                from tokenizers import Tokenizer
                self.tokenizer = Tokenizer.from_file(self.path)
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        words = text.split()
        blanks = text.count(" ") + text.count("\n")
        first, rest = self.parts.__getitem__, self.after_blank.__getitem__
        if len(words) != blanks + 1 or sum(map(len, words)) != len(text) - blanks:
            return b"".join(map(first, self._cuts.split(text)))
        # single blanks and line breaks between words, nothing else that is white space
        lines = [line.split(" ") for line in text.split("\n")]
        return first("\n").join([first(line[0]) + b"".join(map(rest, line[1:])) for line in lines])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: full pieces, the first one may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


PIECES = "array<struct<piece: int, start: long, length: long, ids_crc32: long>>"


def token_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str | None, ranks_path: str | None,
                 capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document; null text is empty and has the end id alone."""
    @F.pandas_udf(PIECES)
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = per_worker(("token ids", tokenizer_path, ranks_path), lambda: TokenIds(tokenizer_path, ranks_path))
        end = np.array([END_ID], dtype="<u4").tobytes()
        for texts in batches:
            out = []
            for text in texts:
                ids = tokens.ids(text or "") + end
                view = memoryview(ids)
                out.append([(i, s, n, zlib.crc32(view[4 * s:4 * (s + n)])) for i, (s, n) in enumerate(cut(len(ids) // 4, capacity))])
            yield pd.Series(out)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(pieces(F.col(text_col).cast("string"))).alias("p"))
    return rows.select("doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32")


# ---------------------------------------------------------------- plan

@dataclass
class Run:
    """``count`` pieces of ``length`` numbered from ``rank``: ``each`` per sequence, at ``offset``, from ``sequence`` on."""
    length: int
    rank: int
    count: int
    each: int
    sequence: int
    offset: int


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """(pieces per size, times) of a near-optimal fractional cover of the demand, rounded down."""
    k = len(sizes)
    size, need = np.array(sizes), np.array(demand, dtype=float)
    basis = np.diag([float(capacity // s) for s in sizes])
    cost = np.ones(k)
    inverse = np.linalg.inv(basis)
    for step in range(1, 10 * k):  # far more than usual; stopping early leaves a valid cover
        x = inverse @ need
        dual = cost @ inverse
        worst = int(np.argmin(dual))
        if dual[worst] < -1e-7:  # more of a size than needed does no harm
            column, price = np.zeros(k), 0.0
            column[worst] = -1.0
        else:
            column, value = _knapsack(size, dual, capacity)
            price = 1.0
            if value <= 1 + 1e-7:
                break
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.where(up, np.maximum(x, 0) / np.where(up, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        basis[:, out], cost[out] = column, price
        if step % 64:
            pivot = inverse[out] / direction[out]
            inverse -= np.outer(direction, pivot)
            inverse[out] = pivot
        else:
            inverse = np.linalg.inv(basis)
    x = np.linalg.inv(basis) @ need
    return [(np.rint(basis[:, j]).astype(int), int(x[j] + 1e-9)) for j in range(k) if cost[j] == 1 and x[j] >= 1 - 1e-9]


def _knapsack(size: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Unbounded knapsack: best multiset of sizes within the capacity."""
    best = np.zeros(capacity + 1)
    worth = [(int(s), float(v), j) for j, (s, v) in enumerate(zip(size, value)) if v > 1e-12]
    for s, v, _ in worth:
        for lo in range(s, capacity + 1, s):  # a block of s places may build on the block before it
            hi = min(lo + s, capacity + 1)
            np.maximum(best[lo:hi], best[lo - s:hi - s] + v, out=best[lo:hi])
    column, c = np.zeros(len(size)), capacity
    while (step := next(((s, j) for s, v, j in worth if s <= c and best[c] <= best[c - s] + v + 1e-13 and best[c] > 1e-12), None)):
        column[step[1]] += 1
        c -= step[0]
    return column, float(best[capacity])


class _Queue:
    """Pieces by length, taken in runs; ranks within a length are handed out in order."""

    def __init__(self, counts: list[tuple[int, int]], ranks: dict[int, int]):
        self.left = [[n, c] for n, c in counts if c]
        self.ranks = ranks

    def take(self, most: int) -> tuple[int, int, int]:
        """(length, first rank, count) of up to ``most`` pieces of one length."""
        length, left = self.left[0]
        n = min(most, left)
        self.left[0][1] -= n
        if not self.left[0][1]:
            self.left.pop(0)
        rank = self.ranks[length]
        self.ranks[length] += n
        return length, rank, n


def _plan(histogram: dict[int, int], capacity: int, large_share: float, n_groups: int) -> tuple[list[Run], int]:
    runs: list[Run] = []
    ranks = dict.fromkeys(histogram, 0)
    sequences = 0
    full = histogram.get(capacity, 0)
    if full:
        runs.append(Run(capacity, 0, full, 1, 0, 0))
        sequences = full
    lengths = sorted((n for n, c in histogram.items() if n < capacity and c), reverse=True)
    large = [(n, histogram[n]) for n in lengths if n >= large_share * capacity]
    rest = {n: histogram[n] for n in lengths if n < large_share * capacity}
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left -> [(first sequence, count)]

    # 1. groups of equal cardinality, rounded up to their largest length
    total = sum(c for _, c in large)
    groups: list[list[tuple[int, int]]] = []
    if total:
        size = -(-total // n_groups)
        groups, room = [[]], size
        for n, c in large:
            while c:
                if not room:
                    groups.append([])
                    room = size
                t = min(c, room)
                groups[-1].append((n, t))
                c, room = c - t, room - t
    tops = [g[0][0] for g in groups]
    merged: dict[int, list[tuple[int, int]]] = {}
    for top, g in zip(tops, groups):  # groups of one size are one size to the program
        merged.setdefault(top, []).extend(g)
    sizes = list(merged)
    queues = [_Queue(g, ranks) for g in merged.values()]
    # 2. configurations, 3. actual lengths in the places of rounded ones
    left = [sum(c for _, c in g) for g in merged.values()]
    for pattern, times in configurations(sizes, left.copy(), capacity) if sizes else []:
        for j, a in enumerate(pattern):  # a cover may ask for more than there is
            if a:
                times = min(times, left[j] // int(a))
        if not times:
            continue
        segments = [(sequences, times, 0)]  # (first sequence, count, used)
        sequences += times
        for j, a in enumerate(pattern):
            left[j] -= int(a) * times
            for _ in range(int(a)):
                segments = _fill(segments, queues[j], runs)
        for first, count, used in segments:
            gaps.setdefault(capacity - used, []).append((first, count))
    for q in queues:
        for n, c in q.left:
            rest[n] = rest.get(n, 0) + c
    # 4. best fit in descending order
    rooms = sorted(r for r in gaps if r)
    for n in sorted(rest, reverse=True):
        count = rest[n]
        while count:
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):  # open sequences
                each = capacity // n
                new = -(-count // each)
                gaps.setdefault(capacity, []).append((sequences, new))
                bisect.insort(rooms, capacity)
                sequences += new
                continue
            room = rooms[at]
            first, bins = gaps[room].pop()
            if not gaps[room]:
                del gaps[room]
                rooms.pop(at)
            each = min(room // n, count)
            used_bins = min(bins, count // each)
            runs.append(Run(n, ranks[n], each * used_bins, each, first, capacity - room))
            ranks[n] += each * used_bins
            count -= each * used_bins
            for r, f, b in ((room - each * n, first, used_bins), (room, first + used_bins, bins - used_bins)):
                if b and r:
                    if r not in gaps:
                        bisect.insort(rooms, r)
                    gaps.setdefault(r, []).append((f, b))
    return runs, sequences


def _fill(segments: list[tuple[int, int, int]], queue: _Queue, runs: list[Run]) -> list[tuple[int, int, int]]:
    """One piece of the queue into every sequence of the segments."""
    out = []
    for first, count, used in segments:
        while count:
            length, rank, n = queue.take(count)
            runs.append(Run(length, rank, n, 1, first, used))
            if out and out[-1][2] == used + length and out[-1][0] + out[-1][1] == first:
                out[-1] = (out[-1][0], out[-1][1] + n, used + length)
            else:
                out.append((first, n, used + length))
            first, count = first + n, count - n
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, schemes=SCHEMES) -> tuple[list[Run], int]:
    """Runs and number of sequences of the best of the schemes."""
    return min((_plan(histogram, capacity, share, k) for share, k in schemes), key=lambda p: p[1])


# ---------------------------------------------------------------- documents

def assign(pieces: DataFrame, runs: list[Run]) -> DataFrame:
    """Adds sequence_id and offset; ``pieces`` must be stored, as it is read twice."""
    ordered = sorted(runs, key=lambda r: (r.length, r.rank))
    key = np.array([(r.length << 48) + r.rank for r in ordered], dtype=np.int64)
    rank, each, sequence, offset = (np.array([getattr(r, f) for r in ordered], dtype=np.int64) for f in ("rank", "each", "sequence", "offset"))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        n, r = length.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False)
        at = np.searchsorted(key, (n << 48) + r, "right") - 1
        i = r - rank[at]
        return pa.StructArray.from_arrays([pa.array(sequence[at] + i // each[at]), pa.array(offset[at] + i % each[at] * n)], names=["sequence_id", "offset"])

    ranked = gapless_rank(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "number", salts_for(pieces.sparkSession))
    return ranked.withColumn("at", place("length", "number")).select(*pieces.columns, "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
                   ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of one id; repeated rows are packed each; null ids are kept; an empty table gives no
    rows; other columns are ignored. ``tokenizer_path`` and ``ranks_path``: a file of the tokenizers library and its vocabulary
    as merge ranks (default: the byte-level one of 50,257 ids among the public tokenizers).
    """
    bounded_batches(docs.sparkSession)
    pieces = store(token_pieces(docs, id_col, text_col, tokenizer_path, ranks_path, capacity), "packing-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    runs, _ = plan(histogram, capacity)
    return assign(pieces, runs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
