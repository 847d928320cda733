"""Operator 5, benchmark decontamination: prefix-filtered set join of item windows with documents.

An item's windows are its runs of ``window`` consecutive words (the whole item if it is shorter). As a window must be
contained in a document as a whole, one of its shingles is a sufficient prefix: with shingles ordered by rarity in the
corpus, the rarest one is the window's necessary token. The steps:

1. count every benchmark shingle over all documents (partial counts per task, summed by Spark);
2. key each distinct window by its rarest shingle and that shingle's place in the window;
3. join: where a document holds a prefix shingle, a window can only start so many words before it (positional bound)
   and must end inside the document (length bound);
4. verify each candidate exactly, word by word, over the window.

Only the benchmark is sent to the executors, in blocks of at most ``block_bytes`` of text: its size doesn't follow the
corpus, and a benchmark of several blocks is joined block after block, with the state in between written to the
shared folder. Documents are never shuffled, so a hot source or group of copies has no effect.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, store, table

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 16 << 20

#: Bytes of words stay (A-Z lower-cased), all other ASCII becomes a blank.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                    for b in range(256))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order (nulls have none), and each text's first word's index (n + 1 values)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if texts.offset:
        texts = pa.concat_arrays([texts, texts.slice(0, 0)])
    _, offsets, data = texts.buffers()
    data = pa.py_buffer(data.to_pybytes().translate(_WORD_BYTES)) if data is not None else data
    split = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(texts), offsets, data, None, 0, texts.offset))
    words, ends = split.flatten(), split.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    starts = np.concatenate([[0], np.cumsum(full)])[ends - ends[0]]
    return words.filter(pa.array(full)), starts.astype(np.int64)


@dataclass
class Index:
    """A block of the benchmark: distinct windows over a vocabulary of word numbers."""
    vocabulary: pa.Array
    windows: np.ndarray      # windows x longest, padded with -1
    lengths: np.ndarray
    items: list              # per window: the sorted ids (as strings) of the items that have it
    shingles: dict           # shingle length -> sorted codes of the windows' shingles
    prefix: dict | None = None  # shingle length -> (codes, first, count, window, place)

    def codes(self, ids: np.ndarray, length: int) -> np.ndarray:
        """Code of the shingle that starts at each word; -1 if a word is not in the vocabulary."""
        n = max(0, len(ids) - length + 1)
        out, ok = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        for i in range(length):
            part = ids[i:i + n]
            out = out * len(self.vocabulary) + part
            ok &= part >= 0
        return np.where(ok, out, -1)


def build_index(rows: Iterable[tuple], window: int = WINDOW, shingle: int = SHINGLE) -> Index:
    """``rows``: (item id, text). Null texts have no windows; rows of one id are one item; a null id counts as 'null'."""
    rows = list(rows)
    words, starts = split_words(pa.array([t for _, t in rows], type=pa.large_string()))
    vocabulary = pc.unique(words)
    ids = pc.index_in(words, value_set=vocabulary).to_numpy(zero_copy_only=False)
    if len(vocabulary) >= 1 << (63 // shingle):
        raise ValueError("too many distinct words in a block; choose smaller blocks")
    found: dict[tuple, set] = {}
    for (item, _), lo, hi in zip(rows, starts[:-1], starts[1:]):
        own = tuple(ids[lo:hi].tolist())
        name = "null" if item is None else str(item)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            found.setdefault(own[i:i + window], set()).add(name)
    windows = np.full((len(found), window), -1, dtype=np.int64)
    lengths = np.array([len(w) for w in found], dtype=np.int64)
    for i, w in enumerate(found):
        windows[i, :len(w)] = w
    index = Index(vocabulary, windows, lengths, [sorted(x) for x in found.values()], {})
    for k in range(1, shingle + 1):
        own = windows[lengths >= shingle] if k == shingle else windows[lengths == k]
        if len(own):
            index.shingles[k] = np.unique(np.concatenate([index.codes(w[w >= 0], k) for w in own]))
    return index


def count_shingles(index: Index, texts: pa.Array) -> dict[int, np.ndarray]:
    """Occurrences of the index's shingles in the texts."""
    words, starts = split_words(texts)
    ids = pc.index_in(words, value_set=index.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return {k: np.bincount(at, minlength=len(codes)) for k, codes in index.shingles.items()
            for _, at in [_hits(index, ids, starts, k, codes)]}


def _hits(index: Index, ids: np.ndarray, starts: np.ndarray, length: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word positions, places in ``codes``) of the shingles found inside one text."""
    own = index.codes(ids, length)
    if length > 1 and len(own):  # not across two texts
        cross = np.zeros(len(ids) + 1, dtype=bool)
        for i in range(1, length):
            before = starts[1:-1] - i
            cross[before[before >= 0]] = True
        own = np.where(cross[:len(own)], -1, own)
    position = np.flatnonzero(own >= 0)
    at = np.searchsorted(codes, own[position])
    same = (at < len(codes)) & (codes[np.minimum(at, len(codes) - 1)] == own[position]) if len(codes) else np.zeros(0, bool)
    return position[same], at[same]


def choose_prefixes(index: Index, counts: dict[int, np.ndarray]) -> None:
    """Key every window by its rarest shingle (ties: the smaller code, then the first place)."""
    best: dict[int, list] = {k: [] for k in index.shingles}
    longest = max(index.shingles, default=0)
    for w, n in enumerate(index.lengths):
        k = min(int(n), longest)
        codes = index.codes(index.windows[w, :n], k)
        at = np.searchsorted(index.shingles[k], codes)
        place = int(np.lexsort((np.arange(len(at)), at, counts[k][at]))[0])
        best[k].append((int(codes[place]), w, place))
    index.prefix = {}
    for k, keyed in best.items():
        a = np.array(sorted(keyed), dtype=np.int64).reshape(-1, 3)
        codes, first, count = np.unique(a[:, 0], return_index=True, return_counts=True)
        index.prefix[k] = (codes, first, count, a[:, 1], a[:, 2])


def find_windows(index: Index, texts: pa.Array, chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the texts' words, text, first word, window) of every occurrence of a window."""
    words, starts = split_words(texts)
    ids = pc.index_in(words, value_set=index.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    found = [np.zeros((0, 3), dtype=np.int64)]
    for k, (codes, first, count, window, place) in index.prefix.items():
        position, at = _hits(index, ids, starts, k, codes)
        ends = np.cumsum(count[at])
        lo = 0
        while lo < len(position):  # candidates in chunks of bounded size
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + chunk, "right")))
            n = count[at[lo:hi]]
            entry = np.repeat(first[at[lo:hi]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            w, start = window[entry], np.repeat(position[lo:hi], n) - place[entry]
            text = np.searchsorted(starts, np.repeat(position[lo:hi], n), "right") - 1
            ok = (start >= starts[text]) & (start + index.lengths[w] <= starts[text + 1])
            w, start, text = w[ok], start[ok], text[ok]
            cells = np.arange(index.windows.shape[1])
            words_at = ids[np.minimum(start[:, None] + cells, max(len(ids) - 1, 0))]
            same = ((words_at == index.windows[w]) | (cells >= index.lengths[w][:, None])).all(axis=1)
            found.append(np.stack([text[same], start[same], w[same]], axis=1))
            lo = hi
    a = np.concatenate(found)
    return starts, a[:, 0], a[:, 1], a[:, 2]


_STATE = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
STATE_SCHEMA = "struct<n_words: long, spans: array<long>, items: array<string>>"


def scan(index: Index, texts: pa.Array, state: pa.Array | None) -> pa.Array:
    """Per text: words, hit spans (start, end, start, end, ...; disjoint, sorted) and items, joined with earlier blocks' state."""
    starts, text, start, window = find_windows(index, texts)
    # windows that occur in a text overlap or touch: merged by marking words
    marks = np.zeros(starts[-1] + 1, dtype=np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + index.lengths[window], -1)
    hits = np.cumsum(marks) > 0
    by_text: dict[int, set] = {}
    for t, w in np.unique(np.stack([text, window], axis=1), axis=0).tolist():
        by_text.setdefault(t, set()).update(index.items[w])
    before = state.to_pylist() if state is not None else None
    n_words = np.diff(starts)
    spans_out: list = [[] for _ in range(len(texts))]
    items_out: list = [[] for _ in range(len(texts))]
    for t in range(len(texts)) if before is not None else by_text:
        hit = hits[starts[t]:starts[t + 1]].copy()
        items = by_text.get(t, set())
        if before is not None:
            flat = before[t]["spans"]
            for a, b in zip(flat[::2], flat[1::2]):
                hit[a:b] = True
            items = items | set(before[t]["items"])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        spans_out[t], items_out[t] = edges.tolist(), sorted(items)
    return pa.StructArray.from_arrays([pa.array(n_words), pa.array(spans_out, pa.list_(pa.int64())), pa.array(items_out, pa.list_(pa.string()))],
                                      fields=list(_STATE))


def find_contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: (row struct of all input columns, doc_id, n_words, spans, items, n_hit, n_items, contaminated).

    ``spans`` are the hit word ranges, ``items`` the ids (as strings, sorted) of the items with occurring windows. Null
    texts have no words; wordless items have no window; an empty benchmark hits nothing; an empty corpus gives no rows;
    repeated rows give equal results.
    """
    bounded_batches(docs.sparkSession)
    items = bench.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    block_of = F.pmod(F.xxhash64("item"), F.lit(blocks))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    for b in range(blocks):
        index = build_index([(r["item"], r["text"]) for r in items.where(block_of == b).collect()], window)  # a block of bounded size
        choose_prefixes(index, _corpus_counts(rows, index))
        if b:
            rows = store(rows, "decontamination-block").withColumn("state", _scan_udf(index, True)("text", "state"))
        else:
            rows = rows.withColumn("state", _scan_udf(index, False)("text"))
    spans = F.col("state.spans")
    n_hit = F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select("row", "doc_id", "state.n_words", "state.spans", "state.items", n_hit.alias("n_hit"),
                       F.size("state.items").cast("long").alias("n_items"), (F.size(spans) > 0).alias("contaminated"))


def _scan_udf(index: Index, with_state: bool):
    if with_state:
        @F.arrow_udf(STATE_SCHEMA)
        def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, state in batches:
                yield scan(index, texts, state)
    else:
        @F.arrow_udf(STATE_SCHEMA)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield scan(index, texts, None)
    return run.asNondeterministic()  # computed once, also below filters on its result


def _corpus_counts(rows: DataFrame, index: Index) -> dict[int, np.ndarray]:
    """Counts over all documents; what comes back has at most one row per benchmark shingle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(len(c), dtype=np.int64) for k, c in index.shingles.items()}
        for batch in batches:
            for k, n in count_shingles(index, batch.column(0)).items():
                total[k] += n
        for k, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, dtype=np.int32)), pa.array(at), pa.array(n[at])], names=["k", "at", "n"])

    counts = {k: np.zeros(len(c), dtype=np.int64) for k, c in index.shingles.items()}
    if counts:
        for r in rows.select("text").mapInArrow(count, "k int, at long, n long").groupBy("k", "at").agg(F.sum("n").alias("n")).collect():
            counts[r.k][r.at] = r.n
    return counts


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
       FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.p, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
