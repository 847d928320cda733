"""Operator 10, LM scoring: cross-entropy difference between a target and a background n-gram model.

Both models are bigram models of one form over one vocabulary (the words that occur ``MIN_COUNT`` times or more in the corpus; all
others are one unknown word), and both are smoothed alike:

    p(w) = (c(w) + 1) / (N + V),    p(w | h) = (c(h, w) + mu * p(w)) / (c(h) + mu).

The background counts cover every document; the target counts cover the documents of the target (in the query: labelled as of
good quality). A document's score is its loss per token under the target model minus that under the background model:
the lower, the more it is like the target.

Neither vocabulary nor bigrams are capped: the counts are Spark tables that grow with the corpus (words are told apart by 64-bit
hashes). What is sent to the executors is bounded, and holds what is met most often:

1. count the words, as words and as contexts. The ``FREQUENT_WORDS`` most frequent ones get numbers and are sent out;
2. bigrams of two numbered words are shuffled once, with the texts that hold them: a row has the bigrams of a piece of text that fall into
   one bucket, packed. A bucket has all occurrences of its bigrams, so it counts them and knows what the counts add to each text's loss.
   Bigrams of two of the most frequent words of all (``FREQUENT_PAIRS`` such bigrams) are only counted there, added up per task before;
3. bigrams with another word are stored by text, counted, joined with the counts of such words, and their losses with the texts;
4. each text's loss is summed where it is stored: bigrams of the most frequent words take their counts from what was sent out, other
   bigrams of numbered words count as occurring once. What 2 and 3 found is added.

Texts are shuffled only to mark the target documents, and not even that if the target's ids are counted and few enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, broadcast_if_small, free_shuffles, frequent_from, salts_for, store, table, text_pieces

MIN_COUNT = 2
MU = 20.0
#: Words and bigrams whose counts are sent to the executors (40 and 16 bytes each).
FREQUENT_WORDS = 1 << 20
FREQUENT_PAIRS = 1 << 20
#: Buckets are 2 ** FILTER_BITS at most, and have about ``BUCKET_TOKENS`` tokens of the corpus if there are more than shuffle partitions.
FILTER_BITS = 27
BUCKET_TOKENS = 4 << 20
#: Bytes of text that a task cuts into words at a time.
PIECE_BYTES = 4 << 20
START, UNKNOWN = 0, 1  # in place of a word's hash
_WORD = np.int64((1 << 32) - 1)
#: Bytes up to which words are hashed together.
LONG_WORD = 256
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, A-Z lower-cased, in order; each text's first word's index (n + 1 values)."""
    if texts.offset:  # pyarrow's functions read slices wrongly after a cast
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = pc.ascii_split_whitespace(texts)
    words, ends = split.flatten(), split.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    starts = np.concatenate([[0], np.cumsum(full)])[ends - ends[0]]
    return words.filter(pa.array(full)), starts.astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches (texts in column 0) in slices of about ``PIECE_BYTES`` of text, or one text."""
    for batch in batches:
        yield from text_pieces(batch, 0, PIECE_BYTES)


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of ``words`` (large_binary, no nulls): eight bytes of all words are mixed in at a time; words beyond ``LONG_WORD`` bytes singly."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64, words.offset + len(words) + 1)[words.offset:] if len(words) else np.zeros(1, np.int64)
    eights = np.lib.stride_tricks.sliding_window_view(np.append(np.frombuffer(data or b"", np.uint8), np.zeros(8, np.uint8)), 8)
    sizes = np.diff(ends)
    out = sizes.astype(np.uint64) * _MIX[0]
    rows = np.flatnonzero(sizes <= LONG_WORD)
    for done in range(0, LONG_WORD, 8):
        rows = rows[sizes[rows] > done]
        if not len(rows):
            break
        unused = np.maximum(done + 8 - sizes[rows], 0).astype(np.uint64) * np.uint64(8)
        part = eights[ends[rows] + done].view("<u8").ravel() & (np.uint64(2 ** 64 - 1) >> unused)
        mixed = (out[rows] ^ part) * _MIX[0]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX[1]
        out[rows] = mixed ^ (mixed >> np.uint64(29))
    for i in np.flatnonzero(sizes > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(words[int(i)].as_buffer())
    return out.view(np.int64)


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words; of each word its place among them; each text's first word's index."""
    words, starts = split_words(texts)
    coded = words.cast(pa.large_binary()).dictionary_encode()
    return word_hashes(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False), starts


def _contexts(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The word before each word; START before a text's first."""
    before = np.concatenate([[START], words[:-1]])[:len(words)]
    before[starts[:-1][np.diff(starts) > 0]] = START
    return before


def _flags(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).to_numpy(zero_copy_only=False).astype(bool)


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows' order by ``columns``; places in it where a new row begins, and the number of rows equal to it."""
    order = np.lexsort(columns) if len(columns) > 1 else np.argsort(columns[0])
    change = np.zeros(len(order), dtype=bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[order][1:] != c[order][:-1]
    first = np.flatnonzero(change)
    return order, first, np.diff(np.append(first, len(order)))


def _found(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in ``known`` (ascending), and whether they are there."""
    if not len(known):
        return np.zeros(len(values), np.int64), np.zeros(len(values), dtype=bool)
    order = np.argsort(values)  # neighbours are found next to each other, which is faster than jumping about
    at = np.empty(len(values), np.int64)
    at[order] = np.minimum(np.searchsorted(known, values[order]), len(known) - 1)
    return at, known[at] == values


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n, t, cn, ct): occurrences of every word of ``rows`` (text, target boolean) in all and in target documents, and as context."""
    names = ["word", "n", "t", "cn", "ct"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            distinct, codes, starts = _coded(batch.column(0))
            per, chosen = np.diff(starts), _flags(batch)
            last = codes[starts[1:][per > 0] - 1]
            n, t = (np.bincount(c, minlength=len(distinct)) for c in (codes, codes[np.repeat(chosen, per)]))
            ends, target_ends = (np.bincount(c, minlength=len(distinct)) for c in (last, last[chosen[per > 0]]))
            first = [START, 0, 0, len(last), int(chosen[per > 0].sum())]
            yield pa.RecordBatch.from_arrays([pa.array(np.append(c, f), pa.int64()) for c, f in zip((distinct, n, t, n - ends, t - target_ends), first)], names=names)

    counted = rows.mapInArrow(count, ", ".join(f"{c} long" for c in names)).groupBy("word")
    return counted.agg(*[F.sum(c).alias(c) for c in names[1:]])


def _numbered_pairs(distinct: np.ndarray, codes: np.ndarray, starts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its bigram as one number, whether both its words are numbered, and the hashes of context and word."""
    at, known = _found(distinct, words)
    numbers = np.where(known, at + 1, -1)[codes]  # 0 is the start
    before = _contexts(numbers, starts)
    w = distinct[codes]
    return (before << 32) | numbers, (numbers >= 0) & (before >= 0), _contexts(w, starts), w


@dataclass
class Model:
    """Counts of both models: stored words, totals, and what is sent out of the frequent words.

    ``numbered``: hashes of the frequent words (ascending), which occur ``least`` times or more; mu * p(w) and log(c(h) + mu) by
    number, for target and background. ``ranked``: the start and their numbers, the most frequent first.
    """
    words: DataFrame
    total: Row
    least: int
    numbered: Broadcast
    ranked: np.ndarray
    mu: float


def build_model(rows: DataFrame, mu: float = MU, most: int = FREQUENT_WORDS) -> Model:
    """The model of ``rows`` (text, target boolean); ``most``: words that are numbered."""
    none = F.lit(0).cast("long")
    words = store(word_counts(rows), "lm-words")
    proper = F.col("word") != START
    rare = [F.coalesce(F.sum(F.when(proper & (F.col("n") < MIN_COUNT), F.col(c))), none).alias("un" + c) for c in ("n", "t", "cn", "ct")]
    total = words.agg(F.coalesce(F.sum("n"), none).alias("n"), F.coalesce(F.sum("t"), none).alias("t"),
                      F.count_if(proper & (F.col("n") >= MIN_COUNT)).alias("vocabulary"), *rare).first()
    least = max(MIN_COUNT, frequent_from(words.where(proper), most))
    held = words.where(~proper | (F.col("n") >= least)).toArrow()  # ``most`` words and the start
    word, n, t, cn, ct = (held.column(c).to_numpy() for c in ("word", "n", "t", "cn", "ct"))
    order = np.argsort(word, kind="stable")
    order = order[word[order] != START]
    arrays = [word[order]]
    for own, context, size in ((t, ct, total.t), (n, cn, total.n)):
        arrays.append(np.append(1.0, mu * (own[order] + 1.0) / float(size + total.vocabulary + 2)))
        arrays.append(np.log(np.append(context[word == START].sum(), context[order]) + mu))
    ranked = np.append(0, np.argsort(-n[order], kind="stable") + 1)
    del held, word, n, t, cn, ct
    pa.default_memory_pool().release_unused()  # the driver keeps what it sends, and no more
    return Model(words, total, least, rows.sparkSession.sparkContext.broadcast(tuple(arrays)), ranked, mu)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, compressed: first all lowest bytes, last all highest ones."""
    return pa.Codec("zstd").compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T), asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(pa.Codec("zstd").decompress(data, size * 8), np.uint8).reshape(8, size).T).view("<i8").ravel()


def _buckets(pairs: np.ndarray, buckets: int) -> np.ndarray:
    x = pairs.astype(np.uint64) * _MIX[0]
    x = (x ^ (x >> np.uint64(32))) * _MIX[1]
    return ((x >> np.uint64(64 - FILTER_BITS)) % np.uint64(buckets)).astype(np.int32)


def _places(head: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Of each number (0 is the start) its place in ``head``, or -1."""
    places = np.full(len(words) + 1, -1, np.int32)
    places[head] = np.arange(len(head))
    return places


def numbered_bigrams(keyed: DataFrame, model: Model, head: np.ndarray) -> DataFrame:
    """(counted, key, x, y) of the bigrams of two numbered words in ``keyed`` (text, key: odd for target texts).

    Bigrams of two words of ``head``: counted, the bigram's number as key, its target count and count in all. Others: a text's key, and what
    their counts add to its losses under the target and the background model as if they occurred once, summed over equal texts.
    """
    numbered, size = model.numbered, len(head)
    buckets = max(1, min(max(salts_for(keyed.sparkSession), model.total.n // BUCKET_TOKENS), 1 << FILTER_BITS))
    names = ["bucket", "size", "pairs", "docs", "times", "keys"]

    def dealt(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, keys: np.ndarray | None) -> pa.RecordBatch:
        """A row for each bucket's part of the ascending ``pairs``; without ``keys``, docs are the target counts."""
        bucket = _buckets(pairs, buckets)
        order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
        bucket, pairs, docs, times = bucket[order], pairs[order], docs[order], times[order]
        edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        rows = []
        for lo, hi in zip(edges[:-1], edges[1:]):
            own, held = docs[lo:hi], None
            if keys is not None:
                held, own = np.unique(own, return_inverse=True)
                held = keys[held].tobytes()
            rows.append((bucket[lo], hi - lo, _packed(np.diff(pairs[lo:hi], prepend=0)), _packed(own), _packed(times[lo:hi]), held))
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int32()] * 2 + [pa.binary()] * 4)], names=names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = numbered.value[0]
        places, cells = _places(head, words), np.zeros((2, size * size), np.int64)
        for batch in _pieces(batches):
            distinct, codes, starts = _coded(batch.column(0))
            keys, doc = np.unique(batch.column(1).to_numpy(zero_copy_only=False), return_inverse=True)
            at, known = _found(distinct, words)
            local = np.append(0, np.sort(at[known]) + 1)  # the piece's numbers, ascending
            w = np.where(known, np.searchsorted(local, at + 1), -1)[codes]
            h, row, place = _contexts(w, starts), np.repeat(doc, np.diff(starts)), places[local]
            both = (w >= 0) & (h >= 0)
            counted = both & (place[h] >= 0) & (place[w] >= 0)
            cell = place[h[counted]].astype(np.int64) * size + place[w[counted]]
            for c, chosen in zip(cells, (cell, cell[keys[row[counted]] & 1 == 1])):
                c += np.bincount(chosen, minlength=size * size)
            both &= ~counted
            found, times = np.unique((h[both] * len(local) + w[both]) * len(keys) + row[both], return_counts=True)
            pair, docs = np.divmod(found, len(keys))
            h, w = np.divmod(pair, len(local))
            yield dealt(local[h] << 32 | local[w], docs, times, keys)
        met = np.flatnonzero(cells[0])
        pairs = head[met // size] << 32 | head[met % size]
        order = np.argsort(pairs)
        yield dealt(pairs[order], cells[1][met[order]], cells[0][met[order]], None)

    def added(rows: pa.Table) -> pa.Table:
        _, target, _, background, _ = numbered.value
        parts, held, heads, texts = [], [], [], 0
        for r in range(rows.num_rows):
            n, keys = rows["size"][r].as_py(), rows["keys"][r].as_py()
            pairs, docs, times = (_unpacked(rows[c][r].as_py(), n) for c in ("pairs", "docs", "times"))
            if keys is None:
                heads.append((np.cumsum(pairs), docs.astype(float), times.astype(float)))
            else:
                held.append(np.frombuffer(keys, np.int64))
                parts.append((np.cumsum(pairs), docs + texts, times))
                texts += len(held[-1])
        out = [(np.full(len(h[0]), True), *h) for h in heads]
        if parts:
            pair, doc, times = (np.concatenate(c) for c in zip(*parts))
            key = np.concatenate(held)
            once = (key & 1)[doc]
            pair, at = np.unique(pair, return_inverse=True)
            sums = []
            for p, o, n in ((target, once, np.bincount(at, times * once)), (background, np.ones_like(once), np.bincount(at, times))):
                p = p[pair & _WORD]
                alone = np.stack([np.log(p), np.log(p + 1.0)])
                sums.append(np.bincount(doc, (alone[o, at] - np.log(p + n)[at]) * times, minlength=texts))
            some = (sums[0] != 0) | (sums[1] != 0)
            out.append((np.full(some.sum(), False), key[some], sums[0][some], sums[1][some]))
        return pa.table({c: np.concatenate([o[i] for o in out]) for i, c in enumerate(("counted", "key", "x", "y"))})

    rows = keyed.select("text", "key").mapInArrow(blocks, "bucket int, size int, pairs binary, docs binary, times binary, keys binary")
    rows = rows.groupBy("bucket").applyInArrow(added, "counted boolean, key long, x double, y double")
    return rows.groupBy("counted", "key").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))


def other_bigrams(keyed: DataFrame, numbered: Broadcast) -> DataFrame:
    """(key, h, w, kind, times): of each text of ``keyed`` (text, key) the bigrams with a word that isn't numbered, as hashes; kind: 1 if h is numbered, 2 if w is."""
    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = numbered.value[0]
        for batch in _pieces(batches):
            distinct, codes, starts = _coded(batch.column(0))
            w, known = distinct[codes], _found(distinct, words)[1].astype(np.int64)[codes]
            h, before = _contexts(w, starts), np.append(1, known)[:len(known)]
            before[starts[:-1][np.diff(starts) > 0]] = 1  # the start
            kind = before + 2 * known
            some = kind < 3
            row = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            columns = w[some], h[some], row[some]
            order, first, times = _distinct(*columns)
            at = order[first]
            w, h, row = (pa.array(c[at], pa.int64()) for c in columns)
            yield pa.RecordBatch.from_arrays([batch.column(1).take(row), h, w, pa.array(kind[some][at], pa.int8()), pa.array(times, pa.int32())], names=["key", "h", "w", "kind", "times"])

    return keyed.select("text", "key").mapInArrow(bigrams, "key long, h long, w long, kind tinyint, times int")


def other_losses(model: Model, rows: DataFrame) -> DataFrame:
    """(pair, x, y) of the bigrams in ``rows`` (as of ``other_bigrams``): their losses under the target and the background model."""
    total, mu, numbered = model.total, model.mu, model.numbered
    odd = F.col("key").bitwiseAND(F.lit(1))
    bigrams = store(rows.groupBy("h", "w", "kind").agg(F.sum("times").alias("n"), F.sum(F.col("times") * odd).alias("t")), "lm-bigrams")
    known = model.words.where((F.col("n") >= MIN_COUNT) & (F.col("n") < model.least) & (F.col("word") != START))
    own = broadcast_if_small(store(known, "lm-vocabulary"))

    def looked_up(rows: DataFrame, bit: int, word: str, n: str, t: str) -> DataFrame:
        counts = own.select(F.col("word").alias(word), F.col(n).alias(word + "n"), F.col(t).alias(word + "t"))
        there = F.col("kind").bitwiseAND(F.lit(bit)) != 0
        asked = rows.where(~there).join(counts, word, "left")
        return asked.withColumn(word + "u", F.col(word + "n").isNull()).unionByName(rows.where(there).withColumn(word + "u", F.lit(False)), allowMissingColumns=True)

    found = store(looked_up(looked_up(bigrams, 2, "w", "n", "t"), 1, "h", "cn", "ct"), "lm-rare")
    # a bigram that has an unknown word is counted with all others of its kind
    kind = {k: F.when(F.col(c + "u"), UNKNOWN).otherwise(F.col(c)).alias(k) for k, c in (("kh", "h"), ("kw", "w"))}
    strange = found.where("hu OR wu").select("*", *kind.values())
    kinds = strange.groupBy("kh", "kw").agg(F.sum("n").alias("kn"), F.sum("t").alias("kt"))
    joined = strange.join(broadcast_if_small(store(kinds, "lm-unknown")), ["kh", "kw"]).drop("kh", "kw")
    found = found.where("NOT hu AND NOT wu").withColumn("kn", F.col("n")).withColumn("kt", F.col("t")).unionByName(joined)

    @F.arrow_udf("struct<x: double, y: double>")
    def losses(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        words, target, target_context, background, background_context = numbered.value
        for batch in batches:
            h, w, kind, kt, kn, wt, wn, ht, hn = (c.to_numpy(zero_copy_only=False) for c in batch)
            before, own = kind & 1 > 0, kind & 2 > 0
            h = np.where(before & (h != START), _found(h, words)[0] + 1, 0)
            w = np.where(own, _found(w, words)[0] + 1, 0)
            out = []
            for p, c, pairs, word, context, size in ((target, target_context, kt, wt, ht, total.t), (background, background_context, kn, wn, hn, total.n)):
                p = np.where(own, p[w], mu * (word + 1.0) / float(size + total.vocabulary + 2))
                out.append(pa.array(np.where(before, c[h], np.log(context + mu)) - np.log(pairs + p)))
            yield pa.StructArray.from_arrays(out, names=["x", "y"])

    counts = [F.coalesce(c, F.lit(unknown)) for c, unknown in (("wt", total.unt), ("wn", total.unn), ("ht", total.unct), ("hn", total.uncn))]
    found = found.select(F.xxhash64("h", "w").alias("pair"), losses("h", "w", F.col("kind").cast("int"), "kt", "kn", *counts).alias("l"))
    return found.select("pair", "l.x", "l.y")


def text_losses(texts: DataFrame, model: Model, most: int = FREQUENT_PAIRS) -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background): mean losses of ``texts`` (doc_id, text, target); ``most``: bigrams whose counts are sent out.

    The rows returned come from stored tables alone, so they need nothing that was sent out.
    """
    numbered, head = model.numbered, model.ranked[:isqrt(most)]
    size = len(head)
    names = ["loss_target", "loss_background"]
    keyed = texts.withColumn("key", F.xxhash64("text").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("target").cast("long")))
    found = store(numbered_bigrams(keyed, model, head), "lm-numbered")
    held = found.where("counted").toArrow()  # ``most`` rows
    pair, at = held.column("key").to_numpy(), np.zeros(len(model.ranked), np.int64)
    at[head] = np.arange(size)
    cell, counts = at[pair >> 32] * size + at[pair & _WORD], np.zeros((2, size * size))
    for c, name in zip(counts, "xy"):
        c[cell] = held.column(name).to_numpy()
    frequent = texts.sparkSession.sparkContext.broadcast((head, *counts))
    del held, pair, at, cell, counts
    pa.default_memory_pool().release_unused()

    others = store(other_bigrams(keyed, numbered), "lm-others")
    losses = store(other_losses(model, others), "lm-losses")
    others = others.select("key", F.xxhash64("h", "w").alias("pair"), "times").join(losses, "pair").select("key", *[(F.col(c) * F.col("times")).alias(c) for c in "xy"])
    more = found.where("NOT counted").select("key", "x", "y").union(others)
    more = more.groupBy("key").agg(F.sum("x").alias("more_target"), F.sum("y").alias("more_background"))
    copies = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))  # equal texts have their rows joined once each
    more = more.join(copies, "key").select("key", *[(F.col(c) / F.col("copies")).alias(c) for c in ("more_target", "more_background")])

    @F.arrow_udf("struct<n_tokens: long, loss_target: double, loss_background: double>")
    def sums(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        words, target, target_context, background, background_context = numbered.value
        head, in_target, in_all = frequent.value
        places = _places(head, words)
        for batch in batches:
            out = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))]
            for piece in text_pieces(pa.RecordBatch.from_arrays(list(batch), names=["text", "target"]), 0, PIECE_BYTES):
                distinct, codes, starts = _coded(piece.column(0))
                per = np.diff(starts)
                flags = np.repeat(_flags(piece), per)
                pair, both, _, _ = _numbered_pairs(distinct, codes, starts, words)
                own, before = pair[both] & _WORD, pair[both] >> 32
                at, known = places[before].astype(np.int64) * size + places[own], (places[before] >= 0) & (places[own] >= 0)
                both_losses = []
                for p, c, f, once in ((target, target_context, in_target, flags[both]), (background, background_context, in_all, np.ones(len(own)))):
                    counted = once.astype(float)
                    counted[known] = f[at[known]]
                    loss = np.zeros(len(codes))
                    loss[both] = c[before] - np.log(p[own] + counted)
                    both_losses.append(np.diff(np.append(0.0, np.cumsum(loss))[starts]))
                out.append((per, *both_losses))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["n_tokens", *names])

    more, rows = store(more, "lm-texts"), store(keyed.select("doc_id", "key", sums("text", "target").alias("l")), "lm-sums")
    frequent.destroy()  # all that needs it is stored
    rows = rows.join(broadcast_if_small(more), "key", "left")
    total = [F.col(f"l.{c}") + F.coalesce("more" + c[4:], F.lit(0.0)) for c in names]
    return rows.select("doc_id", "l.n_tokens", *[F.when(F.col("l.n_tokens") > 0, x / F.col("l.n_tokens")).otherwise(F.lit(0.0)).alias(c) for x, c in zip(total, names)])


def score_documents(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", mu: float = MU) -> DataFrame:
    """One row per document: doc_id, n_tokens, loss_target, loss_background (nats per token), score (their difference).

    ``target_ids``: doc_id of the target documents; repeats and nulls in it don't matter. Texts without words, null ones
    included, have no tokens and losses and score 0. Repeated rows count each time and score alike. Without any target
    document the target model is the smoothed uniform one. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    free_shuffles(docs.sparkSession)
    ids = target_ids.select(F.col("doc_id").alias("__id")).where("__id IS NOT NULL").distinct().withColumn("__target", F.lit(True))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = texts.join(broadcast_if_small(store(ids, "lm-target")), F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", F.coalesce("__target", F.lit(False)).alias("target"))
    model = build_model(marked.select("text", "target"), mu, FREQUENT_WORDS)
    rows = text_losses(marked, model)
    model.numbered.destroy()
    return rows.withColumn("score", F.col("loss_target") - F.col("loss_background"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return score_documents(table(spark, sf_dir, "documents"), good)
