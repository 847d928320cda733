"""Operator 6, substring dedup: paragraph MinHash banding.

A paragraph is a line (between line breaks) of at least ``min_words`` words; its normal form has A-Z lower-cased and words
joined by one blank. Equal normal forms are one class from the start (64-bit hash). The others:

1. MinHash signatures over five-word shingles; rows per band are given, and ``tune_bands`` takes as many bands as a
   pair at the threshold needs to collide with the wanted recall;
2. distinct paragraphs that collide in a band form a bucket; buckets with the same members (a pair that collides in
   several bands) are processed once; a bucket of more than ``max_bucket`` is dealt into tiles, each pair of tiles is a
   bucket of its own, so that no task holds a whole group and no pair is lost;
3. inside a bucket pairs are verified exactly (Jaccard of the shingle sets at least ``threshold``), except pairs that
   are linked already; only spanning links leave the task;
4. components of the links are the classes. Of a class whose paragraphs lie in several documents, the paragraph of the
   document with the smallest id stays and all others are removed. Repeats inside one document alone stay.

Lines miss passages inside longer lines and passages wrapped over short lines. With ``passage`` given (the query and the pipeline
give 50), the words left are read as one sequence per document, over line ends, and every run of so many words that stands in
several documents stays in the one with the smallest id only:

5. of the half-length runs of words the least hash of each window of ``passage`` words is kept (winnowing), so two
   documents with a window in common always share a hash;
6. only windows that hold a shared hash are hashed as a whole and counted by document; the words of those that lie
   in several are cut from all but the keeper.

Signatures and ids are shuffled with partial aggregation. Texts meet two tables: the ids of colliding paragraphs, and the
list of each document's removed paragraphs. Either is broadcast if it is counted and found small; else that join shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import ASCII_LOWER, ascii_lower, bounded_batches, broadcast_if_small, connected_components, grouped, store, table
from retentia.llm.op10_lm_scoring import split_words

SHINGLE = 5
THRESHOLD = 0.8
MIN_WORDS = 25
#: Words of a passage that is found wherever it stands.
PASSAGE = 50
#: Bytes of text whose windows are hashed at a time.
PIECE_BYTES = 4 << 20
BAND_ROWS = 3
RECALL = 0.998
MAX_BUCKET = 2048
#: Shingle sets that a task keeps between buckets.
MAX_SETS = 1500
SEED = 20240607


def tune_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """Fewest bands of ``rows`` minima in which a pair at the threshold collides with probability ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold ** rows)))


def normal_form(line: str) -> bytes:
    return b" ".join(line.encode().translate(ASCII_LOWER).split())


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signatures(paragraphs: list[bytes], bands: int, rows: int = BAND_ROWS, shingle: int = SHINGLE) -> np.ndarray:
    """Band keys (paragraphs x bands, int64) of normal forms with at least ``shingle`` words each."""
    words = [p.split(b" ") for p in paragraphs]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    coded = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode()
    distinct = np.array([xxhash.xxh64_intdigest(x, SEED) for x in coded.dictionary.to_pylist()], dtype=np.uint64)
    h = distinct[coded.indices.to_numpy(zero_copy_only=False)]
    n = len(h) - shingle + 1
    s = np.zeros(n, dtype=np.uint64)
    for i in range(shingle):
        s = _mix(s + h[i:i + n] + np.uint64(i))
    ends = np.cumsum(counts)
    inside = np.ones(n, dtype=bool)  # shingles that don't reach into the next paragraph
    for i in range(1, shingle):
        inside[ends[:-1] - i] = False
    s = s[inside]
    per = counts - shingle + 1
    starts = np.cumsum(per) - per
    rng = np.random.default_rng(SEED)
    keys = np.zeros((len(paragraphs), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(paragraphs), b, dtype=np.uint64)
        for _ in range(rows):
            a, c = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            key = _mix(key + np.minimum.reduceat(s * (a * np.uint64(2) + np.uint64(1)) + c, starts))
        keys[:, b] = key
    return keys.view(np.int64)


PARAGRAPHS = "array<struct<paragraph: int, pid: long, bands: array<long>>>"


def paragraph_signatures(docs: DataFrame, text: Column, bands: int, min_words: int) -> DataFrame:
    """(columns of docs, paragraph, pid, bands): one row per paragraph with its place among the lines."""
    @F.arrow_udf(PARAGRAPHS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            held, place, sizes = [], [], []
            for t in texts.to_pylist():
                before = len(held)
                for i, line in enumerate(t.split("\n") if t else ()):
                    p = normal_form(line)
                    if p.count(b" ") + 1 >= min_words and p:
                        held.append(p)
                        place.append(i)
                sizes.append(len(held) - before)
            keys = np.zeros((0, bands), dtype=np.int64)
            lo = 0
            parts = [keys]
            while lo < len(held):  # signatures of some 2 MB of paragraphs at a time
                hi, size = lo, 0
                while hi < len(held) and (size < 1 << 21 or hi == lo):
                    size += len(held[hi])
                    hi += 1
                parts.append(signatures(held[lo:hi], bands))
                lo = hi
            keys = np.concatenate(parts)
            pids = np.array([xxhash.xxh64_intdigest(p, 42) for p in held], dtype=np.uint64).view(np.int64)
            band_lists = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
            rows = pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(pids), band_lists], names=["paragraph", "pid", "bands"])
            yield pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), rows)

    return docs.select("*", F.explode(run(text)).alias("p")).select(*docs.columns, "p.paragraph", "p.pid", "p.bands")


def _shingles(p: bytes, shingle: int = SHINGLE) -> set:
    words = p.split(b" ")
    return set(zip(*[words[i:] for i in range(shingle)]))


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def verified_links(pids: list, sets: list, tiles: list, threshold: float, tile_pair: tuple) -> list[tuple]:
    """Spanning links among a bucket's paragraphs. With two tiles only pairs across them are compared."""
    order = sorted(range(len(pids)), key=lambda i: len(sets[i]))
    parent = {i: i for i in order}

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            if len(sets[i]) < threshold * len(sets[j]):
                break  # the sets are too different in size, and later ones are larger still
            if tile_pair[0] != tile_pair[1] and tiles[i] == tiles[j]:
                continue
            a, b = find(i), find(j)
            if a != b and jaccard(sets[i], sets[j]) >= threshold:
                parent[a] = b
                out.append((pids[i], pids[j]))
    return out


def paragraph_links(paragraphs: DataFrame, lines: DataFrame, threshold: float = THRESHOLD, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Verified links (a, b) between the pids of ``paragraphs`` (pid, bands); ``lines`` (pid, normal) gives their normal forms."""
    distinct = paragraphs.groupBy("pid").agg(F.first("bands").alias("bands"))
    banded = distinct.select("pid", F.explode("bands").alias("key"))
    # buckets of two or more; of buckets with the same members one
    buckets = (banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("pid")).alias("members")).where("n > 1")
               .groupBy("n", "members").agg(F.min("key").alias("key")).select("key", "n"))
    members = banded.join(broadcast_if_small(store(buckets, "substring-buckets")), "key")
    tiles = F.ceil(F.col("n") / max_bucket).cast("int")
    members = members.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("pid"), F.col("tiles")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    members = store(members.select("key", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"), "tile", "pid"), "substring-members")
    wanted = store(members.select("pid").distinct(), "substring-wanted")
    texts = lines.join(broadcast_if_small(wanted), "pid", "left_semi").groupBy("pid").agg(F.first("normal").alias("normal"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets: dict[int, set] = {}
        for (_, t1, t2), group in grouped(batches, ["key", "t1", "t2"]):
            if len(sets) > MAX_SETS:
                sets.clear()
            pids = group["pid"].tolist()
            for p, text in zip(pids, group["normal"]):
                if p not in sets:
                    sets[p] = _shingles(text.encode())
            links = verified_links(pids, [sets[p] for p in pids], group["tile"].tolist(), threshold, (t1, t2))
            if links:
                yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    dealt = members.join(texts, "pid").repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2")
    return dealt.mapInPandas(verify, "a long, b long")


def normal_lines(docs: DataFrame, text: Column, min_words: int) -> DataFrame:
    """(pid, normal) of every paragraph, computed by Spark's functions (the same rule as ``normal_form``)."""
    line = F.col("line")
    # for ASCII lines the plain function is the same rule, and much faster; most lines have single blanks only
    low = F.when(F.char_length(line) == F.octet_length(line), F.lower(line)).otherwise(ascii_lower(line))
    uneven = line.contains("  ") | line.rlike("[\\x09-\\x0D]")
    normal = F.trim(F.when(uneven, F.regexp_replace(low, "[\\x09-\\x0D ]+", " ")).otherwise(low))
    lines = docs.select(F.explode(F.split(text, "\n", -1)).alias("line")).where(F.length("line") >= 2 * min_words - 1).select(normal.alias("normal"))
    return lines.where(F.length("normal") - F.length(F.translate("normal", " ", "")) + 1 >= min_words).select(F.xxhash64("normal").alias("pid"), "normal")


def window_hashes(texts: pa.Array, passage: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every ``passage`` words in a row inside a text: (text, first word, least hash of the half-length runs in it, own hash), by pieces."""
    sizes = np.cumsum([len(t) if t else 0 for t in texts.to_pylist()])
    half, lo = passage // 2, 0
    runs = passage - half + 1
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + PIECE_BYTES, "right")))
        words, starts = split_words(texts.slice(lo, hi - lo))
        coded = words.cast(pa.large_binary()).dictionary_encode()
        distinct = np.array([xxhash.xxh64_intdigest(x, SEED) for x in coded.dictionary.to_pylist()], dtype=np.uint64)
        h = distinct[coded.indices.to_numpy(zero_copy_only=False)]
        n = len(h) - passage + 1
        if n > 0:
            rolled = np.zeros(len(h) - half + 1, dtype=np.uint64)
            for i in range(half):
                rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[i:i + len(rolled)]
            rolled = _mix(rolled)
            least, width = rolled, 1
            while 2 * width <= runs:
                least, width = np.minimum(least[:-width], least[width:]), 2 * width
            least = np.minimum(least[:n], least[runs - width:runs - width + n])
            own = _mix(_mix(rolled[:n] + np.uint64(1)) ^ rolled[passage - half:passage - half + n])
            text = np.repeat(np.arange(hi - lo), np.diff(starts))[:n]
            inside = np.flatnonzero(np.arange(n) + passage <= starts[text + 1])
            text = text[inside]
            yield text + lo, inside - starts[text], least[inside].view(np.int64), own[inside].view(np.int64)
        lo = hi


def _lists(text: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """Per text (``text`` ascends) its values."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), values)


def passage_spans(docs: DataFrame, passage: int) -> DataFrame:
    """(doc_id, text_hash, passages): the words (word, words) of each document of ``docs`` (doc_id, text_hash, text; stored) that stand,
    in runs of ``passage`` or more, in a document before it."""
    @F.arrow_udf("array<long>")
    def least_hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            text, least = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for t, _, m, _ in window_hashes(texts, passage):
                new = np.ones(len(t), dtype=bool)
                new[1:] = (t[1:] != t[:-1]) | (m[1:] != m[:-1])
                text.append(t[new])
                least.append(m[new])
            yield _lists(np.concatenate(text), len(texts), pa.array(np.concatenate(least)))

    @F.arrow_udf("array<struct<word: int, own: long>>")
    def windows(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, shared in batches:
            wanted = np.unique(shared.flatten().to_numpy(zero_copy_only=False))
            parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for t, word, m, own in window_hashes(texts, passage):
                held = np.isin(m, wanted)  # a hash that another text of the batch shares is shared as well
                parts.append((t[held], word[held], own[held]))
            text, word, own = (np.concatenate(x) for x in zip(*parts))
            yield _lists(text, len(texts), pa.StructArray.from_arrays([pa.array(word, pa.int32()), pa.array(own)], names=["word", "own"]))

    document = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    key = F.xxhash64("doc_id", "text_hash")
    hashes = store(docs.select(key.alias("doc"), F.explode(F.array_distinct(least_hashes("text"))).alias("least")).distinct(), "substring-hashes")
    shared = hashes.groupBy("least").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("least")
    shared = hashes.join(broadcast_if_small(store(shared, "substring-shared")), "least").groupBy("doc").agg(F.collect_list("least").alias("shared"))
    shared = broadcast_if_small(store(shared, "substring-lists"), F.size("shared"))
    found = docs.withColumn("doc", key).join(shared, "doc").select("doc_id", "text_hash", F.explode(windows("text", "shared")).alias("w"))
    found = store(found.select("doc_id", "text_hash", "w.word", "w.own"), "substring-windows")
    keepers = found.groupBy("own").agg(F.min(document).alias("keeper"), F.max(document).alias("high")).where("keeper <> high").select("own", "keeper")
    later = found.join(broadcast_if_small(store(keepers, "substring-keepers")), "own").where(document != F.col("keeper"))
    words = later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("word")).alias("words"))

    @F.arrow_udf("array<struct<word: int, words: int>>")
    def merged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for found in batches:
            out = []
            for first in found.to_pylist():
                at = np.array(first)
                new = np.flatnonzero(np.diff(at, prepend=-passage - 1) > passage)
                ends = at[np.append(new[1:], len(at)) - 1] + passage
                out.append([{"word": int(a), "words": int(b - a)} for a, b in zip(at[new], ends)])
            yield pa.array(out, pa.list_(pa.struct([("word", pa.int32()), ("words", pa.int32())])))

    return words.select("doc_id", "text_hash", merged("words").alias("passages"))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut_words(text: str, passages: list) -> str:
    """The text without the words of ``passages`` (dicts of word and words) and the white space after them; a line that stays begun ends."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for x in passages:
        start, last = at[x["word"]][0], at[x["word"] + x["words"] - 1][1]
        after = at[x["word"] + x["words"]][0] if x["word"] + x["words"] < len(at) else len(text)
        out.append(text[done:start])
        if start and text[start - 1] != "\n" and "\n" in text[last:after]:
            out.append("\n")
        done = after
    return "".join([*out, text[done:]])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                threshold: float = THRESHOLD, recall: float = RECALL, max_bucket: int = MAX_BUCKET,
                passage: int | None = None) -> DataFrame:
    """One row per input row: (row struct of all input columns, doc_id, clean_text, removed).

    ``removed`` is null or an array of (paragraph, keeper_doc_id, keeper_paragraph), by paragraph number from 0; clean_text is
    the text without those lines. Null and empty texts have no paragraphs. Rows with equal id and text are one
    document and get equal results; rows with equal id and different texts are different documents; null ids come last in
    the order of ids. An empty table gives no rows. With ``passage``, clean_text is also without the words of ``passages``, null or
    an array of (word, words), counted in the text without the removed lines.
    """
    if min_words < SHINGLE:
        raise ValueError(f"paragraphs need at least {SHINGLE} words")
    bounded_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = paragraph_signatures(keyed, F.col("text"), tune_bands(threshold, recall), min_words).drop("text")
    found = store(found, "substring-paragraphs")
    links = paragraph_links(found, normal_lines(keyed, F.col("text"), min_words), threshold, max_bucket)
    classes = broadcast_if_small(connected_components(links))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "paragraph")
    own = found.select("doc_id", "text_hash", "paragraph", "pid").join(classes.withColumnRenamed("node", "pid"), "pid", "left")
    own = own.select("doc_id", "text_hash", "paragraph", F.coalesce("component", "pid").alias("class"), place.alias("place"))
    document = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    shared = (own.groupBy("class").agg(F.min("place").alias("keeper"), F.min(document).alias("low"), F.max(document).alias("high"))
              .where("low <> high").select("class", "keeper"))
    shared = store(shared, "substring-classes")
    removed = (own.join(broadcast_if_small(shared), "class").where(F.col("place") != F.col("keeper"))
               .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct(
                   "paragraph", F.col("keeper.doc_id").alias("keeper_doc_id"), F.col("keeper.paragraph").alias("keeper_paragraph")))).alias("removed")))
    # rows with equal id and text repeat their paragraphs
    removed = store(removed.withColumn("removed", F.array_distinct("removed")), "substring-removed")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_hash")).alias("d")
    rows = rows.join(broadcast_if_small(removed, F.size("removed")).alias("r"), F.expr("d.doc_id <=> r.doc_id AND d.text_hash = r.text_hash"), "left")
    gone = F.transform("removed", lambda x: x["paragraph"])
    left = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(gone, i))
    clean = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    if passage is None:
        return rows.select("row", "d.doc_id", clean.alias("clean_text"), "removed")
    rows = store(rows.select("row", "d.doc_id", "d.text_hash", clean.alias("clean_text"), "removed"), "substring-lines")
    spans = passage_spans(rows.select("doc_id", "text_hash", F.col("clean_text").alias("text")), passage)
    rows = rows.alias("d").join(broadcast_if_small(store(spans, "substring-passages"), F.size("passages")).alias("r"),
                                F.expr("d.doc_id <=> r.doc_id AND d.text_hash = r.text_hash"), "left")

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            yield pa.array([cut_words(t, x) if x else t for t, x in zip(texts.to_pylist(), found.to_pylist())], pa.string())

    return rows.select("row", "d.doc_id", cut("clean_text", "passages").alias("clean_text"), "removed", "passages")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), passage=PASSAGE)
    return rows.select("doc_id", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
                       F.transform("removed", lambda x: x["paragraph"]).alias("removed_paragraphs"),
                       F.transform("removed", lambda x: x["keeper_doc_id"]).alias("kept_in"), "passages", F.col("clean_text").alias("text"))
