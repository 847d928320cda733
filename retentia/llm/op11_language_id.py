"""Operator 11, language ID: language-bitmask n-gram filters.

1. Spark counts, for each language and n-gram of letters, the training documents that hold it (distinct grams per document, pre-aggregated per
   batch). A language contains the grams that ``SHARE`` of its documents or more hold, and two documents at least. A share doesn't
   wear off as the corpus grows, and it bounds the grams of a language by (distinct grams of a document) / share;
2. the languages' Bloom filters are stored bit-sliced: slot s of the table is a bitmask in which bit l is bit s of language l's filter
   (more than 64 languages take more masks per slot). The table is aggregated in Spark: every gram sends its mask to its slots, ``bit_or``
   joins them;
3. a gram is looked up once for all languages: the AND of the masks in its slots is the set of languages that contain it;
4. per document the masks of its distinct grams are popcounted per language. A filter that is filled to a part f lets a foreign gram
   through with probability f^hashes, so with n grams and c hits the corrected count is (c - n f^k) / (1 - f^k). The largest decides.

The grams of a language and the table have bounded sizes, and only the table goes to the driver and from there to the workers as a
broadcast. Texts are read where they are, once to learn and once to predict.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, per_worker, store, table, text_pieces

UNDETERMINED = "und"
#: Code points in a gram; a word has one blank on either side.
LENGTHS = (3, 4)
#: Part of a language's documents that hold a gram of the language.
SHARE = 0.01
HASHES = 4
SLOTS_PER_GRAM = 16
#: Slots of the table: 16 for each gram of the richest language, within these powers of two. A fuller table lets more foreign grams through,
#: which the counts are corrected for.
MIN_BITS, MAX_BITS = 10, 22
MAX_LANGUAGES = 4096
FOLDS, HELD_FOLD = 4, 2
#: Bytes of text whose grams are held at a time (or one text).
PIECE_BYTES = 1 << 18

_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def held_out(doc_id: Column) -> Column:
    """Documents never learned from; those without an id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_FOLD, F.lit(True))


def _letters() -> np.ndarray:
    """Per code point: 1 for letters, 2 for marks that go with letters, 0 for all else."""
    kinds = {"L": 1, "M": 2}
    return np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], dtype=np.uint8)


def letter_grams(texts: list[str | None], lengths: Sequence[int] = LENGTHS) -> tuple[list[np.ndarray], np.ndarray]:
    """64-bit hashes of the distinct grams of each text, ascending; and whether a text has a letter.

    Texts are lower-cased; what is no letter or mark separates words. A gram of three or more places has blanks at its ends only.
    """
    kinds = per_worker(("letters",), _letters)
    lowered = [t.lower() if t else "" for t in texts]
    chars = np.frombuffer(f" {' '.join(lowered)}   ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = kinds[chars]
    full = kind > 0
    start = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered], dtype=np.int64)])  # the last one is behind all texts
    first = np.concatenate([[0], np.cumsum(kind == 1)])
    has_letter = first[start[1:] - 1] > first[start[:-1]]
    kept = full.copy()  # one blank between words
    kept[0] = True
    kept[1:] |= full[:-1]
    place = np.concatenate([[0], np.cumsum(kept)])[start]
    c = np.append(np.where(full, chars, 0)[kept].astype(np.uint64), np.zeros(max(lengths), dtype=np.uint64))
    hashes, starts = [], []
    for n in lengths:
        m = len(c) - max(lengths)
        whole = np.ones(m, dtype=bool)
        h = np.full(m, n, dtype=np.uint64)
        for k in range(n):
            if 0 < k < n - 1:
                whole &= c[k:m + k] > 0
            h *= _MULTIPLY
            h += c[k:m + k]
        h ^= h >> np.uint64(29)
        h *= _MIX
        h ^= h >> np.uint64(32)
        at = np.flatnonzero(whole)
        hashes.append(h[at])
        starts.append(np.searchsorted(at + 1, place))  # a gram's second place is a letter of its text
    out = []
    for i in range(len(texts)):
        own = np.sort(np.concatenate([h[cut[i]:cut[i + 1]] for h, cut in zip(hashes, starts)]))
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
    return out, has_letter


@dataclass
class Filters:
    """The languages' names, which of them has most documents, the bit-sliced table and each filter's false-positive rate."""
    languages: list[str]
    default: str | None
    masks: np.ndarray  # (languages / bits of a mask, slots)
    passing: np.ndarray

    def contained(self, grams: np.ndarray) -> np.ndarray:
        """For each gram a row of 0 and 1: the languages that contain it."""
        low, high = grams & np.uint64(0xFFFFFFFF), grams >> np.uint64(32) | np.uint64(1)
        last = np.uint64(self.masks.shape[1] - 1)
        found = self.masks[:, low & last]
        for k in range(1, HASHES):
            found &= self.masks[:, low + np.uint64(k) * high & last]
        bits = np.unpackbits(np.ascontiguousarray(found.T).view(np.uint8), axis=1, bitorder="little")
        return bits.reshape(len(grams), -1)[:, :len(self.languages)]

    def predict(self, texts: list[str | None], lengths: Sequence[int]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        grams, has_letter = letter_grams(texts, lengths)
        n = np.array(list(map(len, grams)), dtype=np.int64)
        counts = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(n)
        if len(full) and self.languages:
            starts = (np.cumsum(n) - n)[full]
            counts[full] = np.add.reduceat(self.contained(np.concatenate(grams)), starts, axis=0, dtype=np.int64)
        counts = np.maximum((counts - n[:, None] * self.passing) / (1 - self.passing), 0)
        names, scores = [], np.zeros(len(texts))
        for i, own in enumerate(counts):
            if not has_letter[i] or not self.languages:
                names.append(UNDETERMINED)
                continue
            best = int(own.argmax())
            if own[best] <= 0:
                names.append(self.default)
                continue
            names.append(self.languages[best])
            scores[i] = own[best] / (own[best] + max(np.delete(own, best), default=0.0))
        return names, scores


def document_counts(rows: DataFrame, lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """(lang, gram, n): documents of ``rows`` (lang, text) that hold each gram, by language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            for piece in text_pieces(batch, "text", PIECE_BYTES):
                grams, _ = letter_grams(piece.column("text").to_pylist(), lengths)
                for lang, own in zip(piece.column("lang").to_pylist(), grams):
                    held.setdefault(lang, []).append(own)
            for lang, own in held.items():
                grams, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    return rows.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, share: float = SHARE, lengths: Sequence[int] = LENGTHS) -> Filters:
    """Filters of the languages of ``rows`` (lang, text); rows without a language are left out.

    Raises ValueError for more than ``MAX_LANGUAGES`` languages.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    rows = rows.where("lang IS NOT NULL")
    documents = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("documents")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(documents) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r.lang for r in documents]
    numbered = spark.createDataFrame([(r.lang, i, r.documents) for i, r in enumerate(documents)], "lang string, number int, documents long")
    counted = document_counts(rows, lengths).join(F.broadcast(numbered), "lang")  # MAX_LANGUAGES rows at most
    enough = (F.col("n") >= 2) & (F.col("n") >= share * F.col("documents"))
    grams = store(counted.where(enough).select("number", "gram"), "language-grams")
    most = max((r[1] for r in grams.groupBy("number").count().collect()), default=0)  # a row per language
    bits = min(max((SLOTS_PER_GRAM * most - 1).bit_length(), MIN_BITS), MAX_BITS)
    width = next((w for w in (8, 16, 32) if len(languages) <= w), 64)
    masks = grams.groupBy("gram", F.floor(F.col("number") / width).cast("int").alias("part")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, number % {width})")).alias("mask"))
    low, high = F.col("gram").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("gram", 32).bitwiseOR(1)
    slots = F.array(*[(low + k * high).bitwiseAND((1 << bits) - 1) for k in range(HASHES)])
    filled = masks.select("part", "mask", F.explode(slots).alias("slot")).groupBy("part", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    table_ = np.zeros((-(-len(languages) // width), 1 << bits), dtype=f"<u{width // 8}")
    part, slot, mask = (filled.column(c).to_numpy() for c in ("part", "slot", "mask"))
    table_[part, slot] = mask.astype(np.int64).view(np.uint64).astype(table_.dtype)
    passing = np.array([((table_[i // width] >> table_.dtype.type(i % width)) & 1).mean() ** HASHES for i in range(len(languages))])
    default = max(documents, key=lambda r: r.documents).lang if documents else None
    return Filters(languages, default, table_, passing)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text", lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    ``lang_pred`` is the language with the largest corrected count (ties: the first by name); without any hit the language with most training
    documents, with score 0. Null texts, texts without a letter, and all texts if nothing was learned: ``und`` with score 0. The score is the
    best language's part of the counts of the best two. Repeated rows and null ids are kept (a null id counts as held out), an empty
    table gives no rows, other columns are ignored whatever their names.
    """
    bounded_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(filters)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, "text", PIECE_BYTES):
                names, scores = known.value.predict(piece.column("text").to_pylist(), lengths)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(predict, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs.where(~held_out(F.col("doc_id"))).select("lang", "text")))
