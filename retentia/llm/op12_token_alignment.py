"""Operator 12, cross-tokenizer alignment: diagonal run skipping.

A text's tokens under two tokenizers A and B cover the same bytes. Places where tokens of both end cut the tokens into
groups. The two arrays of ends are walked along a diagonal, that is, with a fixed shift between the indices:

1. at the current shift, blocks of 1, 2, 4, ... ends are compared as long as they are equal; the block that differs is
   halved down to the first difference. All that was passed is groups of one token each;
2. the irregular group that comes next is resolved by itself: the side that ends first moves on until both end together.
   Its sizes change the shift, and probing begins anew.

Texts are encoded and aligned once, where they are; the alignment is stored. Links (the two tokens that end a group together) are counted over
the corpus, pre-aggregated per batch. Of these counts the most frequent pairs, ``FREQUENT`` at most, are broadcast; links of the others
are joined with the rest of the counts and summed by document, so no pair is left out however many there are.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, frequent_from, per_worker, store, table, text_pieces

#: Pairs of ids whose counts are broadcast, at 20 bytes each.
FREQUENT = 1 << 20
WORD_START = "▁"
ARRAYS = ["a_ids", "b_ids", "ones", "a_sizes", "b_sizes"]
#: Bytes of text that are aligned at a time (or one text), words encoded at a time, and tokens of known words that a worker keeps.
PIECE_BYTES, CHUNK_WORDS, MAX_KEPT = 1 << 18, 2048, 600_000


class Aligner:
    """Both tokenizers, with the tokens of the words met so far.

    Neither tokenizer has tokens that reach over the border before a single blank or line break between printing characters (checked for the
    vocabulary of B when it is read), so words are encoded once, many in one call, and texts are put together from them. A text with
    other white space in it is encoded as a whole.
    """

    def __init__(self, ranks_path: str | None = None, pieces_path: str | None = None):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.encode_a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        model = sentencepiece.SentencePieceProcessor(model_file=pieces_path or public_tokenizers.path("piece_bpe_32k.model"))
        self.encode_b = model.encode
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.by_word = not any("\n" in p or WORD_START in p.lstrip(WORD_START) for p in names)
        entries = {r: t for t, r in ranks.items()}
        self.bytes = ([entries.get(i, b"") for i in range(max(entries) + 1)],
                      [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(WORD_START, " ").encode() for i, p in enumerate(names)])
        self.length = tuple(np.array(list(map(len, x)), dtype=np.int64) for x in self.bytes)
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.ids = [np.zeros(0, dtype=np.int32)] * 2
        self.first = [np.zeros(1, dtype=np.int64)] * 2
        self.whole = np.zeros(0, dtype=bool)

    def keys(self, text: str | None) -> list[str]:
        """The words of a text, with their line break if there is one before them; or a blank and the whole text."""
        if not text:
            return []
        words = text.split()
        borders = text.count(" ") + text.count("\n")
        if not self.by_word or len(words) != borders + 1 or sum(map(len, words)) != len(text) - borders or WORD_START in text:
            return [" " + text]
        return text.replace("\n", " \n").split(" ")

    def encoded(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, tokens of each part) of A and of B, and whether they give back its bytes, for parts that begin with a blank or line break."""
        alone = len(parts) == 1
        text = parts[0] if alone and parts[0][0] == " " else " x" + "".join(parts)  # B puts a blank in front
        data = text.encode()
        lead = len(text) - sum(map(len, parts))
        ends = np.cumsum([lead, *(len(p.encode()) for p in parts)])
        out = []
        for ids, known, length in zip((self.encode_a(text), self.encode_b(text[1:])), self.bytes, self.length):
            ids = np.array(ids, dtype=np.int32)
            if b"".join(map(known.__getitem__, ids.tolist())) != data:
                break
            at = np.concatenate([[0], np.cumsum(length[ids])])
            cut = np.searchsorted(at, ends)
            if (at[cut] != ends).any():
                break
            out += [ids[cut[0]:], np.diff(cut)]
        else:
            return [(*out, np.ones(len(parts), dtype=bool))]
        if alone:
            none = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
            return [(*none, *none, np.zeros(1, dtype=bool))]
        half = len(parts) // 2  # find the part that is not given back
        return self.encoded(parts[:half]) + self.encoded(parts[half:])

    def learn(self, keys: list[str]) -> None:
        words = [k for k in keys if k[0] != " "]
        chunks = [[k] for k in keys if k[0] == " "] + [words[i:i + CHUNK_WORDS] for i in range(0, len(words), CHUNK_WORDS)]
        found = [f for chunk in chunks for f in self.encoded([k if k[0] in " \n" else " " + k for k in chunk])]
        n = len(self.row)
        self.row.update((k, n + i) for i, k in enumerate(k for chunk in chunks for k in chunk))
        for side in (0, 1):
            self.ids[side] = np.concatenate([self.ids[side], *[f[2 * side] for f in found]])
            counts = np.concatenate([f[2 * side + 1] for f in found])
            self.first[side] = np.concatenate([self.first[side], self.first[side][-1] + np.cumsum(counts)])
        self.whole = np.concatenate([self.whole, *[f[4] for f in found]])

    def align(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], list[tuple[list[int], list[int], list[int]]]]:
        """Ids of A and B of all texts, their numbers per text, and the runs of each text (see ``diagonal_runs``)."""
        if sum(map(len, self.ids)) > MAX_KEPT:
            self.clear()
        by_text = list(map(self.keys, texts))
        flat = [k for keys in by_text for k in keys]
        new = [k for k in dict.fromkeys(flat) if k not in self.row]
        if new:
            self.learn(new)
        n_rows = np.array(list(map(len, by_text)), dtype=np.int64)
        rows = np.fromiter(map(self.row.__getitem__, flat), np.int64, len(flat))
        # texts with a word that is not given back have no tokens
        wrong = np.concatenate([[0], np.cumsum(~self.whole[rows])])
        stop = np.cumsum(n_rows)
        right = wrong[stop] == wrong[stop - n_rows]
        rows = rows[np.repeat(right, n_rows)]
        stop = np.cumsum(np.where(right, n_rows, 0))
        ids, counts, ends = [], [], []
        for side in (0, 1):
            lo, n = self.first[side][rows], np.diff(self.first[side])[rows]
            upto = np.concatenate([[0], np.cumsum(n)])
            ids.append(self.ids[side][np.repeat(lo - upto[:-1], n) + np.arange(upto[-1])])
            counts.append(np.diff(upto[stop], prepend=0))
            ends.append(np.cumsum(self.length[side][ids[side]]).tolist())
        a, b = (np.cumsum(c).tolist() for c in counts)
        runs = [diagonal_runs(ends[0][i:p], ends[1][j:q]) for i, p, j, q in zip([0, *a], a, [0, *b], b)]
        return ids, counts, runs


def diagonal_runs(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The groups that the ascending ends of A's and of B's tokens share, as stretches and irregular groups in turn.

    Three lists: groups of one token each in a stretch, then A's and B's tokens in the irregular group after it (0 and 0 at the end, if
    the text ends with the stretch). Both arrays have the same last end.
    """
    i, j, n = 0, 0, len(a)
    ones: list[int] = []
    in_a: list[int] = []
    in_b: list[int] = []
    while i < n:
        # blocks of doubling size along the diagonal j - i
        start, step = i, 1
        while i < n and a[i:i + step] == b[j:j + step]:
            i += step
            j += step
            step += step
        if i >= n:
            ones.append(n - start)
            in_a.append(0)
            in_b.append(0)
            break
        step >>= 1
        while step:  # the last block differs: halve it
            if a[i:i + step] == b[j:j + step]:
                i += step
                j += step
            step >>= 1
        ones.append(i - start)
        # one side's tokens end first until both end together
        p, q, x, y = i, j, a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
        in_a.append(i - p)
        in_b.append(j - q)
    return ones, in_a, in_b


def group_sizes(ones: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Tokens of one side in every group, from the runs of one or more texts in turn."""
    last = sizes > 0
    out = np.ones(int(ones.sum() + last.sum()), dtype=np.int64)
    at = np.cumsum(ones + last) - 1
    out[at[last]] = sizes[last]
    return out


def _lists(counts: np.ndarray, flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat, pa.int32()))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
                    pieces_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, a_ids, b_ids, ones, a_sizes, b_sizes.

    ``a_ids`` are the ids of a blank and the text by a byte-level vocabulary (given as merge ranks), ``b_ids`` those of the text by a sentencepiece
    model that puts a blank in front. The groups in turn: ``ones[r]`` groups of one token of each, then one of ``a_sizes[r]`` tokens of A and
    ``b_sizes[r]`` of B (0 and 0: none, the text ends). Special tokens are neither added nor read from a text. Null and empty texts, and
    texts whose bytes one of the tokenizers doesn't give back, have five empty arrays. Repeated rows and null ids are kept, an
    empty table gives no rows, other columns are ignored whatever their names.
    """
    bounded_batches(docs.sparkSession)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = per_worker(("aligner", ranks_path, pieces_path), lambda: Aligner(ranks_path, pieces_path))
        for batch in batches:
            for piece in text_pieces(batch, "text", PIECE_BYTES):  # what a piece gives leaves the worker at once
                ids, counts, runs = both.align(piece.column("text").to_pylist())
                n = np.array([len(r[0]) for r in runs], dtype=np.int64)
                columns = [_lists(c, i) for c, i in zip(counts, ids)]
                columns += [_lists(n, np.array([x for r in runs for x in r[k]], dtype=np.int32)) for k in range(3)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], names=["doc_id", *ARRAYS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(aligned, f"doc_id {kind}, " + ", ".join(f"{c} array<int>" for c in ARRAYS))


#: Rows of an alignment table that are expanded at a time.
SLICE_ROWS = 100


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


class _Batch:
    """Flat arrays of alignments: ids, group sizes, ends of groups and of documents, and the links."""

    def __init__(self, batch: pa.RecordBatch):
        self.a, self.b, ones, sizes_a, sizes_b = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ARRAYS)
        self.n_a, self.n_b, n_runs = (np.diff(batch.column(c).offsets.to_numpy()).astype(np.int64) for c in ("a_ids", "b_ids", "ones"))
        self.in_a, self.in_b = group_sizes(ones, sizes_a), group_sizes(ones, sizes_b)
        upto, stop = np.concatenate([[0], np.cumsum(ones + (sizes_a > 0))]), np.cumsum(n_runs)
        self.n_groups = upto[stop] - upto[stop - n_runs]
        self.end_a, self.end_b = np.cumsum(self.in_a), np.cumsum(self.in_b)
        self.links = (self.a[self.end_a - 1] << 32) + self.b[self.end_b - 1]

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of each link by document."""
        sums = np.concatenate([[0], np.cumsum(values)])
        ends = np.cumsum(self.n_groups)
        return sums[ends] - sums[ends - self.n_groups]

    def group_digests(self, a_names: list[bytes], b_names: list[bytes]) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; the names end in a comma, or the sign after a group's last token."""
        last_a, last_b = np.zeros(len(self.a), dtype=np.int64), np.zeros(len(self.b), dtype=np.int64)
        last_a[self.end_a - 1], last_b[self.end_b - 1] = 1, 1
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        order[np.arange(len(self.a)) + np.repeat(self.end_b - self.in_b, self.in_a)] = 2 * self.a + last_a
        order[np.arange(len(self.b)) + np.repeat(self.end_a, self.in_b)] = len(a_names) + 2 * self.b + last_b
        names, ends = a_names + b_names, np.cumsum(self.n_a + self.n_b)
        out = []
        for end, n in zip(ends.tolist(), (self.n_a + self.n_b).tolist()):
            joined = b"".join(map(names.__getitem__, order[end - n:end].tolist()))
            out.append(hashlib.sha256(joined[:-1]).hexdigest() if n else "")
        return out


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, n, best) of every linked pair of ids; ``best``: no other id of A has more links with b. ``aligned`` must be stored."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, n = np.unique(np.concatenate([_Batch(piece).links for piece in _slices([batch])]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    rows = aligned.select(*ARRAYS).mapInArrow(count, "pair long, n long")
    pairs = store(rows.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.expr("int(pair & 4294967295)")), "alignment-pairs")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))  # at most as many rows as B has ids
    return pairs.join(F.broadcast(most), "b").select("pair", F.expr("int(shiftright(pair, 32))").alias("a"), "b", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_digests(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Counts and digest of each alignment: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``count_sum`` sums the corpus counts of a document's links, ``n_best`` counts the links whose pair is the most frequent of its id of B (ties
    included). Documents without tokens have zeros and an empty digest. ``frequent``: pairs whose counts are broadcast.
    """
    spark = aligned.sparkSession
    aligned = store(aligned.withColumn("key", F.monotonically_increasing_id()), "alignment")
    pairs = store(pair_counts(aligned), "alignment-counts")
    least = frequent_from(pairs, frequent)
    held = pairs.where(F.col("n") >= least).select("pair", "n", "best").toPandas().sort_values("pair")  # ``frequent`` rows at most
    known = spark.sparkContext.broadcast([held[c].to_numpy() for c in ("pair", "n", "best")])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, bests = known.value
        a_names, b_names = [], []
        for batch in _slices(batches):
            x = _Batch(batch)
            for names, ids, sign in ((a_names, x.a, "|"), (b_names, x.b, ";")):
                for i in range(len(names) // 2, int(ids.max()) + 1 if len(ids) else 0):
                    names += [f"{i},".encode(), f"{i}{sign}".encode()]
            at = np.minimum(np.searchsorted(keys, x.links), max(len(keys) - 1, 0))
            found = keys[at] == x.links if len(keys) else np.zeros(len(x.links), dtype=bool)
            n = np.where(found, counts[at], 0) if len(keys) else np.zeros(len(x.links), dtype=np.int64)
            best = found & bests[at] if len(keys) else found
            rest = x.per_document(~found)
            columns = [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in (x.n_a, x.n_b, x.n_groups, x.n_groups, x.per_document(best), x.per_document(n))],
                       pa.array(x.group_digests(a_names, b_names)), batch.column("key"),
                       pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rest)]), pa.int32()), pa.array(x.links[~found], pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names_out)

    names_out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "key", "rest"]
    kind = aligned.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names_out[1:7]) + ", groups_sha256 string, key long, rest array<long>"
    rows = aligned.mapInArrow(digest, schema)
    if least > 1:  # links of the other pairs meet their counts in a join
        rows = store(rows, "alignment-digests")
        links = rows.select("key", F.explode("rest").alias("pair")).groupBy("key", "pair").agg(F.count(F.lit(1)).alias("times"))
        sums = links.join(pairs.where(F.col("n") < least), "pair").groupBy("key").agg(
            F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
        rows = rows.join(sums, "key", "left")
        for c, more in (("n_best", "more_best"), ("count_sum", "more")):
            rows = rows.withColumn(c, F.col(c) + F.coalesce(more, F.lit(0)))
    return rows.select(*names_out[:8])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digests(align_documents(table(spark, sf_dir, "documents")))
