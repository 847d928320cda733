"""Operator 7, SimHash near-duplicates: bit-sliced comparison.

Fingerprints are computed where the texts are. Copies collapse to one row per distinct fingerprint. Two fingerprints
within ``radius`` bits agree on at least (4 - radius) of four 16-bit parts, so they share one of the keys made of that
many parts (radius 2: six 32-bit keys, radius 1: four of three parts, radius 3: four of one part); fingerprints that
share a key form a group and are compared there:

* the group's fingerprints are transposed into 64 bit planes (one bit per fingerprint, packed into 64-bit words);
* a fingerprint's distances to all others are counted at once: each plane, flipped where the fingerprint has a 1, is
  added to a vertical counter with carry-save logic (ones, twos, ..., and one "over" plane that saturates);
* a block of planes' words is abandoned as soon as every distance in it exceeds the radius.

Groups stay small on any data: a group of more than ``max_group`` distinct fingerprints is dealt again by further bits.
Two fingerprints that share the parts of a key and differ in at most ``radius`` of the remaining bits agree on one of
radius + 1 slices of those bits, so each slice gives a finer key; no pair is lost. The bits that are left shrink with
every round, and with them the largest possible group. A group gives a spanning forest of its links, not all pairs,
and the links' components are found by ``connected_components``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import ASCII_LOWER, bounded_batches, connected_components, store, table

SHINGLE = 3
RADIUS = 2
MAX_GROUP = 4096
#: Words of 64 fingerprints that are compared before the next test for abandoning.
BLOCK_WORDS = 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64 values (seed 42). No words: 0."""
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    parts = zip(*[words[i:] for i in range(shingle)]) if len(words) >= shingle else [words]
    h = np.array([xxhash.xxh64_intdigest(s, 42) for s in map(b" ".join, parts)], dtype="<u8")
    bits = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        bits += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))

    return run(text.cast("string"))


def links_within(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning links (i, j) of the graph of fingerprints (uint64) at most ``radius`` bits apart, bit-sliced."""
    n = len(fps)
    words = -(-n // 64)
    words += -words % BLOCK_WORDS if words > BLOCK_WORDS else 0
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = np.zeros((64, words), dtype=np.uint64)
    packed = np.packbits(bits, axis=0, bitorder="little").T.copy()  # 64 x ceil(n / 8) bytes
    planes.view(np.uint8)[:, :packed.shape[1]] = packed
    valid = np.zeros(words, dtype=np.uint64)
    valid.view(np.uint8)[:-(-n // 8)] = np.packbits(np.ones(n, dtype=np.uint8), bitorder="little")
    # planes that tell the fingerprints apart come first, so that blocks are abandoned early
    share = bits.mean(axis=0)
    order = np.argsort(np.abs(share - 0.5), kind="stable")
    order = order[(share[order] > 0) & (share[order] < 1)]
    counters = max(1, radius.bit_length())
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    step = words if words <= BLOCK_WORDS else BLOCK_WORDS
    for i in range(n):
        flips = np.where(bits[i, order], np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        for lo in range(i // 64 // step * step, words, step):
            sums = [np.zeros(step, dtype=np.uint64) for _ in range(counters)]
            over = ~valid[lo:lo + step]
            for at, plane in enumerate(order):
                carry = planes[plane, lo:lo + step] ^ flips[at]
                for c in range(counters):  # carry-save addition of one bit to every counter
                    sums[c], carry = sums[c] ^ carry, sums[c] & carry
                over = over | carry
                if at % 4 == 3:
                    over = over | _exceeds(sums, radius)
                    if not np.any(~over):
                        break
            near = ~(over | _exceeds(sums, radius))
            if not near.any():
                continue
            for j in np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")) + 64 * lo:
                if j > i and (a := find(i)) != (b := find(int(j))):
                    parent[max(a, b)] = min(a, b)
                    found.append((i, int(j)))
    return found


def _exceeds(sums: list[np.ndarray], radius: int) -> np.ndarray:
    """Bit set where the vertical counter is greater than ``radius``."""
    greater, equal = np.zeros_like(sums[0]), ~np.zeros_like(sums[0])
    for c in reversed(range(len(sums))):
        if radius >> c & 1:
            equal = equal & sums[c]
        else:
            greater = greater | (equal & sums[c])
            equal = equal & ~sums[c]
    return greater


def _masks(bits: list[int], parts: int, chosen: int) -> list[int]:
    """Masks of ``chosen`` out of ``parts`` slices of the given bits."""
    slices = [bits[len(bits) * i // parts:len(bits) * (i + 1) // parts] for i in range(parts)]
    return [sum(1 << b for s in pick for b in s) for pick in itertools.combinations(slices, chosen)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, key, fp): one row per fingerprint and mask."""
    pairs = F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in masks])
    return fps.select("fp", F.explode(pairs).alias("k")).select("k.mask", "k.key", "fp")


def _refine(hot: DataFrame, used: list[int], radius: int) -> DataFrame:
    """Hot groups dealt again: every mask widened by each of radius + 1 slices of its remaining bits."""
    finer = {m: [_signed(m | s) for s in _masks([b for b in range(64) if not m >> b & 1], radius + 1, 1)] for m in used}
    wide = F.create_map(*[x for m, f in finer.items() for x in (F.lit(_signed(m)), F.array(*map(F.lit, f)))])
    return (hot.select("fp", F.explode(wide[F.col("mask")]).alias("mask"))
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp").distinct())


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, max_group: int = MAX_GROUP) -> DataFrame:
    """Links (a, b) that span the components of the distinct fingerprints ``fps`` (fp long)."""
    if not 1 <= radius <= 3:
        raise ValueError("radius must be 1, 2 or 3")
    masks = _masks(list(range(64)), 4, 4 - radius)
    keyed, parts = _keyed(fps, masks), []
    while True:
        sizes = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        groups = store(keyed.join(sizes, ["mask", "key"]), "simhash-groups")
        last = 64 - min(m.bit_count() for m in masks) <= 12
        small = groups if last else groups.where(F.col("n") <= max_group)
        parts.append(small)
        if last or not groups.where(F.col("n") > max_group).head(1):
            break
        keyed = _refine(groups.where(F.col("n") > max_group), masks, radius)
        masks = sorted({m | s for m in masks for s in _masks([b for b in range(64) if not m >> b & 1], radius + 1, 1)})
    groups = parts[0].select("mask", "key", "fp")
    for p in parts[1:]:
        groups = groups.union(p.select("mask", "key", "fp"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in itertools.chain(batches, [None]):
            if pdf is not None:
                pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
                if not len(pdf):
                    continue
                # the last group may go on in the next batch
                mask, key = pdf["mask"].to_numpy(), pdf["key"].to_numpy()
                cut = int(np.flatnonzero((mask != mask[-1]) | (key != key[-1])).max(initial=-1)) + 1
                pdf, rest = pdf.iloc[:cut], pdf.iloc[cut:]
            else:
                pdf = rest
            if pdf is None or not len(pdf):
                continue
            mask, key, fp = (pdf[c].to_numpy() for c in ("mask", "key", "fp"))
            edge = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            out_a, out_b = [], []
            for lo, hi in zip(np.r_[0, edge], np.r_[edge, len(fp)]):
                group = np.ascontiguousarray(fp[lo:hi]).view(np.uint64)
                if len(group) == 2:
                    pairs = [(0, 1)] if int(group[0] ^ group[1]).bit_count() <= radius else []
                else:
                    pairs = links_within(group, radius)
                out_a += [fp[lo + i] for i, _ in pairs]
                out_b += [fp[lo + j] for _, j in pairs]
            yield pd.DataFrame({"a": np.array(out_a, dtype=np.int64), "b": np.array(out_b, dtype=np.int64)})

    dealt = groups.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInPandas(compare, "a long, b long")


def near_duplicates(rows: DataFrame, id_col: str, fp_col: str, radius: int = RADIUS, max_group: int = MAX_GROUP) -> DataFrame:
    """``rows`` with component (the smallest fingerprint, as a signed number, that is reachable over links of at most
    ``radius`` bits) and component_id (the smallest id of the component's documents).

    ``rows`` must be stored, as it is read several times. Null ids are linked but never name a component, except one
    of null ids only (null). An empty table gives no rows.
    """
    fps = store(rows.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("low")), "simhash-distinct")
    nodes = connected_components(fingerprint_links(fps.select("fp"), radius, max_group))
    # fingerprints without links are components of their own
    known = fps.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lows = known.groupBy("component").agg(F.min("low").alias("component_id"))
    named = store(known.join(lows, "component").select(F.col("fp").alias("__fp"), "component", "component_id"), "simhash-components")
    return rows.join(named, F.col(fp_col) == F.col("__fp")).drop("__fp")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                      radius: int = RADIUS) -> DataFrame:
    """One row per input row: (row struct of all input columns, doc_id, fp long, component, component_id).

    Null and wordless texts have fingerprint 0 and are linked like any other; repeated rows share a component.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"),
                       fingerprint_column(F.col(text_col), shingle).alias("fp"))
    return near_duplicates(store(rows, "simhash-rows"), "doc_id", "fp", radius)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = store(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")), "simhash-rows")
    out = near_duplicates(rows, "doc_id", "fp")
    return out.select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def one_per_component(rows: DataFrame) -> DataFrame:
    """Of ``simhash_documents``' rows the one with the smallest id of each component.

    Components whose smallest id belongs to several rows (repeated rows, or null ids only) are rare; only their rows
    are shuffled, to keep one of them.
    """
    first = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("row", "component")
    several = first.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
    several = store(several, "simhash-several")
    alone = first.join(several, "component", "left_anti")
    tied = first.join(several, "component", "left_semi").dropDuplicates(["component"])
    return alone.select("row").union(tied.select("row"))
