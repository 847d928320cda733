"""Operator 4, URL filters: Bloom filter cascade (DataFrame functions only).

Rules are (host, path prefix) keys. All keys that a url could match form the corpus's key universe: for every shape
(host length, path length) that occurs in the list, the host suffix and the path prefix of that shape, if the suffix
starts at a label. A cascade answers exactly, over this universe, whether a key is listed: level 1 encodes the listed
keys, level 2 those keys of the universe that wrongly pass level 1, level 3 the listed keys that pass level 2, and so on
until nothing passes wrongly. Urls are then judged by expressions over literals alone: no join, no Python. Building
takes one pass over the urls for the universe, and each later level works on the few keys that are left.

A filter is bounded by ``max_bits`` (its size follows the list, not the corpus: level 1's error rate is chosen from the
sizes of list and universe, as is usual for such cascades); a larger list is refused with an error, and can be given in
several parts, each judged by cascades of its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import ascii_lower, store, table

MAX_BITS = 1 << 26

#: (host, path prefix, verdict) of the production query, fixed by its contract.
PRODUCTION_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]
    seed: int

    def positions(self, key: Column) -> Column:
        return F.array(*_positions(key, self.bits, self.hashes, self.seed))

    def passes(self, key: Column) -> Column:
        # a constant array: folded once per plan
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        hit = F.lit(True)
        for p in _positions(key, self.bits, self.hashes, self.seed):
            hit = hit & (F.getbit(F.get(words, (p / 64).cast("int")), (p % 64).cast("int")) == 1)
        return hit


def _positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    h = F.xxhash64(key, F.lit(seed))
    low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(low + high * i) % bits for i in range(hashes)]


@dataclass(frozen=True)
class Cascade:
    """Levels 1, 3, 5, ... encode listed keys, levels 2, 4, ... unlisted keys of the universe."""
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe that the cascade was built over."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            # failing level i+1 means "not listed" on odd levels and "listed" on even ones
            answer = F.when(self.levels[i].passes(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def _build_level(keys: DataFrame, n: int, rate: float, seed: int, max_bits: int) -> Level:
    bits = max(64, 64 * math.ceil(n * math.log(1 / rate) / math.log(2) ** 2 / 64))
    if bits > max_bits:
        raise ValueError(f"a level of {n} keys needs {bits} bits, more than max_bits={max_bits}; give the list in parts")
    empty = Level(bits, max(1, round(math.log2(1 / rate))), (0,) * (bits // 64), seed)
    at = keys.select(F.explode(empty.positions(F.col("key"))).alias("p"))
    words = (at.groupBy((F.col("p") / 64).cast("int").alias("i"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("w")).collect())  # at most bits / 64 rows
    filled = [0] * (bits // 64)
    for r in words:
        filled[r.i] = r.w
    return Level(bits, empty.hashes, tuple(filled), seed)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS, later_rate: float = 0.25) -> Cascade:
    """Cascade for ``listed`` (key) over ``universe`` (distinct keys, stored). An empty list needs no level."""
    listed = store(listed.where(F.col("key").isNotNull()).select("key").distinct(), "cascade-listed")
    n, total = listed.count(), universe.count()
    if not n:
        return Cascade(())
    levels: list[Level] = []
    # about as many wrong keys as listed ones are left after level 1
    first = min(0.5, max(2.0 ** -30, n / max(total, 1)))
    levels.append(_build_level(listed, n, first, 1, max_bits))
    wrong = store(universe.where(levels[0].passes(F.col("key"))).join(listed, "key", "left_anti"), "cascade-wrong")
    sides = [listed, wrong]  # the listed and the unlisted keys that pass every level so far
    while n := wrong.count():
        levels.append(_build_level(wrong, n, later_rate, len(levels) + 1, max_bits))
        side = len(levels) % 2
        sides[side] = wrong = store(sides[side].where(levels[-1].passes(F.col("key"))), "cascade-wrong")
    return Cascade(tuple(levels))


def shapes_of(rules: Sequence[tuple[str, str, str]]) -> list[tuple[int, int]]:
    """(host length, path length) pairs, longest key first; of equal keys' lengths the longer host first."""
    return sorted({(len(h), len(p)) for h, p, _ in rules}, key=lambda s: (-(s[0] + s[1]), -s[0]))


def candidate_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """Array of the keys that a url could match, one place per shape (null where the url has none), longest first."""
    keys = []
    for h, p in shapes:
        at_label = (F.char_length(host) == h) | (F.substring(host, -(h + 1), 1) == ".")
        fits = (F.char_length(host) >= h) & at_label & (F.char_length(path) >= p)
        suffix = F.substring(host, -h, h) if h else F.lit("")
        keys.append(F.when(fits, F.concat(suffix, F.substring(path, 1, p) if p else F.lit(""))))
    return F.array(*keys)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
               unlisted: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (host + path prefix, null if none fits) and verdict.

    The longest fitting rule wins (of two of one length the one with the longer host); a url that no rule fits is not
    listed and gets ``unlisted``. A null url or one without ``://`` has an empty host and path and fits no rule.
    Repeated rows are judged alike; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    shapes = shapes_of(rules)
    if not shapes:
        raise ValueError("no rules")
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    keys = candidate_keys(F.col("host"), F.col("path"), shapes)
    universe = store(rows.select(F.explode(keys).alias("key")).where(F.col("key").isNotNull()).distinct(), "universe")
    cascades = {verdict: build_cascade(spark.createDataFrame([(h + p,) for h, p, v in rules if v == verdict], "key string"), universe)
                for verdict in sorted({v for _, _, v in rules})}
    rows = rows.withColumn("keys", keys)
    rule, verdict = F.lit(None).cast("string"), F.lit(unlisted)
    for i in reversed(range(len(shapes))):
        key = F.get(F.col("keys"), F.lit(i))
        for name, cascade in cascades.items():
            hit = key.isNotNull() & cascade.contains(key)
            rule, verdict = F.when(hit, key).otherwise(rule), F.when(hit, F.lit(name)).otherwise(verdict)
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), PRODUCTION_RULES)


ORACLE_SQL = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
        ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
split AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM cut),
urls AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM split),
fits AS (SELECT u.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
                max_by(r.verdict, length(r.host || r.path)) AS verdict
         FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
         GROUP BY u.page_id)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fits f USING (page_id)
"""
