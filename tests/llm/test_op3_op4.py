import math

import pytest
import xxhash
from pyspark.sql import functions as F

from retentia.llm import op3_sharding as S
from retentia.llm import op4_url_filters as U
from tests.llm.helpers import CLASHES, documents, oracle, rows_of, write

TEXTS = [(1, "ab"), (1, "ab"), (2, None), (3, ""), (None, "é"), (4, "x" * 200_000), (None, None)]


def draw(key, node):
    h = xxhash.xxh64_intdigest(node.name.encode(), xxhash.xxh64_intdigest(key.encode(), 42))
    return -math.log(((h >> 11) + 0.5) * 2.0 ** -53) / node.weight


def descend(key, node):
    while node.children:
        node = min((c for c in node.children if c.weight > 0), key=lambda c: draw(key, c))
    return node.shard


def placed(spark, tree, n=4000):
    df = spark.range(n).withColumn("s", S.place(F.col("id"), tree))
    return {r.id: r.s for r in df.collect()}


def test_placement_matches_a_plain_descent(spark):
    tree = S.topology([[[1, 2], [0, 1]], [[3]], [[1, 1, 1]]])
    got = placed(spark, tree, 500)
    assert got == {i: descend(str(i), tree) for i in range(500)}
    assert 2 not in got.values()  # no weight


def test_an_extra_shard_takes_rows_only_into_itself(spark):
    old, new = placed(spark, S.PRODUCTION_TREE), placed(spark, S.with_extra_shard(S.PRODUCTION_TREE))
    assert {new[i] for i in old if old[i] != new[i]} == {8}
    shares = [list(new.values()).count(s) / len(new) for s in range(9)]
    assert all(abs(x - 1 / 9) < 0.03 for x in shares)


def test_weight_changes_move_rows_only_into_the_changed_subtree(spark):
    a = placed(spark, S.topology([[[1, 1], [1, 1]], [[1, 1], [1, 1]]]))
    b = placed(spark, S.topology([[[1, 1], [1, 1]], [[1, 1], [1, 4]]]))
    moved = {(a[i], b[i]) for i in a if a[i] != b[i]}
    region = lambda s: s // 4
    rack = lambda s: s // 2
    assert all(region(y) == 1 for _, y in moved)
    assert all(rack(y) == 3 for x, y in moved if region(x) == 1)
    assert all(y == 7 for x, y in moved if rack(x) == 3)


def test_documents_edge_cases(spark):
    docs = documents(spark, TEXTS, CLASHES)
    rows = S.shard_documents(docs, S.PRODUCTION_TREE).collect()
    assert len(rows) == len(TEXTS)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    by = {(r.doc_id, r["size"]): r for r in rows}
    assert {(1, 3), (2, 1), (3, 1), (None, 3), (4, 200_001), (None, 1)} == set(by)
    assert by[2, 1].text_crc32 == 0
    assert all(r.shard == descend("" if r.doc_id is None else str(r.doc_id), S.PRODUCTION_TREE) for r in rows)
    assert S.shard_documents(docs.limit(0), S.PRODUCTION_TREE).count() == 0
    with pytest.raises(ValueError):
        S.topology([[[0]]])


PAGES = [(1, "http://A.example.COM/en/x?y"), (2, "http://www.example.com/en/"), (3, "https://x.www.example.com/en/a#/b"),
         (4, "http://example.com"), (5, "http://a.net/es/1"), (6, "http://net/fr/"), (7, "http://anet/fr/"), (8, None), (9, ""),
         (10, "no scheme/en/"), (11, "http://examplexcom/en/"), (12, "http://xexample.com/en/"), (13, "a://b://example.com/en/"), (13, "a://b://example.com/en/"),
         (None, "http://x.com/?q=://net/es/"), (14, "http://É.com/\n/en/"), (15, "http://" + "a." * 20_000 + "example.com/en/" + "z" * 50_000), (16, "://com/"),
         (17, "http://.com/"), (18, "http://user@www.example.com:80/en/")]


def test_urls_match_the_oracle(spark, tmp_path):
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in PAGES], "page_id long, url string, html string, keys string")
    sf = write(tmp_path, pages=pages)
    got = rows_of(U.query(spark, sf))
    want = U.ORACLE_SQL.replace("max_by(r.host || r.path", "max_by(r.host || r.path")
    ids = [i for i, _ in PAGES]
    unique = [r for r in oracle(want, sf) if ids.count(r[1]) == 1 and r[1] is not None]  # the oracle joins on page_id
    assert [r for r in got if ids.count(r[1]) == 1 and r[1] is not None] == unique
    assert len(got) == len(PAGES)
    empty = write(tmp_path / "empty", pages=pages.limit(0))
    assert rows_of(U.query(spark, empty)) == []


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("pmod(xxhash64(key), 50) = 0")
    cascade = U.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    wrong = universe.withColumn("in", F.expr("pmod(xxhash64(key), 50) = 0")).where(cascade.contains(F.col("key")) != F.col("in"))
    assert wrong.count() == 0
    assert universe.where(U.build_cascade(listed.limit(0), universe).contains(F.col("key"))).count() == 0
    with pytest.raises(ValueError, match="max_bits"):
        U.build_cascade(listed, universe, max_bits=64)
