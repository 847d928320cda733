import gzip
import hashlib

import pytest

from retentia.llm import op8_warc as W
from tests.llm.helpers import oracle, rows_of, write

BIG = "ä<p>" * 400
PAGES = [(1, "http://a/", BIG), (2, "http://b/", BIG), (9, "http://c/\r\nX: y", BIG), (3, None, None), (4, "", ""), (5, "http://d/", "short"), (6, "e", "short"),
         (None, "n", BIG + "x"), (None, "n", "only" * 300), (None, "n2", "only" * 300), (7, "f", BIG + "x"), (8, "g", "\r\n\r\nWARC/1.1\r\n" * 100), (10, "h", "z" * 3_000_000),
         (11, "i", "tie" * 500), (11, "i", "tie" * 500)]


def pages(spark, rows):
    return spark.createDataFrame([r + ("x",) for r in rows], "page_id long, url string, html string, payload string")


def expected(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = len(data) >= 1000 and len([1 for r in rows if r[2] == html]) > 1 and same and i != max(same)
        out.append((i, hashlib.sha1(data).hexdigest(), len(data), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.page_id, r.payload_digest, r.payload_bytes, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_round_trip(spark, tmp_path):
    assert got(W.archive_pages(pages(spark, PAGES).repartition(3), f"{tmp_path}/a")) == expected(PAGES)
    assert got(W.archive_pages(pages(spark, []), f"{tmp_path}/b")) == []
    back = W.read_warc(spark, f"{tmp_path}/a").where("record_id = 'urn:page:9'").collect()
    assert [bytes(r.payload).decode() for r in back] == [BIG] and back[0].target_uri == "http://c/%0D%0AX: y"


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    assert rows_of(W.query(spark, sf)) == oracle(W.ORACLE_SQL, sf)


def test_files_are_gzip_and_chunks_split(spark, tmp_path):
    path = f"{tmp_path}/c"
    W.register(spark)
    W.page_records(pages(spark, PAGES[:9])).coalesce(1).write.format("warc").option("chunkbytes", 500).mode("append").save(path)
    reader = W.WarcReader({"path": path}, None)
    chunks = reader.partitions()
    assert len(chunks) > 3
    plain = gzip.open(chunks[0].file).read()
    assert plain.count(b"WARC/1.1\r\n") == 9
    # files of other writers: gzip members without lengths, and plain ones, without a manifest
    other = tmp_path / "other"
    other.mkdir()
    cuts = [plain[a:b] for a, b in zip(*(lambda at: (at, at[1:] + [len(plain)]))([i for i in range(len(plain)) if plain.startswith(b"WARC/1.1\r\n", i)]))]
    (other / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in cuts))
    (other / "b.warc").write_bytes(plain)
    want = sorted(map(repr, W.read_warc(spark, path).collect()))
    assert sorted(map(repr, W.read_warc(spark, str(other)).collect())) == sorted(want * 2)


def test_predicates_are_pushed_down_and_payloads_skipped(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/d"
    W.write_warc(W.page_records(pages(spark, PAGES)).coalesce(1), path)
    df = W.read_warc(spark, path, "record_id string, record_type string").where("record_type = 'revisit' AND record_id LIKE 'urn:page:%'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "").replace("pushedFilters", "") or "record_type" not in plan.split("Filter")[-1]
    assert {r.record_id for r in df.collect()} == {"urn:page:1", "urn:page:2", "urn:page:null"}
    reader = W.WarcReader({"path": path}, W.StructType().add("record_id", "string"))
    monkeypatch.setattr(W, "_block", lambda *a: pytest.fail("a block was decoded"))
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == len(PAGES)


def test_write_needs_a_shared_schema(spark, tmp_path):
    with pytest.raises(Exception, match="no columns"):
        W.read_warc(spark, str(tmp_path), "colour string").collect()


def test_oracle_with_repeats(spark, tmp_path):
    rows = [r for r in PAGES if r[0] is not None and r[0] != 11]
    sf = write(tmp_path, pages=pages(spark, rows))
    assert rows_of(W.query(spark, sf)) == oracle(W.ORACLE_SQL, sf)


def test_append_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "w")
    page = lambda *ids: W.page_records(spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i}</p>") for i in ids], "page_id long, url string, html string"))
    W.write_warc(page(1, 2, 3), path)
    W.write_warc(page(4, 5), path)
    W.write_warc(page(), path)
    got = W.read_warc(spark, path, "record_id string, payload binary").collect()
    assert sorted((r.record_id, bytes(r.payload)) for r in got) == [(f"urn:page:{i}", f"<p>{i}</p>".encode()) for i in range(1, 6)]


def test_ids_of_other_types(spark, tmp_path):
    same = "z" * 1200
    rows = [("a b/ü%", same), ("null", same), (None, same), ("", "x"), ("line\nbreak", "y")]
    got = W.archive_pages(spark.createDataFrame([(i, "http://u", h) for i, h in rows], "page_id string, url string, html string"), str(tmp_path / "s"))
    assert sorted(((r.page_id, r.record_type, r.refers_to) for r in got.collect()), key=str) == sorted(
        [("a b/ü%", "revisit", "null"), ("null", "response", None), (None, "revisit", "null"), ("", "response", None), ("line\nbreak", "response", None)], key=str)


def test_paths_get_the_default_file_system(spark, tmp_path):
    assert W.qualified(spark, str(tmp_path)).startswith("file:/") and W.qualified(spark, f"file://{tmp_path}/x").endswith("/x")
