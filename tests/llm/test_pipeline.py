import random
import re

import corpus_pipeline as C
from retentia.llm.common import store
from tests.llm import brute
from tests.llm.helpers import documents, write
from tests.llm.test_op2_packing import check_rows
from tests.llm.test_op7_op6 import plain_passages


def without(text, gone):
    """The text without the words numbered in ``gone`` and the white space after them; a line of which words stay in front ends."""
    parts = re.split(r"([^\x20\x09-\x0D]+)", text or "")  # white space at even places, words at odd ones
    out = parts[0]
    for i in range(1, len(parts), 2):
        if i // 2 in gone:
            ends = "\n" in parts[i + 1] and i // 2 + 1 not in gone
            out += "\n" if ends and out and out[-1] != "\n" else ""
        else:
            out += parts[i] + parts[i + 1]
    return out


def plain(rows, items):
    """rows: (doc_id, text, source); (doc_id, text) after each stage but the last."""
    out = []
    judged = brute.quality(rows)
    docs = [(d, judged[d][3]) for d, _, _ in rows if judged[d][2]]
    out.append(docs)
    fps = {d: brute.fingerprint(t) for d, t in docs}
    names = brute.components(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for d, _ in sorted(docs):
        first.setdefault(names[fps[d]], d)
    docs = [(d, t) for d, t in docs if d in first.values()]
    out.append(docs)
    removed = brute.substring_dedup(docs)
    cut = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in removed)) for d, t in docs]
    passages = plain_passages(cut)
    cut = [(d, without(t, passages[d, t]) if passages[d, t] else t) for d, t in cut]
    docs = [(d, t) for (d, t), (_, old) in zip(cut, docs) if t == old or brute.words(t)]
    out.append(docs)
    found = brute.contamination(docs, items)
    out.append([(d, t) for d, t in docs if not found[d][1]])
    return out


def test_pipeline_matches_the_plain_version(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in source.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    # one more document whose passage other documents have, one copy and one leak, so that every stage has work
    rng = random.Random(1)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    filler = lambda: " ".join(f"f{rng.randrange(10**6)}" for _ in range(40))
    more = [(10**6 + i, filler() + "\n" + passage, "src0") for i in range(3)] + [(2 * 10**6, rows[0][1], "src1"), (3 * 10**6, filler() + " " + items[0][1], "src2")]
    rows += more
    docs = source.unionByName(documents(spark, more))
    wants = plain(rows, items)
    for (name, stage), want in zip(C.STAGES, wants):
        docs = store(stage(spark, docs, sf), "test-stage")
        assert docs.columns == source.columns, name
        got = docs.collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted(want), name
        assert all(r.n_chars == len(r.text) for r in got if r.text is not None), name
    assert len({len(w) for w in wants}) > 2
    check_rows(C.STAGES[-1][1](spark, docs, sf).collect(), wants[-1], 2048)


def test_stages_on_edge_cases(spark, tmp_path):
    rows = [(1, None), (1, ""), (None, "a b c d e f g h i j k l"), (None, "a b c d e f g h i j k l"), (2, "m n o p q r s t u v w x"), (2, "m n o p q r s t u v w x"), (3, "x y " * 50_000)]
    bench = spark.createDataFrame([(1, "zz yy")], "item_id long, text string")
    extra = "row component removed clean_text state items doc"
    sf = write(tmp_path, documents=documents(spark, rows, extra), benchmark=bench)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        docs = store(stage(spark, docs, sf), "test-stage")
        assert docs.columns[-1] == "doc" and {r["row"] for r in docs.collect()} <= {"x"}
    assert sorted((str(r.doc_id), r.text) for r in docs.collect()) == [("2", rows[4][1]), ("None", rows[2][1])]
    assert C.STAGES[-1][1](spark, docs, sf).count() == 2
    empty = write(tmp_path / "e", documents=documents(spark, rows).limit(0), benchmark=bench)
    assert C.run(spark, empty).count() == 0
    # every stage alone takes nulls, empty texts and repeated rows
    whole = documents(spark, rows)
    for _, stage in C.STAGES:
        assert stage(spark, whole, sf).count() >= 0
