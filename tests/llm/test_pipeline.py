import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from limpid.llm import arrays
from limpid.llm.queries import table

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, DATA, "documents").orderBy("doc_id")
    out = {"documents": [r.asDict() for r in docs.collect()]}
    for name, stage in corpus_pipeline.STAGES:
        schema = docs.schema
        docs = stage(spark, docs, DATA)
        out[name] = [r.asDict() for r in docs.collect()]
        if name != "token_ids":
            assert docs.columns == schema.names
            docs = spark.createDataFrame(out[name], schema)
    return out


def test_stages_as_brute_force(steps):
    from test_near_dedup import brute as near
    from test_repeats import brute as cut

    docs = steps["language"]
    assert [d["doc_id"] for d in docs] == [d["doc_id"] for d in steps["documents"]]  # all are clean prose
    kept = {docs[i]["doc_id"] for i, _, _, ok in near([d["text"] for d in docs]) if ok}
    assert {d["doc_id"] for d in steps["near_dedup"]} == kept < {d["doc_id"] for d in docs}
    before = steps["near_dedup"]
    want = {d["doc_id"]: c for d, c in zip(before, cut([d["text"] for d in before], 200), strict=True) if c[1] == 0 or c[1] < c[0]}
    after = {d["doc_id"]: d for d in steps["repeats"]}
    assert after.keys() == want.keys()
    for d in before:
        if d["doc_id"] in want and want[d["doc_id"]][1] == 0:
            assert after[d["doc_id"]] == d
    assert {d["doc_id"] for d in steps["decontamination"]} <= after.keys()
    texts = {d["doc_id"]: d["text"] for d in steps["decontamination"]}
    assert {d["doc_id"] for d in steps["token_ids"]} == texts.keys()
    assert all(d["decoded_sha256"] == hashlib.sha256(texts[d["doc_id"]].encode()).hexdigest() for d in steps["token_ids"])


def test_empty_and_odd_rows(spark, documents):
    for docs in (documents([]), documents([None, "", "a b", "a b", "??", "word " * 30_000])):
        docs = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, DATA)
        docs.collect()


def test_rows_without_or_with_one_doc_id_go_one_by_one(spark):
    item = table(spark, DATA, "benchmark").orderBy("item_id").first()["text"]
    clean = ["one clean text about boats and the sea today", "another text on hills", None]
    rows = [(None, t) for t in (*clean, "leak: " + item)] + [(5, clean[0]), (5, "leak: " + item)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.decontamination(spark, docs, DATA).collect()), key=str)
    assert got == sorted([(None, t) for t in clean] + [(5, clean[0])], key=str)


def test_texts_of_one_doc_id_all_stay_unless_they_repeat(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(40)) for p in "abc")
    rows = [(5, a), (5, a), (5, a.upper()), (5, b), (3, b), (3, c), (None, a), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text.lower()) for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect()), key=str)
    assert got == sorted([(None, a), (None, a), (3, b), (3, c), (5, a)], key=str)


def test_batches_are_bounded_by_bytes(spark):
    """Long texts: 400 rows of 100 KB came as one batch of 40 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    corpus_pipeline.token_ids(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), DATA)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "rows"])

    rows = spark.range(0, 400, 1, 1).selectExpr("id", "repeat('x', 100000) AS text").mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r["rows"] for r in rows) == 400 and max(r["bytes"] for r in rows) < 2 * corpus_pipeline.BATCH_BYTES
    try:
        spark.conf.set(key, "1000")  # a session's own bound stays
        corpus_pipeline.token_ids(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), DATA)
        assert spark.conf.get(key).rstrip("b") == "1000"
    finally:
        spark.conf.unset(key)


def test_tasks_give_memory_back(monkeypatch):
    """After each batch and at the end, also if the task stops early; batches and rows are the same."""
    calls = []
    monkeypatch.setattr(arrays, "give_back", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_arrays([pa.array([k])], ["x"]) for k in range(3)]
    task = arrays.lean(lambda found: (b for b in found))
    assert [b.column("x")[0].as_py() for b in task(iter(batches))] == [0, 1, 2] and len(calls) == 4
    early = task(iter(batches))
    next(early)
    early.close()
    assert len(calls) == 5
    arrays_of = [np.ones(12_000) for _ in range(4000)]  # below the size of a mapping of its own
    last, arrays_of = arrays_of[-1], None
    monkeypatch.undo()
    arrays.give_back()
    assert last.sum() == 12_000
