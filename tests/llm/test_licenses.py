import re

import pyarrow.parquet as pq

from limpid.llm.licenses import PHRASES, licenses

DATA = "/root/testdata/sf0.01/documents.parquet"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def base(text):
    w, at, labels = words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def check(df, texts):
    got = sorted(df.collect(), key=lambda r: r.doc_id)
    assert [tuple(r)[1:6] for r in got] == [base(t) for t in texts]
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and (r.score > 0) == bool(r.labels)
    return got


def test_as_brute_force_on_documents(spark):
    texts = pq.read_table(DATA)["text"].to_pylist()
    got = check(licenses(spark.read.parquet(DATA)), texts)
    for phrase, label in (("Apache License, Version 2.0", "apache-2.0"), ("Released under the MIT License", "mit"), ("CC BY-NC 4.0", "cc-by-nc")):
        assert [label in r.labels.split(",") for r in got] == [phrase in t for t in texts]


def test_edges_and_changed_notices(spark, documents):
    grant = "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"
    texts = [None, "", "...", "cc by cc BY", "cc", "by cc", "General\nPublic-License all rights reserved all rights reserved", "cc by " * 20_000, grant, grant[:60], "cc by é", "écc by", "rights all reserved"]
    got = check(licenses(documents(texts)), texts)
    assert got[8].labels == "mit" and 0.7 <= got[8].score < 1 and got[9].labels == ""
    assert licenses(documents([])).collect() == []


def test_labels_need_their_words(spark, documents):
    start, whole = "licensed under cc ", "Licensed under CC BY-NC 4.0"
    grant = "permission is hereby granted free of charge to any person obtaining a copy of this software"
    texts = [start * 4, start * 30, start * 30 + whole, whole + " " + start * 30, "by nc 4 0 licensed under cc", "version 3 of the license " * 9, grant + " " + grant, whole.replace("NC", "ND")]
    got = check(licenses(documents(texts)), texts)
    assert [r.labels for r in got] == ["", "", "cc-by,cc-by-nc", "cc-by,cc-by-nc", "", "", "", "cc-by"]
    assert [r.score for r in got][:3] == [0.0, 0.0, 1.0]


def test_a_vote_is_for_words_and_not_for_a_hash(spark, documents, monkeypatch):
    """With one hash for all grams, votes are still for equal words only."""
    import numpy as np

    from limpid.llm import licenses as module

    monkeypatch.setattr(module, "grams", lambda h, k: np.zeros(max(0, h.size - k + 1), np.uint64))
    data, known = documents(["cc by", "some other words here", "x all rights reserved"]), {k: np.zeros(1, np.uint64) for k in (2, 3)}
    words = {0: frozenset([b"cc by", b"all rights reserved"])}
    batch = next(module_run(module, data, known, words))
    assert [[h["place"] for h in hs] for hs in batch.column("hits").to_pylist()] == [[0], [], [1]]


def module_run(module, docs, known, words):
    """The function that `hits` hands to Spark, on one batch in this process."""
    import pyarrow as pa

    found = {}

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            found["run"] = run
            return self

        def withColumn(self, *_):  # noqa: N802
            return self

    module.hits(Rows(), known, words)
    rows = docs.select("doc_id", "text").collect()
    batch = pa.RecordBatch.from_pydict({"doc_id": [r.doc_id for r in rows], "text": [r.text for r in rows]})
    return found["run"](iter([batch]))
