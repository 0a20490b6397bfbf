import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from limpid.llm.decontaminate import decontaminate, leaks, tiles

DATA = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(doc, item, least):
    """The longest match of unmarked words, leftmost first, until none has `least` words."""
    d, i = [False] * len(doc), [False] * len(item)
    total = 0
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(item)):
            for q in range(len(doc)):
                n = 0
                while p + n < len(item) and q + n < len(doc) and item[p + n] == doc[q + n] and not i[p + n] and not d[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < least:
            return total
        i[p : p + n] = d[q : q + n] = [True] * n
        total += n


def test_tiles_as_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        doc, item = ([rng.randrange(4) for _ in range(rng.randint(0, 40))] for _ in range(2))
        got = tiles(np.array(doc, np.uint64), np.array(item, np.uint64), 3)
        assert sum(t[2] for t in got) == brute(doc, item, 3)


def test_as_brute_force_on_documents(spark):
    docs, items = pq.read_table(f"{DATA}/documents.parquet").to_pylist(), pq.read_table(f"{DATA}/benchmark.parquet").to_pylist()
    want = set()
    for item in items:
        w = words(item["text"])
        seeds = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        for doc in docs:
            v = words(doc["text"])
            if any(tuple(v[k : k + 5]) in seeds for k in range(len(v) - 4)) and brute(v, w, 5) >= 0.5 * len(w):
                want.add((doc["doc_id"], item["item_id"]))
    read = lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")
    assert want and {(r.doc_id, r.item_id) for r in leaks(read("documents"), read("benchmark")).collect()} == want
    got = {r.doc_id for r in decontaminate(read("documents"), read("benchmark")).collect() if r.contaminated}
    assert got == {d for d, _ in want}


@pytest.mark.parametrize("most", [1000, 0])
def test_reordered_passages_and_edges(spark, documents, most):
    item = [f"w{k}" for k in range(40)]
    texts = [" ".join(item), "x " + " ".join(item[20:] + ["y"] + item[:20]).upper(), " ".join(item[:19]), None, "", "w1 w2 w3", " ".join(["w0"] * 30_000), " ".join(item)]
    bench = spark.createDataFrame([(2, " ".join(item)), (1, " ".join(item)), (3, None), (4, "w1 w2 w3 w4"), (None, ""), (5, " ".join(item[:10] * 4))], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_id) for r in decontaminate(documents(texts), bench, most_seeds=most).collect()}
    assert got[0] == got[1] == got[7] == (True, 2, 1)
    assert [got[k] for k in range(2, 7)] == [(False, 0, None)] * 5
    assert decontaminate(documents([]), bench).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate(documents(texts), none).collect())


def test_items_without_id_short_items_and_scripts_without_blanks(spark, documents):
    item = " ".join(f"w{k}" for k in range(20))
    texts = [f"a {item} b", "so Yes, no maybe said", "yes maybe no", "前文。今天天气很好我们去公园散步。后文", "今天很好", "ก่อน สวัสดีครับผม หลัง", "w1 w2 w3"]
    bench = spark.createDataFrame(
        [(None, item), (None, item), (None, "yes no maybe"), (7, "今天天气很好我们去公园散步"), (8, "สวัสดีครับผม"), (9, "𠀀𠀁"), (10, "w1 w2 w3 w4")], "item_id long, text string"
    )
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_id) for r in decontaminate(documents([*texts, "x𠀀𠀁y"]), bench, short=True).collect()}
    assert got == {0: (True, 2, 10), 1: (True, 1, None), 2: (False, 0, None), 3: (True, 1, 7), 4: (False, 0, None), 5: (True, 1, 8), 6: (False, 0, None), 7: (True, 1, 9)}
