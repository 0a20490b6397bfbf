import hashlib
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from limpid.llm.merkle import edited_neighbours, first_changed_paragraph, likeness, tree

DATA = "/root/testdata/sf0.001/documents.parquet"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def root(text):
    sections, last = [[]], False
    for p in text.split("\n"):
        if last:
            sections.append([])
        sections[-1].append(sha(p))
        last = sections[-1][-1][0] in "01"
    return sha(" ".join(sha(" ".join(s)) for s in sections))


def names(text):
    """The nodes below the root, each level apart; a lone paragraph or section is left out."""
    nodes = [[]]
    for p in text.split("\n"):
        if nodes[-1] and nodes[-1][-1][0] in "01":
            nodes.append([])
        nodes[-1].append(sha(p))
    phrases = re.split(r"(?<=[.,;:!?|。！？dghkmpwxyz]\s)", text, flags=re.ASCII)
    middle = [(1, n) for s in nodes for n in s]
    upper = [(2, sha(" ".join(s))) for s in nodes]
    return {*phrases, *(middle if len(middle) > 1 else []), *(upper if len(upper) > 1 else [])}


def alike(a, b):
    if root(a) == root(b):
        return 1.0
    a, b = names(a), names(b)
    return min(2 * len(a & b) / (len(a) + len(b)), 0.999999)


def brute(texts):
    texts = [t or "" for t in texts]
    out = []
    for i, t in enumerate(texts):
        k = len(t) // 4
        edited = t[: len(t) - k] + texts[(i + 1) % len(texts)][:k]
        out.append((i, len(t), sha(edited), root(t), root(edited), alike(t, edited), alike(t, texts[(i + 1) % len(texts)])))
    return out


def check(df, texts):
    got = sorted(df.collect())
    expected = brute(texts)
    assert [tuple(r)[:5] for r in got] == [e[:5] for e in expected]
    for r, e in zip(got, expected, strict=True):
        # Two nodes may share a name of 32 bits.
        assert (r.near_edited, r.near_next) == pytest.approx(e[5:], abs=0.001)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
    return got


def test_as_brute_force_on_documents(spark):
    texts = pq.read_table(DATA)["text"].to_pylist()
    got = check(edited_neighbours(spark.read.parquet(DATA)), texts)
    assert sum(r.near_edited > 0.4 for r in got) > 0.9 * len(got)
    assert sum(r.near_edited >= r.near_next for r in got) > 0.9 * len(got)


def test_edges(spark, documents):
    texts = [None, "", "a", "abc", "abcd", "éß漢字🙂" * 5, "\n\n\n", "same\ntext", "same\ntext", "x. " * 40_000, "p\n" * 500]
    check(edited_neighbours(documents(texts)), texts)
    check(edited_neighbours(documents(["alone, one\ntwo"])), ["alone, one\ntwo"])
    assert edited_neighbours(documents([])).collect() == []
    odd = spark.createDataFrame([(None, "abcdefgh"), (5, "abcdefgh"), (5, "b" * 8), (900, "zzzzyyyy")], "doc_id long, text string")
    got = {(r.doc_id, r.fingerprint): r for r in edited_neighbours(odd).collect()}
    assert len(got) == 4 and got[None, root("abcdefgh")].near_next is None and got[None, root("abcdefgh")].near_edited == 1
    assert got[900, root("zzzzyyyy")].edited_sha256 == sha("zzzzyyab") and got[5, root("b" * 8)].edited_sha256 == sha("bbbbbbzz")


def test_edits_are_located(spark):
    lines = [f"line {i}" for i in range(50)]
    new = [*lines[:33], "changed", *lines[34:]]
    row = spark.createDataFrame([("\n".join(lines), "\n".join(new))], "a string, b string").select(tree(F.col("a")).alias("a"), tree(F.col("b")).alias("b"))
    got = row.select(first_changed_paragraph(F.col("a"), F.col("b")), first_changed_paragraph(F.col("a"), F.col("a")), likeness(F.col("a"), F.col("a"))).first()
    assert tuple(got) == (33, None, 1.0)


def test_no_python_in_the_plan(spark):
    plan = edited_neighbours(spark.read.parquet(DATA))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_only_equal_trees_are_quite_alike(spark):
    pairs = [("one two. three four. ", "three four. one two. "), ("a\nb", "b\na"), ("x. x. ", "x. "), ("", "\n"), ("same", "same"), ("a b", "c d")]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", likeness(tree(F.col("a")), tree(F.col("b"))).alias("n"))
    for r in df.collect():
        assert r.n == pytest.approx(alike(r.a, r.b)) and (r.n == 1) == (r.a == r.b)


def test_texts_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = edited_neighbours(spark.read.parquet(DATA))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 2 and sum("ReusedExchange" in line for line in dealt) == 1
