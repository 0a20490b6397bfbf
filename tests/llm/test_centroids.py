"""k-means by subvector dictionaries against a plain version in Python."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from limpid.llm.centroids import chunks, cluster_vectors, encode, integers, nearest


def plain(rows, k, rounds, dims, scale=1024, seed=3):
    """rows: (id, list or None)."""
    kept = [
        (i, tuple(math.floor(Fraction(x) * scale) for x in v))
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "x"
    centroids = [v for i, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == j]
            if own:
                centroids[j] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    found = assign()
    total = sum(d for d, _ in found)
    by = [sum(d for d, c in found if c == j) for j in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, c, d, by[c], total, sha[c]) for (i, _), (d, c) in zip(kept, found, strict=True)], key=str)


def found(df, **more):
    return sorted((tuple(r) for r in cluster_vectors(df, **more).collect()), key=str)


@pytest.fixture
def table(spark):
    def make(rows, kind="double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        return df.selectExpr("*", "'x' as id", "0 as cluster", "0 as v", "1 as distance")

    return make


def some(n, dims, seed=1, digits=2):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(0, 1), digits) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 14])
@pytest.mark.parametrize("dims, k, digits", [(4, 3, 1), (1, 2, 0), (9, 8, 3)])
def test_clusters_equal_the_plain_version(table, chunk, dims, k, digits):
    rows = some(120, dims, digits=digits)
    assert found(table(rows), k=k, rounds=4, dims=dims, chunk=chunk) == plain(rows, k, 4, dims)


def test_hard_rows(table):
    nan, inf = float("nan"), float("inf")
    rows = some(30, 3)
    rows += [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, 2.0, 3.0, 4.0]), (104, [nan, 1.0, 1.0])]
    rows += [(105, [1.0, inf, 1.0]), (106, [1.0, -inf, 1.0]), (107, [1.0, None, 1.0]), (None, None)]
    rows += [(None, [0.5, 0.5, 0.5]), (None, [0.25, -0.5, 0.5]), (3, [9.0, 9.0, 9.0]), (3, [-9.0, 9.0, 9.0])]
    rows += [(200, [0.125, -0.0, 0.25])] * 40  # more than a third are one vector
    assert found(table(rows), k=4, rounds=5, dims=3) == plain(rows, 4, 5, 3)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(table):
    rows = [(i, [1.0, 1.0]) for i in range(10)] + [(20, [2.0, 1.0])]
    expected = plain(rows, 5, 3, 2)
    assert found(table(rows), k=5, rounds=3, dims=2) == expected
    assert len({r[1] for r in expected}) < 5


def test_fewer_vectors_than_clusters_and_none(table):
    rows = some(3, 2)
    assert found(table(rows), k=8, rounds=2, dims=2) == plain(rows, 8, 2, 2)
    assert found(table([]), k=8, rounds=2, dims=2) == []
    assert cluster_vectors(table([])).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_negative_numbers_round_down(table):
    rows = [(1, [-0.0001]), (2, [-0.001]), (3, [0.0009]), (4, [-1.5])]
    assert found(table(rows), k=2, rounds=3, dims=1) == plain(rows, 2, 3, 1)


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(df, k=8, rounds=3) == plain(rows, 8, 3, 64)


def test_far_components_raise(table):
    with pytest.raises(Exception, match="beyond"):
        found(table([(1, [1e30])]), k=1, rounds=1, dims=1)
    assert found(table([(1, [131072.0]), (2, [-131072.0])]), k=1, rounds=1, dims=1) == plain([(1, [131072.0]), (2, [-131072.0])], 1, 1, 1)


@pytest.mark.parametrize("values, dims, n", [(2, 12, 500), (3, 5, 40), (1000, 6, 300), (1, 4, 10), (2, 1, 1)])
def test_dictionaries_lose_nothing(values, dims, n):
    rows = np.random.default_rng(5).integers(-values, values, (n, dims))
    blocks = encode(rows)
    assert [b[0] for b in blocks] == np.cumsum([0, *[b[1] for b in blocks[:-1]]]).tolist()
    assert np.array_equal(np.hstack([entries[codes] for _, _, entries, codes in blocks]), rows)
    for _, _, entries, _ in blocks:
        assert len(np.unique(entries, axis=0)) == len(entries)
    if values == 2 and n == 500:
        assert len(blocks) < dims  # few values: wide blocks


def test_partial_distances_add_up():
    rng = np.random.default_rng(6)
    rows, centroids = rng.integers(-3, 3, (400, 10)), rng.integers(-3, 3, (5, 10))
    cluster, distance = nearest(encode(rows), centroids)
    exact = ((rows[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert np.array_equal(cluster, exact.argmin(axis=1))
    assert np.array_equal(distance, exact.min(axis=1))


def test_chunks_hold_every_vector_once(table):
    df = table(some(100, 3)).select("vec_id", integers_of("embedding"))
    rows = chunks(df, 9).collect()
    assert sorted(i for r in rows for i in r.ids) == list(range(100))
    assert max(len(r.ids) for r in rows) <= 9


def integers_of(name):
    from pyspark.sql import functions as F

    return integers(F.col(name), 3, 1024)
