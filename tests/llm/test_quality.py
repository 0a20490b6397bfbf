import numpy as np
from pyspark.sql import functions as F

from limpid.llm.quality import CONTENT, LocalPool, SparkPool, View, _both, classify, co_train, content_features, fit, train, views
from limpid.llm.queries import op7_quality, table

DATA = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = table(spark, DATA, "labels").filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    row = (
        op7_quality(spark, DATA)
        .join(labels, "doc_id")
        .agg(F.count("*"), F.avg(((F.col("quality") == 1) == F.col("good")).cast("int")), F.avg(F.when(F.col("quality") == 1, F.col("good").cast("int"))))
        .first()
    )
    assert row[0] > 600 and row[1] > 0.98 and row[2] > 0.98


def test_pool_helps_the_weaker_view():
    rng = np.random.default_rng(1)

    def draw(n):
        y = rng.integers(0, 2, n).astype(float)
        return rng.normal(size=(n, 4)) + 3 * y[:, None], rng.normal(size=(n, 12)) + 0.9 * y[:, None], y

    a, b, y = draw(24)
    pa_, pb, _ = draw(3000)
    ta, tb, ty = draw(3000)
    right = lambda m: ((m.page.logit(tb) > 0) == ty).mean()
    alone, taught = (co_train((a, b, y, np.arange(24)), (pa_, pb), rounds) for rounds in (0, 5))
    assert right(taught) > right(alone) and right(taught) > 0.85
    assert ((taught.scores(ta, tb)[:, 0] > 0.5) == ty).mean() > 0.95


def test_edges(spark, documents):
    texts = [None, "", "a", "word " * 60_000, "same text", "same text", "é漢字 | | |", "\n\n"]
    docs = documents(texts)
    label = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for rows, base in (([], 0.5), ([(0, 1, 0), (1, 1, 0), (99, 0, 0), (None, 0, 0), (2, None, 0)], 1.0)):
        got = classify(docs, label(rows)).collect()
        assert len(got) == len(texts) and {r.score for r in got} == {base}
    many = documents([("good prose, here it is. " * 3 if i % 2 else "# | # | # ") + str(i % 5) for i in range(80)])
    got = {r.doc_id: r for r in classify(many, label([(i, i % 2, 0) for i in range(40)])).collect()}
    assert all(got[i].good == bool(i % 2) for i in range(80)) and all(0 <= r.score <= 1 for r in got.values())
    assert classify(documents([]), label([])).collect() == []


def test_features_and_fit():
    import pyarrow as pa

    x = content_features(pa.array([None, "ab AB. 1", "", "z"]))
    assert x.shape == (4, CONTENT) and np.isfinite(x).all() and (x[0] == x[2]).all()
    m = fit(np.array([[0.0], [1.0], [2.0], [3.0]]), np.array([0.0, 0.0, 1.0, 1.0]), 0.1)
    assert (m.logit(np.array([[0.0], [3.0]])) * [-1, 1] > 0).all()


def test_sources_that_begin_alike_are_told_apart(spark):
    names = [f"https://www.example-{k}.org" for k in range(100)] + [f"source_{k:02d}" for k in range(50)] + [None, ""]
    docs = spark.createDataFrame([(i, "a b", "en", n) for i, n in enumerate(names)], "doc_id long, text string, lang string, source string")
    rows = views(docs).collect()
    assert len({r.source for r in rows}) >= len(names) - 2 and len({r.lang for r in rows}) == 1
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, "a b", "en", f"https://www.{'good' if i % 2 else 'poor'}.org") for i in range(500)], docs.schema)
    assert all(r.good == bool(r.doc_id % 2) for r in classify(docs, labels).collect())


def test_fit_with_sources_as_with_dense_columns():
    rng = np.random.default_rng(2)
    x, source, lang = rng.normal(size=(300, 2)), rng.integers(0, 5, 300), rng.integers(0, 3, 300)
    y = (x[:, 0] + (source > 2) + rng.normal(size=300) > 0.5).astype(float)
    got = fit(View(x, source, lang), y)
    z = np.column_stack([np.ones(300), (x - x.mean(0)) / x.std(0), np.eye(3)[lang], np.eye(5)[source]])
    w, penalty = np.zeros(11), np.array([1e-3] + [1.0] * 10)
    for _ in range(20):
        p = 1 / (1 + np.exp(-z @ w))
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
    assert np.allclose(got.logit(View(x, source, lang)), z @ w, atol=1e-6)


def test_exchange_looks_at_all_unlabelled_documents(spark, documents):
    # One rare source in far more documents than are labelled: the page view knows it only through what the text view teaches.
    rng = np.random.default_rng(3)
    good, source = rng.integers(0, 2, 3000), rng.integers(0, 4, 3000)
    rows = [(i, "good prose, here it is. " * 3 if g else "# | # | # ", "en", "rare" if i % 100 == 99 and g else f"s{s}") for i, (g, s) in enumerate(zip(good.tolist(), source.tolist(), strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, g) for i, g in enumerate(good.tolist()) if i < 300 and i % 100 != 99], "doc_id long, quality int")
    found = views(docs).persist()
    model = train(found, labels, taught=0.2)
    rare = found.filter("doc_id >= 300").join(docs.filter("source = 'rare'").select("doc_id"), "doc_id").first()
    assert model.page.source[rare.source] > 0
    local = _both(found.join(labels, "doc_id", "left_anti").toArrow())
    pool = SparkPool(found.join(labels, "doc_id", "left_anti"))
    both = [model.content, model.page]
    assert pool.size == len(local[0].x) and all((a == b).all() for a, b in zip(pool.counts(both), LocalPool(*local).counts(both), strict=True))
    # The whole training as with all rows in memory.
    drawn = found.join(labels, "doc_id").withColumn("draw", F.abs(F.xxhash64("doc_id") % 1_000_000)).orderBy("doc_id").toArrow()
    content, page = _both(drawn)
    plain = co_train((content, page, drawn.column("quality").to_numpy().astype(float), drawn.column("draw").to_numpy()), local, taught=0.2)
    assert np.allclose(plain.scores(*local), model.scores(*local), atol=1e-6)


def test_the_size_of_the_pool_changes_little():
    """Ten times the unlabelled documents, all alike: the same fit but for rounding of the cuts."""
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 60).astype(float)
    a, b = rng.normal(size=(60, 3)) + 2 * y[:, None], rng.normal(size=(60, 2)) + y[:, None]
    z = rng.integers(0, 2, 500)
    pool = rng.normal(size=(500, 3)) + 2 * z[:, None], rng.normal(size=(500, 2)) + z[:, None]
    once, often = (co_train((a, b, y, np.arange(60)), tuple(np.repeat(v, n, axis=0) for v in pool)) for n in (1, 10))
    assert np.abs(once.scores(*pool)[:, 0] - often.scores(*pool)[:, 0]).max() < 0.05
