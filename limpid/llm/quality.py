"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other.

Both views start from a bounded sample of labelled documents. In each round each view labels those of all unlabelled
documents that it is surest of, and the other view learns from them too, through sums that Spark adds up. The views are calibrated on labelled documents that neither has seen and joined to
one score for every document.

Null text counts as empty, null lang and source are values of their own. Documents without doc_id are scored as all
others and never learned from. Labels of documents that don't exist, and null labels, are left out; of several labels the
greatest counts. Repeated rows get equal scores. With labels of one kind only, or none, every score is the share of good
ones (0.5 without any). Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.arrays import not_space, text_slices, words_of
from limpid.llm.storage import stored

#: About so many labelled documents are fitted on, drawn by a hash of doc_id; some 500 bytes each.
LABELLED = 20_000
#: All unlabelled documents take part in the exchange. Were all of them taught, they would weigh together so many times as
#: much as the labelled ones, however many they are.
TAUGHT = 4.0
ROUNDS = 5
#: Logits are counted in so many bins for the cut-offs.
BINS = 1 << 16
#: Share of the unlabelled documents that a view labels in a round.
STEP = 0.05
#: Hashed columns of the source and of the lang of a page; a page stores two numbers, so they cost nothing a row.
SOURCES = 1 << 16
LANGS = 128
CONTENT = 16


def _classes() -> np.ndarray:
    """Kind of each byte: 0 other, 1 a-z, 2 A-Z, 3 0-9, 4 end of sentence, 5 other sign, 6 white space, 7 beyond ASCII."""
    kind = np.zeros(256, np.int64)
    kind[33:127] = 5
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 1, 2, 3, 7
    kind[[46, 33, 63, 44]] = 4
    kind[[32, 9, 10, 11, 12, 13]] = 6
    return kind


def content_features(column: pa.Array) -> np.ndarray:
    """A row for each text: shares of kinds of bytes, of repeated words and lines, lengths of words and sentences."""
    out = []
    kinds = _classes()
    for s in text_slices(column):
        n = s.offsets.size - 1
        text = np.repeat(np.arange(n), np.diff(s.offsets))
        kind = np.bincount(text * 8 + kinds[s.data], minlength=8 * n).reshape(n, 8)
        size = np.maximum(kind.sum(1), 1)
        w = words_of(s, not_space())
        words = np.diff(w.first)
        own = np.repeat(np.arange(n), words)
        lines = np.ones(256, bool)
        lines[10] = False
        li = words_of(s, lines)
        distinct = []
        for part in (w, li):
            distinct.append(np.array([np.unique(part.hash[a:b]).size for a, b in zip(part.first[:-1], part.first[1:], strict=True)]))
        length = np.bincount(own, w.end - w.start, n)
        upper = np.bincount(own, kinds[s.data[w.start]] == 2, n)
        sign = np.bincount(own, np.isin(kinds[s.data[w.end - 1]], (5,)), n)
        alone = np.bincount(own, w.end - w.start == 1, n)
        m, k = np.maximum(words, 1), np.maximum(np.diff(li.first), 1)
        out.append(
            np.column_stack(
                [kind[:, 1:] / size[:, None], np.log1p(words), length / m / 10, upper / m, sign / m, alone / m, 1 - distinct[0] / m, 1 - distinct[1] / k, kind[:, 2] / np.maximum(kind[:, 1] + kind[:, 2], 1), words == 0]
            )
        )
    return np.concatenate(out) if out else np.zeros((0, CONTENT))


def page_features(chars: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A row for each page: size, lines and their length."""
    return np.column_stack([np.log1p(chars), np.log1p(lines), np.log1p(chars / np.maximum(lines, 1))])


def views(docs: DataFrame) -> DataFrame:
    """doc_id, content and page (arrays of floats), hashed columns of source and lang, of every row."""
    names = ["doc_id", "content", "page", "source", "lang"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                content = content_features(part.column("text"))
                page = page_features(part.column("chars").to_numpy(), part.column("lines").to_numpy())
                columns = [pa.array(list(x.astype(np.float32)), pa.list_(pa.float32())) for x in (content, page)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns, part.column("source"), part.column("lang")], names)

    text = F.coalesce("text", F.lit(""))
    slot = lambda c, n: F.pmod(F.xxhash64(F.lit(c), F.col(c)), F.lit(n)).cast("int").alias(c)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", slot("lang", LANGS), slot("source", SOURCES), F.length(text).alias("chars"), (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("lines")
    )
    return rows.mapInArrow(run, "doc_id long, content array<float>, page array<float>, source int, lang int")


class View(NamedTuple):
    """Features of rows, and the hashed columns that are 1 in them, if the view has such."""

    x: np.ndarray
    source: np.ndarray | None = None
    lang: np.ndarray | None = None

    def take(self, which: np.ndarray) -> View:
        return View(*(None if v is None else v[which] for v in self))


def _view(x: np.ndarray | View) -> View:
    return x if isinstance(x, View) else View(x)


@dataclass
class Logistic:
    """core: weights of 1, the features and the langs; source: those of the sources."""

    mean: np.ndarray
    scale: np.ndarray
    core: np.ndarray
    source: np.ndarray

    @staticmethod
    def start(x: np.ndarray | View) -> Logistic:
        v = _view(x)
        mean, scale = v.x.mean(0), v.x.std(0)
        scale[scale < 1e-6] = 1.0
        hashed = v.source is not None
        return Logistic(mean, scale, np.zeros(1 + mean.size + LANGS * hashed), np.zeros(SOURCES * hashed))

    def logit(self, x: np.ndarray | View) -> np.ndarray:
        v = _view(x)
        d = 1 + self.mean.size
        z = ((v.x - self.mean) / self.scale) @ self.core[1:d] + self.core[0]
        if v.source is not None:
            z = z + self.core[d:][v.lang] + self.source[v.source]
        return np.clip(z, -30, 30)


def sums(model: Logistic, x: np.ndarray | View, y: np.ndarray, weight: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """What a Newton step needs of these rows, as (sorted cells, values); of equal cells the values of several parts add up.

    With k core weights, cell (i, j) is i * (k + 2) + j for the core and (k + source) * (k + 2) + j for a source; column k
    holds a source's own second derivative and column k + 1 the gradient.
    """
    v = _view(x)
    k, d = model.core.size, 1 + model.mean.size
    p = 1 / (1 + np.exp(-model.logit(v)))
    r, q = weight * (y - p), weight * p * (1 - p)
    z = np.zeros((len(y), k))
    z[:, 0] = 1
    z[:, 1:d] = (v.x - model.mean) / model.scale
    if v.source is not None:
        z[np.arange(len(y)), d + v.lang] = 1
    own = np.zeros((k, k + 2))
    own[:, :k] = (z * q[:, None]).T @ z
    own[:, k + 1] = z.T @ r
    cells = [np.flatnonzero(own)]
    values = [own.reshape(-1)[cells[0]]]
    if v.source is not None:
        at = (k + v.source.astype(np.int64)) * (k + 2)
        cells += [at + j for j in range(d)] + [at + d + v.lang, at + k, at + k + 1]
        values += [q * z[:, j] for j in range(d)] + [q, q, r]
    return merged(np.concatenate(cells), np.concatenate(values))


def merged(cells: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cells, at = np.unique(cells, return_inverse=True)
    return cells, np.bincount(at, values, cells.size)


def newton(model: Logistic, cells: np.ndarray, values: np.ndarray, ridge: float = 1.0) -> float:
    """Moves the model by a step; the greatest move. Sources are eliminated first, as no row has two."""
    cells, values = merged(cells, values)
    k = model.core.size
    row, column = np.divmod(cells, k + 2)
    core = row < k
    own = np.zeros((k, k + 2))
    own[row[core], column[core]] = values[core]
    penalty = np.full(k, ridge)
    penalty[0] = 1e-3
    h, g = own[:, :k] + np.diag(penalty), own[:, k + 1] - penalty * model.core
    used = np.union1d(row[~core] - k, np.flatnonzero(model.source))
    block = np.zeros((used.size, k + 2))
    block[np.searchsorted(used, row[~core] - k), column[~core]] = values[~core]
    cross, second, slope = block[:, :k], block[:, k] + ridge, block[:, k + 1] - ridge * model.source[used]
    step = np.linalg.solve(h - cross.T @ (cross / second[:, None]), g - cross.T @ (slope / second))
    more = (slope - cross @ step) / second
    model.core = model.core + step
    model.source = model.source.copy()
    model.source[used] += more
    return max(np.abs(step).max(), np.abs(more).max(initial=0))


def fit(x: np.ndarray | View, y: np.ndarray, ridge: float = 1.0) -> Logistic:
    """Ridge logistic regression by Newton steps."""
    model = Logistic.start(x)
    for _ in range(12):
        if newton(model, *sums(model, x, y), ridge) < 1e-6:
            break
    return model


@dataclass
class Model:
    base: float
    content: Logistic | None = None
    page: Logistic | None = None
    joint: Logistic | None = None

    def scores(self, content: np.ndarray | View, page: np.ndarray | View) -> np.ndarray:
        """Columns: joint score, calibrated logits of the views."""
        if self.joint is None:
            return np.column_stack([np.full(len(_view(content).x), self.base), np.zeros((len(_view(content).x), 2))])
        z = np.column_stack([self.content.logit(content), self.page.logit(page)])
        return np.column_stack([1 / (1 + np.exp(-self.joint.logit(z))), z])


def _bins(z: np.ndarray) -> np.ndarray:
    return np.minimum(((z + 30) * (BINS / 60)).astype(np.int64), BINS - 1)


def _cut(counts: np.ndarray, good: int, bad: int) -> tuple[int, int]:
    """Bins from and up to which the surest documents of each kind lie, whole bins; none if they meet."""
    high = BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), good))
    low = int(np.searchsorted(np.cumsum(counts), bad))
    return (high, low) if low < high else (BINS, -1)


@dataclass
class Lesson:
    """Two new models (content, page) that learn from what the other view's teacher is surest of."""

    models: list[Logistic]
    teachers: list[Logistic]
    cuts: list[tuple[int, int]]
    weight: float

    def sums(self, both: tuple[View, View]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for k in (0, 1):
            high, low = self.cuts[1 - k]
            sure = _bins(self.teachers[1 - k].logit(both[1 - k]))
            which = np.flatnonzero((sure >= high) | (sure <= low))
            out.append(sums(self.models[k], both[k].take(which), (sure[which] >= high).astype(float), self.weight))
        return out


class LocalPool:
    """Unlabelled documents in memory."""

    def __init__(self, content: np.ndarray | View, page: np.ndarray | View):
        self.both = _view(content), _view(page)
        self.size = len(self.both[0].x)

    def counts(self, models: list[Logistic]) -> list[np.ndarray]:
        return [np.bincount(_bins(m.logit(v)), minlength=BINS) for m, v in zip(models, self.both, strict=True)]

    def sums(self, lesson: Lesson) -> list[tuple[np.ndarray, np.ndarray]]:
        return lesson.sums(self.both)


class SparkPool:
    """Unlabelled documents as a stored DataFrame of views. What comes back is bounded by the models, not by the rows."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.size = rows.count()

    def _added(self, shared, work) -> list[tuple[np.ndarray, np.ndarray]]:
        """work(shared, content and page of a batch): (cells, values) of each view, added up over all rows."""
        sent = self.rows.sparkSession.sparkContext.broadcast(shared)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[list] = [[], []]
            for batch in batches:
                if not batch.num_rows:
                    continue
                for k, part in enumerate(work(sent.value, _both(batch))):
                    held[k].append(part)
                    if len(held[k]) > 16:
                        held[k] = [merged(*map(np.concatenate, zip(*held[k], strict=True)))]
            for k in (0, 1):
                if held[k]:
                    cells, values = merged(*map(np.concatenate, zip(*held[k], strict=True)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(cells.size, k, np.int32)), pa.array(cells), pa.array(values, pa.float64())], ["view", "cell", "value"])

        table = self.rows.mapInArrow(run, "view int, cell long, value double").groupBy("view", "cell").agg(F.sum("value").alias("value")).toArrow()
        sent.destroy()
        view, cell, value = (table.column(c).to_numpy() for c in ("view", "cell", "value"))
        return [(cell[view == k], value[view == k]) for k in (0, 1)]

    def counts(self, models: list[Logistic]) -> list[np.ndarray]:
        work = lambda models, both: [merged(b := _bins(m.logit(v)), np.ones(b.size)) for m, v in zip(models, both, strict=True)]
        return [np.bincount(cells, values, BINS) for cells, values in self._added(models, work)]

    def sums(self, lesson: Lesson) -> list[tuple[np.ndarray, np.ndarray]]:
        return self._added(lesson, lambda lesson, both: lesson.sums(both))


def co_train(labelled: tuple, pool, rounds: int = ROUNDS, step: float = STEP, taught: float = TAUGHT) -> Model:
    """labelled: (content, page, labels, draw); pool: (content, page) or one of the pools. A quarter of the labelled calibrates.

    Taught documents weigh `taught` times the labelled ones by the documents of the pool each.
    """
    content, page, y, draw = labelled
    if y.size < 8 or y.min() == y.max():
        return Model(float(y.mean()) if y.size else 0.5)
    pool = LocalPool(*pool) if isinstance(pool, tuple) else pool
    rest = draw % 4 == 1
    if min(y[rest].sum(), (1 - y[rest]).sum(), y[~rest].sum(), (1 - y[~rest]).sum()) < 1:
        rest = np.zeros(y.size, bool)
    data = [_view(content), _view(page)]
    weight = taught * y.size / max(1, pool.size)
    models = [fit(v.take(~rest), y[~rest]) for v in data]
    for turn in range(rounds if pool.size else 0):
        cuts = []
        for k, counts in enumerate(pool.counts(models)):  # what view k is surest of, as many of each kind as the labelled have, teaches the other one
            # A view that can't tell kinds apart on unseen labels would only teach its noise.
            own = models[k].logit(data[k].take(rest) if rest.any() else data[k])
            known = y[rest] if rest.any() else y
            ranks = np.argsort(np.argsort(own))
            apart = (ranks[known == 1].mean() - ranks[known == 0].mean()) / max(1, len(known))
            n = max(1, int(step * (turn + 1) * pool.size))
            good = max(1, int(n * y.mean()))
            cuts.append(_cut(counts, good, max(1, n - good)) if apart > 0.2 else (BINS, -1))
        lesson = Lesson([Logistic.start(v.take(~rest)) for v in data], models, cuts, weight)
        for _ in range(12):
            moves = []
            for k, (cells, values) in enumerate(pool.sums(lesson)):
                own = sums(lesson.models[k], data[k].take(~rest), y[~rest])
                moves.append(newton(lesson.models[k], np.concatenate([own[0], cells]), np.concatenate([own[1], values])))
            if max(moves) < 1e-3:
                break
        models = lesson.models
    use = rest if rest.any() else np.ones(y.size, bool)
    z = np.column_stack([m.logit(v.take(use)) for m, v in zip(models, data, strict=True)])
    return Model(float(y.mean()), models[0], models[1], fit(z, y[use]))


def _both(batch: pa.Table | pa.RecordBatch) -> tuple[View, View]:
    """Content and page of rows of views."""
    table = batch if isinstance(batch, pa.Table) else pa.Table.from_batches([batch])
    content, page = (_matrix(table.column(c), table.num_rows) for c in ("content", "page"))
    return View(content), View(page, table.column("source").to_numpy(), table.column("lang").to_numpy())


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(rows, -1) if rows else np.zeros((0, 1))


def train(found: DataFrame, labels: DataFrame, labelled: int = LABELLED, taught: float = TAUGHT, rounds: int = ROUNDS) -> Model:
    """found: the views of the documents that may be learned from; labels: doc_id, quality."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("quality") > 0).cast("int").alias("y"))
    drawn = found.filter("doc_id IS NOT NULL").withColumn("draw", F.abs(F.xxhash64("doc_id") % 1_000_000)).join(marks, "doc_id", "left")
    drawn = stored(drawn, "drawn")
    share = 1e6 * labelled / max(1, drawn.filter("y IS NOT NULL").count())
    table = drawn.filter(F.col("y").isNotNull() & (F.col("draw") < share)).orderBy("doc_id").toArrow()
    content, page = _both(table)
    rest = SparkPool(drawn.filter("y IS NULL").select("content", "page", "source", "lang"))
    return co_train((content, page, table.column("y").to_numpy().astype(float), table.column("draw").to_numpy()), rest, rounds, taught=taught)


def score(found: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, score, content_logit, page_logit, good of every row of views."""
    shared = found.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "score", "content_logit", "page_logit", "good"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            s = shared.value.scores(*_both(batch)) if n else np.zeros((0, 3))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(s[:, k]) for k in range(3)], pa.array(s[:, 0] >= least)], names)

    return found.mapInArrow(run, "doc_id long, score double, content_logit double, page_logit double, good boolean")


def classify(docs: DataFrame, labels: DataFrame, learn_from=None, **options) -> DataFrame:
    """Scores of all documents after co-training on those that learn_from (a filter of views) lets through."""
    found = stored(views(docs), "views")
    return score(found, train(learn_from(found) if learn_from else found, labels, **options))
