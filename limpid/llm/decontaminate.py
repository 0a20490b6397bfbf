"""Finds benchmark items in documents by greedy string tiling over words.

Words are runs of 0-9, A-Z (as a-z) and characters beyond ASCII; in scripts that set no blanks, such as Chinese, Japanese
and Thai, each character is a word. A document and an item that share a seed, five words in a row,
are tiled: the longest match of unmarked words is marked on both sides, again and again down to five words, so a
passage cut up and put into another order still counts. An item is leaked if the tiles cover enough of its words.

Null and empty texts hold nothing. Items of fewer than five words can't be told from common phrases: with short, a
document that holds all their words in a row matches, without it nothing does. Each row is judged on its own, also if
its doc_id is missing or repeated; copies get equal answers. An item of several rows matches by any of them. Rows without
item_id are an item each (equal words: one) and are matched and counted as all others. Of items with equal coverage the
least item_id is named. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.arrays import U64, alphanumeric, grams, lean, owner, text_slices, words_and_characters
from limpid.llm.rows import row_key
from limpid.llm.storage import stored

SEED = 5
COVERAGE = 0.5
#: Up to so many seeds (8 bytes each) are sent to the tasks; beyond that all seeds are joined by a shuffle.
MOST_SEEDS = 4_000_000


def tiles(doc: np.ndarray, item: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """(place in the item, place in the document, length) of the tiles; longest first, then by place."""
    a, b = grams(item, least), grams(doc, least)
    order = np.argsort(a, kind="stable")
    lo, hi = np.searchsorted(a[order], b, "left"), np.searchsorted(a[order], b, "right")
    n = hi - lo
    if not n.any():
        return []
    j = np.repeat(np.arange(b.size), n)
    i = order[np.repeat(lo, n) + np.arange(j.size) - np.repeat(np.cumsum(n) - n, n)]
    along = np.lexsort((i, j - i))
    i, j = i[along], j[along]
    new = np.concatenate(([True], (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)))
    first = np.flatnonzero(new)
    length = np.diff(np.concatenate((first, [i.size]))) + least - 1
    heap = [(-m, p, q) for m, p, q in zip(length.tolist(), i[first].tolist(), j[first].tolist(), strict=True)]
    heapify(heap)
    used_item, used_doc = np.zeros(item.size, bool), np.zeros(doc.size, bool)
    out = []
    while heap:
        m, p, q = heappop(heap)
        m = -m
        taken = used_item[p : p + m] | used_doc[q : q + m]
        if not taken.any():
            used_item[p : p + m] = used_doc[q : q + m] = True
            out.append((p, q, m))
            if used_item.all():
                break
            continue
        free = np.flatnonzero(np.diff(np.concatenate(([False], ~taken, [False])).astype(np.int8)))
        for start, stop in free.reshape(-1, 2).tolist():
            if stop - start >= least:
                heappush(heap, (start - stop, p + start, q + start))
    return out


def _items(benchmark: DataFrame, seed: int, short: bool) -> DataFrame:
    """item (a number of its own), item_id, words, seeds of each different row that has a seed; with short, all words of a shorter one."""
    lengths = range(1, seed + 1) if short else [seed]
    rows = _words(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), {"item_id": "long"}, seed, lengths, None, whole=True)
    return rows.dropDuplicates(["item_id", "words"]).withColumn("item", F.monotonically_increasing_id())


def _words(rows: DataFrame, keys: dict[str, str], seed: int, lengths: Iterable[int], known, whole: bool = False) -> DataFrame:
    """keys (name: type), words, seeds of the rows with a seed of one of the lengths.

    With known (a broadcast sorted array), only seeds in it; with whole, those of fewer than `seed` words only if they are the whole text.
    """
    lengths = list(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column("text")):
                w = words_and_characters(s, alphanumeric())
                text = owner(w.first, w.hash.size)
                size = np.diff(w.first)
                owners, found = [], []
                for k in lengths:
                    g = grams(w.hash, k)
                    own = text[: g.size]
                    ok = text[k - 1 :] == own
                    if whole and k < seed:
                        ok &= size[own] == k
                    if known is not None:
                        at = np.searchsorted(known.value, g)
                        at[at == known.value.size] = 0
                        ok &= known.value[at] == g
                    owners.append(own[ok])
                    found.append(g[ok])
                own, found = np.concatenate(owners), np.concatenate(found)
                order = np.argsort(own, kind="stable")
                own, found = own[order], found[order]
                which = np.unique(own)
                taken = pa.array(which + s.first)
                seeds = [np.unique(found[a:b]).view(np.int64) for a, b in _groups(own)]
                words = [w.hash[w.first[k] : w.first[k + 1]].view(np.int64) for k in which.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(taken) for c in keys), pa.array(words, pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64()))],
                    [*keys, "words", "seeds"],
                )

    return rows.mapInArrow(lean(run), "".join(f"{c} {t}, " for c, t in keys.items()) + "words array<long>, seeds array<long>")


def _groups(sorted_numbers: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.concatenate(([True], sorted_numbers[1:] != sorted_numbers[:-1], [True]))) if sorted_numbers.size else np.zeros(0, int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def leaks(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, most_seeds: int = MOST_SEEDS, short: bool = False) -> DataFrame:
    """doc_id, row (its key), item, item_id, coverage of each document and item that share a seed and reach the coverage."""
    items = stored(_items(benchmark, seed, short), "items")
    lengths = [seed]
    if short:
        lengths += [r["n"] for r in items.select(F.size("words").alias("n")).filter(F.col("n") < seed).distinct().collect()]  # under seed
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), "text")
    seeds = items.select(F.explode("seeds").alias("seed")).distinct()
    known = None
    count = seeds.count()
    if 0 < count <= most_seeds:
        known = docs.sparkSession.sparkContext.broadcast(np.sort(seeds.toArrow().column("seed").to_numpy().view(U64)))
    found = stored(_words(rows, {"doc_id": "long", "row": "binary"}, seed, lengths, known), "seeded")
    shared = found.select("doc_id", "row", F.explode("seeds").alias("seed")).join(items.select("item", F.explode("seeds").alias("seed")), "seed")
    pairs = shared.select("row", "item").distinct()

    names = ["doc_id", "row", "item", "item_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for d, i in zip(batch.column("words"), batch.column("item_words"), strict=True):
                item = i.values.to_numpy().view(U64)
                out.append(sum(t[2] for t in tiles(d.values.to_numpy().view(U64), item, min(seed, item.size))) / item.size)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.float64())], [*names, "coverage"])

    tiled = (
        pairs.join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
        .join(found.select("row", "doc_id", "words").dropDuplicates(["row"]), "row")
        .select(*names, "words", "item_words")
        .mapInArrow(lean(run), "doc_id long, row binary, item long, item_id long, coverage double")
    )
    return tiled.filter(F.col("coverage") >= coverage)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, contaminated, n_items, item_id, coverage of every row; the last two are of the best covered item, or null."""
    per_row = (
        leaks(docs, benchmark, **options)
        .groupBy("row")
        .agg(
            (F.count_distinct("item_id") + F.count_distinct(F.when(F.col("item_id").isNull(), F.col("item")))).alias("n_items"),
            F.max_by(F.struct("item_id", "coverage"), F.struct("coverage", -F.col("item_id"))).alias("best"),
        )
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"))
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.col("best.item_id").alias("item_id"),
        F.col("best.coverage").alias("coverage"),
    )
