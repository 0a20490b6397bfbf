"""k-means over integer vectors by subvector dictionaries.

Components become integers, floor(scale * x), so distances, sums and means are exact and a result doesn't depend on how rows
are dealt out. Vectors are stored in chunks. In each chunk the dimensions are cut into blocks, and each block is replaced by
codes into the dictionary of its distinct subvectors, without loss: dictionary and codes give the chunk back. A round reads
the chunks, computes the squared distance of each dictionary entry to each centroid once, and a vector's distances are the
sums of those of its codes. The new centroids come from how often each code fell to each cluster, times its subvector.

Dictionaries are those of a chunk and not of the table: one for all rows grows with the data, so each round would have to
send or join it, once for each block of each vector. A chunk's never holds more entries than the chunk has vectors. Blocks
start as one dimension each; neighbours are merged while that saves work, that is while the entries to measure grow by less
than the additions that a shorter row of codes saves. Copies of one vector thus become one entry of one block.

A round gives the driver k * dims sums and k counts, whatever the number of vectors. Chunks are a table in the shared
folder; a lost executor costs its tasks only.

Hard rows: vectors that are null, of another length, or that hold a null, NaN or infinity are left out. Repeated rows count
each. The first centroids are the kept vectors with the least digests of their id; rows that share an id, or have none
(last), stand in order of their components. Fewer than k vectors make fewer clusters; an empty table gives an empty one.
Components beyond 2^27 after scaling raise, as a distance might not fit a long. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.names import named
from limpid.llm.storage import stored

CHUNK = 1 << 14
MOST = 1 << 27

_BLOCK = "struct<first: int, width: int, entries: array<long>, codes: array<int>>"
_CHUNK = f"ids array<long>, blocks array<{_BLOCK}>"


def integers(vector: Column, dims: int, scale: int) -> Column:
    """floor(scale * x) of each component as longs; null for a vector that is left out."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda v: F.floor(v * scale))
    small = F.forall(x, lambda v: F.abs(v * scale) <= MOST)
    beyond = F.raise_error(F.lit(f"a component times {scale} is beyond {MOST}")).cast("array<long>")
    return F.when((F.size(vector) == dims) & finite, F.when(small, whole).otherwise(beyond))


def encode(rows: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks (first dimension, width, entries, codes): rows[:, first : first + width] is entries[codes]."""
    n, dims = rows.shape
    blocks = []
    for d in range(dims):
        entries, codes = np.unique(rows[:, d], return_inverse=True)
        blocks.append((d, 1, entries[:, None], codes))
    while True:
        merged, i = [], 0
        while i < len(blocks):
            if i + 1 < len(blocks):
                (first, width, left, a), (_, more, right, b) = blocks[i], blocks[i + 1]
                both, codes = np.unique(a * len(right) + b, return_inverse=True)
                if both.size * (width + more) < n + left.size + right.size:
                    entries = np.hstack((left[both // len(right)], right[both % len(right)]))
                    merged.append((first, width + more, entries, codes))
                    i += 2
                    continue
            merged.append(blocks[i])
            i += 1
        if len(merged) == len(blocks):
            return blocks
        blocks = merged


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([p.size for p in parts])))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))


def _packed(ids: list[pa.Array], rows: list[np.ndarray]) -> pa.RecordBatch:
    """One chunk as one row of ids and blocks."""
    blocks = encode(np.concatenate(rows))
    cells = pa.StructArray.from_arrays(
        [
            pa.array([b[0] for b in blocks], pa.int32()),
            pa.array([b[1] for b in blocks], pa.int32()),
            _lists([b[2].ravel() for b in blocks]),
            _lists([b[3].astype(np.int32) for b in blocks]),
        ],
        names=["first", "width", "entries", "codes"],
    )
    chunk = pa.concat_arrays(ids)
    whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.RecordBatch.from_arrays([whole(chunk), whole(cells)], names=["ids", "blocks"])


def chunks(vectors: DataFrame, size: int = CHUNK) -> DataFrame:
    """(ids, blocks) of (id, v): up to `size` vectors of a task in a row, dictionary-encoded."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, held = [], [], 0
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else None
            at = 0
            while at < batch.num_rows:
                n = min(size - held, batch.num_rows - at)
                ids.append(batch.column(0).slice(at, n))
                rows.append(v[at : at + n])
                at, held = at + n, held + n
                if held == size:
                    yield _packed(ids, rows)
                    ids, rows, held = [], [], 0
        if held:
            yield _packed(ids, rows)

    return vectors.mapInArrow(pack, _CHUNK)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[tuple[int, int, np.ndarray, np.ndarray]]]]:
    """The ids and blocks of each chunk of a batch."""
    for i in range(batch.num_rows):
        cells = batch.column(1)[i].values
        first, width = (cells.field(c).to_pylist() for c in ("first", "width"))
        entries, codes = cells.field("entries"), cells.field("codes")
        blocks = [
            (first[j], width[j], entries[j].values.to_numpy().reshape(-1, width[j]), codes[j].values.to_numpy()) for j in range(len(first))
        ]
        yield batch.column(0)[i].values, blocks


def nearest(blocks: list[tuple[int, int, np.ndarray, np.ndarray]], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector of a chunk, the smaller number on a tie, and the squared distance."""
    total = 0
    for first, width, entries, codes in blocks:
        partial = ((entries[:, None, :] - centroids[None, :, first : first + width]) ** 2).sum(axis=2)
        total = total + partial[codes]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(cluster.size), cluster]


def _moved(chunked: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of the mean of each cluster's vectors; empty clusters keep theirs."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, blocks in _blocks(batch):
                cluster, _ = nearest(blocks, centroids)
                # One column more than dimensions: the number of vectors.
                out = np.zeros((k, dims + 1), np.int64)
                out[:, dims] = np.bincount(cluster, minlength=k)
                for first, width, entries, codes in blocks:
                    held = np.bincount(codes * k + cluster, minlength=len(entries) * k).reshape(-1, k)
                    out[:, first : first + width] = held.T @ entries
                c, d = np.indices(out.shape).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(out.ravel())], names=["c", "d", "s"])

    # A table's sums pass the range of longs beyond 2^36 vectors of the largest components.
    summed = chunked.mapInArrow(sums, "c long, d long, s long").groupBy("c", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {(r.c, r.d): int(r.s) for r in summed.collect()}  # k * (dims + 1) numbers
    new = centroids.copy()
    for c in range(k):
        if n := found.get((c, dims)):
            new[c] = [found[c, d] // n for d in range(dims)]
    return new


def cluster_vectors(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    chunk: int = CHUNK,
) -> DataFrame:
    """id, cluster, distance (squared), cluster_inertia and inertia (sums of distances), centroid_sha256.

    The first centroids are the k vectors with the least sha256 of `seed:id`. A sum of distances beyond a long is null.
    """
    x = vectors.select(named(id_column).alias("id"), integers(named(vector_column), dims, scale).alias("v")).filter("v IS NOT NULL")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = x.select("v").orderBy(F.asc_nulls_last(digest), "v").limit(k).collect()  # k vectors
    kind = vectors.select(named(id_column)).schema[0].dataType.simpleString()
    spark = vectors.sparkSession
    if not chosen:
        columns = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"`{id_column}` {kind}, {columns}")
    centroids = np.array([r.v for r in chosen], np.int64)
    chunked = stored(chunks(x, chunk), "chunks")
    for _ in range(rounds):
        centroids = _moved(chunked, centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, blocks in _blocks(batch):
                cluster, distance = nearest(blocks, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    placed = stored(chunked.mapInArrow(place, f"id {kind}, cluster int, distance long"), "placed")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # at most k
    total = sum(int(r.s) for r in sums)
    fits = lambda n: n if n < 1 << 63 else None
    of_cluster = spark.createDataFrame(
        [(r.cluster, fits(int(r.s)), fits(total), sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return placed.join(F.broadcast(of_cluster), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
