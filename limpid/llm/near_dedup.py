"""Near duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidate edges.

Words are runs of bytes other than ASCII white space, A-Z as a-z. A text's set is its distinct 5-word shingles; with
fewer words the whole sequence is the one shingle. Null, empty and blank texts have an empty set and no links. Rows
without doc_id are left out of links and come back with component_id null and kept true. Repeated rows and
copies share a class, so they cost no pairs. Columns other than doc_id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.arrays import GOLDEN, U64, lean, long_array, mix, not_space, shingles, text_slices, words_of
from limpid.llm.components import components
from limpid.llm.storage import stored

WIDTH = 5
PERCENT = 75
BANDS, ROWS = 56, 6
ROUNDS = 2


@cache
def detours(bins: int) -> np.ndarray:
    """For each bin an order of all bins, the same for every text: where an empty bin looks for a value."""
    order = mix(np.arange(bins * bins, dtype=U64) * GOLDEN + U64(11)).reshape(bins, bins)
    return np.argsort(order, axis=1).astype(np.int32)


def signature(found: np.ndarray, bins: int) -> np.ndarray:
    """Least hash of each bin of a sorted set; an empty bin takes that of the first filled bin on its own detour."""
    place = ((found >> U64(32)) * U64(bins)) >> U64(32)
    place = place.astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    out, filled = np.zeros(bins, U64), np.zeros(bins, bool)
    out[place[first]] = found[first]
    filled[place[first]] = True
    empty = np.flatnonzero(~filled)
    seen = 16
    while empty.size:
        way = detours(bins)[empty, :seen]
        usable = filled[way]
        hit = usable.argmax(axis=1)
        ok = usable[np.arange(empty.size), hit]
        out[empty[ok]] = out[way[ok, hit[ok]]]
        empty, seen = empty[~ok], seen * 8
    return out


def band_keys(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = mix(signature(found, bands * rows)).reshape(bands, rows)
    h = np.arange(1, bands + 1, dtype=U64) * GOLDEN
    for i in range(rows):
        h = mix(h * U64(0xD6E8FEB86659FD93) + parts[:, i])
    return h


def set_keys(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a whole set."""
    return int(mix(found ^ U64(1)).sum(dtype=U64)), int(mix(found ^ GOLDEN).sum(dtype=U64))


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for s in text_slices(column):
        yield from shingles(words_of(s, not_space()), width)


def fingerprints(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = WIDTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, key1, key2 (of the whole set, 128 bits), bands (null if the set is empty) and the columns in carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                n, keys, found = [], [], []
                for x in _sets(part.column("text"), width):
                    n.append(x.size)
                    keys.append(set_keys(x))
                    found.append(band_keys(x, bands, rows).view(np.int64) if x.size else None)
                keys = np.array(keys, U64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), long_array(keys[:, 0]), long_array(keys[:, 1]), pa.array(found, pa.list_(pa.int64())), *(part.column(c) for c in carry)],
                    ["doc_id", "n_shingles", "key1", "key2", "bands", *carry],
                )

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return rows_in.mapInArrow(lean(run), f"doc_id long, n_shingles long, key1 long, key2 long, bands array<long>{kinds}")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """The pairs (a, b) of ids whose full sets have 100 * intersection >= percent * union. texts: (id, text); copies count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ok = []
                for x, y in zip(_sets(part.column("text_a"), width), _sets(part.column("text_b"), width), strict=True):
                    both = np.intersect1d(x, y, assume_unique=True).size
                    ok.append(100 * both >= percent * (x.size + y.size - both) and both > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    own = texts.join(wanted, "id", "left_semi").withColumn("mark", F.unhex(F.md5("text"))).dropDuplicates(["id", "mark"])
    joined = pairs.join(own.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        own.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(lean(run), "a long, b long")


def rare_pairs(mixed: DataFrame, texts: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Pairs (a, b) of the ids in mixed (id, component) that may be alike, of different components.

    Exact: sets this alike share one of their rarest shingles, ordered by how many of these sets have them; a set of n
    needs its n - ceil(percent/100 n) + 1 rarest. Passages that many texts share are thus no candidates. Sets are ranked
    one by one: copies of a row count once, and an id may stand for several texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = list(_sets(part.column("text"), width))
                keys = np.array([set_keys(x) for x in sets], U64).reshape(-1, 2)
                sets = [x.view(np.int64) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), long_array(keys[:, 0]), long_array(keys[:, 1]), pa.array(sets, pa.list_(pa.int64()))], ["id", "key1", "key2", "found"]
                )

    own = ["id", "key1", "key2"]
    sets = texts.join(mixed.select("id"), "id", "left_semi").mapInArrow(lean(run), "id long, key1 long, key2 long, found array<long>").dropDuplicates(own)
    each = sets.select(*own, F.size("found").alias("n"), F.explode("found").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("often")).filter("often > 1")
    each = each.join(often, "shingle", "left")
    rank = F.row_number().over(Window.partitionBy(*own).orderBy(F.coalesce("often", F.lit(1)), "shingle"))
    rare = each.withColumn("rank", rank).filter((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1) & F.col("often").isNotNull())
    rare = rare.join(mixed, "id").select("shingle", "id", "n", "component", "rank")
    other = rare.select("shingle", F.struct("id", "n", "component", "rank").alias("hub"))
    # From the first shingle in common on, enough must be left in both for the intersection that the pair needs.
    close = F.expr(
        f"id < hub.id AND component != hub.component AND 100 * least(n, hub.n) >= {int(percent)} * greatest(n, hub.n)"
        f" AND {100 + int(percent)} * least(n - rank + 1, hub.n - hub.rank + 1) >= {int(percent)} * (n + hub.n)"
    )
    return rare.join(other, "shingle").filter(close).select(F.col("id").alias("a"), F.col("hub.id").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT, width: int = WIDTH, rounds: int = ROUNDS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row, and the columns of docs in carry.

    Equal sets are one class, represented by its least doc_id. In each bucket of each band the members are paired with
    one hub only, and confirmed on the full sets; a later round takes members that are not yet in the hub's component.
    Members of one bucket that are in different components after the rounds are compared through their rarest shingles,
    so no link is lost to the stars, while a group of similar texts never makes all its pairs.
    """
    found = stored(fingerprints(docs, bands, rows, width, carry), "fingerprints")
    usable = found.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("key1", "key2").agg(F.min("doc_id").alias("id"))
    buckets = usable.select("doc_id", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("bucket")
    named = usable.select("doc_id", F.col("n_shingles").alias("n"), "key1", "key2").join(classes, ["key1", "key2"]).select("doc_id", "n", "id")
    members = stored(buckets.join(shared, "bucket").join(named, "doc_id").select("bucket", "id", "n").distinct(), "members")
    # Rows may repeat a doc_id with other texts: an id then stands for all of them.
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    links = members.sparkSession.createDataFrame([], "a long, b long")
    tested, component = links, None
    close = F.expr(f"component != hub.component AND 100 * least(n, hub.n) >= {int(percent)} * greatest(n, hub.n)")
    for turn in range(rounds + 1):
        now = members if component is None else members.join(component, "id", "left")
        now = now.withColumn("component", F.coalesce("component", "id") if component is not None else F.col("id"))
        mixed = now.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("bucket")
        now = stored(now.join(mixed, "bucket", "left_semi"), "mixed")
        if turn < rounds:
            hubs = now.groupBy("bucket").agg(F.min(F.struct("id", "n", "component")).alias("hub"))
            pairs = now.join(hubs, "bucket").filter(close).select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b"))
        else:
            pairs = rare_pairs(stored(now.select("id", "component").distinct(), "rest"), texts, percent, width)
        if turn == 0:  # one hub for each member settles most of them
            pairs = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        else:
            pairs = pairs.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            continue
        links = links.unionByName(stored(confirmed(pairs, texts, percent, width), "links"))
        tested = tested.unionByName(pairs)
        component = stored(components(links), "components")
    out = found.drop("bands").join(classes, ["key1", "key2"], "left")
    if component is not None:
        out = out.join(component, "id", "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("long"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *carry)
