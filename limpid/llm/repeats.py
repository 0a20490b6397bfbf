"""Removes every byte that a string of 200 bytes covers which also starts elsewhere, by bucket-pointer refinement.

The suffixes that matter start windows of 200 bytes. Each window is put into the bucket of its least 50-gram (leftmost
of equals), which equal windows share at the same offset; neighbouring windows of one bucket entry are a run. Buckets
with one entry end there. The others are refined by the identifiers of longer strings from earlier to later offsets:
first of whole runs (equal runs settle all their windows at once, and later steps reuse that), then of single windows,
only in buckets where some run stayed alone, and with one representative of equal runs.

Runs are shuffled once, by bucket, and sorted by bucket and run. One pass over them drops lone buckets, settles equal runs
and keeps what is open. Buckets and runs that hold more than some 1/2000 of all are found before by a sketch. Heavy buckets
are dealt by bucket and run, and heavy runs by a salt as well, so no task holds one whole. Heavy buckets are never lone. If
a salt leaves an equal run alone, its windows still meet those of the others there.

A row stands for itself: rows with the same doc_id and text are copies of each other; a digest of 128 bits stands for the
text. Null text counts as empty; doc_id
may be null or repeated. Texts shorter than a window lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.llm.arrays import U64, Rolling, lean, long_array, mix, text_slices
from limpid.llm.storage import stored
from limpid.operators.keys import heavy_numbers

WINDOW = 200
GRAM = 50
#: A bucket with more different runs than this is refined by counting windows in Spark instead of within a task.
HOT = 20_000
#: A run that many rows share is dealt over so many groups.
SALTS = 256
#: Bytes hashed at once: a worker's arrays take some hundred times as much, beside those of the executor's other workers.
_PIECE = 1 << 18


def _pieces(column: pa.Array, window: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, place in that text, bytes, offsets); a longer text comes in pieces that share window - 1 bytes."""
    for s in text_slices(column, _PIECE):
        if s.data.size <= 2 * _PIECE or s.offsets.size > 2:
            yield s.first, 0, s.data, s.offsets
            continue
        for at in range(0, max(1, s.data.size - window + 1), _PIECE):
            part = s.data[at : at + _PIECE + window - 1]
            yield s.first, at, part, np.array([0, part.size])


def runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, bucket, run identifier) of each run of windows with one least gram; none crosses texts."""
    none = np.zeros(0, np.int64)
    if data.size < window:
        return none, none, none.view(U64), none.view(U64)
    rolling = Rolling(data, seed=3)
    bits = U64(max(21, int(data.size).bit_length()))
    place = np.arange(data.size - gram + 1, dtype=U64)
    least = (rolling.every(gram) >> bits << bits) | place
    span, n = window - gram + 1, data.size - window + 1
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[span - width : span - width + n])
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    valid = np.flatnonzero(np.arange(n) + window <= ends)
    if not valid.size:
        return none, none, none.view(U64), none.view(U64)
    at = (least[valid] & ((U64(1) << bits) - U64(1))).astype(np.int64)
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [valid.size])) - 1
    lo, hi, at = valid[first], valid[last], at[first]
    return lo, hi, rolling(at, at + gram), rolling(lo, hi + window)


def find_runs(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, base, data, offsets in _pieces(batch.column("text"), window):
                lo, hi, bucket, name = runs(data, offsets, window, gram)
                text = np.searchsorted(offsets, lo, "right") - 1
                owner = pa.array(row + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(owner),
                        batch.column("mark").take(owner),
                        pa.array((lo - offsets[text] + base).astype(np.int32)),
                        pa.array((hi - lo + 1).astype(np.int32)),
                        long_array(bucket),
                        long_array(name),
                    ],
                    ["doc_id", "mark", "lo", "n", "bucket", "run"],
                )

    return rows.mapInArrow(lean(run), "doc_id long, mark binary, lo int, n int, bucket long, run long")


#: What becomes of a run: settled by an equal one, or open, alone or not, in a bucket for one task or for Spark.
SETTLED, OPEN, OPEN_ALONE, HOT_OPEN, HOT_ALONE = range(5)


class _Judge:
    """One pass over runs in order of (bucket, run). Holds one row, and of the bucket it is in at most `hot` rows."""

    def __init__(self, heavy: list[int], hot: int):
        self.heavy, self.hot = np.array(sorted(heavy), np.int64), hot
        self.last, self.same = None, False  # a row whose successor isn't known, and whether it equals its predecessor
        self.open: list[pa.RecordBatch] = []  # representatives of the runs of the bucket that may go on
        self.bucket, self.count, self.alone = None, 0, False

    def _kinds(self, batch: pa.RecordBatch, kind: np.ndarray) -> pa.RecordBatch:
        names = ["doc_id", "mark", "lo", "n", "bucket"]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(kind.astype(np.int8))], [*names, "kind"])

    def _close(self) -> Iterator[pa.RecordBatch]:
        """Ends the open bucket: its runs matter if one is alone among others. Beyond `hot` runs they have gone out already."""
        if self.count <= self.hot and self.count > 1 and self.alone:
            yield from self.open
        self.open, self.bucket, self.count, self.alone = [], None, 0, False

    def _bucket(self, bucket: int, part: pa.RecordBatch, alone: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Some representatives of one bucket, which may go on."""
        if bucket != self.bucket:
            yield from self._close()
            self.bucket = bucket
        before = self.count
        self.count += part.num_rows
        self.alone |= bool(alone.any())
        if self.count > self.hot:
            if before <= self.hot:
                for held in self.open:
                    yield self._kinds(held, held.column("kind").to_numpy() + (HOT_OPEN - OPEN))
                self.open = []
            yield self._kinds(part, np.where(alone, HOT_ALONE, HOT_OPEN))
        else:
            self.open.append(self._kinds(part, np.where(alone, OPEN_ALONE, OPEN)))

    def feed(self, batch: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        """The next rows, or None at the end."""
        rows = [b for b in (self.last, batch) if b is not None and b.num_rows]
        if rows:
            rows = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            bucket, run = (rows.column(c).to_numpy() for c in ("bucket", "run"))
            following = np.append((bucket[1:] == bucket[:-1]) & (run[1:] == run[:-1]), False)
            previous = np.append(self.same, following[:-1])
            n = rows.num_rows - (batch is not None)
            self.last, self.same = (rows.slice(n), bool(previous[n])) if n < rows.num_rows else (None, False)
            following, previous = following[:n], previous[:n]
            equal = np.flatnonzero(following | previous)
            if equal.size:
                yield self._kinds(rows.take(pa.array(equal)), np.full(equal.size, SETTLED))
            first = np.flatnonzero(~previous)
            if first.size:
                yield from self._representatives(rows.take(pa.array(first)), ~following[first])
        if batch is None:
            yield from self._close()

    def _representatives(self, rows: pa.RecordBatch, alone: np.ndarray) -> Iterator[pa.RecordBatch]:
        bucket = rows.column("bucket").to_numpy()
        heavy = np.isin(bucket, self.heavy)
        if heavy.any():
            yield self._kinds(rows.filter(pa.array(heavy)), np.where(alone[heavy], HOT_ALONE, HOT_OPEN))
            rows, bucket, alone = rows.filter(pa.array(~heavy)), bucket[~heavy], alone[~heavy]
        if not bucket.size:
            return
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(start, bucket.size))
        # The first bucket may have begun before, and the last may go on; those between are judged together.
        yield from self._bucket(int(bucket[0]), rows.slice(0, size[0]), alone[: size[0]])
        if start.size == 1:
            return
        yield from self._close()
        if start.size > 2:
            of = np.repeat(np.arange(start.size), size)
            some = np.logical_or.reduceat(alone, start)
            wanted = (size > 1) & some
            wanted[[0, -1]] = False
            keep = np.flatnonzero(wanted[of])
            if keep.size:
                crowd = size[of[keep]] > self.hot
                kind = np.where(alone[keep], OPEN_ALONE, OPEN) + crowd * (HOT_OPEN - OPEN)
                yield self._kinds(rows.take(pa.array(keep)), kind)
        yield from self._bucket(int(bucket[-1]), rows.slice(start[-1]), alone[start[-1] :])


def judge_runs(found: DataFrame, heavy: list[int], hot: int) -> DataFrame:
    """doc_id, mark, lo, n, bucket, kind of the runs that are settled, and of one of each that stay open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(heavy, hot)
        for batch in batches:
            yield from judge.feed(batch)
        yield from judge.feed(None)

    salted = F.when(F.col("run").isin(heavy), F.xxhash64("run", F.pmod(F.xxhash64("mark", "lo"), F.lit(SALTS)))).otherwise(F.col("run"))
    crowded = F.when(F.col("bucket").isin(heavy), salted) if heavy else F.lit(None).cast("long")
    dealt = found.withColumn("_part", crowded).repartition("bucket", "_part").drop("_part")
    return dealt.sortWithinPartitions("bucket", "run").mapInArrow(lean(run), "doc_id long, mark binary, lo int, n int, bucket long, kind byte")


def cut_strips(wanted: DataFrame, window: int) -> DataFrame:
    """The bytes of wanted runs. wanted: doc_id, mark, text, runs (array of lo, n, bucket, alone); other columns don't matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "mark", "lo", "bucket", "alone", "strip"]
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column("text")[k].as_py().encode()
                items = batch.column("runs")[k].values
                lo, n = items.field("lo"), items.field("n")
                strips = [text[a : a + m - 1 + window] for a, m in zip(lo.to_pylist(), n.to_pylist(), strict=True)]
                same = pa.array(np.full(len(items), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(same), batch.column("mark").take(same), lo, items.field("bucket"), items.field("alone"), pa.array(strips, pa.binary())],
                    names,
                )

    return wanted.mapInArrow(lean(run), "doc_id long, mark binary, lo int, bucket long, alone boolean, strip binary")


def _windows(batch: pa.RecordBatch, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place in the strip, identifier) of every window of the strips."""
    for s in text_slices(batch.column("strip")):
        n = np.diff(s.offsets) - window + 1
        row = np.repeat(np.arange(n.size), n)
        place = np.arange(row.size) - np.repeat(np.cumsum(n) - n, n)
        start = s.offsets[row] + place
        yield row + s.first, place, Rolling(s.data, seed=3)(start, start + window)


def _found(batch: pa.RecordBatch, row: np.ndarray, place: np.ndarray, window: int) -> pa.RecordBatch:
    """Byte ranges of neighbouring windows; rows and places in order."""
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1))) if row.size else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [row.size])) - 1 if first.size else first
    at = batch.column("lo").to_numpy()[row[first]]
    own = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(own), batch.column("mark").take(own), pa.array((at + place[first]).astype(np.int32)), pa.array((at + place[last] + window).astype(np.int32))],
        ["doc_id", "mark", "start", "stop"],
    )


_RANGES = "doc_id long, mark binary, start int, stop int"


def refine_in_tasks(strips: DataFrame, window: int) -> DataFrame:
    """Ranges of the lone runs' windows that another run of the bucket has. A task sorts the buckets it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(part: pa.RecordBatch) -> pa.RecordBatch:
            bucket = mix(part.column("bucket").to_numpy().view(U64))
            row, place, name = (np.concatenate(x) for x in zip(*_windows(part, window), strict=True))
            name = mix(name + bucket[row])
            order = np.sort(name)
            twice = np.unique(order[1:][order[1:] == order[:-1]])
            at = np.searchsorted(twice, name)
            at[at == twice.size] = 0
            hit = (twice[at] == name) if twice.size else np.zeros(name.size, bool)
            hit &= part.column("alone").to_numpy(zero_copy_only=False)[row]
            return _found(part, row[hit], place[hit], window)

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            bucket = batch.column("bucket").to_numpy()
            edges = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [bucket.size]))
            done, k = 0, 1
            while k < edges.size - 1:  # whole buckets, some thousand strips at a time
                if edges[k + 1] - done > 4096 or k == edges.size - 2:
                    yield solve(batch.slice(done, edges[k] - done))
                    done = edges[k]
                k += 1
            held = batch.slice(done)
        if held is not None and held.num_rows:
            yield solve(held)

    return strips.sortWithinPartitions("bucket").mapInArrow(lean(run), _RANGES)


def refine_by_count(strips: DataFrame, window: int) -> DataFrame:
    """The same for buckets of any size: windows are counted by identifier, map-side first, and joined back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, place, name in _windows(batch, window):
                own = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(x).take(own) for x in ("doc_id", "mark", "bucket", "alone")]
                    + [pa.array((batch.column("lo").to_numpy()[row] + place).astype(np.int32)), long_array(name)],
                    ["doc_id", "mark", "bucket", "alone", "start", "name"],
                )

    windows = strips.mapInArrow(lean(run), "doc_id long, mark binary, bucket long, alone boolean, start int, name long")
    twice = windows.groupBy("bucket", "name").agg(F.count("*").alias("c")).filter("c > 1").select("bucket", "name")
    hit = windows.filter("alone").join(twice, ["bucket", "name"])
    return hit.select("doc_id", "mark", "start", (F.col("start") + window).cast("int").alias("stop"))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, keep_text: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; with keep_text also kept_text, the rest as text.

    Where removal cuts a character of several bytes, kept_text lacks its remaining bytes; the digest has them. Columns
    of docs named in carry come along.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram must fit into the window")
    # A cast to the type it has would be another expression for each use of the rows, and so another exchange.
    number = F.col("doc_id") if docs.schema["doc_id"].dataType == T.LongType() else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(number, F.coalesce("text", F.lit("")).alias("text"), *([F.struct(*carry).alias("carry")] if carry else []))
    rows = rows.withColumn("mark", F.unhex(F.md5("text")))
    owner = ["doc_id", "mark"]
    found = find_runs(rows.filter(F.octet_length("text") >= window), window, gram)
    heavy = heavy_numbers(found.select(F.explode(F.array("bucket", "run")).alias("name")), "name")
    judged = stored(judge_runs(found, heavy, hot), "runs")
    kind = F.col("kind")
    settled = judged.filter(kind == SETTLED).select(
        *owner, F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + window).cast("int").alias("stop")
    )
    # Heavy buckets were judged in parts: only together it shows whether a run is alone in them and how many there are.
    crowds = judged.filter(kind >= HOT_OPEN)
    sizes = crowds.groupBy("bucket").agg(F.count(F.lit(1)).alias("runs_in"), F.max(kind).alias("most")).filter(F.col("most") == HOT_ALONE)
    alone = kind.isin(OPEN_ALONE, HOT_ALONE).alias("alone")
    few = judged.filter(kind.isin(OPEN, OPEN_ALONE)).select(*owner, "lo", "n", "bucket", alone, F.lit(False).alias("hot"))
    many = crowds.join(sizes, "bucket").select(*owner, "lo", "n", "bucket", alone, (F.col("runs_in") > hot).alias("hot"))
    wanted = few.unionByName(many).groupBy(*owner).agg(F.collect_list(F.struct("lo", "n", "bucket", "alone", "hot")).alias("runs"))
    # The one shuffle of the texts: an exchange of its own, with the same columns for all uses. Structs are equal where both
    # lack the doc_id.
    held = rows.select(F.struct(*owner).alias("row"), "text", *(["carry"] if carry else [])).repartition("row")
    wanted = stored(wanted.select(F.struct(*owner).alias("row"), "runs"), "wanted")

    def strips(crowded: bool) -> DataFrame:
        own = wanted.select("row", F.filter("runs", lambda r: r["hot"] == F.lit(crowded)).alias("runs")).filter("size(runs) > 0")
        # Repeated rows cut the same strips twice. That is harmless: a lone run's row is never repeated.
        return cut_strips(held.join(own, "row").select("row.*", "text", "runs", *(["carry"] if carry else [])), window)

    ranges = settled.unionByName(refine_in_tasks(strips(False).repartition("bucket"), window))
    if not sizes.filter(F.col("runs_in") > hot).isEmpty():
        # Dealt out anew, so that strips are cut once for both uses, and not in the same tasks as their windows.
        ranges = ranges.unionByName(refine_by_count(strips(True).repartition("mark", "lo"), window))
    # Copies of a row settle the same ranges; a set holds them once.
    ranges = ranges.groupBy(F.struct(*owner).alias("row")).agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_out = [*carry, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * keep_text
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                out = []
                for text, spans in zip(part.column("text").to_pylist(), part.column("ranges"), strict=True):
                    raw = text.encode()
                    spans = spans.values
                    rest, n_spans = raw, 0
                    if spans is not None and len(spans):
                        starts, stops = spans.field("start").to_numpy(), spans.field("stop").to_numpy()
                        order = np.argsort(starts, kind="stable")
                        starts, stops = starts[order], np.maximum.accumulate(stops[order])
                        new = np.concatenate(([True], starts[1:] > stops[:-1]))
                        first = np.flatnonzero(new)
                        ends = stops[np.concatenate((first[1:], [stops.size])) - 1].tolist()
                        n_spans = first.size
                        begins = starts[first].tolist()
                        rest = b"".join([raw[a:b] for a, b in zip([0, *ends], [*begins, len(raw)], strict=True)])
                    row = [len(raw), len(raw) - len(rest), n_spans, hashlib.sha256(rest).hexdigest()]
                    out.append(row + [rest.decode(errors="ignore")] * keep_text)
                columns = list(zip(*out, strict=True)) or [()] * (4 + keep_text)
                types = [pa.int64()] * 3 + [pa.string()] * (1 + keep_text)
                yield pa.RecordBatch.from_arrays(
                    part.columns[2:] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names_out
                )

    joined = held.join(ranges, "row", "left")
    joined = joined.select("text", "ranges", *[F.col(f"carry.`{c}`") for c in carry], F.col("row.doc_id").alias("doc_id"))
    schema = T.StructType([docs.schema[c] for c in carry])
    for name in ("doc_id", "n_bytes", "n_removed", "n_spans"):
        schema.add(name, "long")
    for name in ["kept_sha256"] + ["kept_text"] * keep_text:
        schema.add(name, "string")
    return joined.mapInArrow(lean(cut), schema)
