"""Byte-level BPE with a rank file: overlapping chunks are split into pre-tokens in parallel, stitched where their
boundaries meet again, and the pieces encoded; decoding joins raw bytes.

Null and empty texts have no ids. Rows stand for themselves: repeated rows and rows that share a doc_id, or have none, give
a row each, and equal texts give equal results. A very long text is split in parallel and joined in one task that holds it
and its ids, in time in proportion to it. Names of special tokens in a text are text. An empty table gives an empty one;
columns other than doc_id and text are left out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from itertools import accumulate
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.arrays import lean

CHUNK = 1 << 15
OVERLAP = 1 << 11
KEEP = 1 << 19


class Codec:
    """Ranks and pattern of one vocabulary. Ids are the ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self._known: dict[str, bytes] = {}
        parts = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            parts[rank] = token
        self._length = np.array([len(p) for p in parts], np.int64)
        self._start = np.cumsum(self._length) - self._length
        self._bytes = np.frombuffer(b"".join(parts), np.uint8)

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def ends(self, text: str) -> list[int]:
        """Where the pre-tokens of a text end."""
        return list(accumulate(map(len, self.split(text))))

    def merge(self, piece: bytes) -> list[int]:
        """Joins the neighbours of lowest rank, leftmost first, until no pair is in the vocabulary."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        if len(parts) > 64:
            return self._merge_long(parts)
        none = 1 << 60
        rank = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while rank and (best := min(rank)) < none:
            i = rank.index(best)
            parts[i : i + 2] = [joined := parts[i] + parts[i + 1]]
            del rank[i]
            if i:
                rank[i - 1] = ranks.get(parts[i - 1] + joined, none)
            if i < len(rank):
                rank[i] = ranks.get(joined + parts[i + 1], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, parts: list[bytes]) -> list[int]:
        """The same with a heap over linked neighbours, n log n in the length."""
        from heapq import heapify, heappop, heappush

        ranks, n = self.ranks, len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, joined = heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or parts[i] + parts[j] != joined:
                continue
            parts[i], alive[j], after[i] = joined, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := ranks.get(parts[a] + parts[b])) is not None:
                    heappush(heap, (r, a, parts[a] + parts[b]))
        return [ranks[p] for p, a in zip(parts, alive, strict=True) if a]

    def encode(self, pieces: list[str]) -> bytes:
        """Ids of pre-tokens, little-endian unsigned 32-bit."""
        known = self._known
        if len(known) > KEEP:
            known.clear()
        for p in set(pieces).difference(known):
            known[p] = pack(f"<{len(ids := self.merge(p.encode()))}I", *ids)
        return b"".join([known[p] for p in pieces])

    def forget(self) -> None:
        self._known = {}

    def decode(self, ids: np.ndarray) -> bytes:
        """The raw bytes of the ids, one after another."""
        length = self._length[ids]
        ends = np.cumsum(length)
        if not ends.size:
            return b""
        return self._bytes[np.repeat(self._start[ids] - ends + length, length) + np.arange(ends[-1])].tobytes()


@cache
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file (base64 token, rank), read once in each worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
    return Codec(ranks, pattern)


@contextmanager
def task_codec(path: str, pattern: str) -> Iterator[Codec]:
    """The codec for one task. Workers live on for other stages, so the pieces it got to know go with the task."""
    c = codec(path, pattern)
    try:
        yield c
    finally:
        c.forget()


def stitch(ends: list[list[int]], starts: list[int], texts: list[str], split) -> list[str]:
    """Pre-tokens of the whole text from those of its overlapping chunks.

    A boundary of the true split is one of the next chunk's too from the first place where both have one, as a match
    depends on the text from there on alone. A chunk's last pre-tokens, which its end may have cut, don't count. Where
    no boundary is common in an overlap, the chunk's text goes on with the next one's and is split again.
    """
    pieces: list[str] = []
    at, text, own, origin = 0, texts[0], ends[0], starts[0]
    k, more = 1, 1
    while True:
        own = [e + origin for e in own]
        if k == len(texts):
            bounds = [e for e in own if e > at]
            return pieces + [text[a - origin : b - origin] for a, b in zip([at, *bounds], bounds, strict=False)]
        safe = origin + len(text) - 1
        sure = own[:-2] if len(own) > 2 else []
        other = {starts[k]} | {e + starts[k] for e in ends[k]}
        meet = next((e for e in sure if e >= max(at, starts[k]) and e in other and e < safe), None)
        if meet is None:
            # Each time twice as many chunks are added, so splitting anew costs no more than a few times the text.
            for k in range(k, min(k + more, len(texts))):  # noqa: B020
                text += texts[k][origin + len(text) - starts[k] :]
            text, origin = text[at - origin :], at
            own = split(text)
            k, more = k + 1, 2 * more
            continue
        bounds = [e for e in own if at < e <= meet]
        pieces += [text[a - origin : b - origin] for a, b in zip([at, *bounds], bounds, strict=False)]
        at, text, own, origin = meet, texts[k], ends[k], starts[k]
        k, more = k + 1, 1


def _row(c: Codec, pieces: list[str]) -> tuple[int, str, str]:
    ids = c.encode(pieces)
    back = c.decode(np.frombuffer(ids, "<u4"))
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()


def encode_documents(
    docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, keep_ids: bool = False
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row; with keep_ids also ids (binary) of each text.

    Texts of up to `chunk` characters are one chunk, encoded where they are read. Longer ones become overlapping chunk
    rows, dealt over all tasks; only their pre-token boundaries decide where chunks join. Equal long texts are encoded
    once.
    """
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than the chunk")
    ids_type = ", ids binary" if keep_ids else ""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.length("text") > chunk

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_codec(path, pattern) as c:
            for batch in batches:
                texts = batch.column("text")
                for at in range(0, max(len(texts), 1), 1024):
                    found, ids = [], []
                    for t in texts.slice(at, 1024).to_pylist():
                        pieces = c.split(t)
                        found.append(_row(c, pieces))
                        if keep_ids:
                            ids.append(c.encode(pieces))
                    n, a, b = zip(*found, strict=True) if found else ((), (), ())
                    columns = [batch.column("doc_id").slice(at, 1024), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * keep_ids, names + ["ids"] * keep_ids)

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ids_type
    whole = rows.filter(~is_long).mapInArrow(lean(short), "doc_id long, " + schema)

    def boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            ends = [c.ends(t) for t in batch.column("part").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(x) for x in ("key", "place", "part")] + [pa.array(ends, pa.list_(pa.int32()))], ["key", "place", "part", "ends"]
            )

    def join_chunks(key: tuple[str], parts: pd.DataFrame) -> pd.DataFrame:
        c = codec(path, pattern)
        parts = parts.drop_duplicates("place").sort_values("place")
        pieces = stitch([list(map(int, e)) for e in parts["ends"]], parts["place"].tolist(), parts["part"].tolist(), c.ends)
        row = [key[0], *_row(c, pieces)]
        return pd.DataFrame([row + [c.encode(pieces)] * keep_ids], columns=["key", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)

    keyed = rows.filter(is_long).withColumn("key", F.sha2("text", 256))

    def overlapping(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                text = text.as_py()
                places = range(0, len(text) - overlap, chunk - overlap)
                for at in range(0, len(places), 64):
                    some = places[at : at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()] * len(some)), pa.array(some, pa.int32()), pa.array([text[p : p + chunk] for p in some], pa.string())],
                        ["key", "place", "part"],
                    )

    parts = (
        keyed.select("key", "text")
        .mapInArrow(lean(overlapping), "key string, place int, part string")
        .dropDuplicates(["key", "place"])
        .repartition("key", "place")
    )
    stitched = parts.mapInArrow(lean(boundaries), "key string, place int, part string, ends array<int>").groupBy("key").applyInPandas(join_chunks, "key string, " + schema)
    return whole.unionByName(keyed.select("doc_id", "key").join(stitched, "key").drop("key"))
