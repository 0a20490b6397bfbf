"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

A text is lower-cased, every run of non-letters is one blank. Each language has counts of 4-character strings; lower
orders use continuation counts. The language of lowest cross-entropy per character wins; ties go to the first name.
Null texts and texts without a letter are `und` with score 0 and rejected. Rows are scored one by one, so repeated
rows get equal results; doc_id and other columns are never looked at beyond being passed on. With no labelled row
at all, every text is `und`. Texts of any length are scored whole, in pieces of bounded size.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.llm.arrays import U64, lean, mix

ORDER = 4
#: At most about so many labelled texts of each language are learned from, chosen by a hash of doc_id.
PER_LANGUAGE = 20_000
#: About so many different strings of each length in all languages are kept, besides the ends of longer ones and single
#: characters: 16 bytes each and 8 for each language. Beyond that each language keeps its most frequent ones.
MAX_STRINGS = 1_000_000
#: Rejected: cross-entropy beyond the mean of calibration texts by so many standard deviations, and twice that mean.
DEVIATIONS = 8.0
UND = "und"
_BLANK = 32
_PIECE = 1 << 18


@cache
def symbols() -> np.ndarray:
    """For each code point its lower-case letter in 16 bits, or blank; letters beyond 16 bits share one symbol."""
    out = np.full(0x110000, _BLANK, np.uint16)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if unicodedata.category(ch)[0] in "LM":
            low = ch.lower()
            out[c] = min(ord(low[0]) if len(low) == 1 else c, 0xFFFF)
    out[0] = _BLANK
    return out


@cache
def letters() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    for c in range(0x110000):
        out[c] = unicodedata.category(chr(c))[0] == "L"
    return out


def strings(texts: list[str], skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed 4-character strings, number of the text of each, whether each text has a letter).

    skip: how many symbols at the start of each text are context and have no string of their own.
    """
    length = np.array([len(t) for t in texts], np.int64)
    codes = _codes("".join(texts))
    text = np.repeat(np.arange(length.size), length)
    has = np.zeros(length.size, bool)
    has[text[letters()[codes]]] = True
    new = np.ones(codes.size, bool)
    new[1:] = text[1:] != text[:-1]
    s, keep = _kept(codes, new)
    s, text = s[keep].astype(U64), text[keep]
    first = np.searchsorted(text, text)
    place = np.arange(s.size) - first
    packed = s.copy()
    for k in range(1, ORDER):
        before = np.full(s.size, _BLANK, U64)
        before[k:] = s[:-k] if k < s.size else before[k:]
        before[place < k] = _BLANK
        packed |= before << U64(16 * k)
    if skip is not None and skip.any():
        own = place >= skip[text]
        packed, text = packed[own], text[own]
    return packed, text, has


class HashArray:
    """Sorted hashes of 64-bit keys, with the place where each leading bit pattern starts."""

    def __init__(self, keys: np.ndarray):
        h = mix(keys.astype(U64))
        self.order = np.argsort(h)
        self.hash = np.concatenate((h[self.order], [U64(0xFFFFFFFFFFFFFFFF)]))
        self.bits = max(1, int(keys.size).bit_length())
        self.start = np.searchsorted(self.hash[:-1] >> U64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=U64)).astype(np.int32)
        self.steps = int(np.diff(self.start).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        h = mix(keys)
        top = (h >> U64(64 - self.bits)).astype(np.int64)
        at = self.start[top]
        out = np.where(self.hash[at] == h, at, -1)
        todo = np.flatnonzero((out < 0) & (self.start[top + 1] - at > 1))
        for k in range(1, self.steps):
            if not todo.size:
                break
            place = np.minimum(at[todo] + k, self.hash.size - 1)
            hit = self.hash[place] == h[todo]
            out[todo[hit]] = place[hit]
            todo = todo[~hit]
        return out


@dataclass
class Model:
    """For each order n: hashes of the strings seen in any language and their log2 probabilities; of the contexts, log2 weights."""

    names: list[str]
    grams: list[HashArray]
    logp: list[np.ndarray]
    contexts: list[HashArray]
    weight: list[np.ndarray]
    unseen: np.ndarray
    limit: np.ndarray
    sharpness: float

    def scores(self, packed: np.ndarray) -> np.ndarray:
        """log2 probabilities of each string's last character after the others: one column a language."""
        n = ORDER
        out = np.zeros((packed.size, len(self.names)))
        todo = np.arange(packed.size)
        while todo.size and n:
            key = packed[todo] & _mask(n)
            at = self.grams[n - 1].find(key)
            hit = at >= 0
            out[todo[hit]] += self.logp[n - 1][at[hit]]
            todo, key = todo[~hit], key[~hit]
            if n > 1 and todo.size:
                at = self.contexts[n - 1].find(key >> U64(16))
                seen = at >= 0
                out[todo[seen]] += self.weight[n - 1][at[seen]]
            n -= 1
        out[todo] += self.unseen
        return out

    def entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bits a character in each language, characters, whether there is a letter) of each text."""
        total, count, has = np.zeros((len(texts), len(self.names))), np.zeros(len(texts)), np.zeros(len(texts), bool)
        for part, number, skip in _pieces(texts):
            packed, text, letter = strings(part, skip)
            if packed.size:
                s = self.scores(packed)
                first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                np.add.at(total, number[text[first]], np.add.reduceat(s, first, axis=0))
                np.add.at(count, number, np.bincount(text, minlength=len(part)))
            np.logical_or.at(has, number, letter)
        return -total / np.maximum(count, 1)[:, None], count, has

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, bits a character, rejected) of each text."""
        bits, count, has = self.entropy(texts)
        best = bits.argmin(axis=1)
        at = np.arange(len(texts))
        odds = np.exp2(-(bits - bits[at, best][:, None]) * np.minimum(np.maximum(count, 1), self.sharpness)[:, None])
        score = np.where(has, 1 / odds.sum(axis=1), 0.0)
        low = np.where(has, bits[at, best], 0.0)
        far = low > self.limit[best] + DEVIATIONS / np.sqrt(np.maximum(count, 1))
        return [self.names[b] if h else UND for b, h in zip(best, has, strict=True)], score, low, ~has | far


def _mask(n: int) -> U64:
    return U64((1 << (16 * n)) - 1)


def _kept(codes: np.ndarray, new: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each code point, and which stay: letters, and of a run of others the first after a letter."""
    s = symbols()[codes]
    keep = s != _BLANK
    after = s[:-1] != _BLANK
    keep[1:] |= after if new is None else after & ~new[1:]
    return s, keep


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _context(text: str) -> str:
    """The characters of the last ORDER - 1 symbols of a text: what the next character's probability depends on."""
    size = 64
    while True:
        tail = text[-size:]
        at = np.flatnonzero(_kept(_codes(tail))[1])[1 - ORDER :]
        if at.size == ORDER - 1 or size >= len(text):
            return "".join(tail[i] for i in at)
        size *= 64


def _pieces(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Texts in groups of bounded length, the number of each one's text and how many of its symbols only are context.

    A long text comes in pieces that begin with the last symbols of the piece before, so cuts change nothing.
    """
    part, number, skip, size = [], [], [], 0
    for i, t in enumerate(texts):
        context = ""
        for at in range(0, max(1, len(t)), _PIECE):
            piece = context + t[at : at + _PIECE]
            part.append(piece)
            number.append(i)
            skip.append(int(_kept(_codes(context))[1].sum()))
            size += len(piece)
            if at + _PIECE < len(t):
                context = _context(piece)
            if size >= _PIECE:
                yield part, np.array(number), np.array(skip)
                part, number, skip, size = [], [], [], 0
    if part:
        yield part, np.array(number), np.array(skip)


def _discount(one: int, two: int) -> float:
    """Kneser-Ney discount from the numbers of strings that stand once and twice."""
    return min(0.95, max(0.1, one / (one + 2 * two))) if one + two else 0.5


def smooth(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Interpolated Kneser-Ney models from the packed strings and counts of each language."""
    names = sorted(counts)
    tables: list[list[tuple]] = [[] for _ in range(ORDER)]
    for name in names:
        keys, c = counts[name]
        order = np.argsort(keys)
        keys, c = keys[order].astype(U64), c[order].astype(float)
        for n in range(ORDER, 0, -1):
            first = np.unique(keys >> U64(16), return_inverse=True)[1] if n > 1 else np.zeros(keys.size, np.int64)
            tables[n - 1].append((keys, c, np.bincount(first, c)[first], _discount((c == 1).sum(), (c == 2).sum())))
            if n > 1:  # continuation counts: in how many longer strings a string ends
                keys, c = np.unique(keys & _mask(n - 1), return_counts=True)
                c = c.astype(float)
    return interpolate(names, tables)


def interpolate(names: list[str], tables: list[list[tuple]]) -> Model:
    """The model from (kept strings, counts, count of all strings of the same context, discount) of each order and language.

    What a context's strings that are not kept would have weighs the lower order.
    """
    width = len(names)
    alphabet = max(2, np.unique(np.concatenate([t[0] for t in tables[0]])).size)
    floor = 1.0 / (4 * alphabet)
    unseen = np.full(width, np.log2(floor))
    grams, logp, contexts, weights = [], [], [], []
    lower: tuple[np.ndarray, np.ndarray] | None = None
    for n in range(1, ORDER + 1):
        union = np.unique(np.concatenate([t[0] for t in tables[n - 1]]))
        before = np.unique(union >> U64(16)) if n > 1 else np.zeros(1, U64)
        p = np.zeros((union.size, width))
        weight = np.zeros((before.size, width))
        own = np.searchsorted(before, union >> U64(16)) if n > 1 else np.zeros(union.size, np.int64)
        for k, (keys, c, whole, d) in enumerate(tables[n - 1]):
            at = np.searchsorted(union, keys)
            total = np.zeros(before.size)
            total[own[at]] = whole
            rest = total - np.bincount(own[at], c, before.size)
            kinds = np.bincount(own[at], minlength=before.size)
            w = np.where(total > 0, (d * kinds + rest) / np.maximum(total, 1e-300), 1.0)
            weight[:, k] = w
            p[at, k] = np.maximum(c - d, 0) / total[own[at]]
            shorter = np.full(union.size, floor) if lower is None else lower[1][np.searchsorted(lower[0], union & _mask(n - 1)), k]
            p[:, k] += w[own] * shorter
        lower = (union, p)
        for keys, values, hashes, logs in ((union, p, grams, logp), (before, weight, contexts, weights)):
            table = HashArray(keys)
            hashes.append(table)
            logs.append(np.log2(np.maximum(values, 1e-12))[table.order].astype(np.float32))
    return Model(names, grams, logp, contexts, weights, unseen + weights[0][0], np.full(width, np.inf), 20.0)


def learn(labelled: DataFrame, max_strings: int) -> Model | None:
    """A model from (lang, text). Strings are counted map-side first; discounts and continuation counts come from all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for name in sorted(set(langs)):
                texts = batch.column("text").filter(pa.array(langs == name)).to_pylist()
                for part, _, skip in _pieces(texts):
                    keys, c = np.unique(strings(part, skip)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * keys.size, pa.string()), pa.array(keys.view(np.int64)), pa.array(c)], ["lang", "key", "c"])

    counts = labelled.mapInArrow(lean(run), "lang string, key long, c long").groupBy("lang", "key").agg(F.sum("c").alias("c"))
    counts = counts.persist()
    try:
        if counts.count() > max_strings:
            return _learn_kept(counts, max_strings)
        found = {name: columns[:2] for name, columns in _by_language(counts.toArrow(), ["key", "c"]).items()}
        return smooth(found) if found else None
    finally:
        counts.unpersist()


def _by_language(table: pa.Table, columns: list[str]) -> dict[str, list[np.ndarray]]:
    langs = np.array(table.column("lang").to_pylist(), object)
    values = [table.column(c).to_numpy() for c in columns]
    values[0] = values[0].view(U64)
    return {name: [v[langs == name] for v in values] for name in sorted(set(langs))}


def _level(sizes: list[int], most: int) -> int:
    """The greatest bound on each size with which all add up to at most `most`."""
    left = most
    for i, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - i) > left:
            return max(1, left // (len(sizes) - i))
        left -= size
    return max(sizes)


def _learn_kept(counts: DataFrame, max_strings: int) -> Model:
    """The same with the most frequent strings of each language only; of the least frequent kept, a share by their hash."""
    tables: list[list[tuple]] = [[] for _ in range(ORDER)]
    level, ends = counts, None
    for n in range(ORDER, 0, -1):
        often = F.least("c", F.lit(4096))
        kinds: dict[str, dict[int, int]] = {}
        for row in level.groupBy("lang", often.alias("c")).agg(F.count("*").alias("n")).collect():  # 4096 rows a language at most
            kinds.setdefault(row["lang"], {})[row["c"]] = row["n"]
        kept = level
        if n > 1:  # single characters all stay, so no language goes
            bound = _level([sum(k.values()) for k in kinds.values()], max_strings)
            cuts = []
            for name, k in kinds.items():
                room, least, share = bound, 0, 0.0
                for c in sorted(k, reverse=True):
                    if k[c] > room:
                        least, share = c, room / k[c]
                        break
                    room -= k[c]
                cuts.append((name, least, share))
            cut = level.sparkSession.createDataFrame(cuts, "lang string, least long, share double")
            draw = F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < F.col("share") * 1_000_000
            kept = level.join(F.broadcast(cut), "lang").filter((often > F.col("least")) | ((often == F.col("least")) & draw)).select("lang", "key", "c")
            if ends is not None:
                kept = kept.unionByName(level.join(ends, ["lang", "key"], "left_semi")).distinct()
        before = F.shiftrightunsigned("key", 16).alias("before")
        whole = level.groupBy("lang", before).agg(F.sum("c").alias("whole"))
        found = _by_language(kept.withColumn("before", before).join(whole, ["lang", "before"]).select("lang", "key", "c", "whole").toArrow(), ["key", "c", "whole"])
        for name in sorted(kinds):
            keys, c, total = found.get(name, [np.zeros(0, U64), np.zeros(0), np.zeros(0)])
            order = np.argsort(keys)
            d = _discount(kinds[name].get(1, 0), kinds[name].get(2, 0))
            tables[n - 1].append((keys[order], c[order].astype(float), total[order].astype(float), d))
        if n > 1:
            end = F.col("key").bitwiseAND(F.lit(int(_mask(n - 1)))).alias("key")
            ends = kept.select("lang", end).distinct()
            level = level.groupBy("lang", end).agg(F.count("*").alias("c"))
    return interpolate(sorted(kinds), tables)


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, max_strings: int = MAX_STRINGS) -> Model | None:
    """A model from (doc_id, text, lang). A tenth of the sample sets the rejection limits and the score's sharpness."""
    usable = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang", F.abs(F.xxhash64(F.col("doc_id").cast("string")) % 1_000_000).alias("draw"))
    sizes = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").groupBy("lang").count()
    # A language's share of the draws gives about per_language texts; the list of languages is small.
    sample = usable.join(F.broadcast(sizes.select("lang", (F.lit(1e6 * per_language) / F.col("count")).alias("most"))), "lang").filter(F.col("draw") < F.col("most"))
    most, rest = sample.filter("draw % 10 != 7"), sample.filter("draw % 10 = 7")
    model = learn(most.select("lang", "text"), max_strings) or learn(sample.select("lang", "text"), max_strings)
    if model is None:
        return None
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            bits, count, has = m.entropy(batch.column("text").to_pylist())
            names = np.array(batch.column("lang").to_pylist(), object)
            ok = has & (count >= 50) & np.isin(names.astype(str), m.names)
            own = np.array([m.names.index(x) for x in names[ok]], np.int64)
            b = bits[ok]
            out = [names[ok].tolist(), b[np.arange(own.size), own], np.sort(b - b[np.arange(own.size), own][:, None], axis=1)[:, :2].sum(axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1]), pa.array(out[2])], ["lang", "bits", "margin"])

    stats = rest.select("lang", "text").mapInArrow(lean(measure), "lang string, bits double, margin double")
    for row in stats.groupBy("lang").agg(F.avg("bits").alias("mean"), F.coalesce(F.stddev("bits"), F.lit(0.0)).alias("sd")).collect():
        model.limit[model.names.index(row["lang"])] = row["mean"] + max(DEVIATIONS * row["sd"], row["mean"])
    shared.unpersist()
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of docs and lang_pred, score, bits_per_char, rejected. Clashing columns of docs give way."""
    added = ["lang_pred", "score", "bits_per_char", "rejected"]
    docs = docs.drop(*added)
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UND), "score": F.lit(0.0), "bits_per_char": F.lit(0.0), "rejected": F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                name, score, bits, out = m.predict([t or "" for t in part.column("text").to_pylist()])
                found = [pa.array(name, pa.string()), pa.array(score), pa.array(bits), pa.array(out)]
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, *added])

    schema = T.StructType(list(docs.schema.fields))
    for name, kind in zip(added, (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()), strict=True):
        schema.add(name, kind)
    return docs.mapInArrow(lean(run), schema)
