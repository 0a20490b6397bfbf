"""Token ids in files of compressed blocks: a context-mixing range coder over order-0 to order-2 predictions.

Documents are written in ascending order of doc_id. A segment is some documents' ids cut into blocks of equal length; each
block starts from fresh statistics and carries its length and CRC-32, so any block is decoded without others and damage
is found. An id is coded in one step, from one distribution: how often the block has each id (order 0, sent with the block), widened
where the id that last followed the one before it (order 1) or the two before it (order 2) predicts one. How the three are
mixed is learned for each block, by how often the two predictions held lately and whether they agree. A block is cut into
streams that share its predictions and are coded side by side with numpy, as are the blocks of a segment. All arithmetic is
in integers, the same on every machine.

The tokenizers library encodes. Where its file says that texts are split as byte-level BPE does it, no piece runs on from a character
that is not white space to one that is; so a text's words, each with the white space before it, have the same ids anywhere.
Arrow finds the different words of some megabytes of text, and a word that came up lately is not encoded again. Texts with names
of added tokens, and all texts of other files, are encoded whole.

Null text counts as empty: one end id. Rows that share a doc_id stand next to each other in order of text; rows without
doc_id come first. Extra columns don't matter. An empty table makes no segment.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.sources.shared import new_folder

END = 2
# On 3.2 million ids of the test documents blocks of this length take 0.98 bytes an id; zlib over all, two bytes an id, needs 1.05.
BLOCK = 1 << 17
LANES = 32
#: Ids of a stream. More streams a block are wider steps for numpy, at six bytes each.
STREAM = 512
MAGIC = b"TIB2"
_BITS = 16  # ids are below 2^16
_S2 = 1 << 15
_STATES = 32
_ONE = 1 << 16
_WORD, _LOW = np.uint64(32), np.uint64((1 << 32) - 1)
_LEAST, _SHIFT = np.uint64(1 << 32), np.uint64(24)


class _Alphabet:
    """The order-0 prediction of each block: its ids by falling count, as ranks, with frequencies that add up to 2^16."""

    def __init__(self, ids: list[np.ndarray], counts: list[np.ndarray]):
        self.stride = max(map(len, ids)) + 1
        self.cum = np.full((len(ids), self.stride), _ONE, np.int64)
        self.ids = np.zeros((len(ids), self.stride), np.uint16)
        self.slot = np.zeros((len(ids), _ONE), np.uint16)
        for k, (i, c) in enumerate(zip(ids, counts, strict=True)):
            share = 1 + c * (_ONE - i.size) // int(c.sum())
            share[0] += _ONE - int(share.sum())
            self.cum[k, 0], self.cum[k, 1 : i.size + 1] = 0, np.cumsum(share)
            self.ids[k, : i.size] = i
            self.slot[k] = np.repeat(np.arange(i.size, dtype=np.uint16), share)
        self.cum, self.slot = self.cum.reshape(-1), self.slot.reshape(-1)


class _Writer:
    """A range coder for each lane: 64-bit bounds, whose leading 32 bits go out when the range is below 2^32."""

    def __init__(self, lanes: int, steps: int):
        self.room = steps + 2
        self.lo, self.r = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.out, self.size = np.zeros(lanes * self.room, "<u4"), np.zeros(lanes, np.int64)

    def code(self, c: np.ndarray, f: np.ndarray) -> None:
        lo, r = self.lo[: c.size], self.r[: c.size]
        t = r >> _SHIFT
        lo += t * c.view(np.uint64)
        np.multiply(t, f.view(np.uint64), out=r)
        todo = np.flatnonzero(r < _LEAST)
        if todo.size:
            low, at = lo[todo], self.size[todo]
            self.out[todo * self.room + at] = low >> _WORD
            self.size[todo] = at + 1
            r[todo] = np.minimum(r[todo], _LEAST - (low & _LOW)) << _WORD
            lo[todo] = low << _WORD

    def payloads(self) -> tuple[np.ndarray, np.ndarray]:
        """Words of the lanes, one after another, and how many each has."""
        lanes = np.arange(self.size.size)
        self.out[lanes * self.room + self.size] = (self.lo + _LOW) >> _WORD
        size = self.size + 1
        return self.out.reshape(-1, self.room), size


class _Reader:
    def __init__(self, words: np.ndarray, size: np.ndarray):
        lanes, self.room = size.size, int(size.max()) + 3
        data = np.zeros((lanes, self.room), np.uint64)
        data[np.arange(self.room) < size[:, None]] = words
        self.lo, self.r = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.d = data[:, 0] << _WORD | data[:, 1]
        self.data, self.at = data.reshape(-1), np.full(lanes, 2, np.int64)

    def value(self, n: int) -> np.ndarray:
        self.t = self.r[:n] >> _SHIFT
        v = self.d[:n] // self.t
        return np.minimum(v, np.uint64((1 << 24) - 1), out=v).view(np.int64)

    def code(self, c: np.ndarray, f: np.ndarray) -> None:
        lo, r, d = self.lo[: c.size], self.r[: c.size], self.d[: c.size]
        step = self.t * c.view(np.uint64)
        lo += step
        d -= step
        np.multiply(self.t, f.view(np.uint64), out=r)
        todo = np.flatnonzero(r < _LEAST)
        if todo.size:
            low, at = lo[todo], self.at[todo]
            d[todo] = d[todo] << _WORD | self.data[todo * self.room + np.minimum(at, self.room - 1)]
            self.at[todo] = at + 1
            r[todo] = np.minimum(r[todo], _LEAST - (low & _LOW)) << _WORD
            lo[todo] = low << _WORD


class _Contexts:
    """The order-1 and order-2 predictions: in each block, the rank that last followed the rank or the two ranks before.

    A cell holds step << 18 | trust << 16 | rank. The streams of a block share its cells; where some write one in the same step, the
    greatest stays.
    """

    def __init__(self, block: np.ndarray, stride: int):
        blocks = int(block.max()) + 1
        self.one, self.two = np.zeros(blocks * stride, np.int64), np.zeros(blocks * _S2, np.int64)
        self.base1, self.base2, self.base = block * stride, block * _S2, block * _STATES
        self.a = self.b = np.zeros(block.size, np.int64)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both guesses and the state that weights are learned for: how far each is trusted and whether they agree."""
        a, b = self.a[:n], self.b[:n]
        self.at1 = a + self.base1[:n]
        at2 = a * 40503
        at2 += b
        at2 &= _S2 - 1
        at2 += self.base2[:n]
        self.at2 = at2
        p, q = self.one[self.at1], self.two[at2]
        self.trust1, self.trust2 = p >> 16 & 3, q >> 16 & 3
        p &= _ONE - 1
        q &= _ONE - 1
        state = self.trust1 << 2
        state += self.trust2
        state += (p == q) * 16
        state += self.base[:n]
        return p, q, state

    def learn(self, step: int, x: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        cell = x + (step + 1 << 18)
        for table, at, trust, hit in ((self.one, self.at1, self.trust1, hit1), (self.two, self.at2, self.trust2, hit2)):
            trust += 1
            np.minimum(trust, 3, out=trust)
            trust *= hit
            trust <<= 16
            trust += cell
            np.maximum.at(table, at, trust)
        self.a, self.b = x, self.a


def _weights(hits: np.ndarray) -> np.ndarray:
    """Shares of 256 for the order-2 and the order-1 prediction in a state, from how often there none, order 1, order 2 and both held."""
    return (np.stack([hits[2] + hits[3], hits[1]]) * 254 // np.maximum(hits.sum(0), 1)).astype(np.uint8)


class _Mix:
    """One interval for each rank: w0 times its order-0 interval, widened by w1 and w2 where order 1 and order 2 predict it."""

    def __init__(self, weights: np.ndarray, alphabet: _Alphabet, block: np.ndarray):
        w2, w1 = weights.astype(np.int64)
        self.w0, self.w1, self.w2 = 256 - w1 - w2, w1 << 16, w2 << 16
        self.over = -(-(1 << 32) // self.w0)  # v * over >> 32 is v // w0 for v below 2^24
        self.cum, self.slot = alphabet.cum, alphabet.slot
        self.base, self.slots = block * alphabet.stride, block * _ONE

    def interval(self, x, p, q, w0, w1, w2, hit1, hit2):
        at = x + self.base[: x.size]
        c = self.cum[at]
        at += 1
        f = self.cum[at]
        f -= c
        f *= w0
        f += w1 * hit1
        f += w2 * hit2
        c *= w0
        c += w1 * (p < x)
        c += w2 * (q < x)
        return c, f

    def rank(self, v, p, q, w0, w1, w2, state):
        """The rank whose interval holds v: the widenings below v are taken off, the lower one first."""
        n = v.size
        base = self.base[:n]
        both = w1 + w2
        first = np.where(p < q, w1, w2)
        both -= first
        for guess, width in ((np.minimum(p, q), first), (np.maximum(p, q), both)):
            guess += base
            off = self.cum[guess]
            off *= w0
            np.subtract(v, off, out=off)
            np.maximum(off, 0, out=off)
            np.minimum(off, width, out=off)
            v -= off
        v *= self.over[state]
        v >>= 32
        v += self.slots[:n]
        return self.slot[v].astype(np.int64)


def _streams(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block and length of each stream, longest first, and their numbers in order of the ids."""
    count = -(-sizes // STREAM)
    block = np.repeat(np.arange(sizes.size), count)
    length = np.full(block.size, STREAM)
    length[np.cumsum(count) - 1] = sizes - STREAM * (count - 1)
    order = np.argsort(-length, kind="stable")
    return block[order], length[order], order


def _active(length: np.ndarray) -> np.ndarray:
    """How many streams have an id at each step."""
    return np.searchsorted(-length, -np.arange(int(length[0])), "left")


def encode_blocks(ids: np.ndarray, block: int = BLOCK, lanes: int = LANES) -> list[bytes]:
    """Blocks of `block` ids, the last maybe shorter: magic, number of ids, CRC-32 of them, order-0 counts and weights, streams."""
    if ids.size and int(ids.max()) >> _BITS:
        raise ValueError(f"ids must be below 2^{_BITS}")
    out: list[bytes] = []
    for at in range(0, ids.size, block * lanes):
        part = ids[at : at + block * lanes]
        out += _encode([part[k : k + block] for k in range(0, part.size, block)])
    return out


def _encode(parts: list[np.ndarray]) -> list[bytes]:
    heads, names, counts = [], [], []
    block, length, order = _streams(np.array([p.size for p in parts]))
    table = np.zeros((order.size, STREAM), np.uint16)
    row = 0
    for part in parts:
        count = np.bincount(part, minlength=_ONE)
        seen = np.flatnonzero(count)
        heads.append((seen, count[seen]))
        by = np.argsort(-count[seen], kind="stable")
        names.append(seen[by])
        counts.append(count[seen[by]])
        rank = np.zeros(_ONE, np.uint16)
        rank[names[-1]] = np.arange(seen.size)
        n = -(-part.size // STREAM)
        table[row : row + n].reshape(-1)[: part.size] = rank[part]
        row += n
    steps = np.ascontiguousarray(table[order].T)  # a row for each step
    active = _active(length)
    alphabet, contexts = _Alphabet(names, counts), _Contexts(block, max(map(len, names)) + 1)
    guess1, guess2 = np.zeros((len(active), order.size), np.uint16), np.zeros((len(active), order.size), np.uint16)
    states = np.zeros((len(active), order.size), np.int32)
    hits = np.zeros(len(parts) * _STATES * 4, np.int64)
    for step, n in enumerate(active.tolist()):
        x = steps[step, :n].astype(np.int64)
        p, q, state = contexts.predict(n)
        hit1, hit2 = p == x, q == x
        contexts.learn(step, x, hit1, hit2)
        guess1[step, :n], guess2[step, :n], states[step, :n] = p, q, state
        state <<= 2
        state += hit1
        state += hit2 * 2
        hits += np.bincount(state, minlength=hits.size)
    weights = _weights(hits.reshape(-1, 4).T)
    mix, coder = _Mix(weights, alphabet, block), _Writer(order.size, len(active))
    for step, n in enumerate(active.tolist()):
        x, p, q, state = (m[step, :n].astype(np.int64) for m in (steps, guess1, guess2, states))
        coder.code(*mix.interval(x, p, q, mix.w0[state], mix.w1[state], mix.w2[state], p == x, q == x))
    words, size = coder.payloads()
    back = np.argsort(order)
    words, size = words[back], size[back]
    out, row = [], 0
    for k, (part, (seen, count)) in enumerate(zip(parts, heads, strict=True)):
        n = -(-part.size // STREAM)
        own = size[row : row + n]
        gaps = np.diff(seen, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T
        often = count.astype("<u4").view(np.uint8).reshape(-1, 4).T
        head = zlib.compress(gaps.tobytes() + often.tobytes() + weights[:, k * _STATES : (k + 1) * _STATES].tobytes(), 1)
        body = own.astype("<u2").tobytes() + words[row : row + n][np.arange(words.shape[1]) < own[:, None]].tobytes()
        out.append(MAGIC + struct.pack("<III", part.size, zlib.crc32(part.astype("<u4").tobytes()), len(head)) + head + body)
        row += n
    return out


def decode_blocks(blocks: list[bytes], lanes: int = LANES) -> np.ndarray:
    """The ids of some blocks, one after another. Raises ValueError if a block is damaged."""
    out: list[np.ndarray] = []
    for at in range(0, len(blocks), lanes):
        try:
            out += _decode(blocks[at : at + lanes])
        except (IndexError, OverflowError, ZeroDivisionError, struct.error, zlib.error) as e:
            raise ValueError("a block is damaged") from e
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def _decode(blocks: list[bytes]) -> list[np.ndarray]:
    sizes, crcs, names, counts, weights, each, words = [], [], [], [], [], [], []
    for b in blocks:
        if b[:4] != MAGIC or len(b) < 16:
            raise ValueError("not a block of ids")
        n, crc, long = struct.unpack("<III", b[4:16])
        head = np.frombuffer(zlib.decompress(b[16 : 16 + long]), np.uint8)
        kinds, streams = (head.size - 2 * _STATES) // 6, -(-n // STREAM)
        seen = np.cumsum(np.ascontiguousarray(head[: 2 * kinds].reshape(2, -1).T).view("<u2").astype(np.int64).reshape(-1))
        count = np.ascontiguousarray(head[2 * kinds : 6 * kinds].reshape(4, -1).T).view("<u4").astype(np.int64).reshape(-1)
        size = np.frombuffer(b, "<u2", streams, 16 + long).astype(np.int64)
        word = np.frombuffer(b, "<u4", -1, 16 + long + 2 * streams)
        if not kinds or seen[-1] >= _ONE or int(count.sum()) != n or int(size.sum()) != word.size:
            raise ValueError("a block is damaged")
        by = np.argsort(-count, kind="stable")
        sizes.append(n)
        crcs.append(crc)
        names.append(seen[by])
        counts.append(count[by])
        weights.append(head[6 * kinds :].reshape(2, -1))
        each.append(size)
        words.append(word)
    block, length, order = _streams(np.array(sizes))
    size = np.concatenate(each)
    starts = np.cumsum(size) - size
    at = np.repeat(starts[order] - (np.cumsum(size[order]) - size[order]), size[order]) + np.arange(int(size.sum()))
    coder = _Reader(np.concatenate(words)[at], size[order])
    alphabet = _Alphabet(names, counts)
    contexts, mix = _Contexts(block, alphabet.stride), _Mix(np.concatenate(weights, 1), alphabet, block)
    active = _active(length)
    steps = np.zeros((len(active), order.size), np.uint16)
    for step, n in enumerate(active.tolist()):
        p, q, state = contexts.predict(n)
        w0, w1, w2 = mix.w0[state], mix.w1[state], mix.w2[state]
        x = mix.rank(coder.value(n), p, q, w0, w1, w2, state)
        hit1, hit2 = p == x, q == x
        coder.code(*mix.interval(x, p, q, w0, w1, w2, hit1, hit2))
        contexts.learn(step, x, hit1, hit2)
        steps[step, :n] = x
    table = np.empty((order.size, len(active)), np.uint16)
    table[order] = steps.T
    out, row = [], 0
    for k, (n, crc) in enumerate(zip(sizes, crcs, strict=True)):
        streams = -(-n // STREAM)
        ids = alphabet.ids[k][table[row : row + streams].reshape(-1)[:n]].astype("<u4")
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError("a block's checksum differs")
        out.append(ids)
        row += streams
    return out


#: Words kept in each of two generations; the older goes when the younger is full.
WORDS = 500_000
_LONG = 64
#: Bytes of text whose words are looked up together.
_BYTES = 1 << 22
_SPACE, _DENSE = np.zeros(256, bool), np.ones(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_DENSE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False  # 28 to 31 are white space to some


def _word_starts(data: np.ndarray) -> np.ndarray:
    """Where white space begins in UTF-8 after a character that is none in any reading: a flag for each byte."""
    found = _SPACE[data]
    found[1:] &= _DENSE[data[:-1]]
    found[:1] = False
    at = np.flatnonzero(found)
    at = at[data[at - 1] >= 128]  # other white space is U+0080 to U+00BF, or begins with E1, E2 or E3 and one of four bytes
    two, three = data[at - 2], data[np.maximum(at - 3, 0)]
    found[at[(two == 0xC2) | (three >= 0xE1) & (three <= 0xE3) & np.isin(two, (0x80, 0x81, 0x9A, 0xA0))]] = False
    return found


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Encoder:
    """Ids of whole texts, as the library gives them, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        says = json.loads(self.library.to_str())
        split, model = says["pre_tokenizer"] or {}, says["model"]
        self.by_word = (
            split.get("type") == "ByteLevel" and split.get("use_regex") is True and split.get("add_prefix_space") is False
            and model.get("type") == "BPE" and not model.get("dropout")
            and not any(says[k] for k in ("normalizer", "post_processor", "truncation", "padding"))
        )
        self.added = [t["content"] for t in says["added_tokens"]]
        plain = [t for t in says["added_tokens"] if not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))]
        self.between = (plain[0]["content"], plain[0]["id"]) if plain else None
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, words: list[str]) -> list[bytes]:
        """Ids of words, many in one text with an added token between them: a call for each would take longer than its work."""
        if self.between is None:
            return self._whole(words)
        mark, number = self.between
        out: list[bytes] = []
        for raw in self._whole([mark.join(words[k : k + 64]) for k in range(0, len(words), 64)]):
            ends = [*(4 * np.flatnonzero(np.frombuffer(raw, "<u4") == number)).tolist(), len(raw)]
            out += [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends, strict=False)]
        return out

    def _known(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.young.get, words))
        more = {w: self.old.get(w) for w, ids in zip(words, found, strict=True) if ids is None}
        new = [w for w, ids in more.items() if ids is None]
        more.update(zip(new, self._new([w.decode() for w in new]), strict=True))
        self.young.update((w, ids) for w, ids in more.items() if len(w) <= _LONG)
        if len(self.young) > WORDS:
            self.old, self.young = self.young, {}
        return [ids or more[w] for w, ids in zip(words, found, strict=True)]

    def _by_word(self, texts: pa.StringArray) -> list[bytes]:
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        data = np.frombuffer(b"".join(x.as_buffer() for x in texts), np.uint8)
        if not data.size:
            return [b""] * len(texts)
        first = _word_starts(data)
        first[0] = True
        first[ends[ends < data.size]] = True
        starts = np.append(np.flatnonzero(first), data.size).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), starts.size - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        each = self._known(words.dictionary.to_pylist())
        size = np.array([len(x) // 4 for x in each])
        which = words.indices.to_numpy()
        n = size[which]
        upto = np.append(0, np.cumsum(n))
        at = np.repeat((np.cumsum(size) - size)[which] - upto[:-1], n)
        at += np.arange(at.size)
        raw = np.frombuffer(b"".join(each), "<u4")[at].tobytes()
        cuts = [0, *(4 * upto[np.searchsorted(starts, ends)]).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode(self, texts: pa.StringArray) -> Iterator[bytes]:
        if not self.by_word:
            for at in range(0, len(texts), 256):
                yield from self._whole(texts.slice(at, 256).to_pylist())
            return
        hard = np.zeros(len(texts), bool)
        for name in self.added:
            hard |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        easy = pc.if_else(pa.array(hard), "", texts)
        part = np.cumsum(pc.binary_length(easy).to_numpy(zero_copy_only=False), dtype=np.int64) // _BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            for k, ids in enumerate(self._by_word(easy.slice(a, b - a)), a):
                yield self._whole([texts[k].as_py()])[0] if hard[k] else ids


@cache
def _encoder(path: str) -> _Encoder:
    """One for all tasks of a worker."""
    return _Encoder(path)


def write_ids(docs: DataFrame, path: str, folder: str, end: int = END, block: int = BLOCK, lanes: int = LANES) -> None:
    """Writes segments (part, segment, doc_ids, lengths, blocks) of all documents by ascending doc_id to a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = _encoder(path), TaskContext.get().partitionId(), 0
        last = np.array([end], "<u4").tobytes()
        held: list[bytes] = []
        owners: list = []
        size = 0

        def segment() -> pa.RecordBatch:
            blocks = encode_blocks(np.frombuffer(b"".join(held), "<u4"), block, lanes)
            columns = [[part], [number], [owners], [[len(x) // 4 for x in held]], [blocks]]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "segment", "doc_ids", "lengths", "blocks"])

        for batch in batches:
            for i, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
                held.append(raw + last)
                owners.append(i)
                size += len(held[-1]) // 4
                if size >= block * lanes:
                    yield segment()
                    held, owners, size, number = [], [], 0, number + 1
        if held:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, "part int, segment long, doc_ids array<long>, lengths array<long>, blocks array<binary>").write.parquet(folder)


def read_ids(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files; with keep_ids also ids (binary)."""
    files = spark.read.parquet(folder)
    sizes = files.selectExpr("part", "segment", "aggregate(lengths, 0L, (a, x) -> a + x) AS n")
    # One row for each part, as many as the writing job had tasks; segments add up within their part.
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS before")
    within = sizes.selectExpr("part", "segment", "sum(n) OVER (PARTITION BY part ORDER BY segment) - n AS inside")
    starts = within.join(parts, "part").selectExpr("part", "segment", "before + inside AS start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = decode_blocks(batch.column("blocks")[row].as_py())
                n = batch.column("lengths")[row].values.to_numpy()
                ends = np.cumsum(n)
                raw = [ids[a:b].tobytes() for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                columns = [batch.column("doc_ids")[row].values, pa.array(ends - n + batch.column("start")[row].as_py()), pa.array(n), pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(raw, pa.binary())] * keep_ids, ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids)

    joined = files.join(starts, ["part", "segment"]).select("doc_ids", "lengths", "blocks", "start")
    return joined.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)


def round_trip(docs: DataFrame, path: str, **options) -> DataFrame:
    """Writes the ids of docs to a new folder of the shared one and reads them back."""
    folder = new_folder(docs.sparkSession, "ids")
    write_ids(docs, path, folder, **options)
    return read_ids(docs.sparkSession, folder)
