import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tokenizers import Tokenizer

from limpid.llm import token_files
from limpid.llm.token_files import decode_blocks, encode_blocks, read_ids, round_trip, write_ids

DATA = "/root/testdata/sf0.001/documents.parquet"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    """(doc_id, start, n_tokens, crc) by doc_id, missing ids first, then by text."""
    t, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(((i, t_ or "") for i, t_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_names_of_special_tokens_in_a_text(spark):
    """As the library has it: a text that holds the name gets the token."""
    rows = [(0, "x <|endoftext|> y"), (1, "<|endoftext|>"), (2, "<|endoftext|")]
    assert Tokenizer.from_file(PATH).encode(rows[0][1], add_special_tokens=False).ids == [87, 220, 50256, 331]
    assert got(round_trip(spark.createDataFrame(rows, "doc_id long, text string"), PATH)) == brute(rows)


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("n", [0, 1, 5, 999, 1000, 1001, 20_000])
def test_blocks_come_back(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 65536).astype(np.uint32)
    blocks = encode_blocks(ids, block=1000, lanes=7)
    assert len(blocks) == -(-n // 1000) and (decode_blocks(blocks, lanes=5) == ids).all()
    for k in (0, len(blocks) - 1) if n > 1000 else ():
        assert (decode_blocks(blocks[k : k + 1]) == ids[k * 1000 : k * 1000 + 1000]).all()  # each on its own


def test_predictable_ids_are_small_and_damage_is_found():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    blocks = encode_blocks(ids)
    assert sum(map(len, blocks)) < ids.nbytes / 20
    bad = bytearray(blocks[0])
    bad[14] ^= 255
    for wrong in (bytes(bad), b"nonsense", b"XIB1" + blocks[0][4:]):
        with pytest.raises(ValueError):
            decode_blocks([wrong])
    with pytest.raises(ValueError):
        encode_blocks(np.array([1 << 20]))


def test_as_the_tokenizer_on_documents(spark):
    rows = pq.read_table(DATA, columns=["doc_id", "text"]).to_pylist()
    df = round_trip(spark.read.parquet(DATA), PATH)
    assert got(df) == brute([(r["doc_id"], r["text"]) for r in rows])


def test_edges(spark, tmp_path):
    rows = [(5, None), (5, "b"), (5, "a"), (None, "x y"), (-3, ""), (9, "<|endoftext|> é漢"), (7, "long text " * 20_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    folder = str(tmp_path / "ids")
    write_ids(df, PATH, folder, block=64, lanes=8)
    assert got(read_ids(spark, folder)) == brute(rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in read_ids(spark, folder, keep_ids=True).collect())
    assert round_trip(df.limit(0), PATH).collect() == []


def test_an_id_is_coded_in_one_step():
    """Bit by bit, with as many steps as a block has ids, these took 74 microseconds an id; now 0.7."""
    ids = (np.random.default_rng(1).zipf(1.3, 300_000) % 50_000).astype(np.uint32)
    began = time.thread_time()
    blocks = encode_blocks(ids)
    assert (decode_blocks(blocks) == ids).all()
    assert (time.thread_time() - began) / ids.size < 6e-6
    assert sum(map(len, blocks)) < len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_context_is_mixed_in():
    """Each id follows from the two before it, but each is as frequent as any other."""
    rng = np.random.default_rng(2)
    follows = rng.integers(0, 300, (300, 300))
    ids = [0, 1]
    for k in range(100_000):
        ids.append(int(follows[ids[-2], ids[-1]]) if k % 8 else int(rng.integers(300)))
    blocks = encode_blocks(np.array(ids))
    assert (decode_blocks(blocks) == ids).all()
    assert sum(map(len, blocks)) < 0.9 * len(ids)  # order 0 alone takes more than one byte


def texts(n, seed):
    rng = random.Random(seed)
    blank = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    other = ["'s", "'ll", "<|endoftext|>", "<|endof", "\u200b", "\u180e", "\ufeff", "\x80", "\u2014", "\u3001", "\0"]
    signs = [*blank, *other, *[" "] * 20, *["\n"] * 5, *"aAzé漢ß12²½Ⅷ٣'’.,;!?-_(){}😀"]
    return ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_have_the_ids_they_have_in_whole_texts(monkeypatch, name):
    monkeypatch.setattr(token_files, "_BYTES", 700)
    monkeypatch.setattr(token_files, "WORDS", 500)
    path = public_tokenizers.path(name)
    rows, t = texts(5000, 3), Tokenizer.from_file(path)
    found = token_files._Encoder(path).encode(pa.array(["not this", *rows], pa.string()).slice(1))
    for text, ids in zip(rows, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_a_word_goes_to_the_library_once(monkeypatch):
    coder = token_files._Encoder(PATH)
    assert coder.by_word
    rows = pa.array(["one two  three", "two\u3000two", "", " one"])
    before = list(coder.encode(rows))
    monkeypatch.setattr(coder, "_whole", lambda asked: pytest.fail(str(asked)) if asked else [])
    assert list(coder.encode(rows)) == before
