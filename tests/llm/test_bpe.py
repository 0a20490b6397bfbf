"""Byte-level BPE against the tiktoken library."""

import hashlib
import random
import time
from struct import pack

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

from limpid.llm.bpe import codec, encode_documents, stitch

DATA = "/root/testdata/sf0.01/documents.parquet"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=load_tiktoken_bpe(PATH), special_tokens={})


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def brute(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        assert library.decode_bytes(ids) == (text or "").encode()
        out.append((i, len(ids), sha(pack(f"<{len(ids)}I", *ids)), sha((text or "").encode())))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


def test_as_the_library_on_documents(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(DATA, columns=["doc_id", "text"]).to_pylist()]
    assert got(encode_documents(spark.read.parquet(DATA), PATH, PATTERN)) == brute(library, rows)


HARD = [
    None, "", " ", "\n", "a", "x <|endoftext|> y", "é漢字🙂\u200d👩", "  two  blanks \n\n and lines\r\n", "don't we'll I'VE", "123456789 0x1F", "\u00a0\u3000 tab\t\t.", "a" * 40,
]


@pytest.mark.parametrize("chunk, overlap", [(8, 3), (20, 19), (64, 8), (1 << 15, 1 << 11)])
def test_chunks_of_any_size_change_nothing(spark, library, chunk, overlap):
    rng = random.Random(chunk)
    texts = [*HARD, "a" * 500, " " * 300, "\n" * 200 + "x", "1" * 333]
    texts += ["".join(rng.choice(["word", " ", "  ", "\n", "é", "漢", "'s", "12", ".", "!?", "a" * 30]) for _ in range(rng.randrange(200))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(encode_documents(df, PATH, PATTERN, chunk=chunk, overlap=overlap)) == brute(library, rows)


def test_around_chunk_and_overlap(spark, library):
    chunk, overlap = 1 << 15, 1 << 11
    words = "some words, and 12 more;\n" * 8000
    sizes = [chunk - 1, chunk, chunk + 1, chunk + overlap, 2 * chunk - overlap - 1, 2 * chunk - overlap, 2 * chunk - overlap + 1, 4 * chunk]
    rows = [(n, words[:n]) for n in sizes] + [(-n, "é" * n) for n in sizes]
    assert got(encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), PATH, PATTERN)) == brute(library, rows)


def test_missing_and_repeated_ids_and_other_columns(spark, library, documents):
    long = "repeated words " * 5000
    rows = [(None, "x"), (None, long), (4, long), (4, long), (4, "y"), (4, None)]
    df = spark.createDataFrame([(*r, "k", 1, b"z") for r in rows], "doc_id long, text string, key string, place int, part binary")
    found = encode_documents(df, PATH, PATTERN, keep_ids=True)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert got(found) == brute(library, rows)
    assert all(sha(bytes(r.ids)) == r.ids_sha256 and len(r.ids) == 4 * r.n_tokens for r in found.collect())
    assert got(encode_documents(documents(HARD), PATH, PATTERN)) == brute(library, list(enumerate(HARD)))
    assert encode_documents(df.limit(0), PATH, PATTERN).collect() == []


def test_one_letter_a_million_times(spark):
    """Two million are one pre-token over all chunks. Time is in proportion; the ids decode to the text."""
    times = []
    c = codec(PATH, PATTERN)
    for n in (1 << 20, 1 << 22):
        text, starts = "a" * n, list(range(0, n - 2048, 32768 - 2048))
        parts = [text[p : p + 32768] for p in starts]
        ends = [c.ends(p) for p in parts]
        began = time.process_time()
        assert stitch(ends, starts, parts, c.ends) == [text]
        times.append(time.process_time() - began)
    assert times[1] < 8 * times[0] + 0.5
    text = "a" * (1 << 20)
    row = encode_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, PATTERN).first()
    assert row.decoded_sha256 == sha(text.encode())


@pytest.mark.parametrize("chunk, overlap", [(5, 0), (5, 5), (5, 9)])
def test_an_overlap_fits_into_its_chunk(spark, chunk, overlap):
    with pytest.raises(ValueError):
        encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN, chunk=chunk, overlap=overlap)


def test_merges_of_long_pieces(library):
    """The heap for long pieces joins as the plain loop does."""
    rng = random.Random(1)
    c = codec(PATH, PATTERN)
    for n in (65, 200, 1000):
        piece = "".join(rng.choice("aeinrst") for _ in range(n))
        assert c.merge(piece.encode()) == library.encode_ordinary(piece)


def test_workers_keep_no_pieces(spark):
    """Python workers live on for other stages; pieces of a task's texts don't."""
    texts = spark.range(64, numPartitions=8).selectExpr("id AS doc_id", "concat('word ', id, ' and ', id * id) AS text")
    assert encode_documents(texts, PATH, PATTERN).count() == 64

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(codec(PATH, PATTERN)._known)]})

    assert {r.n for r in spark.range(64, numPartitions=8).mapInArrow(held, "n long").collect()} == {0}
