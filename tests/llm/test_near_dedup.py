import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from limpid.llm import arrays
from limpid.llm.components import components
from limpid.llm.near_dedup import confirmed, near_duplicates, rare_pairs

DATA = "/root/testdata/sf0.001/documents.parquet"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(texts):
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_as_brute_force_on_documents(spark):
    texts = pq.read_table(DATA)["text"].to_pylist()
    assert rows(near_duplicates(spark.read.parquet(DATA))) == brute(texts)


def test_edges_ties_and_a_group_of_near_copies(spark, documents):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(60)]
    texts = [None, "", " \t\n ", "One", "one", "a b c", "A b  c", "a b", " x y", "x" * 50_000]
    for _ in range(60):  # pairs of these are alike in part only
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(n)) for n in (4, 5, 6, 200)] * 2
    assert rows(near_duplicates(documents(texts))) == brute(texts)


def test_empty_table_and_missing_ids(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
    got = near_duplicates(spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c")], schema))
    assert sorted(map(tuple, got.collect()), key=str) == [(3, 1, 3, True), (3, 1, 3, True), (None, 1, None, True)]


@pytest.mark.parametrize("links", [[(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (5, 5)], [(i, i + 1) for i in range(40)], []])
def test_components(spark, links):
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    known = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: min(known) for x in known}


def test_rare_pairs_of_copies_and_of_ids_with_several_texts(spark):
    words = [f"w{k}" for k in range(120)]
    near = " ".join([*words[:60], "x", *words[60:], "y"])
    other = " ".join(f"o{k}" for k in range(400))
    mixed = spark.createDataFrame([(1, 1), (2, 2)], "id long, component long")
    for rows in ([(1, near)] * 8 + [(2, " ".join(words))] * 3, [(1, near), (1, other), (2, " ".join(words)), (2, other.upper() + " z")] * 2):
        texts = spark.createDataFrame(rows, "id long, text string")
        pairs = rare_pairs(mixed, texts)
        assert [tuple(r) for r in pairs.collect()] == [(1, 2)]
        assert {tuple(r) for r in confirmed(pairs, texts).collect()} == {(1, 2)}
    texts = spark.createDataFrame([(1, near)] * 8 + [(2, " ".join(words))] * 3, "id long, text string")
    assert confirmed(rare_pairs(mixed, texts), texts).count() == 1


def test_slices_and_tables_of_powers_stay_small():
    """A worker keeps one table of powers a seed, the longest it needed, and looks at about 256 KB of text at once."""
    column = pa.array(["a b c d e f " * 2000] * 100)  # 2.4 MB
    assert max(s.data.size for s in arrays.text_slices(column)) <= 1 << 18
    arrays._known_powers.clear()
    sets = [x for s in arrays.text_slices(column) for x in arrays.shingles(arrays.words_of(s, arrays.not_space()))]
    long = pa.array([" ".join(column.to_pylist()[:20])])  # a text of its own, 480 KB
    one = arrays.shingles(arrays.words_of(next(arrays.text_slices(long)), arrays.not_space()))[0]
    assert all(set(x) == set(sets[0]) for x in sets) and set(sets[0]) == set(one)
    assert list(arrays._known_powers) == [0] and arrays._known_powers[0][0].size <= 1 << 19
