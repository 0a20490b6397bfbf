"""How far the sources of a language diverge in their words: a frequent-pattern tree of term rows.

Terms are runs of letters A-Z, a-z and of characters beyond ASCII; only A-Z are lower-cased. A language keeps the V terms
that stand in at least `least` of its documents (rows). A group (lang, source), and a language as a whole, gives a kept
term with count c the share p = 1 + floor(SCALE * (c + 1) / (N + V)), N the group's count of all kept terms; a share q is
diverged from by f(p, q) = floor((p - q)^2 / q). All of it is exact integer arithmetic.

The value of a pair of sources is the sum of f over all kept terms. A term row is a term's list of (source, count), nonzero
counts only, in order of the sources. Were every count zero, the sum would be V * f of the two shares of a count of zero.
To that come corrections: for each count of one source alone, from how many terms have that count there; and for each two
counts of one term, from the tree. Equal rows are inserted once with their number. Rows in sorted order walk the tree depth
first, so a node, that is a prefix of rows, ends where the next row leaves it and needs no pointers: tasks take ranges of
sorted rows and build their parts of the tree with numpy. A node gives one correction with each of its ancestors, times the
rows through it, however many terms share the path. Where a range or an Arrow batch ends, a node is two nodes with parts of
its rows, which adds up to the same.

Hard rows: null lang, source and text count as ''. A group without a term has all its counts zero and is compared all the
same; a language without kept terms has pairs of value 0 and no term rows. Repeated rows and rows that share a doc_id are
documents each. Ties rank by UTF-8 order. An empty table gives an empty one. Columns other than lang, source and text don't
matter. A text is read whole, in memory in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.arrays import text_slices
from limpid.llm.storage import stored

LEAST = 3
SCALE = 1_000_000_000
RANKS = 200
# Bytes of text that are counted at once, term rows that a task puts into its part of the tree, about, and combinations of
# a node and an ancestor in one Arrow batch.
BYTES = 4 << 20
PATHS = 1 << 15
BATCH = 1 << 17


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to terms, and what each becomes: A-Z as a-z."""
    inside = np.zeros(256, bool)
    inside[65:91] = inside[97:123] = inside[128:] = True
    small = np.arange(256, dtype=np.uint8)
    small[65:91] += 32
    return inside, small


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of some texts one after another, and the number of each one's text."""
    inside, small = _letters()
    marked = inside[data]
    starts, ends = marked.copy(), marked.copy()
    cut = np.zeros(data.size + 1, bool)
    cut[offsets] = True
    starts[1:] &= ~marked[:-1] | cut[1:-1]
    ends[:-1] &= ~marked[1:] | cut[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    letters = small[data[marked]]
    places = np.concatenate(([0], np.cumsum(end - start)))
    words = pa.LargeStringArray.from_buffers(start.size, pa.py_buffer(places), pa.py_buffer(letters))
    return words, np.repeat(np.arange(offsets.size - 1), np.diff(np.searchsorted(start, offsets)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) from (lang, source, text), combined over some megabytes of text."""
    for batch in batches:
        langs, sources = (batch.column(i).dictionary_encode() for i in (0, 1))
        width = max(1, len(sources.dictionary))
        group = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()
        for s in text_slices(batch.column(2), BYTES):
            words, owner = _terms(s.data, s.offsets)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            n = len(coded.dictionary)
            cell, found = np.unique(owner * n + coded.indices.to_numpy(), return_counts=True)
            of_group, part = np.unique(group[s.first + cell // n] * n + cell % n, return_inverse=True)
            total = np.zeros(of_group.size, np.int64)
            np.add.at(total, part, found)
            g, term = of_group // n, of_group % n
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(g // width)),
                    sources.dictionary.take(pa.array(g % width)),
                    pc.cast(coded.dictionary.take(pa.array(term)), pa.string()),
                    pa.array(total),
                    pa.array(np.bincount(part, minlength=of_group.size).astype(np.int64)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def term_rows(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, term, row) of the kept terms; row is the list of (source, n) in order of the sources."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counted = docs.select(empty("lang"), empty("source"), empty("text")).mapInArrow(
        _count, "lang string, source string, term string, n long, docs long"
    )
    by_source = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("row")
    )
    return by_term.filter(F.col("docs") >= least).select("lang", "term", "row")


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, na, b, nb, terms) for each node and ancestor, from sorted (lang, row, terms): b, nb is the node's item."""
    for batch in batches:
        row, weight = batch.column(1), batch.column(2).to_numpy()
        items = row.flatten()
        names = items.field(0).dictionary_encode()
        source, n = names.indices.to_numpy(), items.field(1).to_numpy()
        first = np.concatenate(([0], np.cumsum(pc.list_value_length(row).to_numpy()))).astype(np.int64)
        length = np.diff(first)
        lang = batch.column(0).dictionary_encode()
        # Whether a row has left the path of the row before, so far.
        left = np.concatenate(([True], np.diff(lang.indices.to_numpy()) != 0))
        for depth in range(int(length.max(initial=0))):
            here = np.flatnonzero(length > depth)
            at, before = first[here] + depth, np.maximum(here - 1, 0)
            over = np.minimum(first[before] + depth, source.size - 1)
            left[here] |= (length[before] <= depth) | (source[over] != source[at]) | (n[over] != n[at])
            begun = np.flatnonzero(left[here])
            if not depth:
                continue
            node, through = here[begun], np.add.reduceat(weight[here], begun)
            step = max(1, BATCH // depth)
            for i in range(0, node.size, step):
                some = node[i : i + step]
                above = (first[some][:, None] + np.arange(depth)).ravel()
                own = np.repeat(first[some] + depth, depth)
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.dictionary.take(pc.take(lang.indices, pa.array(np.repeat(some, depth)))),
                        names.dictionary.take(pa.array(source[above])),
                        pa.array(n[above]),
                        names.dictionary.take(pa.array(source[own])),
                        pa.array(n[own]),
                        pa.array(np.repeat(through[i : i + step], depth)),
                    ],
                    names=["lang", "a", "na", "b", "nb", "terms"],
                )


def shared_paths(rows: DataFrame) -> DataFrame:
    """(lang, a, na, b, nb, terms): how many terms have count na in source a and nb in b, a before b, both nonzero."""
    paths = rows.groupBy("lang", "row").agg(F.count(F.lit(1)).alias("terms"))
    # Any order that keeps equal beginnings together will do: hashes of the items are short to sort and to sample. Nodes are
    # told apart by their items, so two items of one hash make at most a node more.
    order = [F.hash("lang"), F.transform("row", lambda i: F.hash(i["source"], i["n"]))]
    parts = 1 + rows.count() // PATHS
    ordered = paths.withColumns({"_l": order[0], "_r": order[1]}).repartitionByRange(parts, "_l", "_r").sortWithinPartitions("_l", "_r")
    combined = ordered.drop("_l", "_r").mapInArrow(_grow, "lang string, a string, na long, b string, nb long, terms long")
    return combined.groupBy("lang", "a", "na", "b", "nb").agg(F.sum("terms").alias("terms"))


def _share(count: str | Column, total: str, kept: str = "v") -> Column:
    """p of a count; decimals, as a billion times a count passes the range of long integers."""
    c = F.col(count) if isinstance(count, str) else count
    whole = (c + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return (1 + F.call_function("div", whole, (F.col(total) + F.col(kept)).cast("decimal(20,0)"))).cast("long")


def _f(p: str, q: str) -> Column:
    d = F.col(p) - F.col(q)
    return F.call_function("div", d * d, F.col(q))


def _sum(value: Column, times: str) -> Column:
    return value.cast("decimal(20,0)") * F.col(times).cast("decimal(18,0)")


def _both(df: DataFrame, a: str, b: str, there: Column, back: Column) -> DataFrame:
    """Corrections of the pair in both directions."""
    return df.select(
        "lang",
        F.inline(
            F.array(
                F.struct(F.col(a).alias("source"), F.col(b).alias("item"), there.alias("value")),
                F.struct(F.col(b).alias("source"), F.col(a).alias("item"), back.alias("value")),
            )
        ),
    )


def divergence(docs: DataFrame, least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part `pair`: for each group and each other source of its language the sum of f over the kept terms, p the group's and q
    the other's, all ranks. Part `term`: for each group the kept terms that it holds with a larger share than its language
    has, with their f, the first `ranks` of them.
    """
    rows = stored(term_rows(docs, least), "terms")
    cells = rows.select("lang", "term", F.aggregate("row", F.lit(0).cast("long"), lambda x, i: x + i["n"]).alias("all"), F.inline("row"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    words = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    known = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    found = known.join(sizes, ["lang", "source"], "left").join(words, "lang", "left")
    found = found.select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("v", F.lit(0)).alias("v"))
    whole = found.groupBy("lang").agg(F.sum("size").alias("lang_size"))
    groups = stored(found.join(whole, "lang").withColumn("none", F.when(F.col("v") > 0, _share(F.lit(0), "size"))), "groups")

    def of(side: str, *more: str) -> DataFrame:
        """The groups with their columns named for one side of a pair."""
        return groups.select("lang", *[F.col(c).alias(f"{c}_{side}") for c in ("source", "size", "none", *more)])

    pairs = groups.select("lang", "source", "none", "v").join(of("b"), "lang").filter("source != source_b")
    nothing = _sum(F.coalesce(_f("none", "none_b"), F.lit(0)), "v").cast("decimal(38,0)")
    base = pairs.select("lang", "source", F.col("source_b").alias("item"), nothing.alias("value"))

    alone = cells.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms"))
    alone = alone.join(groups, ["lang", "source"]).withColumn("p", _share("n", "size"))
    alone = alone.join(of("b"), "lang").filter("source != source_b")
    there, back = _f("p", "none_b") - _f("none", "none_b"), _f("none_b", "p") - _f("none_b", "none")
    singles = _both(alone, "source", "source_b", _sum(there, "terms"), _sum(back, "terms"))

    both = shared_paths(rows).withColumnsRenamed({"a": "source_a", "b": "source_b"})
    both = both.join(of("a", "v"), ["lang", "source_a"]).join(of("b"), ["lang", "source_b"])
    both = both.withColumns({"p": _share("na", "size_a", "v_a"), "q": _share("nb", "size_b", "v_a")})

    def apart(p: str, p0: str, q: str, q0: str) -> Column:
        """What two counts of one term add beyond what each adds alone."""
        return _f(p, q).cast("decimal(20,0)") - _f(p, q0) - _f(p0, q) + _f(p0, q0)

    joint = _both(
        both, "source_a", "source_b", _sum(apart("p", "none_a", "q", "none_b"), "terms"), _sum(apart("q", "none_b", "p", "none_a"), "terms")
    )
    parts = [x.withColumn("value", F.col("value").cast("decimal(38,0)")) for x in (base, singles, joint)]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))

    held = cells.join(groups, ["lang", "source"]).withColumns({"p": _share("n", "size"), "q": _share("all", "lang_size")}).filter("p > q")
    terms = held.select("lang", "source", F.col("term").alias("item"), _f("p", "q").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= ranks)
    all_pairs = summed.withColumn("rank", F.row_number().over(by_value))
    order = ("lang", "source", "part", "item", "value", "rank")
    return (
        all_pairs.withColumn("part", F.lit("pair")).select(*order).unionByName(ranked.withColumn("part", F.lit("term")).select(*order))
    )
