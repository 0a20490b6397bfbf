"""Document fingerprints: a Merkle tree over paragraphs and sections, in Spark's own expressions.

Paragraphs are the lines of a text, a paragraph's node is its SHA-256. Sections are runs of paragraphs that end after
one whose digest starts with 0 or 1, so an insertion moves no other section; a section's node is the SHA-256 of its
paragraphs' nodes, the root that of the sections' nodes. The leaves below a paragraph are its phrases. They end where the
text itself says so, after a mark or one of a few letters and a blank, so an edit changes the phrases it touches only.

Two trees are as alike as the share of nodes that they have in common, over the levels below the root: where branches are
equal, all nodes below them are; where they differ, the nodes below decide. Nodes are compared by 32-bit names. Only equal
roots give 1: the same phrases in another order are almost 1 where there is one paragraph, less where there are more.

Null text counts as empty. Equal texts have equal trees. doc_id may be null or repeated, see `edited_neighbours`. Very long
texts are handled whole, in memory in proportion to them. Columns other than doc_id and text don't matter; an empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.storage import stored

#: A phrase ends after one of these and a white-space character. The letters end about a third of the words of European
#: languages, so phrases have some three words; which letters they are doesn't matter. Fixed values.
_PHRASE = r"(?<=[.,;:!?|。！？dghkmpwxyz]\s)"
_MARK = "\u0001"


def tree(text: Column) -> Column:
    """root, sections (node and nodes of its paragraphs) and names (distinct, of the nodes below the root) of a text."""
    nodes = F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))
    ended = F.transform(nodes, lambda n: F.concat(n, F.when(n.substr(1, 1).isin("0", "1"), F.lit(_MARK)).otherwise(F.lit(" "))))
    sections = F.transform(
        F.split(F.regexp_replace(F.array_join(ended, ""), f"[ {_MARK}]$", ""), _MARK, -1),
        lambda s: F.struct(F.sha2(s, 256).alias("node"), F.split(s, " ", -1).alias("paragraphs")),
    )
    root = F.sha2(F.array_join(F.transform(sections, lambda s: s["node"]), " "), 256)
    return F.struct(root.alias("root"), sections.alias("sections"), _names(text, nodes, sections).alias("names"))


def _names(text: Column, paragraphs: Column, sections: Column) -> Column:
    """32-bit names of the nodes that tell something: all phrases, and paragraphs and sections that aren't the only one.
    Levels are told apart."""
    none = F.array().cast("array<int>")
    phrases = F.transform(F.split(text, _PHRASE, -1), lambda p: F.hash(p))
    middle = F.when(F.size(paragraphs) > 1, F.transform(paragraphs, lambda n: F.hash(F.lit(1), n))).otherwise(none)
    upper = F.when(F.size(sections) > 1, F.transform(sections, lambda s: F.hash(F.lit(2), s["node"]))).otherwise(none)
    return F.array_distinct(F.concat(phrases, middle, upper))


def likeness(a: Column, b: Column) -> Column:
    """1 if the roots are equal, else twice the common nodes by all nodes of both trees, and less than 1."""
    common = F.size(F.array_intersect(a["names"], b["names"]))
    share = 2.0 * common / (F.size(a["names"]) + F.size(b["names"]))
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(F.least(share, F.lit(0.999999)))


def first_difference(a: Column, b: Column) -> Column:
    """Number (from 0) of the first section whose node differs, null if the roots are equal: equal branches aren't entered."""
    mine, other = a["sections"], b["sections"]
    differs = F.transform(mine, lambda s, i: F.coalesce(F.get(other, i)["node"] != s["node"], F.lit(True)))
    at = F.array_position(differs, True)
    return F.when(a["root"] != b["root"], F.when(at > 0, at - 1).otherwise(F.size(mine).cast("long")))


def first_changed_paragraph(a: Column, b: Column) -> Column:
    """Number (from 0, in the whole text) of the first paragraph that differs, found below the first differing section."""
    at = first_difference(a, b).cast("int")
    before = F.aggregate(F.slice(a["sections"], 1, at), F.lit(0), lambda n, s: n + F.size(s["paragraphs"]))
    mine = F.coalesce(F.get(a["sections"], at)["paragraphs"], F.array().cast("array<string>"))
    other = F.coalesce(F.get(b["sections"], at)["paragraphs"], F.array().cast("array<string>"))
    place = F.array_position(F.transform(mine, lambda p, i: F.coalesce(F.get(other, i) != p, F.lit(True))), True)
    return F.when(at.isNotNull(), before + F.when(place > 0, place - 1).otherwise(F.size(mine)))


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, prev_id, prev_chars over the distinct doc_ids in ascending order, the last before the first.

    Ids are dealt out by range; neighbours come from windows within a range, and across ranges from one row a range.
    """
    ids = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("n_chars").alias("chars"))
    ids = stored(ids.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id()), "ids")
    ends = ids.groupBy("range").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max_by("chars", "doc_id").alias("hi_chars"))
    # One row a range, whatever the table's size: a task's share of the ids each.
    ends = ends.selectExpr(
        "range",
        "coalesce(lead(lo) OVER (ORDER BY range), first(lo) OVER (ORDER BY range)) AS after",
        "coalesce(lag(hi) OVER (ORDER BY range), last(hi) OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS before",
        "coalesce(lag(hi_chars) OVER (ORDER BY range), last(hi_chars) OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS before_chars",
    )
    inside = ids.selectExpr(
        "doc_id",
        "range",
        "lead(doc_id) OVER (PARTITION BY range ORDER BY doc_id) AS next_in",
        "lag(doc_id) OVER (PARTITION BY range ORDER BY doc_id) AS prev_in",
        "lag(chars) OVER (PARTITION BY range ORDER BY doc_id) AS prev_in_chars",
    )
    return inside.join(ends, "range").selectExpr(
        "doc_id",
        "coalesce(next_in, after) AS next_id",
        "coalesce(prev_in, before) AS prev_id",
        "coalesce(prev_in_chars, before_chars) AS prev_chars",
    )


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next document's are.

    The edited text has its last quarter of code points replaced by as many from the start of the next document,
    by ascending doc_id, after the last the first. Where rows share the next doc_id, the one with the least start counts.
    Rows without doc_id have no next document: nothing is replaced and near_next is null.
    """
    # A cast to the type it has would be another expression for each use of the rows, and so another exchange.
    number = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(number, F.coalesce("text", F.lit("")).alias("text"))
    # The one shuffle of the texts: dealt out here, and not by a join, it is the same exchange for both uses below.
    known = rows.filter("doc_id IS NOT NULL").repartition("doc_id")
    near = neighbours(rows.select("doc_id", F.length("text").cast("long").alias("n_chars")))
    # The next document sends only what is used of it.
    placed = known.join(near, "doc_id")
    sent = placed.withColumn("tree", tree(F.col("text"))).select(
        F.col("prev_id").alias("to"),
        F.struct(
            F.expr("substring(text, 1, cast(prev_chars div 4 AS int))").alias("head"), F.col("tree.root").alias("root"), F.col("tree.names").alias("names")
        ).alias("next"),
    )
    sent = sent.groupBy("to").agg(F.min("next").alias("next"))
    both = placed.select("doc_id", "text").join(sent, F.col("doc_id") == F.col("to")).select("doc_id", "text", "next")
    alone = rows.filter("doc_id IS NULL").withColumn("next", F.lit(None).cast(both.schema["next"].dataType))
    both = both.unionByName(alone).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.when(F.col("next").isNull(), F.lit(0)).otherwise(F.expr("n_chars div 4")).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - cut), F.coalesce(F.col("next.head").substr(F.lit(1), cut), F.lit("")))
    done = both.select("doc_id", "n_chars", tree(F.col("text")).alias("tree"), "next", edited.alias("edited")).withColumn("edited_tree", tree(F.col("edited")))
    mine, other = F.col("tree"), F.col("edited_tree")
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        mine["root"].alias("fingerprint"),
        other["root"].alias("edited_fingerprint"),
        likeness(mine, other).alias("near_edited"),
        F.when(F.col("next").isNotNull(), likeness(mine, F.col("next"))).alias("near_next"),
        first_difference(mine, other).alias("changed_section"),
        first_changed_paragraph(mine, other).cast("long").alias("changed_paragraph"),
    )
