"""License scans by diagonal voting.

Words are runs of 0-9, A-Z (as a-z) and characters beyond ASCII. The hashes of all rolling k-word grams are joined to
the places of equal grams in the templates; each hit votes for its diagonal, the place in the text less that in the
template. A vote counts only if the gram's words are those of the template, compared as bytes. A phrase stands where one
diagonal has all of its votes. Longer templates may differ a little: a diagonal holds if enough different places of the
template voted for it; neighbouring diagonals are merged to a span, which holds if they have enough different places
together, these cover enough of the template's words, and the span is not much longer than the template.

Null and empty texts have no words. Rows stand for themselves, so repeated rows get equal answers; doc_id and
other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.arrays import U64, Slice, Words, alphanumeric, grams, owner, text_slices, words_of
from limpid.llm.storage import stored

#: Phrases whose every place counts, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Templates that add labels: common notices and the grants of well-known public licenses.
TEMPLATES = {
    "apache-2.0": ["licensed under the apache license version 2 0"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met"
    ],
    "cc-by-nc": ["licensed under cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "gpl-3.0": [
        "licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ],
    "mpl-2.0": ["subject to the terms of the mozilla public license v 2 0"],
}
GRAM = 3
SHARE = 0.7
SLACK = 4


def template_grams(phrases: dict[str, str], templates: dict[str, list[str]], gram: int) -> list[tuple]:
    """(gram hash, template, label, whether a phrase, place, grams of the template, words of it, words of a gram, the gram)."""
    out = []
    every = [(t, label, True) for t, label in phrases.items()] + [(t, label, False) for label, ts in templates.items() for t in ts]
    for number, (text, label, phrase) in enumerate(every):
        raw = np.frombuffer(text.encode(), np.uint8)
        h = words_of(Slice(0, raw, np.array([0, raw.size])), alphanumeric()).hash
        k = min(gram, h.size)
        g = grams(h, k).view(np.int64).tolist()
        out += [(x, number, label, phrase, i, len(g), h.size, k, " ".join(text.split()[i : i + k])) for i, x in enumerate(g)]
    return out


def hits(docs: DataFrame, known: dict[int, np.ndarray], words: dict[int, frozenset[bytes]]) -> DataFrame:
    """row, doc_id, n_words, hits (place and hash of each gram that some template has) of every row.

    known: hashes of the templates' grams by their number of words; words: by hash, the grams that have it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column("text")):
                w = words_of(s, alphanumeric())
                n = np.diff(w.first)
                text = owner(w.first, w.hash.size)
                found = []
                for k, hashes in known.items():
                    g = grams(w.hash, k)
                    at = np.searchsorted(hashes, g)
                    at[at == hashes.size] = 0
                    place = np.flatnonzero((hashes[at] == g) & (text[k - 1 :] == text[: g.size]))
                    place = place[[_gram(s.data, w, p, k) in words[x] for p, x in zip(place.tolist(), g[place].view(np.int64).tolist(), strict=True)]]
                    found.append((place, g[place]))
                place, g = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(place, kind="stable")
                place, g = place[order], g[order]
                ends = np.searchsorted(place, w.first).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(place - w.first[text[place]]), pa.array(g.view(np.int64))], ["place", "gram"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(s.first, n.size), pa.array(n), pa.ListArray.from_arrays(pa.array(ends), pairs)],
                    ["doc_id", "n_words", "hits"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(run, "doc_id long, n_words long, hits array<struct<place:long,gram:long>>")
    return found.withColumn("row", F.monotonically_increasing_id())


def _gram(data: np.ndarray, w: Words, at: int, k: int) -> bytes:
    """The k words from place `at` on, in small letters and one blank apart."""
    return b" ".join(data[w.start[i] : w.end[i]].tobytes().lower() for i in range(at, at + k))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = TEMPLATES,
    gram: int = GRAM,
    share: float = SHARE,
    slack: int = SLACK,
) -> tuple[DataFrame, DataFrame]:
    """(rows, spans). rows: row, doc_id, n_words. spans: row, label, phrase, start, stop (words) and share of the template."""
    table = template_grams(phrases, templates, gram)
    known = {k: np.unique(np.array([t[0] for t in table if t[7] == k], np.int64).view(U64)) for k in sorted({t[7] for t in table})}
    words = {x: frozenset(t[8].encode() for t in table if t[0] == x) for x in {t[0] for t in table}}
    rows = stored(hits(docs, known, words), "hits")
    places = docs.sparkSession.createDataFrame(
        table, "gram long, template int, label string, phrase boolean, at int, grams int, words int, k int, said string"
    ).drop("said")
    voted = rows.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    # The templates are a parameter, a few hundred rows whatever the documents.
    voted = voted.join(F.broadcast(places), "gram").withColumn("diagonal", F.col("place") - F.col("at"))
    keys = ["row", "template", "label", "phrase", "grams", "words", "k"]
    # A diagonal has each place of the template once at most.
    lines = voted.groupBy(*keys, "diagonal").agg(F.collect_list("at").alias("places"), F.min("place").alias("lo"), F.max("place").alias("hi"))
    own = F.size("places") / F.col("grams")
    alone = lines.filter(F.when(F.col("phrase"), own == 1).otherwise(own >= share))
    phrase = F.col("phrase")
    exact = alone.select(
        "row",
        "label",
        "phrase",
        F.when(phrase, F.col("diagonal")).otherwise(F.col("lo")).alias("start"),
        F.when(phrase, F.col("diagonal") + F.col("words")).otherwise(F.col("hi") + F.col("k")).alias("stop"),
        own.alias("share"),
    )
    beside = Window.partitionBy("row", "template").orderBy("diagonal")
    spans = (
        lines.filter("NOT phrase")
        .withColumn("new", (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(beside), F.lit(slack + 1)) > slack).cast("int"))
        .withColumn("span", F.sum("new").over(beside))
        .select(*keys, "span", "diagonal", "lo", "hi", F.explode("places").alias("at"))
        .groupBy(*keys, "span")
        .agg(
            F.collect_set("at").alias("places"),
            F.min("lo").alias("start"),
            (F.max("hi") + F.first("k")).alias("stop"),
            (F.max("diagonal") > F.min("diagonal")).alias("several"),
        )
        .filter("several")
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda a: F.sequence(a, a + F.col("k") - 1)))))
    merged = spans.withColumn("share", F.size("places") / F.col("grams")).filter(
        (F.col("share") >= share) & (covered >= share * F.col("words")) & (F.col("stop") - F.col("start") <= 1.5 * F.col("words") + slack)
    )
    return rows.select("row", "doc_id", "n_words"), exact.unionByName(merged.select("row", "label", "phrase", "start", "stop", "share"))


def licenses(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row; score is the best share."""
    rows, spans = scan(docs, **options)
    base = F.when(F.col("phrase"), F.col("start"))
    found = spans.groupBy("row").agg(
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
