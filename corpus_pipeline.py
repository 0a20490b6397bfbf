"""A corpus from raw documents: language, near duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes to the shared folder and rereads as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.llm.bpe import encode_documents
from limpid.llm.decontaminate import leaks
from limpid.llm.language import identify, train
from limpid.llm.near_dedup import near_duplicates
from limpid.llm.queries import learned_from, rank_file, table
from limpid.llm.repeats import remove_repeats
from limpid.llm.rows import row_key
from limpid.llm.storage import stored

#: Bytes of an Arrow batch. The JVM and the worker of every task hold one; by rows alone it grows with the length of the texts.
BATCH_BYTES = 1 << 22
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage whose session bounds Arrow batches by bytes too, unless it has a bound of its own. Rows are the same."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(_BATCH, None) is None:
            spark.conf.set(_BATCH, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@bounded
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected: no letter at all, or far from every learned language."""
    model = train(learned_from(docs).select("doc_id", "text", "lang"))
    return identify(docs, model).filter("NOT rejected").select(*docs.columns)


@bounded
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the row with the least doc_id; rows without doc_id stay.

    Rows that share a doc_id are judged one by one: each different one gets a number of its own, checked to be unique.
    """
    marked = docs.filter("doc_id IS NOT NULL").withColumn("_row", row_key())
    for salt in range(8):
        number = F.xxhash64(F.lit(salt), "_row")
        if marked.select("_row", number.alias("n")).groupBy("n").agg(F.min("_row").alias("lo"), F.max("_row").alias("hi")).filter("lo != hi").isEmpty():
            break
    else:
        raise ValueError("no numbering tells all rows apart")
    found = near_duplicates(marked.select("_row", F.col("doc_id").alias("_doc"), number.alias("doc_id"), "text"), carry=("_row", "_doc"))
    kept = found.groupBy("component_id").agg(F.min(F.struct("_doc", "_row")).alias("one")).select(F.col("one._row").alias("_kept"))
    chosen = marked.join(kept, marked["_row"] == kept["_kept"], "left_semi").dropDuplicates(["_row"]).drop("_row")
    return chosen.unionByName(docs.filter("doc_id IS NULL"))


@bounded
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of the texts; a document that is nothing but repeats goes."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = remove_repeats(docs.withColumn("_others", F.struct(*others)), keep_text=True, carry=("_others",))
    cut = cut.filter("n_removed = 0 OR n_removed < n_bytes")
    n_chars = F.when(F.col("n_removed") == 0, F.col("_others.n_chars")).otherwise(F.length("kept_text"))
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": n_chars.cast("long")}
    return cut.select(*[new.get(c, F.col(f"_others.`{c}`")).alias(c) for c in docs.columns])


@bounded
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that hold a benchmark item, not others of the same doc_id or without one."""
    flagged = leaks(docs, table(spark, sf_dir, "benchmark"), short=True).select(F.col("row").alias("_leak")).distinct()
    return docs.withColumn("_row", row_key()).join(flagged, F.col("_row") == F.col("_leak"), "left_anti").drop("_row")


@bounded
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded bytes, and the ids."""
    return encode_documents(docs, *rank_file(), keep_ids=True)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

#: SQL can't express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over sf_dir's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
