"""Readers. Every schema is explicit, so no reader looks at the data twice."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.names import named
from limpid.functions.text import null_if, surplus_fields
from limpid.plans.cleaning import FLAGS
from limpid.plans.history import with_stage
from limpid.rules import DEFAULT, MISSING_TOKENS, Rules
from limpid.sources.shared import exists, has_files, stored_table

# What ends a line for Python's str.splitlines() beyond \n, \r\n and \r.
_LINE_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


# A table without rows is a smaller file than this.
FOOTER = 1 << 20


def ingested_schema(rules: Rules = DEFAULT) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in rules.cols.record])


def cleaned_schema(rules: Rules = DEFAULT) -> T.StructType:
    c = rules.cols
    kinds = {c.grade: T.DoubleType(), c.session: T.IntegerType()}
    return T.StructType(
        [T.StructField(n, kinds.get(n, T.StringType())) for n in c.record]
        + [T.StructField(n, T.BooleanType()) for n in FLAGS]
    )


def read_lines(spark: SparkSession, path: str, rules: Rules = DEFAULT) -> DataFrame:
    """(line_no, raw_line): one row per line, numbered uniquely in scan order.

    Store the numbers with the ingested records: another scan, with other file sizes
    or settings, may number the lines differently.
    """
    text = spark.read.text(path)
    return text.select(F.monotonically_increasing_id().alias(rules.order), F.col("value").alias("raw_line"))


def read_lines_lenient(spark: SparkSession, path: str, rules: Rules = DEFAULT) -> DataFrame:
    """As ``read_lines``, without undecodable bytes, splitting at every Unicode line end."""
    clean = F.translate(F.make_valid_utf8("value"), "\ufffd", "")
    pieces = F.split(clean, _LINE_ENDS)
    return (
        spark.read.text(path)
        # Never empty, so "outer" changes nothing but spares a second split that tests for it.
        .select(F.explode_outer(pieces).alias("raw_line"))
        .select(F.monotonically_increasing_id().alias(rules.order), "raw_line")
    )


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_cleaned_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text."""
    return spark.read.option("header", True).csv(path)


def read_ragged(spark: SparkSession, path: str, rules: Rules = DEFAULT) -> DataFrame:
    """Headerless CSV onto the six fields plus EXTRA; short lines padded, header line dropped.

    ``too_many_fields`` marks lines with more than seven fields, and ``surplus`` keeps their rest.
    """
    names = [*rules.cols.fields, "EXTRA"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])
    rows = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("sep", rules.delimiter)
        .option("columnNameOfCorruptRecord", "_line")
        .csv(path)
    )
    surplus = surplus_fields(F.col("_line"), rules.delimiter, len(names))
    return rows.where(~F.col(names[0]).eqNullSafe(names[0])).select(
        *[null_if(F.col(n), MISSING_TOKENS).alias(n) for n in names],
        surplus.isNotNull().alias("too_many_fields"),
        surplus.alias("surplus"),
    )


def read_csv_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All ``*.csv`` files below ``path`` as one table; missing-value tokens become null.

    Columns are bound by the names in each file's header: files may order them differently, lack some (null) or have
    others, which are left out. Files are grouped by header, of which there are few, and each group is one scan.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    found = lambda reader: reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    lines = found(spark.read).text(path).where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at")
    )
    headers = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = headers.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    rows = spark.createDataFrame([], schema)
    for group in sorted(groups, key=lambda g: g["header"]):
        order = next(csv.reader([group["header"].removeprefix("\ufeff")]))
        kinds = {f.name: f.dataType for f in schema.fields}
        own = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in order])
        part = spark.read.schema(own).option("header", True).csv(sorted(group["files"]))
        rows = rows.unionByName(part.select(*[named(n) for n in order if n in kinds]), allowMissingColumns=True)
    text = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return rows.select(
        *[null_if(F.col(c), MISSING_TOKENS).alias(c) if c in text else F.col(c) for c in rows.columns]
    )


def read_folders(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Parquet tables in several folders as one table in one scan; columns are bound by name, folders may be missing."""
    there = [p for p in paths if exists(spark, p)]
    return spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)


def _parts(spark: SparkSession, path: str):
    """Reader for part files directly in ``path``, or anywhere below when there are none."""
    reader = spark.read.option("pathGlobFilter", "part-*.parquet")
    deep = not has_files(spark, path, "part-*.parquet")
    return reader.option("recursiveFileLookup", deep)


def read_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet part files; a file that can't be read to its end is left out whole. See ``part_states``.

    The files are checked by one read when this is called. What comes back is a plain scan of the good ones: Spark drops
    the others by their names before it opens any.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    # Names of files that are damaged: as long as that list at most.
    damaged = [r["path"] for r in part_states(spark, path, schema).where("state = 'damaged'").select("path").collect()]
    rows = _readable(spark, path, schema)
    return rows.where(~F.col("_metadata.file_path").isin(damaged)) if damaged else rows


def _readable(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _parts(spark, path).option("ignoreCorruptFiles", True).schema(schema).parquet(path)


def part_states(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(path, bytes, rows, state) of each part file; state is whole, empty (a table without rows) or damaged.

    Spark's reader stops within a damaged file and keeps what it had. So a file is whole if reading every column gives as
    many rows as its footer states; counting without a column looks at footers only. A file without any row is empty
    if its footer can be parsed and says so.
    """
    file = F.col("_metadata.file_path").alias("path")
    files = _parts(spark, path).format("binaryFile").load(path)
    # Listing only: without the content column no file is opened.
    listed = files.select(file, F.col("length").alias("bytes"))
    rows = _readable(spark, path, schema)
    stated = rows.select(file).groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    touched = F.hash(*[named(f.name) for f in schema.fields])
    read = rows.select(file, touched.alias("h")).groupBy("path").agg(F.count(F.lit(1)).alias("read"), F.bit_xor("h").alias("seen"))
    # Asking for the digest keeps Spark from pruning the columns, which have to be read.
    whole = (F.col("rows") == F.col("read")) & F.col("seen").isNotNull()
    # One row a file; written, as it is used twice and costs the read of all columns.
    known = stored_table(stated.join(read, "path", "left").select("path", "rows", F.coalesce(whole, F.lit(False)).alias("whole")), "parts")
    # Names of small files without any row: a table without rows is little but its footer, so larger ones need no look.
    silent = [r["path"] for r in listed.where(F.col("bytes") <= FOOTER).join(known, "path", "left_anti").select("path").collect()]
    state = F.when(F.col("whole"), "whole")
    found = listed.join(known, "path", "left")
    if silent:
        footers = files.where(F.col("_metadata.file_path").isin(silent)).select(file, "content")
        found = found.join(footers.mapInArrow(_without_rows, "path string, empty boolean"), "path", "left")
        state = state.when(F.col("empty"), "empty")
    state = state.otherwise("damaged")
    return found.select("path", "bytes", F.when(state == "empty", 0).otherwise(F.col("rows")).alias("rows"), state.alias("state"))


def _without_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, empty): whether a file's content is a Parquet table without rows."""

    def empty(content: pa.Scalar) -> bool:
        try:
            return pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata.num_rows == 0
        except (pa.ArrowException, OSError):
            return False

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([empty(c) for c in batch.column(1)], pa.bool_())], names=["path", "empty"])


def skipped_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(path, bytes) of part files that ``read_parts`` leaves out."""
    return part_states(spark, path, schema).where("state = 'damaged'").select("path", "bytes")


def history_schema(metrics: Sequence[str]) -> T.StructType:
    return T.StructType(
        [T.StructField("timestamp", T.StringType()), T.StructField("stage", T.StringType())]
        + [T.StructField(m, T.DoubleType()) for m in metrics]
    )


def read_history_csv(spark: SparkSession, path: str, metrics: Sequence[str]) -> DataFrame:
    """Score history from CSV with its time column parsed (naive UTC)."""
    rows = spark.read.schema(history_schema(metrics)).option("header", True).csv(path)
    return rows.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Score history table; columns added over time are merged by name."""
    return with_stage(spark.read.option("mergeSchema", True).parquet(path))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, or an empty one when nothing is there."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
