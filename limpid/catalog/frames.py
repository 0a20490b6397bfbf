"""Record lines derived from the orders table, and the frames built from them.

Every order gives four lines with the faults real files have: mixed year
spellings, decimal commas, blank and malformed fields, repeated keys, short and
long lines. Their number grows with the table. Lines, parsed and cleaned records
and the score history are each written once per session to the shared folder, as the
jobs would leave them for each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.operators.parsing import coerce_numeric, drop_first_row, parse_lines, ragged_records
from limpid.plans.cleaning import clean_records
from limpid.plans.history import history_row
from limpid.plans.scoring import scores_d
from limpid.sources.shared import exists, new_folder
from limpid.sources.write import write_parquet

HEADER = "COD_ANU,COD_ETU,COD_ELP,NOT_ELP,COD_TRE,COD_SES"

# The same expressions run in Spark and in the checking SQL.
ORDER_EXPRESSIONS = (
    "o_orderkey as k",
    "o_custkey as c",
    "cast(year(o_orderdate) as int) as y",
    "cast(floor(o_totalprice) as int) % 230 as g",
    "cast(year(o_orderdate) as string)||'-'||lpad(cast(month(o_orderdate) as string),2,'0') as batch",
)
FIELD_EXPRESSIONS = (
    "ln",
    "batch",
    """case when ln%10<=4 then cast(y as string)
         when ln%10<=6 then cast(y as string)||'-'||cast(y+1 as string)
         when ln%10=7 then lpad(cast(y%100 as string),2,'0')||'/'||lpad(cast((y+1)%100 as string),2,'0')
         when ln%10=8 then '' else 'AN'||cast(y as string) end as anu""",
    "case when ln%101=0 then '' else cast(10000000+c as string) end as etu",
    """case when ln%23=0 then '' when ln%19=0 then 'MAT-'||cast(k%40 as string)
         when ln%13=0 then 'math'||cast(1000+k%40+cast(floor(s/2.0) as int) as string)
         when ln%17=0 then '  MATH'||cast(1000+k%40+cast(floor(s/2.0) as int) as string)||' '
         else 'MATH'||cast(1000+k%40+cast(floor(s/2.0) as int) as string) end as elp""",
    """case when ln%29=0 then 'ABS' when ln%31=0 then '' when ln%37=0 then '-3'
         when ln%3=0 then cast(cast(floor(g/10.0) as int) as string)||','||cast(g%10 as string)
         else cast(cast(floor(g/10.0) as int) as string)||'.'||cast(g%10 as string) end as note""",
    """case (k+5*s)%12 when 0 then 'V' when 1 then 'AJ' when 2 then 'RAT' when 3 then 'VAR' when 4 then 'ADM'
         when 5 then 'NV' when 6 then 'ACAR' when 7 then 'ABSN' when 8 then ' v ' when 9 then 'XX'
         when 10 then '' else 'V' end as tre""",
    """case when ln%41=0 then '' when ln%43=0 then '3' when ln%47=0 then 'x' when ln%53=0 then '1.0'
         else cast(1+s%2 as string) end as ses""",
)
LINE_EXPRESSION = """case when ln%223=0 then anu||','||etu||','||elp
       when ln%211=0 then anu||','||etu||','||elp||','||note||','||tre||','||ses||',EXTRA,EXTRA'
       else anu||','||etu||','||elp||','||note||','||tre||','||ses end as raw_line"""

HELPERS = ("line_no", "batch")

# Records take about 11 bytes in a file and over 150 in the sorts and counts of a later task.
ROWS_PER_FILE = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_folders: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """Folder of a table written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _folders or not exists(spark, _folders[key]):
        path = new_folder(spark, name)
        write(path)
        _folders[key] = path
    return _folders[key]


def _stored(spark: SparkSession, sf_dir: str, name: str, derive: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The derived table ``name`` as every job after the one that wrote it sees it."""
    path = written(spark, sf_dir, name, lambda p: write_parquet(derive(spark, sf_dir), p, rows_per_file=ROWS_PER_FILE))
    return spark.read.parquet(path)


def derive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, batch, raw_line), the header line first with number -1."""
    orders = table(spark, sf_dir, "orders").selectExpr(*ORDER_EXPRESSIONS)
    # A single small file scans as one task; parsing its lines should use all cores.
    orders = orders.repartition("k")
    fields = (
        orders.selectExpr("*", "explode(array(0, 1, 2, 3)) as s")
        .selectExpr("*", "k*4+s as ln")
        .selectExpr(*FIELD_EXPRESSIONS)
    )
    # As the output of a generator the line is a finished value: filters on it stay above,
    # as they would over a text file, instead of repeating the expression that builds it.
    line = LINE_EXPRESSION.removesuffix(" as raw_line")
    body = fields.selectExpr("cast(ln as bigint) as line_no", "batch", f"explode(array({line})) as raw_line")
    header = spark.range(1).select(
        F.lit(-1).cast("long").alias("line_no"), F.lit(None).cast("string").alias("batch"), F.lit(HEADER).alias("raw_line")
    )
    return body.union(header)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines as stored."""
    return _stored(spark, sf_dir, "lines", derive_lines)


def ingested_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingested records as stored, with the month their order belongs to."""
    return _stored(spark, sf_dir, "ingested", lambda s, d: parse_lines(lines(s, d)))


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without header and unparsable lines."""
    return ingested_batches(spark, sf_dir).drop("batch")


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without header, unparsable lines kept as null records."""
    derive = lambda s, d: parse_lines(lines(s, d).drop("batch"), keep_invalid=True)
    return _stored(spark, sf_dir, "quarantined", derive)


def ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line dropped by position, the others read without repair."""
    derive = lambda s, d: ragged_records(drop_first_row(lines(s, d).drop("batch"))).drop("surplus")
    return _stored(spark, sf_dir, "ragged", derive)


def ragged_seven(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ragged(spark, sf_dir).drop("line_no", "too_many_fields")


def ragged_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_numeric(ragged_seven(spark, sf_dir))


def cleaned_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records as stored, with the month their order belongs to."""
    derive = lambda s, d: clean_records(ingested_batches(s, d), carry=HELPERS)
    return _stored(spark, sf_dir, "cleaned", derive)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_batches(spark, sf_dir).drop("batch")


def cleaned_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen cleaned columns."""
    return cleaned(spark, sf_dir).drop("line_no")


def derive_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores before and after cleaning of every monthly batch of records."""
    at = lambda clock: F.concat("batch", F.lit(f"-01T{clock}")).cast("timestamp_ntz")
    stages = (
        (ingested_batches(spark, sf_dir), "raw", "08:00:00"),
        (cleaned_batches(spark, sf_dir), "cleaned", "09:30:00.5"),
    )
    raw, done = (
        history_row(scores_d(frame, helpers=("line_no",), by=("batch",)), stage, at(clock)).drop("batch")
        for frame, stage, clock in stages
    )
    return raw.unionByName(done)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "history", derive_history)
