"""Where jobs may put files that every executor has to see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


# Folders made for each application, to be removed at its end.
_made: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a local session may make its own."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors share")
    made = _made.setdefault(spark.sparkContext.applicationId, [])
    if not made:
        _register(spark, tempfile.mkdtemp(prefix="limpid-"))
    return made[0]


def _register(spark: SparkSession, folder: str) -> None:
    """Has the file system remove the folder when the driver's JVM ends."""
    fs, where = _fs(spark, folder)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    _made.setdefault(spark.sparkContext.applicationId, []).append(folder)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that does not exist yet. It goes when the driver ends, or with ``remove_folders``."""
    folder = f"{shared_root(spark).rstrip('/')}/limpid-{uuid.uuid4().hex}"
    _register(spark, folder)
    return f"{folder}/{name}"


def remove_folders(spark: SparkSession) -> int:
    """Removes all tables this application has put into the shared folder, for those who go on without them; returns
    how many folders. DataFrames that read them can't be used any more."""
    folders = _made.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        fs, where = _fs(spark, folder)
        fs.delete(where, True)
    return len(folders)


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """Writes to the shared folder and reads back, so that later steps neither repeat this one nor lose it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def has_files(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether files matching ``pattern`` lie directly in ``path``."""
    fs, where = _fs(spark, f"{path.rstrip('/')}/{pattern}")
    found = fs.globStatus(where)
    return found is not None and len(found) > 0


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one small file through the file system Spark uses."""
    fs, where = _fs(spark, path)
    out = fs.create(where)
    out.write(bytearray(content))
    out.close()
