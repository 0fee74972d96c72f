"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text"):
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


#: The session's setting that removes a query's shuffle files at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_folders: dict[str, str] = {}


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in the one all executors share (``spark.checkpoint.dir``), removed when the driver ends.

    Where that setting is absent a local master gets a temporary folder; on a cluster it must be set.
    """
    app = spark.sparkContext.applicationId
    if app not in _folders:
        folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not folder:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        _folders[app] = f"{folder}/tidemark-{app}"
        files, at = _file_system(spark, _folders[app])
        files.mkdirs(at)
        files.deleteOnExit(at)
    return _folders[app]


def write_table(df: DataFrame, name: str, **options) -> DataFrame:
    """Write *df* as Parquet in the shared folder and return a reader of it: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    # Shuffle files of the write go as soon as it ends, not when the driver happens to collect its garbage.
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    made = spark.read.parquet(path)
    made.written_at = path
    return made


def drop_tables(*tables: DataFrame) -> None:
    """Remove tables of ``write_table`` that nothing will read any more."""
    for t in tables:
        files, at = _file_system(t.sparkSession, t.written_at)
        files.delete(at, True)


def sides_by_size(df: DataFrame, n_rows: int, bound: int) -> DataFrame:
    """*df* with a broadcast hint if its counted rows are within *bound*; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if n_rows <= bound else df
