"""Tables for intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Bytes that a writer holds before it writes them out.
ROW_GROUP = 16 << 20


def _folder(spark: SparkSession) -> str:
    """The session's checkpoint folder."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession) -> str:
    """A path in the checkpoint folder that nothing else uses."""
    return f"{_folder(spark)}/folder-{uuid4().hex}"


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written as a table to the checkpoint folder and read from there, and the table's path."""
    path = f"{_folder(df.sparkSession)}/table-{uuid4().hex}"
    # Small row groups, so that a task that writes large values buffers little.
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and its lineage cut, so that a lost executor costs no more than a reread.

    The table goes to the session's ``spark.checkpoint.dir``; only where that is unset and the master
    is local, as in tests, a local folder is made.
    """
    return stored(df)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def cleared(spark: SparkSession) -> None:
    """Delete all intermediate tables of this session, once the results that read them are written."""
    removed(spark, _folder(spark))


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, without counting on beyond that."""
    return df.limit(rows + 1).count() <= rows
