"""Rows computed once and kept in the folder that driver and executors share.

Who owns what: a checkpoint's files go when Spark has dropped its rows, which keep asks Spark for; a
table made under fresh() belongs to who asked for it, who calls drop(); clear() drops all that one
Spark application has left.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANING = "spark.cleaner.referenceTracking.cleanCheckpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. In local mode, where it may be unset, one of our own that goes at exit."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="verso-")
        atexit.register(shutil.rmtree, named, True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    own = context._jsc.sc().conf()
    if not own.contains(CLEANING):
        own.set(CLEANING, "true")
    return named


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def fresh(spark: SparkSession, kind: str = "table") -> str:
    """A path in the shared folder that nothing has used."""
    return f"{_own(spark)}/{kind}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clear(spark: SparkSession) -> None:
    """Drops all tables and checkpoints of this Spark application; results that still read them are lost."""
    drop(spark, _own(spark))
    drop(spark, spark.sparkContext.getCheckpointDir())


def keep(df: DataFrame) -> DataFrame:
    """The same rows, computed once."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
