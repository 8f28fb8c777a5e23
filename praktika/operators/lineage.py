"""Cutting lineage with tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset, a temporary one if the master is local, as in tests.

    On a cluster a folder of one machine would lose rows without a word: there an unset one is an error.
    """
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if not wanted:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is unset and the master is {master}: name a folder that all executors share")
        wanted = tempfile.mkdtemp(prefix="praktika-")
        spark.conf.set("spark.checkpoint.dir", wanted)
    return wanted.rstrip("/")


def file_system(spark: SparkSession, path: str) -> tuple:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, written to the shared folder and read back; a lost executor loses none of it.

    A table is written rather than a checkpoint, as a checkpoint keeps the size that Catalyst guessed for its plan:
    over the rounds of an iteration these guesses multiply until planning no longer ends. A table has its true size,
    on which the choice of joins can rely. It goes when the application ends or with ``drop``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/praktika-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, at = file_system(spark, path)
    fs.deleteOnExit(at)
    result = spark.read.schema(df.schema).parquet(path)
    result._praktika_path = path
    return result


def drop(df: DataFrame) -> None:
    """Remove the table of a ``cut`` that nothing reads any more."""
    path = getattr(df, "_praktika_path", None)
    if path:
        fs, at = file_system(df.sparkSession, path)
        fs.delete(at, True)
