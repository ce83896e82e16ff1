"""Folders for intermediate tables, in the place that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the folder that the program set for checkpoints. Where neither is set a
    local session (as in tests) gets a folder of its own; on a cluster this raises, as no folder of
    one machine would do."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(rows: DataFrame) -> DataFrame:
    """`rows` written once to shared_folder() and read from there: for what several branches of a plan read."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below shared_folder()."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a job has committed its files in the folder at `path`."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)
