"""File inventories and text bodies."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INVENTORY = "path string, modificationTime timestamp, length long"


def two_days(anchor: str | date) -> tuple[date, date]:
    """The day before and the day itself; text must be exactly YYYY-MM-DD."""
    if isinstance(anchor, str):
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", anchor):
            raise ValueError(f"not a YYYY-MM-DD date: {anchor!r}")
        anchor = datetime.strptime(anchor, "%Y-%m-%d").date()
    return anchor - timedelta(days=1), anchor


def list_day_folders(spark: SparkSession, root: str, days: list[date], pattern: str = "*") -> DataFrame:
    """Path, modification time and length of plain files directly inside root/yyyymmdd; folders that are
    not there give no rows. Bodies are not read."""
    folders = ",".join(sorted({f"{day:%Y%m%d}" for day in days}))
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(f"{root}/{{{folders}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], INVENTORY)
    return files.select("path", "modificationTime", "length")


def in_two_days(files: DataFrame, anchor: str | date) -> DataFrame:
    """Files of both target folders."""
    return files.where(F.col("folder_date").isin(*[F.lit(d) for d in two_days(anchor)]))


def files_per_day(files: DataFrame) -> DataFrame:
    """(folder_date, texts, images)."""
    return files.groupBy("folder_date").agg(
        F.count(F.when(F.col("kind") == "text", 1)).alias("texts"),
        F.count(F.when(F.col("kind") == "image", 1)).alias("images"),
    )


def stale_files(files: DataFrame, now: datetime, age: timedelta = timedelta(days=3)) -> DataFrame:
    """Files last changed more than `age` before `now`."""
    return files.where(F.col("modified") < F.lit(now - age))


def size_mismatches(source: DataFrame, copies: DataFrame) -> DataFrame:
    """(path, source_size, copy_size) where a copy is missing or of another size."""
    other = copies.select("path", F.col("size").alias("copy_size"))
    met = source.select("path", F.col("size").alias("source_size")).join(other, "path", "left")
    return met.where(~F.col("source_size").eqNullSafe(F.col("copy_size")))


def decoded(content: Column) -> Column:
    """Text of a body as UTF-8, with U+FFFD for what is not valid."""
    return F.make_valid_utf8(content.cast("string"))


def decode_bodies(files: DataFrame, *, fallback: str | None = "MS949") -> DataFrame:
    """`files` (source_file, content) with column text, in one pass. UTF-8 bodies stay in the JVM; an Arrow
    function sees the others alone, and tries `fallback` strictly before it puts in U+FFFD. Null
    bodies give null text."""
    body = F.col("content").cast("string")
    valid = F.is_valid_utf8(body)
    if fallback is None:
        return files.withColumn("text", decoded(F.col("content")))
    codec = {"MS949": "cp949"}.get(fallback, fallback)

    @F.pandas_udf("string")
    def fall_back(bodies):
        def one(body: bytes | None) -> str | None:
            if body is None:
                return None
            try:
                return bytes(body).decode(codec)
            except UnicodeDecodeError:
                return bytes(body).decode("utf-8", errors="replace")

        return bodies.map(one)

    other = fall_back(F.when(~valid, F.col("content")))
    return files.withColumn("text", F.coalesce(F.when(valid, body), other))
