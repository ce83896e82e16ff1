"""The exclusive match run by run: each run reads its own new files and what the run before left open.

Images are put on a stack and texts take from it, so all that a stretch of time needs to know of the time
before it are the images that are still free at its start, the latest first; and a text that finds the stretch's own
stack empty, as the n-th such text, takes the n-th of them. As a match spans five minutes at most,
what a run hands on are the free images of its last five minutes, however long the history.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracelode.operators.matching import REACH, matched, stacked
from tracelode.sources.scratch import written

#: What is handed on: free images by prefix, rank 1 the latest.
FREE = "prefix string, file_id long, path string, file_ts timestamp_ntz, at long, rank int"


def nothing_free(spark: SparkSession) -> DataFrame:
    """What the first run starts from."""
    return spark.createDataFrame([], FREE)


def _seconds(moment: datetime):
    return F.unix_seconds(F.lit(moment).cast("timestamp_ntz").cast("timestamp"))


def arrivals(files: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """Files of the run's own stretch, since <= file_ts < until, as a filter that reaches the scan."""
    return files.where((F.col("file_ts") >= F.lit(since)) & (F.col("file_ts") < F.lit(until)))


def match_run(
    texts: DataFrame,
    images: DataFrame,
    free: DataFrame,
    since: datetime,
    until: datetime,
    reach: int = REACH,
    *,
    sliced: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(pairs, free): each text of the stretch with the image it takes, as match_exclusive() gives them, and what the
    next run starts from. `free` is what the run before handed on, up to `since`. Runs follow each other without gaps and in
    order of time; files that come after their stretch was matched call for a match of that stretch and the later ones anew.
    """
    keys = ["file_id", "path", "file_ts", "at"]
    rows = written(stacked(arrivals(texts, since, until), arrivals(images, since, until), sliced=sliced))
    stack = F.col("o.kind") == "image"
    own = rows.where("kind = 'text'").where(F.col("_level").isNotNull())
    # Texts that found the stack empty. After `reach` they find nothing older either, and they come last in their order.
    bare = rows.where("kind = 'text' and _level is null")
    early = F.col("at") <= _seconds(since) + reach
    order = W.partitionBy("prefix").orderBy("at", "path", "file_id")
    asking = written(bare.where(early).withColumn("rank", F.row_number().over(order)).select("prefix", *keys, "rank"))
    offered = free.select("prefix", "rank", F.struct(F.lit("image").alias("kind"), *keys).alias("o"))
    across = asking.join(offered, ["prefix", "rank"], "left")
    late = bare.where(~early).select("prefix", *keys)
    nobody = F.lit(None).cast(offered.schema["o"].dataType)
    every = (
        own.select("prefix", *keys, F.when(stack, F.col("o")).alias("o"))
        .union(across.select("prefix", *keys, "o"))
        .union(late.select("prefix", *keys, nobody.alias("o")))
    )
    popped = own.where(stack).select(F.col("o.file_id").alias("file_id"), F.col("o.path").alias("path"))
    recent = F.col("at") >= _seconds(until) - reach
    new = rows.where("kind = 'image'").where(recent).join(popped, ["file_id", "path"], "left_anti").select("prefix", *keys)
    taken = asking.groupBy("prefix").agg(F.max("rank").alias("n"))
    old = free.join(taken, "prefix", "left").where(recent & (F.col("rank") > F.coalesce("n", F.lit(0)))).select("prefix", *keys)
    latest = W.partitionBy("prefix").orderBy(F.desc("at"), F.asc("path"), F.asc("file_id"))
    left = new.union(old).withColumn("rank", F.row_number().over(latest))
    return matched(every, reach), left
