"""What file names and paths say, and what is to be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Fixed value: prefix, date and time of a file name without suffix.
NAME = r"\A(.+)_(\d{8})_(\d{6})\z"


def stem(path: Column) -> Column:
    """File name without folders and without its last suffix; a leading dot is no suffix."""
    name = F.element_at(F.split(F.regexp_replace(path, r"/+\z", ""), "/"), -1)
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]*\z", "")


def parse_names(files: DataFrame) -> DataFrame:
    """`files` with prefix and file_ts, both null where the name or its time does not fit."""
    bare = stem(F.col("path"))
    prefix = F.nullif(F.regexp_extract(bare, NAME, 1), F.lit(""))
    digits = F.concat(F.regexp_extract(bare, NAME, 2), F.regexp_extract(bare, NAME, 3))
    ts = F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")
    return files.withColumn("file_ts", ts).withColumn("prefix", F.when(F.col("file_ts").isNotNull(), prefix))


def accepted(files: DataFrame) -> DataFrame:
    return parse_names(files).where("file_ts is not null")


def rejected(files: DataFrame) -> DataFrame:
    return parse_names(files).where("file_ts is null")


def output_path(path: Column) -> Column:
    """rbi/ruip/... with suffix .png: from the first segment that is `ruip` in any case on; null without one."""
    tail = F.regexp_extract(path, r"(?i)\A(?:.*?/)??ruip(/.*)?\z", 1)
    there = path.rlike(r"(?i)(\A|/)ruip(/|\z)")
    bare = F.regexp_replace(tail, r"(?<=[^/])\.[^./]*\z", "")
    return F.when(there, F.concat(F.lit("rbi/ruip"), bare, F.lit(".png")))


def relative_path(path: Column, root: str) -> Column:
    """`path` below `root`, or without leading slashes where it is elsewhere."""
    base = root.rstrip("/")
    return F.when(path.startswith(base + "/"), F.substring(path, len(base) + 2, 1_000_000)).otherwise(
        F.regexp_replace(path, r"\A/+", "")
    )


def publish_plan(matched: DataFrame, published: DataFrame, prepared: DataFrame) -> DataFrame:
    """Per matched image what is left to do: record (already published), reuse (a prepared copy is
    there) or convert. `published` and `prepared` have a column output_path."""
    done = published.select("output_path").distinct().withColumn("_done", F.lit(True))
    ready = prepared.select("output_path").distinct().withColumn("_ready", F.lit(True))
    return (
        matched.withColumn("output_path", output_path(F.col("image_path")))
        .join(done, "output_path", "left")
        .join(ready, "output_path", "left")
        .withColumn("action", F.when(F.col("_done"), "record").when(F.col("_ready"), "reuse").otherwise("convert"))
        .drop("_done", "_ready")
    )


def already_published(images: DataFrame, published: DataFrame) -> DataFrame:
    """Images whose output is there."""
    return images.withColumn("output_path", output_path(F.col("path"))).join(published.select("output_path"), "output_path", "left_semi")
