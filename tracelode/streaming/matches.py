"""Texts and images linked with the nearest file of the other kind as both arrive.

A file waits in the state of its prefix and slice of time; files that may serve a later or an earlier slice as well
wait in that one too, as in the batch form. Once the watermark has passed all that a slice can get, its files are
matched, given out and forgotten. So a busy prefix is as many states as it has slices, a state holds the files of one
slice, and what is held in all is bounded by the watermark's delay. No pairs are formed.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType, StructType

from tracelode.operators.matching import REACH, SLICE_SECONDS
from tracelode.sources.workers import importable
from tracelode.streaming.jobs import CLOSING, DELAY, EVENT_TIME

#: What a match says, beside the keys; ids as strings.
_MET = "file_id string, path string, file_ts timestamp_ntz, o_id string, o_path string, o_ts timestamp_ntz, diff_seconds long"


class SliceState(StatefulProcessor):
    """Keyed state of a slice of one prefix: the pieces in which its files came, until the watermark passes its end."""

    def __init__(self, keys: list[str], seconds: int, reach: int, forward: bool, every: bool, numbers: bool):
        self.keys, self.seconds, self.reach = keys, seconds, reach
        self.forward, self.every, self.numbers = forward, every, numbers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "piece binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for piece in rows:
            piece = piece[piece["path"] != CLOSING].drop(columns=EVENT_TIME)
            if len(piece):
                self.waiting.appendValue((pickle.dumps(piece, protocol=5),))
                # Later texts serve images of the slice's last seconds; earlier images are in the slice itself.
                end = (int(piece["slice"].iloc[0]) + 1) * self.seconds + (self.reach if self.forward else 0)
                self.handle.registerTimer(end * 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        pieces = [pickle.loads(piece) for (piece,) in self.waiting.get()] if self.waiting.exists() else []
        self.waiting.clear()
        if pieces:
            met = self.nearest(pd.concat(pieces, ignore_index=True))
            if len(met):
                yield met

    def nearest(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Asking files with the nearest offer; of offers of one second the one with the lowest path and id, null lowest."""
        order = pd.to_numeric(rows["file_id"], dtype_backend="numpy_nullable") if self.numbers else rows["file_id"]
        offers = rows.assign(order=order)[rows["kind"] == "offer"]
        offers = offers.sort_values(["at", "path", "order"], na_position="first").drop_duplicates("at")
        offers = pd.DataFrame({"at": offers["at"], "o_at": offers["at"], "o_id": offers["file_id"], "o_path": offers["path"], "o_ts": offers["file_ts"]})
        asks = rows[rows["kind"] == "ask"].sort_values("at", kind="stable")
        met = pd.merge_asof(asks, offers, on="at", direction="forward" if self.forward else "backward", tolerance=self.reach)
        met["diff_seconds"] = (met["o_at"] - met["at"]).abs().astype("Int64")
        met = met if self.every else met[met["o_at"].notna()]
        return met[[*self.keys, "file_id", "path", "file_ts", "o_id", "o_path", "o_ts", "diff_seconds"]]

    def close(self) -> None:
        pass


def _matches(
    asking: DataFrame, offered: DataFrame, keys: list[str], *, forward: bool, reach: int, delay: str, every: bool, seconds: int
) -> DataFrame:
    """The asking files (keys, file_id, path, file_ts) with o_id, o_path, o_ts and diff_seconds."""
    importable(asking.sparkSession)
    id_type = asking.schema["file_id"].dataType
    at = F.unix_seconds(F.col(EVENT_TIME))
    slice_of = lambda t: F.floor(t / seconds)

    def side(files: DataFrame, kind: str) -> DataFrame:
        timed = files.withColumn(EVENT_TIME, F.col("file_ts").cast("timestamp")).withWatermark(EVENT_TIME, delay)
        id_ = F.col("file_id").cast("string").alias("file_id")
        return timed.select(*keys, F.lit(kind).alias("kind"), id_, "path", "file_ts", at.alias("at"), EVENT_TIME)

    asks = side(asking, "ask")
    near = F.array_distinct(F.array(slice_of(F.col("at")), slice_of(F.col("at") + (-reach if forward else reach))))
    both = (
        side(offered, "offer")
        .withColumn("slice", F.explode(near))
        .unionByName(asks.withColumn("slice", slice_of(F.col("at"))))
        .where("file_ts is not null")
    )
    kinds = ", ".join(f"{k} {asking.schema[k].dataType.simpleString()}" for k in keys)
    processor = SliceState(keys, seconds, reach, forward, every, isinstance(id_type, IntegralType))
    met = both.groupBy(*keys, "slice").transformWithStateInPandas(processor, f"{kinds}, {_MET}", "Append", "EventTime")
    if every:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("o_id", "string"), ("o_path", "string"), ("o_ts", "timestamp_ntz"), ("diff_seconds", "long"))]
        met = met.unionByName(asks.where("file_ts is null").select(*keys, "file_id", "path", "file_ts", *none))
    return met.withColumns({"file_id": F.col("file_id").cast(id_type), "o_id": F.col("o_id").cast(offered.schema["file_id"].dataType)})


def match_image_to_text(
    images: DataFrame, texts: DataFrame, reach: int = REACH, *, delay: str = DELAY, every: bool = False, seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Two streams of files (prefix, folder_date, file_id, path, file_ts): per image the nearest text of its prefix and folder,
    0 to `reach` seconds later; the rows of the batch form, for any order in which no file of a stream comes more than
    `delay` after later ones of the same stream. A row comes out once both streams' watermarks have passed its slice of `seconds` and the reach; with
    `every` images without a text then come out with nulls. Null prefixes and folders are one group each; files without a time match nothing. Ids are
    whole numbers or strings. closing_files() in both sources brings out the last rows; run_once() raises where files came too late."""
    met = _matches(images, texts, ["prefix", "folder_date"], forward=True, reach=reach, delay=delay, every=every, seconds=seconds)
    return met.select(
        "prefix", "folder_date", F.col("file_id").alias("image_id"), F.col("path").alias("image_path"), F.col("file_ts").alias("image_ts"),
        F.col("o_id").alias("text_id"), F.col("o_path").alias("text_path"), F.col("o_ts").alias("text_ts"), "diff_seconds",
    )


def match_text_to_image(
    texts: DataFrame, images: DataFrame, reach: int = REACH, *, delay: str = DELAY, every: bool = False, seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Two streams of files: per text the nearest image of its prefix, 0 to `reach` seconds earlier; images may be reused.
    As match_image_to_text() in all else."""
    met = _matches(texts, images, ["prefix"], forward=False, reach=reach, delay=delay, every=every, seconds=seconds)
    return met.select(
        "prefix", F.col("file_id").alias("text_id"), F.col("path").alias("text_path"), F.col("file_ts").alias("text_ts"),
        F.col("o_id").alias("image_id"), F.col("o_path").alias("image_path"), F.col("o_ts").alias("image_ts"), "diff_seconds",
    )


def closing_files(spark: SparkSession, schema: StructType, after: datetime) -> DataFrame:
    """A file that moves a stream's watermark to `after`, less the delay, and gives no result. Both sources need one."""
    known = {"path": F.lit(CLOSING), "file_ts": F.lit(after).cast("timestamp_ntz")}
    return spark.range(1).select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
