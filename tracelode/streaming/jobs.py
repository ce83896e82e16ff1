"""Streaming forms: root causes, dose warnings with keyed state, text files.

The keyed form holds handle and wafer values per equipment across micro-batches, and keeps rows
until the watermark has passed them, so that it can hand them through in order of time whatever order
they come in. What it holds of an equipment is bounded by the watermark's delay.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tracelode.functions import dose, root_cause
from tracelode.operators.state import JUMP, LOG_ORDER
from tracelode.sources.files import decode_bodies
from tracelode.sources.workers import importable

#: Time of a row as the watermark needs it, and how long rows may come after later ones.
EVENT_TIME, DELAY = "event_time", "1 day"
#: Code and equipment of the rows that only move the watermark.
CLOSING = "CLOSING"


def root_causes(logs: DataFrame) -> DataFrame:
    """Parsed root causes of a stream of logs; stateless, the same columns as the batch form."""
    return root_cause.parse_root_causes(logs)


def _filled(rows: pd.DataFrame, last: tuple, threshold: int) -> tuple[pd.DataFrame, tuple]:
    """Rows of one equipment in order, with test shots dropped and wafers filled, and the (handle, wafer_id, wafer_seq)
    that later rows start from; `last` is that of the rows before."""
    handle, *wafer = last
    counted = rows["code"].str.upper().str.startswith("DW-", na=False) & rows["exposure_handle"].notna()
    before = rows["exposure_handle"].where(counted).ffill().shift()
    if handle is not None:
        before = before.fillna(handle)
    rise = rows["exposure_handle"] - before
    handles = rows["exposure_handle"].where(counted).dropna()
    kept = rows[~(counted & (rise >= threshold).fillna(False))].copy()
    for i, name in enumerate(("wafer_id", "wafer_seq")):
        kept[name] = kept[name].ffill()
        if wafer[i] is not None:
            kept[name] = kept[name].fillna(wafer[i])

    def latest(values: pd.Series, old):
        return int(values.iloc[-1]) if len(values) and pd.notna(values.iloc[-1]) else old

    now = (latest(handles, handle), latest(kept["wafer_id"], wafer[0]), latest(kept["wafer_seq"], wafer[1]))
    for name, kind in dose.INTEGER_COLUMNS.items():
        kept[name] = kept[name].astype("Int64" if kind == "long" else "Int32")
    return kept, now


class DoseState(StatefulProcessor):
    """Keyed state of one equipment: the last values, and rows that wait for the watermark.

    Rows wait as the pieces in which they came. When the watermark passes the earliest of them, all
    that it has passed are put in order, handed through and given out; the others are one piece again.
    So whatever comes no later than the watermark's delay, in any order and any cut, gives the rows of
    the batch form, and a state holds what an equipment logs within the delay.
    """

    def __init__(self, columns: list[str], threshold: int = JUMP):
        self.columns, self.threshold = columns, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "handle long, wafer_id long, wafer_seq long")
        self.waiting = handle.getListState("waiting", "piece binary")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """`seed` of dose_warnings(): what no earlier row gives."""
        number = lambda x: None if pd.isna(x) else int(x)
        self.last.update((None, number(initialState["wafer_id"].iloc[0]), number(initialState["wafer_seq"].iloc[0])))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for piece in rows:
            piece = piece[piece["code"] != CLOSING]
            if len(piece):
                self._wait(piece)
        yield from ()

    def _wait(self, piece: pd.DataFrame) -> None:
        self.waiting.appendValue((pickle.dumps(piece, protocol=5),))
        # Due once the watermark stands behind the piece's first row.
        self.handle.registerTimer(int(piece[EVENT_TIME].min().timestamp() * 1000) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.waiting.exists():
            return
        passed = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        due, later = [], []
        for (piece,) in self.waiting.get():
            rows = pickle.loads(piece)
            ready = rows[EVENT_TIME].dt.tz_localize(None) < passed
            due.append(rows[ready])
            later.append(rows[~ready])
        self.waiting.clear()
        if any(map(len, later)):
            self._wait(pd.concat(later, ignore_index=True))
        rows = pd.concat(due, ignore_index=True)
        if len(rows):
            rows = rows.sort_values(list(LOG_ORDER), kind="stable", na_position="last")
            last = self.last.get() if self.last.exists() else (None, None, None)
            kept, now = _filled(rows, tuple(last), self.threshold)
            self.last.update(now)
            yield kept[self.columns]

    def close(self) -> None:
        pass


def dose_warnings(logs: DataFrame, seed: DataFrame | None = None, threshold: int = JUMP, *, delay: str = DELAY) -> DataFrame:
    """Parsed dose warnings of a stream with test shots dropped and wafers carried forward: the rows of the batch form,
    for any order of input in which no row comes more than `delay` after later ones of any equipment, however it is cut in
    batches. Rows come out once the watermark has passed them; closing() rows bring out the last. `seed` (eq_name,
    wafer_id, wafer_seq) fills what no earlier row of the stream gives. Rows that come later than that are not taken
    in; run_once() raises where there were any. Rows without an equipment or a time have no place in any order and pass by.
    """
    importable(logs.sparkSession)
    timed = logs.withColumn(EVENT_TIME, F.col("code_occur_time").cast("timestamp")).withWatermark(EVENT_TIME, delay)
    parsed = dose.parse_dose_warnings(timed.where(F.col("code").isin(*dose.TARGET_CODES, CLOSING)), EVENT_TIME)
    columns = [c for c in parsed.columns if c != EVENT_TIME]
    whole = parsed.where("eq_name is not null and code_occur_time is not null")
    free = parsed.where("eq_name is null or code_occur_time is null").select(*columns)
    start = None if seed is None else seed.where("eq_name is not null").select("eq_name", "wafer_id", "wafer_seq").groupBy("eq_name")
    kept = whole.groupBy("eq_name").transformWithStateInPandas(
        DoseState(columns, threshold), free.schema, "Append", "EventTime", start
    )
    return kept.unionByName(free)


def closing(spark: SparkSession, schema: StructType, after: datetime) -> DataFrame:
    """A row that moves the watermark to `after`, less the delay, and gives no result. Written to the source behind all
    others, with a time later than theirs by the delay and more, it brings out the rows that still wait."""
    known = {"eq_name": F.lit(CLOSING), "code": F.lit(CLOSING), "code_occur_time": F.lit(after).cast("timestamp_ntz")}
    return spark.range(1).select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def text_bodies(
    spark: SparkSession, folder: str, pattern: str = "*.txt", *, files_per_batch: int | None = None, archive: str | None = None, delete: bool = False
) -> DataFrame:
    """Stream of (source_file, text) of new files below `folder`; a file is read once. Where wanted, files go to `archive`
    or are deleted after the batch that read them is done; those of the last batch when the stream next runs."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    elif delete:
        reader = reader.option("cleanSource", "delete")
    found = reader.load(folder)
    return decode_bodies(found.select(F.col("path").alias("source_file"), "content")).select("source_file", "text")


#: Rows of a file that write_logs() makes, at most.
FILE_ROWS = 100_000


def write_logs(logs: DataFrame, path: str, most: int = FILE_ROWS, *, time: str = "code_occur_time") -> None:
    """Adds `logs` to the stream's source folder: ranges of `time`, each as files of at most `most` rows in order of time. A
    range is a task, so the files of a load come in any order; a reader's delay has to cover what one load spans."""
    ranges = logs.repartitionByRange(time).sortWithinPartitions(time)
    ranges.write.mode("append").option("maxRecordsPerFile", most).parquet(path)


def read_logs(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1, *, bytes_per_batch: int | None = None) -> DataFrame:
    """Stream of the files below `path`, at most `files_per_batch` of them in a micro-batch; with `bytes_per_batch`
    as many as have that size, one at least. A batch costs seconds of its own, so a long history is read by size."""
    most = ("maxFilesPerTrigger", files_per_batch) if bytes_per_batch is None else ("maxBytesPerTrigger", bytes_per_batch)
    return spark.readStream.schema(schema).option(*most).parquet(path)


class LateRows(RuntimeError):
    """Rows came after the watermark and were not taken in."""


#: Settings that a keyed stream starts with: a store for its kinds of state, and the progress of every batch.
KEYED = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.numRecentProgressUpdates": "1000000",
}


@contextmanager
def keyed_state(spark: SparkSession):
    """KEYED while a query starts; what was set before is set again."""
    before = {name: spark.conf.get(name, None) for name in KEYED}
    for name, value in KEYED.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def run_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes all input that is there, adds it to the table at `path` and stops. Raises LateRows where rows came
    later than the watermark; what was processed stays."""
    with keyed_state(stream.sparkSession):
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    late = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    if late:
        raise LateRows(f"{late} rows came after the watermark; read them with a longer delay")
