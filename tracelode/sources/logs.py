"""Scans of message tables by time window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.functions import dose, root_cause


def day_window(target: date | None = None, start: datetime | None = None, end: datetime | None = None) -> tuple[datetime, datetime]:
    """A half-open window: one day, or the given bounds; a window that is empty or open raises."""
    if target is not None:
        start = datetime(target.year, target.month, target.day)
        end = start + timedelta(days=1)
    if start is None or end is None:
        raise ValueError("a day, or both a start and an end, are needed")
    if start >= end:
        raise ValueError("the start must be before the end")
    return start, end


def in_window(logs: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= code_occur_time < end, as a filter that reaches the scan. A table with an
    event_date column is filtered by it too, so that only the window's days are listed."""
    time = F.col("code_occur_time")
    kept = logs.where((time >= F.lit(start)) & (time < F.lit(end)))
    if "event_date" in logs.columns:
        last = (end - timedelta(microseconds=1)).date()
        kept = kept.where(F.col("event_date").between(F.lit(start.date()), F.lit(last)))
    return kept


def scan_dose_logs(logs: DataFrame, start: datetime, end: datetime, codes: Sequence[str] = dose.TARGET_CODES) -> DataFrame:
    """The columns that the dose parser needs, in the window, with exactly these codes."""
    return in_window(logs, start, end).where(F.col("code").isin(*codes)).select(*dose.SOURCE_COLUMNS)


def scan_root_cause_logs(logs: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """The columns that the root-cause parser needs, in the window, of any code."""
    return in_window(logs, start, end).select(*root_cause.SOURCE_COLUMNS)


def select(spark: SparkSession, sql: str, params: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """A SELECT with named :parameters over {frames}."""
    return spark.sql(sql, args=dict(params or {}), **frames)


def from_database(spark: SparkSession, url: str, table: str, *, fetch: int = 10_000, split_by: tuple | None = None, **options) -> DataFrame:
    """A JDBC table, `fetch` rows a round trip; split_by = (column, lower, upper, parts) reads in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch).options(**options)
    if split_by:
        column, lower, upper, parts = split_by
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load()
