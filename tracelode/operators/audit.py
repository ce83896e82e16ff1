"""Audits of source and result tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.functions import dose
from tracelode.sources.logs import in_window, scan_dose_logs
from tracelode.sources.scratch import written

#: The columns that tell a message.
JOIN_KEYS = ("er_date", "er_index", "er_line", "eq_name", "code", "code_occur_time")


def missing_from_parsed(logs: DataFrame, parsed: DataFrame, start: datetime, end: datetime, *, null_safe: bool = False) -> DataFrame:
    """Source rows of the window without a result row, with the handle as the text has it. Plain equality:
    rows with a null key are always missing, unless `null_safe`."""
    return _reported(_without(scan_dose_logs(logs, start, end), parsed, null_safe))


def _without(rows: DataFrame, parsed: DataFrame, null_safe: bool) -> DataFrame:
    keys = parsed.select(*[F.col(c).alias(f"_p_{c}") for c in JOIN_KEYS])
    same = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) if null_safe else F.col(c) == F.col(f"_p_{c}") for c in JOIN_KEYS]
    return rows.join(keys, same, "left_anti")


def _reported(rows: DataFrame) -> DataFrame:
    # Fixed value: the pattern of a handle in a text.
    handle = F.nullif(F.regexp_extract("contents", r"exposure_handle\s*[:=]\s*([0-9]+)", 1), F.lit(""))
    return rows.select(*dose.SOURCE_COLUMNS[:-1], handle.alias("exposure_handle_raw"), "contents").orderBy(
        "eq_name", "code_occur_time", "er_date", "er_index"
    )


def _sums(rows: DataFrame) -> DataFrame:
    """(day, machine, n, a, b): for each day and machine the number of rows and two checksums of their keys, which no
    order changes."""
    one, two = F.xxhash64(*JOIN_KEYS), F.xxhash64(F.lit(1), *JOIN_KEYS)
    return rows.groupBy(F.to_date("code_occur_time").alias("day"), F.col("eq_name").alias("machine")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("a"), F.bit_xor(two).alias("b")
    )


def differing_groups(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """(day, machine) of `rows` where `parsed` does not have the same keys as often. Both sides are added up before
    they are exchanged: a row for each task, day and machine."""
    there = _sums(parsed).select(*[F.col(c).alias(f"_p_{c}") for c in ("day", "machine", "n", "a", "b")])
    met = _sums(rows).join(there, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in ("day", "machine")], "left")
    same = F.col("_p_n").isNotNull() & (F.col("n") == F.col("_p_n")) & F.col("a").eqNullSafe(F.col("_p_a")) & (F.col("b") == F.col("_p_b"))
    return met.where(~same).select("day", "machine")


def missing_by_groups(logs: DataFrame, parsed: DataFrame, start: datetime, end: datetime, *, null_safe: bool = False) -> DataFrame:
    """missing_from_parsed() by reconciliation: only the days and machines whose counts or checksums differ are
    compared row by row, so what is exchanged grows with them and not with the tables. The sums read the keys alone."""
    rows = scan_dose_logs(logs, start, end)
    parsed = in_window(parsed, start, end)
    told = reduce(and_, [F.col(c).isNotNull() for c in JOIN_KEYS])
    whole, known = (rows, parsed) if null_safe else (rows.where(told), parsed.where(told))
    differ = written(differing_groups(whole, known))

    def among(some: DataFrame) -> DataFrame:
        group = (F.to_date("code_occur_time").eqNullSafe(F.col("day"))) & F.col("eq_name").eqNullSafe(F.col("machine"))
        return some.join(differ, group, "left_semi")

    missing = _without(among(whole), among(known), null_safe)
    # A null key equals none.
    return _reported(missing if null_safe else missing.union(rows.where(~told)))


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on more than one row, with their count."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_nulls) of columns that must not be null, in one pass."""
    counts = rows.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counts.select(F.expr(f"stack({len(columns)}, {', '.join(f"'{c}', `{c}`" for c in columns)}) as (column_name, n_nulls)"))


def run_summary(rows: DataFrame, kept: str, keys: Sequence[str]) -> DataFrame:
    """(fetched, parsed, inserted) as one row, in one pass over a run's rows: all of them, those that column
    `kept` marks, and of these the ones that differ in `keys`. Repeats are counted before the exchange."""
    each = rows.groupBy(F.coalesce(kept, F.lit(False)).alias("_kept"), *keys).agg(F.count(F.lit(1)).alias("_n"))
    sums = {
        "fetched": F.sum("_n"),
        "parsed": F.sum(F.when(F.col("_kept"), F.col("_n"))),
        "inserted": F.count(F.when(F.col("_kept"), 1)),
    }
    return each.agg(*[F.coalesce(n, F.lit(0)).cast("long").alias(name) for name, n in sums.items()])


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """(outcome, n_files)."""
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_files"))
