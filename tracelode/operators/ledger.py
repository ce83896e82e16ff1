"""Ledgers as DataFrames: each operation takes the ledger and gives its next state.

A ledger has one row for each source_file. Times of creation and change are parameters, so that a
repeated run gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "source_file"
MATCH = ("matched_text_file", "matched_text_ts", "matched_diff_seconds")
COLUMNS = (KEY, "prefix", "image_ts", *MATCH, "output_remote_file", "created_at", "updated_at")


def _now(now: Column | None) -> Column:
    return F.current_timestamp().cast("timestamp_ntz") if now is None else now


def upsert(ledger: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """New keys are added; known ones take all match fields of `new` (nulls too), keep created_at and get
    updated_at."""
    fields = ("prefix", "image_ts", *MATCH, "output_remote_file")
    mine = new.select(KEY, *[F.col(c).alias(f"_n_{c}") for c in fields], F.lit(True).alias("_new"))
    met = ledger.withColumn("_old", F.lit(True)).join(mine, KEY, "full")
    fresh = F.col("_new")
    return met.select(
        KEY,
        *[F.when(fresh, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in fields],
        F.when(F.col("_old"), F.col("created_at")).otherwise(_now(now)).alias("created_at"),
        F.when(fresh & F.col("_old"), _now(now)).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def insert_if_absent(ledger: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """Keys of `new` (source_file, prefix, image_ts) that the ledger lacks are added; others stay untouched."""
    absent = new.dropDuplicates([KEY]).join(ledger.select(KEY), KEY, "left_anti")
    kinds = dict(ledger.dtypes)
    empty = {c: F.lit(None).cast(kinds[c]) for c in (*MATCH, "output_remote_file", "updated_at")}
    return ledger.unionByName(absent.select(KEY, "prefix", "image_ts").withColumns(empty).withColumn("created_at", _now(now)))


def update_match(ledger: DataFrame, found: DataFrame, now: Column | None = None) -> DataFrame:
    """Known keys take the match fields of `found`."""
    mine = found.select(KEY, *[F.col(c).alias(f"_n_{c}") for c in MATCH], F.lit(True).alias("_hit"))
    met = ledger.join(mine, KEY, "left")
    hit = F.coalesce("_hit", F.lit(False))
    new = {c: F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(c)) for c in MATCH}
    return met.withColumns(new | {"updated_at": F.when(hit, _now(now)).otherwise(F.col("updated_at"))}).select(*COLUMNS)


def finalize(ledger: DataFrame, outputs: DataFrame, now: Column | None = None) -> DataFrame:
    """Known keys take their output file from `outputs` (source_file, output_remote_file)."""
    mine = outputs.select(KEY, F.col("output_remote_file").alias("_out"))
    met = ledger.join(mine, KEY, "left")
    hit = F.col("_out").isNotNull()
    return met.withColumns(
        {
            "output_remote_file": F.coalesce("_out", "output_remote_file"),
            "updated_at": F.when(hit, _now(now)).otherwise(F.col("updated_at")),
        }
    ).select(*COLUMNS)


def remove(ledger: DataFrame, unmatched: DataFrame) -> DataFrame:
    """Rows of images without a text go, also those that an earlier run had completed."""
    return ledger.join(unmatched.select(KEY), KEY, "left_anti")


def apply_run(ledger: DataFrame, run: DataFrame, now: Column | None = None) -> DataFrame:
    """insert_if_absent(), update_match(), remove() and finalize() of one run in one join. `run` has one row for
    each source_file: prefix, image_ts, the match fields (all null: no match, the row goes) and
    output_remote_file (null: none yet)."""
    fields = ("prefix", "image_ts", *MATCH, "output_remote_file")
    mine = run.select(KEY, *[F.col(c).alias(f"_n_{c}") for c in fields], F.lit(True).alias("_run"))
    met = ledger.withColumn("_old", F.lit(True)).join(mine, KEY, "full")
    kept = met.where(F.col("_run").isNull() | F.col("_n_matched_text_file").isNotNull())
    known = F.col("_old").isNotNull()
    new = {c: F.when(known, F.col(c)).otherwise(F.col(f"_n_{c}")) for c in ("prefix", "image_ts")}
    new |= {c: F.when(F.col("_run"), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in MATCH}
    new["output_remote_file"] = F.coalesce("_n_output_remote_file", "output_remote_file")
    new["created_at"] = F.when(known, F.col("created_at")).otherwise(_now(now))
    new["updated_at"] = F.when(F.col("_run"), _now(now)).otherwise(F.col("updated_at"))
    return kept.select(KEY, *[new[c].alias(c) for c in COLUMNS if c != KEY])


def unprocessed(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files that no earlier run has consumed."""
    return files.join(processed.select("path"), "path", "left_anti")
