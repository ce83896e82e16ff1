"""Files taken in exactly once: each micro-batch is a folder of its own, and counts once a ledger has it.

A batch is written to its folder first, then its files and at last its entry in the ledger. A batch that
is run again before its entry finds its folder and replaces it; one that is run again after its entry
adds nothing. Readers see batches with an entry only. Sources are cleared by the stream itself, after it
has noted a batch as done, so after the entry.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.sources.scratch import is_written

ENTRY = "batch long, n_files long, files_sum decimal(38,0), n_rows long"


class AnotherStream(RuntimeError):
    """A batch of this number is in the ledger, with other files."""


def _folder(target: str, part: str, batch_id: int) -> str:
    return f"{target}/{part}/batch={batch_id}"


def _files_of(files: DataFrame) -> tuple[int, int]:
    """Number of the files and a checksum over their paths that no order changes."""
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("path").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], int(r["s"] or 0)


def _commit(spark: SparkSession, target: str, batch_id: int, n_files: int, files_sum: int) -> None:
    n_rows = spark.read.parquet(_folder(target, "rows", batch_id)).count()
    entry = spark.createDataFrame([(n_files, Decimal(files_sum), n_rows)], "n_files long, files_sum decimal(38,0), n_rows long")
    entry.coalesce(1).write.mode("overwrite").parquet(_folder(target, "entries", batch_id))


def write_batch(bodies: DataFrame, batch_id: int, target: str, parse: Callable[[DataFrame], DataFrame]) -> None:
    """Adds one micro-batch of `bodies` (source_file, ..) below `target`: the rows that `parse` makes of it, the
    files that it consumed, its entry. Does nothing where the entry is there; raises AnotherStream if that is of other
    files, as when a checkpoint was lost and numbers start anew."""
    spark = bodies.sparkSession
    consumed = bodies.select(F.col("source_file").alias("path")).distinct()
    if is_written(spark, _folder(target, "entries", batch_id)):
        n, total = _files_of(consumed)
        known = spark.read.parquet(_folder(target, "entries", batch_id)).first()
        if (n, total) != (known["n_files"], int(known["files_sum"])):
            raise AnotherStream(f"batch {batch_id} below {target} was made of other files")
        return
    parse(bodies).write.mode("overwrite").parquet(_folder(target, "rows", batch_id))
    consumed.write.mode("overwrite").parquet(_folder(target, "files", batch_id))
    _commit(spark, target, batch_id, *_files_of(spark.read.parquet(_folder(target, "files", batch_id))))


def ingest_once(stream: DataFrame, target: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame]) -> None:
    """Takes in all files that are there and stops; the next call goes on where this one, finished or not, ended."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda bodies, batch_id: write_batch(bodies, batch_id, target, parse))
        .start()
    )
    query.awaitTermination()


def entries(spark: SparkSession, target: str) -> DataFrame:
    """The ledger: one row for each batch that counts."""
    return spark.read.schema(ENTRY).parquet(f"{target}/entries")


def _counted(spark: SparkSession, target: str, part: str) -> DataFrame:
    # The batch is the folder, so the folders of other batches are not opened.
    return spark.read.parquet(f"{target}/{part}").join(entries(spark, target).select("batch"), "batch", "left_semi")


def rows(spark: SparkSession, target: str) -> DataFrame:
    """All rows of batches that count, with their batch."""
    return _counted(spark, target, "rows")


def consumed(spark: SparkSession, target: str) -> DataFrame:
    """(path, batch) of every file that was taken in: the `processed` of ledger.unprocessed()."""
    return _counted(spark, target, "files")
