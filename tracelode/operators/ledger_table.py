"""A ledger as a keyed table: rows lie in buckets by their key, and a run touches only its own buckets.

The table is a folder partitioned by bucket. A run's keys tell which buckets it can change; only these
are read, joined with the run and written anew, each replacing its old files when the job commits. Every bucket holds
one row without a key, so that a bucket whose last row goes is replaced too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.operators.ledger import KEY
from tracelode.sources.scratch import written

BUCKETS = 256

Operation = Callable[..., DataFrame]


class LedgerTable:
    """The ledger at `path`, a folder that one run at a time changes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        stored = spark.read.parquet(path)
        self.schema = stored.schema
        first = stored.select("buckets").first()
        if first is None:
            raise ValueError(f"no ledger at {path}")
        self.buckets: int = first["buckets"]
        self.columns = [c for c in stored.columns if c not in ("buckets", "bucket")]

    @classmethod
    def create(cls, ledger: DataFrame, path: str, buckets: int = BUCKETS) -> LedgerTable:
        """A new table of the rows of `ledger`; the number of buckets is for good. Rows without a key are refused."""
        if buckets < 1:
            raise ValueError(f"{buckets} buckets")
        spark = ledger.sparkSession
        kept = ledger.where(F.col(KEY).isNotNull()).withColumn("bucket", cls._bucket(buckets))
        cls._put(kept, spark.range(buckets).select(F.col("id").cast("int").alias("bucket")), path, buckets, "errorifexists")
        return cls(spark, path)

    @staticmethod
    def _bucket(buckets: int) -> Column:
        return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")

    @staticmethod
    def _put(rows: DataFrame, marked: DataFrame, path: str, buckets: int, mode: str) -> None:
        """Writes `rows`, and the row without a key of each bucket in `marked`; in mode overwrite these buckets alone."""
        every = rows.unionByName(marked, allowMissingColumns=True).withColumn("buckets", F.lit(buckets))
        writer = every.hint("rebalance", "bucket").sortWithinPartitions("bucket", KEY).write.mode(mode)
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("buckets", "bucket").parquet(path)

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).where(F.col("buckets") == self.buckets)

    def read(self) -> DataFrame:
        """All rows of the ledger."""
        return self._stored().where(F.col(KEY).isNotNull()).select(*self.columns)

    def in_buckets(self, touched: list[int]) -> DataFrame:
        """Rows of these buckets; the others' files are not opened."""
        return self._stored().where(F.col("bucket").isin(touched) & F.col(KEY).isNotNull()).select(*self.columns)

    def touched(self, run: DataFrame) -> list[int]:
        """Buckets of the keys of `run`: at most as many numbers as there are buckets."""
        rows = run.where(F.col(KEY).isNotNull()).select(self._bucket(self.buckets).alias("bucket")).distinct().collect()
        return sorted(r["bucket"] for r in rows)

    def apply(self, operation: Operation, run: DataFrame, *now: Column) -> list[int]:
        """Changes the table by an operation of tracelode.operators.ledger, with what a run brings for its keys: upsert,
        insert_if_absent, update_match, finalize, remove or apply_run. Gives the buckets that were written.

        Rows of `run` without a key, or with a key on several rows, are the caller's to remove; an empty run writes nothing. A
        run that ends before its commit changes nothing, and is simply run again.
        """
        run = written(run.where(F.col(KEY).isNotNull()))
        touched = self.touched(run)
        if touched:
            new = operation(self.in_buckets(touched), run, *now).select(*self.columns).withColumn("bucket", self._bucket(self.buckets))
            marked = self.spark.createDataFrame([(b,) for b in touched], "bucket int")
            self._put(new, marked, self.path, self.buckets, "overwrite")
        return touched
