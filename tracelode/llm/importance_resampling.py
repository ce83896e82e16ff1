"""Importance resampling of documents towards a target's distribution of hashed word n-grams.

Every n-gram falls into one of a fixed number of buckets by its CRC-32, which crc_prefix.py derives
from two running CRCs of the document. The documents are scanned once; what a document's n-grams
fell into is kept as bucket numbers. Counts for each bucket, over all documents and over all target texts,
give the bucket's gain, a document weighs the sum of its gains, and the documents of the highest weight plus
Gumbel noise are drawn, which is drawing without replacement by those weights.

Only the counts for each bucket (as many as there are buckets) and for each range of scores meet on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from tracelode.llm.common import cut, map_arrow, named
from tracelode.llm.crc_prefix import run_crcs, running

BUCKETS = 10_000
#: Lengths of the n-grams, the least and the most.
RUNS = (1, 1)
#: Documents with fewer words are weighed but not drawn.
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Words whose n-grams are worked on at a time; a longer document is a step by itself.
STEP_WORDS = 500_000


def _steps(texts: pa.Array) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    held, size = [], 0
    for text in texts:
        found = running(text.as_py())
        if held and size + len(found[0]) > STEP_WORDS:
            yield held
            held, size = [], 0
        held.append(found)
        size += len(found[0])
    if held:
        yield held


def bucketed(texts: pa.Array, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the n-grams) of each text; texts are bytes, null counts as empty."""
    kind = np.dtype("<u2") if buckets <= 65_536 else np.dtype("<u4")
    for held in _steps(texts):
        counts = [len(c) for c, _ in held]
        doc = np.repeat(np.arange(len(held)), counts)
        crc, end = (np.concatenate(x) for x in zip(*held, strict=True))
        each = [run_crcs(crc, end, doc, n) for n in range(runs[0], runs[1] + 1)]
        found, where = (np.concatenate(x) for x in zip(*each, strict=True))
        found = (found % np.uint32(buckets)).astype(kind)
        if len(each) > 1:
            order = np.argsort(where, kind="stable")
            found, where = found[order], where[order]
        edges = np.searchsorted(where, np.arange(1, len(held)))
        yield from zip(counts, np.split(found, edges), strict=True)


def features(
    docs: DataFrame, carried: dict[str, Column], *, text_col: str = "text", runs: tuple[int, int] = RUNS, buckets: int = BUCKETS
) -> DataFrame:
    """(carried.., n_words, n_features, buckets) of each row: bucket numbers as little-endian unsigned integers of
    two bytes, or of four where there are more than 65536 buckets."""

    names = [*carried, "n_words", "n_features", "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sizes, found = [], [], []
            for n, each in bucketed(batch.column(0), runs, buckets):
                words.append(n)
                sizes.append(len(each))
                found.append(each.tobytes())
            columns = [*batch.columns[1:], pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = docs.select(named(text_col).cast("binary").alias("_text"), *[c.alias(n) for n, c in carried.items()])
    schema = StructType(narrow.schema.fields[1:])
    for name, kind in (("n_words", LongType()), ("n_features", LongType()), ("buckets", BinaryType())):
        schema = schema.add(name, kind)
    return map_arrow(narrow, run, schema)


def _numbers(column: pa.Array, buckets: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2" if buckets <= 65_536 else "<u4")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of features() fell into each bucket. Tasks count theirs first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            counts += np.bincount(_numbers(batch.column(0), buckets), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["bucket", "n"])

    parts = map_arrow(found.select("buckets"), run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    # One row for each bucket at most.
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source share for each bucket, one added to every count."""
    n = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(found: DataFrame, gain: np.ndarray, kept: Sequence[str]) -> DataFrame:
    sent = found.sparkSession.sparkContext.broadcast(gain)
    n, kept = len(gain), list(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(len(kept) + 1).to_numpy(zero_copy_only=False)
            total = np.concatenate([[0], np.cumsum(sent.value[_numbers(batch.column(len(kept) + 2), n)])])
            stop = np.cumsum(sizes)
            weight = total[stop] - total[stop - sizes]
            columns = [*batch.columns[: len(kept) + 2], pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "n_features", "weight"])

    return map_arrow(found, run, StructType(found.schema.fields[:-1]).add("weight", LongType()))


def noise(id_: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths by the id's SHA-256; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: Sequence[Column], most: int) -> DataFrame:
    """`rows` with `rank`, their place (from 1) in `order` where that is within `most`, else null. Rows are dealt over
    ranges of the order; a place is the rows of the ranges before, plus that in the own range."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The id holds the range in its upper bits and the place in it in the lower 33.
    placed = cut(placed.select("*", F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", 33).cast("int")
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append((p, total))
        total += sizes.get(p, 0)
    # One row for each range.
    starts = spark.createDataFrame(before, "_p int, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND(2**33 - 1) + 1
    met = placed.withColumn("_p", part).join(F.broadcast(starts), "_p")
    return met.select(*rows.columns, F.when(place <= most, place).alias("rank"))


def importance_resampling(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    runs: tuple[int, int] = RUNS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    whole_rows: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_features, weight, score and rank (1 for the highest score; null where
    it is not drawn); with `whole_rows` also `row`, the row itself as a struct.

    `percent` of the documents that have `least_words` words are drawn, rounded down, by score; ties go to the smaller id
    (nulls last), then to fewer features, then to whichever row comes first. Null text counts as empty and weighs 0;
    a null id has the noise of an empty one; repeated rows are drawn each for itself; without target
    texts all gains come from the documents alone; an empty table gives an empty one; other columns are ignored,
    whatever they are called.
    """
    if not 1 <= runs[0] <= runs[1]:
        raise ValueError(f"lengths of n-grams from {runs[0]} to {runs[1]}")
    carried = {"doc_id": named(id_col)}
    if whole_rows:
        carried["row"] = F.struct(*map(named, docs.columns))
    found = cut(features(docs, carried, text_col=text_col, runs=runs, buckets=buckets))
    wanted = features(target, {}, text_col=target_col, runs=runs, buckets=buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    scored = _weighed(found, gain, list(carried)).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = cut(scored.withColumn("_row", F.monotonically_increasing_id()))
    can = F.col("n_words") >= least_words
    most = percent * scored.where(can).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("_row")]
    out = ["doc_id", "n_features", "weight", "score", "rank", *(["row"] if whole_rows else [])]
    drawn = ranked(scored.where(can), order, most).select(*out)
    return drawn.union(scored.where(~can).withColumn("rank", F.lit(None).cast("long")).select(*out))


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that importance_resampling() draws, with all their columns."""
    found = importance_resampling(docs, target, whole_rows=True, **options)
    return found.where("rank is not null").select("row.*")
