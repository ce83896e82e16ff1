"""Exact top-k inner products by a three-phase uniform threshold.

A vector is dealt over a few blocks of components, and each block's parts are rows of their own: a
block's local score is its part of the inner product, and no task sees more than its own block's.

Phase one gathers, per query and block, the highest local scores of every task; these few candidates
are scored whole, and the k-th best total is a cutoff t that the answer cannot fall below. Phase two
sends the cutoffs to all tasks. Of m parts that sum to t one is at least t / m, so only entries above
this uniform threshold are sent back; of these, entries that cannot reach t with any other parts
of their vectors' lengths stay as well. Phase three adds up what came, fetches by row the parts that did not
come, and ranks the totals that reach the cutoff.

Queries go out in blocks of bounded size, so neither the driver nor a task ever holds more than a
block's queries and their k best entries of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracelode.llm.common import cut, map_arrow
from tracelode.sources.scratch import scratch_dir

#: Queries that one pass over the candidates serves; they are broadcast.
QUERY_BLOCK = 2048
#: Parts that are scored at a time; scores of a step take QUERY_BLOCK x STEP x 8 bytes.
STEP = 1024
#: Parts that a vector is dealt into.
BLOCKS = 2

NONE = np.iinfo(np.int64).min


def usable(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v): ids and integer vectors of the rows that take part."""
    whole = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & whole).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"),
    )


def without_spare_copies(rows: DataFrame, k: int) -> DataFrame:
    """`rows` without copies that no answer can hold: of equal vectors the ones of the k + 1 smallest ids stay
    (one may be the query's own), and k rows of each id. Tasks drop theirs before the exchange, so a
    vector that very many rows share is neither a hot key nor very many ties at a cutoff."""
    same = [F.xxhash64("v"), F.col("v")]
    ids = F.dense_rank().over(W.partitionBy(*same).orderBy("vec_id"))
    few = rows.withColumn("nth", ids).where(F.col("nth") <= k + 1)
    again = F.row_number().over(W.partitionBy(*same, "vec_id").orderBy("vec_id"))
    return few.withColumn("nth", again).where(F.col("nth") <= k).select("vec_id", "v")


def dealt(rows: DataFrame) -> DataFrame:
    """(rid, vec_id, dim, block, part, rest) of usable() rows: one row for each block; rest is the length of
    the vector's other parts. Written once, so that row numbers hold."""
    numbered = rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", F.size("v").alias("dim"), "v")
    edge = lambda i: F.expr(f"dim * {i} div {BLOCKS}").cast("int")
    parts = F.array(
        *[
            F.struct(F.lit(i).alias("block"), F.slice("v", edge(i) + 1, edge(i + 1) - edge(i)).alias("part"))
            for i in range(BLOCKS)
        ]
    )
    squares = lambda x: F.aggregate(x, F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    each = numbered.select("rid", "vec_id", "dim", squares(F.col("v")).alias("whole"), F.explode(parts).alias("p"))
    rest = F.sqrt(F.greatest(F.col("whole") - squares(F.col("p.part")), F.lit(0.0)))
    return cut(each.select("rid", "vec_id", "dim", "p.block", "p.part", rest.alias("rest")))


class Queries:
    """Parts of one block of one dimension's queries, ready to score candidates' parts."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, rest: np.ndarray):
        self.ids, self.matrix, self.rest = ids, matrix, rest
        self.top = int(np.abs(matrix).max(initial=0))
        self.real = matrix.astype(np.float64)

    def score(self, matrix: np.ndarray) -> np.ndarray:
        """Local scores, exact: doubles while every sum stays below 2^53, else integers."""
        exact = self.top * int(np.abs(matrix).max(initial=0)) * max(matrix.shape[1], 1) < 2**53
        if exact:
            return (self.real @ matrix.astype(np.float64).T).astype(np.int64)
        return self.matrix @ matrix.T


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """((dim, block), rid, vec_id, parts, rest) of each dimension and block in a batch of dealt() rows."""
    rid, vec, dim, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
    part, rest = batch.column(4), batch.column(5).to_numpy(zero_copy_only=False)
    size = part.value_lengths().to_numpy(zero_copy_only=False)
    flat = part.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for key in sorted(set(zip(dim.tolist(), block.tolist(), strict=True))):
        rows = np.flatnonzero((dim == key[0]) & (block == key[1]))
        for at in range(0, len(rows), STEP):
            some = rows[at : at + STEP]
            yield key, rid[some], vec[some], flat[start[some][:, None] + np.arange(size[some[0]])], rest[some]


SCHEMA = pa.schema([("query_id", pa.int64()), ("block", pa.int32()), ("rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _entries(q: np.ndarray, block: int, rid: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(np.int64)) for x in (q,)]
        + [pa.array(np.full(len(q), block, np.int32))]
        + [pa.array(x.astype(np.int64)) for x in (rid, vec, score)],
        schema=SCHEMA,
    )


def _gather(batches: Iterator[pa.RecordBatch], queries: dict[tuple[int, int], Queries], k: int) -> Iterator[pa.RecordBatch]:
    """Phase one, one task: per query and block the k entries of highest local score."""
    kept = {key: tuple(np.full((len(q.ids), k), NONE, np.int64) for _ in range(3)) for key, q in queries.items()}
    for batch in batches:
        for key, rid, vec, matrix, _ in _parts(batch):
            if (q := queries.get(key)) is None:
                continue
            score = q.score(matrix)
            score[q.ids[:, None] == vec[None, :]] = NONE
            held = kept[key]
            both = np.concatenate([held[0], score], axis=1)
            best = np.argpartition(both, -k, axis=1)[:, -k:]
            fill = [np.concatenate([old, np.broadcast_to(new, score.shape)], axis=1) for old, new in ((held[1], rid), (held[2], vec))]
            kept[key] = tuple(np.take_along_axis(x, best, 1) for x in (both, *fill))
    for key, (score, rid, vec) in kept.items():
        q, at = np.nonzero(score > NONE)
        yield _entries(queries[key].ids[q], key[1], rid[q, at], vec[q, at], score[q, at])


def _above(batches: Iterator[pa.RecordBatch], queries: dict[tuple[int, int], Queries], cutoffs: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Phase two, one task: entries that reach their share of the cutoff, and can reach all of it with
    parts of the lengths that the others have. Queries without a cutoff take all."""
    bounds = {key: np.array([cutoffs.get(i, NONE) for i in q.ids.tolist()], np.int64) for key, q in queries.items()}
    for batch in batches:
        for key, rid, vec, matrix, rest in _parts(batch):
            if (q := queries.get(key)) is None:
                continue
            score, least = q.score(matrix), bounds[key][:, None]
            # A little over the exact product, for the rounding of square roots.
            most = score + np.multiply.outer(q.rest, rest) * (1 + 1e-9) + 1
            enough = ((score * BLOCKS >= least) & (most >= least)) | (least == NONE)
            enough &= q.ids[:, None] != vec[None, :]
            i, at = np.nonzero(enough)
            yield _entries(q.ids[i], key[1], rid[at], vec[at], score[i, at])


def _resolved(entries: DataFrame, parts: DataFrame, asked: DataFrame) -> DataFrame:
    """(query_id, vec_id, rid, score): whole scores of the rows that `entries` (query_id, block, rid,
    vec_id, score) name. Parts that no entry has are fetched by row and scored; no others are."""
    blocks = F.array(*[F.lit(i) for i in range(BLOCKS)])
    came = entries.groupBy("query_id", "rid", "vec_id").agg(F.sum("score").alias("score"), F.collect_set("block").alias("have"))
    came = cut(came.withColumn("lack", F.array_except(blocks, "have")).drop("have"))
    missing = came.where(F.size("lack") > 0).select("query_id", "rid", F.explode("lack").alias("block"))
    fetched = (
        missing.join(parts.select("rid", "block", "part"), ["rid", "block"])
        .join(F.broadcast(asked), ["query_id", "block"])
        .select(
            "query_id",
            "rid",
            F.aggregate(F.zip_with("part", "q_part", lambda x, y: x * y), F.lit(0).cast("long"), lambda a, x: a + x).alias("more"),
        )
        .groupBy("query_id", "rid")
        .agg(F.sum("more").alias("more"))
    )
    return came.join(fetched, ["query_id", "rid"], "left").select(
        "query_id", "vec_id", "rid", (F.col("score") + F.coalesce("more", F.lit(0))).alias("score")
    )


def exact_topk(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 1024,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product for each query.

    `is_query` is a condition on `vec_id`. Components become floor(scale * x). Ties go to the smaller
    vec_id. A query's own id is no candidate of it. Rows with a null id or a null vector, or with null
    or non-finite components, take no part; vectors of another dimension are no candidates. Queries
    repeated under one id count once (the least vector); candidates repeated count each. Fewer than k
    candidates give fewer rows; an empty table gives an empty one; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col, scale)
    queries = dealt(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")))
    parts = dealt(without_spare_copies(rows, k))
    n = queries.where("block = 0").count()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"), F.asc("rid"))
    found = scratch_dir(spark, "topk")
    rounds = max(1, -(-n // query_block))
    for i in range(rounds):
        here = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == i)
        asked = here.select(F.col("vec_id").alias("query_id"), "block", F.col("part").alias("q_part"))
        # At most query_block queries (about; they are dealt by a hash) come to the driver.
        table = here.select(F.lit(0).cast("long").alias("rid"), "vec_id", "dim", "block", "part", "rest").toArrow()
        made: dict[tuple[int, int], list] = {}
        for batch in table.to_batches():
            for key, _, ids, matrix, rest in _parts(batch):
                made.setdefault(key, []).append((ids, matrix, rest))
        groups = {key: tuple(np.concatenate(x) for x in zip(*each, strict=True)) for key, each in made.items()}
        sent = spark.sparkContext.broadcast(groups)

        def phase_one(batches, sent=sent):
            yield from _gather(batches, {key: Queries(*x) for key, x in sent.value.items()}, k)

        kinds = "query_id long, block int, rid long, vec_id long, score long"
        lists = map_arrow(parts, phase_one, kinds)
        local = W.partitionBy("query_id", "block").orderBy(F.desc("score"), F.asc("rid"))
        tops = lists.withColumn("r", F.row_number().over(local)).where(F.col("r") <= k).drop("r")
        whole = _resolved(tops, parts, asked)
        cutoffs = {
            r["query_id"]: r["cutoff"]
            for r in whole.withColumn("r", F.row_number().over(order))
            .where(F.col("r") == k)
            .select("query_id", F.col("score").alias("cutoff"))
            .collect()
        }
        limits = spark.sparkContext.broadcast(cutoffs)

        def phase_two(batches, sent=sent, limits=limits):
            yield from _above(batches, {key: Queries(*x) for key, x in sent.value.items()}, limits.value)

        whole = _resolved(map_arrow(parts, phase_two, kinds), parts, asked)
        ranked = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(found)
        sent.destroy()
        limits.destroy()
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(found)
