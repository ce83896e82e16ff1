"""SimHash near-duplicates by multi-index hashing.

Fingerprints have 64 bits, cut in two segments of 32. Two fingerprints that differ in at most
three bits have a segment that differs in at most one. So each fingerprint enumerates the ball of
radius one around each of its segments, fetches the table entries with exactly such a segment and
verifies the whole distance.

Copies meet in one fingerprint before any search. A table entry that very many fingerprints share
is not searched in pairs. There the search goes over points of the other segment instead: all
members within one bit of a point are within two of each other, so each is linked to the least of
them; so is every member two bits from the point, and every fingerprint whose segment differs in
one bit and whose other segment is within one bit of the point. All these links hold, and every
pair within the limit is joined by such links, so components come out the same while the work
grows with the members and not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import cut, map_arrow, wrapped
from tracelode.llm.components import connected_components

#: The method's distances: three bits over two segments leave one for the better of them.
MAX_BITS = 3
#: Table entries with more fingerprints than this are searched by points, not in pairs.
PAIRED = 400

#: BITS[x, i]: bit i of byte x.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """Fingerprint of one text, as a signed long."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(width)), strict=False) if len(words) >= width else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(run), 42) for run in runs), np.uint64)
    place = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    counts = np.bincount(place.ravel(), minlength=2048).reshape(8, 256) @ BITS
    set_bits = np.packbits(2 * counts.ravel() > len(hashes), bitorder="little")
    return int(set_bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, text_key, fp) for every row: text_key is the text's MD5, fp a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), width) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())],
                names=["doc_id", "text_key", "fp"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.md5(text).alias("text_key"), text.alias("text"))
    return map_arrow(narrow, run, f"doc_id {kind}, text_key string, fp long")


def _half(fp: Column, segment: int) -> Column:
    """Segment 0 or 1 of a fingerprint, as a long below 2^32."""
    return F.shiftrightunsigned(fp, 32) if segment else fp.bitwiseAND(0xFFFFFFFF)


def _ball(key: Column, *radii: int) -> Column:
    """All 32-bit keys at the given distances (0, 1, 2) from `key`, as an array."""
    masks = [sum(1 << b for b in bits) for r in radii for bits in combinations(range(32), r)]
    listed = F.transform(F.split(F.lit(",".join(map(str, masks))), ","), lambda m: m.cast("long"))
    return F.transform(listed, lambda m: key.bitwiseXOR(m))


def links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Pairs (u, v) of the distinct fingerprints `prints.fp` within three bits, enough of them that
    components are those of all such pairs."""
    table = cut(
        prints.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("seg"), _half(F.col("fp"), 0).alias("key")), F.struct(F.lit(1).alias("seg"), _half(F.col("fp"), 1).alias("key")))).alias("s"))
        .select("fp", "s.seg", "s.key")
    )
    crowded = cut(table.groupBy("seg", "key").count().where(F.col("count") > paired).select("seg", "key"))
    some_crowded = bool(crowded.take(1))
    probes = table.select("fp", "seg", F.explode(_ball(F.col("key"), 0, 1)).alias("key"))
    entries = table.join(crowded, ["seg", "key"], "left_anti") if some_crowded else table
    found = (
        probes.select(F.col("fp").alias("u"), "seg", "key")
        .join(entries.select(F.col("fp").alias("v"), "seg", "key"), ["seg", "key"])
        .where("u > v and bit_count(u ^ v) <= 3")
        .select("u", "v")
    )
    if not some_crowded:
        return found

    other = F.when(F.col("seg") == 0, _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0))
    inside = table.join(crowded, ["seg", "key"], "left_semi").withColumn("other", other)
    beside = (
        table.select("fp", "seg", F.explode(_ball(F.col("key"), 1)).alias("key"))
        .join(crowded, ["seg", "key"], "left_semi")
        .withColumn("other", other)
    )

    def at_points(members: DataFrame, *radii: int) -> DataFrame:
        return members.select("fp", "seg", "key", F.explode(_ball(F.col("other"), *radii)).alias("point"))

    near = at_points(inside, 0, 1)
    chosen = cut(near.groupBy("seg", "key", "point").agg(F.min("fp").alias("v")))
    around = near.union(at_points(inside, 2)).union(at_points(beside, 0, 1))
    starred = (
        around.join(chosen.hint("merge"), ["seg", "key", "point"])
        .where("fp <> v")
        .select(F.col("fp").alias("u"), "v")
    )
    return found.union(starred)


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, paired: int = PAIRED
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_key, fp, component_id (the smallest doc_id of the
    texts that links of three or fewer bits reach) and component (the group's smallest fingerprint).

    Null text counts as empty; texts without words have fingerprint zero and are linked like any
    other; rows of null id are grouped but never name a component (a component of nulls only has
    a null id); repeated rows each give a row; an empty table gives an empty one.
    """
    rows = cut(fingerprints(docs, id_col=id_col, text_col=text_col, width=width))
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = connected_components(links(prints, paired))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = cut(rooted)
    named = cut(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    labels = cut(rooted.join(named.hint("merge"), "root").select("fp", "root", "component_id"))
    return rows.join(labels.hint("merge"), "fp").select(
        "doc_id", "text_key", "fp", "component_id", F.col("root").alias("component")
    )


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one row of each near-duplicate group: the one with the smallest doc_id, all columns
    kept, whatever they are called. Of repeated rows of that id in the group one stays; rows of null id
    stay only if their group has no other (one row of it then). Null text counts as empty; an empty table
    gives an empty one."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    best = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component")
        .agg(F.first("doc_id").alias("keep_id"), F.min("text_key").alias("keep_key"), F.count(F.lit(1)).alias("n"))
    )
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("key") == F.col("keep_key"))
    kept = wrapped(docs, id_col, text_col).join(best, same)
    once = kept.where("n = 1").select("row.*")
    more = kept.where("n > 1").dropDuplicates(["component"]).select("row.*")
    return once.union(more)
