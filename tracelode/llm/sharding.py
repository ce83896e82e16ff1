"""Sharding by fixed virtual slots.

A record's id is hashed into one of a few thousand slots, for good. Records without an id, and those
of an id that alone outweighs a mean slot, are spread by id, checksum and, where these are equal too,
by blocks of equal records; as that depends on the table, such records can change slots when it grows. Bytes are summed per slot. A stored, versioned map says which shard holds
a slot. Its first version deals the slots in turn, before any record is known. Rebalancing reads the
latest version, moves slots from shards that are too heavy to light ones, leaves all others where
they are, and stores the result as the next version; more shards than before, or fewer, are the same edit.
Only the sums per slot (as many as there are slots) meet on the driver.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracelode.llm.common import cut
from tracelode.sources.scratch import scratch_dir

SLOTS = 4096
#: Share of the mean that a shard may be off it before slots move.
SLACK = 0.001


def slot_of(id_col: Column, slots: int = SLOTS) -> Column:
    """Virtual slot of a record; ids are hashed as text, null as empty text."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


#: Records equal in id, size and checksum that are kept together in a slot, at most.
BLOCK = 1000


def spread_slot(id_col: Column, text_crc32: Column, block: Column, slots: int = SLOTS) -> Column:
    """Virtual slot of a record whose id does not tell enough."""
    return slot_of(F.concat_ws("/", id_col.cast("string"), text_crc32.cast("string"), block.cast("string")), slots)


def _exchange(heavy: list[int], light: list[int], loads: dict[int, int], gap: int) -> tuple[int, int] | None:
    """Where every slot of the heavy shard is too large to move: the slot of it, and the one of the light shard
    for it, that narrow `gap` most. None where no exchange narrows it."""
    by_load = sorted(light, key=lambda s: (loads.get(s, 0), s))
    sizes = [loads.get(s, 0) for s in by_load]
    found = []
    for slot in heavy:
        load = loads.get(slot, 0)
        # The best partner is the one below, or the one above, half a gap less; of equal ones the first.
        at = bisect_left(sizes, load - gap / 2)
        near = [at] if at == 0 else [bisect_left(sizes, sizes[at - 1]), at]
        found += [(abs(2 * (load - sizes[i]) - gap), slot, by_load[i]) for i in near if i < len(sizes) and 0 < load - sizes[i] < gap]
    return min(found)[1:] if found else None


@dataclass
class SlotMap:
    """Version and shard of every slot; shards are numbered from 0."""

    shards: int
    version: int = 1
    of: dict[int, int] = field(default_factory=dict)

    @classmethod
    def first(cls, shards: int, slots: int = SLOTS) -> SlotMap:
        """Version 1: slots in turn."""
        return cls(shards, 1, {slot: slot % shards for slot in range(slots)})

    def totals(self, loads: dict[int, int]) -> list[int]:
        out = [0] * self.shards
        for slot, shard in self.of.items():
            out[shard] += loads.get(slot, 0)
        return out

    def rebalance(self, loads: dict[int, int], shards: int | None = None, slack: float = SLACK) -> SlotMap:
        """The next version: slots move from the heaviest to the lightest shard while that narrows their
        gap and some shard is off the mean by more than `slack`; where all are too large to move, one changes
        places with a smaller one. All others stay where they are.
        Shards that no longer exist hand out all their slots."""
        shards = shards or self.shards
        new = SlotMap(shards, self.version + 1, {s: d for s, d in self.of.items() if d < shards})
        totals = new.totals(loads)
        for slot in sorted((s for s in self.of if s not in new.of), key=lambda s: (-loads.get(s, 0), s)):
            light = totals.index(min(totals))
            new.of[slot] = light
            totals[light] += loads.get(slot, 0)
        held: dict[int, list] = {d: [] for d in range(shards)}
        for slot, shard in new.of.items():
            held[shard].append(slot)
        mean = sum(totals) / shards
        for _ in range(len(new.of)):
            heavy, light = totals.index(max(totals)), totals.index(min(totals))
            gap = totals[heavy] - totals[light]
            off = max(totals[heavy] - mean, mean - totals[light])
            if off <= slack * mean:
                break
            fits = [s for s in held[heavy] if 0 < loads.get(s, 0) < gap]
            if fits:
                moves = [(min(fits, key=lambda s: (abs(2 * loads[s] - gap), s)), heavy, light)]
            elif pair := _exchange(held[heavy], held[light], loads, gap):
                moves = [(pair[0], heavy, light), (pair[1], light, heavy)]
            else:
                break
            for slot, here, there in moves:
                held[here].remove(slot)
                held[there].append(slot)
                new.of[slot] = there
                totals[here] -= loads.get(slot, 0)
                totals[there] += loads.get(slot, 0)
        return new

    def frame(self, spark: SparkSession) -> DataFrame:
        """(version, shards, slot, shard): as many rows as there are slots."""
        rows = [(self.version, self.shards, s, d) for s, d in sorted(self.of.items())]
        return spark.createDataFrame(rows, "version int, shards int, slot int, shard int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Adds this version to the table at `path`."""
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A version of the table at `path`, the latest by default; shards without a slot count too."""
        stored = spark.read.parquet(path)
        if version is None:
            version = stored.agg(F.max("version")).first()[0]
        rows = stored.where(F.col("version") == version).collect()
        if not rows:
            raise ValueError(f"no version {version} of the slot map at {path}")
        return cls(rows[0]["shards"], version, {r["slot"]: r["shard"] for r in rows})


def records(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        slot_of(F.col(id_col), slots).alias("virtual_slot"),
    )


def slot_loads(rows: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, n): one row for each slot in use."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def spread(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """`rows` of records() with `copies`, one row for each record, or for a block of equal records where
    the id is null or alone holds more bytes or records than a mean slot."""
    all_ = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    # Such ids are at most twice as many as there are slots, and lie in slots as heavy as they.
    above = (F.col("bytes") > (all_["bytes"] or 0) / slots) | (F.col("n") > all_["n"] / slots)
    full = slot_loads(rows).where(above & (F.col("n") > 1)).select("virtual_slot")
    known = rows.where("doc_id is not null").join(F.broadcast(full), "virtual_slot", "left_semi")
    heavy = known.groupBy("doc_id").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    heavy = cut(heavy.where(above & (F.col("n") > 1)).select("doc_id"))
    single = rows.where("doc_id is not null").join(F.broadcast(heavy), "doc_id", "left_anti").withColumn("copies", F.lit(1).cast("long"))
    # Equal records are counted before they are exchanged, so a third of a table is one row of each task.
    loose = rows.where("doc_id is null").unionByName(rows.join(F.broadcast(heavy), "doc_id", "left_semi").select(*rows.columns))
    equal = loose.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    most = min(BLOCK, max(1, all_["n"] // slots))
    blocks = equal.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {most})")))
    placed = blocks.select(
        "doc_id",
        "size",
        "text_crc32",
        spread_slot(F.col("doc_id"), F.col("text_crc32"), F.col("block"), slots).alias("virtual_slot"),
        F.least(F.lit(most).cast("long"), F.col("n") - most * F.col("block")).alias("copies"),
    )
    return single.select(*placed.columns).unionByName(placed)


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    slots: int = SLOTS,
    maps: str | None = None,
    slack: float = SLACK,
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law (bytes), shard, slot (its place in the
    shard, gapless from 0), grown_shard (null), virtual_slot, map_version.

    `maps` is the folder of the stored maps; where it is new, or none is given (then it is a scratch
    folder), a first version is stored. The latest version is read, edited for these rows' bytes if a
    shard is off the mean by more than `slack` or their number has changed, and stored as the next.
    Null text counts as empty, null and heavy ids are spread, repeated rows each take a place (in order of
    doc_id, checksum and size); an empty table gives an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = cut(spread(cut(records(docs, id_col=id_col, text_col=text_col, slots=slots)), slots))
    sums = rows.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("n"))
    found = {r["virtual_slot"]: (r["bytes"], r["n"]) for r in sums.collect()}
    loads = {s: b for s, (b, _) in found.items()}
    if maps is None:
        maps = scratch_dir(spark, "slot-maps")
        SlotMap.first(shards, slots).save(spark, maps)
    now = SlotMap.load(spark, maps)
    if len(now.of) != slots:
        raise ValueError(f"the stored map has {len(now.of)} slots, not {slots}")
    edited = now.rebalance(loads, shards, slack)
    if edited.of != now.of or shards != now.shards:
        edited.save(spark, maps)
        now = SlotMap.load(spark, maps)
    placed, filled = [], [0] * now.shards
    for slot, shard in sorted(now.of.items()):
        placed.append((slot, shard, filled[shard]))
        filled[shard] += found.get(slot, (0, 0))[1]
    # As many rows as there are slots, whatever the input.
    where = spark.createDataFrame(placed, "virtual_slot int, shard int, before long")
    inside = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    earlier = F.coalesce(F.sum("copies").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.withColumn("earlier", earlier)
        .withColumn("nth", F.explode(F.sequence(F.col("earlier") + 1, F.col("earlier") + F.col("copies"))))
        .join(F.broadcast(where), "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("before") + F.col("nth") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.lit(now.version).alias("map_version"),
        )
    )
