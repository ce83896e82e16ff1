"""Jaccard join of documents as sets of word shingles, by pivots, regions and triangle inequalities.

One minus the Jaccard similarity is a metric, so whatever two documents within a distance r of each
other are far from, they are about as far from: within r. The join uses that three times.

- *Shingles as pivots.* Documents without common shingles are all at distance one, where no document
  tells them apart as a pivot. The first pivots are therefore single shingles. A document's window are its
  first shingles in one order of all shingles, rare ones first: so many that a document within r cannot lack all but
  a few of them. Documents within r meet at several of these shingles; two that meet at fewer are no pair.
- *Documents as pivots.* Where more than CROWD documents meet at a shingle, the one whose shingles are most common
  is the pivot and the others are its region, whatever shingle brought them. All of a region
  are compared with the pivot. Groups of near copies have such a pivot in their middle, and links to it
  join them without a look at their pairs. Where fewer meet, they are compared with each other
  if they meet often enough.
- *Regions.* Only pairs that no link has joined yet are left. A small region is joined in one task, where
  the distances from the pivot rule out pairs that differ by more than r. A large one gets pivots of its own,
  its documents go to the nearest (a Voronoi region) and to all within 2 r of that (the window), and so on. Where
  that does not make regions smaller, they are cut into blocks that meet two by two.

Copies (equal sets) are one document throughout. The order of shingles comes from a table of fixed size
that counts all shingles of all documents by their hash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import cut, map_arrow, named
from tracelode.llm.components import connected_components

WIDTH = 4
#: Two sets link when PERCENT of their union, or more, is common.
PERCENT = 85
#: Entries of the table of counts; it only orders shingles, so any size gives the same links.
COUNTS = 1 << 22
#: Entries of the table that are one row when tasks' tables are added up.
CHUNK = 1 << 18
#: Documents, and shingles of all of them, in a region that one task joins.
LEAF, LEAF_SHINGLES = 128, 4_000_000
#: Pivots of a region that is larger, about.
PIVOTS = 16
#: Shingles that a window holds beyond those it needs, so that documents that link meet at one more for each.
MORE = 7
#: Documents at one shingle whose pairs are counted; where more meet, one is the pivot of all.
CROWD = 16
#: Keys for which a table of bits (_near()) has LEAST bits each; fewer have up to SPARE, for more it stays as large and lets more rows through.
FEW, LEAST, SPARE = 1 << 22, 16, 64
#: Bits in one row of such a table.
MAP = 1 << 15
#: Shingles at which most documents meet, at most, that are broadcast.
HEAVY = 2_000
#: Rows of windows' shingles, about, that one task groups.
CELLS = 500_000
#: Bits of a document's key that number it; those above rank it as a pivot.
NUMBER_BITS = 53

#: Bytes to themselves, A-Z lowered and the blanks between words to one of them.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
#: Bytes of text that are worked on at a time; words go on from one piece of a text to the next.
PIECE = 500_000
#: Odd multipliers that mix bytes to words and words to shingles; any large ones would do.
ODD = [np.uint64(5**k % 2**64) for k in (27, 25, 23)]
BASE = 5**21 % 2**64


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(32)) * ODD[1]
    return values ^ values >> np.uint64(29)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2^64."""
    out = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        each = np.full(n, base, np.uint64)
        each[0] = 1
        out.append(np.cumprod(each, dtype=np.uint64))
    return out[0], out[1]


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return _mixed(_mixed(np.arange(1, 257, dtype=np.uint64) * ODD[0]))


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, start, stop) of each word of a text in PLAIN bytes. A word's value is a polynomial in its bytes, taken
    from running sums over the text."""
    held = np.frombuffer(text, np.uint8)
    power, inverse = _powers(1 << max(len(text), 1).bit_length())
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = held != 32
    turns = np.diff(inside)
    start, stop = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_byte_values()[held] * power[: len(text)], out=sums[1:])
    return (sums[stop] - sums[start]) * inverse[start], start, stop


def _long_words(text: bytes) -> np.ndarray:
    """Values of the words of a long text, piece by piece."""
    values, at = [np.empty(0, np.uint64)], 0
    open_, length = None, 0
    while at < len(text):
        piece = text[at : at + PIECE]
        value, start, stop = _words(piece)
        if open_ is not None and len(start) and start[0] == 0:
            # The last word of the piece before goes on.
            value[0] = np.uint64((int(open_) + pow(BASE, length, 2**64) * int(value[0])) % 2**64)
            length += int(stop[0])
        else:
            values += [np.array([open_], np.uint64)] if open_ is not None else []
            length = 0
        open_ = None
        if len(stop) and stop[-1] == len(piece):
            length = length if len(stop) == 1 and start[0] == 0 and length else int(stop[-1] - start[-1])
            open_, value = value[-1], value[:-1]
        values.append(value)
        at += PIECE
    values += [np.array([open_], np.uint64)] if open_ is not None else []
    return np.concatenate(values)


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of `width` words, or of all where there are fewer."""
    n = min(width, len(words))
    out = np.full(len(words) - n + 1 if n else 0, n, np.uint64)
    for i in range(n):
        out = out * ODD[0] + words[i : len(words) - n + 1 + i] * ODD[2]
    return _mixed(out)


def shingle_sets(texts: Iterable[bytes | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; a text of fewer words is one shingle, none has none."""
    held: list[bytes] = []

    def done() -> Iterator[np.ndarray]:
        value, start, _ = _words(b" ".join(held))
        value = _mixed(value)
        first = np.cumsum([0, *[len(x) + 1 for x in held[:-1]]])
        edges = [*np.searchsorted(start, first).tolist(), len(start)]
        for i in range(len(held)):
            yield np.unique(_shingles(value[edges[i] : edges[i + 1]], width))
        held.clear()

    size = 0
    for text in texts:
        text = (text or b"").translate(PLAIN)
        if held and size + len(text) > PIECE:
            yield from done()
            size = 0
        if len(text) > PIECE:
            yield np.unique(_shingles(_mixed(_long_words(text)), width))
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield from done()


def window(n: int, percent: int = PERCENT) -> int:
    """How many of a set's first shingles hold 1 + MORE of any set that links with it, or all that both have."""
    return min(n, n - -(-percent * n // 100) + 1 + MORE)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, list(shingle_sets((x.as_py() for x in batch.column(0)), width))


def _digest(shingles: np.ndarray) -> str:
    return hashlib.md5(shingles.tobytes()).hexdigest()


def _level_table(tables: DataFrame, size: int) -> np.ndarray:
    """Logarithms of the counts that tasks' tables (chunk, counts) add up to. They reach the driver packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = np.frombuffer(zlib.decompress(counts.as_py()), np.int64)
                sums[chunk] = sums[chunk] + found if chunk in sums else found
        kept = sorted(sums)
        packed = [zlib.compress(np.log2(sums[c] + 1.0).astype(np.float32).tobytes(), 1) for c in kept]
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(packed, pa.binary())], names=["chunk", "levels"])

    chunks = -(-size // CHUNK)
    levels = np.zeros(chunks * CHUNK, np.float32)
    # As many rows as the table has chunks, whatever the input.
    for r in map_arrow(tables.repartition(chunks, "chunk"), run, "chunk int, levels binary").collect():
        levels[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["levels"]), np.float32)
    return levels[:size]


def _outlines(texts: DataFrame, width: int, size: int) -> tuple[DataFrame, np.ndarray]:
    """((doc_id, text_key, digest, n) of each row of `texts` (text, doc_id, text_key), logarithms of the counts of all
    their shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(-(-size // CHUNK) * CHUNK, np.int64)
        names = ["doc_id", "text_key", "digest", "n", "chunk", "counts"]
        kind = None
        for batch, sets in _sets(batches, width):
            for each in sets:
                np.add.at(counts, (each % np.uint64(size)).astype(np.int64), 1)
            kind, n = batch.column(1).type, len(sets)
            columns = [*batch.columns[1:], pa.array(map(_digest, sets), pa.string()), pa.array(map(len, sets), pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if kind is not None:
            parts = [(c, x) for c, x in enumerate(counts.reshape(-1, CHUNK)) if x.any()]
            n = len(parts)
            blobs = pa.array([zlib.compress(x.tobytes(), 1) for _, x in parts], pa.binary())
            columns = [pa.nulls(n, kind), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array([c for c, _ in parts], pa.int32()), blobs]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(texts.dtypes)["doc_id"]
    both = cut(map_arrow(texts, run, f"doc_id {kind}, text_key string, digest string, n long, chunk int, counts binary"))
    levels = _level_table(both.where("chunk is not null").select("chunk", "counts"), size)
    return both.where("chunk is null").select("doc_id", "text_key", "digest", "n"), levels


def _representatives(texts: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """(digest, n, key, first): each distinct set that is not empty, its key (least for the best pivot) and
    the shingles of its window."""
    sent = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        top = max(float(table.max()), 1.0)
        for batch, sets in _sets(batches, width):
            sets = [x for x in sets if len(x)]
            first, rank = [], []
            for each in sets:
                level = table[(each % np.uint64(len(table))).astype(np.int64)]
                rank.append(1023 - int(1023 * level.mean() / top))
                # The counts themselves decide: an entry holds more of other shingles the larger the table of documents, and steps as
                # wide as the count would then take ever more common shingles for rare ones. Equal counts go by hash, as sets are sorted.
                order = np.argsort(level, kind="stable")[: window(len(each), percent)]
                first.append(each[order].view(np.int64))
            columns = [pa.array(map(_digest, sets), pa.string()), pa.array(map(len, sets), pa.int64()), pa.array(rank, pa.int64()), pa.array(first, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "n", "rank", "first"])

    each = map_arrow(texts.select("text"), run, "digest string, n long, rank long, first array<long>")
    one = each.groupBy("digest").agg(*[F.first(c).alias(c) for c in ("n", "rank", "first")])
    key = F.shiftleft("rank", NUMBER_BITS) + F.monotonically_increasing_id()
    return cut(one.select("digest", "n", key.alias("key"), "first"))


def _near(rows: DataFrame, column: str, keys: DataFrame, few: int) -> DataFrame:
    """`rows` without most of those whose `column` is not in `keys` (one column; read twice), so that the join that follows exchanges
    hardly more than it needs. The keys' hashes are bits of a table of bounded size, rows of MAP bits, that is broadcast."""
    bits, wanted = MAP, min(SPARE * keys.count(), LEAST * few)
    while bits < wanted:
        bits *= 2
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    place = keys.select(at(keys.columns[0]).alias("_at"))
    maps = place.groupBy(F.expr(f"_at div {MAP}").alias("_map")).agg(F.bitmap_construct_agg(F.col("_at") % MAP).alias("_bits"))
    met = rows.withColumn("_at", at(column)).withColumn("_map", F.expr(f"_at div {MAP}")).join(F.broadcast(maps), "_map")
    byte = F.conv(F.hex(F.col("_bits").substr(F.expr(f"cast(_at % {MAP} div 8 as int) + 1"), F.lit(1))), 16, 10).cast("long")
    return met.where(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1).select(*rows.columns)


def _met(reps: DataFrame) -> DataFrame:
    """(s, a, b, all, n) of each shingle of a window: the extremes and the exclusive or of the keys of the documents that meet at it,
    which tell all of up to three, and their number. Rows are combined batch by batch before they are exchanged; most are of one document
    then, and say nothing twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.repeat(batch.column(0).to_numpy(), np.diff(batch.column(1).offsets.to_numpy()))
            s = batch.column(1).flatten().to_numpy()
            order = np.argsort(s)
            s, key = s[order], key[order]
            at = np.flatnonzero(np.append(True, s[1:] != s[:-1])[: len(s)])
            if len(at):
                sums = [f.reduceat(key, at) for f in (np.minimum, np.maximum, np.bitwise_xor)]
                made = [s[at], *sums, np.diff(np.append(at, len(s)))]
                # Rows of one document side by side are packed best.
                order = np.argsort(made[1], kind="stable")
                s, a, *rest = [x[order] for x in made]
                columns = [pa.array(s), pa.array(a), *[pa.array(x, mask=rest[-1] == 1) for x in rest]]
                yield pa.RecordBatch.from_arrays(columns, names=["s", "a", "b", "all", "n"])

    # So many tasks that the groups of each stay in memory, whatever the input.
    tasks = (reps.agg(F.sum(F.size("first"))).first()[0] or 0) // CELLS + 1
    parts = map_arrow(reps.select("key", "first"), run, "s long, a long, b long, all long, n long")
    parts = parts.repartition(max(tasks, reps.sparkSession.sparkContext.defaultParallelism), "s")
    b, every, n = F.coalesce("b", "a"), F.coalesce("all", "a"), F.coalesce("n", F.lit(1))
    return parts.groupBy("s").agg(F.min("a").alias("a"), F.max(b).alias("b"), F.bit_xor(every).alias("all"), F.sum(n).alias("n"))


def _meetings(reps: DataFrame, percent: int, crowd: int, few: int) -> tuple[DataFrame, DataFrame]:
    """(region, x) of the shingles at which more than `crowd` documents meet: the pivot, and all others that meet
    there; and (region, x), one way round, of other documents that meet often enough to link."""
    cells = reps.select(F.explode("first").alias("s"), "key")
    met = cut(_met(reps).where("n > 1"))
    several = met.where("n > 3").select("s", F.col("a").alias("region"), "n")
    # At most HEAVY shingles have more than that, and no group of the others is large.
    most = (several.agg(F.sum("n")).first()[0] or 0) // HEAVY
    heavy, light = several.where(F.col("n") > most), several.where(F.col("n") <= most)
    several = cut(
        cells.join(F.broadcast(heavy), "s").union(_near(cells, "s", light.select("s"), few).join(light.hint("merge"), "s"))
    )
    regions = several.where((F.col("n") > crowd) & (F.col("key") != F.col("region"))).select("region", F.col("key").alias("x")).distinct()
    pair = lambda u, v: F.struct(F.least(u, v).alias("region"), F.greatest(u, v).alias("x"))
    a, b = F.col("a"), F.col("b")
    third = F.col("all").bitwiseXOR(a).bitwiseXOR(b)
    two = F.when(F.col("n") == 2, F.array(pair(a, b))).when(F.col("n") == 3, F.array(pair(a, b), pair(a, third), pair(b, third)))
    # At most `crowd` keys each.
    listed = several.where(F.col("n") <= crowd).groupBy("s").agg(F.collect_list("key").alias("keys"))
    more = F.expr("flatten(transform(keys, u -> transform(filter(keys, v -> v > u), v -> struct(u as region, v as x))))")
    pairs = met.where("n <= 3").select(F.explode(two).alias("p")).union(listed.select(F.explode(more).alias("p")))
    often = cut(pairs.groupBy("p.region", "p.x").agg(F.count(F.lit(1)).alias("times")).where("times > 0"))
    # Sets that link with fewer than 1 + MORE shingles in common have no more than this in their union, and windows that hold all.
    tiny = reps.where(F.col("n") <= 100 * MORE // percent)
    size = lambda of, c: of.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"))
    sized = lambda rows, of: rows.join(size(of, "x"), "x").join(size(of, "region"), "region")
    some = sized(often.where(F.col("times") >= 1 + MORE), reps).union(sized(often.where(F.col("times") <= MORE), tiny))
    return cut(regions), some.where(_may_link(percent)).select("region", "x")


def _may_link(percent: int) -> Column:
    """Whether sets of n_region and n_x shingles can link if `times` of them are in both windows. Of the two windows, the one that ends first
    in the order holds no shingle of the other set that the other window lacks; so at most `times` of its own are in
    common, and all that its set has beyond. That is most for the larger set."""
    least = F.expr(f"({percent} * (n_region + n_x) + {99 + percent}) div {100 + percent}")
    beyond = F.expr(f"greatest((({percent} * greatest(n_region, n_x) + 99) div 100) - {1 + MORE}, 0)")
    return (F.least("n_region", "n_x") >= least) & (F.col("times") + beyond >= least)


def _needed_sets(texts: DataFrame, rows: DataFrame, reps: DataFrame, pairs: DataFrame, width: int, few: int) -> DataFrame:
    """(x, n, regions, shingles): the sets of the documents in `pairs` (region, x), as bytes, with the regions that they are
    the x of. One text of each is read."""
    copy = F.xxhash64("text_key", "doc_id").alias("copy")
    one = rows.select("digest", "text_key", copy).groupBy("digest").agg(F.min(F.struct("text_key", "copy")).alias("one")).select("digest", "one.*")
    # As many for a document as its window has shingles and these have others to be paired with.
    keys = pairs.select("x", "region").union(pairs.select(F.col("region").alias("x"), F.lit(None).cast("long")))
    asked = reps.select("digest", F.col("key").alias("x"), "n").join(keys.groupBy("x").agg(F.collect_list("region").alias("regions")), "x")
    asked = cut(asked.join(one, "digest").select("text_key", "copy", "x", "n", "regions"))
    # Of a text's copies hardly more than one is exchanged; where more are, the first of them does.
    found = _near(texts.select("text_key", "text", copy), "copy", asked.select("copy"), few)
    found = found.groupBy("text_key").agg(F.first("text").alias("text")).join(asked.drop("copy").hint("merge"), "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, width):
            columns = [*batch.columns[1:], pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "n", "regions", "shingles"])

    return cut(map_arrow(found.select("text", "x", "n", "regions"), run, "x long, n long, regions array<long>, shingles binary"))


def _array(binary: pa.Scalar) -> np.ndarray:
    return np.frombuffer(binary.as_py(), np.uint64)


def _to_pivots(pairs: DataFrame, sets: DataFrame, few: int) -> DataFrame:
    """`pairs` (region, x) with n, n_pivot and inter: the sizes of the document, of the pivot and of what they share."""
    mine = sets.select(F.explode("regions").alias("region"), "x", "n", "shingles")
    theirs = _near(sets, "x", pairs.select("region").distinct(), few)
    theirs = theirs.select(F.col("x").alias("region"), F.col("n").alias("n_pivot"), F.col("shingles").alias("of_pivot"))
    met = mine.join(theirs.hint("merge"), "region").select("region", "x", "n", "n_pivot", "shingles", "of_pivot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inter = [common(_array(a), _array(b)) for a, b in zip(batch.column(4), batch.column(5), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(inter, pa.int64())], names=["region", "x", "n", "n_pivot", "inter"])

    return cut(map_arrow(met, run, "region long, x long, n long, n_pivot long, inter long"))


def _similar(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * inter >= percent * (a + b - inter)


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """`members` (region, x, ..) of regions that links have not joined whole, with their label: the root of connected_components()."""
    found = cut(
        members.join(roots.hint("merge"), F.col("x") == F.col("node"), "left").select(*members.columns, F.coalesce("root", "x").alias("label"))
    )
    open_ = found.groupBy("region").agg(
        F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight")
    )
    return found.join(open_.where("a <> b").select("region", "size", "weight").hint("merge"), "region")


def _candidates(label: np.ndarray, n: np.ndarray, far: np.ndarray, block: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one group that may link: no label in common, sizes and distances from the pivot close enough, of
    different blocks if there are two."""
    i, j = np.triu_indices(len(label), 1)
    close = (label[i] != label[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
    # A little more than the limit, for the rounding of quotients.
    close &= np.abs(far[i] - far[j]) <= (100 - percent) / 100 + 1e-9
    if len(set(block.tolist())) > 1:
        close &= block[i] != block[j]
    return i[close], j[close]


LEAF_ROW = "region long, x long, n long, far double, label long, block long"


def _leaf_links(leaves: DataFrame, sets: DataFrame, percent: int, few: int) -> DataFrame:
    """Links (u, v) of all pairs inside groups of bounded size; `leaves` is LEAF_ROW."""

    def columns(table: pa.Table) -> list[np.ndarray]:
        return [table.column(c).to_numpy() for c in ("label", "n", "far", "block")]

    def narrow(table: pa.Table) -> pa.Table:
        i, j = _candidates(*columns(table), percent)
        return table.take(pa.array(np.union1d(i, j)))

    def linked(table: pa.Table) -> pa.Table:
        key, label = table.column("x").to_numpy(), table.column("label").to_numpy()
        found = [_array(x) for x in table.column("shingles")]
        i, j = _candidates(*columns(table), percent)
        joined: dict[int, int] = {}

        def root(x: int) -> int:
            while x in joined:
                x = joined[x]
            return x

        u, v = [], []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            p, q = root(int(label[a])), root(int(label[b]))
            if p != q:
                both = common(found[a], found[b])
                if 100 * both >= percent * (len(found[a]) + len(found[b]) - both):
                    joined[p] = q
                    u.append(int(key[a]))
                    v.append(int(key[b]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    asked = cut(leaves.groupBy("region", "block_pair").applyInArrow(narrow, LEAF_ROW + ", block_pair long"))
    whole = asked.join(_near(sets.select("x", "shingles"), "x", asked.select("x"), few), "x")
    return whole.groupBy("region", "block_pair").applyInArrow(linked, "u long, v long")


def _split(large: DataFrame, sets: DataFrame, level: int, pivots: int, percent: int, few: int) -> DataFrame:
    """One row for each document of `large` (region, x, n, size, label, ..) and pivot of its own region that it
    goes to, with the distance `far`, and whether the two link. Pivots are compared with all and go nowhere (not `stays`)."""
    lot = F.pmod(F.xxhash64("x", F.lit(level)), F.col("size"))
    least = large.groupBy("region").agg(F.min(F.xxhash64("x", F.lit(level))).alias("least"))
    drawn = large.join(least, "region").where((lot < pivots) | (F.xxhash64("x", F.lit(level)) == F.col("least"))).select("region", "x")
    sets = _near(sets.select("x", "shingles"), "x", large.select("x"), few)
    packed = drawn.join(sets, "x").groupBy("region").agg(F.collect_list(F.struct("x", "shingles")).alias("pivots"))
    met = large.select("region", "x", "n", "label", "size").join(sets, "x").join(packed.hint("merge"), "region")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                mine = np.frombuffer(r["shingles"], np.uint64)
                stays = all(p["x"] != r["x"] for p in r["pivots"])
                far = []
                for p in r["pivots"]:
                    if p["x"] == r["x"]:
                        continue
                    other = np.frombuffer(p["shingles"], np.uint64)
                    both = common(mine, other)
                    link = 100 * both >= percent * (len(mine) + len(other) - both)
                    far.append((1 - both / (len(mine) + len(other) - both), p["x"], link))
                most = min(far, default=(0,))[0] + 2 * (100 - percent) / 100 + 1e-9
                rows += [
                    {"parent": r["region"], "x": r["x"], "n": r["n"], "label": r["label"], "size": r["size"], "pivot": x, "far": d, "link": link, "stays": stays}
                    for d, x, link in far
                    if (stays and d <= most) or link
                ]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    names = ("parent", "x", "n", "label", "size", "pivot")
    schema = pa.schema([*[(c, pa.int64()) for c in names], ("far", pa.float64()), ("link", pa.bool_()), ("stays", pa.bool_())])
    columns = met.select("region", "x", "n", "label", "size", "shingles", "pivots")
    return cut(map_arrow(columns, run, "parent long, x long, n long, label long, size long, pivot long, far double, link boolean, stays boolean"))


def _in_blocks(rows: DataFrame, leaf: int, shingles: int) -> DataFrame:
    """Regions cut into blocks, each document once for each block that its own has to meet."""
    blocks = F.greatest(F.ceil(2 * F.col("size") / leaf), F.ceil(2 * F.col("weight") / shingles), F.lit(1))
    mine = F.pmod(F.xxhash64("x"), blocks)
    met = rows.withColumn("_n", blocks).withColumn("block", mine).withColumn("_other", F.explode(F.expr("sequence(0L, _n - 1)")))
    pair = F.least("block", "_other") * F.col("_n") + F.greatest("block", "_other")
    return met.withColumn("block_pair", pair).drop("_n", "_other")


def links(
    texts: DataFrame,
    rows: DataFrame,
    reps: DataFrame,
    *,
    width: int = WIDTH,
    percent: int = PERCENT,
    leaf: int = LEAF,
    leaf_shingles: int = LEAF_SHINGLES,
    pivots: int = PIVOTS,
    crowd: int = CROWD,
    few: int = FEW,
) -> DataFrame:
    """(u, v): pairs of keys of _representatives() that link, enough of them that components are those of
    all links. `texts` and `rows` are those that _outlines() takes and gives."""
    regions, pairs = _meetings(reps, percent, crowd, few)
    both = cut(regions.union(pairs).distinct())
    sets = _needed_sets(texts, rows, reps, both, width, few)
    measured = _to_pivots(both, sets, few)
    similar = _similar(F.col("inter"), F.col("n"), F.col("n_pivot"), percent)
    roots = connected_components(measured.where(similar).select(F.col("x").alias("u"), F.col("region").alias("v")))
    far = 1 - F.col("inter") / (F.col("n") + F.col("n_pivot") - F.col("inter"))
    members = measured.join(regions.hint("merge"), ["region", "x"], "left_semi")
    left = cut(_labelled(members.select("region", "x", "n", far.alias("far")), roots))
    level = 0
    while True:
        small = (F.col("size") <= leaf) & (F.col("weight") <= leaf_shingles)
        ready = [left.where(small).withColumns({"block": F.lit(0).cast("long"), "block_pair": F.lit(0).cast("long")})]
        large = left.where(~small)
        split = None
        if large.take(1):
            level += 1
            split = _split(large, sets, level, pivots, percent, few)
            # Regions that windows copy more than they part are cut into blocks instead.
            grown = split.where("stays").groupBy("parent").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size")).where(F.col("n") > 1.5 * F.col("size"))
            stuck = cut(grown.select("parent"))
            hard = large.join(stuck.select(F.col("parent").alias("region")).hint("merge"), "region", "left_semi")
            ready.append(_in_blocks(hard, leaf, leaf_shingles))
        columns = ["region", "x", "n", "far", "label", "block", "block_pair"]
        leaves = ready[0].select(*columns)
        for more in ready[1:]:
            leaves = leaves.union(more.select(*columns))
        # Roots stand for the links that they come from.
        found = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(_leaf_links(leaves, sets, percent, few))
        if split is None:
            return found
        roots = connected_components(found.union(split.where("link").select(F.col("x").alias("u"), F.col("pivot").alias("v"))))
        parted = split.where("stays").join(stuck.hint("merge"), "parent", "left_anti")
        left = cut(_labelled(parted.select(F.xxhash64("parent", "pivot").alias("region"), "x", "n", "far"), roots))


def jaccard_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, counts: int = COUNTS, **sizes
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles (size of its set), component_id (the smallest doc_id that links
    reach, its own included) and `digest` (equal for equal sets).

    Null text counts as empty; empty sets link with nothing, not with each other; rows of null id are grouped
    but name no component (one of nulls only has a null id); repeated rows each give a row; an empty
    table gives an empty one; other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"{percent} percent")
    text = named(text_col).cast("binary")
    texts = docs.select(text.alias("text"), named(id_col).alias("doc_id"), F.md5(F.coalesce(text, F.lit(b""))).alias("text_key"))
    rows, levels = _outlines(texts, width, counts)
    reps = _representatives(texts, levels, width, percent)
    roots = connected_components(links(texts, rows, reps, width=width, percent=percent, **sizes))
    rooted = reps.select("digest", "key").join(roots.hint("merge"), F.col("key") == F.col("node"), "left")
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    grouped = cut(rooted.select("digest", F.coalesce("root", "key").alias("root")).join(least, "digest"))
    best = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = grouped.join(best.hint("merge"), "root").select("digest", "component_id")
    met = rows.where("n > 0").join(grouped.hint("merge"), "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "digest")
    return met.union(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "digest"))
