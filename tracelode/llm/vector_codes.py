"""Vector codes: each part of a vector as the number of its nearest codebook entry, in whole numbers.

Parts and entries are filled with zeros to a power of two and taken through the Walsh-Hadamard
transform, which needs additions only and scales every squared distance by that power. Smooth parts
have most of their length in the first coefficients in order of sequency, so squared differences are
added in that order: after the first few of them the entry that leads gives a bound for each part, and entries
beyond it are out. What is left is exact, ties included, as all of it is integers.

Codebooks are of fixed size and are broadcast. A round's tasks add up what falls to each entry, so one
row for each task and entry is exchanged and the sums for each entry meet on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import cut, map_arrow, named

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Coefficients that all entries are compared in before the first go out, and those added between later looks.
FIRST, STEP = 4, 4
#: Parts that are compared at a time.
ROWS = 1024
#: Distinct labels whose sums are broadcast; with more they are joined by an exchange.
FEW_LABELS = 100_000
#: Parts of a label's rows in that exchange.
SALTS = 32

LARGEST = 2**63 - 1


def sequency(size: int) -> np.ndarray:
    """Natural places of the Hadamard coefficients in order of their number of sign changes; `size` is a power of two."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ np.arange(size) >> 1
    return sum((gray >> b & 1) << (bits - 1 - b) for b in range(bits)) if bits else gray


def walsh(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, filled with zeros to a power of two, in order of sequency."""
    n, width = rows.shape
    size = 1 << max(width - 1, 0).bit_length()
    out = np.zeros((n, size), rows.dtype)
    out[:, :width] = rows
    half = 1
    while half < size:
        pairs = out.reshape(n, -1, 2, half)
        out = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency(size)]


def _fits(rows: np.ndarray, entries: np.ndarray) -> bool:
    """Whether scaled squared distances stay below 2^62."""
    size = 1 << max(rows.shape[1] - 1, 0).bit_length()
    top = max((abs(int(x)) for a in (rows, entries) if a.size for x in (a.min(), a.max())), default=0)
    return (2 * top) ** 2 * size * max(rows.shape[1], 1) < 2**62


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """(entry, squared distance) for each row: the nearest entry, of equally near ones the first."""
    if not len(rows):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if not _fits(rows, entries):
        # Too large for 64 bits: the same in whole numbers of any size.
        exact = [[sum((int(x) - int(y)) ** 2 for x, y in zip(r, e, strict=True)) for e in entries] for r in rows]
        best = [min(range(len(d)), key=d.__getitem__) for d in exact]
        return np.array(best), [d[i] for d, i in zip(exact, best, strict=True)]
    known = walsh(entries)
    size = known.shape[1]
    found, errors = [], []
    for at in range(0, len(rows), ROWS):
        mine = walsh(rows[at : at + ROWS])
        so_far = np.zeros((len(mine), len(known)), np.int64)
        for c in range(min(FIRST, size)):
            so_far += (mine[:, None, c] - known[None, :, c]) ** 2
        bound = ((mine - known[so_far.argmin(axis=1)]) ** 2).sum(axis=1)
        i, e = np.nonzero(so_far <= bound[:, None])
        total = so_far[i, e]
        for c in range(FIRST, size, STEP):
            total += ((mine[i, c : c + STEP] - known[e, c : c + STEP]) ** 2).sum(axis=1)
            left = total <= bound[i]
            i, e, total = i[left], e[left], total[left]
        order = np.lexsort((e, total, i))
        first = order[np.unique(i[order], return_index=True)[1]]
        found.append(e[first])
        errors.append(total[first] // size)
    return np.concatenate(found), np.concatenate(errors)


@dataclass(frozen=True)
class Codebooks:
    """`entries[part]`: the part's entries, one row each; vectors have `width` components once filled up."""

    width: int
    entries: tuple[np.ndarray, ...]

    def sha256(self) -> str:
        numbers = (str(int(x)) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def cut(self, whole: np.ndarray) -> Iterator[np.ndarray]:
        """Each part of the rows."""
        size = self.width // len(self.entries)
        return (whole[:, p * size : (p + 1) * size] for p in range(len(self.entries)))

    def assign(self, whole: np.ndarray) -> list[tuple[np.ndarray, list[int] | np.ndarray]]:
        return [nearest(part, e) for part, e in zip(self.cut(whole), self.entries, strict=True)]


def usable(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, v as longs; what no long holds counts as the largest or smallest."""
    vec = named(vec_col)
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = named(label_col) if label_col in vectors.columns else F.lit(None).cast("int")
    return vectors.where(vec.isNotNull() & whole).select(
        named(id_col).alias("vec_id"), label.alias("label"), F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of one batch as rows of `width` components, filled up with zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """Codebooks of the `entries` rows of usable() with the smallest ids (nulls last, equal ids by vector)."""
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts) * parts
    some = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    whole = np.array([list(r["v"]) + [0] * (width - len(r["v"])) for r in some], np.int64).reshape(len(some), width)
    return Codebooks(width, tuple(np.ascontiguousarray(x) for x in np.split(whole, parts, axis=1)))


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks whose entries are the means, rounded down, of what is nearest to them; unused entries stay."""
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = sent.value
        counts = [np.zeros(len(e), np.int64) for e in now.entries]
        sums = [np.zeros(e.shape, object) for e in now.entries]
        for batch in batches:
            whole = _matrix(batch.column(0), now.width)
            # Sums of a batch stay in 64 bits unless components are very large.
            small = not whole.size or max(abs(int(whole.min())), abs(int(whole.max()))) * len(whole) < 2**62
            for p, (part, (at, _)) in enumerate(zip(now.cut(whole), now.assign(whole), strict=True)):
                counts[p] += np.bincount(at, minlength=len(counts[p]))
                here = np.zeros(sums[p].shape, np.int64 if small else object)
                np.add.at(here, at, part if small else part.astype(object))
                sums[p] += here.astype(object)
        used = [(p, e) for p, c in enumerate(counts) for e in np.flatnonzero(c)]
        total = [[Decimal(int(x)) for x in sums[p][e]] for p, e in used]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in used], pa.int32()),
                pa.array([int(e) for _, e in used], pa.int32()),
                pa.array([int(counts[p][e]) for p, e in used], pa.int64()),
                pa.array(total, pa.list_(pa.decimal128(38, 0))),
            ],
            names=["part", "entry", "n", "total"],
        )

    parts = map_arrow(rows.select("v"), run, "part int, entry int, n long, total array<decimal(38,0)>")
    size = books.width // len(books.entries)
    sums = [F.sum(F.col("total")[i]).cast("decimal(38,0)").alias(f"t{i}") for i in range(size)]
    found = parts.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()
    new = [e.copy() for e in books.entries]
    for r in found:
        new[r["part"]][r["entry"]] = [int(r[f"t{i}"]) // r["n"] for i in range(size)]
    sent.destroy()
    return Codebooks(books.width, tuple(new))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of usable() rows after `rounds` rounds over all of them."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if len(books.entries[0]) else 0):
        books = improved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of usable() rows: two hex digits for each part, and the squared distance to what the
    code stands for (the largest long where that is larger)."""
    if max((len(e) for e in books.entries), default=0) > 256:
        raise ValueError("codes have two hex digits for each part, so 256 entries at most")
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.assign(_matrix(batch.column(2), sent.value.width))
            digits = np.stack([at for at, _ in found], axis=1).astype(np.uint8)
            errors = [min(sum(map(int, e)), LARGEST) for e in zip(*[e for _, e in found], strict=True)]
            code = [bytes(x).hex() for x in digits]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = dict(rows.dtypes)
    return map_arrow(rows.select("vec_id", "label", "v"), run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """`codes` (code) with `v`: the whole numbers that each code stands for; a null code has none."""
    sent, names = codes.sparkSession.sparkContext.broadcast(books), [*codes.columns, "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for code in batch.column(batch.num_columns - 1).to_pylist():
                parts = zip(bytes.fromhex(code), sent.value.entries, strict=True) if code is not None else ()
                found.append([int(x) for at, entries in parts for x in entries[at]] if code is not None else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.int64()))], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema.fields)
    return map_arrow(codes.select("*", F.col("code").alias("_code")), run, f"{kinds}, v array<long>")


def with_label_error(codes: DataFrame, few: int = FEW_LABELS) -> DataFrame:
    """`codes` with label_error, the errors of all rows of the same label (nulls are one) added up."""
    sums = codes.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    sums = cut(sums.withColumnRenamed("label", "_label"))
    if sums.count() <= few:
        return codes.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    dealt = codes.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    copied = sums.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = dealt.join(copied, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_at")))
    return met.drop("_label", "_salt", "_at")


def vector_codes(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | None = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each row that takes part.

    Rows with a null vector, or with null or non-finite components, take no part. Vectors that are shorter than
    the longest one, or whose length is no multiple of `parts`, count as filled up with zeros. Rows of a
    null id come last where ids choose entries; repeated rows each count and each give a row; fewer rows
    than `entries` make smaller codebooks; an empty table gives an empty one; other columns are ignored.
    """
    rows = usable(vectors, id_col=id_col, vec_col=vec_col, label_col=label_col, scale=scale)
    books = train(rows, parts, entries, rounds)
    codes = cut(encode(rows, books))
    return with_label_error(codes).select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
