"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

A step of texts becomes one array of code points. A class table (letter, number, white space,
other) turns it into symbols; a four-state automaton decides where a contraction such as ``'re``
may start. Its transition of each symbol is a function from states to states, packed in one byte.
Composing such functions is associative, so the state at every position comes from a blocked scan
of table look-ups, without a regular expression. States, classes and their neighbours give the
piece boundaries; pieces go through a bounded cache in front of the pair merging. The byte offset
of each token is kept for decoding.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import map_arrow, steps

#: Distinct pieces whose ids a worker keeps; past it the cache starts anew.
CACHE_PIECES = 400_000
#: Pieces longer than this many bytes are merged with a heap and not kept.
LONG_PIECE = 64
#: Above every rank: a pair that does not merge.
NEVER = 1 << 40

OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)  # BLANK: U+0020
# Automaton. FREE: a contraction may start here. BOUND: an apostrophe belongs to what went before.
# ONE, TWO: so many characters of a contraction are still to come.
FREE, BOUND, ONE, TWO = range(4)
APOSTROPHE = 0x27


def packed(*to: int) -> int:
    """The function FREE, BOUND, ONE, TWO -> to, two bits for each."""
    return sum(t << 2 * s for s, t in enumerate(to))


OPENS = packed(FREE, FREE, FREE, ONE)  # after a letter, number or white space but a blank
HOLDS = packed(BOUND, BOUND, FREE, ONE)  # after another character or a blank
TAKES_ONE = packed(ONE, BOUND, FREE, ONE)  # apostrophe with one letter to come: 's 't 'm 'd
TAKES_TWO = packed(TWO, BOUND, FREE, ONE)  # with two: 're 've 'll
RESETS = packed(FREE, FREE, FREE, FREE)  # between texts
SAME = packed(FREE, BOUND, ONE, TWO)


def composition() -> np.ndarray:
    """COMPOSE[f, g]: first f, then g."""
    f = np.arange(256, dtype=np.uint8)
    out = np.zeros((256, 256), np.uint8)
    for state in range(4):
        middle = f >> 2 * state & 3
        out |= (f[None, :] >> 2 * middle[:, None] & 3) << 2 * state
    return out


COMPOSE = composition()


def scan(functions: np.ndarray, block: int = 128) -> np.ndarray:
    """Composition of all functions before each position (SAME at the first)."""
    n = len(functions)
    if n <= block:
        out = np.empty(n, np.uint8)
        so_far = SAME
        for i in range(n):
            out[i] = so_far
            so_far = COMPOSE[so_far, functions[i]]
        return out
    rows = -(-n // block)
    padded = np.full(rows * block, SAME, np.uint8)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, block).T)
    inside = np.empty_like(columns)
    so_far = np.full(rows, SAME, np.uint8)
    for i in range(block):
        inside[i] = so_far
        so_far = COMPOSE[so_far, columns[i]]
    before = scan(so_far, block)
    return COMPOSE[before[None, :], inside].T.reshape(-1)[:n]


def class_table() -> np.ndarray:
    """The class of each code point, as the library's own Unicode tables have it."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    every = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], np.uint32)
    text = every.tobytes().decode("utf-32-le")
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        only = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(only.encode_ordinary(text)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    table[0x20] = BLANK
    return table


def piece_starts(points: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """True where a piece starts. `points`: code points of texts, each followed by one separator
    position; `ends`: the separator positions (their own flag is True)."""
    n = len(points)
    kind = table[points]
    kind[ends] = SPACE
    function = np.full(n, HOLDS, np.uint8)
    function[(kind == LETTER) | (kind == NUMBER) | (kind == SPACE)] = OPENS
    at = np.flatnonzero(points == APOSTROPHE)
    at = at[kind[at] == OTHER]
    # A separator (code point 0) is never part of a contraction, so no look-ahead leaves its text.
    one = points[np.minimum(at + 1, n - 1)]
    two = points[np.minimum(at + 2, n - 1)]
    single = (one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d"))
    double = (
        (one == ord("r")) & (two == ord("e"))
        | (one == ord("v")) & (two == ord("e"))
        | (one == ord("l")) & (two == ord("l"))
    )
    function[at[single]] = TAKES_ONE
    function[at[double]] = TAKES_TWO
    function[ends] = RESETS
    state = scan(function) & 3  # all texts begin in FREE

    space = (kind == SPACE) | (kind == BLANK)
    last = np.empty(n, np.uint8)  # class of the position before; a text begins after white space
    last[0] = SPACE
    last[1:] = kind[:-1]
    gap = (last == SPACE) | (last == BLANK)
    gap[0] = True
    first = np.zeros(n, bool)
    first[0] = True
    first[ends[ends + 1 < n] + 1] = True
    over = np.zeros(n, bool)  # the position after is the text's end
    over[ends[ends > 0] - 1] = True
    ahead = np.ones(n, bool)  # the position after is white space
    ahead[:-1] = space[1:]

    start = np.where(
        space,
        ~gap | first | ~ahead & ~over,  # a run begins; or its last one, with a word behind it
        first | (last == SPACE) | (last != BLANK) & (last != kind),
    )
    inside = state >= ONE
    start &= ~inside
    done = np.zeros(n, bool)
    done[1:] = inside[:-1] & (state[1:] == FREE) & (state[:-1] == ONE)
    start |= done  # right behind a contraction
    start[ends] = True
    return start


class Codec:
    """Encoder and decoder by one file of ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.table = class_table()
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece: again and again the leftmost pair of lowest rank becomes one token."""
        if (whole := self.ranks.get(piece)) is not None:
            return (whole,)
        if len(piece) > LONG_PIECE:
            return self.merge_long(piece)
        get = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < NEVER:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NEVER)
        return tuple([self.ranks[p] for p in parts])

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same by a heap over linked parts: n log n for pieces of any length."""
        n = len(piece)
        end = list(range(1, n + 1))  # of the part that starts here; 0: merged away
        before = list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (rank := self.ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or j >= n or end[j] != k:
                continue
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, texts: list[str]) -> list[array]:
        """Ids of each text, as unsigned 32-bit arrays."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        cuts = np.flatnonzero(piece_starts(points, ends, self.table))
        last = np.searchsorted(cuts, ends)
        cuts, last = cuts.tolist(), last.tolist()
        if len(self.known) > CACHE_PIECES:
            self.known = {}
        known, out, k = self.known, [], 0
        for stop in last:
            ids = array("I")
            put = ids.extend
            for a, b in zip(cuts[k:stop], cuts[k + 1 : stop + 1], strict=True):
                piece = joined[a:b]
                found = known.get(piece)
                if found is None:
                    found = self.merge(piece.encode())
                    if b - a <= LONG_PIECE:
                        known[piece] = found
                put(found)
            out.append(ids)
            k = stop + 1
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def offsets(self, ids) -> np.ndarray:
        """Byte position at which each token starts, and the end: what decode() gives, cut there."""
        sizes = np.fromiter((len(self.bytes_of[i]) for i in ids), np.int64, len(ids))
        return np.concatenate([[0], np.cumsum(sizes)])


@lru_cache(maxsize=2)
def codec(ranks: str) -> Codec:
    """One codec for each Python worker and file, so that tasks share its table and cache."""
    return Codec(ranks)


def little_endian(ids: array) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def lists(rows: list[np.ndarray], kind: type) -> pa.ListArray:
    """Arrow lists of the rows' numbers, without a Python object for each."""
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).astype(kind)))


def encode_texts(
    docs: DataFrame,
    ranks: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, ids_sha256, decoded_sha256, n_decoded (bytes), and
    with `keep_ids` the arrays ids and offsets (byte position of each token, and the end).

    `ranks` is the path of a rank file on the workers. Ids are those of ordinary encoding, no
    special tokens; decoded_sha256 is of the bytes that the ids decode to. Null text counts as
    empty; null ids stay; repeated rows each give a row; an empty table gives an empty one; other
    columns are ignored. Pieces of any length are merged in n log n time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks)
        for batch in batches:
            start = 0
            for part in steps(x.as_py() for x in batch.column(1)):
                encoded = coder.encode(part)
                decoded = [coder.decode(ids) for ids in encoded]
                columns = [
                    batch.column(0).slice(start, len(part)),
                    pa.array([len(x) for x in encoded], pa.int64()),
                    pa.array([hashlib.sha256(little_endian(x)).hexdigest() for x in encoded]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                    pa.array([len(x) for x in decoded], pa.int64()),
                ]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "n_decoded"]
                if keep_ids:
                    columns.append(lists([np.asarray(x, np.uint32) for x in encoded], np.int32))
                    columns.append(lists([coder.offsets(x) for x in encoded], np.int64))
                    names += ["ids", "offsets"]
                start += len(part)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_decoded long"
    if keep_ids:
        schema += ", ids array<int>, offsets array<long>"
    return map_arrow(docs.select(F.col(id_col), F.col(text_col)), run, schema)


def decode_ids(encoded: DataFrame, ranks: str, *, id_col: str = "doc_id") -> DataFrame:
    """id, text and span check of rows that encode_texts() made: decodes `ids` and cuts the bytes at
    `offsets`. Null ids decode to null; invalid UTF-8 (from cut ids) becomes U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks)
        for batch in batches:
            texts, fits = [], []
            for ids, offsets in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if ids is None:
                    texts.append(None)
                    fits.append(None)
                    continue
                texts.append(coder.decode(ids).decode(errors="replace"))
                fits.append(offsets is not None and offsets == coder.offsets(ids).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(fits, pa.bool_())],
                names=[id_col, "text", "offsets_fit"],
            )

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_arrow(encoded.select(id_col, "ids", "offsets"), run, f"`{id_col}` {kind}, text string, offsets_fit boolean")
