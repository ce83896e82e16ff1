"""CRC-32 of every run of words, from the running CRCs of one scan.

A text is brought to its words with one blank between them. One pass stores the CRC after each word.
CRC-32 is linear over GF(2): the checksum of a prefix, moved on by n zero bytes, cancels against that of
the longer prefix and leaves the checksum of the n bytes between them. Moving on by 2^k bytes is a
linear map of 32 bits, held as four tables of 256 entries; lengths are moved through bit by bit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np

#: Fixed value: the polynomial of CRC-32, bits reversed.
POLYNOMIAL = 0xEDB88320
#: Bytes of a text whose words are objects at a time; running CRCs go on from one piece to the next.
PIECE = 1_000_000

#: Bytes to their word characters (A-Z lowered), all separators to a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    """What one byte's value turns the register to."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ POLYNOMIAL, table >> 1).astype(np.uint32)
    return table


@lru_cache(maxsize=64)
def _move(k: int) -> np.ndarray:
    """Tables (4, 256) of moving on by 2^k zero bytes, one for each byte of the checksum."""
    if k == 0:
        start = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
        return _byte_table()[start & 255] ^ (start >> 8)
    half = _move(k - 1)
    return _through(half, half)


def _through(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


def moved(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each checksum moved on by its number of zero bytes."""
    out = crc.astype(np.uint32)
    for k in range(int(lengths.max(initial=0)).bit_length()):
        here = np.flatnonzero(lengths >> k & 1)
        out[here] = _through(_move(k), out[here])
    return out


def after_blank(crc: np.ndarray) -> np.ndarray:
    """Checksums of the same prefixes with one blank more."""
    register = ~crc.astype(np.uint32)
    return ~(_byte_table()[(register ^ 32) & 255] ^ (register >> 8))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text whose separators are blanks, each but the first with the blank before it."""
    start, first = 0, True
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            at = text.rfind(b" ", start, stop)
            stop = at if at > start else text.find(b" ", stop)
            stop = len(text) if stop < 0 else stop
        words = b" ".join(text[start:stop].split())
        if words:
            found = words.replace(b" ", b"\n ").split(b"\n")
            if not first:
                found[0] = b" " + found[0]
            first = False
            yield found
        start = stop


def running(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(crc, length) after each word of a text: the running CRC, and the bytes of prefix that it covers."""
    crcs, ends = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    crc, end, step = 0, 0, zlib.crc32
    for words in _pieces((text or b"").translate(WORD_BYTES)):
        sums = np.fromiter(accumulate(words, lambda c, w: step(w, c), initial=crc), np.uint32, len(words) + 1)[1:]
        sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + end
        crc, end = int(sums[-1]), int(sizes[-1])
        crcs.append(sums)
        ends.append(sizes)
    return np.concatenate(crcs), np.concatenate(ends)


def run_crcs(crc: np.ndarray, end: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(crc, doc) of all runs of `n` words, from running() of several texts put together; `doc` tells the text."""
    if len(crc) < n:
        return np.empty(0, np.uint32), np.empty(0, doc.dtype)
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    before = np.zeros(len(crc), np.uint32)
    before[1:] = after_blank(crc[:-1])
    start = np.zeros(len(end), np.int64)
    start[1:] = end[:-1] + 1
    before[first], start[first] = 0, 0
    last = len(crc) - n + 1
    whole = np.flatnonzero(doc[:last] == doc[n - 1 :])
    return crc[whole + n - 1] ^ moved(before[whole], end[whole + n - 1] - start[whole]), doc[whole]
