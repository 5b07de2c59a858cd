"""Hashes of whole texts' words by numpy, many short texts or pieces of a long
one at a time, and bitmaps of hashes.

A word's hash is a polynomial of its bytes (a random odd number for each byte,
powers of another) and its length, spread by a bijection; a word over ``_LONG``
bytes is hashed by XXH64.  Equal words have equal hashes wherever they are cut;
different words share one with probability about 2^-64.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of a bitmap, at most.
MOST_BITS = 26

_PIECE = 1 << 20    # bytes hashed at once
_LONG = 1 << 12     # a longer word is hashed on its own
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for every byte, powers of an odd number, and odd factors for the words of a shingle (from one seed)."""
    rng = np.random.default_rng(20)
    draw = rng.integers(0, 1 << 63, 256 + 1 + 64, dtype=np.int64).astype(_U) * _U(2) + _U(1)
    powers = np.cumprod(np.concatenate([[_U(1)], np.full(_LONG - 1, draw[256])]), dtype=_U)
    return draw[:256], powers, draw[257:]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (in place of a second hash)."""
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def _piece_hashes(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of a lower-case piece."""
    raw = np.frombuffer(piece, np.uint8)
    word = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return starts, np.zeros(0, _U)
    size = ends - starts
    of_byte, powers, _ = _tables()
    at = np.flatnonzero(word[1:-1])
    place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    values = of_byte[raw[at]] * powers[np.minimum(place, _LONG - 1)]
    out = np.add.reduceat(values, np.cumsum(size) - size) + size.astype(_U) * _U(0x9E3779B97F4A7C15)
    for i in np.flatnonzero(size > _LONG):
        out[i] = xxhash.xxh64_intdigest(piece[starts[i]:ends[i]])
    return starts, mixed(out)


def _cuts(text: bytes) -> Iterator[bytes]:
    """Pieces of a long text that cut no word."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        if end < len(text):
            back = max(text.rfind(bytes([c]), at, end) for c in (9, 10, 11, 12, 13, 32))
            if back > at:
                end = back
            else:
                found = _BLANK.search(text, end)
                end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def word_hashes(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The hashes of each text's words, many short texts at a time."""
    held, size = [], 0

    def release():
        starts, hashes = _piece_hashes(b" ".join(held).lower())
        begins = np.cumsum([0] + [len(t) + 1 for t in held])
        cut = np.searchsorted(starts, begins)
        for a, b in zip(cut[:-1], cut[1:]):
            yield hashes[a:b]

    for text in texts:
        if size + len(text) > _PIECE and held:
            yield from release()
            held, size = [], 0
        if len(text) > _PIECE:
            yield np.concatenate([_piece_hashes(p.lower())[1] for p in _cuts(text)])
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield from release()


def word_factors() -> np.ndarray:
    """Odd factors for the words of a sequence."""
    return _tables()[2]


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Bits of a table of numbers, 16 or more for each, 2^MOST_BITS at most: tells most rows that are not in it."""
    bits = min(MOST_BITS, max(16, int(16 * keys.count()).bit_length()))
    span = bits - 6

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch["at"].to_numpy()
            for part in np.unique(at >> span).tolist():
                parts.setdefault(part, np.zeros(1 << span, bool))[at[at >> span == part] & ((1 << span) - 1)] = True
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([np.packbits(v).tobytes() for v in parts.values()], pa.binary())], ["part", "bits"])

    places = keys.select(F.col(column).bitwiseAND(F.lit((1 << bits) - 1)).alias("at"))
    rows = places.repartition(F.shiftright("at", span)).mapInArrow(mark, "part bigint, bits binary").toArrow()
    out = np.zeros((1 << bits) // 8, np.uint8).reshape(64, -1)
    for part, row in zip(rows["part"].to_pylist(), rows["bits"].to_pylist()):
        out[part] = np.frombuffer(row, np.uint8)
    return out.reshape(-1)


def within(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which numbers (of 64 bits, signed or not) are marked in a bitmap; those that were put in always are."""
    at = numbers.view(np.int64) & (len(bits) * 8 - 1)
    return bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1
