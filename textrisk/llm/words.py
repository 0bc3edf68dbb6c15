"""Words of Arrow text columns as 64-bit hashes, for many texts at once.

A word is a run of bytes of a given class in the UTF-8 text, with A-Z read as a-z. All
bytes of a character beyond ASCII count as one class, so words never cut a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows handed to a Python task at once, at most.
BATCH_ROWS = 1000

# Texts are worked on in slices of about so many bytes; one longer text is its own slice.
SLICE_BYTES = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (one to one)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def small_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python tasks in batches that a small executor can hold."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


class WordClass:
    """Which bytes make up words; ``contains`` is asked for each byte after A-Z became a-z."""

    def __init__(self, contains):
        lowered = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
        self.member = np.array([contains(b) for b in lowered])
        self.codes = np.where(self.member, _BYTE_CODES[lowered], np.uint64(0))


#: Runs of anything but ASCII white space.
SPACED = WordClass(lambda b: b != 32 and not 9 <= b <= 13)
#: Runs of ASCII letters, digits and everything beyond ASCII.
ALPHANUMERIC = WordClass(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)

_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < size:
        _powers = tuple(
            np.concatenate(
                [np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, base, np.uint64))]
            )
            for base in (_ODD, _ODD_INVERSE)
        )
    return _powers


@dataclass(frozen=True)
class Words:
    """Words of some texts in order: hash, first and last byte (exclusive), and for each
    text the number of its first word (one entry more than texts)."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def of(self, text: int) -> slice:
        return slice(self.first[text], self.first[text + 1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins. Null reads as empty."""
    filled = column.fill_null("") if column.null_count else column
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    if pa.types.is_large_string(filled.type):
        kind = np.int64
    else:
        filled, kind = filled.cast(pa.string()), np.int32
    _, offsets, data = filled.buffers()
    bounds = np.frombuffer(offsets, kind)[filled.offset : filled.offset + len(filled) + 1]
    bounds = bounds.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``size`` bytes together; every row in one of them."""
    if not len(column):
        return
    _, bounds = text_bytes(column)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(bounds, bounds[begin] + size, "right")) - 1
        end = min(max(end, begin + 1), len(column))
        yield begin, end
        begin = end


def find_words(data: np.ndarray, bounds: np.ndarray, kind: WordClass) -> Words:
    size = len(data)
    inside = kind.member[data]
    text_starts = bounds[:-1][bounds[:-1] < size]
    text_ends = bounds[1:][bounds[1:] > 0] - 1
    before = np.zeros(size, bool)
    before[1:] = inside[:-1]
    before[text_starts] = False
    after = np.zeros(size, bool)
    after[:-1] = inside[1:]
    after[text_ends] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    power, inverse = _power_tables(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(kind.codes[data] * power[:size], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.searchsorted(starts, bounds))


def chain(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on (fewer entries than words)."""
    count = max(len(hashes) - length + 1, 0)
    out = np.zeros(count, np.uint64)
    for step in range(length):
        out = mix(out * _GOLD + hashes[step : step + count] + np.uint64(step + 1))
    return out
