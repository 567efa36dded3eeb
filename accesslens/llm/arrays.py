"""Text columns of Arrow batches as flat arrays: word borders and hashes without a loop per word.

A block is a slice of a batch with a bounded number of bytes, one document at least. Hashes are
polynomials over random 64-bit values, wrapped to 64 bits, taken from prefix sums and mixed.
"""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import SparkSession

BLOCK_BYTES = 4 << 20
SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_tables: dict = {}


def not_space() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    keep = np.ones(256, bool)
    keep[[0x20, *range(0x09, 0x0E)]] = False
    return keep


def alphanumeric() -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, after lower-casing A-Z."""
    keep = np.zeros(256, bool)
    keep[0x30:0x3A] = keep[0x61:0x7B] = keep[0x80:] = True
    return keep


def lower_table() -> np.ndarray:
    """A-Z to a-z, all other bytes unchanged."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of each piece have ``most`` bytes or are one row. At the end, memory that is
    free goes back to the system: Python workers live on, and those of earlier stages would keep it."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + most, "right")))
            yield batch.slice(at, end - at)
            at = end
    release()


def release() -> None:
    """Gives free memory back to the system, where its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row begins (one more than rows). Null: empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    else:
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def borders(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and how many words come before each row (one more than rows)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = keep[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]  # where two rows touch
    first[cuts] = inside[1:-1][cuts]
    last[cuts - 1] = inside[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse mod 2^64, ``n`` at least; kept per worker."""
    have = _tables.get(("powers", seed))
    if have is None or len(have[0]) < n:
        base, size = seed | 1, max(n, 1 << 16)
        up, down = (np.full(size, x, np.uint64) for x in (base, pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        have = _tables[("powers", seed)] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have


def ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A hash of ``values[start:end]`` for each range; equal ranges have equal hashes wherever they lie."""
    total, down = sums(values, seed)
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sums(values: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the values times powers, and the inverse powers: what hashes of ranges are made of."""
    up, down = powers(len(values) + 1, seed)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return total, down


def byte_table(seed: int) -> np.ndarray:
    """A random value for every byte; kept per worker."""
    if ("bytes", seed) not in _tables:
        _tables[("bytes", seed)] = np.random.default_rng(seed & 0xFFFFFFFF).integers(1, 1 << 64, 256, np.uint64)
    return _tables[("bytes", seed)]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEEDS[0]) -> np.ndarray:
    """A hash of every word's bytes; words in order, none inside another. Works on a slice of the bytes at a time."""
    table, out, at = byte_table(seed), np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 20), "right")))
        low = starts[at]
        out[at:end] = ranges(table[data[low : ends[end - 1]]], starts[at:end] - low, ends[at:end] - low, seed)
        at = end
    return out


def prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...],
                  seed: int = SEEDS[0]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(word number, size, hash) as arrays: of whole words (size 0), and of the first bytes of those longer than each
    size. The hashes are those of :func:`word_hashes`; a slice's prefix sums are made once for all sizes."""
    table, at = byte_table(seed), 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 20), "right")))
        low = starts[at]
        total, down = sums(table[data[low : ends[end - 1]]], seed)
        begin, long = starts[at:end] - low, ends[at:end] - starts[at:end]
        words, before, scale = np.arange(at, end), total[begin], down[begin]
        yield words, 0, mixed((total[begin + long] - before) * scale + long.astype(np.uint64))
        for size in sizes:
            some = np.flatnonzero(long > size)
            yield words[some], size, mixed((total[begin[some] + size] - before[some]) * scale[some] + np.uint64(size))
        at = end


def windows(hashes: np.ndarray, width: int, seed: int = SEEDS[0]) -> np.ndarray:
    """A hash of every run of ``width`` consecutive values."""
    n = max(0, len(hashes) - width + 1)
    starts = np.arange(n)
    return ranges(hashes, starts, starts + width, seed)


def rows_of(firsts: np.ndarray) -> np.ndarray:
    """The row of every word, from how many words come before each row."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """A broadcast value of bounded size, to be fetched in tasks; its class goes with it."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def fetch() -> object:
        return pickle.loads(sent.value)

    return fetch
