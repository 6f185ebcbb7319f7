"""Vectorised word handling inside Arrow tasks: splitting, hashing, windows, ragged arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text handed to one step inside a task, in bytes; a longer single text is handled alone.
STEP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece stay near ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Whole rows collected until their texts pass ``limit`` bytes."""
    held, size = [], 0
    for piece in steps(batches, column, limit):
        held.append(piece)
        size += pc.sum(pc.binary_length(piece.column(column))).as_py() or 0
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def trim() -> None:
    """Give memory that a step has let go of back to the system: Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def one_array(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    return column


def split_words(texts) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in a row, and their number per text."""
    texts = pc.fill_null(one_array(texts), "")
    lists = pc.ascii_split_whitespace(texts)
    words, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    full = pc.greater(pc.binary_length(words), 0)
    parent = parent[full.to_numpy(zero_copy_only=False)]
    return words.filter(full), np.bincount(parent, minlength=len(texts)).astype(np.int64)


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's place in the list of distinct words, and that list."""
    if not len(words):
        return np.zeros(0, np.int64), words
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def hashes(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct.to_pylist()), np.uint64, len(distinct))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``start, start + 1, …`` of every row."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ahead = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - ahead, counts)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class Spans:
    """64-bit hashes of any stretch of a word sequence, from one running sum."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        power = np.cumprod(np.full(n + 1, _BASE, np.uint64))
        back = np.cumprod(np.full(n + 1, _INVERSE, np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:n], dtype=np.uint64)])
        self.back = back

    def of(self, starts: np.ndarray, lengths) -> np.ndarray:
        return mix((self.sums[starts + lengths] - self.sums[starts]) * self.back[starts])


def window_starts(counts: np.ndarray, width: int) -> np.ndarray:
    """Places where a window of ``width`` words begins and stays inside its text."""
    starts = np.cumsum(counts) - counts
    return ragged(starts, np.maximum(counts - width + 1, 0))


def small_batches(spark) -> None:
    """Let Arrow batches end at a few MB, so that rows with long texts do not pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
