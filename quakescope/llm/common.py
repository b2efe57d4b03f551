"""Shared helpers: scratch tables, Arrow text access, word and range hashes.

Texts are handled as UTF-8 bytes.  The word separators of all operators here
are the six ASCII blanks, so splitting bytes equals splitting characters.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.session import scratch_path

#: Bytes of text worked on at once; the arrays made from them take about 40 times as much.
CHUNK_BYTES = 2 << 20

_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_CODE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_POWERS = np.ones(1, _U), np.ones(1, _U)


# ---- tables in the shared folder -------------------------------------------------


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later steps re-read it instead of running it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_column: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids take the text ``''``."""
    col = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus


def width(df: DataFrame) -> int:
    """Partitions to deal keyed work over: the session's count, or the input's splits if more."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


# ---- memory of Python workers ----------------------------------------------------


@functools.cache
def _trim() -> Callable[[int], int]:
    """The C library's call that gives freed memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the memory that it freed goes back to the system: workers outlive their tasks and stages."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return whole


# ---- text as bytes ---------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes in one array, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8, last - first, first) if data and last > first else np.zeros(0, np.uint8)
    return data, offsets - first


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and for each text the number of words before it (n + 1 values)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_BLANK[data]
    opens = np.ones(n + 1, bool)
    opens[1:n] = ~solid[:-1]
    opens[offsets] = True
    starts = np.flatnonzero(solid & opens[:n])
    closes = np.ones(n, bool)
    closes[:-1] = ~solid[1:]
    closes[offsets[offsets > 0] - 1] = True
    ends = np.flatnonzero(solid & closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def keep_texts(docs: DataFrame, text_column: str, judge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The rows, with all their columns, whose text ``judge`` (bytes, offsets -> true or false each) keeps."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_column))
            for lo, hi, data, offsets in chunks(text, CHUNK_BYTES // 2):
                yield batch.slice(lo, hi - lo).filter(pa.array(judge(data, offsets), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


# ---- hashes ----------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()

        def series(base: int) -> np.ndarray:
            out = np.full(size, _U(base & _MASK))
            out[0] = 1
            return np.cumprod(out, dtype=_U)

        _POWERS = series(_BASE), series(pow(_BASE, -1, 1 << 64))
    return _POWERS


def hash_ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of each values[start:end]: one prefix sum, two look-ups a range."""
    power, inverse = _powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, _U)
    np.cumsum(values * power[: len(values)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(_U))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return hash_ranges(_BYTE_CODE[data], starts, ends)


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of ``size`` words within one text, and each run's text."""
    many = np.maximum(np.diff(first) - size + 1, 0)
    doc = np.repeat(np.arange(len(many)), many)
    before = np.cumsum(many) - many
    return np.arange(int(many.sum())) - before[doc] + first[:-1][doc], doc


# ---- Arrow columns ---------------------------------------------------------------


def binary_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per count: the next ``count`` items of ``values``, as bytes."""
    ends = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.asarray(counts, np.int64) * values.itemsize, out=ends[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def list_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def floats(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are complete and finite, by length: (row numbers, lengths)."""
    good = np.array(pc.is_valid(column))
    lengths = np.array(pc.fill_null(pc.list_value_length(column), 0))
    good &= lengths > 0
    parent = np.array(pc.list_parent_indices(column))
    flat = column.flatten()
    bad = ~np.isfinite(np.array(pc.fill_null(flat.cast(pa.float64()), np.nan)))
    good[parent[bad]] = False
    return np.flatnonzero(good), lengths
