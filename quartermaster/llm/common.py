"""Helpers shared by the corpus operators: ASCII word splitting and vectorised
polynomial hashing over Arrow batches, sliding minima, and streaming over
sorted groups inside a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.session import ensure_checkpoint_dir

WORD_SPACE = "\t\n\x0b\x0c\r "  # the separators of `[^\x20\x09-\x0D]+`
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
_ASCII_UP, _ASCII_LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BASE_A = np.uint64(0x9E3779B97F4A7C15)
BASE_B = np.uint64(0xC2B2AE3D27D4EB4F)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(c, _ASCII_UP, _ASCII_LOW)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the session's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def counted_side(df: DataFrame, rows: int = 1_000_000, weight: Column | None = None) -> DataFrame:
    """A side of few narrow columns for a join: counted, and broadcast if it has
    at most `rows` rows (some 50 MB); otherwise the join shuffles. `weight` is
    what a row counts as if it holds an array."""
    df = cut(df)
    n = df.count() if weight is None else df.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    return F.broadcast(df) if n <= rows else df


def text_key(text: str = "text") -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def texts_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes as one buffer, and the n + 1 offsets (null: empty)."""
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that their order is that of random numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def prefix(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """Prefix sums of value[i] * base^-i' written so that equal substrings
    compare equal after `window_hash`."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), base), out=out[1:])
    return out


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def window_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64, inv: np.ndarray | None = None) -> np.ndarray:
    """Hash of values[start:end] for every pair, from `prefix`; equal sequences hash equal."""
    if inv is None:
        inv = powers(int(start.max()) + 1 if len(start) else 1, inverse(base))
    return mix((pre[end] - pre[start]) * inv[start] + (end - start).astype(np.uint64))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes other than the ASCII white space."""
    word = (data != 32) & ((data < 9) | (data > 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
    return edge[0::2], edge[1::2]


def split_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends over a batch of texts, words never crossing texts,
    and the word index at which each text begins (n + 1 values)."""
    gap = np.full(len(data) + len(offs) - 1, 32, np.uint8)
    shift = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    gap[np.arange(len(data)) + shift] = data
    s, e = word_bounds(gap)
    first = np.searchsorted(s, offs + np.arange(len(offs)))
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    return s - doc, e - doc, first


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, base: np.uint64 = BASE_A) -> np.ndarray:
    return window_hash(prefix(data.astype(np.uint64) + np.uint64(1), base), s, e, base)


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    k, cur = 1, a
    while 2 * k <= w:
        cur = np.minimum(cur[:-k], cur[k:])
        k *= 2
    return np.minimum(cur[:len(cur) - (w - k)], cur[w - k:]) if w > k else cur


def sub_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about `limit` bytes of one column
    (or a single row), which bounds what a task holds at a time."""
    for b in batches:
        size = np.concatenate(([0], np.cumsum(binary_lengths(b.column(column)))))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(size, size[at] + limit, side="right")) - 1)
            yield b.slice(at, to - at)
            at = to


def binary_lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], min_rows: int = 20_000) -> Iterator[pa.Table]:
    """Rows sorted by `keys`, re-cut so that no group is split: tables of at
    least `min_rows` rows (the last may be shorter) that end at a group's end."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < min_rows:
            continue
        t = pa.Table.from_batches(held)
        last = changed_at(t, keys)
        if last.any():
            end = int(np.flatnonzero(last)[-1]) + 1
            yield t.slice(0, end)
            t = t.slice(end)
        held, n = t.combine_chunks().to_batches(), t.num_rows
    if n:
        yield pa.Table.from_batches(held)


def changed_at(t: pa.Table, keys: list[str]) -> np.ndarray:
    """For each row but the last: whether the next row has another key."""
    out = np.zeros(max(t.num_rows - 1, 0), bool)
    for k in keys:
        v = t.column(k).to_numpy()
        out |= v[1:] != v[:-1]
    return out


def map_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """`mapInArrow` whose worker hands freed memory back at the end of a
    partition: workers are used again for other tasks, beside the executor."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim_memory()

    return df.mapInArrow(run, schema)


def trim_memory() -> None:
    import ctypes
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def as_long(u: np.ndarray) -> np.ndarray:
    return u.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offs = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, type=kind))
