"""Vector code compression: each vector becomes one byte for each part, the
nearest entry of that part's codebook.

Arithmetic is over integers, so a codebook doesn't depend on how rows are
dealt out. The nearest entry is found by slices and masks (`nearest`): the
entries' coordinates are sorted in every dimension, and prefix masks tell
which entries come before a place. A radius that is known to reach an entry
selects a range of places in each dimension; the ranges' masks, one uint64 for
each vector and dimension, are ANDed, and only the entries left are measured.
Any entry within the radius lies in every range, so the result is exact.

Each round is one pass over the vectors that hands on sums for each part,
entry and place, whatever the number of rows; the codebooks (parts x entries
numbers) are the only thing on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.vectors import finite, whole_rows

MOST_ENTRIES = 64  # bits of a mask


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x). Saturates where squared distances could leave 64 bits
    (at +-2^27 for 64 components, that is at |x| of 32,768 for a scale of 4096)."""
    bound = 1 << int((62 - np.ceil(np.log2(max(values.shape[1], 1)))) // 2 - 1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -bound, bound).astype(np.int64)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of `x` the nearest row of `book` (ties to the lower one) and its squared distance."""
    entries, dims = book.shape
    order = np.argsort(book, axis=0, kind="stable")
    coords = np.take_along_axis(book, order, 0)
    before = np.zeros((entries + 1, dims), np.uint64)  # before[i, j]: the entries at the first i places of dimension j
    before[1:] = np.bitwise_or.accumulate(np.uint64(1) << order.astype(np.uint64), axis=0)
    # the initial radius reaches the entry whose first coordinate comes next
    best = order[np.searchsorted(coords[:, 0], x[:, 0]).clip(0, entries - 1), 0]
    least = ((x - book[best]) ** 2).sum(axis=1)
    radius = np.sqrt(least.astype(np.float64)).astype(np.int64) + 1
    left = np.full(len(x), np.iinfo(np.uint64).max, np.uint64)
    for j in range(dims):
        lo = np.searchsorted(coords[:, j], x[:, j] - radius, "left")
        hi = np.searchsorted(coords[:, j], x[:, j] + radius, "right")
        left &= before[hi, j] ^ before[lo, j]
    for e in range(entries):
        rows = np.flatnonzero(left & np.uint64(1 << e))
        d = ((x[rows] - book[e]) ** 2).sum(axis=1)
        closer = (d < least[rows]) | ((d == least[rows]) & (e < best[rows]))
        best[rows[closer]], least[rows[closer]] = e, d[closer]
    return best, least


def assigned(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each part, and the squared distances summed over the parts; books: parts x entries x width."""
    parts, _, width = books.shape
    codes, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
    for p in range(parts):
        codes[:, p], d = nearest(np.ascontiguousarray(x[:, p * width:(p + 1) * width]), books[p])
        error += d
    return codes, error


def first_books(df: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """The parts of the first vectors by id (nulls last; rows of one id by their components)."""
    order = [F.asc_nulls_last("id"), "vector"]
    usable = df.filter(finite("vector") & (F.size("vector") % parts == 0)).select("id", "vector")
    rows = usable.orderBy(*order).limit(entries).collect()
    if not rows:
        return None
    dims = len(rows[0]["vector"])
    if any(len(r["vector"]) != dims for r in rows):
        rows = usable.filter(F.size("vector") == dims).orderBy(*order).limit(entries).collect()
    x = integers(np.array([r["vector"] for r in rows], np.float64), scale)
    return np.ascontiguousarray(x.reshape(len(x), parts, -1).transpose(1, 0, 2))


def next_books(df: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts nearest to it."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]):
        total, seen = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            x = integers(whole_rows(b.column("vector"), parts * width)[1], scale)
            codes, _ = assigned(x, books)
            for p in range(parts):
                for e in range(entries):
                    own = x[codes[:, p] == e, p * width:(p + 1) * width]
                    total[p, e] += own.sum(axis=0)
                    seen[p, e] += len(own)
        if seen.any():
            p, e, k = np.indices(books.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v.ravel().astype(np.int64)) for v in (p, e, k, np.repeat(seen[:, :, None], width, 2), total)],
                ["part", "entry", "place", "n", "total"])

    sums = df.select("vector").mapInArrow(run, "part bigint, entry bigint, place bigint, n bigint, total bigint")
    out = books.copy()
    for r in sums.groupBy("part", "entry", "place").agg(
            F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).filter("n > 0").collect():
        out[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return out


def compress_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: Sequence[str] = (), parts: int = 8,
                     entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray | None]:
    """Codes of all vectors, and the codebooks (parts x entries x width integers).

    A component x counts as floor(scale * x). The codebook of a part starts as
    that part of the first `entries` vectors by id and is refined in `rounds`
    rounds. The frame has, for each vector: `id_col`, the columns `keep`, code
    (binary, one byte a part: the entry's number), error (squared distance to
    the coded vector, in scaled units).

    Vectors that are null or empty, hold null or non-finite components, don't
    fall into `parts` equal parts, or have another length than the vector of
    the smallest id are left out. Repeated ids and equal vectors are rows like
    any other; a null id comes last; ties go to the lower entry. With fewer
    vectors than entries there are as many entries as vectors; without any, no
    rows and None. Other columns aren't read, whatever their names. Very large
    components saturate (`integers`).
    """
    if not 1 <= entries <= MOST_ENTRIES:
        raise ValueError(f"1 to {MOST_ENTRIES} entries")
    held = [f"keep_{i}" for i in range(len(keep))]
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), *[F.col(c).alias(h) for c, h in zip(keep, held)])
    names = [id_col, *keep, "code", "error"]
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", *held)]
    schema = ", ".join([*(f"{c} {k}" for c, k in zip(("id", *held), kinds)), "code binary, error bigint"])
    books = first_books(rows, parts, entries, scale)
    if books is None:
        return rows.sparkSession.createDataFrame([], schema).toDF(*names), None
    for _ in range(rounds):
        books = next_books(rows, books, scale)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            at, x = whole_rows(b.column("vector"), books.shape[0] * books.shape[2])
            codes, error = assigned(integers(x, scale), books)
            offs = (np.arange(len(at) + 1) * parts).astype(np.int32)
            code = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(codes))])
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in ("id", *held)), code, pa.array(error)],
                                             ["id", *held, "code", "error"])

    return rows.mapInArrow(run, schema).toDF(*names), books


def decoded(code: bytes, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in scaled units."""
    return np.concatenate([books[p, e] for p, e in enumerate(code)])


def books_digest(books: np.ndarray | None) -> str:
    """SHA-256 of all entries' integers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, [] if books is None else books.ravel().tolist())).encode()).hexdigest()
