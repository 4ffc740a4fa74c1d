"""Byte-level repeat removal with a Burrows-Wheeler transform.

Candidate stretches meet in their minimiser's bucket (see `repeats`). There
the distinct stretches are joined to one text, whose rotations are sorted by
their first `length` bytes. Longest common prefixes come from the transform
alone, by increasing value: starting from the interval of the empty string,
every interval is extended by one byte to the left (LF mapping of the runs
inside it), breadth first; an interval of a string of length l whose right
border has no value yet sets that border to l and goes on. The search stops
at `length`: borders still without a value separate neighbours that share at
least `length` bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import binary_lengths, map_arrow, sub_batches, texts_of, whole_groups
from quartermaster.llm.repeats import (CHUNK, Units, covered, part_rows, repeated_stretches, rows_with_key, stretches,
                                       with_changes)


def sort_rotations(text: np.ndarray, length: int) -> np.ndarray:
    """Start positions of the rotations of `text` (values 0 to 256), sorted by
    their first `length` symbols or a few more: by the first seven, then by
    prefix doubling of the groups that are still tied."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for j in range(7):  # symbols of 9 bits
        key = (key << 9) | np.roll(text, -j)
    order = np.argsort(key)
    slot, rank, k = np.arange(n), np.empty(n, np.int64), 7  # rank: the slot at which a rotation's group begins
    key = key[order]
    while True:
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order[slot]] = np.maximum.accumulate(np.where(new, slot, 0))
        tied = ~(new & np.append(new[1:], True))
        slot = slot[tied]
        if k >= length or not len(slot):
            return order
        at = order[slot]
        key = (rank[at] << 32) | rank[(at + k) % n]
        by = np.argsort(key)
        order[slot], key = at[by], key[by]
        k *= 2


def borders_below(bwt: np.ndarray, length: int) -> np.ndarray:
    """For each border i between sorted rotations i - 1 and i: whether their
    common prefix is shorter than `length` (True at 0 and n)."""
    n = len(bwt)
    lf = np.empty(n, np.int64)
    lf[np.argsort(bwt, kind="stable")] = np.arange(n)
    new = np.concatenate(([True], bwt[1:] != bwt[:-1]))
    run = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    finish = np.append(begin[1:], n) - 1
    symbol = bwt[begin].astype(np.int64)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    lb, rb = np.array([0]), np.array([n - 1])
    for _ in range(length):  # the interval of a string of length l sets borders to l - 1
        if not len(lb):
            break
        a, b = run[lb], run[rb]
        size = b - a + 1
        part = np.repeat(np.arange(len(lb)), size)
        r = np.arange(len(part)) - np.repeat(np.cumsum(size) - size, size) + a[part]
        lo, hi = np.maximum(begin[r], lb[part]), np.minimum(finish[r], rb[part])
        key = part * 512 + symbol[r]
        order = np.argsort(key, kind="stable")
        key = key[order]
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        left = lf[lo[order[edge]]]
        right = lf[hi[order[np.append(edge[1:], len(key)) - 1]]]
        fresh = ~known[right + 1]
        lb, rb = left[fresh], right[fresh]
        known[rb + 1] = True
    return known


def repeated_starts(pieces: pa.Array, length: int) -> np.ndarray:
    """For every window of the distinct pieces, in order: whether it starts elsewhere in them too."""
    data, offs = texts_of(pieces)
    size = np.diff(offs)
    if not len(size):
        return np.zeros(0, bool)
    # symbols 1 to 256, 0 ends each piece
    text = np.zeros(len(data) + len(size), np.int16)
    text[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = data.astype(np.int16) + 1
    order = sort_rotations(text, length)
    same = np.flatnonzero(~borders_below(text[order - 1], length)[1:-1]) + 1
    shared = np.zeros(len(text), bool)
    shared[order[same]] = True
    shared[order[same - 1]] = True
    wins = size - length + 1
    begin = np.repeat(offs[:-1] + np.arange(len(size)), wins)
    return shared[begin + np.arange(len(begin)) - np.repeat(np.cumsum(wins) - wins, wins)]


def expand_intervals(length: int):
    """Decides within buckets: rows sorted by minimiser, with `piece`."""
    def decide(batches):
        for t in whole_groups(batches, ["mini"], 4_000):
            t = t.combine_chunks()
            enc = t.column("piece").chunk(0).dictionary_encode()
            index = enc.indices.to_numpy()
            times = np.bincount(index, weights=binary_lengths(t.column("starts").chunk(0)) // 4, minlength=len(enc.dictionary))
            first = np.unique(index, return_index=True)[1]
            # a piece alone in its bucket has nothing to be compared with
            _, bucket, pieces = np.unique(t.column("mini").to_numpy()[first], return_inverse=True, return_counts=True)
            alone = pieces[bucket] == 1
            data, offs = texts_of(enc.dictionary)
            size = np.diff(offs)
            wins = size - length + 1
            own = np.repeat(np.arange(len(size)), wins)
            at = np.arange(len(own)) - np.repeat(np.cumsum(wins) - wins, wins)
            # equal pieces are one in the text; all windows of such a piece are repeats
            hit = times[own] > 1
            hit[~alone[own]] |= repeated_starts(enc.dictionary.filter(pa.array(~alone)), length)
            hit = np.flatnonzero(hit)
            p, lo, hi = stretches(own[hit], at[hit])
            # from the distinct pieces to all rows, row after row
            count = np.bincount(p, minlength=len(size))[index]
            begin = np.searchsorted(p, index)
            which = np.repeat(begin, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            yield from part_rows(t, np.repeat(np.arange(len(index)), count), lo[which], hi[which])

    return decide


def changed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                      mer: int = 64, bucket_limit: int = 4000) -> DataFrame:
    """The rows that lose bytes: id, key (hash of the text), n_bytes,
    n_removed, spans, kept, as `remove_repeated_bytes` has them."""
    rows = rows_with_key(docs, id_col, text_col)
    found = repeated_stretches(rows, Units("bytes", length, min(mer, length)), expand_intervals(length), bucket_limit)
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])

    def keep(batches):
        for b in sub_batches(batches, "text", CHUNK):
            total, gone, removed, kept = [], [], [], []
            spans = b.column("spans")
            for i, text in enumerate(b.column("text").cast(pa.large_binary()).to_pylist()):
                text = text or b""
                drop = covered(len(text), spans[i], length)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], drop.view(np.int8), [0])))).tolist()
                removed.append([{"lo": a, "hi": z} for a, z in zip(edge[0::2], edge[1::2])])
                total.append(len(text)), gone.append(int(drop.sum()))
                kept.append(np.frombuffer(text, np.uint8)[~drop].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("key"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(removed, pa.list_(span)), pa.array(kept, pa.binary())],
                ["id", "key", "n_bytes", "n_removed", "spans", "kept"])

    return map_arrow(found, keep, f"id {kind}, key bigint, n_bytes bigint, n_removed bigint, "
                                  "spans array<struct<lo: int, hi: int>>, kept binary")


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, **options) -> DataFrame:
    """Removes every byte of the UTF-8 texts covered by a string of `length`
    bytes that also starts anywhere else, in the same row or another.

    Strings never cross rows and are judged on the input. Returns one row for
    each input row: `id_col`, n_bytes, n_removed, spans (array of maximal
    removed (lo, hi) byte ranges), kept (binary: the remaining bytes, which
    need not be valid UTF-8; with `digest` their SHA-256 instead, so that
    unchanged texts needn't move). Options as in `changed_documents`.

    Null and empty texts give 0, 0, no spans and empty bytes; texts shorter
    than `length` stay whole; rows equal in id and text repeat each other; an
    empty table gives an empty result; other columns are not read, whatever
    their names, and a null id is kept.
    """
    changed = changed_documents(docs, id_col, text_col, **options)
    whole = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = rows_with_key(docs, id_col, text_col).select("id", "key", F.octet_length(whole).cast("bigint").alias("all"), whole.alias("whole"))
    if digest:
        rows, changed = (x.withColumn(c, F.sha2(c, 256)) for x, c in ((rows, "whole"), (changed, "kept")))
    none = F.array().cast("array<struct<lo: int, hi: int>>")
    out = with_changes(rows, changed, {"n_bytes": F.col("all"), "n_removed": F.lit(0).cast("bigint"), "spans": none, "kept": F.col("whole")})
    return out.withColumnRenamed("id", id_col)
