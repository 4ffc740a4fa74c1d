"""Distributed search for windows that occur more than once in a corpus.

Both repeat operators (bytes and words) cut every text into units and look
at all windows of W consecutive units. To bring equal windows together
without shipping every window, each window is assigned its minimiser: the
smallest hash among its m-unit substrings. Equal windows have the same
minimiser, and consecutive windows mostly share it, so a run of such windows
travels as one piece.

1. `runs_of` lists each document's runs (minimiser, first window, number of
   windows); a run ends where its minimiser's place changes. One aggregate counts the runs of each minimiser; a minimiser
   with one run has no repeat and nothing of it travels.
2. The repeated runs are gathered per document and joined with the text,
   which is cut into pieces; the pieces go to their minimiser's bucket.
3. The operator decides inside the buckets (`decide`).
4. A minimiser with more than `bucket_limit` runs is split further
   (`hot_stretches`): its equal pieces are one, with a count, and the distinct
   pieces are dealt out anew by minimisers over more units, which fewer
   windows share. Only what is still in a bucket beyond the limit after
   `finer` such rounds is counted window by window, by a 128-bit hash and with
   partial aggregation, so no group of one key meets in one task.
5. The repeated stretches are gathered per document and joined with the
   texts of step 2, which are already dealt by document.

Rows are told apart by id and text hash; rows equal in both count as two
documents, like any other two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import (BASE_A, BASE_B, as_long, cut, map_arrow, mix, prefix, sliding_min,
                                      split_words, sub_batches, text_key, texts_of, window_hash, word_hashes)

CHUNK = 1 << 19  # bytes of text that a task hashes at a time, some 100 bytes of arrays for each
PARTS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


@dataclass(frozen=True)
class Units:
    """How texts fall into units: `kind` bytes or words, windows of `window`
    units, minimisers over `mer` units; buckets too large are dealt out anew
    `finer` times."""
    kind: str
    window: int
    mer: int
    finer: int = 2

    def next(self) -> Units:
        """The same windows, minimisers half way to a window's length."""
        return replace(self, mer=(self.mer + self.window) // 2, finer=self.finer - 1)

    def values(self, col: pa.Array, base=BASE_A) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each unit of the batch, and where each text begins."""
        data, offs = texts_of(col)
        if self.kind == "bytes":
            return data.astype(np.uint64) + np.uint64(1), offs
        s, e, first = split_words(data, offs)
        return word_hashes(data, s, e, base), first

    def cut_pieces(self, text: bytes, starts: np.ndarray, wins: np.ndarray) -> list[bytes]:
        ends = starts + wins + (self.window - 1)
        if self.kind == "bytes":
            return [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        w = text.split()
        return [b" ".join(w[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]


def minimiser_runs(u: Units, values: np.ndarray, first: np.ndarray):
    """Runs of windows with one minimiser, the leftmost least hash at one place:
    (minimiser, first window within its text, number of windows, text)."""
    n, W, m = len(values), u.window, u.mer
    if n < W:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    pre, at = prefix(values, BASE_A), np.arange(n - m + 1)
    hashes = window_hash(pre, at, at + m, BASE_A)
    least = sliding_min(hashes, W - m + 1)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = np.arange(n - W + 1)
    start = start[doc[start] == doc[start + W - 1]]
    least, doc, leaves = least[start], doc[start], hashes[start] == least[start]
    if not len(start):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    new = np.ones(len(start), bool)
    # a run also ends with the window that begins with its minimiser: the next has it elsewhere
    new[1:] = (start[1:] != start[:-1] + 1) | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | leaves[:-1]
    at = np.flatnonzero(new)
    return least[at], start[at] - first[doc[at]], np.diff(np.append(at, len(start))), doc[at]


def grouped_ints(keys: list[np.ndarray], *values: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Rows grouped by `keys`: the first row of each group, and its values as
    little-endian 32-bit numbers in a row (v1, v2, ... of every member)."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    at = np.flatnonzero(new)
    flat = np.stack([v[order] for v in values], axis=1).astype("<i4")
    offs = (np.append(at, len(order)) * 4 * len(values)).astype(np.int32)
    return order[at], pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(flat))])


def runs_of(docs: DataFrame, u: Units) -> DataFrame:
    """One row for each text and minimiser: id, key, mini, runs (start, number
    of windows of each, as 32-bit numbers)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in sub_batches(batches, "text", CHUNK):
            values, first = u.values(b.column("text"))
            mini, start, wins, doc = minimiser_runs(u, values, first)
            if len(doc):
                first, runs = grouped_ints([doc, mini], start, wins)
                take = pa.array(doc[first])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(take), b.column("key").take(take), pa.array(as_long(mini[first])), runs],
                    ["id", "key", "mini", "runs"])

    return map_arrow(docs, run, f"id {kind}, key bigint, mini bigint, runs binary")


def pieces_of(found: DataFrame, u: Units) -> DataFrame:
    """The repeated runs as packed strings, equal ones of a text as one row:
    id, key, mini, starts (32-bit numbers), piece."""
    kind = found.schema["id"].dataType.simpleString()

    def run(batches):
        for b in sub_batches(batches, "text", CHUNK):
            texts, runs = b.column("text").cast(pa.large_binary()).to_pylist(), b.column("runs")
            docs, minis, starts, out = [], [], [], []
            for i, text in enumerate(texts):
                s, w, mini = distinct_runs(runs[i])
                same: dict = {}
                for start, m, piece in zip(s.tolist(), mini.tolist(), u.cut_pieces(text or b"", s, w)):
                    same.setdefault((m, piece), []).append(start)
                for (m, piece), at in same.items():
                    docs.append(i), minis.append(m), out.append(piece)
                    starts.append(np.array(at, "<i4").tobytes())
            if out:
                take = pa.array(docs)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(take), b.column("key").take(take), pa.array(minis, pa.int64()),
                     pa.array(starts, pa.binary()), pa.array(out, pa.binary())], ["id", "key", "mini", "starts", "piece"])

    return map_arrow(found, run, f"id {kind}, key bigint, mini bigint, starts binary, piece binary")


def distinct_runs(runs: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, numbers of windows and minimisers of a text's runs, each run
    once (rows equal in id and text have gathered theirs together)."""
    v = runs.values
    mini, packed = v.field("mini").to_numpy(zero_copy_only=False), v.field("runs").to_pylist()
    both = np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2)
    mini = np.repeat(mini, [len(x) // 8 for x in packed])
    s, at = np.unique(both[:, 0], return_index=True)
    return s.astype(np.int64), both[at, 1].astype(np.int64), mini[at]


def windows_of(pieces: DataFrame, u: Units) -> DataFrame:
    """Each window of the distinct pieces (digest, n, piece): 128-bit hash, digest, n, pos."""
    def run(batches):
        for b in sub_batches(batches, "piece", CHUNK):
            both, first = [], None
            for base in (BASE_A, BASE_B):
                values, first = u.values(b.column("piece"), base)
                both.append((base, prefix(values, base)))
            wins = np.diff(first) - u.window + 1
            piece = np.repeat(np.arange(len(wins)), wins)
            pos = np.arange(len(piece)) - np.repeat(np.cumsum(wins) - wins, wins)
            at = first[piece] + pos
            h = [as_long(window_hash(pre, at, at + u.window, base)) for base, pre in both]
            take = pa.array(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[0]), pa.array(h[1]), b.column("digest").take(take), b.column("n").take(take),
                 pa.array(pos.astype(np.int32))], ["h1", "h2", "digest", "n", "pos"])

    return map_arrow(pieces, run, "h1 bigint, h2 bigint, digest string, n bigint, pos int")


def joined_places(places: DataFrame) -> DataFrame:
    """digest, places -> digest, parts: the maximal runs (lo, hi) of the window places."""
    def run(batches):
        for b in batches:
            out = []
            for x in b.column("places"):
                p = np.unique(x.values.to_numpy(zero_copy_only=False))
                cut_at = np.flatnonzero(np.diff(p) > 1) + 1
                out.append([{"lo": int(q[0]), "hi": int(q[-1]) + 1} for q in np.split(p, cut_at)])
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(out, PARTS)], ["digest", "parts"])

    return map_arrow(places, run, "digest string, parts array<struct<lo: int, hi: int>>")


def whole_pieces(pieces: DataFrame, u: Units) -> DataFrame:
    """digest, parts of pieces (digest, piece) that are repeated as a whole."""
    def run(batches):
        for b in sub_batches(batches, "piece", CHUNK):
            _, first = u.values(b.column("piece"))
            parts = [[{"lo": 0, "hi": w}] for w in (np.diff(first) - u.window + 1).tolist()]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(parts, PARTS)], ["digest", "parts"])

    return map_arrow(pieces, run, "digest string, parts array<struct<lo: int, hi: int>>")


def parts_of_pieces(found: DataFrame) -> DataFrame:
    """digest, parts from the repeated stretches of pieces (id: the digest)."""
    def run(batches):
        for b in batches:
            parts = [[{"lo": at + p["lo"], "hi": at + p["hi"]} for span in spans
                      for at in np.frombuffer(span["starts"], "<i4").tolist() for p in span["parts"]] for spans in b.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(parts, PARTS)], ["digest", "parts"])

    return map_arrow(found.select("id", "spans"), run, "digest string, parts array<struct<lo: int, hi: int>>")


def hot_stretches(pieces: DataFrame, u: Units, decide: Callable, bucket_limit: int) -> DataFrame:
    """Repeated stretches of the pieces (id, key, mini, starts, piece) of
    buckets beyond the limit, spread over the cluster: equal pieces are one,
    the distinct ones are texts of their own with finer minimisers, or at last
    their windows are counted by hash; joined back to the pieces' places."""
    placed = cut(pieces.withColumn("digest", F.md5("piece")))
    n = (F.octet_length("starts") / 4).cast("bigint")
    distinct = placed.groupBy("digest").agg(F.sum(n).alias("n"), F.any_value("piece").alias("piece"))
    if u.finer and not placed.isEmpty():
        distinct = cut(distinct)
        texts = distinct.select(F.col("digest").alias("id"), F.lit(0).cast("bigint").alias("key"), F.col("piece").alias("text"))
        parts = parts_of_pieces(repeated_stretches(texts, u.next(), decide, bucket_limit))
        parts = parts.unionByName(whole_pieces(distinct.filter("n > 1").select("digest", "piece"), u))
    else:
        windows = windows_of(distinct, u)
        twice = windows.groupBy("h1", "h2").agg(F.sum("n").alias("c")).filter("c > 1").select("h1", "h2")
        parts = joined_places(windows.join(twice, ["h1", "h2"]).groupBy("digest").agg(F.collect_list("pos").alias("places")))
    return placed.select("id", "key", "starts", "digest").join(parts, "digest").select("id", "key", "starts", "parts")


def same_row(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id"]) & (a["key"] == b["key"])


def repeated_stretches(docs: DataFrame, u: Units, decide: Callable, bucket_limit: int) -> DataFrame:
    """docs: id, key, text. Returns the rows that have repeats, with spans: array
    of (starts, parts), where each (lo, hi) of the parts holds the windows
    lo to hi - 1 after each start that also start elsewhere. After the runs one plan without a cut, so that the texts, dealt
    by document once, serve the pieces and the result."""
    kind = docs.schema["id"].dataType.simpleString()
    runs = runs_of(docs, u)
    counts = runs.groupBy("mini").agg(F.sum(F.octet_length("runs") / 8).cast("bigint").alias("seen")).filter("seen > 1")
    repeated = runs.join(counts, "mini").select(
        "id", "key", F.struct("mini", "runs").alias("run"), (F.col("seen") > bucket_limit).alias("hot"))
    by_doc = cut(repeated.groupBy("id", "key").agg(
        F.collect_list(F.when(~F.col("hot"), F.col("run"))).alias("runs"),
        F.collect_list(F.when(F.col("hot"), F.col("run"))).alias("hot")))
    found = docs.join(by_doc, same_row(docs, by_doc)).select(docs["id"], docs["key"], "text", "runs", "hot")

    pieces = pieces_of(found.filter("size(runs) > 0").select("id", "key", "text", "runs"), u)
    spans = map_arrow(pieces.repartition("mini").sortWithinPartitions("mini"), decide,
                      f"id {kind}, key bigint, starts binary, parts array<struct<lo: int, hi: int>>")

    hot = pieces_of(found.filter("size(hot) > 0").select("id", "key", "text", F.col("hot").alias("runs")), u)
    spans = spans.unionByName(hot_stretches(hot, u, decide, bucket_limit))
    spans = spans.groupBy("id", "key").agg(F.collect_list(F.struct("starts", "parts")).alias("spans"))
    return found.join(spans, same_row(found, spans)).select(found["id"], found["key"], "text", "spans")


def covered(n: int, spans: pa.ListScalar, window: int) -> np.ndarray:
    """Which of n units lie in any repeated window."""
    step = np.zeros(n + 1, np.int64)
    v = spans.values
    parts, starts = v.field("parts"), v.field("starts").to_pylist()
    size = np.diff(parts.offsets.to_numpy())
    flat = parts.flatten()
    lo, hi = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("lo", "hi"))
    at = 0
    for s, k in zip(starts, size.tolist()):
        s = np.frombuffer(s, "<i4")[:, None]
        np.add.at(step, (s + lo[at:at + k]).ravel(), 1)
        np.add.at(step, (s + hi[at:at + k] + (window - 1)).ravel(), -1)
        at += k
    return np.cumsum(step[:n]) > 0


def part_rows(t: pa.Table, piece: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Output rows for window stretches [lo, hi) of the given pieces (sorted)."""
    if len(piece):
        rows, count = np.unique(piece, return_counts=True)
        offs = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
        parts = pa.ListArray.from_arrays(pa.array(offs), pa.StructArray.from_arrays(
            [pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["lo", "hi"]))
        out = t.select(["id", "key", "starts"]).take(pa.array(rows)).append_column("parts", parts)
        yield from out.combine_chunks().to_batches()


def stretches(piece: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of consecutive positions within a piece: piece, from, to."""
    if not len(pos):
        return piece, pos, pos
    new = np.ones(len(pos), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (pos[1:] != pos[:-1] + 1)
    at = np.flatnonzero(new)
    return piece[at], pos[at], pos[np.append(at[1:], len(pos)) - 1] + 1


def with_changes(rows: DataFrame, changed: DataFrame, kept: dict) -> DataFrame:
    """Every row of `rows` (id, key, ...) with the columns of `changed` (id,
    key, ...) where it has the row, else those of `kept` (name: expression)."""
    names = [c for c in changed.columns if c not in ("id", "key")]
    once = changed.groupBy("id", "key").agg(*[F.any_value(c).alias(f"new_{c}") for c in names], F.lit(True).alias("is_new"))
    both = rows.join(once, same_row(rows, once), "left")
    return both.select(rows["id"], *[F.when(F.col("is_new"), F.col(f"new_{c}")).otherwise(kept[c]).alias(c) for c in names])


def rows_with_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))


__all__ = ["Units", "covered", "mix", "part_rows", "repeated_stretches", "rows_with_key", "same_row", "stretches", "with_changes"]
