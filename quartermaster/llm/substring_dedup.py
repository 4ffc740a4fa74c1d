"""Word-level repeat removal by super-k-mer partitioning.

Every run of consecutive windows that share a minimiser (a super-k-mer)
travels as one packed string to its minimiser's bucket. In the bucket the
windows of all strings are sorted by a 128-bit hash of their words; equal
neighbours are repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import BASE_A, BASE_B, binary_lengths, map_arrow, prefix, split_words, sub_batches, texts_of, whole_groups, window_hash, word_hashes
from quartermaster.llm.quality import held, word_array
from quartermaster.llm.repeats import (CHUNK, Units, covered, part_rows, repeated_stretches, rows_with_key, stretches,
                                       with_changes)


def sort_windows(W: int):
    """Decides within buckets: rows sorted by minimiser, with `piece`."""
    def decide(batches):
        for t in whole_groups(batches, ["mini"], 4_000):
            t = t.combine_chunks()
            data, offs = texts_of(t.column("piece").chunk(0))
            s, e, first = split_words(data, offs)
            wins = np.diff(first) - W + 1
            often = binary_lengths(t.column("starts").chunk(0)) > 4  # the piece starts at several places of its text
            piece = np.repeat(np.arange(len(wins)), wins)
            pos = np.arange(len(piece)) - np.repeat(np.cumsum(wins) - wins, wins)
            at = first[piece] + pos
            h1, h2 = (window_hash(prefix(word_hashes(data, s, e, b), b), at, at + W, b) for b in (BASE_A, BASE_B))
            order = np.lexsort((h2, h1))
            same = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
            twice = np.zeros(len(at), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            hit = np.flatnonzero(twice | often[piece])
            yield from part_rows(t, *stretches(piece[hit], pos[hit]))

    return decide


def changed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                      mer: int = 6, bucket_limit: int = 4000) -> DataFrame:
    """The rows that lose words: id, key (hash of the text), n_words,
    n_removed, kept (the kept words joined by one space)."""
    rows = rows_with_key(docs, id_col, text_col)
    found = repeated_stretches(rows, Units("words", window, min(mer, window)), sort_windows(window), bucket_limit)
    kind = rows.schema["id"].dataType.simpleString()

    def keep(batches):
        for b in sub_batches(batches, "text", CHUNK):
            total, gone, kept = [], [], []
            spans = b.column("spans")
            for i, text in enumerate(b.column("text").cast(pa.large_binary()).to_pylist()):
                words = (text or b"").split()
                drop = covered(len(words), spans[i], window)
                total.append(len(words)), gone.append(int(drop.sum()))
                kept.append(b" ".join([w for w, d in zip(words, drop.tolist()) if not d]).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("key"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["id", "key", "n_words", "n_removed", "kept"])

    return map_arrow(found, keep, f"id {kind}, key bigint, n_words bigint, n_removed bigint, kept string")


def remove_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, **options) -> DataFrame:
    """Removes every word covered by a window of `window` consecutive words
    that also starts anywhere else, in the same row or another.

    Words are the maximal runs of characters other than the ASCII white
    space; windows are judged on the input. Returns one row for each input
    row: `id_col`, n_words, n_removed, kept (the kept words joined by one
    space; with `digest` its SHA-256 instead, so that unchanged texts needn't
    move). Options as in `changed_documents`; `bucket_limit` is the number of
    runs of one minimiser beyond which its windows are counted one by one
    over the cluster.

    Null and empty texts have no words (0, 0, ''); a text of fewer words than
    the window keeps all of them; rows equal in id and text repeat each
    other; an empty table gives an empty result; other columns are not read,
    whatever their names, and a null id is kept.
    """
    changed = changed_documents(docs, id_col, text_col, **options)
    words = word_array(F.coalesce("text", F.lit("")))
    rows = held(rows_with_key(docs, id_col, text_col), words=words).select(
        "id", "key", F.size("words").cast("bigint").alias("all"), F.array_join("words", " ").alias("whole"))
    if digest:
        rows, changed = (x.withColumn(c, F.sha2(c, 256)) for x, c in ((rows, "whole"), (changed, "kept")))
    out = with_changes(rows, changed, {"n_words": F.col("all"), "n_removed": F.lit(0).cast("bigint"), "kept": F.col("whole")})
    return out.withColumnRenamed("id", id_col)
