"""Ranked lexical search over bit-sliced Bloom signatures.

1. `signature_index` tokenises every text once. Documents of similar size
   share a block; a block holds bit slices, one row of document bits for each
   signature bit. A document's signature holds its terms, and for every level
   of `LEVELS` that a term's count reaches the pair of term and level. The
   index also has each block's terms with their document counts.
2. A term's presence in a block is the AND of its bits' slices; it is never
   missed, only overestimated. The highest level present bounds the term's
   count, so that the sum of the weighted slices is an upper bound of each
   document's score.
3. The documents of the highest bounds are scored exactly first. The score of
   the k-th best then excludes every document whose bound is lower; all others
   are scored exactly. Nothing else is left out, so the result is exact.

Documents of one text have one score: of each text only the k smallest ids
can be in a result, so only these go on as candidates.

The score of a document is the sum over the item's terms, once each, of
w * ((10^9 * tf) div (1000 * tf + 8 * m)), with w = floor(1000 * ln((2N + 2) /
(2 df + 1))) and m = 10 + (90 * n * N) div L.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermaster.llm.common import counted_side, cut, lists, sub_batches, text_key, texts_of

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Term counts from which a signature has another entry: exact up to 3, then within a half.
LEVELS = np.array([1, 2, 3, *sorted(b * 2**i for b in (4, 6) for i in range(28))])
HASHES, BITS = 4, 12  # bits set for an entry; least bits of a signature for an entry
TEXT, CELLS = 1 << 23, 1 << 22  # bytes of text indexed together; terms x documents looked at together
ITEM_TERMS = 100_000  # terms of the items that are searched together


def terms_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Distinct terms of each text: text, term (number in the dictionary), and
    the dictionary; then the number of terms of each text, with repeats."""
    data, offs = texts_of(col)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    low = pa.Array.from_buffers(pa.large_string(), len(col), [None, pa.py_buffer(offs), pa.py_buffer(data)])
    split = pc.split_pattern_regex(low, SEPARATORS)
    row = np.repeat(np.arange(len(col)), np.diff(split.offsets.to_numpy()))
    words = split.flatten()
    some = pc.not_equal(words, "")
    row = row[some.to_numpy(zero_copy_only=False)]
    enc = words.filter(some).dictionary_encode()
    return row, enc.indices.to_numpy().astype(np.int64), enc.dictionary, np.bincount(row, minlength=len(col))


def counted(row: np.ndarray, term: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, term, tf of the distinct pairs."""
    key, tf = np.unique(row * max(size, 1) + term, return_counts=True)
    return key // max(size, 1), key % max(size, 1), tf


def hashes(terms: pa.Array) -> np.ndarray:
    return pd.util.hash_array(terms.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def entry_bits(h: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """The bits (entries x HASHES) of terms' hashes at a level; `bits` is a power of two."""
    h = (h + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    step = (h >> np.uint64(17)) | np.uint64(1)
    return ((h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def signature_index(docs: DataFrame) -> DataFrame:
    """docs: id, key, text. Rows of kind 0, one for each block: ids, keys, ns
    (number of terms) of its documents, bits, slices (bits rows of document
    bits); of kind 1, one for each batch of texts: terms, dfs."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = pa.schema([("kind", pa.int32()), ("ids", pa.list_(pa.field("element", pa.null()))), ("keys", pa.list_(pa.int64())),
                        ("ns", pa.list_(pa.int64())), ("bits", pa.int32()), ("slices", pa.binary()),
                        ("terms", pa.list_(pa.string())), ("dfs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in sub_batches(batches, "text", TEXT):
            ids, keys = b.column("id"), b.column("key").to_numpy()
            own = schema.set(1, pa.field("ids", pa.list_(ids.type)))
            row, term, dictionary, n = terms_of(b.column("text"))
            row, term, tf = counted(row, term, len(dictionary))
            times = np.searchsorted(LEVELS, tf, "right")  # entries of the pair
            entries = np.bincount(row, weights=times, minlength=b.num_rows).astype(np.int64)
            level = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            h, doc = np.repeat(hashes(dictionary)[term], times), np.repeat(row, times)
            size = np.ceil(np.log2(np.maximum(entries * BITS, 64))).astype(int)
            for s in np.unique(size[n > 0]).tolist():
                members = np.flatnonzero((size == s) & (n > 0))
                place = np.full(b.num_rows, -1)
                place[members] = np.arange(len(members))
                mine = place[doc] >= 0
                bitmap = np.zeros((1 << s, len(members)), bool)
                for k, at in enumerate(entry_bits(h[mine], level[mine], 1 << s).T):
                    bitmap[at, place[doc[mine]]] = True
                yield pa.RecordBatch.from_pylist([{
                    "kind": 0, "ids": ids.take(pa.array(members)).to_pylist(), "keys": keys[members].tolist(), "ns": n[members].tolist(),
                    "bits": 1 << s, "slices": np.packbits(bitmap, axis=1).tobytes()}], own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([1], pa.int32()), pa.nulls(1, own.field("ids").type), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int64())),
                 pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(dictionary)], pa.int32()), dictionary.cast(pa.string())),
                 lists(np.bincount(term, minlength=len(dictionary)), np.array([len(dictionary)]), pa.int64())], schema=own)

    return docs.mapInArrow(run, f"kind int, ids array<{kind}>, keys array<bigint>, ns array<bigint>, bits int, slices binary, "
                                "terms array<string>, dfs array<bigint>")


@dataclass(frozen=True)
class Items:
    """Some items' terms: item i has the terms own[first[i]:first[i + 1]] with
    the weights `weight` of the distinct terms."""
    numbers: np.ndarray
    first: np.ndarray
    own: np.ndarray
    terms: pa.Array
    weight: np.ndarray
    least: np.ndarray  # bounds below this are of no use, for each item

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Values (distinct terms x documents) summed over each item's terms."""
        return np.add.reduceat(values[self.own], self.first[:-1], axis=0)


def item_terms(items: DataFrame) -> DataFrame:
    """item, term: the distinct terms of each item (item, text)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            row, term, dictionary, _ = terms_of(b.column("text"))
            row, term, _ = counted(row, term, len(dictionary))
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(row)), dictionary.cast(pa.string()).take(pa.array(term))], ["item", "term"])

    return items.select("item", "text").mapInArrow(run, "item bigint, term string")


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def upper_bounds(items: Items, h: np.ndarray, m: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Upper bound of the score of each item (row) and document of some slices (bits x bytes)."""
    docs, live = len(m), np.arange(len(h))
    values, reached = np.zeros((len(h), docs), np.int64), np.zeros((len(h), docs), np.uint8)
    on = np.full((len(h), slices.shape[1]), 255, np.uint8)
    for level in range(len(LEVELS)):
        on &= np.bitwise_and.reduce(slices[entry_bits(h[live], level, len(slices))], axis=1)
        some = on.any(axis=1)
        live, on = live[some], on[some]
        if not len(live):
            break
        reached[live] += np.unpackbits(on, axis=1, count=docs)
    row, col = np.nonzero(reached)
    most = LEVELS[reached[row, col]] - 1  # the count is below the next level
    values[row, col] = items.weight[row] * part(most, m[col])
    return items.sums(values)


def candidates(index: DataFrame, items: Items, n_all: int, n_terms: int, top: int | None, k: int) -> DataFrame:
    """item, id, key, bound: for each item the documents whose bound reaches the
    item's least one; with `top`, of each block only so many of the highest."""
    kind = index.schema["ids"].dataType.elementType.simpleString()
    h = hashes(items.terms)

    step = max(8, CELLS // len(items.own) // 8 * 8)  # documents

    def some_documents(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i in range(b.num_rows):
                ids, keys, ns = (b.column(c)[i].values for c in ("ids", "keys", "ns"))
                m = 10 + 90 * ns.to_numpy() * n_all // n_terms
                slices = np.frombuffer(b.column("slices")[i].as_buffer(), np.uint8).reshape(b.column("bits")[i].as_py(), -1)
                for a in range(0, len(m), step):
                    yield ids.slice(a, step), keys.to_numpy()[a:a + step], m[a:a + step], slices[:, a // 8:(a + step) // 8]

    def run(batches: Iterator[pa.RecordBatch]):
        for ids, keys, m, slices in some_documents(batches):
            bound = upper_bounds(items, h, m, slices)
            if top is not None and len(m) > top:
                edge = np.partition(bound, len(m) - top, axis=1)[:, [len(m) - top]]
                bound[bound < edge] = 0
            row, col = np.nonzero(bound >= np.maximum(items.least, 1)[:, None])
            if not len(row):
                continue
            # of one text only the k smallest ids
            by = np.lexsort((place_of(ids)[col], keys[col], row))
            row, col = row[by], col[by]
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (keys[col[1:]] != keys[col[:-1]])))
            few = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0)) < k
            row, col = row[few], col[few]
            yield pa.RecordBatch.from_arrays([pa.array(items.numbers[row]), ids.take(pa.array(col)), pa.array(keys[col]), pa.array(bound[row, col])],
                                             ["item", "id", "key", "bound"])

    found = index.filter("kind = 0").select("ids", "keys", "ns", "bits", "slices").mapInArrow(run, f"item bigint, id {kind}, key bigint, bound bigint")
    same = Window.partitionBy("item", "key").orderBy(F.asc_nulls_last("id"))
    found = found.distinct().withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k).drop("copy")
    if top is not None:
        best = Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_last("id"), "key")
        found = found.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= top).drop("at")
    return found


def place_of(ids: pa.Array) -> np.ndarray:
    """Order of the ids, nulls last."""
    out = np.empty(len(ids), np.int64)
    out[pc.array_sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    return out


def exact_scores(docs: DataFrame, found: DataFrame, items: Items, n_all: int, n_terms: int) -> DataFrame:
    """item, id, key, score (above 0) of the pairs in `found` (item, id, key)."""
    kind = docs.schema["id"].dataType.simpleString()
    wanted = counted_side(found.groupBy("id", "key").agg(F.collect_set("item").alias("items")), weight=F.size("items"))
    rows = docs.join(wanted, docs["id"].eqNullSafe(wanted["id"]) & (docs["key"] == wanted["key"])).select(docs["id"], docs["key"], "text", "items")
    slot = {int(x): i for i, x in enumerate(items.numbers)}

    def run(batches: Iterator[pa.RecordBatch]):
        for b in sub_batches(batches, "text", TEXT // 4):
            row, term, dictionary, n = terms_of(b.column("text"))
            ours = pc.fill_null(pc.index_in(dictionary.cast(pa.string()), value_set=items.terms), -1).to_numpy()
            known = ours[term] >= 0
            row, term, tf = counted(row[known], ours[term[known]].astype(np.int64), len(items.terms))
            value = items.weight[term] * part(tf, (10 + 90 * n * n_all // n_terms)[row])
            edge = np.searchsorted(row, np.arange(b.num_rows + 1))
            out_row, out_item, out_score = [], [], []
            for i, asked in enumerate(b.column("items").to_pylist()):
                have = np.zeros(len(items.terms), np.int64)
                have[term[edge[i]:edge[i + 1]]] = value[edge[i]:edge[i + 1]]
                for item in asked:
                    s = slot[item]
                    score = int(have[items.own[items.first[s]:items.first[s + 1]]].sum())
                    if score > 0:
                        out_row.append(i), out_item.append(item), out_score.append(score)
            take = pa.array(out_row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(out_item, pa.int64()), b.column("id").take(take), b.column("key").take(take),
                                              pa.array(out_score, pa.int64())], ["item", "id", "key", "score"])

    return rows.mapInArrow(run, f"item bigint, id {kind}, key bigint, score bigint")


def best_of(scores: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "key")
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def packed_items(weighted: DataFrame) -> Items:
    """The terms (item, term, w) of a block of items, by item."""
    t = weighted.orderBy("item", "term").toArrow().combine_chunks()
    enc = t.column("term").chunk(0).dictionary_encode()
    own, weight = enc.indices.to_numpy().astype(np.int64), np.zeros(len(enc.dictionary), np.int64)
    weight[own] = t.column("w").to_numpy()
    numbers, first = np.unique(t.column("item").to_numpy(), return_index=True)
    return Items(numbers, np.append(first, len(own)), own, enc.dictionary, weight, np.ones(len(numbers), np.int64))


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", k: int = 10) -> DataFrame:
    """`item_col`, rank (from 1), `id_col`, score: for each item the `k` rows of
    `docs` of the highest score above 0, equal scores by ascending id (nulls
    last, then by text hash).

    All rows count in the statistics; whole texts are read, however long. Null
    and empty texts have no terms: such documents are in no result, such items
    have no rows. Rows equal in id and text are rows like any other; items
    equal in id and text are one, items of one id with different texts are
    ranked apart. An empty table gives no rows. Other columns aren't read,
    whatever their names.

    Items are searched in blocks of about `ITEM_TERMS` terms; a block's terms
    are all that passes through the driver.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
    asked = cut(asked.withColumn("item", F.monotonically_increasing_id()))
    index = cut(signature_index(rows))
    ns = F.explode("ns").alias("n")
    totals = index.filter("kind = 0").select(ns).agg(F.count("n").alias("n"), F.sum("n").alias("l")).first()
    n_all, n_terms = totals["n"], totals["l"] or 1
    lexicon = index.filter("kind = 1").select(F.inline(F.arrays_zip("terms", "dfs"))).groupBy(F.col("terms").alias("term")).agg(F.sum("dfs").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_all + 2)) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = cut(item_terms(asked).join(lexicon, "term").select("item", "term", weight.alias("w")).filter("w > 0"))
    blocks = -(-weighted.count() // ITEM_TERMS)
    out = None
    for number in range(blocks):
        block = packed_items(weighted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number))
        if not len(block.numbers):
            continue
        probe = cut(exact_scores(rows, candidates(index, block, n_all, n_terms, 3 * k, k), block, n_all, n_terms))
        # the k-th best score excludes what is bounded below it
        least = {r["item"]: r["score"] for r in best_of(probe.dropDuplicates(["item", "id", "key"]), k).filter(F.col("rank") == k).collect()}
        sharp = Items(block.numbers, block.first, block.own, block.terms, block.weight, np.array([least.get(int(x), 1) for x in block.numbers]))
        found = best_of(exact_scores(rows, candidates(index, sharp, n_all, n_terms, None, k), sharp, n_all, n_terms), k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = rows.limit(0).select(F.lit(0).cast("bigint").alias("item"), "id", "key", F.lit(0).cast("bigint").alias("score"), F.lit(0).alias("rank"))
    return out.join(asked.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
