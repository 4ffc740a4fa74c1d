"""Benchmark decontamination by a prefix-filtered set join, in SQL functions only.

Every benchmark item gives windows of `window` words (a shorter item: one
window). A window is the set of its word shingles, ordered by their count in
the documents, rarest first. As containment has to be whole, one token of
that order is the necessary prefix: a document holds the window only where
it holds the window's rarest shingle. Documents' shingles are matched with
the benchmark's, the matches with the prefixes; the shingle's place bounds
the window's position and length, and what is left is verified word by word
against the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import cut, lower_ascii, text_key
from quartermaster.llm.quality import held

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A broadcast of at most this many shingle hashes (16 bytes each, 16 MB); larger sets are joined by shuffle.
BROADCAST_SHINGLES = 1_000_000


def word_array(text: Column) -> Column:
    """Runs of a-z (after lower-casing), digits and every character above ASCII."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SPLIT), lambda w: w != "")


def places(n: Column) -> Column:
    """0 to n - 1, empty for n < 1."""
    return F.when(n < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - 1))


def shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words."""
    n = F.size(words) - (size - 1)
    short = F.array().cast("array<bigint>")
    return F.when(n < 1, short).otherwise(F.transform(
        F.slice(words, 1, F.greatest(n, F.lit(1))), lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)], F.lit(size))))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """item, win (array of words), at (place), size, h: a row for each shingle of each window."""
    rows = held(items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")),
                words=word_array(F.col("text"))).filter(F.size("words") > 0)
    w = F.col("words")
    wins = rows.select("item", F.explode(F.transform(places(F.greatest(F.size(w) - (window - 1), F.lit(1))),
                                                     lambda i: F.slice(w, i + 1, window))).alias("win")).distinct()
    win = F.col("win")
    sized = F.concat(*[F.when(F.least(F.size(win), F.lit(shingle)) == k, F.transform(
        shingles(win, k), lambda h, i: F.struct(i.alias("at"), F.lit(k).alias("size"), h.alias("h")))).otherwise(
            F.array().cast("array<struct<at:int,size:int,h:bigint>>")) for k in range(1, shingle + 1)])
    return wins.select("item", "win", F.inline(sized))


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """One row for each document row: `id_col`, row_key (hash of the text),
    n_words, n_hit (words inside any occurrence of an item's window), items
    (sorted ids, as strings, of the items with occurring windows).

    Null texts have no words; items without words have no window; an item
    without an id counts as the id ''; equal rows are judged alike; empty
    tables give an empty result or no hits; other columns are not read,
    whatever their names; a null document id is kept.
    """
    wins = cut(item_windows(items, item_col, item_text, window, shingle))
    known = wins.select("h").distinct()
    few = known.count() <= BROADCAST_SHINGLES
    sizes = sorted(r[0] for r in wins.select("size").distinct().collect())  # at most `shingle` values

    base = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("row_key"), F.col(text_col).alias("text"))
    rows = held(base, words=word_array(F.col("text")))
    n = F.size("words").alias("n")
    found = None
    for k in sizes:
        part = rows.select("id", "row_key", n, F.posexplode(shingles(F.col("words"), k)).alias("pos", "h"))
        found = part if found is None else found.union(part)
    if found is None:  # no benchmark words at all
        found = rows.select("id", "row_key", n, F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("h")).limit(0)
    matches = cut(found.join(F.broadcast(known) if few else known, "h"))

    count = matches.groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    ranked = wins.join(count, "h", "left").groupBy("item", "win").agg(
        F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "at", "h")).alias("first"))
    prefix = ranked.filter("first.c > 0").select("item", "win", F.size("win").alias("len"), "first.at", "first.h")
    start = F.col("pos") - F.col("at")
    likely = matches.join(prefix, "h").filter((start >= 0) & (start + F.col("len") <= F.col("n"))).select(
        "id", "row_key", F.struct(start.alias("start"), "len", "item", "win").alias("c"))
    likely = likely.groupBy("id", "row_key").agg(F.collect_set("c").alias("likely")).withColumnsRenamed({"id": "id_", "row_key": "key_"})
    both = rows.join(likely, rows["id"].eqNullSafe(likely["id_"]) & (rows["row_key"] == likely["key_"]), "left")

    words = F.col("words")
    hits = F.filter(F.coalesce("likely", F.array().cast(likely.schema["likely"].dataType)),
                    lambda c: F.slice(words, c["start"] + 1, c["len"]) == c["win"])
    out = held(both.select("id", "row_key", "words", "likely"), hits=hits).select("id", "row_key", F.size("words").alias("n_words"), "hits")
    spans = F.array_sort(F.array_distinct(F.transform("hits", lambda c: F.struct(c["start"].alias("start"), (c["start"] + c["len"]).alias("end")))))
    covered = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")), lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["at"], s["start"]))).alias("n")), lambda acc: acc["n"])
    return out.select(F.col("id").alias(id_col), "row_key", F.col("n_words").cast("bigint").alias("n_words"), covered.cast("bigint").alias("n_hit"),
                      F.array_sort(F.array_distinct(F.transform("hits", lambda c: c["item"]))).alias("items"))
