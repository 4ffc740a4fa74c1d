"""Near-duplicate documents by b-bit MinHash.

Each text becomes its set of word shingles (lower-cased A-Z). Equal sets are
one node. `bands` x `rows` minima give band keys for candidate generation
and, `bits` low bits of each, a packed signature: the share of equal b-bit
values, corrected for chance collisions (1 in 2^b), estimates the
similarity. Candidates that the estimate can't rule out (six standard
deviations below the threshold) are confirmed on the full sets.

No bucket is turned into all its pairs. First every member is compared with
its bucket's smallest id; the confirmed links give components. Only buckets
that still hold several components are looked at again, and only pairs from
different components matter there: members are dealt into blocks of about
`block` rows and every pair of blocks that can hold such a pair is one group,
so a task's group stays bounded and no candidate is left out.

With the defaults a pair at similarity 0.8 shares no band with a chance of
(1 - 0.8^5)^40 = 1.3e-7.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermaster.llm.common import (BASE_A, as_long, changed_at, counted_side, cut, map_arrow, mix, prefix, split_words, sub_batches,
                                      text_key, texts_of, whole_groups, window_hash, word_hashes)
from quartermaster.llm.components import components

CHUNK = 1 << 20


def shingle_sets(col: pa.Array, words: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; fewer words: the whole
    sequence as one; no words: empty."""
    data, offs = texts_of(col)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    s, e, first = split_words(data, offs)
    pre = prefix(word_hashes(data, s, e), BASE_A)
    size = np.diff(first)
    n = np.where(size == 0, 0, np.maximum(size - words + 1, 1))
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1], n)
    h = window_hash(pre, at, at + np.repeat(np.minimum(size, words), n), BASE_A)
    return [np.unique(x) for x in np.split(h, np.cumsum(n)[:-1])] if len(n) else []


class Scheme:
    """Fixed hash functions and the packed layout of a signature."""

    def __init__(self, threshold: float, bands: int, rows: int, bits: int):
        self.threshold, self.bands, self.rows, self.bits = threshold, bands, rows, bits
        self.size = bands * rows
        seeds = mix(np.arange(1, 2 * self.size + 1, dtype=np.uint64) * BASE_A)
        self.mult, self.add = seeds[0::2] | np.uint64(1), seeds[1::2]
        self.per_long = 64 // bits
        self.longs = -(-self.size // self.per_long)
        chance = 0.5 ** bits
        p = threshold + (1 - threshold) * chance
        self.least_equal = math.floor(self.size * p - 6 * math.sqrt(self.size * p * (1 - p)))

    def minima(self, sets: list[np.ndarray]) -> np.ndarray:
        h = np.concatenate(sets)
        at = np.cumsum([0] + [len(x) for x in sets[:-1]])
        return np.stack([np.minimum.reduceat(h * a + b, at) for a, b in zip(self.mult, self.add)], axis=1)

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        m = minima.reshape(len(minima), self.bands, self.rows)
        key = np.broadcast_to(mix(np.arange(1, self.bands + 1, dtype=np.uint64)), m.shape[:2])
        for r in range(self.rows):
            key = mix(key * BASE_A + m[:, :, r])
        return key

    def packed(self, minima: np.ndarray) -> np.ndarray:
        low = mix(minima) & np.uint64((1 << self.bits) - 1)
        wide = np.zeros((len(low), self.longs * self.per_long), np.uint64)
        wide[:, :self.size] = low
        wide = wide.reshape(len(low), self.longs, self.per_long)
        return np.bitwise_or.reduce(wide << (np.arange(self.per_long, dtype=np.uint64) * np.uint64(self.bits)), axis=2)

    def ones(self) -> int:
        return sum(1 << (i * self.bits) for i in range(self.per_long))

    def unequal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of unequal b-bit values between packed rows (broadcasting)."""
        x = a ^ b
        for shift in range(1, self.bits):
            x = x | ((a ^ b) >> np.uint64(shift))
        return np.bitwise_count(x & np.uint64(self.ones())).sum(axis=-1, dtype=np.int32)

    def equal_in_sql(self, a: str, b: str) -> Column:
        """The same count over two array<bigint> columns."""
        ones = self.ones()
        ones = ones - (1 << 64) if ones >> 63 else ones

        def differ(x, y):
            d = x.bitwiseXOR(y)
            for shift in range(1, self.bits):
                d = d.bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), shift))
            return F.bit_count(d.bitwiseAND(F.lit(ones).cast("bigint")))

        return F.lit(self.size) - F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda s, x: s + x)


def signatures(docs: DataFrame, words: int, scheme: Scheme) -> DataFrame:
    """id, n, s1, s2 (order-free hash of the set), bands, packed (null without words)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for b in sub_batches(batches, "text", CHUNK):
            sets = shingle_sets(b.column("text"), words)
            n = np.array([len(x) for x in sets])
            full = np.flatnonzero(n)
            s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            bands, packed = [None] * len(n), [None] * len(n)
            if len(full):
                some = [sets[i] for i in full]
                m = scheme.minima(some)
                for i, k, p, x in zip(full, as_long(scheme.band_keys(m)), as_long(scheme.packed(m)), some):
                    bands[i], packed[i] = k, p
                    s1[i], s2[i] = mix(x).sum(dtype=np.uint64), mix(x ^ BASE_A).sum(dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(as_long(s1)), pa.array(as_long(s2)),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64()))],
                ["id", "n", "s1", "s2", "bands", "packed"])

    return map_arrow(docs, run, f"id {kind}, n bigint, s1 bigint, s2 bigint, bands array<bigint>, packed array<bigint>")


def sets_for(docs: DataFrame, roles: DataFrame, words: int) -> DataFrame:
    """docs joined with roles (id, roles: array<struct<g1, g2, g3, role, comp>>),
    one row for each role with the packed set."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["g1", "g2", "g3", "role", "comp"]

    def run(batches):
        for b in sub_batches(batches, "text", CHUNK):
            sets = [x.tobytes() for x in shingle_sets(b.column("text"), words)]
            col = b.column("roles")
            count = np.diff(col.offsets.to_numpy())
            row = np.repeat(np.arange(len(sets)), count)
            v = col.flatten()
            yield from pa.Table.from_arrays(
                [v.field(k) for k in names] + [b.column("id").take(pa.array(row)), pa.array([sets[i] for i in row], pa.binary())],
                names + ["id", "set"]).combine_chunks().to_batches()

    return map_arrow(docs.join(roles, "id").select("id", "text", "roles"), run, f"g1 bigint, g2 bigint, g3 bigint, role int, comp {kind}, id {kind}, set binary")


def alike(inter, x, y, threshold: float):
    """intersection >= threshold * union, in whole numbers of hundredths."""
    return 100 * inter >= round(100 * threshold) * (x + y - inter)


def groups(batches, keys: list[str], min_rows: int = 2_000):
    """Single groups of rows sorted by `keys`."""
    for t in whole_groups(batches, keys, min_rows):
        t = t.combine_chunks()
        at = np.concatenate(([0], np.flatnonzero(changed_at(t, keys)) + 1, [t.num_rows]))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a > 1:
                yield t.slice(a, b - a)


def intersections(sets: list[np.ndarray]):
    """A function giving set i's intersection size with every set."""
    sizes = np.array([len(x) for x in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    at = np.cumsum(sizes) - sizes
    mark = np.zeros(int(ids.max()) + 1, np.int64)

    def with_set(i):
        own = ids[at[i]:at[i] + sizes[i]]
        mark[own] = 1
        out = np.add.reduceat(mark[ids], at)
        mark[own] = 0
        return out

    return sizes, with_set


def confirm_stars(docs: DataFrame, pairs: DataFrame, words: int, threshold: float, per_group: int = 500) -> DataFrame:
    """The pairs (a, b) whose full sets are alike; a's members are dealt into
    groups of about `per_group` rows, each with a copy of a's set."""
    kind = docs.schema["id"].dataType.simpleString()
    counted = pairs.join(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m")), "a").withColumn(
        "parts", F.ceil(F.col("m") / per_group)).withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))

    def role(which, member):
        return F.struct(F.xxhash64("a").alias("g1"), F.col("part").alias("g2"), F.lit(0).cast("bigint").alias("g3"),
                        F.lit(which).alias("role"), F.col("a").alias("comp")).alias("role"), F.col(member).alias("id")

    centres = counted.select("a", "part").distinct().select(*role(0, "a"))
    members = counted.select(*role(1, "b"))
    roles = centres.unionByName(members).groupBy("id").agg(F.collect_list("role").alias("roles"))
    rows = sets_for(docs, roles, words).repartition("g1", "g2").sortWithinPartitions("g1", "g2", "comp", "role")

    def run(batches):
        for g in groups(batches, ["g1", "g2", "comp"]):
            role = g.column("role").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in g.column("set").to_pylist()]
            sizes, with_set = intersections(sets)
            linked = np.zeros(len(sets), bool)
            for i in np.flatnonzero(role == 0):
                linked |= alike(with_set(i), sizes[i], sizes, threshold)
            hit = np.flatnonzero(linked & (role == 1))
            if len(hit):
                take = pa.array(hit)
                yield from g.select(["comp", "id"]).take(take).rename_columns(["a", "b"]).combine_chunks().to_batches()

    return map_arrow(rows, run, f"a {kind}, b {kind}")


def rest_of_buckets(docs: DataFrame, heads: DataFrame, buckets: DataFrame, known: DataFrame, words: int, scheme: Scheme, block: int) -> DataFrame:
    """Links between different components (`known`: id, component) inside the
    buckets (band, id) that still hold several."""
    kind = docs.schema["id"].dataType.simpleString()
    part = buckets.select("band", "id").join(known, "id", "left").select(
        "band", "id", F.coalesce("component", "id").alias("comp"))
    of = part.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("band").agg(
        F.count(F.lit(1)).alias("comps"), F.sum("c").alias("m"), F.max("c").alias("top"), F.max_by("comp", "c").alias("main"))
    open_ = of.filter("comps > 1").select(
        "band", "main", F.ceil(F.col("top") / block).alias("nm"), F.ceil((F.col("m") - F.col("top")) / block).alias("no"))
    # groups (i, j): other block i with main block j; (i, -1 - k): other blocks i and k
    other = F.pmod(F.xxhash64("id"), F.col("no"))
    main = F.pmod(F.xxhash64("id"), F.col("nm"))

    def group(i, j, role):
        return F.struct(i.cast("bigint").alias("g2"), j.cast("bigint").alias("g3"), F.lit(role).alias("role"))

    steps = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    dealt = F.when(F.col("comp") == F.col("main"), F.transform(steps(F.col("no")), lambda i: group(i, main, 0))).otherwise(F.concat(
        F.transform(steps(F.col("nm")), lambda j: group(other, j, 1)),
        F.transform(F.filter(steps(F.col("no")), lambda k: k != other),
                    lambda k: group(F.least(k, other), -1 - F.greatest(k, other), 1))))
    member = part.join(open_, "band").select("band", "id", "comp", F.explode(dealt).alias("g")).select(
        F.col("band").alias("g1"), "g.*", "id", "comp").join(heads.select("id", "n", "packed"), "id")
    keys = ["g1", "g2", "g3"]

    def candidates(batches):
        for g in groups(batches, keys):
            role, n = g.column("role").to_numpy(), g.column("n").to_numpy()
            comp = np.unique(np.array(g.column("comp").to_pylist()), return_inverse=True)[1]
            bits = np.stack([np.array(x, np.int64) for x in g.column("packed").to_pylist()]).view(np.uint64)
            hit = np.zeros(len(n), bool)
            for i in np.flatnonzero(role == 1):
                near = (scheme.size - scheme.unequal(bits[i], bits) >= scheme.least_equal) & (comp != comp[i])
                near &= 100 * np.minimum(n[i], n) >= round(100 * scheme.threshold) * np.maximum(n[i], n)
                if near.any():
                    hit |= near
                    hit[i] = True
            if hit.any():
                yield from g.select(keys + ["role", "comp", "id"]).take(pa.array(np.flatnonzero(hit))).combine_chunks().to_batches()

    flagged = map_arrow(member.repartition(*keys).sortWithinPartitions(*keys), candidates, f"g1 bigint, g2 bigint, g3 bigint, role int, comp {kind}, id {kind}")
    roles = flagged.groupBy("id").agg(F.collect_list(F.struct("g1", "g2", "g3", "role", "comp")).alias("roles"))
    rows = sets_for(docs, roles, words).repartition(*keys).sortWithinPartitions(*keys)

    def links(batches):
        for g in groups(batches, keys):
            ids, comps = g.column("id"), np.unique(np.array(g.column("comp").to_pylist()), return_inverse=True)[1]
            sets = [np.frombuffer(x, np.uint64) for x in g.column("set").to_pylist()]
            sizes, with_set = intersections(sets)
            a, b = [], []
            for i in np.flatnonzero(g.column("role").to_numpy() == 1):
                if (comps != comps[i]).any():
                    near = np.flatnonzero(alike(with_set(i), sizes[i], sizes, scheme.threshold) & (comps != comps[i]))
                    for c in np.unique(comps[near]).tolist():  # one link joins two components
                        a.append(i), b.append(int(near[comps[near] == c][0]))
                        comps[comps == c] = comps[i]
            if a:
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)).combine_chunks(), ids.take(pa.array(b)).combine_chunks()], ["a", "b"])

    return map_arrow(rows, links, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8,
                    bands: int = 40, rows: int = 5, bits: int = 2, block: int = 256) -> DataFrame:
    """One row for each input row: `id_col`, n_shingles, component_id (the
    smallest id reachable over links of similarity >= threshold, itself
    included), kept (id is its component's smallest).

    Null texts and texts without words have an empty set, linked with
    nothing; a text of fewer than `words` words has one shingle, all of it.
    Rows that share an id are one node, linked by any of their texts. Rows
    without an id are linked with nothing and kept. An empty table gives an
    empty result; other columns are not read, whatever their names.
    """
    scheme = Scheme(threshold, bands, rows, bits)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sig = cut(signatures(docs, words, scheme))
    full = sig.filter("n > 0 AND id IS NOT NULL")
    first = full.groupBy("s1", "s2").agg(F.min("id").alias("rep"))
    copies = cut(full.select("id", "s1", "s2").join(first, ["s1", "s2"]).select("id", "rep"))
    heads = full.join(copies.filter("id = rep").select("id").distinct(), "id").select("id", "n", "bands", "packed")

    band = heads.select("id", F.explode("bands").alias("band"))
    shared = band.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("centre")).filter("m > 1")
    buckets = cut(band.join(shared, "band").select("band", "centre", "id"))
    stars = buckets.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    sa = heads.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("packed").alias("pa"))
    sb = heads.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("packed").alias("pb"))
    least = round(100 * threshold)
    likely = cut(stars.join(sa, "a").join(sb, "b").filter(
        (100 * F.least("na", "nb") >= least * F.greatest("na", "nb")) & (scheme.equal_in_sql("pa", "pb") >= scheme.least_equal)
    ).select("a", "b").distinct())
    links = confirm_stars(docs, likely, words, threshold).union(copies.filter("id <> rep").select("id", "rep"))
    known = components(links)
    more = rest_of_buckets(docs, heads, buckets, known, words, scheme, block)
    known = components(known.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
    out = sig.select("id", "n").join(known, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each group the text with
    the smallest id, as one row.

    Texts are told apart by id and text hash, so different texts of one id are
    grouped apart; of an id's texts the one with the smallest hash goes by the
    id, the others come after all ids. Of rows equal in id and text the least
    one stays. Rows without an id, with null or empty texts aside from such
    repeats, all stay; texts of any length are whole; an empty table gives an
    empty one; columns may have any name and type. Ids are whole numbers.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    named = rows.filter("id IS NOT NULL")
    pairs = named.select("id", "key").distinct()
    several = pairs.groupBy("id").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    last = named.agg(F.max("id")).scalar()
    others = pairs.join(several, "id").filter("key <> first").select(F.col("id").alias("of_id"), F.col("key").alias("of_key"))
    others = counted_side(cut(others.withColumn("at", F.monotonically_increasing_id())).withColumn("other", F.col("at") + last + 1).drop("at"))
    named = named.join(others, (F.col("id") == F.col("of_id")) & (F.col("key") == F.col("of_key")), "left").select(
        F.coalesce("other", "id").alias("node"), "text", "row")
    found = cut(near_duplicates(named, "node", "text", **options).select("node", "kept"))
    gone = counted_side(found.filter("NOT kept").select("node").distinct())
    twice = counted_side(found.filter("kept").groupBy("node").count().filter("count > 1").select("node"))
    left = named.join(gone, "node", "left_anti")
    least = Window.partitionBy("node").orderBy(F.to_json("row"))
    one = left.join(twice, "node", "left_semi").withColumn("rank", F.row_number().over(least)).filter("rank = 1")
    out = left.join(twice, "node", "left_anti").select("row").unionByName(one.select("row")).unionByName(rows.filter("id IS NULL").select("row"))
    return out.select("row.*")
