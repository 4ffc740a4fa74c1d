"""Joins, aggregates, windows, ordering and set operators.

Scale rules followed here:
* no broadcast hints: AQE picks broadcast from the measured runtime size and
  falls back to a shuffled join;
* per-key "first/latest" uses ``min``/``max`` over a struct (partial
  aggregation map-side), never a window that sorts a whole hot key in one task;
* per-row group totals are aggregate-then-join (the aggregate is small and
  pre-combined), never a window partitioned by a possibly skewed key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermaster.functions.nulls import null_safe_eq, sum0
from quartermaster.operators.columns import q
from quartermaster.session import cut


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def shared_shuffle(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of ``df``, which were dealt out, for several plans that go on from them.

    Spark writes equal shuffles once, but each plan would shuffle only the
    columns and rows that it uses, so every plan had its own. ``inline`` asks for
    all columns, whatever is used after it, and filters stay above it. ``keys``
    pass beside it: Spark still knows that rows are dealt out by them (or
    expressions of them), and filters on them have to be the same in all plans.
    Carry nothing that no plan uses.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.select(*[q(k) for k in keys], F.inline(F.array(F.struct(*[q(c) for c in rest])))).select(df.columns)


# J1 / J2 / J3 / J6
def join_on(left: DataFrame, right: DataFrame, lkey, rkey=None, how: str = "inner",
            match_nulls: bool = False) -> DataFrame:
    """Equi-join; same-named keys are merged, different names are both kept.

    ``match_nulls`` reproduces pandas merging NaN with NaN (``<=>``, still a
    hash/sort-merge join key for Spark).
    """
    lk, rk = _keys(lkey), _keys(rkey if rkey is not None else lkey)
    if lk == rk and not match_nulls:
        return left.join(right, lk, how)
    lr = left.alias("__l")
    rr = right.alias("__r")
    cond = None
    for a, b in zip(lk, rk):
        e = null_safe_eq(F.col(f"__l.`{a}`"), F.col(f"__r.`{b}`"), match_nulls)
        cond = e if cond is None else (cond & e)
    out = lr.join(rr, cond, how)
    if lk == rk:
        # merge same-named keys like USING does
        keep = []
        for c in left.columns:
            if c in lk and how in ("right", "right_outer"):
                keep.append(F.col(f"__r.`{c}`").alias(c))
            elif c in lk and how in ("full", "full_outer", "outer"):
                keep.append(F.coalesce(F.col(f"__l.`{c}`"), F.col(f"__r.`{c}`")).alias(c))
            else:
                keep.append(F.col(f"__l.`{c}`"))
        if how not in ("left_semi", "semi", "left_anti", "anti"):
            keep += [F.col(f"__r.`{c}`") for c in right.columns if c not in lk]
        return out.select(keep)
    return out


# J5
def join_suffix(left: DataFrame, right: DataFrame, on, how: str = "inner",
                suffixes=("_left", "_right")) -> DataFrame:
    """pandas-style merge: non-key columns present on both sides get suffixes."""
    keys = _keys(on)
    both = (set(left.columns) & set(right.columns)) - set(keys)
    l2 = left.select([q(c).alias(c + suffixes[0]) if c in both else q(c) for c in left.columns])
    r2 = right.select([q(c).alias(c + suffixes[1]) if c in both else q(c) for c in right.columns])
    return l2.join(r2, keys, how)


# J7 / J12
def anti(left: DataFrame, right: DataFrame, lkey, rkey=None) -> DataFrame:
    return join_on(left, right, lkey, rkey, "left_anti")


def missing_keys(expected: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Expected keys that are not available (set difference on the key)."""
    return expected.select(key).distinct().join(available.select(key), key, "left_anti")


# J8
def semi(left: DataFrame, right: DataFrame, lkey, rkey=None) -> DataFrame:
    return join_on(left, right, lkey, rkey, "left_semi")


# J9
def coalesce_chain(base: DataFrame, key, sources: Sequence[tuple], default: Mapping | None = None,
                   zero_is_missing=True, first_keeps_zero=False, origin_col: str | None = None,
                   origin_names: Sequence[str] | None = None) -> DataFrame:
    """Left-join chain with priority: the first source holding a value wins.

    ``sources`` is a list of ``(DataFrame, {out_col: source_col})`` or
    ``(DataFrame, {out_col: source_col}, join_key)``; each source must be
    unique on its join key (default ``key``). With ``zero_is_missing`` a 0
    counts as absent; ``first_keeps_zero`` is the variant whose first stage
    keeps 0 as a value. ``origin_col`` names which source supplied the first
    output column ('default' when none did).
    """
    out = base
    per_col: dict[str, list[Column]] = {}
    names = list(origin_names or [f"source{i + 1}" for i in range(len(sources))])
    for i, src_spec in enumerate(sources):
        src, cols = src_spec[0], src_spec[1]
        keys = _keys(src_spec[2] if len(src_spec) > 2 else key)
        sel = [q(k) for k in keys] + [q(s_).alias(f"__s{i}_{o}") for o, s_ in cols.items()]
        out = out.join(src.select(sel), keys, "left")
        for o in cols:
            c = F.col(f"__s{i}_{o}")
            if zero_is_missing and not (first_keeps_zero and i == 0):
                c = F.when(c != 0, c)
            per_col.setdefault(o, []).append(c)
    first_out = next(iter(per_col)) if per_col else None
    result = {}
    for o, cs in per_col.items():
        d = [F.lit(default[o])] if default and o in default else []
        result[o] = F.coalesce(*cs, *d) if (len(cs) + len(d)) > 1 else cs[0]
    if origin_col and first_out:
        e = None
        for c, nm in zip(per_col[first_out], names):
            e = F.when(c.isNotNull(), F.lit(nm)) if e is None else e.when(c.isNotNull(), F.lit(nm))
        result[origin_col] = e.otherwise(F.lit("default"))
    out = out.withColumns(result)
    return out.drop(*[c for c in out.columns if c.startswith("__s")])


# J10
def patch(df: DataFrame, lookup: DataFrame, key, cols: Sequence[str],
          when_col: str | None = None, sequential: bool = True) -> DataFrame:
    """Replace ``cols`` by the lookup value where the test column is <= 0.

    With ``sequential`` each later column tests the *already patched* first
    column (the order of a chained mutate); otherwise all test the original.
    """
    keys = _keys(key)
    test = when_col or cols[0]
    lk = lookup.select(*[q(k) for k in keys], *[q(c).alias(f"__p_{c}") for c in cols])
    out = df.join(lk, keys, "left").withColumn("__p_test", q(test))
    for c in cols:
        t = q(test) if sequential else F.col("__p_test")
        out = out.withColumn(c, F.when(t <= 0, F.coalesce(F.col(f"__p_{c}"), q(c))).otherwise(q(c)))
    return out.drop(*[f"__p_{c}" for c in cols], "__p_test")


# J11
def reconcile(expected: DataFrame, files: DataFrame, state: DataFrame, key) -> DataFrame:
    """Classify every expected key against two availability sets.

    matched   - present as a file and in the state table;
    synced    - absent from both (consistently missing);
    unmatched - present in exactly one of them.
    The availability sets are reduced to distinct keys first, so each left
    join is against a key set, never a fan-out.
    """
    keys = _keys(key)
    f = files.select(*[q(k) for k in keys]).distinct().withColumn("__f", F.lit(True))
    s = state.select(*[q(k) for k in keys]).distinct().withColumn("__s", F.lit(True))
    out = expected.join(f, keys, "left").join(s, keys, "left")
    ff = F.coalesce(F.col("__f"), F.lit(False))
    ss = F.coalesce(F.col("__s"), F.lit(False))
    status = F.when(ff & ss, "matched").when(~ff & ~ss, "synced").otherwise("unmatched")
    return (out.withColumn("has_file", ff).withColumn("has_state", ss)
            .withColumn("status", status).drop("__f", "__s"))


# J13
def contains_join(df: DataFrame, col: str, keys: Sequence[str], key_col: str = "key") -> DataFrame:
    """Pair each row with every literal key contained in ``col``.

    The key list is a literal (bounded by the caller); it is filtered inside
    the row before the Generate, so only matches become rows: no join, no
    shuffle.
    """
    found = F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: F.contains(q(col), k))
    return df.withColumn(key_col, F.explode(found))


#: Pieces of keys (counted) up to which they are sent to every task; some 100 bytes each.
BROADCAST_PIECES = 1_000_000


def contains_join_keys(df: DataFrame, col: str, keys: DataFrame, key_col: str = "key", gram: int = 8,
                       broadcast_pieces: int = BROADCAST_PIECES) -> DataFrame:
    """Each row of ``df`` paired with every key of the table ``keys`` that ``col`` contains.

    A key's candidates are the texts that hold its rarest ``gram``-character
    piece (the whole key if it is shorter), found by an equi-join, and are then
    checked. Up to ``broadcast_pieces`` pieces of keys, the keys go to the rows,
    so no piece of a text is shuffled; beyond it pieces and texts are. Pieces
    are counted with partial aggregation, so a piece that most texts have is not
    used for a key that holds a rarer one. Null texts and keys pair with nothing,
    the empty key with every text; repeated keys count once, repeated rows stay rows.
    """
    k = keys.select(q(key_col).alias("__key")).filter("__key IS NOT NULL").distinct()
    size = F.least(F.lit(gram), F.length("__key"))

    def pieces(c: str, n) -> Column:
        n = F.lit(n) if isinstance(n, int) else n
        places = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring(F.col(c), i, n))

    def all_pieces() -> Column:
        found = [F.array(F.lit("")) if n == 0 else pieces("__text", n) for n in sizes]
        return F.array_distinct(F.concat(*found)) if found else F.array().cast("array<string>")

    own = F.when(size == 0, F.array(F.lit(""))).otherwise(pieces("__key", size))
    of_key = cut(k.select("__key", size.alias("__size"), F.array_distinct(own).alias("__own")))
    n_pieces = {n: m for n, m in of_key.groupBy("__size").agg(F.sum(F.size("__own"))).collect()}  # at most gram + 1 rows
    sizes = sorted(n_pieces)
    of_key = of_key.select("__key", F.size("__own").alias("__n_own"), F.explode("__own").alias("__piece"))
    if sum(n_pieces.values()) <= broadcast_pieces:
        rows = df.withColumn("__text", q(col).cast("string")).filter("__text IS NOT NULL").hint("rebalance")  # each row becomes its pieces
        alone, several = of_key.filter("__n_own = 1"), of_key.filter("__n_own > 1")
        wanted = several.select("__piece").distinct()
        seen = rows.select(F.explode(F.array_distinct(pieces("__text", gram))).alias("__piece")).join(F.broadcast(wanted), "__piece").groupBy(
            "__piece").agg(F.count(F.lit(1)).alias("__n"))
        least = F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__piece")).alias("__m")
        rarest = several.join(seen, "__piece", "left").groupBy("__key").agg(least).filter("__m.n > 0").select("__key", "__m.__piece")
        chosen = alone.select("__key", "__piece").unionByName(rarest)
        # every piece at its place; of one that comes again the first place counts
        placed = rows.withColumn("__length", F.length("__text")).select("*", F.explode(F.sequence(F.lit(1), F.greatest("__length", F.lit(1)))).alias("__at"))
        placed = placed.select("*", F.explode(F.array(*[F.lit(n) for n in sizes] or [F.lit(0)])).alias("__size")).filter("__at + __size - 1 <= __length")
        pairs = placed.withColumn("__piece", F.substring("__text", F.col("__at"), F.col("__size"))).join(F.broadcast(chosen), "__piece")
        pairs = pairs.filter((F.instr("__text", F.col("__piece")) == F.col("__at")) & F.contains("__text", "__key"))
        return pairs.select(*[q(c) for c in df.columns], F.col("__key").alias(key_col))
    texts = df.select(q(col).cast("string").alias("__text")).filter("__text IS NOT NULL").distinct()
    of_text = texts.select("__text", F.explode(all_pieces()).alias("__piece"))
    seen = of_text.groupBy("__piece").agg(F.count(F.lit(1)).alias("__n"))
    rarest = of_key.join(seen, "__piece", "left").groupBy("__key").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__piece")).alias("__m"))
    chosen = rarest.filter("__m.n > 0").select("__key", F.col("__m.__piece").alias("__piece"))
    pairs = of_text.join(chosen, "__piece").filter(F.contains("__text", "__key")).select("__text", F.col("__key").alias(key_col))
    return df.join(pairs, q(col).cast("string") == F.col("__text")).select(*[df[f"`{c}`"] for c in df.columns], key_col)


# A1
def group_sum(df: DataFrame, keys, measures: Sequence[str], drop_null_keys: bool = True) -> DataFrame:
    """pandas ``groupby().sum()``: NULL keys dropped, all-NULL group sums to 0."""
    keys = _keys(keys)
    src = df
    if drop_null_keys:
        for k in keys:
            src = src.filter(q(k).isNotNull())
    return src.groupBy(*[q(k) for k in keys]).agg(*[sum0(q(m)).alias(m) for m in measures])


# A2 / A3
def list_agg(df: DataFrame, keys, cols: Sequence[str], sep: str = ", ",
             distinct=False, suffix: str = "") -> DataFrame:
    """Joined text list per key and column, values sorted (deterministic);
    NULL values are skipped and a key whose column holds only NULLs gets
    NULL. ``distinct`` is a bool for all columns or the set of columns to
    join without repeats.

    Built from ``list_chunks``; only the output cell itself is whole.
    """
    keys, cols = _keys(keys), list(cols)
    kc = [q(k) for k in keys]
    chunks = list_chunks(df, keys, cols, sep, distinct)
    wide = chunks.groupBy(*kc).agg(*[
        F.array_sort(F.collect_list(F.when((F.col("column") == c) & F.col("text").isNotNull(), F.struct("place", "part", "text")))).alias(f"__l{i}") for i, c in enumerate(cols)])
    joined = [F.when(F.size(f"__l{i}") > 0, F.array_join(F.transform(f"__l{i}", lambda s: s["text"]), sep)).alias(c + suffix)
              for i, c in enumerate(cols)]
    return wide.select(*kc, *joined)


def list_chunks(df: DataFrame, keys, cols: Sequence[str], sep: str = ", ", distinct=False, rows: int = 10_000) -> DataFrame:
    """The long form of ``list_agg``: (keys, column, place, part, text), each text
    up to ``rows`` different values of a key's column, in order of (place, part);
    a key whose column holds only NULLs has one row without text.

    Rows are reduced to (key, column, value, count) with a map-side combined
    count and dealt into ranges of (key, column, value), so the values of a hot
    key are spread over tasks, and each is cut into chunks there.
    """
    keys, cols = _keys(keys), list(cols)
    dset = set(cols) if distinct is True else set(distinct or ())
    kc = [q(k) for k in keys]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("__v")) for c in cols])
    counted = df.select(*kc, F.inline(cells)).groupBy(*kc, "column", "__v").agg(F.count(F.lit(1)).alias("__n"))
    ranged = counted.repartitionByRange(*kc, "column", "__v").withColumn("place", F.spark_partition_id())
    within = Window.partitionBy("place", *kc, "column").orderBy("__v")
    placed = ranged.withColumn("part", F.floor((F.row_number().over(within) - 1) / rows).cast("int"))
    pairs = F.array_sort(F.collect_list(F.when(F.col("__v").isNotNull(), F.struct("__v", "__n"))))
    held = placed.groupBy(*kc, "column", "place", "part").agg(pairs.alias("__l"))
    once = F.transform("__l", lambda s: s["__v"])
    every = F.flatten(F.transform("__l", lambda s: F.array_repeat(s["__v"], s["__n"].cast("int"))))
    words = F.when(F.col("column").isin(sorted(dset)), once).otherwise(every) if dset else every
    out = held.select(*kc, "column", "place", "part", F.when(F.size("__l") > 0, F.array_join(words, sep)).alias("text"))
    return out


# A10
def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.select(*[q(c) for c in cols]).distinct() if cols else df.distinct()


# A11 / W4
def first_per_key(df: DataFrame, keys, order: Sequence[str] | str) -> DataFrame:
    """First row per key by ``order`` (ties broken by the remaining columns).

    ``min(struct(order..., rest...))`` is a partial aggregate: each task keeps
    one candidate per key, so a hot key never lands whole in one task. With
    text in the struct Spark plans a sort aggregate, which sorts each
    partition by the key.
    """
    keys, order = _keys(keys), _keys(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[q(c).alias(f"__o{i}") for i, c in enumerate(order)],
                            *[q(c) for c in rest])).alias("__m")
    out = df.groupBy(*[q(k) for k in keys]).agg(packed)
    sel = []
    for c in df.columns:
        if c in keys:
            sel.append(q(c))
        elif c in order:
            sel.append(F.col(f"__m.__o{order.index(c)}").alias(c))
        else:
            sel.append(F.col("__m").getField(c).alias(c))
    return out.select(sel)


# W5
def latest(df: DataFrame, key, order: str, cols: Sequence[str]) -> DataFrame:
    """Most recent value(s) per key by ``order`` (max over a struct, partial-aggregated)."""
    keys = _keys(key)
    packed = F.max(F.struct(q(order).alias("__o"), *[q(c) for c in cols])).alias("__m")
    out = df.groupBy(*[q(k) for k in keys]).agg(packed)
    return out.select(*[q(k) for k in keys], F.col("__m.__o").alias(order),
                      *[F.col("__m").getField(c).alias(c) for c in cols])


# A12
def rollup_measures(df: DataFrame, dims: Sequence[str], measures: Mapping[str, Column],
                    level_col: str = "grouping_level") -> DataFrame:
    return df.rollup(*[q(d) for d in dims]).agg(
        *[c.alias(n) for n, c in measures.items()],
        F.grouping_id().cast("bigint").alias(level_col))


def rollup_sums(df: DataFrame | Sequence[DataFrame], dims: Sequence[str], sums: Mapping[str, str],
                count_col: str | None = None, level_col: str = "grouping_level") -> DataFrame:
    """Roll-up of sums (and a row count) aggregated at the finest grain first.

    ``rollup`` replicates every input row once per grouping level before it
    aggregates; sums and counts decompose, so the input is first reduced to
    one row per full dimension tuple (partial aggregation map-side) and only
    those rows are rolled up. Integer sums give exactly the single-pass
    result. Of several inputs (a union's parts) each is reduced on its own,
    without a shuffle if it was dealt out by some of the dimensions.
    """
    dims = list(dims)
    fine_aggs = [F.sum(q(src)).alias(out) for out, src in sums.items()]
    if count_col:
        fine_aggs.append(F.count(F.lit(1)).alias(count_col))
    parts = [df] if isinstance(df, DataFrame) else df
    fine = reduce(DataFrame.unionByName, [p.groupBy(*[q(d) for d in dims]).agg(*fine_aggs) for p in parts])
    coarse = {out: F.sum(q(out)) for out in sums}
    if count_col:
        coarse[count_col] = F.sum(q(count_col))
    return rollup_measures(fine, dims, coarse, level_col)


# A13
def fill_zero_with_min_positive(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Values <= 0 (or NULL) replaced by the smallest positive value of the column.

    The scalar is a Spark scalar subquery (one tiny job, broadcast as a
    literal) - not a driver round trip and not a global window.
    """
    m = df.select(F.min(F.when(q(col) > 0, q(col))).alias("m")).scalar()
    return df.withColumn(out or col, F.when(q(col) > 0, q(col)).otherwise(m))


# A14
def zscore(df: DataFrame, col: str, out: str) -> DataFrame:
    mu = df.select(F.avg(q(col))).scalar()
    sd = df.select(F.stddev_samp(q(col))).scalar()
    return df.withColumn(out, (q(col) - mu) / sd)


# A15
def regression_error(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    err = q(y) - q(yhat)
    aggs = [F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"),
            F.avg(F.abs(err)).alias("mae")]
    return df.groupBy(*[q(b) for b in by]).agg(*aggs) if by else df.agg(*aggs)


# A16
def same_row_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: both counts and whether they differ (two counting aggregates,
    the second as a scalar subquery)."""
    nb = b.select(F.count(F.lit(1))).scalar()
    return (a.agg(F.count(F.lit(1)).alias("source_rows"))
            .withColumn("target_rows", nb)
            .withColumn("changed", F.col("source_rows") != F.col("target_rows")))


# A18
def first_row(df: DataFrame, order: Sequence[str] | str) -> DataFrame:
    """Deterministic ``iloc[0]``: the smallest row by ``order`` (a top-1, not a sort)."""
    return df.orderBy(*[q(o) for o in _keys(order)]).limit(1)


# W1
def running_total(df: DataFrame, order: str, measure: str, out_daily: str, out_cum: str,
                  partition: Sequence[str] = ()) -> DataFrame:
    """Per-``order`` totals and their cumulative sum, joined back to each row.

    The window runs on the pre-aggregated grain (one row per order value and
    partition), never on detail rows. Without a ``partition`` the grain is dealt
    into ranges of the order, each is summed on its own, and the totals of the
    ranges before are added (``prefix_sum``).
    """
    part = list(partition)
    grain = group_sum(df, part + [order], [measure]).withColumnRenamed(measure, out_daily)
    if not part:
        return df.join(prefix_sum(grain, order, out_daily, out_cum), [order], "left")
    w = Window.partitionBy(*[q(p) for p in part]).orderBy(q(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    grain = grain.withColumn(out_cum, F.sum(q(out_daily)).over(w))
    return df.join(grain, part + [order], "left")


def prefix_sum(grain: DataFrame, order: str, measure: str, out: str) -> DataFrame:
    """Cumulative sum over all rows by ``order`` (one row for each of its
    values) in two levels: within ranges of the order, which are as many as
    the shuffle has partitions, and over the ranges' totals, one number each.
    No task holds more than a range.
    """
    ranged = cut(grain.repartitionByRange(q(order)).withColumn("__range", F.spark_partition_id()))
    totals = ranged.groupBy("__range").agg(F.sum(q(measure)).alias("t"))
    each = F.sort_array(F.collect_list(F.struct(F.col("__range").alias("r"), "t")))
    kind = totals.schema["t"].dataType
    before = F.transform("__all", lambda x: F.struct(x["r"].alias("__range"), F.aggregate(
        F.filter("__all", lambda y: y["r"] < x["r"]), F.lit(0).cast(kind), lambda s, y: s + F.coalesce(y["t"], F.lit(0).cast(kind))).alias("__before")))
    offsets = totals.agg(each.alias("__all")).select(F.inline(before))  # one row holds one number for each range
    within = Window.partitionBy("__range").orderBy(q(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumn(out, F.sum(q(measure)).over(within)).join(offsets, "__range")
    return summed.withColumn(out, q(out) + F.col("__before")).drop("__range", "__before")


# W2 / J4
def partition_total(df: DataFrame, keys, measures: Mapping[str, str]) -> DataFrame:
    """pandas ``groupby(keys)[m].transform('sum')`` for several measures.

    Aggregate (map-side combined) then join back on the keys; AQE broadcasts
    the aggregate when its measured size is small. Rows with a NULL key get
    NULL totals.
    """
    keys = _keys(keys)
    agg = group_sum(df, keys, list(measures.values()))
    agg = agg.select(*[q(k) for k in keys], *[q(src).alias(dst) for dst, src in measures.items()])
    return df.join(agg, keys, "left")


# W3
def add_columns(df: DataFrame, out: str, cols: Sequence[str]) -> DataFrame:
    e = None
    for c in cols:
        e = q(c) if e is None else e + q(c)
    return df.withColumn(out, e)


# O1
def order_by_index(df: DataFrame, dim: DataFrame, key: str, index: str) -> DataFrame:
    """Order rows by the dimension's index column instead of the label."""
    return join_on(df, dim.select(key, index), key, how="left").orderBy(index)


# O2
def order_by_list(df: DataFrame, col: str, values: Sequence[str], out: str = "sort_key") -> DataFrame:
    """Order column = position of the value in ``values`` (unknown -> after all)."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), q(col))
    return df.withColumn(out, F.when(pos > 0, pos).otherwise(F.lit(len(values) + 1)))


# O3
def head(df: DataFrame, n: int, order=None) -> DataFrame:
    return (df.orderBy(*[q(o) for o in _keys(order)]) if order else df).limit(n)


# O4
def split_keys(df: DataFrame, key: str, weights: Mapping[str, float], out: str = "split",
               seed: int = 42) -> DataFrame:
    """Deterministic split by a digest of the key: no sort, no driver list.

    ``weights`` maps split name -> share (shares are normalised).
    """
    total = float(sum(weights.values()))
    text = F.concat(F.coalesce(q(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    bucket = (F.conv(F.substring(F.sha2(text, 256), 1, 7), 16, 10).cast("bigint") % 10_000).cast("double") / 10_000.0
    e = None
    acc = 0.0
    items = list(weights.items())
    for name, w in items[:-1]:
        acc += w / total
        e = F.when(bucket < acc, F.lit(name)) if e is None else e.when(bucket < acc, F.lit(name))
    last = F.lit(items[-1][0])
    return df.withColumn(out, e.otherwise(last) if e is not None else last)


def split_positions(df: DataFrame, key: str, parts: Mapping[str, float], out: str = "split") -> DataFrame:
    """Split by position: the first share of the different keys, in key order,
    is the first part, the next the second, and so on (shares of the number of
    keys, rounded; the last part has the rest; null keys have no part).

    Positions are a prefix sum in two levels, so no task sorts all keys.
    """
    keys = df.select(q(key)).filter(q(key).isNotNull()).distinct().withColumn("__one", F.lit(1).cast("bigint"))
    placed = prefix_sum(keys, key, "__one", "__at")
    total, acc, e = float(sum(parts.values())), 0.0, None
    size = keys.agg(F.count(F.lit(1))).scalar()
    *firsts, last = parts.items()
    for name, share in firsts:
        acc += share / total
        here = F.col("__at") <= F.round(size * acc)
        e = F.when(here, F.lit(name)) if e is None else e.when(here, F.lit(name))
    e = F.lit(last[0]) if e is None else e.otherwise(F.lit(last[0]))
    return df.join(placed.select(q(key), e.alias(out)), key, "left")


# U1
def union_conform(dfs: Sequence[DataFrame], cols: Sequence[str], fill=0) -> DataFrame:
    """Union by name onto ``cols``; a column absent from one input is filled
    with ``fill`` cast to the type the other inputs use ('0' for text)."""
    types = {}
    for d in dfs:
        for f in d.schema.fields:
            types.setdefault(f.name, f.dataType)
    out = None
    for d in dfs:
        sel = [q(c) if c in d.columns else F.lit(fill).cast(types.get(c, "string")).alias(c)
               for c in cols]
        part = d.select(sel)
        out = part if out is None else out.unionByName(part)
    return out


# U2
def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


# U3
def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)
