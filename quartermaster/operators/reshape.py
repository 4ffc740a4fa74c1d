"""Wide <-> long reshaping.

Unpivots are Generate operators (no shuffle). Pivots shuffle once on the
index keys; the pivot value list is always passed explicitly so Spark does
not run a separate job to discover it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.functions.nulls import extract_or_null
from quartermaster.operators.columns import q


# A6
def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         var: str = "variable", val: str = "value") -> DataFrame:
    """Wide -> long, NULL cells kept (pandas ``melt``)."""
    if not values:
        raise ValueError("melt needs at least one value column")
    return df.unpivot([q(c) for c in ids], [q(c) for c in values], var, val)


# A7
def melt_matching(df: DataFrame, pattern: str | None = None, predicate=None,
                  var: str = "variable", val: str = "value") -> DataFrame:
    """Unpivot the columns whose name matches; every other column is an id."""
    if predicate is None:
        rx = re.compile(pattern)
        predicate = lambda c: rx.search(c) is not None
    values = [c for c in df.columns if predicate(c)]
    ids = [c for c in df.columns if c not in values]
    return melt(df, ids, values, var, val)


# A8
def melt_multi(df: DataFrame, ids: Sequence[str], pattern: str,
               period_col: str = "period", periods: Sequence[str] | None = None,
               measures: Sequence[str] | None = None) -> DataFrame:
    """Multi-measure unpivot: ``pattern`` has two groups (measure, period).

    Every matching column ``<measure>_<period>`` becomes column ``measure`` on
    the row for ``period``; a measure missing for a period is NULL. One input
    row yields one output row per period, built by ``inline`` (no shuffle).
    """
    rx = re.compile(pattern)
    cells: dict[tuple[str, str], str] = {}
    seen_m: list[str] = []
    seen_p: list[str] = []
    for c in df.columns:
        m = rx.fullmatch(c)
        if not m:
            continue
        meas, per = m.group(1), m.group(2)
        cells[(meas, per)] = c
        if meas not in seen_m:
            seen_m.append(meas)
        if per not in seen_p:
            seen_p.append(per)
    measures = list(measures) if measures else seen_m
    periods = list(periods) if periods else seen_p
    if not cells:
        raise ValueError(f"no column matches {pattern!r}")
    types = {f.name: f.dataType for f in df.schema.fields}
    mtype = {}
    for meas in measures:
        ts = [types[cells[(meas, p)]] for p in periods if (meas, p) in cells]
        mtype[meas] = ts[0] if ts else None
    structs = []
    for p in periods:
        fields = [F.lit(p).alias(period_col)]
        for meas in measures:
            src = cells.get((meas, p))
            col = q(src) if src else F.lit(None)
            if mtype[meas] is not None:
                col = col.cast(mtype[meas])
            fields.append(col.alias(meas))
        structs.append(F.struct(*fields))
    return df.select(*[q(c) for c in ids], F.inline(F.array(*structs)))


def melt_cells(df: DataFrame, ids: Sequence[str], cells: Sequence[tuple[str, str | None, str]],
               period_col: str) -> DataFrame:
    """``melt`` with the names parsed beforehand: ``cells`` are (column, period,
    measure). One row per period with its measures side by side, all of the type
    that ``melt`` gives; further columns of one cell go to further rows."""
    kind = melt(df, [], [c for c, _, _ in cells], "variable", "value").schema["value"].dataType
    measures = list(dict.fromkeys(m for _, _, m in cells))
    rows: dict[str | None, list[dict[str, str]]] = {}
    for c, period, measure in cells:
        of_period = rows.setdefault(period, [])
        row = next((r for r in of_period if measure not in r), None)
        if row is None:
            of_period.append(row := {})
        row[measure] = c
    structs = [F.struct(F.lit(period).cast("string").alias(period_col),
                        *[(q(r[m]) if m in r else F.lit(None)).cast(kind).alias(m) for m in measures])
               for period, of_period in rows.items() for r in of_period]
    return df.select(*[q(c) for c in ids], F.inline(F.array(*structs)))


# A9
def split_name(df: DataFrame, col: str, pattern: str, names: Sequence[str],
               drop: bool = False) -> DataFrame:
    """Parse a name column into parts by regex groups; no match -> NULL parts."""
    out = df.withColumns({n: extract_or_null(q(col), pattern, i + 1) for i, n in enumerate(names)})
    return out.drop(col) if drop else out


def _pivot_check_cols(keys):
    return [q(k) for k in keys]


# A4
def pivot_strict(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
                 value_col: str, on_duplicate: str = "error") -> DataFrame:
    """Long -> wide, one value per cell (pandas ``DataFrame.pivot``).

    NULL index keys are kept. ``on_duplicate='error'`` fails the job when a
    (keys, pivot value) cell holds two rows; the check rides along in the same
    aggregation as a filter, which no pruning of output columns removes.
    """
    agg, most = [], []
    for v in values:
        cell = F.col(pivot_col) == F.lit(v)
        first = F.first(F.when(cell, q(value_col)), ignorenulls=True)
        agg.append(first.alias(v))
        most.append(F.count(F.when(cell, F.lit(1))))
    out = df.groupBy(*_pivot_check_cols(keys))
    if on_duplicate != "error" or not most:
        return out.agg(*agg)
    out = out.agg(*agg, F.greatest(*most, F.lit(0)).alias("__rows"))
    return out.filter(F.when(F.col("__rows") > 1, F.raise_error(F.lit(f"pivot: duplicate entries for {pivot_col}")))
                      .otherwise(True)).drop("__rows")


# A5
def pivot_first(df: DataFrame, keys: Sequence[str], pivot_col: str | None, values: Sequence[str],
                value_col: str | None, order_col: str, drop_null_keys: bool = True) -> DataFrame:
    """Long -> wide keeping the first non-null value by ``order_col``
    (pandas ``pivot_table(aggfunc='first')``): rows whose values are all NULL
    disappear, and NULL index keys are dropped like pandas groupby does.
    Without ``pivot_col`` and ``value_col`` the values are columns already,
    as ``melt_cells`` lays them side by side."""
    if pivot_col is None:
        src = df.filter(F.coalesce(*[q(v) for v in values]).isNotNull())
    else:
        src = df.filter(q(value_col).isNotNull() & q(pivot_col).isin(list(values)))
    if drop_null_keys:
        for k in keys:
            src = src.filter(q(k).isNotNull())
    agg = []
    for v in values:
        cell, value = (q(v).isNotNull(), q(v)) if pivot_col is None else (q(pivot_col) == F.lit(v), q(value_col))
        agg.append(F.min_by(F.when(cell, value), F.when(cell, q(order_col))).alias(v))
    return src.groupBy(*[q(k) for k in keys]).agg(*agg)


# A17
def stack_periods(df: DataFrame, ids: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """One input row -> N rows: ``rows`` is a list of tuples of (alias -> Column)
    dicts, e.g. [{'POS': lit('POS1'), 'Period': col('DaysOfSupplyFirst')}, ...]."""
    rows = list(rows)
    structs = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows]
    return df.select(*[q(c) for c in ids], F.inline(F.array(*structs)))
