"""Projection, renaming and filter operators (header work is driver-side
metadata only; row work stays in one projection/filter stage)."""

from __future__ import annotations

import re
import weakref
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_COLS: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def q(name: str) -> Column:
    """Column by exact name, safe for names with '.', '(' or spaces.

    An unresolved column reference is immutable and resolves against the
    plan it is used in, so one object per name is reused (per live
    SparkContext): building a wide job then costs far fewer JVM round trips.
    """
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    if sc is None:
        return F.col("`" + name.replace("`", "``") + "`")
    cache = _COLS.setdefault(sc, {})
    c = cache.get(name)
    if c is None:
        c = cache[name] = F.col("`" + name.replace("`", "``") + "`")
    return c


def _rename_all(df: DataFrame, new_names: list[str]) -> DataFrame:
    if len(set(new_names)) != len(new_names):
        dup = sorted({n for n in new_names if new_names.count(n) > 1})
        raise ValueError(f"column names collide after renaming: {dup}")
    return df.toDF(*new_names)


# P1
def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names absent from ``df`` are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


# P2
def rename_regex(df: DataFrame, pattern: str, repl: str) -> DataFrame:
    return _rename_all(df, [re.sub(pattern, repl, c) for c in df.columns])


# P3
def upper_columns(df: DataFrame, strip: bool = False) -> DataFrame:
    return _rename_all(df, [(c.strip() if strip else c).upper() for c in df.columns])


# P4
def normalize_columns(df: DataFrame, upper: Iterable[str] = ("POS", "DOS", "UIC", "MSE", "MEF"),
                      retain: Iterable[str] = ()) -> DataFrame:
    """'.' -> '_'; names in ``upper`` upper-cased; ``retain`` kept; others capitalised."""
    upper, retain = set(upper), set(retain)
    out = []
    for c in df.columns:
        c = c.replace(".", "_")
        out.append(c.upper() if c in upper else c if c in retain else c.capitalize())
    return _rename_all(df, out)


# P5
def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


# P6
def drop_matching(df: DataFrame, text: str) -> DataFrame:
    return df.select([q(c) for c in df.columns if text not in c])


# P7
def project(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Ordered projection; a missing column is an error naming all missing ones."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select([q(c) for c in cols])


# P8
def conform(df: DataFrame, cols: Iterable[str], fill=0) -> DataFrame:
    """Exactly ``cols`` in order; absent ones become the constant ``fill``."""
    return df.select([q(c) if c in df.columns else F.lit(fill).alias(c) for c in cols])


# P9
def fill_zero(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Nulls -> 0 in numeric columns and '0' in string columns (text written by pandas)."""
    targets = set(cols) if cols is not None else set(df.columns)
    exprs = []
    for f in df.schema.fields:
        c = q(f.name)
        if f.name in targets and isinstance(f.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name)
        elif f.name in targets and isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit("0")).alias(f.name)
        exprs.append(c)
    return df.select(exprs)


# P13/P14
def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def copy_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """New column per (target -> source) pair, source kept."""
    return df.withColumns({dst: q(src) for dst, src in mapping.items()})


# F1
def keep_positive(df: DataFrame, col: str) -> DataFrame:
    """Rows whose measure is > 0 (NULL and NaN rows dropped)."""
    c = q(col)
    return df.filter(c.isNotNull() & ~F.isnan(c) & (c > 0))


# F2
def keep_flag(df: DataFrame, col: str, value=True) -> DataFrame:
    return df.filter(q(col) == F.lit(value))


# F3
def keep_in(df: DataFrame, col: str, keys) -> DataFrame:
    """Membership: a literal list becomes an InSet filter (pushed to the scan);
    a key DataFrame becomes a left-semi join that AQE sizes at runtime."""
    if isinstance(keys, DataFrame):
        kcol = keys.columns[0]
        return df.join(keys.select(q(kcol).alias("__k")).distinct(),
                       q(col) == F.col("__k"), "left_semi")
    return df.filter(q(col).isin(list(keys)))


# F4
def missing_or_zero(*cols) -> Column:
    out = None
    for c in cols:
        e = F.coalesce(q(c) if isinstance(c, str) else c, F.lit(0)) == 0
        out = e if out is None else (out | e)
    return out


# F5 lives in functions.scalar.is_sentinel

# F6
def path_filter(df: DataFrame, col: str, prefix: str | None = None, suffix: str | None = None,
                case_insensitive_suffix: bool = True) -> DataFrame:
    c = q(col)
    cond = F.lit(True)
    if prefix:
        cond = cond & c.startswith(prefix)
    if suffix:
        cond = cond & ((F.lower(c).endswith(suffix.lower())) if case_insensitive_suffix
                       else c.endswith(suffix))
    return df.filter(cond)


# F7
def exclude_prefixes(df: DataFrame, col: str, prefixes: Iterable[str]) -> DataFrame:
    c = q(col)
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | c.startswith(p)
    return df.filter(~cond)


# F9
def has_attribute(col) -> Column:
    return (q(col) if isinstance(col, str) else col).isNotNull()


# F10
def numeric_recent(df: DataFrame, name_col: str, time_col: str, months: int = 3,
                   now: Column | None = None) -> DataFrame:
    """Folder names that are all digits and were modified within ``months``."""
    now = now if now is not None else F.current_timestamp()
    return df.filter(q(name_col).rlike(r"^[0-9]+$")
                     & (q(time_col) >= F.add_months(now, -months)))
