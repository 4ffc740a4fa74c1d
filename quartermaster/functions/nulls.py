"""Null rules carried over from the pandas semantics the jobs were written in.

Spark and pandas disagree on missing values in a handful of places; each
helper here pins one rule so the composite jobs can state which one applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN (a legal double in Spark, where ``NaN > 0`` is true) becomes NULL."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def clean_nan(df: DataFrame, cols=None) -> DataFrame:
    """Apply :func:`nan_to_null` to every float/double column (or ``cols``)."""
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or floats) if c in floats]
    if not targets:
        return df
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in targets})


def max_strict(a, b) -> Column:
    """Maximum of two values that is NULL when either is NULL (numpy.maximum)."""
    a, b = _c(a), _c(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def sum0(c) -> Column:
    """Sum that is 0 for an all-NULL or empty group (pandas ``groupby.sum``)."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def extract_or_null(c, pattern: str, idx: int = 1) -> Column:
    """``regexp_extract`` that yields NULL, not '', when the pattern misses."""
    return F.nullif(F.regexp_extract(_c(c), pattern, idx), F.lit(""))


def safe_div(a, b) -> Column:
    """Division that is NULL instead of an ANSI error on a zero divisor."""
    return F.try_divide(_c(a), _c(b))


def to_double(c) -> Column:
    """Text -> double after trimming; unparsable text becomes NULL."""
    c = _c(c)
    return F.trim(c.cast("string")).try_cast("double")


def to_bigint(c) -> Column:
    """Text -> bigint, exactly: '12', ' 12 ', '12.0' and '9007199254740993'
    parse; fractional or other text becomes NULL."""
    text = F.trim(_c(c).cast("string"))
    whole = F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.regexp_replace(text, r"\.0*$", ""))
    return whole.try_cast("bigint")


def null_safe_eq(left: Column, right: Column, match_nulls: bool) -> Column:
    """Join predicate: pandas merges NaN keys with each other, SQL ``=`` does not."""
    return left.eqNullSafe(right) if match_nulls else left == right
