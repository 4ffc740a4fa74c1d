"""Scalar column functions used by the composite jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quartermaster.functions.nulls import max_strict


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(c, mapping: dict, default=0.0) -> Column:
    """Constant map lookup with a default (a folded CASE, stays in codegen)."""
    c = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def text_bool(c) -> Column:
    """'TRUE'/'FALSE' in any case -> boolean; anything else -> NULL."""
    u = F.upper(F.trim(_c(c).cast("string")))
    return F.when(u == "TRUE", F.lit(True)).when(u == "FALSE", F.lit(False))


def numeric_hash(c, digits: int = 12) -> Column:
    """SHA-256 hex of the text, keep only the decimal digits, take the last ``digits``."""
    h = F.regexp_replace(F.sha2(_c(c).cast("string"), 256), "[^0-9]", "")
    return F.right(h, F.lit(digits))


def is_sentinel(c, values=(0, 9999)) -> Column:
    """True where a dimension holds an 'unknown' marker."""
    return _c(c).isin(*values)


def cube_feet(length, width, height, cube, sentinels=(0, 9999)) -> Column:
    """Cubic feet from inch dimensions, floored by a catalog cube.

    Any side that is a sentinel -> the catalog cube; otherwise the larger of
    L*W*H/12^3 and the cube, NULL when either is NULL (numpy semantics).
    """
    l, w, h = _c(length), _c(width), _c(height)
    bad = is_sentinel(l, sentinels) | is_sentinel(w, sentinels) | is_sentinel(h, sentinels)
    geom = (l / 12) * (w / 12) * (h / 12)
    return F.when(bad, _c(cube)).otherwise(max_strict(geom, _c(cube)))


def square_feet(length, width, sentinels=(0, 9999)) -> Column:
    """Floor area in square feet; 0 when a side is a sentinel."""
    l, w = _c(length), _c(width)
    bad = is_sentinel(l, sentinels) | is_sentinel(w, sentinels)
    return F.when(bad, F.lit(0.0)).otherwise((l / 12) * (w / 12))


def cents(c) -> Column:
    """Money as whole cents (bigint) so sums are exact on every engine."""
    return half_up(_c(c) * 100)


def half_up(x: Column) -> Column:
    """``round(x)`` of a double as bigint, halves away from zero. Whole part and
    rest of a size are exact, so the usual range needs no decimal text, as
    ``round`` does for each value."""
    size = F.abs(x)
    whole = F.floor(size)
    near = F.when(size - whole >= 0.5, whole + 1).otherwise(whole)
    return F.when(size < 9e15, F.when(x < 0, -near).otherwise(near)).otherwise(F.round(x).cast("bigint"))


def from_cents(c) -> Column:
    return _c(c).cast("double") / 100.0
