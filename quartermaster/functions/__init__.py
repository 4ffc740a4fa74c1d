"""Column -> Column helpers (all JVM-side expressions, no Python UDFs)."""

from quartermaster.functions.nulls import (  # noqa: F401
    clean_nan, extract_or_null, max_strict, nan_to_null, null_safe_eq, safe_div,
    sum0, to_bigint, to_double,
)
from quartermaster.functions.scalar import (  # noqa: F401
    cube_feet, lookup, numeric_hash, square_feet, text_bool,
)
