"""Spark result vs. SQL oracle (DuckDB over the same parquet files).

Compares column names and types, row count and the multiset of rows. Floats are
compared after rounding to 6 decimals; dates/timestamps as text.
"""

from __future__ import annotations

import math
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for tname in TABLES:
        con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{sf_dir}/{tname}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, query_fn, sql: str, sf_dir: str, con=None):
    sdf = query_fn(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_names) != sorted(d_names):
        return False, f"columns differ: spark={sorted(s_names)} oracle={sorted(d_names)}"
    d_types = {d[0]: str(d[1]) for d in res.description}
    bad_types = [(c, t, d_types.get(c)) for c, t in sdf.dtypes if SPARK_TO_DUCK.get(t) != d_types.get(c)]
    if bad_types:
        return False, f"column types differ (name, spark, oracle): {bad_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(d_rows)}"
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    if a != b:
        only_s = list((a - b).items())[:3]
        only_d = list((b - a).items())[:3]
        return False, f"values differ; spark-only={only_s} oracle-only={only_d}"
    return True, f"{len(s_rows)} rows"
