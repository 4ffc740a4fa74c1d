"""Table contracts: read every cell as text, then cast / tag / project.

A contract is plain JSON::

    {"name": "POS",
     "columns": [{"name": "POS", "type": "STRING"},
                 {"name": "Period", "type": "INTEGER"},
                 {"name": "Region", "type": "STRING", "tag": "STATE"}],
     "projection": ["POS", "Period"]}

Types: STRING, INTEGER (-> bigint), DECIMAL (-> double by default, or
``decimal(38,4)`` with ``decimal_as='decimal'``). Casts never fail the job:
a cell that does not parse becomes NULL and is counted in ``_bad_cells``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.functions.nulls import to_bigint
from quartermaster.operators.columns import q
from quartermaster.sources.io import read_text_columns

SPARK_TYPE = {"STRING": "string", "INTEGER": "bigint", "DECIMAL": "double"}
CONTRACT_TYPE = {"string": "STRING", "bigint": "INTEGER", "int": "INTEGER",
                 "smallint": "INTEGER", "tinyint": "INTEGER", "double": "DECIMAL",
                 "float": "DECIMAL", "boolean": "STRING", "date": "STRING",
                 "timestamp": "STRING"}


def load_contract(src) -> dict:
    if isinstance(src, Mapping):
        return dict(src)
    with open(src) as fh:
        return json.load(fh)


def _cast(c: Column, ctype: str, decimal_as: str) -> Column:
    ctype = ctype.upper()
    if ctype == "STRING":
        return c.cast("string")
    text = F.trim(c.cast("string"))
    if ctype == "INTEGER":
        return to_bigint(c)
    if ctype == "DECIMAL":
        return text.try_cast("decimal(38,4)" if decimal_as == "decimal" else "double")
    raise ValueError(f"unknown contract type {ctype}")


# P10 (+ N2 bad-cell count)
def apply_casts(df: DataFrame, contract, decimal_as: str = "double",
                count_bad: bool = True) -> DataFrame:
    c = load_contract(contract)
    spec = {col["name"]: col for col in c["columns"]}
    exprs, bad = [], []
    for name in df.columns:
        if name in spec:
            cast = _cast(q(name), spec[name]["type"], decimal_as)
            if spec[name]["type"].upper() != "STRING":
                raw = F.trim(q(name).cast("string"))
                bad.append(F.when(raw.isNotNull() & (raw != "") & cast.isNull(), 1).otherwise(0))
            exprs.append(cast.alias(name))
        else:
            exprs.append(q(name))
    if count_bad:
        total = F.lit(0)
        for b in bad:
            total = total + b
        exprs.append(total.cast("int").alias("_bad_cells"))
    return df.select(exprs)


# P11
def tag(df: DataFrame, col: str, role: str) -> DataFrame:
    """Attach a role (e.g. geographic STATE/COUNTRY) as column metadata."""
    return df.withColumn(col, q(col).alias(col, metadata={"tag": role}))


# P12
def apply_projection(df: DataFrame, contract) -> DataFrame:
    """The contract's columns in its order; an absent one is an error."""
    c = load_contract(contract)
    keep = c.get("projection") or [col["name"] for col in c["columns"]]
    absent = [p for p in keep if p not in df.columns]
    if absent:
        raise ValueError(f"projected columns are absent: {absent}")
    extra = ["_bad_cells"] if "_bad_cells" in df.columns else []
    return df.select([q(p) for p in keep + extra])


# S3
def read_contract(spark: SparkSession, path, contract, decimal_as: str = "double") -> DataFrame:
    """All cells as text, the contract's columns taken by header name (a
    missing one is an error, others are not read), then logical casts, tags
    and projection."""
    c = load_contract(contract)
    df = read_text_columns(spark, path, [col["name"] for col in c["columns"]])
    df = apply_casts(df, c, decimal_as)
    for col in c["columns"]:
        if col.get("tag"):
            df = tag(df, col["name"], col["tag"])
    return apply_projection(df, c)


def cast_row(df: DataFrame, contract, decimal_as: str = "double") -> DataFrame:
    """Contract casts over an already-loaded all-text frame (no file read)."""
    return apply_projection(apply_casts(df, contract, decimal_as), contract)


def contract_type(kind: T.DataType) -> str:
    """The contract type of a Spark type."""
    t = kind.simpleString()
    return CONTRACT_TYPE.get(t, "DECIMAL" if t.startswith("decimal") else "STRING")


# S4
def infer_contract(df: DataFrame, name: str, tags: Mapping[str, str] | None = None) -> dict:
    """Contract from a schema: integral -> INTEGER, fractional -> DECIMAL,
    everything else (text, boolean, dates) -> STRING."""
    cols = []
    for f in df.schema.fields:
        entry = {"name": f.name, "type": contract_type(f.dataType)}
        if tags and f.name in tags:
            entry["tag"] = tags[f.name]
        cols.append(entry)
    return {"name": name, "columns": cols, "projection": [f.name for f in df.schema.fields]}


def contract_frame(spark: SparkSession, contract) -> DataFrame:
    c = load_contract(contract)
    rows = [(col["name"], col["type"].upper()) for col in c["columns"]]
    return spark.createDataFrame(rows, "name string, contract_type string")


# P15
def contract_diff(df: DataFrame, contract) -> DataFrame:
    """Missing / extra / type-mismatched columns of ``df`` against a contract."""
    spark = df.sparkSession
    want = contract_frame(spark, contract)
    have_rows = [(f.name, contract_type(f.dataType))
                 for f in df.schema.fields if f.name != "_bad_cells"]
    have = spark.createDataFrame(have_rows, "name string, actual_type string")
    j = want.join(have, "name", "full")
    issue = (F.when(F.col("actual_type").isNull(), "missing")
             .when(F.col("contract_type").isNull(), "extra")
             .when(F.col("contract_type") != F.col("actual_type"), "type_mismatch"))
    return j.withColumn("issue", issue).filter(F.col("issue").isNotNull())
