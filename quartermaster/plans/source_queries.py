"""Registered queries for the file readers: tables are written as files in
the session's shared folder, with other column orders and further columns,
and read back by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.plans import classes as X
from quartermaster.plans.table_queries import ORACLE_SQL, QUERIES, register, t
from quartermaster.sources import contract as K
from quartermaster.sources import io as IO
from quartermaster.streaming.lifecycle import state_base

__all__ = ["QUERIES", "ORACLE_SQL"]

ORDER_COLUMNS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
ORDERS_CONTRACT = {"name": "orders_text", "columns": [
    {"name": "o_orderkey", "type": "INTEGER"}, {"name": "o_custkey", "type": "INTEGER"},
    {"name": "o_orderstatus", "type": "STRING"}, {"name": "o_totalprice", "type": "DECIMAL"}],
    "projection": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]}
_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice{} FROM orders"


def orders_file(spark, sf_dir) -> str:
    """Orders as CSV files, columns in another order and one more of them."""
    path = state_base(spark, "qm-csv") + "/orders.csv"
    o = t(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey")
    IO.write_table(o, path)
    return path


@register("csv_roundtrip", _ORDERS_SQL.format(""))
def q_csv_roundtrip(spark, sf_dir) -> DataFrame:
    return IO.read_table(spark, orders_file(spark, sf_dir), schema=ORDER_COLUMNS)


@register("csv_contract", _ORDERS_SQL.format(", CAST(0 AS INTEGER) AS _bad_cells"))
def q_csv_contract(spark, sf_dir) -> DataFrame:
    return K.read_contract(spark, orders_file(spark, sf_dir), ORDERS_CONTRACT)


@register("csv_to_parquet", "SELECT p_partkey, p_name, CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS p_retailprice FROM part")
def q_csv_to_parquet(spark, sf_dir) -> DataFrame:
    base = state_base(spark, "qm-csv")
    price = F.when(F.col("p_size") % 5 == 0, F.lit(".")).otherwise(F.col("p_retailprice").cast("string"))
    IO.write_table(t(spark, sf_dir, "part").select(price.alias("p_retailprice"), "p_brand", "p_name", "p_partkey"), base + "/part.csv")
    return IO.csv_to_parquet(spark, base + "/part.csv", base + "/part.parquet", "p_partkey bigint, p_name string, p_retailprice double")


@register("read_many_classes", """
SELECT p_partkey, p_size, CAST(NULL AS BIGINT) AS p_keylen FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, CAST(NULL AS INTEGER), p_partkey + 1 FROM part WHERE p_partkey % 2 = 1
""")
def q_read_many_classes(spark, sf_dir) -> DataFrame:
    base = state_base(spark, "qm-many")
    part = t(spark, sf_dir, "part")
    for name, frame in (("cos_a", part.filter("p_partkey % 2 = 0").select(F.col("p_size").cast("int").alias("p_size"), "p_partkey")),
                        ("cos_b", part.filter("p_partkey % 2 = 1").select("p_partkey", (F.col("p_partkey") + 1).alias("p_keylen")))):
        IO.write_table(frame, f"{base}/{name}", fmt="parquet")
    out = IO.read_many(spark, base, "*.parquet").drop("source_file")
    return out.select("p_partkey", "p_size", F.col("p_keylen").cast("bigint").alias("p_keylen"))


@register("manifest_read", _ORDERS_SQL.format(""))
def q_manifest_read(spark, sf_dir) -> DataFrame:
    base = state_base(spark, "qm-manifest")
    entries = spark.createDataFrame([(orders_file(spark, sf_dir), True), (base + "/absent.csv", False)], "url string, mandatory boolean")
    IO.write_manifest(spark, entries, base + "/manifest")
    return IO.read_from_manifest(spark, IO.read_manifest(spark, base + "/manifest"), schema=ORDER_COLUMNS)


@register("header_profile", "SELECT 'o_orderpriority,o_totalprice,o_orderstatus,o_custkey,o_orderkey' AS header, CAST(count(*) > 0 AS BOOLEAN) AS files FROM orders")
def q_header_profile(spark, sf_dir) -> DataFrame:
    profile = IO.profile_headers(spark, orders_file(spark, sf_dir))
    return profile.groupBy(F.array_join("columns", ",").alias("header")).agg((F.count(F.lit(1)) > 0).alias("files"))


@register("class_outputs_from_files", """
WITH o AS (SELECT * FROM (VALUES ('I'), ('IV')) v(CLASS_OF_SUPPLY))
SELECT o.CLASS_OF_SUPPLY, CAST(count(*) AS BIGINT) AS n FROM orders CROSS JOIN o GROUP BY 1
""")
def q_class_outputs_from_files(spark, sf_dir) -> DataFrame:
    base = state_base(spark, "qm-classes")
    o = t(spark, sf_dir, "orders")
    paths = []
    for label, cols in (("I", ["POS", "CUFT"]), ("IV", ["CUFT", "SQFT", "POS"])):
        frame = o.select(F.lit(label).alias("CLASS_OF_SUPPLY"), F.col("o_orderstatus").alias("POS"),
                         F.col("o_totalprice").alias("CUFT"), F.col("o_totalprice").alias("SQFT"))
        paths.append(f"{base}/cos{label}_embark.csv")
        IO.materialize_missing({paths[-1]: frame.select("CLASS_OF_SUPPLY", *cols)}, fmt="csv")
    outputs, _ = X.read_class_outputs(spark, paths)
    return X.aggregated_classes(outputs).groupBy("CLASS_OF_SUPPLY").agg(F.count(F.lit(1)).alias("n"))


def write_archives(spark, sf_dir, rows: int = 50_000) -> str:
    """Orders as CSV members, one for each status, of ZIP archives of about ``rows`` orders."""
    from quartermaster.sources.archives import create_file
    base = state_base(spark, "qm-zip")
    o = t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    number = F.pmod(F.xxhash64("o_orderkey"), F.lit(1 + o.count() // rows)).alias("archive")

    def pack(key, pdf):
        import io
        import zipfile

        import pandas as pd
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.txt", "no table")
            for status, part in pdf.groupby("o_orderstatus"):
                z.writestr(f"run/{status}.csv", part.drop(columns="o_orderstatus").to_csv(index=False))
        with create_file(f"{base}/in/orders-{key[0]}.zip") as f:
            f.write(held.getvalue())
        return pd.DataFrame({"archive": [key[0]]})

    spark.createDataFrame([], "a int").write.mode("overwrite").parquet(f"{base}/in")  # makes the folder
    o.groupBy(number).applyInPandas(pack, "archive bigint").count()
    return base


@register("zip_members", """
SELECT o_orderkey, o_custkey, o_totalprice, 'run/' || o_orderstatus || '.csv' AS member, CAST(NULL AS VARCHAR) AS error FROM orders
""")
def q_zip_members(spark, sf_dir) -> DataFrame:
    """Orders read back from the members of archives, several members to a task."""
    rows = IO.read_zip_csv(spark, write_archives(spark, sf_dir) + "/in/*.zip", columns=["o_orderkey", "o_custkey", "o_totalprice"],
                           bundle_bytes=1 << 20)
    return rows.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), F.col("o_totalprice").cast("double"), "member", "error")


# ---------------------------------------------------------------------------
# Contracts made from tables, their differences, the input gate
# ---------------------------------------------------------------------------
def orders_as_text(spark, sf_dir) -> DataFrame:
    """Orders read from CSV files whose types are inferred; the date is text."""
    base = state_base(spark, "qm-infer")
    IO.write_table(t(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "'on' yyyy-MM-dd")), base + "/orders.csv")
    return IO.read_table(spark, base + "/orders.csv")


@register("inferred_contract", """
SELECT * FROM (VALUES (0, 'o_orderkey', 'INTEGER'), (1, 'o_custkey', 'INTEGER'), (2, 'o_orderstatus', 'STRING'), (3, 'o_totalprice', 'DECIMAL'),
                      (4, 'o_orderdate', 'STRING'), (5, 'o_orderpriority', 'STRING')) AS v(place, name, contract_type)
WHERE (SELECT count(*) FROM orders) >= 0
""")
def q_inferred_contract(spark, sf_dir) -> DataFrame:
    """The contract of a CSV file whose types are inferred."""
    made = K.infer_contract(orders_as_text(spark, sf_dir), "orders")
    rows = [(i, c["name"], c["type"]) for i, c in enumerate(made["columns"])]
    return spark.createDataFrame(rows, "place int, name string, contract_type string")


@register("contract_differences", """
SELECT * FROM (VALUES ('o_orderdate', CAST(NULL AS VARCHAR), 'STRING', 'extra'), ('o_orderpriority', NULL, 'STRING', 'extra'),
                      ('o_totalprice', 'INTEGER', 'DECIMAL', 'type_mismatch'), ('o_clerk', 'STRING', NULL, 'missing')) AS v(name, contract_type, actual_type, issue)
WHERE (SELECT count(*) FROM orders) >= 0
""")
def q_contract_differences(spark, sf_dir) -> DataFrame:
    """How a CSV file's inferred columns differ from a contract."""
    want = {"name": "w", "columns": [{"name": "o_orderkey", "type": "INTEGER"}, {"name": "o_custkey", "type": "INTEGER"}, {"name": "o_orderstatus", "type": "STRING"},
                                     {"name": "o_totalprice", "type": "INTEGER"}, {"name": "o_clerk", "type": "STRING"}]}
    return K.contract_diff(orders_as_text(spark, sf_dir), want)
