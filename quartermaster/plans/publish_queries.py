"""Registered queries for the publishing jobs.

A run is a customer. Which expected datasets exist as files, as state rows
or as created datasets is read from the customer's orders and line items
(day of month of a date, modulo the list's length = position in the fixed
dataset list), so the work
grows with the tables. Report definitions are built one per line item
(row-local, so none grows with a hot key) from the line and its order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.plans import publish as P
from quartermaster.plans.cascade import DATASET_FILTERS
from quartermaster.plans.table_queries import ORACLE_SQL, QUERIES, register, t

__all__ = ["QUERIES", "ORACLE_SQL"]

EXPECTED_STEMS = [s for _, s in P.EXPECTED_DATASETS]
MAPPED_STEMS = list(dict.fromkeys(d for d, _ in P.DATASET_SHEETS))


def _stem_at(stems, idx):
    return F.try_element_at(F.array(*[F.lit(s) for s in stems]), idx)


def _position(date: str, stems):
    """Day of month, modulo the list's length: every row has a place in it."""
    return F.dayofmonth(date) % len(stems) + 1


def _pairs(df: DataFrame, run, idx, stems) -> DataFrame:
    out = df.select(run.alias("assessment_id"), _stem_at(stems, idx).alias("stem"))
    out = out.filter(F.col("stem").isNotNull()).distinct()
    return out.withColumn("dataset_id", P.dataset_id(F.col("stem"), F.col("assessment_id")))


def _values_sql(stems) -> str:
    return ", ".join(f"({i + 1}, '{s}')" for i, s in enumerate(stems))


@register("reconcile_datasets", f"""
WITH stems AS (SELECT * FROM (VALUES {_values_sql(EXPECTED_STEMS)}) AS v(idx, stem)),
runs AS (SELECT DISTINCT o_custkey AS assessment_id FROM orders),
e AS (SELECT r.assessment_id, s.stem FROM runs r CROSS JOIN stems s),
f AS (SELECT DISTINCT o.o_custkey AS assessment_id, s.stem FROM orders o
      JOIN stems s ON dayofmonth(o.o_orderdate) % {len(EXPECTED_STEMS)} + 1 = s.idx),
st AS (SELECT DISTINCT o.o_custkey AS assessment_id, s.stem FROM lineitem l
       JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN stems s ON dayofmonth(l.l_shipdate) % {len(EXPECTED_STEMS)} + 1 = s.idx),
d AS (SELECT e.assessment_id, f.stem IS NOT NULL AS hf, st.stem IS NOT NULL AS hs FROM e
      LEFT JOIN f ON e.assessment_id = f.assessment_id AND e.stem = f.stem
      LEFT JOIN st ON e.assessment_id = st.assessment_id AND e.stem = st.stem)
SELECT assessment_id, count(*) FILTER (WHERE hf AND hs) AS n_matched,
       count(*) FILTER (WHERE NOT hf AND NOT hs) AS n_synced,
       count(*) FILTER (WHERE hf <> hs) AS n_unmatched,
       CASE WHEN count(*) FILTER (WHERE hf <> hs) = 0 THEN '{P.SYNCED_SIGNAL}' END AS signal
FROM d GROUP BY assessment_id
""")
def q_reconcile_datasets(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    runs = o.select(F.col("o_custkey").alias("assessment_id")).distinct()
    expected = P.expected_datasets(runs)
    files = _pairs(o, F.col("o_custkey"), _position("o_orderdate", EXPECTED_STEMS), EXPECTED_STEMS)
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    lo = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    state = _pairs(lo, F.col("o_custkey"), _position("l_shipdate", EXPECTED_STEMS), EXPECTED_STEMS)
    _, verdict = P.reconcile_datasets(expected, files, state)
    return verdict


@register("publishable_sheets", f"""
WITH stems AS (SELECT * FROM (VALUES {_values_sql(MAPPED_STEMS)}) AS v(idx, stem)),
m AS (SELECT * FROM (VALUES {", ".join(f"('{d}', '{s}', {P.SHEET_ORDER.index(s) + 1})"
                                       for d, s in P.DATASET_SHEETS)}) AS v(stem, sheet_name, sheet_order)),
a AS (SELECT DISTINCT o.o_custkey AS assessment_id, s.stem FROM orders o
      JOIN stems s ON dayofmonth(o.o_orderdate) % {len(MAPPED_STEMS)} + 1 = s.idx WHERE o.o_orderstatus = 'F')
SELECT DISTINCT a.assessment_id, CAST(m.sheet_order AS INTEGER) AS sheet_order, m.sheet_name
FROM a JOIN m ON a.stem = m.stem
""")
def q_publishable_sheets(spark, sf_dir):
    o = t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    available = _pairs(o, F.col("o_custkey"), _position("o_orderdate", MAPPED_STEMS), MAPPED_STEMS)
    return P.publishable_sheets(available, P.sheet_mapping(spark))


def line_definitions(spark, sf_dir) -> DataFrame:
    """One report definition (JSON text) per line item, built row by row (no
    grouping, so no document can grow with a hot key): a sheet for the
    order's status holding one visual for the order, whose field wells carry
    the line's two measures and the order's priority dimension.

    Lines are dealt out by their key, in as many tasks as the session
    shuffles to: a line is small and its document is not, so partitions
    joined by their size before would be few and long. ``inline`` keeps the
    text a column of its own; merged into ``from_json`` it would be made by
    interpreted expressions.
    """
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    j = j.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey", "l_linenumber")
    order = F.col("l_orderkey").cast("string")
    line_id = F.concat(order, F.lit("_"), F.col("l_linenumber").cast("string"))

    def field(kind, fid, ds, col):
        return F.struct(F.struct(fid.alias("FieldId"), F.struct(
            ds.alias("DataSetIdentifier"), F.lit(col).alias("ColumnName")).alias("Column")).alias(kind))

    ds = F.concat(F.lit("ds_"), F.col("l_returnflag"))
    values = F.array(field("NumericalMeasureField", F.concat(F.lit("Q"), line_id), ds, "l_quantity"),
                     field("NumericalMeasureField", F.concat(F.lit("P"), line_id), ds, "l_extendedprice"))
    group = F.array(field("CategoricalDimensionField", F.concat(F.lit("G"), order),
                          F.concat(F.lit("orders_"), F.col("o_orderpriority")), "o_orderpriority"))
    vtype = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("BarChartVisual")) \
        .otherwise(F.lit("TableVisual"))
    wells = F.struct(F.struct(values.alias("Values"), group.alias("GroupBy")).alias("AggregatedFieldWells"))
    visual = F.create_map(vtype, F.struct(
        F.concat(F.lit("V"), order).alias("VisualId"),
        F.struct(wells.alias("FieldWells")).alias("ChartConfiguration")))
    sheet = F.struct(F.concat(F.lit("S_"), F.col("o_orderstatus")).alias("SheetId"),
                     F.array(visual).alias("Visuals"))
    return j.select(F.inline(F.array(F.struct(
        F.concat(F.lit("L"), line_id).alias("document"),
        F.to_json(F.struct(F.array(sheet).alias("Sheets"))).alias("definition")))))


_VT = ("CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'BarChartVisual' "
       "ELSE 'TableVisual' END")


_LINE = "CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR)"
_FU_COMMON = f"""'L' || {_LINE} AS document, 'S_' || o.o_orderstatus AS sheet_id,
       'V' || CAST(o.o_orderkey AS VARCHAR) AS visual_id, {_VT} AS visual_type,
       'AggregatedFieldWells' AS well"""


@register("field_usage", f"""
SELECT {_FU_COMMON}, 'Values' AS role, 'NumericalMeasureField' AS field_kind, 'Q' || {_LINE} AS field_id,
       'ds_' || l.l_returnflag AS dataset_identifier, 'l_quantity' AS column_name
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
UNION ALL
SELECT {_FU_COMMON}, 'Values', 'NumericalMeasureField', 'P' || {_LINE}, 'ds_' || l.l_returnflag,
       'l_extendedprice'
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
UNION ALL
SELECT {_FU_COMMON}, 'GroupBy', 'CategoricalDimensionField', 'G' || CAST(o.o_orderkey AS VARCHAR),
       'orders_' || o.o_orderpriority, 'o_orderpriority'
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def q_field_usage(spark, sf_dir):
    return P.field_usage(line_definitions(spark, sf_dir))


# ---------------------------------------------------------------------------
# The parts of a report that each run keeps
# ---------------------------------------------------------------------------
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def report_definition(spark, sf_dir) -> dict[str, DataFrame]:
    """A definition from the parts (calculated fields, every third built on
    another, and column configurations) and suppliers (visuals of two fields)."""
    from quartermaster.plans.cascade import mapping_tables
    stem = lambda i: _stem_at(MAPPED_STEMS, (i % len(MAPPED_STEMS) + 1).cast("int"))
    name = lambda c: F.concat(F.lit("f"), c.cast("string"))
    part, key = t(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("p_partkey")
    supplier = t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    sheet = F.get(F.array(*[F.lit(s) for s in P.SHEET_ORDER]), (F.col("s_nationkey") % len(P.SHEET_ORDER)).cast("int"))
    visual = F.concat(F.lit("v"), F.col("s_suppkey").cast("string")).alias("visual")
    identifiers = spark.createDataFrame([(s.replace("-", "_"), s) for s in MAPPED_STEMS], "identifier string, dataset string")
    underscored = lambda c: F.regexp_replace(c, "-", "_").alias("identifier")
    return mapping_tables(spark) | {
        "identifiers": identifiers,
        "fields": part.select(name(key).alias("field"), underscored(stem(F.col("p_size")))),
        "field_uses": part.filter((key % 3 == 0) & (key > 0)).select(name(key).alias("field"), name(F.floor(key / 2)).alias("uses")),
        "columns": part.select(F.concat(F.lit("c"), key.cast("string")).alias("column"), underscored(stem(key))),
        "visuals": supplier.select(visual, sheet.alias("sheet")),
        "visual_fields": supplier.select(visual, F.explode(F.array(name(F.col("s_suppkey")), name(F.col("s_suppkey") * 2))).alias("field"))}


_STEM_ROWS = ", ".join(f"({i}, '{s}')" for i, s in enumerate(MAPPED_STEMS))


@register("report_parts", f"""
WITH RECURSIVE stems AS (SELECT * FROM (VALUES {_STEM_ROWS}) AS v(idx, stem)),
segments AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{s}')" for i, s in enumerate(SEGMENTS))}) AS v(seg, name)),
avail AS (SELECT DISTINCT c_nationkey * 10 + seg AS run, stem FROM customer JOIN segments ON c_mktsegment = name
          JOIN stems ON c_custkey % {len(MAPPED_STEMS)} = idx WHERE c_acctbal > 9300),
runs AS (SELECT DISTINCT run FROM avail),
sheets AS (SELECT * FROM (VALUES {", ".join(f"('{d}', '{s}', {P.SHEET_ORDER.index(s)})" for d, s in P.DATASET_SHEETS)}) AS v(stem, sheet, place)),
filters AS (SELECT * FROM (VALUES {", ".join(f"('{d}', '{f}')" for d, f in DATASET_FILTERS)}) AS v(stem, filter)),
nodes AS (SELECT 'identifier' AS part, replace(stem, '-', '_') AS name FROM stems UNION SELECT 'sheet', sheet FROM sheets UNION SELECT 'filter', filter FROM filters
          UNION SELECT 'field', 'f' || p_partkey FROM part UNION SELECT 'column', 'c' || p_partkey FROM part UNION SELECT 'visual', 'v' || s_suppkey FROM supplier),
edges AS (SELECT 'field' AS part, 'f' || p_partkey AS name, 'identifier' AS of_part, replace(stem, '-', '_') AS of_name FROM part JOIN stems ON p_size % {len(MAPPED_STEMS)} = idx
          UNION ALL SELECT 'field', 'f' || p_partkey, 'field', 'f' || (p_partkey // 2) FROM part WHERE p_partkey % 3 = 0 AND p_partkey > 0
          UNION ALL SELECT 'column', 'c' || p_partkey, 'identifier', replace(stem, '-', '_') FROM part JOIN stems ON p_partkey % {len(MAPPED_STEMS)} = idx
          UNION ALL SELECT 'visual', 'v' || s_suppkey, 'sheet', sheet FROM supplier JOIN (SELECT DISTINCT sheet, place FROM sheets) ON s_nationkey % {len(P.SHEET_ORDER)} = place
          UNION ALL SELECT 'visual', 'v' || s_suppkey, 'field', 'f' || (s_suppkey * k) FROM supplier, (VALUES (1), (2)) AS m(k)),
gone AS (SELECT run, 'identifier' AS part, replace(stem, '-', '_') AS name FROM runs, stems WHERE (run, stem) NOT IN (SELECT (run, stem) FROM avail)
         UNION SELECT run, 'sheet', sheet FROM runs, (SELECT DISTINCT sheet FROM sheets) WHERE (run, sheet) NOT IN (SELECT (run, sheet) FROM avail JOIN sheets USING (stem))
         UNION SELECT run, 'filter', filter FROM runs, (SELECT DISTINCT filter FROM filters) WHERE (run, filter) NOT IN (SELECT (run, filter) FROM avail JOIN filters USING (stem))
         UNION SELECT gone.run, e.part, e.name FROM gone JOIN edges e ON e.of_part = gone.part AND e.of_name = gone.name)
SELECT run AS assessment_id, 'dataset' AS part, stem AS name, CAST(NULL AS INTEGER) AS position FROM avail
UNION ALL
SELECT run, part, name, CASE WHEN part = 'sheet' THEN CAST((SELECT min(place) + 1 FROM sheets WHERE sheet = name) AS INTEGER) END
FROM runs, nodes WHERE (run, part, name) NOT IN (SELECT (run, part, name) FROM gone)
""")
def q_report_parts(spark, sf_dir):
    """All parts of the report that a run (nation and segment) keeps."""
    from quartermaster.plans.cascade import report_parts
    c = t(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 9300)
    segment = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment")) - 1
    available = c.select((F.col("c_nationkey") * 10 + segment).cast("int").alias("assessment_id"),
                         _stem_at(MAPPED_STEMS, (F.col("c_custkey") % len(MAPPED_STEMS) + 1).cast("int")).alias("dataset"))
    return report_parts(available, report_definition(spark, sf_dir)).drop("level")
