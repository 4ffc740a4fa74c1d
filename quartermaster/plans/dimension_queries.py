"""Registered queries for the part-dimension jobs.

Parts are the distinct parts that appear on line items; the catalog is
derived from ``part`` (PROMO parts are absent from it, small parts carry a
zero weight, the largest a zero cube). Measures are multiples of 1/4 or 1/8
so sums and means are exact in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.plans import dimensions as D
from quartermaster.plans.table_queries import ORACLE_SQL, QUERIES, register, t

__all__ = ["QUERIES", "ORACLE_SQL"]


def _niin(c):
    return F.lpad(F.col(c).cast("string"), 9, "0")


def line_parts(spark, sf_dir) -> DataFrame:
    """Parts that appear on line items (the requirement's part list)."""
    p = t(spark, sf_dir, "part")
    used = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    p = p.join(used, "p_partkey", "left_semi")
    return p.select(F.col("p_brand").alias("FSC"), _niin("p_partkey").alias("NIIN"),
                    F.col("p_name").alias("Nomenclature"), F.lit("EA").alias("UI"),
                    F.col("p_retailprice").alias("Unit_Price"))


_PARTS_SQL = """parts AS (
  SELECT p_brand AS FSC, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS NIIN, p_name AS Nomenclature,
         'EA' AS UI, p_retailprice AS Unit_Price
  FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem))"""


def part_catalog(spark, sf_dir) -> DataFrame:
    p = t(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    size = F.col("p_size").cast("double")
    return p.select(
        _niin("p_partkey").alias("niin"),
        F.concat(F.lit("PN"), F.col("p_partkey").cast("string")).alias("part_number"),
        F.concat(F.lit("C"), F.col("p_size").cast("string")).alias("cage_code"),
        F.when(F.col("p_size") < 4, F.lit(0.0)).otherwise(size / 4).alias("dss_weight"),
        F.when(F.col("p_size") > 47, F.lit(0.0)).otherwise(size / 8).alias("dss_cube"),
        F.when(F.col("p_type") == "LARGE", F.lit(0.0)).otherwise(size / 2).alias("unit_pack_weight"),
        F.when(F.col("p_type") == "SMALL", F.lit(None).cast("double")).otherwise(size / 16)
        .alias("unit_pack_cube"))


_CATALOG_SQL = """cat AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS niin, 'PN' || CAST(p_partkey AS VARCHAR) AS part_number,
         'C' || CAST(p_size AS VARCHAR) AS cage_code,
         CASE WHEN p_size < 4 THEN CAST(0.0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / 4 END AS dss_weight,
         CASE WHEN p_size > 47 THEN CAST(0.0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / 8 END AS dss_cube,
         CASE WHEN p_type = 'LARGE' THEN CAST(0.0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / 2 END AS unit_pack_weight,
         CASE WHEN p_type = 'SMALL' THEN CAST(NULL AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / 16 END AS unit_pack_cube
  FROM part WHERE p_type <> 'PROMO')"""


# ---------------------------------------------------------------------------
# X12 decimal repair
# ---------------------------------------------------------------------------
def undotted_dimensions(spark, sf_dir) -> DataFrame:
    """Length / width / height written without decimal points, and the
    known cubic feet: for ECONOMY, STANDARD and SMALL parts the cube is that
    of (L/10, W/10, H) plus 0.0004, for the others an unrelated value."""
    p = t(spark, sf_dir, "part")
    ln = F.col("p_size") * 10 + 5
    wd = F.col("p_size") + 100
    ht = F.length("p_name") * 10 + F.col("p_size")
    true_cf = (ln / 10) * (wd / 10) * ht / 1728 + 0.0004
    cf = F.when(F.col("p_type").isin("ECONOMY", "STANDARD", "SMALL"), true_cf).otherwise(
        F.col("p_retailprice") / 1000)
    return p.select("p_partkey", ln.cast("bigint").alias("l"), wd.cast("bigint").alias("w"),
                    ht.cast("bigint").alias("h"), cf.alias("cubic_feet"))


def _placements_sql(x: str) -> str:
    return (f"list_transform(range(1, length(CAST({x} AS VARCHAR)) + 1), "
            f"lambda i: {x} / power(10.0, length(CAST({x} AS VARCHAR)) - i))")


@register("decimal_repair", f"""
WITH d AS (
  SELECT p_partkey, CAST(p_size * 10 + 5 AS BIGINT) AS l, CAST(p_size + 100 AS BIGINT) AS w,
         CAST(length(p_name) * 10 + p_size AS BIGINT) AS h,
         CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'SMALL')
              THEN ((p_size * 10 + 5) / 10) * ((p_size + 100) / 10) * (length(p_name) * 10 + p_size) / 1728
                   + CAST(0.0004 AS DOUBLE)
              ELSE p_retailprice / 1000 END AS cubic_feet
  FROM part),
c AS (
  SELECT *, list_filter(flatten(list_transform({_placements_sql('l')}, lambda a: flatten(list_transform(
              {_placements_sql('w')}, lambda b: list_transform({_placements_sql('h')},
              lambda cc: {{'l': a, 'w': b, 'h': cc}}))))),
            lambda s: abs(s.l * s.w * s.h / 1728 - cubic_feet) < CAST(0.001 AS DOUBLE))[1] AS hit
  FROM d)
SELECT p_partkey, l, w, h, cubic_feet, hit.l AS l_new, hit.w AS w_new, hit.h AS h_new FROM c
""")
def q_decimal_repair(spark, sf_dir):
    return D.repair_dimensions(undotted_dimensions(spark, sf_dir), "l", "w", "h", "cubic_feet")


# ---------------------------------------------------------------------------
# X13 catalog summary: supplier catalog rows per part, ECONOMY parts requested
# ---------------------------------------------------------------------------
def supplier_catalog(spark, sf_dir) -> DataFrame:
    """One catalog row per line item: part as NIIN, supplier as part number,
    CAGE code and company, line quantity / 4 as weight."""
    li = t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    s = t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.select(_niin("l_partkey").alias("niin"),
                    F.concat(F.lit("PN"), F.col("l_suppkey").cast("string")).alias("part_number"),
                    F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("cage_code"),
                    F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("parent_cage"),
                    F.col("s_name").alias("company_name"),
                    (F.col("l_quantity") / 4).alias("dss_weight"))


@register("catalog_summary", """
WITH c AS (
  SELECT lpad(CAST(l.l_partkey AS VARCHAR), 9, '0') AS niin, 'PN' || CAST(l.l_suppkey AS VARCHAR) AS part_number,
         'C' || CAST(s.s_nationkey AS VARCHAR) AS cage_code, 'P' || CAST(s.s_nationkey AS VARCHAR) AS parent_cage,
         s.s_name AS company_name, l.l_quantity / 4 AS dss_weight
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
want AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS niin FROM part WHERE p_type = 'ECONOMY')
SELECT niin, string_agg(DISTINCT part_number, ', ' ORDER BY part_number) AS part_number,
       string_agg(DISTINCT cage_code, ', ' ORDER BY cage_code) AS cage_code,
       string_agg(parent_cage, ', ' ORDER BY parent_cage) AS parent_cage,
       string_agg(company_name, ', ' ORDER BY company_name) AS company_name,
       string_agg(CAST(dss_weight AS VARCHAR), ', ' ORDER BY CAST(dss_weight AS VARCHAR)) AS dss_weight
FROM c WHERE niin IN (SELECT niin FROM want) GROUP BY niin
""")
def q_catalog_summary(spark, sf_dir):
    want = (t(spark, sf_dir, "part").filter(F.col("p_type") == "ECONOMY")
            .select(_niin("p_partkey").alias("niin")))
    return D.catalog_summary(supplier_catalog(spark, sf_dir), want,
                             list_cols=["parent_cage", "company_name", "dss_weight"])


# ---------------------------------------------------------------------------
# X14 missing dimensions
# ---------------------------------------------------------------------------
_MISSING_SQL = """missing AS (
  SELECT DISTINCT NIIN, 'not_in_catalog' AS reason FROM parts WHERE NIIN NOT IN (SELECT niin FROM cat)
  UNION ALL
  SELECT DISTINCT niin, 'zero_dimension' FROM cat
  WHERE (coalesce(dss_weight, 0) = 0 OR coalesce(dss_cube, 0) = 0) AND niin IN (SELECT NIIN FROM parts))"""


@register("missing_dimensions", "WITH " + _PARTS_SQL + ",\n" + _CATALOG_SQL + ",\n" + _MISSING_SQL
          + "\nSELECT NIIN, reason FROM missing")
def q_missing_dimensions(spark, sf_dir):
    return D.missing_dimensions(line_parts(spark, sf_dir), part_catalog(spark, sf_dir))


# ---------------------------------------------------------------------------
# X15 imputation (tree ensemble; no SQL form) and its mean baseline
# ---------------------------------------------------------------------------
def _imputation_sets(spark, sf_dir):
    parts, cat = line_parts(spark, sf_dir), part_catalog(spark, sf_dir)
    miss = D.missing_dimensions(parts, cat).select("NIIN")
    missing = parts.join(miss, "NIIN", "left_semi")
    train = (parts.join(miss, "NIIN", "left_anti")
             .join(cat.select(F.col("niin").alias("NIIN"), "dss_weight", "dss_cube"), "NIIN"))
    return parts, cat, train, missing


@register("impute_measure")
def q_impute_measure(spark, sf_dir):
    _, _, train, missing = _imputation_sets(spark, sf_dir)
    out = D.impute_dimensions(train, missing, model="forest", mode="corrected")
    return out.select("NIIN", "FSC", "Nomenclature", "dss_weight", "dss_cube", "Imputed")


_IMPUTED_SQL = """train AS (
  SELECT p.FSC, c.dss_weight, c.dss_cube FROM parts p JOIN cat c ON p.NIIN = c.niin
  WHERE p.NIIN NOT IN (SELECT NIIN FROM missing)),
g AS (SELECT FSC, avg(ln(1 + dss_weight)) AS gw, avg(ln(1 + dss_cube)) AS gc FROM train GROUP BY FSC),
mp AS (SELECT p.NIIN, coalesce(g.gw, (SELECT avg(ln(1 + dss_weight)) FROM train)) AS pw,
              coalesce(g.gc, (SELECT avg(ln(1 + dss_cube)) FROM train)) AS pc
       FROM parts p LEFT JOIN g ON p.FSC = g.FSC WHERE p.NIIN IN (SELECT NIIN FROM missing)),
imputed AS (
  SELECT NIIN, CASE WHEN pw = 0 THEN (SELECT min(pw) FROM mp WHERE pw > 0) ELSE pw END AS dss_weight,
         CASE WHEN pc = 0 THEN (SELECT min(pc) FROM mp WHERE pc > 0) ELSE pc END AS dss_cube,
         'Yes' AS Imputed FROM mp)"""


# ---------------------------------------------------------------------------
# X16 final dimension table (mean imputation, so it has a SQL form)
# ---------------------------------------------------------------------------
@register("final_dimension_table", "WITH " + ",\n".join(
    [_PARTS_SQL, _CATALOG_SQL, _MISSING_SQL, _IMPUTED_SQL]) + """,
z AS (SELECT * FROM cat WHERE dss_weight IS NULL OR dss_weight = 0 OR dss_cube IS NULL OR dss_cube = 0),
j AS (
  SELECT p.FSC, p.NIIN, p.Nomenclature, p.UI, p.Unit_Price,
         coalesce(z.part_number, c.part_number, 'Not in FLIS') AS part_number,
         coalesce(z.cage_code, c.cage_code, 'Not in FLIS') AS cage_code,
         coalesce(z.dss_weight, c.dss_weight) AS dss_weight, coalesce(z.dss_cube, c.dss_cube) AS dss_cube,
         z.unit_pack_weight AS zw, z.unit_pack_cube AS zc, c.dss_weight AS cw, c.dss_cube AS cc
  FROM parts p LEFT JOIN z ON p.NIIN = z.niin LEFT JOIN cat c ON p.NIIN = c.niin),
s1 AS (
  SELECT DISTINCT FSC, NIIN, Nomenclature, part_number, cage_code, UI, Unit_Price, dss_weight, dss_cube,
         CASE WHEN zw IS NULL OR zw = 0 THEN coalesce(dss_weight, cw) ELSE zw END AS unit_pack_weight,
         CASE WHEN zc IS NULL OR zc = 0 THEN coalesce(dss_cube, cc) ELSE zc END AS unit_pack_cube
  FROM j),
s2 AS (
  SELECT s1.FSC, s1.NIIN, s1.Nomenclature, s1.part_number, s1.cage_code, s1.UI, s1.Unit_Price,
         CASE WHEN s1.dss_weight IS NULL OR s1.dss_weight = 0 THEN i.dss_weight ELSE s1.dss_weight END AS w2,
         CASE WHEN s1.dss_cube IS NULL OR s1.dss_cube = 0 THEN i.dss_cube ELSE s1.dss_cube END AS c2,
         s1.unit_pack_weight AS upw, s1.unit_pack_cube AS upc, i.dss_weight AS iw, i.dss_cube AS ic,
         coalesce(i.Imputed, 'No') AS Imputed
  FROM s1 LEFT JOIN imputed i ON s1.NIIN = i.NIIN)
SELECT DISTINCT FSC, NIIN, Nomenclature, part_number, cage_code, UI, round(Unit_Price, 3) AS Unit_Price,
       round(w2, 3) AS dss_weight, round(c2, 3) AS dss_cube,
       round(CASE WHEN upw IS NULL OR upw = 0 THEN coalesce(iw, w2) ELSE upw END, 3) AS unit_pack_weight,
       round(CASE WHEN upc IS NULL OR upc = 0 THEN coalesce(ic, c2) ELSE upc END, 3) AS unit_pack_cube,
       Imputed
FROM s2
""")
def q_final_dimension_table(spark, sf_dir):
    parts, cat, train, missing = _imputation_sets(spark, sf_dir)
    imputed = D.impute_dimensions(train, missing, model="mean", mode="reference")
    return D.final_dimension_table(parts, cat, imputed)


# ---------------------------------------------------------------------------
# X17 patch by nomenclature
# ---------------------------------------------------------------------------
def named_dimensions(spark, sf_dir) -> DataFrame:
    p = t(spark, sf_dir, "part")
    size = F.col("p_size").cast("double")
    return p.select(_niin("p_partkey").alias("NIIN"), F.col("p_name").alias("NOMENCLATURE"),
                    F.when(F.col("p_size") <= 5, F.lit(0.0)).when(F.col("p_size") > 48, F.lit(-1.0))
                    .otherwise(size / 4).alias("DSS_WEIGHT"),
                    (size / 8).alias("DSS_CUBE"))


@register("patch_from_name_check", """
WITH d AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS NIIN, p_name AS NOMENCLATURE,
         CASE WHEN p_size <= 5 THEN CAST(0.0 AS DOUBLE) WHEN p_size > 48 THEN CAST(-1.0 AS DOUBLE)
              ELSE CAST(p_size AS DOUBLE) / 4 END AS w0,
         CAST(p_size AS DOUBLE) / 8 AS c0
  FROM part),
nc AS (SELECT p_name AS NOMENCLATURE,
              avg(CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) / 4 END) AS nw,
              avg(CAST(p_size AS DOUBLE) / 8 + 1) AS ncube
       FROM part GROUP BY p_name),
p1 AS (SELECT d.*, nc.nw, nc.ncube, CASE WHEN w0 <= 0 THEN coalesce(nc.nw, w0) ELSE w0 END AS DSS_WEIGHT
       FROM d LEFT JOIN nc ON d.NOMENCLATURE = nc.NOMENCLATURE)
SELECT DISTINCT NIIN, NOMENCLATURE, DSS_WEIGHT,
       CASE WHEN DSS_WEIGHT <= 0 THEN coalesce(ncube, c0) ELSE c0 END AS DSS_CUBE
FROM p1
""")
def q_patch_from_name_check(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    size = F.col("p_size").cast("double")
    name_check = p.groupBy(F.col("p_name").alias("NOMENCLATURE")).agg(
        F.avg(F.when(F.col("p_size") > 10, size / 4)).alias("DSS_WEIGHT"),
        F.avg(size / 8 + 1).alias("DSS_CUBE"))
    return D.patch_from_name_check(named_dimensions(spark, sf_dir), name_check)
