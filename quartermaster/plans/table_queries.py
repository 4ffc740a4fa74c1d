"""Registered queries over the shared test tables, one per operator group.

Each query reads whole tables (``region nation customer supplier part orders
lineitem events documents embeddings pages benchmark labels conversations``)
and runs the library operator or composite job on them, or on a frame Spark
derives from them. ``ORACLE_SQL`` holds the same computation as plain SQL
for an independent engine. Money is summed as whole cents so both engines
agree exactly; other floats are rounded to 4 places on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.functions.nulls import extract_or_null
from quartermaster.functions.scalar import cents, cube_feet, from_cents, lookup, numeric_hash, square_feet
from quartermaster.operators import columns as C
from quartermaster.operators import relational as R
from quartermaster.operators import reshape as S
from quartermaster.plans import classes as X
from quartermaster.sources import contract as K
from quartermaster.sources import io as IO

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

# Fixed values of the test-data derivations (not of the source system):
# part type -> ration type used to build a ration table from lineitem.
TYPE_TO_RATION = {
    "ECONOMY": "MEALS_READY_TO_EAT_MRE",
    "SMALL": "UGR_H_S_BREAKFAST",
    "MEDIUM": "UGR_H_S_LUNCH_DINNER",
    "PROMO": "UGR_M_BREAKFAST",
    "STANDARD": "UGR_M_LUNCH_DINNER",
}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PERIODS = ["POS1", "POS2", "POS3", "BEYOND"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r4(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(C.q(c), 4) for c in cols})


def _d(v) -> str:
    """A float constant as a SQL double literal (parsed exactly like Python's)."""
    return f"CAST({v!r} AS DOUBLE)"


def _sql_case(col: str, mapping: dict, default: str) -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN CAST({v!r} AS DOUBLE)" if not isinstance(v, str)
                    else f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {arms} ELSE {default} END"


# ---------------------------------------------------------------------------
# Flagship: class I rations over a ration table derived from lineitem
# ---------------------------------------------------------------------------
UNITS_PER_PALLET = 40
CUFT_PER_PALLET = 45.5
LBS_PER_UNIT = 22.5


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with the columns of their part."""
    return t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))


def ration_requirements(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Wide pallet-requirement table (the class I input layout) from
    lineitem x part x supplier x nation x region: one row per ship year,
    ration type and supplier location; quarters 1-3 are the planned
    periods DOS1..DOS3, quarter 4 is BEYOND. Quantities are summed by supplier
    key first, so no line is shuffled with the texts of its location."""
    lines = part_lines(spark, sf_dir) if lines is None else lines
    sup = t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    geo = (t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"),
                                           F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    qtr = F.quarter("l_shipdate")
    sums = ["DOS1_Units", "DOS2_Units", "DOS3_Units", "BEYOND"]
    of_supplier = lines.groupBy(
        "l_suppkey", F.year("l_shipdate").cast("bigint").alias("AssessmentNumber"),
        F.coalesce(lookup("p_type", TYPE_TO_RATION, None), F.col("p_type")).alias("Ration_Type")
    ).agg(*[F.sum(F.when(qtr == k + 1, F.col("l_quantity"))).alias(c) for k, c in enumerate(sums)])
    j = (of_supplier.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(geo, F.col("s_nationkey") == F.col("n_nationkey")))
    j = j.select(
        "AssessmentNumber", F.lit("I").alias("Class_of_Supply"), "Ration_Type",
        F.col("r_name").alias("Region"),
        F.concat("r_name", F.lit("_"), "n_name").alias("Region_MEF_Lead"),
        F.col("n_name").alias("CAP_Name"), F.col("n_name").alias("CAP_Names"),
        F.col("s_suppkey").alias("Location_ID"),
        F.concat(F.lit("LOC_"), F.col("s_suppkey").cast("string")).alias("Location_Name"),
        F.lit("CS").alias("Unit of Issue"), *sums)
    keys = ["AssessmentNumber", "Class_of_Supply", "Ration_Type", "Region", "Region_MEF_Lead",
            "CAP_Name", "CAP_Names", "Location_ID", "Location_Name", "Unit of Issue"]
    w = j.groupBy(*[C.q(k) for k in keys]).agg(*[F.sum(c).alias(c) for c in sums])
    cols = {}
    for k in (1, 2, 3):
        u = F.col(f"DOS{k}_Units")
        pallets = F.ceil(u / UNITS_PER_PALLET).cast("bigint")
        cols[f"DOS{k}_Units_Pallet_Qty"] = pallets
        cols[f"DOS{k}_Units_Pallet_Tot_CuFT"] = pallets * CUFT_PER_PALLET
        cols[f"DOS{k}_Units_Pallet_Tot_Wt(lbs)"] = u * LBS_PER_UNIT
        cols[f"DOS{k}_Units_Pallet_Tot_TEUs"] = pallets / 16
        cols[f"DOS{k}_Units_Pallet_Tot_FEUs"] = pallets / 32
    return w.withColumns(cols)


RATION_SQL = f"""
WITH j AS (
  SELECT CAST(year(l.l_shipdate) AS BIGINT) AS AssessmentNumber, 'I' AS Class_of_Supply,
         {_sql_case('p.p_type', TYPE_TO_RATION, 'p.p_type')} AS Ration_Type,
         r.r_name AS Region, r.r_name || '_' || n.n_name AS Region_MEF_Lead,
         s.s_suppkey AS Location_ID, 'LOC_' || CAST(s.s_suppkey AS VARCHAR) AS Location_Name,
         'CS' AS UI, quarter(l.l_shipdate) AS qtr, l.l_quantity
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
w AS (
  SELECT AssessmentNumber, Class_of_Supply, Ration_Type, Region, Region_MEF_Lead, Location_ID,
         Location_Name, UI,
         sum(CASE WHEN qtr = 1 THEN l_quantity END) AS u1,
         sum(CASE WHEN qtr = 2 THEN l_quantity END) AS u2,
         sum(CASE WHEN qtr = 3 THEN l_quantity END) AS u3,
         sum(CASE WHEN qtr = 4 THEN l_quantity END) AS u4
  FROM j GROUP BY AssessmentNumber, Class_of_Supply, Ration_Type, Region, Region_MEF_Lead,
                  Location_ID, Location_Name, UI),
p AS (
  SELECT *, CAST(CAST(ceil(u1 / {UNITS_PER_PALLET}) AS BIGINT) AS DOUBLE) AS p1,
            CAST(CAST(ceil(u2 / {UNITS_PER_PALLET}) AS BIGINT) AS DOUBLE) AS p2,
            CAST(CAST(ceil(u3 / {UNITS_PER_PALLET}) AS BIGINT) AS DOUBLE) AS p3 FROM w),
long AS (
  SELECT *, 'POS1' AS POS, u1 AS QTY, p1 AS PALLETS, p1 * {_d(CUFT_PER_PALLET)} AS CUFT, p1 / 16 AS TEUS,
         u1 * {_d(LBS_PER_UNIT)} AS WEIGHT_LBS FROM p
  UNION ALL
  SELECT *, 'POS2', u2, p2, p2 * {_d(CUFT_PER_PALLET)}, p2 / 16, u2 * {_d(LBS_PER_UNIT)} FROM p
  UNION ALL
  SELECT *, 'POS3', u3, p3, p3 * {_d(CUFT_PER_PALLET)}, p3 / 16, u3 * {_d(LBS_PER_UNIT)} FROM p
  UNION ALL
  SELECT *, 'BEYOND', u4,
         CASE WHEN Ration_Type = 'MEALS_READY_TO_EAT_MRE' THEN u4 / 48
              WHEN Ration_Type IN ('UGR_H_S_BREAKFAST', 'UGR_H_S_LUNCH_DINNER', 'UGR_M_BREAKFAST',
                                   'UGR_M_LUNCH_DINNER') THEN u4 / 8 END,
         CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM p)
SELECT AssessmentNumber AS ASSESSMENTNUMBER, Class_of_Supply AS CLASS_OF_SUPPLY,
       Ration_Type AS COS_TYPE, Region AS REGION, Region_MEF_Lead AS REGION_MEF_LEAD,
       Location_ID AS LOCATION_ID, Location_Name AS LOCATION_NAME, UI, POS,
       QTY, PALLETS, CUFT, TEUS, WEIGHT_LBS,
       QTY * {_sql_case('Ration_Type', X.FIXED['ration_cost'], 'CAST(0.0 AS DOUBLE)')} AS TOTAL_COST
FROM long
"""

CLASS_I_MEASURES = ["QTY", "PALLETS", "CUFT", "TEUS", "WEIGHT_LBS", "TOTAL_COST"]


@register("class_i", RATION_SQL)
def q_class_i(spark, sf_dir, lines=None):
    return X.class_i(ration_requirements(spark, sf_dir, lines))


@register("class_i_pivot_plan", RATION_SQL)
def q_class_i_pivot(spark, sf_dir):
    return X.class_i(ration_requirements(spark, sf_dir), plan="pivot")


# ---------------------------------------------------------------------------
# Reshaping
# ---------------------------------------------------------------------------
@register("unpivot_measures", """
SELECT l_orderkey, l_linenumber, regexp_extract(name, '^l_(.*)$', 1) AS metric, value
FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
             nullif(l_discount, 0) AS l_discount FROM lineitem)
UNPIVOT INCLUDE NULLS (value FOR name IN (l_quantity, l_extendedprice, l_discount))
""")
def q_unpivot_measures(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"))
    m = S.melt(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount"],
               "name", "value")
    return S.split_name(m, "name", r"^l_(.*)$", ["metric"], drop=True)


@register("unpivot_pivot_roundtrip", """
SELECT o_orderkey,
       max(CASE WHEN name = 'o_custkey_d' THEN value END) AS o_custkey_d,
       max(CASE WHEN name = 'o_totalprice' THEN value END) AS o_totalprice
FROM (SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey_d, o_totalprice FROM orders)
UNPIVOT INCLUDE NULLS (value FOR name IN (o_custkey_d, o_totalprice))
GROUP BY o_orderkey
""")
def q_roundtrip(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey_d"), "o_totalprice")
    m = S.melt(o, ["o_orderkey"], ["o_custkey_d", "o_totalprice"], "name", "value")
    return S.pivot_strict(m, ["o_orderkey"], "name", ["o_custkey_d", "o_totalprice"], "value")


@register("pivot_first_nonnull", "SELECT user_id, " + ", ".join(
    f"arg_min(v, event_id) FILTER (WHERE event_type = '{e}') AS {e}" for e in EVENT_TYPES) + """
FROM (SELECT user_id, event_type, event_id, CASE WHEN value >= 100 THEN value END AS v FROM events)
WHERE v IS NOT NULL
GROUP BY user_id
""")
def q_pivot_first(spark, sf_dir):
    ev = t(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id",
        F.when(F.col("value") >= 100, F.col("value")).alias("v"))
    return S.pivot_first(ev, ["user_id"], "event_type", EVENT_TYPES, "v", "event_id")


_PERIOD_CASE = ("CASE WHEN year(o_orderdate) <= 1996 THEN 'POS1' WHEN year(o_orderdate) <= 1998 "
                "THEN 'POS2' WHEN year(o_orderdate) <= 2000 THEN 'POS3' ELSE 'BEYOND' END")


@register("multi_measure_unpivot", f"""
WITH o AS (SELECT o_custkey, {_PERIOD_CASE} AS p,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
w AS (SELECT o_custkey, """ + ", ".join(
    f"CAST(sum(CASE WHEN p = '{p}' THEN c END) AS DOUBLE) / 100 AS total_{p}, "
    f"count(CASE WHEN p = '{p}' THEN 1 END) AS cnt_{p}" for p in PERIODS) + """
      FROM o GROUP BY o_custkey)
""" + " UNION ALL ".join(
    f"SELECT o_custkey, '{p}' AS POS, total_{p} AS total, cnt_{p} AS cnt FROM w" for p in PERIODS))
def q_multi_unpivot(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    y = F.year("o_orderdate")
    period = (F.when(y <= 1996, "POS1").when(y <= 1998, "POS2").when(y <= 2000, "POS3")
              .otherwise("BEYOND"))
    o = o.select("o_custkey", period.alias("p"), cents("o_totalprice").alias("c"))
    aggs = []
    for p in PERIODS:
        aggs.append(from_cents(F.sum(F.when(F.col("p") == p, F.col("c")))).alias(f"total_{p}"))
        aggs.append(F.count(F.when(F.col("p") == p, F.lit(1))).alias(f"cnt_{p}"))
    wide = o.groupBy("o_custkey").agg(*aggs)
    return S.melt_multi(wide, ["o_custkey"], r"(total|cnt)_(POS[1-3]|BEYOND)",
                        period_col="POS", periods=PERIODS)


# ---------------------------------------------------------------------------
# Period table and period joins
# ---------------------------------------------------------------------------
def status_runs(spark, sf_dir):
    """Run table and parameter table per order status: the operation spans
    the status' order dates; the three supply periods end at 1/4, 1/2, 3/4."""
    o = t(spark, sf_dir, "orders")
    stats = o.groupBy("o_orderstatus").agg(
        F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("bigint").alias("d"))
    runs = stats.select(F.col("o_orderstatus").alias("AssessmentNumber"),
                        F.col("d").alias("OperationDuration"))
    params = stats.select(F.col("o_orderstatus").alias("AssessmentID"),
                          F.expr("d div 4").alias("DaysOfSupplyFirst"),
                          F.expr("d div 2").alias("DaysOfSupplySecond"),
                          F.expr("(3 * d) div 4").alias("DaysOfSupplyThird"))
    return runs, params


PERIOD_SQL = """
WITH s AS (SELECT o_orderstatus,
                  CAST(date_diff('day', CAST(min(o_orderdate) AS DATE),
                                 CAST(max(o_orderdate) AS DATE)) AS BIGINT) AS d
           FROM orders GROUP BY o_orderstatus),
p AS (
  SELECT o_orderstatus AS AssessmentNumber, 'POS1' AS POS, 'DOS1' AS DOS, d // 4 AS Period,
         CAST(1 AS BIGINT) AS Sort_Index FROM s
  UNION ALL SELECT o_orderstatus, 'POS2', 'DOS2', d // 2, CAST(2 AS BIGINT) FROM s
  UNION ALL SELECT o_orderstatus, 'POS3', 'DOS3', (3 * d) // 4, CAST(3 AS BIGINT) FROM s
  UNION ALL SELECT o_orderstatus, 'BEYOND', 'BEYOND', d, CAST(4 AS BIGINT) FROM s)
"""


@register("period_table", PERIOD_SQL + "SELECT * FROM p")
def q_period_table(spark, sf_dir):
    runs, params = status_runs(spark, sf_dir)
    return X.period_table(runs, params)


@register("rows_to_period_join", PERIOD_SQL + """,
l AS (SELECT l_orderkey, l_linenumber, l_linestatus AS AssessmentNumber,
             CASE quarter(l_shipdate) WHEN 1 THEN 'DOS1' WHEN 2 THEN 'DOS2' WHEN 3 THEN 'DOS3'
                  ELSE 'BEYOND' END AS DOS_Period FROM lineitem)
SELECT l.l_orderkey, l.l_linenumber, l.AssessmentNumber, l.DOS_Period, p.POS, p.DOS, p.Period,
       p.Sort_Index
FROM l LEFT JOIN p ON l.AssessmentNumber = p.AssessmentNumber AND l.DOS_Period = p.DOS
""")
def q_rows_to_period(spark, sf_dir):
    runs, params = status_runs(spark, sf_dir)
    periods = X.period_table(runs, params)
    qtr = F.quarter("l_shipdate")
    li = t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linestatus").alias("AssessmentNumber"),
        F.when(qtr == 1, "DOS1").when(qtr == 2, "DOS2").when(qtr == 3, "DOS3")
        .otherwise("BEYOND").alias("DOS_Period"))
    return X._period_join(li, periods)


# ---------------------------------------------------------------------------
# Windows
# ---------------------------------------------------------------------------
@register("daily_running_total", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
d AS (SELECT day, sum(c) AS daily FROM o GROUP BY day),
w AS (SELECT day, daily, sum(daily) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING
                                          AND CURRENT ROW) AS cum FROM d)
SELECT o.o_orderkey, strftime(o.day, '%Y-%m-%d') AS Day,
       CAST(w.daily AS DOUBLE) / 100 AS daily_total, CAST(w.cum AS DOUBLE) / 100 AS cumulative_total
FROM o LEFT JOIN w ON o.day = w.day
""")
def q_running_total(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("Day"), cents("o_totalprice").alias("c"))
    r = R.running_total(o, "Day", "c", "daily_c", "cum_c")
    return r.select("o_orderkey", F.date_format("Day", "yyyy-MM-dd").alias("Day"),
                    from_cents("daily_c").alias("daily_total"),
                    from_cents("cum_c").alias("cumulative_total"))


@register("partition_totals", """
WITH l AS (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS ship_day, l_quantity,
                  CAST(round(l_extendedprice * 100) AS BIGINT) AS b,
                  CAST(round(l_extendedprice * l_tax * 100) AS BIGINT) AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, ship_day,
       sum(l_quantity) OVER (PARTITION BY ship_day) AS day_qty,
       CAST(sum(b) OVER (PARTITION BY ship_day) AS DOUBLE) / 100 AS day_base,
       CAST(sum(x) OVER (PARTITION BY ship_day) AS DOUBLE) / 100 AS day_tax,
       CAST(sum(b) OVER (PARTITION BY ship_day) + sum(x) OVER (PARTITION BY ship_day) AS DOUBLE) / 100
         AS day_total
FROM l
""")
def q_partition_totals(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day"),
        "l_quantity", cents("l_extendedprice").alias("b"),
        cents(F.col("l_extendedprice") * F.col("l_tax")).alias("x"))
    w = R.partition_total(li, "ship_day", {"day_qty": "l_quantity", "day_b": "b", "day_x": "x"})
    w = R.add_columns(w, "day_t", ["day_b", "day_x"])
    return w.select("l_orderkey", "l_linenumber", "ship_day", "day_qty",
                    from_cents("day_b").alias("day_base"), from_cents("day_x").alias("day_tax"),
                    from_cents("day_t").alias("day_total"))


# ---------------------------------------------------------------------------
# Lookups and per-class arithmetic
# ---------------------------------------------------------------------------
@register("class_cost_lookup", f"""
SELECT p_partkey, Ration_Type,
       {_sql_case('Ration_Type', X.FIXED['ration_cost'], 'CAST(0.0 AS DOUBLE)')} AS rate,
       p_retailprice * {_sql_case('Ration_Type', X.FIXED['ration_cost'], 'CAST(0.0 AS DOUBLE)')} AS cost
FROM (SELECT p_partkey, p_retailprice, {_sql_case('p_type', TYPE_TO_RATION, 'p_type')} AS Ration_Type
      FROM part)
""")
def q_cost_lookup(spark, sf_dir):
    p = t(spark, sf_dir, "part").select(
        "p_partkey", "p_retailprice",
        F.coalesce(lookup("p_type", TYPE_TO_RATION, None), F.col("p_type")).alias("Ration_Type"))
    p = p.withColumn("rate", lookup("Ration_Type", X.FIXED["ration_cost"], 0.0))
    return p.select("p_partkey", "Ration_Type", "rate",
                    (F.col("p_retailprice") * F.col("rate")).alias("cost"))


# ---------------------------------------------------------------------------
# Class jobs on frames derived from lineitem / part
# ---------------------------------------------------------------------------
_QTR_POS = ("CASE quarter(l_shipdate) WHEN 1 THEN 'POS1' WHEN 2 THEN 'POS2' WHEN 3 THEN 'POS3' "
            "ELSE 'BEYOND' END")


def _qtr_pos():
    qtr = F.quarter("l_shipdate")
    return (F.when(qtr == 1, "POS1").when(qtr == 2, "POS2").when(qtr == 3, "POS3")
            .otherwise("BEYOND"))


def water_requirements(spark, sf_dir):
    """Water requirement rows (class I water input layout) from lineitem:
    potable = quantity, non-potable = 2 x quantity, drinking = 3 x quantity
    for returned lines only (NULL otherwise)."""
    li = t(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("AssessmentNumber"), F.lit("I-W").alias("Class_of_Supply"),
        F.col("l_returnflag").alias("Region"), F.col("l_linestatus").alias("Location_Name"),
        F.col("l_suppkey").alias("Location_ID"),
        F.concat("l_returnflag", "l_linestatus").alias("Region_MEF_Lead"),
        F.col("l_linenumber").cast("string").alias("UIC"), _qtr_pos().alias("POS"),
        F.col("l_quantity").alias("Potable_Rqmt"),
        (F.col("l_quantity") * 2).alias("NonPotable_Rqmt"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity") * 3).alias("Drinking_Rqmt"))


WATER_MEASURES = ["QTY", "PALLETS", "CUFT", "WEIGHT_LBS", "TEUS", "TOTAL_COST"]
_WF = X.FIXED


@register("pallet_calc", f"""
WITH w AS (
  SELECT l_orderkey AS AssessmentNumber, 'I-W' AS Class_of_Supply, l_returnflag AS Region,
         l_linestatus AS Location_Name, l_suppkey AS Location_ID,
         l_returnflag || l_linestatus AS Region_MEF_Lead, CAST(l_linenumber AS VARCHAR) AS UIC,
         {_QTR_POS} AS POS, l_quantity AS Potable_Rqmt, l_quantity * 2 AS NonPotable_Rqmt,
         CASE WHEN l_returnflag = 'R' THEN l_quantity * 3 END AS Drinking_Rqmt
  FROM lineitem),
m AS (SELECT * FROM w UNPIVOT INCLUDE NULLS (Units FOR COS_Type IN (Potable_Rqmt, NonPotable_Rqmt,
                                                                      Drinking_Rqmt))),
c AS (SELECT *, CASE WHEN COS_Type = 'Drinking_Rqmt'
                     THEN Units / {_WF['water_units_per_pallet']} * {_d(_WF['water_pallet_factor'])} END AS P
      FROM m),
f AS (SELECT *, coalesce(P, 0) AS Pallets,
             coalesce(CASE WHEN COS_Type = 'Drinking_Rqmt' THEN P * {_d(_WF['water_cuft_per_pallet'])} END, 0)
               AS CUFT,
             coalesce(CASE WHEN COS_Type = 'Drinking_Rqmt' THEN P * {_WF['water_lbs_per_pallet']} END, 0)
               AS Weight_lbs,
             coalesce(CASE WHEN COS_Type = 'Drinking_Rqmt'
                           THEN (P / {_WF['water_pallets_per_teu']}) * {_d(_WF['water_teu_factor'])} END, 0)
               AS TEUS,
             coalesce(CASE WHEN COS_Type = 'Drinking_Rqmt' THEN Units * {_d(_WF['water_cost_per_unit'])} END, 0)
               AS Total_Cost,
             CASE WHEN COS_Type = 'Drinking_Rqmt' THEN 'Case' ELSE 'Gals' END AS UI
      FROM c)
SELECT AssessmentNumber AS ASSESSMENTNUMBER, Class_of_Supply AS CLASS_OF_SUPPLY,
       COS_Type AS COS_TYPE, Region AS REGION, Region_MEF_Lead AS REGION_MEF_LEAD,
       Location_Name AS LOCATION_NAME, Location_ID AS LOCATION_ID, UIC, UI, POS,
       Units AS QTY, Pallets AS PALLETS, CUFT, Weight_lbs AS WEIGHT_LBS, TEUS,
       Total_Cost AS TOTAL_COST
FROM f WHERE Weight_lbs > 0
""")
def q_pallet_calc(spark, sf_dir):
    return X.class_i_water(water_requirements(spark, sf_dir))


def equipment_requirements(spark, sf_dir, lines=None):
    """Daily-equipment rows with unit dimensions (class II/VII input layout)
    from lineitem x part: the part's size and price give unit measures."""
    j = part_lines(spark, sf_dir) if lines is None else lines
    size = F.col("p_size").cast("double")
    return j.select(
        F.col("l_orderkey").alias("AssessmentNumber"), F.lit("II").alias("Class_of_Supply"),
        F.concat(F.lit("LOC_"), F.col("l_suppkey").cast("string")).alias("Location_Name"),
        F.col("l_returnflag").alias("Region"), F.col("l_linestatus").alias("Region_MEF_Lead"),
        F.col("l_linenumber").cast("string").alias("UIC"), _qtr_pos().alias("POS"),
        F.col("p_brand").alias("TAMCN"), (size / 10).alias("IND SQFT"),
        (size * 1.5).alias("IND CUFT"), (F.col("p_retailprice") / 1000).alias("IND STON"),
        (F.col("p_retailprice") / 1100).alias("IND MTON"), (size / 500).alias("TEU_Equivalents"),
        F.col("l_quantity").alias("TE_Orig_Qty"),
        F.col("p_retailprice").alias("STANDARD_UNIT_PRICE"),
        size.alias("DIM HEIGHT INCHES"), (size * 2).alias("DIM LENGTH INCHES"),
        (size * 3).alias("DIM WIDTH INCHES"))


II_VII_MEASURES = ["UNIT_PRICE", "STON_", "SQFT_", "CUFT_", "TEU_", "QTY", "CUFT", "SQFT", "TEUS",
                   "WEIGHT_LBS", "TOTAL_COST", "DIM HEIGHT INCHES", "DIM LENGTH INCHES",
                   "DIM WIDTH INCHES"]


@register("unit_extension", f"""
WITH e AS (
  SELECT l.l_orderkey AS AssessmentNumber, 'II' AS Class_of_Supply,
         'LOC_' || CAST(l.l_suppkey AS VARCHAR) AS Location_Name, l.l_returnflag AS Region,
         l.l_linestatus AS Region_MEF_Lead, CAST(l.l_linenumber AS VARCHAR) AS UIC, {_QTR_POS} AS POS,
         p.p_brand || '_Class_II/VII' AS COS_Type, CAST(p.p_size AS DOUBLE) / 10 AS sqft_,
         CAST(p.p_size AS DOUBLE) * CAST(1.5 AS DOUBLE) AS cuft_, p.p_retailprice / 1000 AS ston_,
         CAST(p.p_size AS DOUBLE) / 500 AS teu_, l.l_quantity AS Qty, p.p_retailprice AS Unit_Price,
         CAST(p.p_size AS DOUBLE) AS h, CAST(p.p_size AS DOUBLE) * 2 AS len,
         CAST(p.p_size AS DOUBLE) * 3 AS wid
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT AssessmentNumber AS ASSESSMENTNUMBER, Class_of_Supply AS CLASS_OF_SUPPLY, COS_Type AS COS_TYPE,
       Region AS REGION, Region_MEF_Lead AS REGION_MEF_LEAD, Location_Name AS LOCATION_NAME, UIC,
       'NIIN' AS UI, Unit_Price AS UNIT_PRICE, h AS "DIM HEIGHT INCHES",
       len AS "DIM LENGTH INCHES", wid AS "DIM WIDTH INCHES", ston_ AS STON_, sqft_ AS SQFT_,
       cuft_ AS CUFT_, teu_ AS TEU_, POS, Qty AS QTY, Qty * cuft_ AS CUFT, Qty * sqft_ AS SQFT,
       Qty * teu_ AS TEUS, (Qty * ston_) / 2000 AS WEIGHT_LBS, Unit_Price * Qty AS TOTAL_COST
FROM e WHERE (Qty * ston_) / 2000 > 0
""")
def q_unit_extension(spark, sf_dir, lines=None):
    return X.class_ii_vii(equipment_requirements(spark, sf_dir, lines))


@register("dimension_cube", """
WITH d AS (
  SELECT p_partkey, CAST(p_size AS DOUBLE) AS L,
         CAST(CASE WHEN p_size < 5 THEN 0 ELSE p_size - 4 END AS DOUBLE) AS W,
         CAST(CASE WHEN p_size > 45 THEN 9999 ELSE p_size + 1 END AS DOUBLE) AS H,
         CASE WHEN p_retailprice > 990 THEN NULL ELSE p_retailprice / 100 END AS cube
  FROM part)
SELECT p_partkey,
       CASE WHEN L IN (0, 9999) OR W IN (0, 9999) OR H IN (0, 9999) THEN cube
            WHEN cube IS NULL THEN NULL
            ELSE greatest((L / 12) * (W / 12) * (H / 12), cube) END AS CUFT,
       CASE WHEN L IN (0, 9999) OR W IN (0, 9999) THEN CAST(0.0 AS DOUBLE)
            ELSE (L / 12) * (W / 12) END AS SQFT
FROM d
""")
def q_dimension_cube(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    L = F.col("p_size").cast("double")
    W = F.when(F.col("p_size") < 5, 0).otherwise(F.col("p_size") - 4).cast("double")
    H = F.when(F.col("p_size") > 45, 9999).otherwise(F.col("p_size") + 1).cast("double")
    cube = F.when(F.col("p_retailprice") > 990, F.lit(None)).otherwise(F.col("p_retailprice") / 100)
    return p.select("p_partkey", cube_feet(L, W, H, cube).alias("CUFT"),
                    square_feet(L, W).alias("SQFT"))


@register("flag_classification", """
SELECT o_orderkey,
       CASE WHEN upper(bat) = 'TRUE' THEN 'IX C (B)' WHEN upper(sec) = 'TRUE' THEN 'IX C (S)'
            ELSE 'IX C' END AS Class_of_Supply
FROM (SELECT o_orderkey,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'TRUE' ELSE 'false' END AS bat,
             CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'FALSE' END AS sec FROM orders)
""")
def q_flag_classification(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", "TRUE").otherwise("false").alias("Battery Flag"),
        F.when(F.col("o_orderstatus") == "F", "True").otherwise("FALSE").alias("SECREP Flag"))
    return X.class_ix_classify(o).select("o_orderkey", "Class_of_Supply")


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------
@register("join_suffix", """
SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_totalprice AS amount_left,
       o_orderstatus AS status_left, c_acctbal AS amount_right, c_mktsegment AS status_right
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_join_suffix(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"))
    c = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"),
        F.col("c_mktsegment").alias("status"))
    return R.join_suffix(o, c, "custkey")


_K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@register("null_safe_join", f"""
WITH ev AS (SELECT event_id, CASE WHEN {_K_SQL} >= 10 THEN {_K_SQL} END AS k FROM events),
b AS (SELECT k, count(*) AS k_events FROM ev GROUP BY k)
SELECT ev.event_id, ev.k, b.k_events FROM ev LEFT JOIN b ON ev.k IS NOT DISTINCT FROM b.k
""")
def q_null_safe_join(spark, sf_dir):
    ev = t(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k bigint").getField("k").alias("k_raw"))
    ev = ev.select("event_id", F.when(F.col("k_raw") >= 10, F.col("k_raw")).alias("k"))
    b = ev.groupBy("k").agg(F.count(F.lit(1)).alias("k_events"))
    return R.join_on(ev, b, "k", how="left", match_nulls=True)


@register("anti_missing", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderpriority = '1-URGENT')
""")
def q_anti_missing(spark, sf_dir):
    urgent = t(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return R.anti(t(spark, sf_dir, "customer"), urgent, "c_custkey", "o_custkey") \
        .select("c_custkey", "c_name")


@register("semi_list", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def q_semi_list(spark, sf_dir):
    seg = t(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    o = C.keep_in(t(spark, sf_dir, "orders"), "o_custkey", seg.select("c_custkey"))
    return o.select("o_orderkey", "o_custkey", "o_totalprice")


@register("missing_keys", """
SELECT c_custkey FROM customer
EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def q_missing_keys(spark, sf_dir):
    expected = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    avail = (t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
             .select(F.col("o_custkey").alias("key")))
    return R.missing_keys(expected, avail, "key").withColumnRenamed("key", "c_custkey")


@register("contains_join", """
SELECT doc_id, source, k AS key
FROM documents, (VALUES ('src1'), ('src2'), ('src3')) AS keys(k)
WHERE contains(source, k)
""")
def q_contains_join(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", "source")
    return R.contains_join(d, "source", ["src1", "src2", "src3"], "key")


@register("contains_join_keys", """
WITH ids AS (SELECT o_orderkey, o_orderpriority || '-dataset-' || CAST(o_custkey AS VARCHAR) AS dataset_id FROM orders),
keys AS (SELECT '-' || CAST(s_suppkey AS VARCHAR) AS key FROM supplier UNION SELECT DISTINCT o_orderpriority || '-dataset' FROM orders
         UNION SELECT DISTINCT p_brand FROM part UNION SELECT CAST(n_nationkey AS VARCHAR) FROM nation)
SELECT o_orderkey, dataset_id, key FROM ids JOIN keys ON contains(dataset_id, key)
""")
def q_contains_join_keys(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    ids = o.select("o_orderkey", F.concat("o_orderpriority", F.lit("-dataset-"), F.col("o_custkey").cast("string")).alias("dataset_id"))
    keys = t(spark, sf_dir, "supplier").select(F.concat(F.lit("-"), F.col("s_suppkey").cast("string")).alias("key")).union(
        o.select(F.concat("o_orderpriority", F.lit("-dataset")))).union(t(spark, sf_dir, "part").select("p_brand")).union(
        t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string")))
    return R.contains_join_keys(ids, "dataset_id", keys)


@register("coalesce_chain", """
WITH la AS (SELECT d.lang, avg(CAST(l.quality AS DOUBLE)) AS q
            FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY d.lang),
j AS (SELECT d.doc_id, NULLIF(CAST(l.quality AS DOUBLE), 0) AS a, NULLIF(la.q, 0) AS b
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN la ON d.lang = la.lang)
SELECT doc_id, COALESCE(a, b, 0.5) AS quality,
       CASE WHEN a IS NOT NULL THEN 'labels' WHEN b IS NOT NULL THEN 'lang_mean' ELSE 'default' END
         AS origin
FROM j
""")
def q_coalesce_chain(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = t(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    lang_mean = lab.join(docs, "doc_id").groupBy("lang").agg(F.avg("quality").alias("quality"))
    out = R.coalesce_chain(docs, "doc_id", [(lab, {"quality": "quality"}),
                                            (lang_mean, {"quality": "quality"}, "lang")],
                           default={"quality": 0.5}, origin_col="origin",
                           origin_names=["labels", "lang_mean"])
    return out.select("doc_id", "quality", "origin")


@register("conditional_patch", """
WITH a AS (SELECT s_nationkey,
                  CAST(sum(CASE WHEN s_acctbal > 0 THEN CAST(round(s_acctbal * 100) AS BIGINT) END)
                       AS DOUBLE) / count(CASE WHEN s_acctbal > 0 THEN 1 END) / 100 AS w_fill
           FROM supplier GROUP BY s_nationkey),
lk AS (SELECT s_nationkey, w_fill, w_fill / 10 AS c_fill FROM a),
p AS (SELECT s.s_suppkey, s.s_acctbal AS w0, s.s_acctbal / 10 AS c0, lk.w_fill, lk.c_fill
      FROM supplier s LEFT JOIN lk ON s.s_nationkey = lk.s_nationkey),
p1 AS (SELECT *, CASE WHEN w0 <= 0 THEN COALESCE(w_fill, w0) ELSE w0 END AS w FROM p)
SELECT s_suppkey, w, CASE WHEN w <= 0 THEN COALESCE(c_fill, c0) ELSE c0 END AS c
FROM p1
""")
def q_conditional_patch(spark, sf_dir):
    s = t(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", F.col("s_acctbal").alias("w"), (F.col("s_acctbal") / 10).alias("c"))
    pos = F.col("w") > 0
    lk = s.groupBy("s_nationkey").agg(
        (F.sum(F.when(pos, cents("w"))).cast("double") / F.count(F.when(pos, 1)) / 100).alias("w"))
    lk = lk.withColumn("c", F.col("w") / 10)
    out = R.patch(s, lk, "s_nationkey", ["w", "c"], sequential=True)
    return out.select("s_suppkey", "w", "c")


@register("reconcile_sets", """
WITH f AS (SELECT DISTINCT doc_id FROM labels),
s AS (SELECT DISTINCT doc_id FROM documents WHERE n_chars > 1000)
SELECT d.doc_id, f.doc_id IS NOT NULL AS has_file, s.doc_id IS NOT NULL AS has_state,
       CASE WHEN f.doc_id IS NOT NULL AND s.doc_id IS NOT NULL THEN 'matched'
            WHEN f.doc_id IS NULL AND s.doc_id IS NULL THEN 'synced' ELSE 'unmatched' END AS status
FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id LEFT JOIN s ON d.doc_id = s.doc_id
""")
def q_reconcile(spark, sf_dir):
    docs = t(spark, sf_dir, "documents")
    return R.reconcile(docs.select("doc_id"), t(spark, sf_dir, "labels"),
                       docs.filter(F.col("n_chars") > 1000), "doc_id")


# ---------------------------------------------------------------------------
# Aggregates
# ---------------------------------------------------------------------------
@register("list_agg", """
SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS nations
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""")
def q_list_agg(spark, sf_dir):
    j = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"),
                                        F.col("n_regionkey") == F.col("r_regionkey"))
    return R.list_agg(j, "r_name", ["n_name"]).withColumnRenamed("n_name", "nations")


@register("list_agg_distinct", """
SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS event_types
FROM events GROUP BY user_id
""")
def q_list_agg_distinct(spark, sf_dir):
    return R.list_agg(t(spark, sf_dir, "events"), "user_id", ["event_type"], distinct=True) \
        .withColumnRenamed("event_type", "event_types")


@register("first_per_key", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT user_id, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
WHERE rn = 1
""")
def q_first_per_key(spark, sf_dir):
    ev = t(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return R.first_per_key(ev, "user_id", "event_id")


@register("latest_state", """
SELECT user_id, epoch_us(ts) AS ts_us, event_id, event_type FROM (
  SELECT user_id, ts, event_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def q_latest_state(spark, sf_dir):
    ev = t(spark, sf_dir, "events").withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp")))
    return R.latest(ev, "user_id", "ts_us", ["event_id", "event_type"])


@register("completeness_gate", """
SELECT user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
       count(DISTINCT event_type) AS n_types
FROM events GROUP BY user_id, CAST(ts AS DATE)
HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events)
""")
def q_completeness(spark, sf_dir):
    from quartermaster.streaming.lifecycle import completeness_batch
    ev = t(spark, sf_dir, "events").select(
        "user_id", F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day"), "event_type")
    expected = ev.select("event_type").distinct()
    return completeness_batch(ev, ["user_id", "day"], "event_type", expected, "n_types")


@register("union_conform", """
SELECT 'customer' AS ENTITY, c_custkey AS KEY, c_nationkey AS NATIONKEY, c_name AS NAME,
       c_acctbal AS BALANCE, c_mktsegment AS SEGMENT FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_nationkey, s_name, s_acctbal, '0' FROM supplier
""")
def q_union_conform(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(
        F.lit("customer").alias("ENTITY"), F.col("c_custkey").alias("KEY"),
        F.col("c_nationkey").alias("NATIONKEY"), F.col("c_name").alias("NAME"),
        F.col("c_acctbal").alias("BALANCE"), F.col("c_mktsegment").alias("SEGMENT"))
    s = t(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("ENTITY"), F.col("s_suppkey").alias("KEY"),
        F.col("s_nationkey").alias("NATIONKEY"), F.col("s_name").alias("NAME"),
        F.col("s_acctbal").alias("BALANCE"))
    return R.union_conform([c, s], ["ENTITY", "KEY", "NATIONKEY", "NAME", "BALANCE", "SEGMENT"])


@register("rollup_measures", """
SELECT r_name, n_name, l_returnflag, sum(l_quantity) AS sum_qty,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS sum_price,
       count(*) AS n_lines,
       CAST(GROUPING(r_name, n_name, l_returnflag) AS BIGINT) AS grouping_level
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name, l_returnflag)
""")
def q_rollup(spark, sf_dir):
    geo = (t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"),
                                           F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    sup = t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    li = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity",
                                              cents("l_extendedprice").alias("c"))
    j = (li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(geo, F.col("s_nationkey") == F.col("n_nationkey")))
    out = R.rollup_sums(j, ["r_name", "n_name", "l_returnflag"],
                        {"sum_qty": "l_quantity", "sum_c": "c"}, count_col="n_lines")
    return out.withColumn("sum_price", from_cents("sum_c")).drop("sum_c")


@register("positive_min_fill", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal
                       ELSE (SELECT min(c_acctbal) FROM customer WHERE c_acctbal > 0) END AS c_acctbal
FROM customer
""")
def q_positive_min_fill(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return R.fill_zero_with_min_positive(c, "c_acctbal")


@register("zscore_log1p", """
SELECT p_partkey,
       round((p_retailprice - (SELECT avg(p_retailprice) FROM part))
             / (SELECT stddev_samp(p_retailprice) FROM part), 4) AS z_price,
       round(ln(1 + p_retailprice), 4) AS log_price
FROM part
""")
def q_zscore(spark, sf_dir):
    p = t(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    z = R.zscore(p, "p_retailprice", "z")
    return z.select("p_partkey", F.round("z", 4).alias("z_price"),
                    F.round(F.log1p("p_retailprice"), 4).alias("log_price"))


@register("regression_error", """
WITH j AS (SELECT d.lang, CAST(l.quality AS DOUBLE) AS y FROM labels l
           JOIN documents d ON l.doc_id = d.doc_id),
m AS (SELECT avg(CAST(quality AS DOUBLE)) AS mu FROM labels)
SELECT lang, count(*) AS n, round(sqrt(avg((y - mu) * (y - mu))), 4) AS rmse,
       round(avg(abs(y - mu)), 4) AS mae
FROM j, m GROUP BY lang
""")
def q_regression_error(spark, sf_dir):
    lab = t(spark, sf_dir, "labels")
    mu = lab.select(F.avg(F.col("quality").cast("double"))).scalar()
    j = lab.join(t(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").select(
        "lang", F.col("quality").cast("double").alias("y"), mu.alias("yhat"))
    e = R.regression_error(j, "y", "yhat", by=["lang"])
    return e.select("lang", "n", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"))


@register("row_count_gate", """
SELECT (SELECT count(*) FROM orders) AS source_rows,
       (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS target_rows,
       (SELECT count(*) FROM orders) <> (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS changed
""")
def q_row_count_gate(spark, sf_dir):
    return R.same_row_count(t(spark, sf_dir, "orders"),
                            t(spark, sf_dir, "lineitem").select("l_orderkey").distinct())


# ---------------------------------------------------------------------------
# Set operations and splits
# ---------------------------------------------------------------------------
@register("set_difference", """
SELECT p_brand AS brand, p_size AS quantity FROM part
EXCEPT SELECT p_brand, CAST(l_quantity AS INTEGER) FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_returnflag = 'R' AND l_tax = 0 AND l_discount = 0
""")
def q_set_difference(spark, sf_dir):
    """Brands and sizes of parts never returned in that quantity at the plain price."""
    part = t(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").cast("int").alias("quantity"))
    back = t(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' AND l_tax = 0 AND l_discount = 0")
    sold = back.select("l_partkey", F.col("l_quantity").cast("int").alias("quantity")).join(
        part.select("p_partkey", "brand"), F.col("l_partkey") == F.col("p_partkey")).select("brand", "quantity")
    return R.set_difference(part.select("brand", "quantity"), sold)


@register("distinct_union", """
SELECT s_nationkey AS nationkey FROM supplier UNION SELECT c_nationkey FROM customer
""")
def q_distinct_union(spark, sf_dir):
    return R.union_distinct(
        t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey")),
        t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey")))


@register("hash_split", """
SELECT p_partkey, CASE WHEN CAST('0x' || substr(sha256(CAST(p_partkey AS VARCHAR) || ':42'), 1, 7) AS BIGINT) % 10000 / 10000.0 < 0.85
            THEN 'train' ELSE 'test' END AS split
FROM part
""")
def q_hash_split(spark, sf_dir):
    return R.split_keys(t(spark, sf_dir, "part").select("p_partkey"), "p_partkey",
                        {"train": 0.85, "test": 0.15})


@register("position_split", """
WITH k AS (SELECT p_name, row_number() OVER (ORDER BY p_name) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT p_name FROM part))
SELECT p_partkey, p_name, CASE WHEN place <= round(n * 0.75) THEN 'train' WHEN place <= round(n * 0.9) THEN 'test' ELSE 'rest' END AS split
FROM part JOIN k USING (p_name)
""")
def q_position_split(spark, sf_dir):
    return R.split_positions(t(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", {"train": 75, "test": 15, "rest": 10})


# ---------------------------------------------------------------------------
# Scalar functions, contracts, paths
# ---------------------------------------------------------------------------
@register("json_extract", f"SELECT event_id, {_K_SQL} AS k FROM events")
def q_json_extract(spark, sf_dir):
    return t(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@register("numeric_hash", """
SELECT doc_id, right(regexp_replace(sha256(CAST(doc_id AS VARCHAR)), '[^0-9]', '', 'g'), 12) AS hash_id
FROM documents
""")
def q_numeric_hash(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", numeric_hash("doc_id").alias("hash_id"))


EVENTS_CONTRACT = {"name": "events_text",
                   "columns": [{"name": "event_id", "type": "INTEGER"},
                               {"name": "user_id", "type": "INTEGER"},
                               {"name": "value", "type": "DECIMAL"},
                               {"name": "event_type", "type": "STRING"}],
                   "projection": ["event_id", "user_id", "value", "event_type"]}


_WHOLE = "^[+-]?[0-9]+(\\.0*)?$"


def _int_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '{_WHOLE}') THEN TRY_CAST(regexp_replace(trim({c}), '\\.0*$', '') AS BIGINT) END"


@register("cast_contract", f"""
WITH r AS (SELECT CASE event_id % 4 WHEN 0 THEN CAST(9007199254740993 + event_id AS VARCHAR)
                  WHEN 1 THEN CAST(event_id AS VARCHAR) || '.0' WHEN 2 THEN CAST(event_id AS VARCHAR) || '.7'
                  ELSE ' ' || CAST(event_id AS VARCHAR) END AS e, CAST(user_id AS VARCHAR) AS u,
                  CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS v,
                  event_type FROM events)
SELECT {_int_sql('e')} AS event_id, {_int_sql('u')} AS user_id,
       TRY_CAST(trim(v) AS DOUBLE) AS value, event_type,
       CAST((CASE WHEN trim(e) <> '' AND {_int_sql('e')} IS NULL THEN 1 ELSE 0 END)
          + (CASE WHEN trim(u) <> '' AND {_int_sql('u')} IS NULL THEN 1 ELSE 0 END)
          + (CASE WHEN trim(v) <> '' AND TRY_CAST(trim(v) AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS _bad_cells
FROM r
""")
def q_cast_contract(spark, sf_dir):
    ev, e = t(spark, sf_dir, "events"), F.col("event_id").cast("string")
    text = (F.when(F.col("event_id") % 4 == 0, (F.col("event_id") + F.lit(9007199254740993)).cast("string"))
            .when(F.col("event_id") % 4 == 1, F.concat(e, F.lit(".0")))
            .when(F.col("event_id") % 4 == 2, F.concat(e, F.lit(".7"))).otherwise(F.concat(F.lit(" "), e)))
    raw = ev.select(text.alias("event_id"), F.col("user_id").cast("string").alias("user_id"),
                    F.when(F.col("event_type") == "error", F.lit("n/a"))
                    .otherwise(F.col("value").cast("string")).alias("value"), "event_type")
    return K.cast_row(raw, EVENTS_CONTRACT)


_URL = r"^https?://([^/]+)/([^/]+)/(.+)$"


@register("run_path_parse", f"""
SELECT page_id, NULLIF(regexp_extract(url, '{_URL}', 1), '') AS bucket,
       NULLIF(regexp_extract(url, '{_URL}', 2), '') AS run_id,
       NULLIF(regexp_extract(url, '{_URL}', 3), '') AS file,
       NULLIF(regexp_extract(url, '{_URL}', 1), '') IS NULL AS path_error
FROM pages
""")
def q_run_path_parse(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", "url")
    return IO.parse_run_path(p, "url", _URL).drop("url")


@register("file_ids", """
WITH n AS (SELECT page_id, string_split(url, '/')[-1] AS file_name FROM pages),
s AS (SELECT *, regexp_replace(regexp_replace(file_name, '\\.[^.]*$', ''), '^manifest_', '') AS file_stem
      FROM n)
SELECT page_id, file_name, file_stem, replace(file_stem, '_', '-') AS file_id,
       replace(file_stem, '_', '-') || '-dataset-' || CAST(page_id AS VARCHAR) AS dataset_id
FROM s
""")
def q_file_ids(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return IO.with_file_ids(p, "path", "page_id").drop("path")
