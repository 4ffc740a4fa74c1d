"""Registered queries for the composite class jobs (force flow, water
locations, classes IIIP / IV / VI / IX, the class union, its roll-up and the
run comparison).

Each query derives the job's input layout from the shared test tables with
plain Spark expressions, then calls the job unchanged. The oracle SQL spells
out the same derivation and the job's arithmetic in one statement. Row-wise
arithmetic is evaluated in the same order on both sides (bit-identical
doubles); sums are taken over whole cents so no summation order matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermaster.functions.scalar import cents, from_cents
from quartermaster.operators import relational as R
from quartermaster.plans import classes as X
from quartermaster.session import ensure_checkpoint_dir
from quartermaster.plans.table_queries import (
    ORACLE_SQL, PERIOD_SQL, QUERIES, RATION_SQL, _d, _qtr_pos, _QTR_POS, part_lines, ration_requirements, register,
    status_runs, t,
)

__all__ = ["QUERIES", "ORACLE_SQL"]


def _niin(c: str):
    """Part key as a 9-character NIIN with leading zeros."""
    return F.lpad(F.col(c).cast("string"), 9, "0")


def _niin_sql(c: str) -> str:
    return f"lpad(CAST({c} AS VARCHAR), 9, '0')"


def written_periods(runs: DataFrame, params: DataFrame) -> DataFrame:
    """The period table, written once (reliable checkpoint) for the joins that share it."""
    ensure_checkpoint_dir(runs.sparkSession)
    return X.period_table(runs, params).checkpoint()


def _dos_period(c: str):
    qtr = F.quarter(c)
    return (F.when(qtr == 1, "DOS1").when(qtr == 2, "DOS2").when(qtr == 3, "DOS3")
            .otherwise("BEYOND"))


def _dos_sql(c: str) -> str:
    return f"CASE quarter({c}) WHEN 1 THEN 'DOS1' WHEN 2 THEN 'DOS2' WHEN 3 THEN 'DOS3' ELSE 'BEYOND' END"


def _days_since(c: str):
    return F.datediff(F.to_date(c), F.lit("1995-01-01").cast("date")).cast("bigint")


def _days_sql(c: str) -> str:
    return f"CAST(date_diff('day', DATE '1995-01-01', CAST({c} AS DATE)) AS BIGINT)"


# ---------------------------------------------------------------------------
# X2 force flow: pax flow rows per customer order, run table per order status
# ---------------------------------------------------------------------------
def pax_flow(spark, sf_dir) -> DataFrame:
    """Pax-location rows (force-flow input layout) from orders x customer:
    the run is the order status, the day is days since 1995-01-01 and the
    inflow is the order value in thousands (floored)."""
    o = t(spark, sf_dir, "orders")
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(
        F.col("o_orderstatus").alias("AssessmentNumber"), F.lit("I").alias("Class_of_Supply"),
        F.col("o_custkey").cast("string").alias("UIC"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("Flowin"),
        F.col("o_orderkey").alias("Cumflow"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Location_Name"),
        F.col("c_nationkey").cast("bigint").alias("Location_ID"),
        F.col("c_mktsegment").alias("Region"),
        F.concat_ws("_", "c_mktsegment", "o_orderpriority").alias("Region_MEF_Lead"),
        F.col("o_orderpriority").alias("MEF"), F.lit("USMC").alias("Service"),
        F.lit("GCE").alias("MSE"), _days_since("o_orderdate").alias("Day"),
        F.lit("FP1").alias("Feed_Plan_ID"),
        F.lit(3).cast("bigint").alias("MEALS_READY_TO_EAT_MRE"),
        F.lit(1).cast("bigint").alias("UGR_H_S_BREAKFAST"),
        F.lit(1).cast("bigint").alias("UGR_H_S_LUNCH_DINNER"),
        F.lit(0).cast("bigint").alias("UGR_M_BREAKFAST"),
        F.lit(0).cast("bigint").alias("UGR_M_LUNCH_DINNER"),
        _dos_period("o_orderdate").alias("DOS_Period"))


_PAX_SQL = f"""
pax AS (
  SELECT o.o_orderstatus AS AssessmentNumber, 'I' AS Class_of_Supply, CAST(o.o_custkey AS VARCHAR) AS UIC,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS Flowin, o.o_orderkey AS Cumflow,
         'NATION_' || CAST(c.c_nationkey AS VARCHAR) AS Location_Name,
         CAST(c.c_nationkey AS BIGINT) AS Location_ID, c.c_mktsegment AS Region,
         c.c_mktsegment || '_' || o.o_orderpriority AS Region_MEF_Lead, o.o_orderpriority AS MEF,
         'USMC' AS Service, 'GCE' AS MSE, {_days_sql('o.o_orderdate')} AS Day, 'FP1' AS Feed_Plan_ID,
         CAST(3 AS BIGINT) AS MEALS_READY_TO_EAT_MRE, CAST(1 AS BIGINT) AS UGR_H_S_BREAKFAST,
         CAST(1 AS BIGINT) AS UGR_H_S_LUNCH_DINNER, CAST(0 AS BIGINT) AS UGR_M_BREAKFAST,
         CAST(0 AS BIGINT) AS UGR_M_LUNCH_DINNER, {_dos_sql('o.o_orderdate')} AS DOS_Period
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


@register("force_flow", PERIOD_SQL + "," + _PAX_SQL + """,
runs AS (SELECT o_orderstatus AS AssessmentNumber, d AS OperationDuration FROM s),
j AS (SELECT pax.*, runs.OperationDuration, p.POS, p.DOS, p.Period, p.Sort_Index
      FROM pax LEFT JOIN runs ON pax.AssessmentNumber = runs.AssessmentNumber
      LEFT JOIN p ON pax.AssessmentNumber = p.AssessmentNumber AND pax.DOS_Period = p.DOS),
dd AS (SELECT AssessmentNumber, Day, CAST(sum(Flowin) AS BIGINT) AS daily_Inflow FROM j
       WHERE AssessmentNumber IS NOT NULL AND Day IS NOT NULL GROUP BY AssessmentNumber, Day),
w AS (SELECT *, CAST(sum(daily_Inflow) OVER (PARTITION BY AssessmentNumber ORDER BY Day
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS Cumulative_Daily_Inflow
      FROM dd)
SELECT j.AssessmentNumber, Class_of_Supply, UIC, Flowin, Cumflow, Location_Name, Location_ID, Region,
       Region_MEF_Lead, MEF, Service, MSE, j.Day, Feed_Plan_ID, MEALS_READY_TO_EAT_MRE,
       UGR_H_S_BREAKFAST, UGR_H_S_LUNCH_DINNER, UGR_M_BREAKFAST, UGR_M_LUNCH_DINNER, DOS_Period,
       upper(POS) AS POS, DOS, Period, Sort_Index, OperationDuration, w.daily_Inflow,
       w.Cumulative_Daily_Inflow
FROM j LEFT JOIN w ON j.AssessmentNumber = w.AssessmentNumber AND j.Day = w.Day
""")
def q_force_flow(spark, sf_dir):
    runs, params = status_runs(spark, sf_dir)
    periods = written_periods(runs, params)
    return X.force_flow(pax_flow(spark, sf_dir), runs, periods)


# ---------------------------------------------------------------------------
# X3 water pax locations joined to the period table
# ---------------------------------------------------------------------------
def water_pax(spark, sf_dir) -> DataFrame:
    """Water pax-location rows with the raw header spellings the job renames."""
    li = t(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linestatus").alias("AssessmentNumber"),
        F.concat(F.lit("LOC_"), F.col("l_suppkey").cast("string")).alias("Location_Name"),
        _days_since("l_shipdate").alias("Day"),
        F.col("l_quantity").cast("bigint").alias("Flowin"),
        F.col("l_quantity").alias("Potable_rqmt"),
        (F.col("l_quantity") * 2).alias("Non-potable_rqmt"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("Drinking_rqmt"),
        F.col("l_discount").alias("V7"),
        _dos_period("l_shipdate").alias("DOS_Period"))


@register("water_location_joined", PERIOD_SQL + f""",
wp AS (SELECT l_linestatus AS AssessmentNumber, 'LOC_' || CAST(l_suppkey AS VARCHAR) AS Location_Name,
              {_days_sql('l_shipdate')} AS Day, CAST(l_quantity AS BIGINT) AS Flowin,
              l_quantity AS Potable_Rqmt, l_quantity * 2 AS NonPotable_Rqmt,
              CASE WHEN l_returnflag = 'R' THEN l_quantity END AS Drinking_Rqmt,
              {_dos_sql('l_shipdate')} AS DOS_Period FROM lineitem),
wt AS (SELECT *,
         CAST(coalesce(sum(Flowin) OVER (PARTITION BY AssessmentNumber, Day), 0) AS BIGINT) AS daily_Inflow,
         coalesce(sum(Potable_Rqmt) OVER (PARTITION BY AssessmentNumber, Day), 0) AS daily_Potable_Rqmt,
         coalesce(sum(NonPotable_Rqmt) OVER (PARTITION BY AssessmentNumber, Day), 0) AS daily_NonPotable_Rqmt,
         coalesce(sum(Drinking_Rqmt) OVER (PARTITION BY AssessmentNumber, Day), 0) AS daily_Drinking_Rqmt
       FROM wp)
SELECT wt.*, daily_Potable_Rqmt + daily_NonPotable_Rqmt AS daily_Total_Potable_NonPotable_Rqmt,
       p.POS, p.DOS, p.Period, p.Sort_Index
FROM wt LEFT JOIN p ON wt.AssessmentNumber = p.AssessmentNumber AND wt.DOS_Period = p.DOS
""")
def q_water_location_joined(spark, sf_dir):
    runs, params = status_runs(spark, sf_dir)
    periods = X.period_table(runs, params)
    return X.water_location_joined(water_pax(spark, sf_dir), periods)


# ---------------------------------------------------------------------------
# X8 class IIIP (packaged fuel) from lineitem x part
# ---------------------------------------------------------------------------
def pol_requirements(spark, sf_dir, lines=None) -> DataFrame:
    j = part_lines(spark, sf_dir) if lines is None else lines
    size = F.col("p_size").cast("double")
    return j.select(
        F.col("l_orderkey").alias("AssessmentNumber"), F.lit("IIIP").alias("Class_of_Supply"),
        F.col("p_brand").alias("TAMCN"), F.lit("NSN").alias("NSN"), _qtr_pos().alias("POS"),
        F.col("l_linestatus").alias("MEF"),
        F.concat(F.lit("LOC_"), F.col("l_suppkey").cast("string")).alias("LOCATION_NAME"),
        F.col("l_returnflag").alias("REGION"), F.col("p_type").alias("POL_Type"),
        F.col("p_brand").alias("POL_Pkg_Type"), F.col("l_quantity").alias("Qty"),
        F.col("p_name").alias("POL_PKG_NSN"), _niin("l_partkey").alias("NIIN"),
        F.col("p_name").alias("NOMENCLATURE"), F.col("p_retailprice").alias("STANDARD UNIT PRICE"),
        F.lit(1).alias("CEC"), F.lit("S").alias("SOS"),
        F.when(F.col("p_size") > 45, F.lit(0.0)).otherwise(size / 100).alias("IND STON"),
        (size * 2).alias("IND SQFT_LW"), (size * 0.5).alias("IND CUFT"),
        (size / 1000).alias("IND TEUs_Cube"), (size / 20).alias("IND SQFT_Cube"))


@register("class_iiip", f"""
WITH e AS (
  SELECT l.l_orderkey AS AssessmentNumber, 'IIIP' AS Class_of_Supply, {_QTR_POS} AS POS,
         l.l_linestatus AS Region_MEF_Lead, 'LOC_' || CAST(l.l_suppkey AS VARCHAR) AS Location_Name,
         l.l_returnflag AS Region, p.p_type AS COS_Type, p.p_brand AS UI, l.l_quantity AS Qty,
         p.p_name AS POL_PKG_NSN, {_niin_sql('l.l_partkey')} AS NIIN, p.p_name AS NOMENCLATURE,
         p.p_retailprice AS Unit_Price,
         CASE WHEN p.p_size > 45 THEN CAST(0.0 AS DOUBLE) ELSE CAST(p.p_size AS DOUBLE) / 100 END AS ston_,
         CAST(p.p_size AS DOUBLE) * {_d(0.5)} AS cuft_, CAST(p.p_size AS DOUBLE) / 1000 AS teu_,
         CAST(p.p_size AS DOUBLE) / 20 AS sqft_
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT AssessmentNumber AS ASSESSMENTNUMBER, Class_of_Supply AS CLASS_OF_SUPPLY, Region AS REGION,
       Location_Name AS LOCATION_NAME, Region_MEF_Lead AS REGION_MEF_LEAD, COS_Type AS COS_TYPE, POS,
       UI, Qty AS QTY, POL_PKG_NSN, NIIN, NOMENCLATURE, Unit_Price AS UNIT_PRICE, ston_ AS STON_,
       sqft_ AS SQFT_, cuft_ AS CUFT_, teu_ AS TEU_, Qty * cuft_ AS CUFT, Qty * sqft_ AS SQFT,
       Qty * teu_ AS TEUS, (Qty * ston_) / 2000 AS WEIGHT_LBS, Qty * ston_ AS STONS,
       Unit_Price * Qty AS TOTAL_COST
FROM e WHERE Qty * ston_ > 0
""")
def q_class_iiip(spark, sf_dir, lines=None):
    return X.class_iiip(pol_requirements(spark, sf_dir, lines))


# ---------------------------------------------------------------------------
# X9 class IV (construction material) from lineitem x part
# ---------------------------------------------------------------------------
def construction_requirements(spark, sf_dir, lines=None) -> DataFrame:
    j = part_lines(spark, sf_dir) if lines is None else lines
    qty = F.col("l_quantity").cast("bigint")
    return j.select(
        F.col("l_orderkey").alias("AssessmentNumber"), F.lit("IV").alias("Class_of_Supply"),
        F.concat(F.lit("LOC_"), F.col("l_suppkey").cast("string")).alias("Location_Name"),
        _niin("l_partkey").alias("NIIN"), F.col("p_name").alias("Nomenclature"),
        F.lit("EA").alias("UI"), F.col("p_retailprice").alias("Price"),
        (F.col("p_size") / 4).alias("Volume"), (F.col("p_size") * 2.5).alias("Weight"),
        qty.alias("UOI_QTY"), (qty * F.col("p_retailprice")).alias("Total_Price"),
        F.when(F.col("l_returnflag") == "N", F.lit(0).cast("bigint"))
        .otherwise(qty * F.col("p_size")).alias("Total_Weight_LB"),
        (qty * (F.col("p_size") / 4)).alias("Total_Volume_CuFt"),
        F.col("l_linestatus").alias("Region"), F.col("l_returnflag").alias("Region_MEF_Lead"),
        _qtr_pos().alias("POS"))


@register("class_iv", f"""
WITH e AS (
  SELECT l.l_orderkey AS AssessmentNumber, 'IV' AS Class_of_Supply,
         'LOC_' || CAST(l.l_suppkey AS VARCHAR) AS Location_Name, {_niin_sql('l.l_partkey')} AS COS_Type,
         p.p_name AS Nomenclature, 'EA' AS UI, p.p_retailprice AS Unit_Price, p.p_size / 4 AS volume,
         p.p_size * {_d(2.5)} AS weight, CAST(l.l_quantity AS BIGINT) AS Qty,
         CAST(l.l_quantity AS BIGINT) * p.p_retailprice AS Total_Cost,
         CASE WHEN l.l_returnflag = 'N' THEN CAST(0 AS BIGINT)
              ELSE CAST(l.l_quantity AS BIGINT) * p.p_size END AS Weight_lbs,
         CAST(l.l_quantity AS BIGINT) * (p.p_size / 4) AS CUFT,
         l.l_linestatus AS Region, l.l_returnflag AS Region_MEF_Lead, {_QTR_POS} AS POS
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT AssessmentNumber AS ASSESSMENTNUMBER, Class_of_Supply AS CLASS_OF_SUPPLY, Region AS REGION,
       Location_Name AS LOCATION_NAME, Region_MEF_Lead AS REGION_MEF_LEAD, COS_Type AS COS_TYPE,
       Nomenclature AS NOMENCLATURE, UI, Unit_Price AS UNIT_PRICE, volume AS VOLUME, weight AS WEIGHT,
       POS, Qty AS QTY, CUFT, CAST(0 AS BIGINT) AS TEUS, Weight_lbs AS WEIGHT_LBS,
       Weight_lbs / 2000 AS STONS, Total_Cost AS TOTAL_COST
FROM e WHERE Weight_lbs / 2000 > 0
""")
def q_class_iv(spark, sf_dir, lines=None):
    return X.class_iv(construction_requirements(spark, sf_dir, lines))


# ---------------------------------------------------------------------------
# X10 class VI (comfort packs) from orders x customer, first non-null by order key
# ---------------------------------------------------------------------------
VI_NIIN_BY_STATUS = {"F": "013689154", "O": "13689155", "P": "14877488"}
VI_METRICS = ["", "_Pallet_Qty", "_Pallet_Tot_CuFT", "_Pallet_Tot_Wt(lbs)", "_Pallet_Tot_TEUs",
              "_Pallet_Tot_FEUs"]


def comfort_pack_requirements(spark, sf_dir) -> DataFrame:
    """Class VI pallet requirement (wide, DOS-labelled) from orders x
    customer: one row per order, quantity in its order quarter only; rows
    repeat per (run, segment, nation, priority, NIIN), so the first
    non-null value by order key decides each cell."""
    o = t(spark, sf_dir, "orders")
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    niin = None
    for k, v in VI_NIIN_BY_STATUS.items():
        cond = F.col("o_orderstatus") == k
        niin = F.when(cond, F.lit(v)) if niin is None else niin.when(cond, F.lit(v))
    cols = [F.year("o_orderdate").cast("string").alias("AssessmentNumber"),
            F.lit("VI").alias("Class_of_Supply"), F.col("c_mktsegment").alias("Region"),
            F.col("c_nationkey").cast("string").alias("Location_ID"),
            F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Location_Name"),
            F.col("o_orderpriority").alias("HCP_Type"), niin.alias("NIIN"),
            F.concat_ws("_", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("Region_MEF_Lead"),
            F.col("o_orderkey").alias("row_id")]
    qtr = F.quarter("o_orderdate")
    for k in (1, 2, 3):
        qty = F.when(qtr == k, F.floor(F.col("o_totalprice") / 1000)).cast("double")
        pallets = F.ceil(qty / 20).cast("double")
        wt = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(0.0)).otherwise(pallets * 500)
        vals = [qty, pallets, pallets * 40.5, wt, pallets / 16, pallets / 32]
        for suffix, v in zip(VI_METRICS, vals):
            cols.append(v.alias(f"DOS{k}_Units_NIIN_Qty{suffix}"))
    return j.select(cols)


def _vi_sql() -> str:
    niin = " ".join(f"WHEN o.o_orderstatus = '{k}' THEN '{v}'" for k, v in VI_NIIN_BY_STATUS.items())
    vals = []
    for k in (1, 2, 3):
        qty = f"CAST(CASE WHEN quarter(o.o_orderdate) = {k} THEN floor(o.o_totalprice / 1000) END AS DOUBLE)"
        pal = f"CAST(ceil({qty} / 20) AS DOUBLE)"
        wt = f"CASE WHEN o.o_orderpriority = '5-LOW' THEN CAST(0.0 AS DOUBLE) ELSE {pal} * 500 END"
        exprs = [qty, pal, f"{pal} * {_d(40.5)}", wt, f"{pal} / 16", f"{pal} / 32"]
        for suffix, e in zip(VI_METRICS, exprs):
            vals.append((f"DOS{k}_Units_NIIN_Qty{suffix}", e))
    sel = ",\n         ".join(f'{e} AS "{n}"' for n, e in vals)
    names = ", ".join(f'"{n}"' for n, _ in vals)
    metric = ("regexp_replace(Metric, '^(DOS\\d_Units_NIIN_|POS\\d_Units_NIIN_|POS\\d_Units_|Pallet_|POS\\d_)', '')")
    cost = " ".join(f"WHEN NIIN IN ('{c[0]}', '{c[1]}') THEN Qty * {_d(r)}"
                    for c, r in X.FIXED["class_vi_cost"])
    keys = ("AssessmentNumber, Class_of_Supply, Region, Location_ID, Location_Name, Region_MEF_Lead, "
            "POS, HCP_Type, NIIN")
    piv = ",\n         ".join(
        f"arg_min(Value, row_id) FILTER (WHERE Metric_Type = '{m}') AS \"{m}\""
        for m in ["Qty", "Qty_Pallet_Qty", "Qty_Pallet_Tot_CuFT", "Qty_Pallet_Tot_Wt(lbs)",
                  "Qty_Pallet_Tot_TEUs"])
    return f"""
WITH w AS (
  SELECT CAST(year(o.o_orderdate) AS VARCHAR) AS AssessmentNumber, 'VI' AS Class_of_Supply,
         c.c_mktsegment AS Region, CAST(c.c_nationkey AS VARCHAR) AS Location_ID,
         'NATION_' || CAST(c.c_nationkey AS VARCHAR) AS Location_Name, o.o_orderpriority AS HCP_Type,
         CASE {niin} END AS NIIN, c.c_mktsegment || '_' || CAST(c.c_nationkey AS VARCHAR) AS Region_MEF_Lead,
         o.o_orderkey AS row_id,
         {sel}
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
m AS (SELECT * FROM w UNPIVOT INCLUDE NULLS (Value FOR Metric IN ({names}))),
l AS (SELECT *, regexp_extract(Metric, '(POS\\d|DOS\\d)', 1) AS POS, {metric} AS Metric_Type FROM m
      WHERE Value IS NOT NULL),
pv AS (
  SELECT {keys},
         {piv}
  FROM l GROUP BY {keys})
SELECT AssessmentNumber AS ASSESSMENTNUMBER, Class_of_Supply AS CLASS_OF_SUPPLY, Region AS REGION,
       Location_ID AS LOCATION_ID, Location_Name AS LOCATION_NAME, Region_MEF_Lead AS REGION_MEF_LEAD,
       HCP_Type AS COS_TYPE, POS, 'Box' AS UI, "Qty" AS QTY, "Qty_Pallet_Qty" AS PALLETS,
       "Qty_Pallet_Tot_CuFT" AS CUFT, "Qty_Pallet_Tot_TEUs" AS TEUS, "Qty_Pallet_Tot_Wt(lbs)" AS WEIGHT_LBS,
       CASE {cost} ELSE CAST(0.0 AS DOUBLE) END AS TOTAL_COST
FROM pv WHERE "Qty_Pallet_Tot_Wt(lbs)" > 0
"""


@register("class_vi", _vi_sql())
def q_class_vi(spark, sf_dir):
    return X.class_vi(comfort_pack_requirements(spark, sf_dir), row_id="row_id")


# ---------------------------------------------------------------------------
# X11 / X23 class IX (repair parts) from lineitem, catalog dimensions from part
# ---------------------------------------------------------------------------
IX_BASES = ["TAMCN_NIIN_QTY", "Required", "Value"]
CATALOG_MEASURES = ["DSS_WEIGHT", "DSS_CUBE"]


def repair_requirements(spark, sf_dir, by=("NIIN",), lines=None) -> DataFrame:
    """Class IX requirement rows (trimmed input layout) from lineitem: one
    row per line, the part as NIIN, quantities by period from the line
    quantity, money from the extended price, inch dimensions with 0 / 9999
    sentinels from quantity and line number. Lines are dealt out by the columns
    of their part that the job joins by, before the wide rows are made from them
    (``lines``: dealt out already, and kept with the catalog columns that they have)."""
    key = {"NIIN": _niin("l_partkey"), "Nomenclature": F.concat(F.lit("PART_"), F.col("l_partkey").cast("string"))}
    li = t(spark, sf_dir, "lineitem").repartition(*[key[c] for c in by]) if lines is None else lines
    qty = F.col("l_quantity").cast("bigint")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    ln = F.col("l_linenumber").cast("double")
    cols = [F.year("l_shipdate").cast("string").alias("AssessmentNumber"),
            F.lit("IX").alias("Class_of_Supply"), F.col("l_returnflag").alias("Region"),
            F.col("l_linestatus").alias("MEF"), F.col("l_linenumber").cast("string").alias("FIE"),
            F.concat(F.lit("LOC_"), F.col("l_suppkey").cast("string")).alias("Location Name"),
            F.when(F.col("l_discount") >= 0.05, F.lit("True")).otherwise(F.lit("false")).alias("SECREP Flag"),
            F.when(F.col("l_tax") > 0.06, F.lit("TRUE")).otherwise(F.lit("False")).alias("Battery Flag"),
            F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("TAMCN_NIIN"),
            F.concat(F.lit("E"), F.col("l_suppkey").cast("string")).alias("TAMCN_of_End_Item"),
            F.col("l_orderkey").cast("string").alias("NIIN_of_End_Item"),
            F.concat(F.lit("ITEM_"), F.col("l_linenumber").cast("string")).alias("COLLOQUIAL_NAME"),
            qty.alias("TAMCN_NIIN_QTY_FIE")]
    for i, p in enumerate(X.PERIODS):
        cols.append((qty * (i + 1)).alias(f"TAMCN_NIIN_QTY_{p}"))
    cols += [F.concat(F.lit("FSC"), F.col("l_linenumber").cast("string")).alias("FSC of Part Required"),
             _niin("l_partkey").alias("NIIN of Part Required"),
             F.concat(F.lit("PART_"), F.col("l_partkey").cast("string")).alias("Nomenclature of Part Required"),
             F.lit("EA").alias("UNIT_OF_ISSUE"), price.alias("STANDARD UNIT PRICE"),
             qty.alias("Required_FIE")]
    for i, p in enumerate(X.PERIODS):
        cols.append((qty + i).alias(f"Required_{p}"))
    cols.append(F.col("l_extendedprice").alias("Value_FIE"))
    for i, p in enumerate(X.PERIODS):
        cols.append((F.col("l_extendedprice") * (i + 1)).alias(f"Value_{p}"))
    cols += [(F.col("l_extendedprice") * 4).alias("Total_Value_Less_FIE"),
             (F.col("l_extendedprice") * 5).alias("Total_Value_Selected_Confidence"),
             F.when(ln > 6, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("DIM LENGTH INCHES"),
             F.when(ln == 1, F.lit(9999.0)).otherwise(ln * 3).alias("DIM WIDTH INCHES"),
             (F.col("l_quantity") + 2).alias("DIM HEIGHT INCHES")]
    return li.select(*cols, *[c for c in CATALOG_MEASURES if c in li.columns])


def catalog_dimensions(spark, sf_dir) -> DataFrame:
    """Catalog dimensions per part (NIIN, nomenclature, price, weight,
    cube): PROMO parts are missing from the catalog; parts larger than 45
    appear twice and the earlier row (``row_id``) is the one kept."""
    p = t(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    size = F.col("p_size").cast("double")
    base = [_niin("p_partkey").alias("NIIN"),
            F.concat(F.lit("PART_"), F.col("p_partkey").cast("string")).alias("NOMENCLATURE"),
            F.col("p_retailprice").alias("UNIT_PRICE"), F.lit("EA").alias("UI")]
    first = p.select(*base, (size / 4).alias("DSS_WEIGHT"),
                     F.when(F.col("p_size") < 5, F.lit(0.0)).otherwise(size / 10).alias("DSS_CUBE"),
                     (F.col("p_partkey") * 2).alias("row_id"))
    second = p.filter(F.col("p_size") > 45).select(
        *base, (size * 4).alias("DSS_WEIGHT"), (size * 10).alias("DSS_CUBE"),
        (F.col("p_partkey") * 2 + 1).alias("row_id"))
    return first.unionByName(second)


_REQ_COLS_SQL = """
  SELECT CAST(year(l_shipdate) AS VARCHAR) AS AssessmentNumber, 'IX' AS Class_of_Supply,
         l_returnflag AS Region, l_linestatus AS MEF, CAST(l_linenumber AS VARCHAR) AS FIE,
         'LOC_' || CAST(l_suppkey AS VARCHAR) AS Location_Name,
         CASE WHEN l_discount >= 0.05 THEN 'True' ELSE 'false' END AS secrep,
         CASE WHEN l_tax > 0.06 THEN 'TRUE' ELSE 'False' END AS battery,
         'T' || CAST(l_partkey AS VARCHAR) AS TAMCN_NIIN, 'E' || CAST(l_suppkey AS VARCHAR) AS TAMCN_of_End_Item,
         CAST(l_orderkey AS VARCHAR) AS NIIN_of_End_Item,
         'ITEM_' || CAST(l_linenumber AS VARCHAR) AS Colloquial_Name,
         CAST(l_quantity AS BIGINT) AS TAMCN_NIIN_QTY_FIE,
         CAST(l_quantity AS BIGINT) * 1 AS TAMCN_NIIN_QTY_POS1, CAST(l_quantity AS BIGINT) * 2 AS TAMCN_NIIN_QTY_POS2,
         CAST(l_quantity AS BIGINT) * 3 AS TAMCN_NIIN_QTY_POS3, CAST(l_quantity AS BIGINT) * 4 AS TAMCN_NIIN_QTY_BEYOND,
         'FSC' || CAST(l_linenumber AS VARCHAR) AS "FSC of Part Required",
         lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS NIIN, 'PART_' || CAST(l_partkey AS VARCHAR) AS Nomenclature,
         'EA' AS UI, l_extendedprice / l_quantity AS Unit_Price, CAST(l_quantity AS BIGINT) AS Required_FIE,
         CAST(l_quantity AS BIGINT) + 0 AS Required_POS1, CAST(l_quantity AS BIGINT) + 1 AS Required_POS2,
         CAST(l_quantity AS BIGINT) + 2 AS Required_POS3, CAST(l_quantity AS BIGINT) + 3 AS Required_BEYOND,
         l_extendedprice AS Value_FIE, l_extendedprice * 1 AS Value_POS1, l_extendedprice * 2 AS Value_POS2,
         l_extendedprice * 3 AS Value_POS3, l_extendedprice * 4 AS Value_BEYOND,
         l_extendedprice * 4 AS Total_Value_Less_FIE, l_extendedprice * 5 AS Total_Value_Selected_Confidence,
         CASE WHEN CAST(l_linenumber AS DOUBLE) > 6 THEN CAST(0.0 AS DOUBLE) ELSE l_quantity END AS L,
         CASE WHEN CAST(l_linenumber AS DOUBLE) = 1 THEN CAST(9999.0 AS DOUBLE)
              ELSE CAST(l_linenumber AS DOUBLE) * 3 END AS W,
         l_quantity + 2 AS H
  FROM lineitem"""

_DIMS_SQL = """
  SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS NIIN, 'PART_' || CAST(p_partkey AS VARCHAR) AS NOMENCLATURE,
         p_retailprice AS UNIT_PRICE, 'EA' AS UI, CAST(p_size AS DOUBLE) / 4 AS DSS_WEIGHT,
         CASE WHEN p_size < 5 THEN CAST(0.0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / 10 END AS DSS_CUBE,
         p_partkey * 2 AS row_id
  FROM part WHERE p_type <> 'PROMO'
  UNION ALL
  SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 'PART_' || CAST(p_partkey AS VARCHAR), p_retailprice, 'EA',
         CAST(p_size AS DOUBLE) * 4, CAST(p_size AS DOUBLE) * 10, p_partkey * 2 + 1
  FROM part WHERE p_type <> 'PROMO' AND p_size > 45"""

_CUBE_SQL = ("CASE WHEN L IN (0, 9999) OR W IN (0, 9999) OR H IN (0, 9999) THEN DSS_CUBE "
             "WHEN DSS_CUBE IS NULL THEN NULL ELSE greatest((L / 12) * (W / 12) * (H / 12), DSS_CUBE) END")
_SQFT_SQL = "CASE WHEN L IN (0, 9999) OR W IN (0, 9999) THEN CAST(0.0 AS DOUBLE) ELSE (L / 12) * (W / 12) END"


@register("class_ix", f"""
WITH r AS ({_REQ_COLS_SQL}),
d0 AS ({_DIMS_SQL}),
d AS (SELECT NIIN, DSS_WEIGHT, CASE WHEN DSS_CUBE = 0.0 THEN {_d(0.01)} ELSE DSS_CUBE END AS DSS_CUBE
      FROM (SELECT *, row_number() OVER (PARTITION BY NIIN, NOMENCLATURE ORDER BY row_id) AS rn FROM d0)
      WHERE rn = 1),
j AS (SELECT CASE WHEN upper(battery) = 'TRUE' THEN 'IX C (B)' WHEN upper(secrep) = 'TRUE' THEN 'IX C (S)'
                  ELSE 'IX C' END AS cls, r.*, d.DSS_WEIGHT, d.DSS_CUBE
      FROM r JOIN d ON r.NIIN = d.NIIN),
m AS (SELECT * FROM j UNPIVOT INCLUDE NULLS (Requirement FOR variable IN (
        TAMCN_NIIN_QTY_POS1, TAMCN_NIIN_QTY_POS2, TAMCN_NIIN_QTY_POS3, TAMCN_NIIN_QTY_BEYOND,
        Required_POS1, Required_POS2, Required_POS3, Required_BEYOND,
        Value_POS1, Value_POS2, Value_POS3, Value_BEYOND))),
c AS (SELECT *, regexp_extract(variable, '(.+?)_(POS[0-9]+|BEYOND)', 1) AS Feature,
             regexp_extract(variable, '(.+?)_(POS[0-9]+|BEYOND)', 2) AS POS,
             {_CUBE_SQL} AS CUFT, {_SQFT_SQL} AS SQFT FROM m)
SELECT AssessmentNumber AS ASSESSMENTNUMBER, cls AS CLASS_OF_SUPPLY, Region AS REGION, MEF, FIE,
       Location_Name AS LOCATION_NAME, TAMCN_NIIN, TAMCN_of_End_Item AS TAMCN_OF_END_ITEM,
       NIIN_of_End_Item AS NIIN_OF_END_ITEM, Colloquial_Name AS COLLOQUIAL_NAME, TAMCN_NIIN_QTY_FIE,
       "FSC of Part Required" AS "FSC OF PART REQUIRED", NIIN, Nomenclature AS NOMENCLATURE, UI,
       Unit_Price AS UNIT_PRICE, L AS "DIM LENGTH INCHES", W AS "DIM WIDTH INCHES", H AS "DIM HEIGHT INCHES",
       DSS_WEIGHT, DSS_CUBE, Feature AS FEATURE, Required_FIE AS REQUIRED_FIE,
       CUFT * Required_FIE AS FIE_CUFT, SQFT * Required_FIE AS FIE_SQFT,
       DSS_WEIGHT * Required_FIE AS FIE_WEIGHT_LBS, Value_FIE AS COST_FIE, POS, Requirement AS REQUIREMENT,
       CUFT, SQFT, DSS_WEIGHT * Requirement AS WEIGHT_LBS, Total_Value_Less_FIE AS TOTAL_COST_LESS_FIE,
       Total_Value_Selected_Confidence AS TOTAL_COST
FROM c
""")
def q_class_ix(spark, sf_dir, lines=None):
    req = repair_requirements(spark, sf_dir, lines=lines)
    joined = set(CATALOG_MEASURES) <= set(req.columns)
    return X.class_ix(req, None if joined else catalog_dimensions(spark, sf_dir), dims_row_id="row_id")


@register("class_ix_long", f"""
WITH r AS ({_REQ_COLS_SQL}),
d0 AS ({_DIMS_SQL}),
d AS (SELECT NIIN, NOMENCLATURE, DSS_WEIGHT, DSS_CUBE
      FROM (SELECT *, row_number() OVER (PARTITION BY NIIN, NOMENCLATURE ORDER BY row_id) AS rn FROM d0)
      WHERE rn = 1),
j AS (SELECT r.*, d.DSS_WEIGHT, d.DSS_CUBE,
             CASE WHEN battery = 'TRUE' THEN 'IX B' WHEN secrep = 'TRUE' THEN 'IX S' ELSE 'IX C' END AS cls
      FROM r LEFT JOIN d ON r.NIIN = d.NIIN AND r.Nomenclature = d.NOMENCLATURE),
m AS (""" + " UNION ALL ".join(
    f"SELECT *, '{p}' AS POS, Required_{p} AS Required FROM j" for p in X.PERIODS) + f""")
SELECT cls AS Class_of_Supply, Region, Location_Name, MEF, UI, Unit_Price, TAMCN_of_End_Item,
       Colloquial_Name AS "Colloquial Name", NIIN, Nomenclature,
       DSS_CUBE * Required_FIE AS FIE_CUFT, DSS_WEIGHT * Required_FIE AS FIE_Weight_lbs, POS,
       DSS_CUBE * Required AS POS_CUFT, ({_SQFT_SQL}) * Required AS POS_SQFT,
       DSS_WEIGHT * Required AS POS_Weight_lbs
FROM m
""")
def q_class_ix_long(spark, sf_dir):
    return X.class_ix_long(repair_requirements(spark, sf_dir, ("NIIN", "Nomenclature")), catalog_dimensions(spark, sf_dir),
                           dims_row_id="row_id")


# ---------------------------------------------------------------------------
# X18 / X19 / X25 class union, roll-up and run comparison
# ---------------------------------------------------------------------------
UNION_PARTS = ["class_i", "pallet_calc", "unit_extension", "class_iiip", "class_iv", "class_vi",
               "class_ix"]
# those made from lines and the columns of their part
PART_CLASSES = ["class_i", "unit_extension", "class_iiip", "class_iv"]


# what the union needs of a line (no order, a date without its time), and the roll-up: no class label, which class IX reads
# from discount and tax. Whole numbers come after decimals and text comes first: varying bytes that meet compress better
UNION_LINE = ["l_returnflag", "l_linestatus", "l_shipdate", "l_partkey", "l_extendedprice", "l_suppkey", "l_discount",
              "l_linenumber", "l_tax", "l_quantity"]
ROLLUP_LINE = [c for c in UNION_LINE if c not in ("l_discount", "l_tax")]


def _carrying(df: DataFrame, full: DataFrame) -> DataFrame:
    """``df`` with the columns of ``full`` that it does not carry as NULLs (for class columns that the union drops)."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in full.schema if f.name not in df.columns})


def _alike_first(df: DataFrame, *cols: str) -> DataFrame:
    """Each task's rows with equal values of ``cols`` together: they compress better in the shuffle that follows."""
    return df.sortWithinPartitions(F.xxhash64(*cols))


def union_lines(spark, sf_dir, columns=UNION_LINE) -> tuple[DataFrame, DataFrame]:
    """The lines, dealt out by part key once for all classes, and the same with the columns of their part."""
    li, part = t(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate")), t(spark, sf_dir, "part")
    niin, p_niin = _niin("l_partkey"), _niin("p_partkey")
    lines = li.filter(F.col("l_partkey").isNotNull() & niin.isNotNull()).select(columns)
    lines = _alike_first(lines, "l_returnflag", "l_linestatus", "l_linenumber").repartition(niin)
    lines = _carrying(R.shared_shuffle(lines, ["l_partkey"]), li)
    return lines, _with_part(lines, part, niin, p_niin)


def _with_part(lines: DataFrame, part: DataFrame, niin, p_niin, how: str = "inner") -> DataFrame:
    """Lines with their part's columns. Joined by NIIN as class IX, so that parts go where the lines are; the key itself is
    compared, as Spark would deal the lines out anew by a second join key. One row a part: hashed in the task."""
    same = F.col("l_partkey").between(F.col("p_partkey"), F.col("p_partkey"))
    return lines.join(part.hint("shuffle_hash"), (niin == p_niin) & same, how)


# what the roll-up needs of a line with its part and its catalog row
LOCATED_LINE = ["l_returnflag", "l_linestatus", "p_type", "PART_NR", "CATALOG_NR", "p_retailprice", "l_suppkey", "l_extendedprice",
                "l_linenumber", "DSS_CUBE", "l_shipdate", "DSS_WEIGHT", "p_size", "l_quantity"]


def located_lines(spark, sf_dir) -> dict[str, DataFrame]:
    """The lines of each class for the roll-up, those of a location (a supplier) in one task, so that they are summed
    there. They travel once more for that, with what their part and their catalog row give them; class IX makes its 12
    rows of each there. Rows of a part key, and catalog rows of a NIIN, are numbered: should there be several, a class
    has a line once for each of its own side's."""
    lines = union_lines(spark, sf_dir, ROLLUP_LINE)[0].withColumn("NIIN", _niin("l_partkey"))
    part = t(spark, sf_dir, "part").withColumn("P_NIIN", _niin("p_partkey")).repartition("P_NIIN")
    part = part.withColumn("PART_NR", F.row_number().over(Window.partitionBy("P_NIIN", "p_partkey").orderBy("p_partkey")))
    dims = catalog_dimensions(spark, sf_dir)
    dims = dims.withColumn("CATALOG_NR", F.dense_rank().over(Window.partitionBy("NIIN").orderBy("NOMENCLATURE")))
    j = X.class_ix_catalog(_with_part(lines, part, F.col("NIIN"), F.col("P_NIIN"), "left"), dims, mode="corrected", dims_row_id="row_id")
    j = j.filter(F.col("PART_NR").isNotNull() | F.col("CATALOG_NR").isNotNull())
    # the location's name as the union has it: Spark sees that its groups are in one task
    location = F.coalesce(F.concat(F.lit("LOC_"), F.col("l_suppkey").cast("string")), F.lit("0"))
    there = _alike_first(j.select(LOCATED_LINE), "l_returnflag", "l_linestatus", "p_type", "CATALOG_NR").repartition(location)
    there = _carrying(R.shared_shuffle(there, ["l_suppkey"]), j)
    of_part = there.filter(F.col("PART_NR").isNotNull() & (F.coalesce("CATALOG_NR", F.lit(1)) == 1))
    of_catalog = there.filter(F.col("CATALOG_NR").isNotNull() & (F.coalesce("PART_NR", F.lit(1)) == 1))
    # class I has lines of known suppliers only; kept apart, as its filter would make a shuffle of its own
    return {n: of_part for n in PART_CLASSES} | {"class_i": R.shared_shuffle(of_part), "class_ix": of_catalog}


def class_outputs(spark, sf_dir, located: bool = False) -> list[DataFrame]:
    if located:
        given = located_lines(spark, sf_dir)
    else:
        lines, of_part = union_lines(spark, sf_dir)
        given = {n: of_part for n in PART_CLASSES} | {"class_ix": lines}
    return [QUERIES[n](spark, sf_dir, given[n]) if n in given else QUERIES[n](spark, sf_dir) for n in UNION_PARTS]


def _union_sql(lead: bool = False) -> str:
    parts = []
    for n in UNION_PARTS:
        sql = ORACLE_SQL[n]
        sel = [f"coalesce(CAST({'REGION_MEF_LEAD' if n not in _NO_LEAD else 'NULL'} AS VARCHAR), '0') AS REGION_MEF_LEAD"] if lead else []
        for c in X.UNION_COLUMNS:
            has = _has_output(n, c)
            if c in X.UNION_MEASURES:
                sel.append(f"coalesce(CAST({c if has else 0} AS DOUBLE), 0) AS {c}")
            else:
                sel.append(f"coalesce(CAST({c} AS VARCHAR), '0') AS {c}")
        parts.append(f"SELECT {', '.join(sel)} FROM ({sql}) AS {n}_out")
    return "\nUNION ALL\n".join(parts)


# class outputs without a lead
_NO_LEAD = {"class_ix"}
# measures each class output does not produce (they become 0 in the union)
_ABSENT = {"class_i": {"SQFT"}, "pallet_calc": {"SQFT"}, "class_iv": {"SQFT"}, "class_vi": {"SQFT"},
           "class_ix": {"TEUS"}}


def _has_output(name: str, col: str) -> bool:
    return col not in _ABSENT.get(name, set())


@register("aggregated_embark", _union_sql())
def q_aggregated_embark(spark, sf_dir):
    return X.aggregated_classes(class_outputs(spark, sf_dir))


_ROLLUP_DIMS = ["REGION", "LOCATION_NAME", "REGION_MEF_LEAD", "POS"]


@register("embark_rollup", "WITH u AS (" + _union_sql(lead=True) + ")\nSELECT " + ", ".join(_ROLLUP_DIMS) + ", " + ", ".join(
    f"CAST(sum(CAST(round({m} * 100) AS BIGINT)) AS DOUBLE) / 100 AS {m}" for m in X.UNION_MEASURES)
    + f", CAST(count(*) AS BIGINT) AS N_ROWS, CAST(GROUPING({', '.join(_ROLLUP_DIMS)}) AS BIGINT) AS grouping_level"
    + f"\nFROM u GROUP BY ROLLUP ({', '.join(_ROLLUP_DIMS)})")
def q_embark_rollup(spark, sf_dir):
    outputs = class_outputs(spark, sf_dir, located=True)
    return X.class_rollup([X.aggregated_classes([o], keep=["REGION_MEF_LEAD"]) for o in outputs], _ROLLUP_DIMS)


BASE_RUN = 1995


@register("compare_runs", "WITH c AS (" + RATION_SQL + "),\ns AS (SELECT CLASS_OF_SUPPLY, REGION, POS, ASSESSMENTNUMBER, "
          "CAST(sum(CAST(round(TOTAL_COST * 100) AS BIGINT)) AS BIGINT) AS tc FROM c GROUP BY ALL)\n"
          f"""SELECT s.CLASS_OF_SUPPLY, s.REGION, s.POS, s.ASSESSMENTNUMBER, s.tc, b.tc AS base_tc,
       coalesce(s.tc, 0) - coalesce(b.tc, 0) AS diff_tc
FROM s LEFT JOIN s b ON b.ASSESSMENTNUMBER = {BASE_RUN} AND s.CLASS_OF_SUPPLY IS NOT DISTINCT FROM b.CLASS_OF_SUPPLY
     AND s.REGION IS NOT DISTINCT FROM b.REGION AND s.POS IS NOT DISTINCT FROM b.POS""")
def q_compare_runs(spark, sf_dir):
    c = X.class_i(ration_requirements(spark, sf_dir)).withColumn("tc", cents("TOTAL_COST"))
    return X.compare_runs(c, "ASSESSMENTNUMBER", BASE_RUN, measure="tc")


#: Factors of the days of supply, by scenario and period.
SCENARIOS = [("base", None, None), ("short", "POS1", 0.5), ("short", "POS2", 0.25), ("long", "POS3", 2.0), ("long", "BEYOND", 4.0)]


@register("what_if_class_i", "WITH c AS (" + RATION_SQL + f"),\nscenarios AS (SELECT * FROM (VALUES {', '.join(f"('{s}', '{p or 'none'}', {f or 1.0})" for s, p, f in SCENARIOS)}) AS v(scenario, period, factor)),\n"
          """x AS (SELECT c.*, n.scenario, coalesce(f.factor, 1) AS factor FROM c CROSS JOIN (SELECT DISTINCT scenario FROM scenarios) n
      LEFT JOIN scenarios f ON f.scenario = n.scenario AND f.period = c.POS),
s AS (SELECT CLASS_OF_SUPPLY, REGION, POS, CAST(ASSESSMENTNUMBER AS VARCHAR) AS ASSESSMENTNUMBER, scenario,
             CAST(sum(CAST(round(TOTAL_COST * factor * 100) AS BIGINT)) AS BIGINT) AS tc FROM x GROUP BY ALL)
SELECT s.*, b.tc AS base_tc, coalesce(s.tc, 0) - coalesce(b.tc, 0) AS diff_tc
FROM s LEFT JOIN s b ON b.scenario = 'base' AND s.CLASS_OF_SUPPLY IS NOT DISTINCT FROM b.CLASS_OF_SUPPLY AND s.REGION IS NOT DISTINCT FROM b.REGION
     AND s.POS IS NOT DISTINCT FROM b.POS AND s.ASSESSMENTNUMBER IS NOT DISTINCT FROM b.ASSESSMENTNUMBER""")
def q_what_if_class_i(spark, sf_dir):
    """Class I under three scenarios of the days of supply, against the base."""
    from quartermaster.plans import whatif as W
    scenarios = spark.createDataFrame(SCENARIOS, "scenario string, parameter string, factor double")
    out = W.what_if(ration_requirements(spark, sf_dir), scenarios, X.class_i).withColumn("tc", cents("TOTAL_COST"))
    return W.compare_scenarios(out, "base", ["CLASS_OF_SUPPLY", "REGION", "POS", "ASSESSMENTNUMBER"], "tc")


# ---------------------------------------------------------------------------
# X5b class I, notebook form, over the ration table (first value by run year)
# ---------------------------------------------------------------------------
def _ext_sql() -> str:
    from quartermaster.plans.table_queries import CUFT_PER_PALLET, LBS_PER_UNIT, UNITS_PER_PALLET, _sql_case
    j_w = RATION_SQL.split("p AS (")[0].rstrip().rstrip(",")
    ugr = ", ".join(f"'{u}'" for u in X.FIXED["ugr_types"])
    mre = "'MEALS_READY_TO_EAT_MRE'"
    wt4 = " ".join(f"WHEN COS_Type = '{k}' THEN p4 * {_d(lbs)} * {_d(f)}"
                   for k, (lbs, f) in X.BEYOND_WEIGHT.items())
    per = []
    for k in (1, 2, 3):
        per.append(f"SELECT *, 'POS{k}' AS POS, u{k} AS Units, p{k} AS m_qty, p{k} * {_d(CUFT_PER_PALLET)} AS m_cuft, "
                   f"p{k} / 16 AS m_teus, u{k} * {_d(LBS_PER_UNIT)} AS m_wt FROM x")
    per.append(f"SELECT *, 'BEYOND' AS POS, u4 AS Units, p4 AS m_qty, "
               f"CASE WHEN COS_Type = {mre} THEN p4 * {_d(X.BEYOND_CUFT['MEALS_READY_TO_EAT_MRE'])} "
               f"WHEN COS_Type IN ({ugr}) THEN p4 * {_d(X.BEYOND_CUFT['UGR'])} END AS m_cuft, "
               f"CASE WHEN COS_Type = {mre} OR COS_Type IN ({ugr}) THEN p4 / 16 END AS m_teus, "
               f"CASE {wt4} END AS m_wt FROM x")
    idx = "Class_of_Supply, Region, Location_Name, Region_MEF_Lead, POS, COS_Type, Type"
    firsts = ", ".join(f"arg_min({m}, AssessmentNumber) FILTER (WHERE {m} IS NOT NULL) AS f_{m}"
                       for m in ["Units", "m_qty", "m_cuft", "m_teus", "m_wt"])
    return j_w + f""",
x AS (SELECT AssessmentNumber, Class_of_Supply, Ration_Type AS COS_Type, Region, Region_MEF_Lead, Location_Name,
             CASE WHEN Ration_Type = {mre} THEN 'Box' ELSE 'Module' END AS Type, u1, u2, u3, u4,
             CAST(CAST(ceil(u1 / {UNITS_PER_PALLET}) AS BIGINT) AS DOUBLE) AS p1,
             CAST(CAST(ceil(u2 / {UNITS_PER_PALLET}) AS BIGINT) AS DOUBLE) AS p2,
             CAST(CAST(ceil(u3 / {UNITS_PER_PALLET}) AS BIGINT) AS DOUBLE) AS p3,
             CASE WHEN Ration_Type = {mre} THEN u4 / 48 WHEN Ration_Type IN ({ugr}) THEN u4 / 8 END AS p4
      FROM w),
l AS ({" UNION ALL ".join(per)}),
pv AS (SELECT {idx}, {firsts} FROM l GROUP BY {idx}
       HAVING count(Units) + count(m_qty) + count(m_cuft) + count(m_teus) + count(m_wt) > 0),
f AS (SELECT Class_of_Supply, Region, Location_Name, Region_MEF_Lead, COS_Type, POS, Type AS UI,
             coalesce(f_Units, 0) AS Qty, coalesce(f_m_teus, 0) AS Pallets, coalesce(f_m_qty, 0) AS CUFT,
             CAST(0.0 AS DOUBLE) AS SQFT, coalesce(f_m_wt, 0) AS Weight_lbs,
             coalesce(f_Units * {_sql_case('COS_Type', X.FIXED['ration_cost'], 'CAST(0.0 AS DOUBLE)')}, 0) AS Cost
      FROM pv)
SELECT Class_of_Supply, Region, Location_Name, Region_MEF_Lead, COS_Type, POS, UI, Qty, Pallets, CUFT, SQFT,
       Weight_lbs / 1024 AS TEUS, Weight_lbs, Weight_lbs / 2000 + ((Weight_lbs / 1024) * 5000) / 2000 AS STONS, Cost
FROM f WHERE Weight_lbs / 2000 + ((Weight_lbs / 1024) * 5000) / 2000 > 0
"""


@register("class_i_extended", _ext_sql())
def q_class_i_extended(spark, sf_dir):
    return X.class_i_extended(ration_requirements(spark, sf_dir), row_id="AssessmentNumber")


# ---------------------------------------------------------------------------
# X4 ration tables joined to the period table (three inputs, one join each)
# ---------------------------------------------------------------------------
def ration_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Water ration costs (line items), class I pax locations and class I
    ration costs (orders x customer), each keyed by run and DOS period."""
    li = t(spark, sf_dir, "lineitem")
    o = t(spark, sf_dir, "orders")
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    oc = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    water = li.select(F.col("l_linestatus").alias("AssessmentNumber"),
                      F.col("l_suppkey").alias("Location_ID"), F.lit("WATER").alias("Ration_Type"),
                      F.col("l_quantity").alias("UI_Count"), _dos_period("l_shipdate").alias("DOS_Period"))
    locations = oc.select(F.col("o_orderstatus").alias("AssessmentNumber"),
                          F.col("c_nationkey").cast("bigint").alias("Location_ID"),
                          F.floor(F.col("o_totalprice") / 1000).cast("double").alias("MEALS_READY_TO_EAT_MRE"),
                          _dos_period("o_orderdate").alias("DOS_Period"))
    costs = oc.select(F.col("o_orderstatus").alias("AssessmentNumber"),
                      F.col("c_nationkey").cast("bigint").alias("Location_ID"),
                      F.col("o_orderpriority").alias("Ration_Type"),
                      (F.col("o_totalprice") / 100).alias("Total_UI_Cost"),
                      _dos_period("o_orderdate").alias("DOS_Period"))
    return {"RD_IW_Ration_Costs": water, "RD_I_POS_Location": locations, "RD_I_Ration_Costs": costs}


_RJ_MEASURE = {"RD_IW_Ration_Costs": "UI_Count", "RD_I_POS_Location": "MEALS_READY_TO_EAT_MRE",
               "RD_I_Ration_Costs": "Total_UI_Cost"}


@register("ration_joins", PERIOD_SQL + f""",
w AS (SELECT l_linestatus AS AssessmentNumber, l_suppkey AS Location_ID, l_quantity AS v,
             {_dos_sql('l_shipdate')} AS DOS_Period FROM lineitem),
oc AS (SELECT o.o_orderstatus AS AssessmentNumber, CAST(c.c_nationkey AS BIGINT) AS Location_ID,
              o.o_totalprice, o.o_orderdate FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
loc AS (SELECT AssessmentNumber, Location_ID, CAST(floor(o_totalprice / 1000) AS DOUBLE) AS v,
               {_dos_sql('o_orderdate')} AS DOS_Period FROM oc),
cost AS (SELECT AssessmentNumber, Location_ID, o_totalprice / 100 AS v,
                {_dos_sql('o_orderdate')} AS DOS_Period FROM oc),
u AS (SELECT 'RD_IW_Ration_Costs' AS table_name, * FROM w
      UNION ALL SELECT 'RD_I_POS_Location', * FROM loc
      UNION ALL SELECT 'RD_I_Ration_Costs', * FROM cost)
SELECT u.table_name, u.AssessmentNumber, u.Location_ID, u.DOS_Period, u.v AS measure,
       p.POS, p.DOS, p.Period, p.Sort_Index
FROM u LEFT JOIN p ON u.AssessmentNumber = p.AssessmentNumber AND u.DOS_Period = p.DOS
""")
def q_ration_joins(spark, sf_dir):
    runs, params = status_runs(spark, sf_dir)
    joined = X.ration_joins(ration_tables(spark, sf_dir), written_periods(runs, params))
    parts = [df.select(F.lit(name).alias("table_name"), "AssessmentNumber", "Location_ID", "DOS_Period",
                       F.col(_RJ_MEASURE[name]).alias("measure"), "POS", "DOS", "Period", "Sort_Index")
             for name, df in joined.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
