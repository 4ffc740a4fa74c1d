"""Per-class requirement jobs, period table, force flow and the class union.

Every job takes DataFrames whose columns follow the source contracts (see
FIXTURES.md) and returns one DataFrame. ``mode='reference'`` reproduces the
published arithmetic including its known slips; ``mode='corrected'`` fixes
them (each difference is named where it applies).

Fixed values that must equal the source system's: unit costs, pallet
divisors and pack factors (``FIXED`` below), and next to their jobs the column
lists, rename maps and name patterns in capitals (``FORCE_FLOW_*``,
``WATER_*``, ``II_VII_COLUMNS``, ``IIIP_*``, ``IV_*``, ``VI_*``, ``IX_*``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.functions.nulls import extract_or_null
from quartermaster.functions.scalar import cents, cube_feet, from_cents, lookup, square_feet, text_bool
from quartermaster.operators import columns as C
from quartermaster.operators import relational as R
from quartermaster.operators import reshape as S
from quartermaster.operators.columns import q

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's; stated as given there)
# ---------------------------------------------------------------------------
FIXED = {
    # class I: ration type -> unit cost (anything else costs 0)
    "ration_cost": {
        "MEALS_READY_TO_EAT_MRE": 119.03,
        "UGR_H_S_BREAKFAST": 403.90,
        "UGR_H_S_LUNCH_DINNER": 364.91,
        "UGR_M_BREAKFAST": 273.33,
        "UGR_M_LUNCH_DINNER": 273.33,
    },
    # class I: units per pallet beyond the planned periods
    "mre_units_per_pallet": 48,
    "ugr_units_per_pallet": 8,
    "ugr_types": ["UGR_H_S_BREAKFAST", "UGR_H_S_LUNCH_DINNER", "UGR_M_BREAKFAST",
                  "UGR_M_LUNCH_DINNER"],
    # class I water: drinking water pallets, volume, weight, TEU and cost
    "water_units_per_pallet": 50,
    "water_pallet_factor": 1 + 0.02 * 0.04,
    "water_cuft_per_pallet": 56.11,
    "water_lbs_per_pallet": 1700,
    "water_pallets_per_teu": 16,
    "water_teu_factor": 1 + 0.063,
    "water_cost_per_unit": 3.05,
    # class VI: NIIN (with and without leading zero) -> unit cost
    "class_vi_cost": [(("13689154", "013689154"), 240.58),
                      (("13689155", "013689155"), 50.95),
                      (("14877488", "014877488"), 68.38)],
    # short ton
    "lbs_per_ston": 2000,
    # class IX: cube used when the catalog says 0
    "min_cube": 0.01,
    # dimension sentinels meaning "unknown"
    "sentinels": (0, 9999),
}

PERIODS = ["POS1", "POS2", "POS3", "BEYOND"]
INPUT_PERIODS = ["DOS1", "DOS2", "DOS3", "BEYOND"]


def _upper_all(df: DataFrame) -> DataFrame:
    return C.upper_columns(df)


# ---------------------------------------------------------------------------
# X1 period table
# ---------------------------------------------------------------------------
def period_table(runs: DataFrame, params: DataFrame, first_only: bool = False) -> DataFrame:
    """Run table + parameter table -> 4 rows (POS, DOS, Period, Sort_Index) per run.

    Inner join on AssessmentNumber = AssessmentID (different names, both
    kept). The source job keeps the first joined row only; here every run
    gets its periods and ``first_only`` keeps the smallest run id.
    """
    j = R.join_on(runs, params, "AssessmentNumber", "AssessmentID", "inner")
    rows = []
    for i, (pos, dos, src) in enumerate(zip(PERIODS, INPUT_PERIODS,
                                            ["DaysOfSupplyFirst", "DaysOfSupplySecond",
                                             "DaysOfSupplyThird", "OperationDuration"])):
        rows.append({"POS": F.lit(pos), "DOS": F.lit(dos),
                     "Period": q(src).cast("bigint"), "Sort_Index": F.lit(i + 1).cast("bigint")})
    out = S.stack_periods(j, ["AssessmentNumber"], rows)
    if first_only:
        first = out.select(F.min("AssessmentNumber").alias("m"))
        out = out.join(first, out["AssessmentNumber"] == first["m"], "left_semi")
    return out


# ---------------------------------------------------------------------------
# X2 force flow
# ---------------------------------------------------------------------------
FORCE_FLOW_RETAIN = [
    "AssessmentNumber", "Class_of_Supply", "Location_Name", "Location_ID", "Region_MEF_Lead",
    "Feed_Plan_ID", "MEALS_READY_TO_EAT_MRE", "UGR_H_S_BREAKFAST", "UGR_H_S_LUNCH_DINNER",
    "UGR_M_BREAKFAST", "UGR_M_LUNCH_DINNER", "DOS_Period", "Sort_Index", "OperationDuration",
    "Ration_Type", "Ration_Cost", "UI_Count", "UI_Cost", "CAP_Name", "CAP_Names",
    "Total_UI_Cost"]

FORCE_FLOW_COLUMNS = [
    "AssessmentNumber", "Class_of_Supply", "UIC", "Flowin", "Cumflow", "Location_Name",
    "Location_ID", "Region", "Region_MEF_Lead", "MEF", "Service", "MSE", "Day", "Feed_Plan_ID",
    "MEALS_READY_TO_EAT_MRE", "UGR_H_S_BREAKFAST", "UGR_H_S_LUNCH_DINNER", "UGR_M_BREAKFAST",
    "UGR_M_LUNCH_DINNER", "DOS_Period", "POS", "DOS", "Period", "Sort_Index",
    "OperationDuration"]


def _period_join(df: DataFrame, periods: DataFrame) -> DataFrame:
    """Left join on the period label; per run when both sides carry the run
    id. Detail without the run id must not meet the periods of several runs."""
    # No hint: the period table is tiny in practice but not bounded by
    # construction; AQE broadcasts it from its measured size.
    if "AssessmentNumber" in periods.columns and "AssessmentNumber" in df.columns:
        p = periods.withColumnRenamed("AssessmentNumber", "__run")
        j = df.join(p, (df["AssessmentNumber"] == p["__run"])
                    & (df["DOS_Period"] == p["DOS"]), "left")
        return j.drop("__run")
    if "AssessmentNumber" in periods.columns:
        periods = _keys_once(periods, ["DOS"])
    return R.join_on(df, periods, "DOS_Period", "DOS", "left")


def force_flow(pax: DataFrame, runs: DataFrame, periods: DataFrame,
               retain: Sequence[str] = FORCE_FLOW_RETAIN, per_run: bool = True) -> DataFrame:
    """Pax flow rows + run table + periods -> 27 columns with daily inflow
    and its running total joined back on Day."""
    pax = C.normalize_columns(pax, retain=retain)
    runs = C.normalize_columns(runs, retain=retain)
    periods = C.normalize_columns(periods, retain=retain)
    j = pax.join(runs, "AssessmentNumber", "left")
    j = _period_join(j, periods)
    j = C.project(j, FORCE_FLOW_COLUMNS).withColumn("POS", F.upper("POS"))
    part = ["AssessmentNumber"] if per_run else []
    return R.running_total(j, "Day", "Flowin", "daily_Inflow", "Cumulative_Daily_Inflow",
                           partition=part)


# ---------------------------------------------------------------------------
# X3 / X4 water locations and ration joins
# ---------------------------------------------------------------------------
WATER_RENAME = {"Potable_rqmt": "Potable_Rqmt", "Non-potable": "NonPotable",
                "Non-potable_rqmt": "NonPotable_Rqmt", "Total water": "Total_Water",
                "Total_rqmt": "Total_Rqmt", "Drinking_rqmt": "Drinking_Rqmt"}


def water_location_joined(water: DataFrame, periods: DataFrame,
                          retain: Sequence[str] = FORCE_FLOW_RETAIN) -> DataFrame:
    water = C.normalize_columns(water, retain=retain)
    periods = C.normalize_columns(periods, retain=retain)
    w = C.rename(water, WATER_RENAME)
    w = C.drop_if_present(w, ["V7", "V8", "V9"])
    keys = ["AssessmentNumber", "Day"] if "AssessmentNumber" in w.columns else ["Day"]
    w = R.partition_total(w, keys, {
        "daily_Inflow": "Flowin", "daily_Potable_Rqmt": "Potable_Rqmt",
        "daily_NonPotable_Rqmt": "NonPotable_Rqmt", "daily_Drinking_Rqmt": "Drinking_Rqmt"})
    w = R.add_columns(w, "daily_Total_Potable_NonPotable_Rqmt",
                      ["daily_Potable_Rqmt", "daily_NonPotable_Rqmt"])
    return _period_join(w, periods)


def ration_joins(tables: Mapping[str, DataFrame], periods: DataFrame,
                 retain: Sequence[str] = FORCE_FLOW_RETAIN) -> dict[str, DataFrame]:
    periods = C.normalize_columns(periods, retain=retain)
    return {name: _period_join(C.normalize_columns(t, retain=retain), periods)
            for name, t in tables.items()}


# ---------------------------------------------------------------------------
# X5 class I (rations)
# ---------------------------------------------------------------------------
CLASS_I_KEYS = ["ASSESSMENTNUMBER", "CLASS_OF_SUPPLY", "COS_TYPE", "REGION", "REGION_MEF_LEAD",
                "LOCATION_ID", "LOCATION_NAME", "UI"]
CLASS_I_METRICS = {"UNITS": "QTY", "UNITS_PALLET_QTY": "PALLETS",
                   "UNITS_PALLET_TOT_CUFT": "CUFT", "UNITS_PALLET_TOT_TEUS": "TEUS",
                   "UNITS_PALLET_TOT_WT(LBS)": "WEIGHT_LBS"}
CLASS_I_COLUMNS = CLASS_I_KEYS + ["POS", "QTY", "PALLETS", "CUFT", "TEUS", "WEIGHT_LBS",
                                  "TOTAL_COST"]


def class_i_prepare(df: DataFrame) -> DataFrame:
    """Header normalisation and the beyond-period pallet count."""
    df = C.rename_regex(df, "DOS", "POS")
    df = C.rename(df, {"BEYOND": "BEYOND_UNITS", "Unit of Issue": "UI", "Ration_Type": "COS_TYPE"})
    df = C.upper_columns(df)
    df = C.drop_if_present(df, ["CAP_NAME", "CAP_NAMES"])
    df = C.drop_matching(df, "FEUS")
    t = q("COS_TYPE")
    pallets = (F.when(t == "MEALS_READY_TO_EAT_MRE", q("BEYOND_UNITS") / FIXED["mre_units_per_pallet"])
               .when(t.isin(FIXED["ugr_types"]), q("BEYOND_UNITS") / FIXED["ugr_units_per_pallet"]))
    return df.withColumn("BEYOND_UNITS_PALLET_QTY", pallets)


def class_i(df: DataFrame, plan: str = "restack", on_duplicate: str = "error") -> DataFrame:
    """Wide pallet requirement -> one row per (location, ration type, period).

    ``plan='restack'`` turns each wide row into its 4 period rows with one
    ``inline``; a repeated key is an error found by one aggregate that hands on
    the measures (``on_duplicate='keep'`` leaves it out).
    ``plan='pivot'`` is the literal melt -> parse -> strict pivot, which
    shuffles once on the keys and fails on a duplicate key like the source.
    """
    df = class_i_prepare(df)
    if plan == "restack":
        if on_duplicate == "error":
            df = _single_rows(df, CLASS_I_KEYS, [c for c in df.columns if _match_period_metric(c)])
        long = _class_i_restack(df)
    else:
        value_cols = [c for c in df.columns if _match_period_metric(c)]
        m = S.melt(df, CLASS_I_KEYS, value_cols, "POS_METRIC", "VALUE")
        m = S.split_name(m, "POS_METRIC", r"^(BEYOND|POS[1-3])_(.*)$", ["POS", "METRIC"])
        metrics = sorted({_match_period_metric(c)[1] for c in value_cols})
        long = S.pivot_strict(m, CLASS_I_KEYS + ["POS"], "METRIC", metrics, "VALUE",
                              on_duplicate=on_duplicate)
    long = C.rename(long, CLASS_I_METRICS)
    for c in ["QTY", "PALLETS", "CUFT", "TEUS", "WEIGHT_LBS"]:
        if c not in long.columns:
            long = long.withColumn(c, F.lit(None).cast("double"))
    long = long.withColumn("TOTAL_COST", q("QTY") * lookup("COS_TYPE", FIXED["ration_cost"], 0.0))
    return C.project(long, CLASS_I_COLUMNS)


def _match_period_metric(c: str):
    m = re.match(r"^(BEYOND|POS[1-3])_(.*)$", c)
    return (m.group(1), m.group(2)) if m else None


def _keys_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, failing if a key occurs twice (a scalar subquery in a filter,
    so that no pruning removes the check)."""
    again = df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = again.agg(F.count(F.lit(1))).scalar()
    return df.filter(F.when(repeated > 0, F.raise_error(F.lit(f"repeated keys {', '.join(keys)}"))).otherwise(True))


def _single_rows(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The rows' keys and values, failing if a key occurs twice. Unlike ``_keys_once``
    the rows go through the check, so what they are made from is worked out once."""
    rows = df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"), *[F.max(q(v)).alias(v) for v in values])
    again = F.raise_error(F.lit(f"repeated keys {', '.join(keys)}"))
    return rows.filter(F.when(q("__n") > 1, again).otherwise(True)).drop("__n")


def _class_i_restack(df: DataFrame) -> DataFrame:
    cells = {}
    for c in df.columns:
        pm = _match_period_metric(c)
        if pm:
            cells[pm] = c
    metrics = []
    for (_, m) in cells:
        if m not in metrics:
            metrics.append(m)
    structs = []
    for p in PERIODS:
        if not any(pp == p for (pp, _) in cells):
            continue
        fields = [F.lit(p).alias("POS")]
        for m in metrics:
            src = cells.get((p, m))
            fields.append((q(src).cast("double") if src else F.lit(None).cast("double")).alias(m))
        structs.append(F.struct(*fields))
    return df.select(*[q(k) for k in CLASS_I_KEYS], F.inline(F.array(*structs)))


# ---------------------------------------------------------------------------
# X5b class I, notebook form (beyond-period volume/weight, TEU and short tons)
# ---------------------------------------------------------------------------
# Fixed values (must equal the source notebook's): beyond-period cubic feet
# per pallet, pounds per pallet and packing factor per ration type.
BEYOND_CUFT = {"MEALS_READY_TO_EAT_MRE": 56.10, "UGR": 47.80}
BEYOND_WEIGHT = {"MEALS_READY_TO_EAT_MRE": (1098.00, 1.02), "UGR_H_S_BREAKFAST": (933.14, 1.13),
                 "UGR_H_S_LUNCH_DINNER": (1060.43, 1.13), "UGR_M_BREAKFAST": (800.00, 1.13),
                 "UGR_M_LUNCH_DINNER": (800.00, 1.13)}
EXT_INDEX = ["Class_of_Supply", "Region", "Location_Name", "Region_MEF_Lead", "POS", "COS_Type", "Type"]
EXT_METRICS = ["Qty", "Tot_CuFT", "Tot_TEUs", "Tot_Wt(lbs)", "Units"]
# the notebook names the pivoted columns by position over the sorted metric
# names, so each lands under the next metric's label (reference mode)
EXT_NAMES_REFERENCE = {"Qty": "CUFT", "Tot_CuFT": "TEUS", "Tot_TEUs": "Pallets",
                       "Tot_Wt(lbs)": "Weight_lbs", "Units": "Qty"}
EXT_NAMES_CORRECTED = {"Qty": "Pallets", "Tot_CuFT": "CUFT", "Tot_TEUs": "TEUS",
                       "Tot_Wt(lbs)": "Weight_lbs", "Units": "Qty"}
EXT_COLUMNS = ["Class_of_Supply", "Region", "Location_Name", "Region_MEF_Lead", "COS_Type", "POS",
               "UI", "Qty", "Pallets", "CUFT", "SQFT", "TEUS", "Weight_lbs", "STONS", "Cost"]


def class_i_extended(df: DataFrame, row_id: str, mode: str = "reference") -> DataFrame:
    """Notebook form of class I: beyond-period pallets, cubic feet, weight
    and TEU per ration type; long by period; first non-null value per
    (class, region, location, lead, period, ration type, pack type) in
    ``row_id`` order; cost by ration type; TEU re-derived as weight / 1024
    and short tons as weight / 2000 + TEU * 5000 / 2000; rows with short
    tons > 0. The run id and location id are not part of the index, so
    rows of several runs fold into one (first value wins), as in the source.
    """
    ren = {}
    for c in df.columns:
        n = c.replace("DOS", "POS").replace("Ration_Type", "COS_Type")
        ren[c] = "BEYOND_Units" if n == "BEYOND" else n
    df = df.select([q(c).alias(ren[c]) for c in df.columns])
    df = C.drop_matching(C.drop_if_present(df, ["CAP_Name", "CAP_Names"]), "FEUs")
    t = q("COS_Type")
    ugr = t.isin(FIXED["ugr_types"])
    mre = t == "MEALS_READY_TO_EAT_MRE"
    pallets = (F.when(mre, q("BEYOND_Units") / FIXED["mre_units_per_pallet"])
               .when(ugr, q("BEYOND_Units") / FIXED["ugr_units_per_pallet"]))
    df = df.withColumns({"Type": F.when(mre, F.lit("Box")).otherwise(F.lit("Module")),
                         "BEYOND_Units_Pallet_Qty": pallets})
    p = q("BEYOND_Units_Pallet_Qty")
    wt = None
    for k, (lbs, factor) in BEYOND_WEIGHT.items():
        e = p * lbs * factor
        wt = F.when(t == k, e) if wt is None else wt.when(t == k, e)
    df = df.withColumns({
        "BEYOND_Units_Pallet_Tot_CuFT": F.when(mre, p * BEYOND_CUFT["MEALS_READY_TO_EAT_MRE"])
        .when(ugr, p * BEYOND_CUFT["UGR"]),
        "BEYOND_Units_Pallet_Tot_Wt(lbs)": wt,
        "BEYOND_Units_Pallet_Tot_TEUs": F.when(mre | ugr, p / 16)})
    values = [c for c in df.columns if _is_ext_value(c)]
    long = S.melt(df.select(*[q(c) for c in EXT_INDEX if c != "POS"], q(row_id),
                            *[q(c).cast("double").alias(c) for c in values]),
                  [c for c in EXT_INDEX if c != "POS"] + [row_id], values, "Metric", "Value")
    long = long.withColumns({
        "POS": extract_or_null(q("Metric"), r"(POS\d|BEYOND)", 1),
        "Metric_Type": F.regexp_replace(q("Metric"), r"^(POS\d_|BEYOND_)(Units_Pallet_|Units_|)", "")})
    wide = S.pivot_first(long, EXT_INDEX, "Metric_Type", EXT_METRICS, "Value", row_id)
    names = EXT_NAMES_REFERENCE if mode == "reference" else EXT_NAMES_CORRECTED
    wide = wide.select(*[q(c).alias("UI" if c == "Type" else c) for c in EXT_INDEX],
                       *[q(m).alias(names[m]) for m in EXT_METRICS])
    wide = wide.withColumns({"Cost": q("Qty") * lookup("COS_Type", FIXED["ration_cost"], 0.0),
                             "SQFT": F.lit(0.0)})
    wide = C.fill_zero(wide)
    wide = wide.withColumn("TEUS", q("Weight_lbs") / 1024)
    wide = wide.withColumn("STONS", q("Weight_lbs") / 2000 + (q("TEUS") * 5000) / 2000)
    return C.project(C.keep_positive(C.fill_zero(wide), "STONS"), EXT_COLUMNS)


def _is_ext_value(c: str) -> bool:
    return re.match(r"^(POS[1-3]|BEYOND)_Units(_Pallet_(Qty|Tot_CuFT|Tot_Wt\(lbs\)|Tot_TEUs))?$", c) is not None


# ---------------------------------------------------------------------------
# X6 class I water
# ---------------------------------------------------------------------------
WATER_IDS = ["AssessmentNumber", "Class_of_Supply", "Region", "Location_Name", "Location_ID",
             "Region_MEF_Lead", "UIC", "POS"]
WATER_COLUMNS = ["AssessmentNumber", "Class_of_Supply", "COS_Type", "Region", "Region_MEF_Lead",
                 "Location_Name", "Location_ID", "UIC", "UI", "POS", "Qty", "Pallets", "CUFT",
                 "Weight_lbs", "TEUS", "Total_Cost"]


def class_i_water(df: DataFrame) -> DataFrame:
    """Water requirement -> long by requirement type; only drinking water is
    palletised (others get 0 and are then dropped by Weight_lbs > 0)."""
    long = S.melt(df, WATER_IDS, ["Potable_Rqmt", "NonPotable_Rqmt", "Drinking_Rqmt"],
                  "COS_Type", "Units")
    drink = q("COS_Type") == "Drinking_Rqmt"
    u = q("Units")
    pallets = u / FIXED["water_units_per_pallet"] * FIXED["water_pallet_factor"]
    long = long.withColumns({
        "Pallets": F.when(drink, pallets),
        "CUFT": F.when(drink, pallets * FIXED["water_cuft_per_pallet"]),
        "Weight_lbs": F.when(drink, pallets * FIXED["water_lbs_per_pallet"]),
        "TEUS": F.when(drink, (pallets / FIXED["water_pallets_per_teu"]) * FIXED["water_teu_factor"]),
        "Total_Cost": F.when(drink, u * FIXED["water_cost_per_unit"]),
        "UI": F.when(drink, F.lit("Case")).otherwise(F.lit("Gals")),
    })
    long = C.fill_zero(long, ["Pallets", "CUFT", "Weight_lbs", "TEUS", "Total_Cost"])
    long = C.rename(long, {"Units": "Qty"})
    out = C.keep_positive(C.project(long, WATER_COLUMNS), "Weight_lbs")
    return _upper_all(out)


# ---------------------------------------------------------------------------
# X7 class II / VII (equipment)
# ---------------------------------------------------------------------------
II_VII_COLUMNS = ["AssessmentNumber", "Class_of_Supply", "COS_Type", "Region", "Region_MEF_Lead",
                  "Location_Name", "UIC", "UI", "Unit_Price", "DIM HEIGHT INCHES",
                  "DIM LENGTH INCHES", "DIM WIDTH INCHES", "ston_", "sqft_", "cuft_", "teu_",
                  "POS", "Qty", "CUFT", "SQFT", "TEUS", "Weight_lbs", "Total_Cost"]


def _weight_from_stons(stons, mode: str):
    # reference divides short tons by 2000 (should multiply); corrected multiplies
    return stons / FIXED["lbs_per_ston"] if mode == "reference" else stons * FIXED["lbs_per_ston"]


def class_ii_vii(df: DataFrame, mode: str = "reference") -> DataFrame:
    df = df.withColumns({
        "COS_Type": F.concat(q("TAMCN").cast("string"), F.lit("_Class_II/VII")),
        "sqft_": q("IND SQFT"), "cuft_": q("IND CUFT"), "ston_": q("IND STON"),
        "teu_": q("TEU_Equivalents"), "Qty": q("TE_Orig_Qty"),
        "Unit_Price": q("STANDARD_UNIT_PRICE"), "UI": F.lit("NIIN")})
    stons = q("Qty") * q("ston_")
    df = df.withColumns({
        "STONS": stons, "Weight_lbs": _weight_from_stons(stons, mode),
        "SQFT": q("Qty") * q("sqft_"), "TEUS": q("Qty") * q("teu_"),
        "CUFT": q("Qty") * q("cuft_"), "Total_Cost": q("Unit_Price") * q("Qty")})
    out = C.keep_positive(C.project(df, II_VII_COLUMNS), "Weight_lbs")
    return _upper_all(out)


# ---------------------------------------------------------------------------
# X8 class IIIP (packaged fuel)
# ---------------------------------------------------------------------------
IIIP_RENAME = {"IND STON": "ston_", "IND CUFT": "cuft_", "IND TEUs_Cube": "teu_",
               "IND SQFT_Cube": "sqft_", "MEF": "Region_MEF_Lead", "POL_Type": "COS_Type",
               "POL_Pkg_Type": "UI", "REGION": "Region", "LOCATION_NAME": "Location_Name",
               "STANDARD UNIT PRICE": "Unit_Price"}
IIIP_COLUMNS = ["AssessmentNumber", "Class_of_Supply", "Region", "Location_Name",
                "Region_MEF_Lead", "COS_Type", "POS", "UI", "Qty", "POL_PKG_NSN", "NIIN",
                "NOMENCLATURE", "Unit_Price", "ston_", "sqft_", "cuft_", "teu_", "CUFT", "SQFT",
                "TEUS", "Weight_lbs", "STONS", "Total_Cost"]


def class_iiip(df: DataFrame, mode: str = "reference") -> DataFrame:
    df = C.drop_if_present(C.rename(df, IIIP_RENAME), ["TAMCN", "NSN", "CEC", "SOS", "IND SQFT_LW"])
    stons = q("Qty") * q("ston_")
    df = df.withColumns({
        "STONS": stons, "Weight_lbs": _weight_from_stons(stons, mode),
        "SQFT": q("Qty") * q("sqft_"), "TEUS": q("Qty") * q("teu_"),
        "CUFT": q("Qty") * q("cuft_"), "Total_Cost": q("Unit_Price") * q("Qty")})
    out = C.project(C.keep_positive(df, "STONS"), IIIP_COLUMNS)
    return _upper_all(out)


# ---------------------------------------------------------------------------
# X9 class IV (construction)
# ---------------------------------------------------------------------------
IV_RENAME = {"UOI_QTY": "Qty", "Total_Price": "Total_Cost", "Total_Weight_LB": "Weight_lbs",
             "Total_Volume_CuFt": "CUFT", "NIIN": "COS_Type", "Price": "Unit_Price",
             "Volume": "volume", "Weight": "weight"}
IV_COLUMNS = ["AssessmentNumber", "Class_of_Supply", "Region", "Location_Name", "Region_MEF_Lead",
              "COS_Type", "Nomenclature", "UI", "Unit_Price", "volume", "weight", "POS", "Qty",
              "CUFT", "TEUS", "Weight_lbs", "STONS", "Total_Cost"]


def class_iv(df: DataFrame) -> DataFrame:
    # Spark resolves names case-insensitively: 'Volume'/'Weight' become
    # 'volume'/'weight' by dropping and re-adding under the new name.
    ren = {k: v for k, v in IV_RENAME.items() if k in df.columns}
    df = df.select([q(c).alias(ren.get(c, c)) for c in df.columns])
    df = df.withColumns({"TEUS": F.lit(0).cast("bigint"),
                         "STONS": q("Weight_lbs") / FIXED["lbs_per_ston"]})
    out = C.project(C.keep_positive(df, "STONS"), IV_COLUMNS)
    return _upper_all(out)


# ---------------------------------------------------------------------------
# X10 class VI (health and comfort packs)
# ---------------------------------------------------------------------------
VI_IDS = ["AssessmentNumber", "Class_of_Supply", "Region", "Location_ID", "Location_Name",
          "HCP_Type", "NIIN", "Region_MEF_Lead"]
VI_INDEX = ["AssessmentNumber", "Class_of_Supply", "Region", "Location_ID", "Location_Name",
            "Region_MEF_Lead", "POS", "HCP_Type", "NIIN"]
VI_RENAME = {"HCP_Type": "COS_Type", "Units_NIIN_Qty": "Qty", "Qty_Pallet_Qty": "Pallets",
             "Qty_Pallet_Tot_Wt(lbs)": "Weight_lbs", "Qty_Pallet_Tot_CuFT": "CUFT",
             "Qty_Pallet_Tot_TEUs": "TEUS", "Qty_Pallet_Tot_FEUs": "FEUS"}
VI_COLUMNS = ["AssessmentNumber", "Class_of_Supply", "Region", "Location_ID", "Location_Name",
              "Region_MEF_Lead", "COS_Type", "POS", "UI", "Qty", "Pallets", "CUFT", "TEUS",
              "Weight_lbs", "Total_Cost"]
VI_METRIC_STRIP = r"^(DOS\d_Units_NIIN_|POS\d_Units_NIIN_|POS\d_Units_|Pallet_|POS\d_)"


def class_vi(df: DataFrame, row_id: str | None = None, mode: str = "reference") -> DataFrame:
    """Class VI pallet requirement -> one row per location, pack type, NIIN, period.

    Period labels stay ``DOSn`` in reference mode (they never meet the POS
    labels of the period table); ``mode='corrected'`` maps them to ``POSn``.
    The first non-null value per cell is taken in source row order
    (``row_id``, else the scan order).
    Without a row id the order is ``monotonically_increasing_id`` taken on
    the input, which stays the same when a lost task is recomputed only if
    the input is a direct file scan; pass a key column otherwise.
    """
    if row_id is None:
        df = df.withColumn("__row", F.monotonically_increasing_id())
        row_id = "__row"
    values = [c for c in df.columns if c.startswith("POS") or "NIIN_Qty" in c]
    # the names are parsed here, not in every row: a row per period, not per cell
    cells = [(c, _vi_period(c, mode), _vi_metric(c)) for c in values]
    long = S.melt_cells(df, VI_IDS + [row_id], cells, "POS")
    wide = S.pivot_first(long, VI_INDEX, None, sorted({m for _, _, m in cells}), None, row_id)
    wide = C.rename(wide, VI_RENAME)
    for c in ["Qty", "Pallets", "CUFT", "TEUS", "Weight_lbs"]:
        if c not in wide.columns:
            wide = wide.withColumn(c, F.lit(None).cast("double"))
    niin = q("NIIN").cast("string")
    cost = None
    for codes, rate in FIXED["class_vi_cost"]:
        cond = niin.isin(list(codes))
        cost = F.when(cond, q("Qty") * rate) if cost is None else cost.when(cond, q("Qty") * rate)
    wide = wide.withColumns({"UI": F.lit("Box"), "Total_Cost": cost.otherwise(F.lit(0.0))})
    out = C.project(C.keep_positive(wide, "Weight_lbs"), VI_COLUMNS)
    return _upper_all(out)


def _vi_period(c: str, mode: str) -> str | None:
    m = re.search(r"(POS\d|DOS\d)", c)
    return m and (re.sub("^DOS", "POS", m[1]) if mode == "corrected" else m[1])


def _vi_metric(c: str) -> str:
    return re.sub(VI_METRIC_STRIP, "", c)


# ---------------------------------------------------------------------------
# X11 class IX (repair parts)
# ---------------------------------------------------------------------------
IX_RENAME = {"Location Name": "Location_Name", "COLLOQUIAL_NAME": "Colloquial Name",
             "UNIT_OF_ISSUE": "UI", "STANDARD UNIT PRICE": "Unit_Price",
             "Nomenclature of Part Required": "Nomenclature", "NIIN of Part Required": "NIIN"}
IX_RENAME_OUT = {"Colloquial Name": "Colloquial_Name",
                 "Total_Value_Less_FIE": "Total_Cost_Less_FIE", "Value_FIE": "Cost_FIE",
                 "Total_Value_Selected_Confidence": "Total_Cost", "base": "Feature",
                 "UI_left": "UI"}
IX_COLUMNS = ["AssessmentNumber", "Class_of_Supply", "Region", "MEF", "FIE", "Location_Name",
              "TAMCN_NIIN", "TAMCN_of_End_Item", "NIIN_of_End_Item", "Colloquial_Name",
              "TAMCN_NIIN_QTY_FIE", "FSC of Part Required", "NIIN", "Nomenclature", "UI",
              "Unit_Price", "DIM LENGTH INCHES", "DIM WIDTH INCHES", "DIM HEIGHT INCHES",
              "DSS_WEIGHT", "DSS_CUBE", "Feature", "Required_FIE", "FIE_CUFT", "FIE_SQFT",
              "FIE_Weight_lbs", "Cost_FIE", "POS", "Requirement", "CUFT", "SQFT", "Weight_lbs",
              "Total_Cost_Less_FIE", "Total_Cost"]


def class_ix_classify(df: DataFrame) -> DataFrame:
    """Battery flag wins over the secondary-reparable flag."""
    bat, sec = text_bool(q("Battery Flag")), text_bool(q("SECREP Flag"))
    cls = (F.when(bat == F.lit(True), F.lit("IX C (B)"))
           .when(sec == F.lit(True), F.lit("IX C (S)")).otherwise(F.lit("IX C")))
    return df.withColumn("Class_of_Supply", cls).drop("SECREP Flag", "Battery Flag")


def _base_and_period(name: str) -> tuple[str | None, str | None]:
    """'Required_POS1' -> ('Required', 'POS1')."""
    m = re.search(r"(.+?)_(POS[0-9]+|BEYOND)", name)
    return (m[1], m[2]) if m else (None, None)


def class_ix_catalog(req: DataFrame, dims: DataFrame, mode: str = "reference",
                     dims_row_id: str | None = None) -> DataFrame:
    """Rows with the catalog row of their part (``NIIN``): inner join in
    reference mode (parts without dimensions disappear), left join in corrected
    mode. See ``class_ix`` for ``dims_row_id``."""
    if dims_row_id is None:
        dims = dims.withColumn("__drow", F.monotonically_increasing_id())
        dims_row_id = "__drow"
    d = C.rename(dims, {"UNIT_PRICE": "Unit_Price", "NOMENCLATURE": "Nomenclature"})
    d = R.first_per_key(d, ["NIIN", "Nomenclature"], dims_row_id).drop(dims_row_id)
    d = C.upper_columns(d)
    # pandas would keep 'Unit_Price' and 'UNIT_PRICE' apart; Spark resolves
    # names case-insensitively, so clashing dimension columns get '_right'.
    lower_req = {c.lower() for c in req.columns}
    d = d.select([q(c).alias(c) if c == "NIIN" or c.lower() not in lower_req
                  else q(c).alias(c + "_right") for c in d.columns])
    how = "inner" if mode == "reference" else "left"
    # one row a part: hashed in the task, so the requirements are not sorted
    return req.join(d.hint("shuffle_hash"), "NIIN", how)


def class_ix(req: DataFrame, dims: DataFrame | None, mode: str = "reference",
             dims_row_id: str | None = None) -> DataFrame:
    """Repair parts x part dimensions -> 12 rows per part requirement
    (3 bases x 4 periods), with volume, floor area and weight.

    reference: inner join (parts without dimensions disappear) and every
    base is unpivoted, so ``Feature`` tells quantities from money.
    corrected: left join.
    ``dims`` is None for rows that hold the columns of their catalog row
    already (``class_ix_catalog``).
    ``dims_row_id`` decides which duplicate dimension row is kept.
    Without a row id the order is ``monotonically_increasing_id`` taken on
    the input, which stays the same when a lost task is recomputed only if
    the input is a direct file scan; pass a key column otherwise.
    """
    req = class_ix_classify(C.rename(req, IX_RENAME))
    j = req if dims is None else class_ix_catalog(req, dims, mode, dims_row_id)
    j = j.withColumnRenamed("UI", "UI_left")
    # geometry and the per-end-item measures once for each part, before its 12 rows
    cube = F.when(q("DSS_CUBE") == 0.0, F.lit(FIXED["min_cube"])).otherwise(q("DSS_CUBE"))
    j = j.withColumn("DSS_CUBE", cube)
    L, W, H = q("DIM LENGTH INCHES"), q("DIM WIDTH INCHES"), q("DIM HEIGHT INCHES")
    pos_cols = [c for c in j.columns if "_POS" in c or "_BEYOND" in c]
    ids = [c for c in j.columns if c not in pos_cols]
    j = j.withColumns({"CUFT": cube_feet(L, W, H, q("DSS_CUBE"), FIXED["sentinels"]),
                       "SQFT": square_feet(L, W, FIXED["sentinels"])})
    j = j.withColumns({"FIE_CUFT": q("CUFT") * q("Required_FIE"), "FIE_SQFT": q("SQFT") * q("Required_FIE"),
                       "FIE_Weight_lbs": q("DSS_WEIGHT") * q("Required_FIE")})
    cells = [F.struct(F.lit(base).alias("base"), F.lit(pos).alias("POS"), q(c).cast("double").alias("Requirement"))
             for c in pos_cols for base, pos in [_base_and_period(c)]]
    derived = ["CUFT", "SQFT", "FIE_CUFT", "FIE_SQFT", "FIE_Weight_lbs"]
    long = j.select(*[q(c) for c in ids + [d for d in derived if d not in ids]], F.inline(F.array(*cells)))
    long = long.withColumn("Weight_lbs", q("DSS_WEIGHT") * q("Requirement"))
    long = C.rename(long, IX_RENAME_OUT)
    return _upper_all(C.project(long, IX_COLUMNS))


# ---------------------------------------------------------------------------
# X23 class IX, notebook form (two-key left join, multi-measure unpivot)
# ---------------------------------------------------------------------------
IX_LONG_COLUMNS = ["Class_of_Supply", "Region", "Location_Name", "MEF", "UI", "Unit_Price",
                   "TAMCN_of_End_Item", "Colloquial Name", "NIIN", "Nomenclature", "FIE_CUFT",
                   "FIE_Weight_lbs", "POS", "POS_CUFT", "POS_SQFT", "POS_Weight_lbs"]


def class_ix_long(req: DataFrame, dims: DataFrame, dims_row_id: str | None = None) -> DataFrame:
    """Notebook variant of class IX: flags compared as exact text 'TRUE'
    (-> 'IX B' / 'IX S' / 'IX C'), left join on (NIIN, Nomenclature) to a
    dimension table deduplicated on that pair, then one row per period with
    the three bases side by side (TAMCN_NIIN_QTY, Required, Value).

    The notebook multiplies by names that the unpivot never creates
    (``Required_POS``, ``cuft``, ``sqft``); here the period requirement is the
    unpivoted ``Required`` column, volume is the catalog cube and floor area
    comes from the part's length and width (0 for sentinel sides).
    Pass ``dims_row_id`` to fix which duplicate dimension row is kept (see
    ``class_ix``).
    """
    req = C.rename(req, {"COLLOQUIAL_NAME": "Colloquial Name", "Location Name": "Location_Name",
                         "UNIT_OF_ISSUE": "UI", "STANDARD UNIT PRICE": "Unit_Price",
                         "Nomenclature of Part Required": "Nomenclature",
                         "NIIN of Part Required": "NIIN"})
    if dims_row_id is None:
        dims = dims.withColumn("__drow", F.monotonically_increasing_id())
        dims_row_id = "__drow"
    d = C.rename(dims, {"UNIT_PRICE": "Unit_Price", "NOMENCLATURE": "Nomenclature"})
    d = R.first_per_key(d, ["NIIN", "Nomenclature"], dims_row_id).drop(dims_row_id)
    d = d.select("NIIN", "Nomenclature", "DSS_WEIGHT", "DSS_CUBE")
    j = req.join(d.hint("shuffle_hash"), ["NIIN", "Nomenclature"], "left")
    cls = (F.when(q("Battery Flag") == "TRUE", F.lit("IX B"))
           .when(q("SECREP Flag") == "TRUE", F.lit("IX S")).otherwise(F.lit("IX C")))
    j = j.withColumn("Class_of_Supply", cls)
    ids = [c for c in j.columns if not _ix_period_col(c)]
    long = S.melt_multi(j, ids, r"(.*)_(POS[0-9]+|BEYOND)", period_col="POS",
                        periods=PERIODS)
    L, W = q("DIM LENGTH INCHES"), q("DIM WIDTH INCHES")
    long = long.withColumns({
        "FIE_Weight_lbs": q("DSS_WEIGHT") * q("Required_FIE"),
        "FIE_CUFT": q("DSS_CUBE") * q("Required_FIE"),
        "POS_Weight_lbs": q("DSS_WEIGHT") * q("Required"),
        "POS_CUFT": q("DSS_CUBE") * q("Required"),
        "POS_SQFT": square_feet(L, W, FIXED["sentinels"]) * q("Required")})
    return C.project(long, IX_LONG_COLUMNS)


def _ix_period_col(c: str) -> bool:
    return re.search(r"_(POS[0-9]+|BEYOND)$", c) is not None


# ---------------------------------------------------------------------------
# X18 / X19 / X25 union of class outputs, roll-up, run comparison
# ---------------------------------------------------------------------------
UNION_COLUMNS = ["CLASS_OF_SUPPLY", "REGION", "LOCATION_NAME", "POS", "CUFT", "SQFT", "TEUS",
                 "WEIGHT_LBS", "TOTAL_COST"]
UNION_MEASURES = ["CUFT", "SQFT", "TEUS", "WEIGHT_LBS", "TOTAL_COST"]


def aggregated_classes(outputs: Sequence[DataFrame], keep: Sequence[str] = (),
                       class_labels: Sequence[str] | None = None) -> DataFrame:
    """Class outputs -> one 9-column fact table: headers stripped and
    upper-cased, absent measures 0, NULLs 0 ('0' in text columns).

    ``keep`` carries extra columns (e.g. the run id) through the union;
    ``class_labels`` overwrites the class label per input (notebook variant).
    """
    cols = list(keep) + UNION_COLUMNS
    parts = []
    for i, d in enumerate(outputs):
        d = C.upper_columns(d, strip=True)
        d = C.conform(d, cols, fill=0)
        d = d.select([q(c).cast("double").alias(c) if c in UNION_MEASURES
                      else q(c).cast("string").alias(c) if c in UNION_COLUMNS or c == "REGION_MEF_LEAD" else q(c)
                      for c in cols])
        if class_labels is not None:
            d = d.withColumn("CLASS_OF_SUPPLY", F.lit(class_labels[i]))
        parts.append(d)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return C.fill_zero(out)


def read_class_outputs(spark, paths: Sequence[str], mode: str = "corrected") -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """Open each class output. A file that can't be read is an error; in
    ``mode='reference'`` it is reported and skipped (the union still runs),
    like the source job."""
    from quartermaster.sources.io import read_table
    ok, failed = [], []
    for p in paths:
        try:
            df = read_table(spark, p)
            df.schema  # noqa: B018 - forces analysis so a bad file fails here
            ok.append(df)
        except Exception as e:
            if mode != "reference":
                raise
            failed.append((p, repr(e)))
    return ok, failed


def class_rollup(union: DataFrame | Sequence[DataFrame],
                 dims: Sequence[str] = ("REGION", "LOCATION_NAME", "REGION_MEF_LEAD", "POS"),
                 measures: Sequence[str] = UNION_MEASURES) -> DataFrame:
    """Region -> location -> lead -> period roll-up of the class union's
    measures (summed in whole cents at the finest grain first, then rolled
    up). The union, or its parts, have to carry the lead (``keep=['REGION_MEF_LEAD']``)."""
    parts = [union] if isinstance(union, DataFrame) else union
    u = [p.withColumns({f"__c_{m}": cents(m) for m in measures}) for p in parts]
    out = R.rollup_sums(u, list(dims), {m: f"__c_{m}" for m in measures}, count_col="N_ROWS")
    return out.withColumns({m: from_cents(m) for m in measures})


def compare_runs(union: DataFrame, run_col: str, base, keys: Sequence[str] = ("CLASS_OF_SUPPLY", "REGION", "POS"),
                 measure: str = "TOTAL_COST") -> DataFrame:
    """One row per (class, region, period, run) of any run in the union: the
    run's sum of the measure, the ``base`` run's, and the difference (a
    missing sum counts as 0)."""
    ks = list(keys)
    sums = union.groupBy(*[q(k) for k in [*ks, run_col]]).agg(F.sum(q(measure)).alias(measure))
    of_base = sums.filter(q(run_col) == F.lit(base)).select(
        *[q(k).alias(f"__{k}") for k in ks], q(measure).alias(f"base_{measure}"))
    same = None
    for k in ks:
        e = q(k).eqNullSafe(q(f"__{k}"))
        same = e if same is None else same & e
    out = sums.join(of_base, same, "left").drop(*[f"__{k}" for k in ks])
    zero = F.lit(0)
    return out.withColumn(f"diff_{measure}", F.coalesce(q(measure), zero) - F.coalesce(q(f"base_{measure}"), zero))
