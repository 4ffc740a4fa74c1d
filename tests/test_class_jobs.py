"""Class jobs and quirks Q1-Q15 on hand-made frames (both modes where the
quirk has a corrected form). Expected numbers follow the formulas in the
job docstrings, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from quartermaster.plans import classes as X


def test_class_i_long_form_and_costs(spark):
    df = spark.createDataFrame(
        [(1, "I", "MEALS_READY_TO_EAT_MRE", "R1", "R1_L", "cap", "caps", 7, "L7", "CS",
          96.0, 2.0, 91.0, 2160.0, 0.125, 0.06, 480.0),
         (1, "I", "OTHER", "R1", "R1_L", "cap", "caps", 8, "L8", "CS",
          10.0, 1.0, 45.5, 225.0, 0.0625, 0.03, 16.0)],
        "AssessmentNumber int, Class_of_Supply string, Ration_Type string, Region string, "
        "Region_MEF_Lead string, CAP_Name string, CAP_Names string, Location_ID int, "
        "Location_Name string, `Unit of Issue` string, DOS1_Units double, DOS1_Units_Pallet_Qty double, "
        "DOS1_Units_Pallet_Tot_CuFT double, `DOS1_Units_Pallet_Tot_Wt(lbs)` double, "
        "DOS1_Units_Pallet_Tot_TEUs double, DOS1_Units_Pallet_Tot_FEUs double, BEYOND double")
    for plan in ("restack", "pivot"):
        with pytest.raises(Exception, match="repeated keys|duplicate entries"):
            X.class_i(df.union(df), plan=plan).count()
        out = {(r.LOCATION_ID, r.POS): r for r in X.class_i(df, plan=plan).collect()}
        assert set(out) == {(7, "POS1"), (7, "BEYOND"), (8, "POS1"), (8, "BEYOND")}
        mre = out[(7, "POS1")]
        assert (mre.QTY, mre.PALLETS, mre.CUFT, mre.TOTAL_COST) == (96.0, 2.0, 91.0, 96.0 * 119.03)
        assert out[(7, "BEYOND")].PALLETS == 480.0 / 48
        assert out[(8, "BEYOND")].PALLETS is None  # not a ration type with a pallet size
        assert out[(8, "POS1")].TOTAL_COST == 0.0
        assert out[(7, "BEYOND")].CUFT is None  # beyond rows carry quantity and pallets only


def test_class_i_duplicate_key_fails_in_pivot_plan(spark):
    row = (1, "I", "MEALS_READY_TO_EAT_MRE", "R", "L", "c", "c", 1, "L1", "CS", 1.0, 2.0)
    df = spark.createDataFrame([row, row], "AssessmentNumber int, Class_of_Supply string, "
                               "Ration_Type string, Region string, Region_MEF_Lead string, "
                               "CAP_Name string, CAP_Names string, Location_ID int, Location_Name string, "
                               "`Unit of Issue` string, DOS1_Units double, BEYOND double")
    with pytest.raises(Exception, match="duplicate"):
        X.class_i(df, plan="pivot").collect()


def _equipment(spark):
    return spark.createDataFrame(
        [(1, "II", "L", "R", "RM", "U", "POS1", "T1", 2.0, 3.0, 0.5, 0.6, 0.01, 4.0, 100.0, 1.0, 2.0, 3.0),
         (1, "II", "L", "R", "RM", "U", "POS1", "T2", 2.0, 3.0, 0.0, 0.6, 0.01, 4.0, 100.0, 1.0, 2.0, 3.0)],
        "AssessmentNumber int, Class_of_Supply string, Location_Name string, Region string, "
        "Region_MEF_Lead string, UIC string, POS string, TAMCN string, `IND SQFT` double, "
        "`IND CUFT` double, `IND STON` double, `IND MTON` double, TEU_Equivalents double, "
        "TE_Orig_Qty double, STANDARD_UNIT_PRICE double, `DIM HEIGHT INCHES` double, "
        "`DIM LENGTH INCHES` double, `DIM WIDTH INCHES` double")


def test_q1_pounds_from_short_tons(spark):
    ref = X.class_ii_vii(_equipment(spark)).collect()
    assert len(ref) == 1 and ref[0].WEIGHT_LBS == 4.0 * 0.5 / 2000  # zero-weight row dropped
    fixed = X.class_ii_vii(_equipment(spark), mode="corrected").collect()
    assert fixed[0].WEIGHT_LBS == 4.0 * 0.5 * 2000
    assert ref[0].COS_TYPE == "T1_Class_II/VII" and ref[0].TOTAL_COST == 400.0


def _vi_input(spark):
    cols = ("AssessmentNumber string, Class_of_Supply string, Region string, Location_ID string, "
            "Location_Name string, HCP_Type string, NIIN string, Region_MEF_Lead string, rid long, "
            "DOS1_Units_NIIN_Qty double, `DOS1_Units_NIIN_Qty_Pallet_Tot_Wt(lbs)` double")
    return spark.createDataFrame(
        [("1", "VI", "R", "7", "L", "H", "013689154", "RM", 2, 10.0, 5.0),
         ("1", "VI", "R", "7", "L", "H", "013689154", "RM", 1, None, 3.0),
         ("1", "VI", "R", "7", "L", "H", "99", "RM", 3, 4.0, 0.0)], cols)


def test_q2_class_vi_keeps_dos_labels_and_first_value(spark):
    out = X.class_vi(_vi_input(spark), row_id="rid").collect()
    assert len(out) == 1  # the zero-weight NIIN is filtered
    r = out[0]
    assert r.POS == "DOS1"  # never matches the period table's POS labels
    assert (r.QTY, r.WEIGHT_LBS) == (10.0, 3.0)  # first non-null by row id per metric
    assert r.TOTAL_COST == 10.0 * 240.58 and r.UI == "Box"
    fixed = X.class_vi(_vi_input(spark), row_id="rid", mode="corrected").collect()
    assert fixed[0].POS == "POS1"


def test_class_vi_makes_a_row_per_period_not_per_cell(spark):
    """The names of the cells are known beforehand: no row carries or parses one."""
    df = _vi_input(spark).selectExpr("*", "cast(7 AS int) AS POS1_Units_NIIN_Qty", "20.0D AS NIIN_Qty")
    out = X.class_vi(df, row_id="rid", mode="corrected")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "Expand" not in plan
    # two columns of one cell meet in it (row 1 has no DOS1 quantity); a column without a period makes no row
    r = out.collect()
    assert [(x.POS, x.QTY, x.WEIGHT_LBS) for x in r] == [("POS1", 7.0, 3.0)]


def _ix_frames(spark):
    req = spark.createDataFrame(
        [("1", "IX", "R", "M", "F", "L", "true", "FALSE", "TN", "TE", "NE", "CN", 1, 2, 0, 0, 0,
          "FSC", "000000001", "PART", "EA", 10.0, 3, 1, 0, 0, 0, 100.0, 5.0, 0.0, 0.0, 0.0, 9.0, 20.0,
          12.0, 12.0, 12.0),
         ("1", "IX", "R", "M", "F", "L", "no", "TRUE", "TN", "TE", "NE", "CN", 1, 2, 0, 0, 0,
          "FSC", "000000002", "PART2", "EA", 10.0, 3, 1, 0, 0, 0, 100.0, 5.0, 0.0, 0.0, 0.0, 9.0, 20.0,
          0.0, 12.0, 12.0)],
        "AssessmentNumber string, Class_of_Supply string, Region string, MEF string, FIE string, "
        "`Location Name` string, `SECREP Flag` string, `Battery Flag` string, TAMCN_NIIN string, "
        "TAMCN_of_End_Item string, NIIN_of_End_Item string, COLLOQUIAL_NAME string, "
        "TAMCN_NIIN_QTY_FIE long, TAMCN_NIIN_QTY_POS1 long, TAMCN_NIIN_QTY_POS2 long, "
        "TAMCN_NIIN_QTY_POS3 long, TAMCN_NIIN_QTY_BEYOND long, `FSC of Part Required` string, "
        "`NIIN of Part Required` string, `Nomenclature of Part Required` string, UNIT_OF_ISSUE string, "
        "`STANDARD UNIT PRICE` double, Required_FIE long, Required_POS1 long, Required_POS2 long, "
        "Required_POS3 long, Required_BEYOND long, Value_FIE double, Value_POS1 double, Value_POS2 double, "
        "Value_POS3 double, Value_BEYOND double, Total_Value_Less_FIE double, "
        "Total_Value_Selected_Confidence double, `DIM LENGTH INCHES` double, `DIM WIDTH INCHES` double, "
        "`DIM HEIGHT INCHES` double")
    dims = spark.createDataFrame(
        [("000000001", "PART", 7.0, "EA", 2.0, 0.0, 1), ("000000001", "PART", 7.0, "EA", 99.0, 9.0, 2)],
        "NIIN string, NOMENCLATURE string, UNIT_PRICE double, UI string, DSS_WEIGHT double, "
        "DSS_CUBE double, rid int")
    return req, dims


def test_q3_q6_class_ix_unpivots_all_bases_and_inner_join_drops(spark):
    req, dims = _ix_frames(spark)
    out = X.class_ix(req, dims, dims_row_id="rid").collect()
    assert len(out) == 12  # 3 bases x 4 periods for the one part with dimensions (Q6)
    assert {r.FEATURE for r in out} == {"TAMCN_NIIN_QTY", "Required", "Value"}  # Q3
    v = next(r for r in out if r.FEATURE == "Value" and r.POS == "POS1")
    assert v.WEIGHT_LBS == 2.0 * 5.0  # weight x money for the Value base (Q3)
    assert v.DSS_CUBE == 0.01 and v.CUFT == 1.0  # 12x12x12 in = 1 cu ft > 0.01
    assert v.CLASS_OF_SUPPLY == "IX C (S)"  # SECREP 'true' (any case)
    assert {r.TOTAL_COST for r in out} == {20.0}  # Q4: totals repeat on every row
    left = X.class_ix(req, dims, mode="corrected", dims_row_id="rid").collect()
    assert len(left) == 24 and any(r.CLASS_OF_SUPPLY == "IX C (B)" for r in left)


def test_x23_notebook_class_ix(spark):
    req, dims = _ix_frames(spark)
    out = X.class_ix_long(req, dims, dims_row_id="rid").collect()
    assert len(out) == 8  # left join keeps both parts, one row per period
    one = next(r for r in out if r.NIIN == "000000001" and r.POS == "POS1")
    assert one.Class_of_Supply == "IX C"  # exact text 'TRUE' needed in this form
    assert (one.FIE_Weight_lbs, one.POS_Weight_lbs, one.POS_SQFT) == (6.0, 2.0, 1.0)
    two = next(r for r in out if r.NIIN == "000000002" and r.POS == "POS1")
    assert two.Class_of_Supply == "IX B" and two.POS_Weight_lbs is None


def test_q5_q15_union_fills_absent_measures(spark, tmp_path):
    a = spark.createDataFrame([("I", "R", "L", "POS1", 1.0, None, 2.0, 3.0)],
                              "CLASS_OF_SUPPLY string, REGION string, LOCATION_NAME string, POS string, "
                              "CUFT double, TEUS double, WEIGHT_LBS double, TOTAL_COST double")
    b = spark.createDataFrame([(" ix ", None, "L", "POS2", 1.0, 1.0)],
                              "` class_of_supply ` string, region string, location_name string, pos string, "
                              "sqft double, weight_lbs double")
    out = X.aggregated_classes([a, b]).orderBy("POS").collect()
    assert [tuple(r) for r in out] == [("I", "R", "L", "POS1", 1.0, 0.0, 0.0, 2.0, 3.0),
                                       (" ix ", "0", "L", "POS2", 0.0, 1.0, 0.0, 1.0, 0.0)]
    good = tmp_path / "cosi_embark.csv"
    a.toPandas().to_csv(good, index=False)
    ok, failed = X.read_class_outputs(spark, [str(good), str(tmp_path / "missing.csv")], mode="reference")
    assert len(ok) == 1 and len(failed) == 1  # Q15: a failing file is reported, the union runs
    with pytest.raises(Exception):
        X.read_class_outputs(spark, [str(good), str(tmp_path / "missing.csv")])


def test_class_i_extended_positional_names(spark):
    df = spark.createDataFrame(
        [(2000, "I", "MEALS_READY_TO_EAT_MRE", "R", "RM", "L", 1, "CS", 96.0, 2.0, 91.0, 2160.0, 0.125, 480.0),
         (1999, "I", "MEALS_READY_TO_EAT_MRE", "R", "RM", "L", 1, "CS", 48.0, 1.0, 45.5, 1080.0, 0.0625, None)],
        "AssessmentNumber int, Class_of_Supply string, Ration_Type string, Region string, "
        "Region_MEF_Lead string, Location_Name string, Location_ID int, `Unit of Issue` string, "
        "DOS1_Units double, DOS1_Units_Pallet_Qty double, DOS1_Units_Pallet_Tot_CuFT double, "
        "`DOS1_Units_Pallet_Tot_Wt(lbs)` double, DOS1_Units_Pallet_Tot_TEUs double, BEYOND double")
    ref = {r.POS: r for r in X.class_i_extended(df, "AssessmentNumber").collect()}
    p1 = ref["POS1"]  # first values come from the 1999 row
    assert (p1.Qty, p1.CUFT, p1.Pallets, p1.Weight_lbs, p1.UI) == (48.0, 1.0, 0.0625, 1080.0, "Box")
    assert p1.TEUS == 1080.0 / 1024 and p1.STONS == 1080.0 / 2000 + (1080.0 / 1024) * 5000 / 2000
    b = ref["BEYOND"]
    assert b.Weight_lbs == 10.0 * 1098.0 * 1.02 and b.Cost == 480.0 * 119.03
    fixed = {r.POS: r for r in X.class_i_extended(df, "AssessmentNumber", mode="corrected").collect()}
    assert (fixed["POS1"].Pallets, fixed["POS1"].CUFT) == (1.0, 45.5)


def test_period_table_and_force_flow(spark):
    runs = spark.createDataFrame([(10908, 115)], "AssessmentNumber long, OperationDuration long")
    params = spark.createDataFrame([(10908, 30, 60, 90)], "AssessmentID long, DaysOfSupplyFirst long, "
                                   "DaysOfSupplySecond long, DaysOfSupplyThird long")
    p = X.period_table(runs, params).orderBy("Sort_Index").collect()
    assert [(r.POS, r.DOS, r.Period) for r in p] == [("POS1", "DOS1", 30), ("POS2", "DOS2", 60),
                                                      ("POS3", "DOS3", 90), ("BEYOND", "BEYOND", 115)]
    cols = X.FORCE_FLOW_COLUMNS
    base = {c: None for c in cols}
    recs = []
    for day, flow, dos in [(1, 5, "DOS1"), (1, 2, "DOS1"), (2, 4, "DOS2"), (None, 9, "DOS1")]:
        r = dict(base, AssessmentNumber=10908, Day=day, Flowin=flow, DOS_Period=dos)
        recs.append(tuple(r[c] for c in cols if c not in ("POS", "DOS", "Period", "Sort_Index",
                                                           "OperationDuration")))
    schema = ", ".join(f"`{c}` {'long' if c in ('AssessmentNumber', 'Day', 'Flowin') else 'string'}"
                       for c in cols if c not in ("POS", "DOS", "Period", "Sort_Index", "OperationDuration"))
    pax = spark.createDataFrame(recs, schema)
    ff = X.force_flow(pax, runs, X.period_table(runs, params)).collect()
    got = sorted((r.Day if r.Day is not None else -1, r.Flowin, r.daily_Inflow, r.Cumulative_Daily_Inflow, r.POS)
                 for r in ff)
    assert got == [(-1, 9, None, None, "POS1"), (1, 2, 7, 7, "POS1"), (1, 5, 7, 7, "POS1"),
                   (2, 4, 4, 11, "POS2")]
    assert len(ff[0].asDict()) == 27


def test_x4_ration_joins_normalise_and_join_per_run(spark):
    runs = spark.createDataFrame([(1, 115), (2, 50)], "AssessmentNumber long, OperationDuration long")
    params = spark.createDataFrame([(1, 30, 60, 90), (2, 10, 20, 30)],
                                   "AssessmentID long, DaysOfSupplyFirst long, DaysOfSupplySecond long, "
                                   "DaysOfSupplyThird long")
    costs = spark.createDataFrame([(1, "DOS2", "mre", 5.0), (2, "DOS2", "ugr", 6.0), (2, "DOS9", "x", 1.0)],
                                  "AssessmentNumber long, DOS_Period string, ration_type string, ui_count double")
    out = X.ration_joins({"costs": costs}, X.period_table(runs, params))["costs"]
    assert "Ration_type" in out.columns and "Ui_count" in out.columns  # capitalised, not retained
    got = sorted((r.AssessmentNumber, r.DOS_Period, r.POS, r.Period) for r in out.collect())
    assert got == [(1, "DOS2", "POS2", 60), (2, "DOS2", "POS2", 20), (2, "DOS9", None, None)]
