"""Dimension jobs (X12-X17), publish jobs (X20-X22) and the property
checks of the test plan on hand-made frames."""

import json

import pytest
from pyspark.sql import functions as F

from quartermaster.operators import relational as R
from quartermaster.operators import reshape as S
from quartermaster.plans import dimensions as D
from quartermaster.plans import publish as P
from quartermaster.plans import publish_queries as Q


def test_decimal_repair_first_match_in_order(spark):
    df = spark.createDataFrame([(1, 250, 150, 145, 3.146), (2, 11, 11, 11, 99.0)],
                               "id int, l long, w long, h long, cf double")
    out = {r.id: (r.l_new, r.w_new, r.h_new) for r in D.repair_dimensions(df, "l", "w", "h", "cf").collect()}
    # candidates 2.5/25/250 x 1.5/15/150 x 1.45/14.5/145: the first hit, length outermost
    assert out[1] == (2.5, 15.0, 145.0)
    assert out[2] == (None, None, None)


def _parts_catalog(spark):
    parts = spark.createDataFrame(
        [("F1", "000000001", "BOLT", "EA", 1.0), ("F1", "000000002", "NUT", "EA", 2.0),
         ("F2", "000000003", "GEAR", "EA", 3.0)],
        "FSC string, NIIN string, Nomenclature string, UI string, Unit_Price double")
    cat = spark.createDataFrame(
        [("000000001", "PN1", "C1", 2.0, 0.5, 7.0, 0.0), ("000000002", "PN2", "C2", 0.0, 1.0, 0.0, 3.0)],
        "niin string, part_number string, cage_code string, dss_weight double, dss_cube double, "
        "unit_pack_weight double, unit_pack_cube double")
    return parts, cat


def test_missing_dimensions_reasons(spark):
    parts, cat = _parts_catalog(spark)
    got = sorted(tuple(r) for r in D.missing_dimensions(parts, cat).collect())
    assert got == [("000000002", "zero_dimension"), ("000000003", "not_in_catalog")]


def test_final_dimension_table_priority_rules(spark):
    parts, cat = _parts_catalog(spark)
    imputed = spark.createDataFrame([("000000002", 4.0, 9.0, "Yes"), ("000000003", 5.0, 6.0, "Yes")],
                                    "NIIN string, dss_weight double, dss_cube double, Imputed string")
    out = {r.NIIN: r for r in D.final_dimension_table(parts, cat, imputed).collect()}
    one = out["000000001"]
    # not in the zero set: unit-pack weight takes the catalog weight (first-stage rule)
    assert (one.part_number, one.dss_weight, one.unit_pack_weight, one.unit_pack_cube, one.Imputed) == \
        ("PN1", 2.0, 2.0, 0.5, "No")
    two = out["000000002"]
    # zero weight kept by the first stage (Q9), replaced by the imputed value in the second
    assert (two.dss_weight, two.dss_cube, two.unit_pack_weight, two.unit_pack_cube, two.Imputed) == \
        (4.0, 1.0, 4.0, 3.0, "Yes")
    three = out["000000003"]
    assert (three.part_number, three.cage_code, three.dss_weight, three.unit_pack_cube) == \
        ("Not in FLIS", "Not in FLIS", 5.0, 6.0)


def test_patch_q10_sequential_vs_corrected(spark):
    dims = spark.createDataFrame([("BOLT", 0.0, 1.0), ("NUT", -1.0, 2.0)],
                                 "NOMENCLATURE string, DSS_WEIGHT double, DSS_CUBE double")
    nc = spark.createDataFrame([("BOLT", 5.0, 7.0), ("NUT", None, 8.0)],
                               "NOMENCLATURE string, DSS_WEIGHT double, DSS_CUBE double")
    ref = {r.NOMENCLATURE: (r.DSS_WEIGHT, r.DSS_CUBE) for r in D.patch_from_name_check(dims, nc).collect()}
    assert ref == {"BOLT": (5.0, 1.0), "NUT": (-1.0, 8.0)}  # cube patched only where weight stayed <= 0
    fixed = {r.NOMENCLATURE: (r.DSS_WEIGHT, r.DSS_CUBE)
             for r in D.patch_from_name_check(dims, nc, mode="corrected").collect()}
    assert fixed == {"BOLT": (5.0, 7.0), "NUT": (-1.0, 8.0)}


def test_impute_mean_and_min_positive(spark):
    train = spark.createDataFrame([("F1", 1.0, 3.0), ("F1", 3.0, 3.0), ("F2", 0.0, 1.0)],
                                  "FSC string, dss_weight double, dss_cube double")
    missing = spark.createDataFrame([("F1", "n1"), ("F2", "n2"), ("F9", "n3")], "FSC string, NIIN string")
    out = {r.NIIN: r for r in D.impute_dimensions(train, missing, model="mean", mode="corrected").collect()}
    import math
    f1 = (math.log1p(1.0) + math.log1p(3.0)) / 2
    assert out["n1"].dss_weight == pytest.approx(math.expm1(f1))
    overall = (math.log1p(1.0) + math.log1p(3.0) + math.log1p(0.0)) / 3
    # F9 unseen -> overall mean; F2's mean is 0 -> smallest positive prediction (the overall mean)
    assert out["n3"].dss_weight == pytest.approx(math.expm1(overall))
    assert out["n2"].dss_weight == pytest.approx(math.expm1(min(f1, overall)))
    assert out["n1"].Imputed == "Yes"


def test_catalog_summary_lists(spark):
    cat = spark.createDataFrame([("n1", "B", "C", 1.5), ("n1", "A", "C", 0.5), ("n1", "A", "D", 2.0),
                                 ("n2", "Z", "C", 1.0)], "niin string, part_number string, cage_code string, "
                                "w double")
    out = D.catalog_summary(cat, ["n1"], list_cols=["w"]).collect()
    assert [tuple(r) for r in out] == [("n1", "A, B", "C, D", "0.5, 1.5, 2.0")]


def test_reconcile_and_publishable_sheets(spark):
    runs = spark.createDataFrame([("9001",), ("9002",)], "assessment_id string")
    exp = P.expected_datasets(runs)
    assert exp.count() == 2 * len(P.EXPECTED_DATASETS)
    files = exp.filter(F.col("stem").isin("cosi-embark", "AssessmentTable") & (F.col("assessment_id") == "9001"))
    state = exp.filter((F.col("stem") == "cosi-embark") & (F.col("assessment_id") == "9001"))
    detail, verdict = P.reconcile_datasets(exp, files, state)
    v = {r.assessment_id: (r.n_matched, r.n_unmatched, r.signal) for r in verdict.collect()}
    assert v == {"9001": (1, 1, None), "9002": (0, 0, P.SYNCED_SIGNAL)}
    # scenario lists from the definition notebook: I; I + IIIP; IX; IIIP + IV
    scen = [("s1", "cosi-embark"), ("s2", "cosi-embark"), ("s2", "cosiiip-embark"), ("s3", "cosix-embark"),
            ("s4", "cosiiip-embark"), ("s4", "cosiv-embark"), ("s4", "AssessmentTable"), ("s4", "POS")]
    avail = spark.createDataFrame(scen, "assessment_id string, stem string")
    sheets = P.publishable_sheets(avail, P.sheet_mapping(spark))
    got = {}
    for r in sheets.orderBy("assessment_id", "sheet_order").collect():
        got.setdefault(r.assessment_id, []).append(r.sheet_name)
    assert got == {"s1": ["CL I RD Embark"], "s2": ["CL I RD Embark", "CL IIIP RD", "CL IIIP RD Embark"],
                   "s3": ["CL IX RD", "CL IX RD Embark"],
                   "s4": ["Summary", "CL IIIP RD", "CL IIIP RD Embark", "CL IV RD", "CL IV RD Embark"]}
    ids = P.dataset_identifiers(exp.filter(F.col("assessment_id") == "9001")).filter(
        F.col("dataset_id") == "cosi-embark-dataset-9001").first()
    assert ids.identifier == "cosi_embark_dataset_9001"


def test_field_usage_walks_field_wells(spark):
    doc = {"Sheets": [{"SheetId": "s1", "Visuals": [
        {"BarChartVisual": {"VisualId": "v1", "ChartConfiguration": {"FieldWells": {
            "BarChartAggregatedFieldWells": {
                "Category": [{"CategoricalDimensionField": {"FieldId": "f1", "Column": {
                    "DataSetIdentifier": "cosi_embark_dataset_1", "ColumnName": "POS"}}}],
                "Values": [{"NumericalMeasureField": {"FieldId": "f2", "Column": {
                    "DataSetIdentifier": "cosix_embark_dataset_1", "ColumnName": "CUFT"}}}]}}}}},
        {"TextBoxVisual": {"VisualId": "v2"}}]}]}
    docs = spark.createDataFrame([("d1", json.dumps(doc))], "document string, definition string")
    rows = sorted((r.visual_id, r.role, r.field_id, r.dataset_identifier)
                  for r in P.field_usage(docs).collect())
    assert rows == [("v1", "Category", "f1", "cosi_embark_dataset_1"),
                    ("v1", "Values", "f2", "cosix_embark_dataset_1")]
    ids = spark.createDataFrame([("1", "cosi_embark_dataset_1")], "assessment_id string, identifier string")
    fields = P.field_usage(docs).withColumn("assessment_id", F.lit("1"))
    assert [r.field_id for r in P.subset_fields(fields, ids).collect()] == ["f1"]


def test_line_definitions_are_dealt_out_and_made_before_they_are_parsed(spark, tmp_path):
    odd = ["1-URGENT", 'a "b" \\ c', "\u00e4\n", None]
    spark.createDataFrame([(i, "F" if i % 3 else None, odd[i % 4]) for i in range(40)],
                          "o_orderkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i % 40, i // 40, ["A", "</x>", None][i % 3]) for i in range(160)],
                          "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = Q.q_field_usage(spark, str(tmp_path))
    rows = df.collect()
    assert len(rows) == 3 * 160
    got = {(r.document, r.column_name): (r.sheet_id, r.visual_type, r.field_id, r.dataset_identifier) for r in rows}
    for i in range(160):
        key, flag = i % 40, ["A", "</x>", None][i % 3]
        line, sheet = f"{key}_{i // 40}", "S_F" if key % 3 else None
        kind = "TableVisual" if key % 4 else "BarChartVisual"
        ds = flag and f"ds_{flag}"
        assert got[f"L{line}", "l_quantity"] == (sheet, kind, f"Q{line}", ds)
        assert got[f"L{line}", "l_extendedprice"] == (sheet, kind, f"P{line}", ds)
        assert got[f"L{line}", "o_orderpriority"] == (sheet, kind, f"G{key}", odd[key % 4] and f"orders_{odd[key % 4]}")
    # a small table's partitions aren't joined to one before its lines become documents
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the text is a column of its own: from_json holds no expression that makes it
    parse = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "from_json" in x]
    assert parse and not any("StructsToJson" in x for x in parse)


# --- property checks of the test plan -------------------------------------
def test_unpivot_then_pivot_is_identity_on_unique_keys(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "k int, a double, b double")
    back = S.pivot_strict(S.melt(df, ["k"], ["a", "b"], "n", "v"), ["k"], "n", ["a", "b"], "v")
    assert sorted(tuple(r) for r in back.select("k", "a", "b").collect()) == sorted(tuple(r) for r in df.collect())


def test_left_join_to_unique_dimension_keeps_row_count(spark):
    fact = spark.range(100).withColumn("k", F.col("id") % 7)
    dim = spark.range(5).withColumnRenamed("id", "k")
    assert R.join_on(fact, dim, "k", how="left").count() == 100


def test_running_total_last_value_is_grand_total(spark):
    df = spark.createDataFrame([(d, v) for d in range(1, 6) for v in (d, 2 * d)], "Day int, x long")
    out = R.running_total(df, "Day", "x", "daily", "cum")
    last = out.orderBy(F.col("Day").desc()).first().cum
    assert last == sum(d + 2 * d for d in range(1, 6))


def test_union_row_count_is_sum_of_inputs(spark):
    a = spark.range(3).select(F.col("id").alias("KEY"))
    b = spark.range(4).select(F.col("id").alias("KEY"), F.lit("x").alias("NAME"))
    assert R.union_conform([a, b], ["KEY", "NAME"]).count() == 7


def test_first_per_key_and_latest(spark):
    df = spark.createDataFrame([("u", 3, "c"), ("u", 1, "a"), ("v", 2, "b")], "k string, o int, x string")
    assert sorted(tuple(r) for r in R.first_per_key(df, "k", "o").collect()) == [("u", 1, "a"), ("v", 2, "b")]
    assert sorted(tuple(r) for r in R.latest(df, "k", "o", ["x"]).collect()) == [("u", 3, "c"), ("v", 2, "b")]


def test_hash_split_is_deterministic_and_complete(spark):
    df = spark.range(1000)
    a = R.split_keys(df, "id", {"train": 0.8, "test": 0.2})
    b = R.split_keys(df, "id", {"train": 0.8, "test": 0.2})
    assert a.exceptAll(b).count() == 0 and a.count() == 1000
    n_test = a.filter(F.col("split") == "test").count()
    assert 120 < n_test < 280
