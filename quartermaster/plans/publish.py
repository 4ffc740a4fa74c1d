"""Publishing side: reconcile expected datasets against files and state,
pick the report sheets each run can show, and list which dataset every
report field reads.

All inputs are DataFrames keyed by run (``assessment_id``), so one job
handles every run at once; lists stay rows (one row per run and item), never
driver-side Python lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.operators import relational as R
from quartermaster.operators.columns import q

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's): the datasets every run is
# expected to produce (file path under the run folder, dataset stem), and
# the report sheets each dataset feeds, in the report's sheet order.
# ---------------------------------------------------------------------------
EXPECTED_DATASETS = [
    ("cos-calculators/AssessmentParameterDataMapTable.csv", "AssessmentParameterDataMapTable"),
    ("cos-calculators/AssessmentTable.csv", "AssessmentTable"),
    ("cosi_embark.csv", "cosi-embark"),
    ("cosi_water_embark.csv", "cosi-water-embark"),
    ("cosii_vii_embark.csv", "cosii-vii-embark"),
    ("cosiiip_embark.csv", "cosiiip-embark"),
    ("cosiv_embark.csv", "cosiv-embark"),
    ("cosvi_embark.csv", "cosvi-embark"),
    ("cosix_embark.csv", "cosix-embark"),
    ("ForceFlow_joined.csv", "ForceFlow-joined"),
    ("RD_I_POS_Location_joined.csv", "RD-I-POS-Location-joined"),
    ("RD_I_Ration_Costs_joined.csv", "RD-I-Ration-Costs-joined"),
    ("RD_IW_PaxLocationAll_joined.csv", "RD-IW-PaxLocationAll-joined"),
    ("RD_IW_Ration_Costs_joined.csv", "RD-IW-Ration-Costs-joined"),
    ("cos-calculators/cos-i-water/output/RD_IW_POS_Requirement.csv", "RD-IW-POS-Requirement"),
    ("cos-calculators/cos-ii-vii/output/RD_II_VII_DailyTE_WithDimensions.csv",
     "RD-II-VII-DailyTE-WithDimensions"),
]

SHEET_ORDER = ["Summary", "Embark", "Force Flow", "CL I RD", "CL I RD Embark", "CL I (W) RD",
               "CL II/VII RD", "CL II/VII RD Embark", "CL IIIP RD", "CL IIIP RD Embark", "CL IV RD",
               "CL IV RD Embark", "CL VI RD", "CL VI RD Embark", "CL IX RD", "CL IX RD Embark"]

DATASET_SHEETS = [
    ("AssessmentTable", "Summary"),
    ("AssessmentParameterDataMapTable", "Summary"),
    ("Locations", "Summary"),
    ("POS", "Summary"),
    ("aggregated-embark", "Embark"),
    ("ForceFlow-joined", "Force Flow"),
    ("RD-I-POS-Location-joined", "CL I RD"),
    ("RD-I-POS-Pallet-Requirement", "CL I RD"),
    ("RD-I-Ration-Costs-joined", "CL I RD"),
    ("cosi-embark", "CL I RD Embark"),
    ("RD-IW-PaxLocationAll-joined", "CL I (W) RD"),
    ("RD-II-VII-DailyTE-WithDimensions", "CL II/VII RD"),
    ("cosii-vii-embark", "CL II/VII RD Embark"),
    ("cosiiip-embark", "CL IIIP RD"),
    ("cosiiip-embark", "CL IIIP RD Embark"),
    ("cosiv-embark", "CL IV RD"),
    ("cosiv-embark", "CL IV RD Embark"),
    ("cosvi-embark", "CL VI RD"),
    ("cosvi-embark", "CL VI RD Embark"),
    ("cosix-embark", "CL IX RD"),
    ("cosix-embark", "CL IX RD Embark"),
]

# Files that arrive but feed no report dataset (skipped by name
# prefix; the last entry is spelled with hyphens, so it never matches the
# underscore file names and that file is processed anyway).
NOT_NEEDED_PREFIXES = ["RD_IIIP_POL_Pkg_NSN_Requirements_PBI", "RD_IV_Daily_Requirements",
                       "RD_VI_POS_Pallet_Requirement", "RD-II-ICCE-DailyTE"]

SYNCED_SIGNAL = "DATASETS_SYNCED!"


def skip_not_needed(files: DataFrame, name_col: str = "file_name",
                    prefixes: Sequence[str] = NOT_NEEDED_PREFIXES) -> DataFrame:
    """Drop arriving files that feed no report dataset (F7 prefix exclusion)."""
    from quartermaster.operators.columns import exclude_prefixes
    return exclude_prefixes(files, name_col, prefixes)


def dataset_id(stem, run) -> F.Column:
    """'<stem>-dataset-<run>' (the state table's dataset key)."""
    return F.concat(stem, F.lit("-dataset-"), run.cast("string"))


def expected_datasets(runs: DataFrame, run_col: str = "assessment_id") -> DataFrame:
    """Every run x every expected dataset, as a Generate on the run rows (no
    join): (run, file, stem, dataset_id)."""
    arr = F.array(*[F.struct(F.lit(f).alias("file"), F.lit(s).alias("stem"))
                    for f, s in EXPECTED_DATASETS])
    e = runs.select(q(run_col), F.inline(arr))
    return e.withColumn("dataset_id", dataset_id(F.col("stem"), q(run_col)))


# ---------------------------------------------------------------------------
# X20 reconcile datasets
# ---------------------------------------------------------------------------
def reconcile_datasets(expected: DataFrame, files: DataFrame, state: DataFrame,
                       run_col: str = "assessment_id") -> tuple[DataFrame, DataFrame]:
    """Expected datasets vs. files present vs. state rows.

    ``files`` and ``state`` hold (run, dataset_id) pairs. Each expected
    dataset is 'matched' (file and state row), 'synced' (neither) or
    'unmatched' (only one). Returns (detail, per-run verdict); the verdict
    carries counts and ``signal`` = 'DATASETS_SYNCED!' when nothing is
    unmatched.
    """
    keys = [run_col, "dataset_id"]
    detail = R.reconcile(expected, files, state, keys)
    verdict = detail.groupBy(q(run_col)).agg(
        F.count(F.when(F.col("status") == "matched", 1)).alias("n_matched"),
        F.count(F.when(F.col("status") == "synced", 1)).alias("n_synced"),
        F.count(F.when(F.col("status") == "unmatched", 1)).alias("n_unmatched"))
    verdict = verdict.withColumn(
        "signal", F.when(F.col("n_unmatched") == 0, F.lit(SYNCED_SIGNAL)))
    return detail, verdict


# ---------------------------------------------------------------------------
# X21 publishable sheets
# ---------------------------------------------------------------------------
def sheet_mapping(spark) -> DataFrame:
    """The dataset -> sheet table with each sheet's position (bounded: a
    literal of the fixed values above)."""
    order = {s: i + 1 for i, s in enumerate(SHEET_ORDER)}
    rows = [(d, s, order[s]) for d, s in DATASET_SHEETS]
    return spark.createDataFrame(rows, "stem string, sheet_name string, sheet_order int")


def publishable_sheets(available: DataFrame, mapping: DataFrame,
                       run_col: str = "assessment_id") -> DataFrame:
    """Sheets each run can publish: its created datasets joined to the
    mapping (one dataset may feed several sheets), distinct per run, with
    the sheet's position in the report order. ``available`` holds (run,
    stem) for datasets whose state row has a creation stamp."""
    j = available.select(q(run_col), "stem").join(mapping, "stem")
    return j.select(q(run_col), "sheet_order", "sheet_name").distinct()


def dataset_identifiers(available: DataFrame, run_col: str = "assessment_id") -> DataFrame:
    """Report identifier per available dataset ('-' -> '_' of the dataset id)."""
    return available.select(q(run_col), "dataset_id",
                            F.regexp_replace("dataset_id", "-", "_").alias("identifier"))


def subset_fields(fields: DataFrame, identifiers: DataFrame, run_col: str = "assessment_id") -> DataFrame:
    """Definition rows whose dataset identifier is available for the run (the
    cascade of semi joins, per run)."""
    ids = identifiers.select(q(run_col), F.col("identifier").alias("dataset_identifier"))
    return fields.join(ids, [run_col, "dataset_identifier"], "left_semi")


# ---------------------------------------------------------------------------
# X22 field usage of report definitions
# ---------------------------------------------------------------------------
_FIELD = T.StructType([
    T.StructField("FieldId", T.StringType()),
    T.StructField("Column", T.StructType([T.StructField("DataSetIdentifier", T.StringType()),
                                          T.StructField("ColumnName", T.StringType())]))])
DEFINITION_SCHEMA = T.StructType([T.StructField("Sheets", T.ArrayType(T.StructType([
    T.StructField("SheetId", T.StringType()),
    T.StructField("Visuals", T.ArrayType(T.MapType(T.StringType(), T.StructType([
        T.StructField("VisualId", T.StringType()),
        T.StructField("ChartConfiguration", T.StructType([
            T.StructField("FieldWells", T.MapType(T.StringType(), T.MapType(
                T.StringType(), T.ArrayType(T.MapType(T.StringType(), _FIELD)))))]))]))))])))])


def field_usage(docs: DataFrame, doc_col: str = "document", text_col: str = "definition") -> DataFrame:
    """(document, sheet, visual, field id, dataset identifier, column) for
    every field placed in a visual's field wells.

    Layout walked: Sheets[] -> Visuals[] -> {visual type: {ChartConfiguration:
    {FieldWells: {well: {role: [{field kind: {FieldId, Column}}]}}}}}.
    (The source notebook's loop iterates the keys of the role map as if
    they were lists, so it finds no field in this layout; this walks it as
    intended.) Parsing is ``from_json`` with a fixed schema and the walk is
    a chain of ``explode``s: row-local, no shuffle.
    """
    d = docs.select(q(doc_col).alias("document"),
                    F.from_json(q(text_col), DEFINITION_SCHEMA).alias("__d"))
    d = d.select("document", F.explode("__d.Sheets").alias("__s"))
    d = d.select("document", F.col("__s.SheetId").alias("sheet_id"),
                 F.explode("__s.Visuals").alias("__v"))
    d = d.select("document", "sheet_id", F.explode("__v").alias("visual_type", "__vc"))
    d = d.select("document", "sheet_id", "visual_type", F.col("__vc.VisualId").alias("visual_id"),
                 F.explode("__vc.ChartConfiguration.FieldWells").alias("well", "__roles"))
    d = d.select("document", "sheet_id", "visual_type", "visual_id", "well",
                 F.explode("__roles").alias("role", "__fields"))
    d = d.select("document", "sheet_id", "visual_type", "visual_id", "well", "role",
                 F.explode("__fields").alias("__f"))
    d = d.select("document", "sheet_id", "visual_type", "visual_id", "well", "role",
                 F.explode("__f").alias("field_kind", "__x"))
    return d.select("document", "sheet_id", "visual_id", "visual_type", "well", "role", "field_kind",
                    F.col("__x.FieldId").alias("field_id"),
                    F.col("__x.Column.DataSetIdentifier").alias("dataset_identifier"),
                    F.col("__x.Column.ColumnName").alias("column_name"))


def read_definitions(spark, path: str) -> DataFrame:
    """Definition documents from a folder: one row per file (path, text)."""
    return (spark.read.option("wholetext", "true").text(path)
            .select(F.col("_metadata.file_path").alias("document"), F.col("value").alias("definition")))


def order_sheets(sheets: DataFrame, col: str = "sheet_name", out: str = "sheet_order",
                 order: Sequence[str] = SHEET_ORDER) -> DataFrame:
    """Sheet position by the fixed report order (unknown sheets last)."""
    return R.order_by_list(sheets, col, list(order), out)
