"""Sources and sinks (S1-S18) and contracts (P10-P15) on files written to a
temporary folder."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quartermaster.sources import contract as K
from quartermaster.sources import io as IO


@pytest.fixture()
def csv_dir(tmp_path):
    (tmp_path / "run" / "10908").mkdir(parents=True)
    (tmp_path / "run" / "10908" / "POS.csv").write_text(
        'POS,DOS,Period,Region\nPOS1,DOS1,30,"East, North"\nBEYOND,BEYOND,115,West\n')
    (tmp_path / "run" / "10908" / "cosi_embark.csv").write_text("CLASS_OF_SUPPLY,CUFT\nI,1.5\nI,NaN\n")
    (tmp_path / "run" / "10908" / "cosix_embark.csv").write_text("CLASS_OF_SUPPLY,SQFT\nIX,2\n")
    (tmp_path / "run" / "10907").mkdir()
    (tmp_path / "run" / "10907" / "POS.csv").write_text("POS,DOS,Period,Region\n")
    (tmp_path / "cat.csv").write_text("niin,dss_weight,dss_cube\n013689154,.,1.5\n000000002,2.0,.\n")
    return tmp_path


def test_read_table_infers_and_cleans_nan(spark, csv_dir):
    df = IO.read_table(spark, str(csv_dir / "run/10908/cosi_embark.csv"))
    assert [r.CUFT for r in df.collect()] == [1.5, None]


def test_read_table_schema_and_columns(spark, csv_dir):
    df = IO.read_table(spark, str(csv_dir / "run/10908/POS.csv"),
                       schema="POS string, DOS string, Period long, Region string", columns=["POS", "Region"])
    assert df.columns == ["POS", "Region"]
    assert [tuple(r) for r in df.collect()] == [("POS1", "East, North"), ("BEYOND", "West")]


def test_contract_read_tag_project_and_diff(spark, csv_dir):
    c = {"name": "POS", "columns": [{"name": "POS", "type": "STRING"}, {"name": "DOS", "type": "STRING"},
                                    {"name": "Period", "type": "INTEGER"},
                                    {"name": "Region", "type": "STRING", "tag": "STATE"}],
         "projection": ["POS", "Period", "Region"]}
    df = K.read_contract(spark, str(csv_dir / "run/10908/POS.csv"), c)
    assert df.columns == ["POS", "Period", "Region", "_bad_cells"]
    assert df.schema["Region"].metadata == {"tag": "STATE"}
    assert [(r.POS, r.Period) for r in df.collect()] == [("POS1", 30), ("BEYOND", 115)]
    with pytest.raises(ValueError, match="absent"):
        K.apply_projection(df, {"columns": [], "projection": ["POS", "X"]})
    inferred = K.infer_contract(df.drop("_bad_cells"), "POS")
    assert [x["type"] for x in inferred["columns"]] == ["STRING", "INTEGER", "STRING"]
    want = {"columns": [{"name": "POS", "type": "STRING"}, {"name": "Period", "type": "DECIMAL"},
                        {"name": "X", "type": "STRING"}]}
    diff = {(r.name, r.issue) for r in K.contract_diff(df, want).collect()}
    assert diff == {("Period", "type_mismatch"), ("X", "missing"), ("Region", "extra")}


def test_csv_to_parquet_with_dot_nulls(spark, csv_dir, tmp_path):
    out = IO.csv_to_parquet(spark, str(csv_dir / "cat.csv"), str(tmp_path / "cat.parquet"),
                            "niin string, dss_weight double, dss_cube double")
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [("000000002", 2.0, None), ("013689154", None, 1.5)]


def test_read_many_unions_by_name_with_file(spark, csv_dir):
    df = IO.read_many(spark, str(csv_dir / "run/10908"), "cos*embark.csv")
    assert set(df.columns) == {"CLASS_OF_SUPPLY", "CUFT", "SQFT", "source_file"}
    assert df.count() == 3
    assert {r.source_file for r in df.collect()} == {"cosi_embark.csv", "cosix_embark.csv"}


def test_zip_members_and_header_profile(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a/RD_I.csv", "NIIN,Qty\n013689154,3\n000000001,\n")
        z.writestr("readme.txt", "skip")
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "run.zip").write_bytes(buf.getvalue())
    (tmp_path / "z" / "plain.csv").write_text("A,B\n1,2\n")
    rows = IO.read_zip_csv(spark, str(tmp_path / "z" / "*.zip"), columns=["NIIN", "Qty", "Missing"],
                           chunk_rows=1).collect()
    assert [(r.member, r.row_number, r.NIIN, r.Qty, r.Missing, r.error) for r in rows] == [
        ("a/RD_I.csv", 0, "013689154", "3", None, None), ("a/RD_I.csv", 1, "000000001", None, None, None)]
    (tmp_path / "z" / "bad.zip").write_bytes(b"not a zip")
    whole = IO.read_zip_csv(spark, str(tmp_path / "z" / "*.zip")).collect()
    assert sorted((r.row_number, sorted(r.cells.items())) for r in whole if r.error is None) == [
        (0, [("NIIN", "013689154"), ("Qty", "3")]), (1, [("NIIN", "000000001"), ("Qty", None)])]
    assert [r.archive.rsplit("/", 1)[1] for r in whole if r.error] == ["bad.zip"]
    (tmp_path / "z" / "bad.zip").unlink()
    prof = {r.name: r.columns for r in IO.profile_headers(spark, str(tmp_path / "z")).collect()}
    assert prof == {"RD_I.csv": ["NIIN", "Qty"], "plain.csv": ["A", "B"]}


def test_members_of_an_archive_in_several_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "many.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(12):
            z.writestr(f"m{i}.csv", "A,B\n" + "".join(f"{i},{j}\n" for j in range(500)))
        z.writestr("bad.csv", b"A,B\n1,\xff\xfe\n")
        z.writestr("empty.csv", "")
    df = IO.read_zip_csv(spark, str(tmp_path / "*.zip"), columns=["A", "B"], chunk_rows=100, bundle_bytes=8000)
    good = df.filter("error IS NULL AND member <> 'bad.csv'")
    assert sorted((int(r.A), int(r.B), r.row_number) for r in good.collect()) == [(i, j, j) for i in range(12) for j in range(500)]
    assert {r.member for r in df.filter("error IS NOT NULL").collect()} == {"bad.csv", "empty.csv"}
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() >= 4
    assert IO.read_zip_csv(spark, str(tmp_path / "none*.zip")).count() == 0


def test_manifest_and_presence(spark, csv_dir, tmp_path):
    pos = str(csv_dir / "run/10908/POS.csv")
    entries = spark.createDataFrame([(pos, True), (str(tmp_path / "absent.csv"), False)],
                                    "url string, mandatory boolean")
    IO.write_manifest(spark, entries, str(tmp_path / "manifest"))
    man = IO.read_manifest(spark, str(tmp_path / "manifest"))
    assert IO.read_from_manifest(spark, man).count() == 2
    bad = spark.createDataFrame([(str(tmp_path / "absent.csv"), True)], "url string, mandatory boolean")
    with pytest.raises(FileNotFoundError):
        IO.read_from_manifest(spark, bad)
    with pytest.raises(FileNotFoundError, match="absent"):
        IO.require_inputs(spark, [pos, str(tmp_path / "absent.csv")])
    df = spark.createDataFrame([(1,)], "a int")
    target = str(tmp_path / "out")
    assert IO.materialize_if_absent(df, target) is True
    assert IO.materialize_if_absent(df, target) is False


def test_listing_latest_run_and_ids(spark, csv_dir):
    files = IO.list_files(spark, str(csv_dir / "run"), "*.csv")
    assert files.count() == 4
    lr = IO.latest_run(files, ["POS.csv", "cosi_embark.csv"]).first()
    assert (lr.latest_complete_run, lr.next_run_id) == (10908, 10909)
    ids = IO.with_file_ids(files.filter(F.col("name") == "cosi_embark.csv")
                           .withColumn("run_id", F.lit(10908)), "path").first()
    assert (ids.file_stem, ids.file_id, ids.dataset_id) == ("cosi_embark", "cosi-embark",
                                                              "cosi-embark-dataset-10908")
    paths = spark.createDataFrame([("s3://bucket/assessments/10908/cosi_embark.csv",), ("bad/path",)], "p string")
    parsed = [(r.bucket, r.run_id, r.file, r.path_error) for r in IO.parse_run_path(paths, "p").collect()]
    assert parsed == [("bucket", "10908", "cosi_embark.csv", False), (None, None, None, True)]


def test_columns_are_bound_by_header_name(spark, tmp_path):
    (tmp_path / "f.csv").write_text("b,extra,a\nBBB,EEE,AAA\n")
    assert [tuple(r) for r in IO.read_table(spark, str(tmp_path / "f.csv"), schema="a string, b string").collect()] == [("AAA", "BBB")]
    contract = {"columns": [{"name": "a", "type": "STRING"}, {"name": "b", "type": "INTEGER"}]}
    assert [tuple(r) for r in K.read_contract(spark, str(tmp_path / "f.csv"), contract).collect()] == [("AAA", None, 1)]
    with pytest.raises(ValueError, match="missing"):
        IO.read_table(spark, str(tmp_path / "f.csv"), schema="a string, c string")
    (tmp_path / "g.csv").write_text("a,extra,b\n1,2,3\n")
    with pytest.raises(Exception):  # two files with different headers
        IO.read_table(spark, [str(tmp_path / "f.csv"), str(tmp_path / "g.csv")], schema="a string, b string").collect()


def test_integers_are_exact(spark):
    df = spark.createDataFrame([("9007199254740993",), ("12.0",), ("12.7",), (" 5 ",), ("",), (None,), ("x",)], "n string")
    c = {"columns": [{"name": "n", "type": "INTEGER"}]}
    assert [tuple(r) for r in K.cast_row(df, c).collect()] == [
        (9007199254740993, 0), (12, 0), (None, 1), (5, 0), (None, 0), (None, 0), (None, 1)]
    typed = K.cast_row(df.select(F.col("n").alias("d")), {"columns": [{"name": "d", "type": "DECIMAL"}]}, decimal_as="decimal")
    assert K.contract_diff(typed, {"columns": [{"name": "d", "type": "DECIMAL"}]}).count() == 0


def test_unfinished_output_is_written_again(spark, tmp_path):
    (tmp_path / "out" / "_temporary").mkdir(parents=True)
    df = spark.range(3)
    assert IO.materialize_missing({str(tmp_path / "out"): df, str(tmp_path / "two"): df}) == [str(tmp_path / "out"), str(tmp_path / "two")]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert IO.materialize_missing({str(tmp_path / "out"): df, str(tmp_path / "two"): df}) == []


def test_write_table_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    IO.write_table(df, str(tmp_path / "t"), partition_by=["k"])
    back = spark.read.option("header", "true").csv(str(tmp_path / "t"))
    assert back.count() == 1 and set(back.columns) == {"v", "k"}
    assert json.loads(json.dumps(K.infer_contract(df, "t")))["name"] == "t"
