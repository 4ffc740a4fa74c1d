"""Every file in exactly one sink, quarantine reasons, repeated batches."""

import json

from quartermaster.streaming import dispatch as D


def notice(*keys):
    return json.dumps({"Records": [{"eventName": "ObjectCreated:Put", "eventTime": "2024-08-08 19:00:00",
                                    "s3": {"bucket": {"name": "b"}, "object": {"key": k, "size": 1}}} for k in keys]})


def test_each_file_has_one_sink_and_a_rerun_adds_only_what_is_new(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path / "base")
    folder.mkdir()
    (folder / "1.json").write_text("\n".join([
        notice("assessments/9001/a+b/POS.csv", "assessments/9001/cosvi_embark.csv", "assessments/9001/Locations.csv"),
        notice("assessments/9002/x_RD_I__Input.zip", "assessments/9002/RD_IX_Requirement_Trimmed.csv", "POS.csv", "assessments/9002/POS.csv.bak"),
        notice("assessments/9002/RD_IX_Requirement.csv"), notice(), "not json", "{}"]))
    D.run_dispatch(spark, str(folder), base)
    tables = D.dispatch_tables(spark, base)
    got = sorted(((r.object_key, r.sink, r.reason, r.dataset_id) for r in tables.read("sinks").collect()), key=str)
    assert got == sorted([
        ("assessments/9001/a b/POS.csv", "force_flow", None, "POS-dataset-9001"),
        ("assessments/9001/cosvi_embark.csv", "aggregated_embark", None, "cosvi-embark-dataset-9001"),
        ("assessments/9001/Locations.csv", "received", None, "Locations-dataset-9001"),
        ("assessments/9002/x_RD_I__Input.zip", "unpack", None, "x-RD-I--Input-dataset-9002"),
        # announced under another name than the job waits for, and the other way round
        ("assessments/9002/RD_IX_Requirement_Trimmed.csv", "quarantine", "not_announced", "RD-IX-Requirement-Trimmed-dataset-9002"),
        ("assessments/9002/RD_IX_Requirement.csv", "received", None, "RD-IX-Requirement-dataset-9002"),
        ("POS.csv", "quarantine", "no_run", None),
        ("assessments/9002/POS.csv.bak", "quarantine", "not_announced", "POS.csv-dataset-9002"),
        (None, "quarantine", "unreadable", None), (None, "quarantine", "unreadable", None), (None, "quarantine", "unreadable", None)], key=str)
    assert D.sink_rows(tables, "force_flow").count() == 1 and D.sink_rows(tables, "none").count() == 0
    assert {r.dataset_id for r in tables.read("status").collect()} == {
        "POS-dataset-9001", "cosvi-embark-dataset-9001", "Locations-dataset-9001", "RD-IX-Requirement-dataset-9002"}
    D.run_dispatch(spark, str(folder), base)
    assert tables.read("sinks").count() == len(got)
    (folder / "2.json").write_text(notice("assessments/9003/POS.csv"))
    D.run_dispatch(spark, str(folder), base)
    assert tables.read("sinks").count() == len(got) + 1


def test_a_batch_run_again_is_written_once(spark, tmp_path):
    (tmp_path / "1.json").write_text(notice("assessments/1/POS.csv", "assessments/1/odd.csv"))
    files = D.read_notices(spark, str(tmp_path / "1.json"), stream=False)
    tables = D.dispatch_tables(spark, str(tmp_path / "base"))
    tables.write("sinks", 0, D.routed_arrivals(files), by="sink")  # a first attempt that ended before its commit
    assert tables.read("sinks").count() == 0
    for _ in range(2):
        D.dispatch(tables)(files, 0)
    assert sorted(r.sink for r in tables.read("sinks").collect()) == ["force_flow", "quarantine"]
    assert tables.read("status").count() == 1


def test_a_route_missing_for_a_job_file(spark, tmp_path):
    (tmp_path / "1.json").write_text(notice("assessments/1/new.csv"))
    files = D.read_notices(spark, str(tmp_path / "1.json"), stream=False)
    row = D.routed_arrivals(files, suffixes=["new.csv"], job_files=["new.csv"]).first()
    assert (row.sink, row.reason) == ("quarantine", "no_route")
