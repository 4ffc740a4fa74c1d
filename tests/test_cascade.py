"""Closure rules, the fixed mapping, and the reference scenarios of available datasets."""

import pytest

from quartermaster.plans.cascade import DATASET_FILTERS, closure, closure_sets, mapping_tables, report_parts
from quartermaster.plans.publish import DATASET_SHEETS, SHEET_ORDER


def kept(spark, seeds, edges):
    s = spark.createDataFrame(seeds, "run long, node string")
    e = spark.createDataFrame(edges, "child string, parent string, need string")
    return {(r.run, r.node, r.level) for r in closure(s, e).collect()}


def test_all_any_circles_and_odd_rows(spark):
    edges = [("b", "a", "all"), ("c", "a", "all"), ("c", "b", "all"), ("c", "b", "all"), ("d", "a", "any"), ("d", "z", "any"),
             ("e", "d", "any"), ("e", "c", "all"), ("f", "z", "all"), ("f", "a", "any"), ("g", "h", "all"), ("h", "g", "all"),
             ("i", "i", "all"), ("j", "a", "all"), ("j", "j", "any"), ("a", "z", "all"), (None, "a", "all"), ("k", None, "all")]
    got = kept(spark, [(1, "a"), (1, "a"), (2, "z"), (3, None), (3, "q")], edges)
    assert got == {(1, "a", 0), (1, "b", 1), (1, "d", 1), (1, "c", 2), (1, "e", 3),
                   (2, "z", 0), (2, "a", 1), (2, "d", 1), (2, "b", 2), (2, "f", 2), (2, "c", 3), (2, "e", 4), (3, "q", 0)}
    assert kept(spark, [], edges) == set()
    assert kept(spark, [(1, "a")], []) == {(1, "a", 0)}


def test_long_chain(spark):
    got = kept(spark, [(1, "n0")], [(f"n{i + 1}", f"n{i}", "all") for i in range(12)])
    assert {(n, lv) for _, n, lv in got} == {(f"n{i}", i) for i in range(13)}


def test_runs_of_a_block_are_one_row(spark):
    """Runs that keep the same nodes in the same rounds are worked out together; those that don't stay apart."""
    edges = [("b", "a", "all"), ("c", "b", "all"), ("c", "z", "all"), ("d", "c", "any"), ("d", "a", "any"), ("e", "d", "all"), ("e", "c", "all")]
    seeds = [(r, "a") for r in range(150)] + [(r, "z") for r in range(0, 150, 3)] + [(r, "b") for r in (5, 70)]
    want = set()
    for r in range(150):
        levels = {"a": 0, "b": 0 if r in (5, 70) else 1, "d": 1}
        if r % 3 == 0:
            levels |= {"z": 0, "c": levels["b"] + 1, "e": levels["b"] + 2}
        want |= {(r, n, lv) for n, lv in levels.items()}
    assert kept(spark, seeds, edges) == want
    sets, _ = closure_sets(spark.createDataFrame(seeds, "run long, node string"), spark.createDataFrame(edges, "child string, parent string, need string"))
    assert sets.count() <= 3 * 8 and sets.groupBy("block", "node", "level").count().filter("count > 1").count() == 0


SCENARIOS = {  # available datasets of a run: class I; IX; IIIP and IV
    1: ["AssessmentParameterDataMapTable", "AssessmentTable", "ForceFlow-joined", "Locations", "POS", "RD-I-POS-Location-joined",
        "RD-I-POS-Pallet-Requirement", "RD-I-Ration-Costs-joined", "aggregated-embark", "cosi-embark", "unknown"],
    2: ["AssessmentParameterDataMapTable", "AssessmentTable", "Locations", "POS", "aggregated-embark", "cosix-embark"],
    3: ["AssessmentTable", "cosiiip-embark", "cosiv-embark"]}


@pytest.mark.parametrize("run", SCENARIOS)
def test_scenarios(spark, run):
    stems = sorted({d for d, _ in DATASET_SHEETS})
    ids = spark.createDataFrame([(s.replace("-", "_"), s) for s in stems], "identifier string, dataset string")
    fields = [("aux", "POS"), ("cost", "cosix_embark"), ("both", "cosix_embark"), ("weight", "cosi_embark")]
    definition = mapping_tables(spark) | {
        "identifiers": ids, "fields": spark.createDataFrame(fields, "field string, identifier string"),
        "field_uses": spark.createDataFrame([("both", "aux")], "field string, uses string"),
        "columns": spark.createDataFrame([("col:a", "cosiv_embark")], "column string, identifier string"),
        "visuals": spark.createDataFrame([("v1", "CL IX RD"), ("v2", "Summary")], "visual string, sheet string"),
        "visual_fields": spark.createDataFrame([("v1", "both"), ("v2", "aux")], "visual string, field string")}
    available = spark.createDataFrame([(r, d) for r, ds in SCENARIOS.items() for d in ds], "assessment_id long, dataset string")
    mine = [r for r in report_parts(available, definition).collect() if r.assessment_id == run]
    by = {}
    for r in mine:
        by.setdefault(r.part, set()).add(r.name)
    have = set(SCENARIOS[run])
    want = {s for d, s in DATASET_SHEETS if d in have}
    assert by["sheet"] == want and [r.name for r in sorted((r for r in mine if r.part == "sheet"), key=lambda r: r.position)] == [
        s for s in SHEET_ORDER if s in want]
    assert by.get("filter", set()) == {f for d, f in DATASET_FILTERS if d in have}
    assert by["identifier"] == {d.replace("-", "_") for d in have if d in stems} and by["dataset"] == have
    pos, nine = "POS" in have, "cosix-embark" in have
    assert by.get("field", set()) == {f for f, ok in (("aux", pos), ("cost", nine), ("both", pos and nine), ("weight", "cosi-embark" in have)) if ok}
    assert by.get("visual", set()) == {v for v, ok in (("v1", pos and nine), ("v2", pos)) if ok}
    assert by.get("column", set()) == ({"col:a"} if "cosiv-embark" in have else set())
