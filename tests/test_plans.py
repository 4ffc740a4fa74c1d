"""Plan guards over every registered query: no cross joins and no
nested-loop joins; scans of the wide fact tables read only the columns
the query needs."""

import re

import pytest

from quartermaster.plans.registry import QUERIES

# the streaming replays and the model fit run jobs while they are built;
# their plans are covered by the streaming and dimension tests
SKIP = {"stream_lifecycle", "stream_status_state", "impute_measure"}
WIDE = {"lineitem": 11, "orders": 6, "part": 6, "events": 6, "documents": 5, "pages": 3}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_plan_has_no_cross_or_nested_loop_join(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


# queries that use a subset of a wide table's columns: the scan must read
# only that subset (column pruning reached the Parquet reader)
PRUNED = {"class_i": ("lineitem", 4), "rollup_measures": ("lineitem", 4),
          "partition_totals": ("lineitem", 6), "catalog_summary": ("lineitem", 3),
          "unpivot_measures": ("lineitem", 5), "cast_contract": ("events", 4),
          "list_agg_distinct": ("events", 2)}


@pytest.mark.parametrize("name", sorted(PRUNED))
def test_scans_read_only_needed_columns(spark, sf_dir, name):
    table, needed = PRUNED[name]
    plan = _plan(QUERIES[name](spark, sf_dir))
    scans = re.findall(rf"FileScan parquet \[([^\]]*)\][^\n]*{table}\.parquet", plan)
    assert scans, f"{name}: no scan of {table}"
    for cols in scans:
        n = len([c for c in cols.split(",") if c.strip()])
        assert n <= needed < WIDE[table], f"{name}: reads {n} columns of {table}"
