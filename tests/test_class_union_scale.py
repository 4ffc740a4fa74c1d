"""The class union and its roll-up shuffle their lines once, with the same rows on odd keys."""

import duckdb
import pytest

from quartermaster.plans.registry import ORACLE_SQL, QUERIES
from tests.oracle_compare import compare, duck

QUIET = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "4"}


@pytest.fixture
def shuffled(spark):
    """No broadcast joins: small tables would hide the shuffles."""
    before = {k: spark.conf.get(k) for k in QUIET}
    for k, v in QUIET.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def odd_dir(tmp_path_factory):
    """Part keys that share a NIIN (over nine digits), keys and values that are missing or unmatched, repeated parts and
    suppliers, a hot supplier."""
    out = tmp_path_factory.mktemp("odd")
    con = duckdb.connect()
    src = "/root/testdata/sf0.001"
    for name in ["region", "nation", "customer", "orders"]:
        con.execute(f"COPY (SELECT * FROM '{src}/{name}.parquet') TO '{out}/{name}.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT * FROM '{src}/supplier.parquet' UNION ALL SELECT * FROM '{src}/supplier.parquet' WHERE s_suppkey % 4 = 1) "
                f"TO '{out}/supplier.parquet' (FORMAT parquet)")
    big = "CASE WHEN {0} % 5 = 1 THEN 1234567800 + {0} % 100 ELSE {0} END"
    con.execute(f"COPY (SELECT * EXCLUDE (i) REPLACE ({big.format('p_partkey')} AS p_partkey) FROM '{src}/part.parquet' "
                f"CROSS JOIN range(2) c(i) WHERE p_partkey % 11 <> 0 AND (p_partkey % 5 <> 1 OR p_partkey < 100) AND (i = 0 OR p_partkey % 7 = 1)) "
                f"TO '{out}/part.parquet' (FORMAT parquet)")
    con.execute(f"""COPY (SELECT * REPLACE (
        CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE {big.format('l_partkey')} END AS l_partkey,
        CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN 999999 ELSE l_suppkey END AS l_suppkey)
        FROM '{src}/lineitem.parquet') TO '{out}/lineitem.parquet' (FORMAT parquet)""")
    for name in ["events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"COPY (SELECT * FROM '{src}/{name}.parquet' LIMIT 1) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_union_shuffles_its_lines_once(spark, sf_dir, shuffled):
    """Two scans of the lines: one for all classes by part, one for water, which needs no shuffle."""
    steps = final_plan(QUERIES["aggregated_embark"](spark, sf_dir))
    assert steps.count("lineitem.parquet") == 2
    assert "Subquery" not in steps  # class I's check of its keys works its rows out once


@pytest.mark.parametrize("name", ["aggregated_embark", "embark_rollup", "class_i"])
def test_odd_keys_match_the_sql(spark, shuffled, odd_dir, name):
    ok, msg = compare(spark, QUERIES[name], ORACLE_SQL[name], odd_dir, duck(odd_dir))
    assert ok, msg


def above(lines: list[str], at: int, stop: str) -> list[str]:
    """The steps that a step's rows go through next, up to ``stop``, from a plan's indentation."""
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    out, d = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < d:
            d = depth(x)
            if stop in x:
                return out
            out.append(x)
    raise AssertionError(f"no {stop} above {lines[at]}")


def test_rollup_sums_lines_where_their_location_is(spark, sf_dir, shuffled):
    """Rows made of lines (class IX makes 12 of each) are summed to a row per group without a shuffle of their own."""
    steps = final_plan(QUERIES["embark_rollup"](spark, sf_dir))
    assert steps.count("lineitem.parquet") == 2
    lines = steps.splitlines()
    nine = [i for i, x in enumerate(lines) if "Generate inline(array(struct(base, TAMCN_NIIN_QTY" in x]
    assert len(nine) == 1
    path = above(lines, nine[0], "Union")
    assert sum("HashAggregate" in x for x in path) == 2 and not any("Exchange" in x for x in path)


def test_rollup_of_parts_equals_that_of_their_union(spark):
    from quartermaster.operators import relational as R
    a = spark.createDataFrame([("x", "p", 1), ("x", None, 2), (None, "q", 3)], "k string, m string, v bigint")
    b = spark.createDataFrame([("x", "p", 10), ("y", "q", None)], "k string, m string, v bigint")
    got = [sorted(map(str, R.rollup_sums(d, ["k", "m"], {"v": "v"}, count_col="n").collect())) for d in ([a, b], a.unionByName(b))]
    assert got[0] == got[1] and len(got[0]) == 8
