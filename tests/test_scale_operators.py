"""J13 with a key table, W1 without a partition, A2 / A3 in chunks: brute force and plans."""

import random

import pytest
from pyspark.sql import functions as F

from quartermaster.operators import relational as R
from quartermaster.plans.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_contains_join_keys(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab-1é", k=rng.randrange(9))) for _ in range(300)] + [None, "", "aaaaaaaaaa", "aaaaaaaaaa"]
    keys = ["".join(rng.choices("ab-1é", k=rng.randrange(7))) for _ in range(120)] + [None, "", "a", "a", "never there", "aaaa"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(3)
    for gram in (1, 3, 4):
        out = R.contains_join_keys(df, "t", spark.createDataFrame([(k,) for k in keys], "key string"), gram=gram)
        assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)
        got = sorted((r.i, r.t, r.key) for r in out.collect())
        assert got == sorted((i, t, k) for i, t in enumerate(texts) for k in set(keys) if t is not None and k is not None and k in t)
    assert R.contains_join_keys(df, "t", spark.createDataFrame([], "key string")).count() == 0
    assert R.contains_join_keys(df.limit(0), "t", spark.createDataFrame([("a",)], "key string")).count() == 0


def test_contains_join_keys_shuffles_no_pieces_of_texts(spark):
    df = spark.createDataFrame([(i, f"set-{i % 7}-of-{i}") for i in range(500)] + [(500, None)], "i long, t string")
    names = [f"-{i}" for i in range(40)] + ["set-3-of-", "set-3-of-12", "nowhere to be found", ""]
    keys = spark.createDataFrame([(k,) for k in names], "key string")
    want = sorted((i, k) for i in range(500) for k in names if k in f"set-{i % 7}-of-{i}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = R.contains_join_keys(df, "t", keys)
        assert "SortMergeJoin" not in plan(out).split("BroadcastExchange")[0]  # above the keys' side
        assert sorted((r.i, r.key) for r in out.collect()) == want
        assert sorted((r.i, r.key) for r in R.contains_join_keys(df, "t", keys, gram=3, broadcast_pieces=5).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_running_total_without_a_partition(spark):
    rng = random.Random(9)
    rows = [(rng.choice([7, rng.randrange(400)]), rng.choice([None, rng.randrange(-50, 90)])) for _ in range(3000)]  # day 7 is hot
    df = spark.createDataFrame(rows, "day long, x long").repartition(5)
    out = R.running_total(df, "day", "x", "daily", "cum")
    windows = [line for line in plan(out).splitlines() if "Window " in line]
    assert windows and all("__range" in line for line in windows)
    daily = {}
    for d, x in rows:
        daily[d] = daily.get(d, 0) + (x or 0)
    want, total = {}, 0
    for d in sorted(daily):
        total += daily[d]
        want[d] = (daily[d], total)
    assert all((r.daily, r.cum) == want[r.day] for r in out.collect()) and out.count() == len(rows)
    assert R.running_total(df.limit(0), "day", "x", "daily", "cum").count() == 0


def test_lists_of_a_hot_key_in_chunks(spark):
    df = spark.range(0, 60_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                       F.format_string("%06d", F.col("id")).alias("v"), F.when(F.col("id") % 2 == 0, "w").alias("w"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # small ranges would be put together again
    chunks = R.list_chunks(df, "k", ["v", "w"], distinct=True, rows=1000)
    sizes = chunks.filter("column = 'v' AND k = 'hot'").select(F.size(F.split("text", ", ")).alias("n"), "place").collect()
    assert sum(r.n for r in sizes) == 40_000 and max(r.n for r in sizes) <= 1000 and len({r.place for r in sizes}) > 2
    spark.conf.set(key, before)
    got = {r.k: (r.v, r.w) for r in R.list_agg(df, "k", ["v", "w"], distinct={"w"}).collect()}
    assert got["hot"] == (", ".join(f"{i:06d}" for i in range(60_000) if i % 3), "w")
    assert got["k3"][0] == ", ".join(f"{i:06d}" for i in range(0, 60_000, 3) if i % 50 == 3) and got["k3"][1] is None


def test_split_by_position(spark):
    keys = [f"k{i:03d}" for i in range(200)]
    rows = [(k, j) for k in keys for j in range(3)] + [(None, 0)]
    df = spark.createDataFrame(rows, "k string, j int").repartition(4)
    got = {(r.k, r.split) for r in R.split_positions(df, "k", {"a": 85, "b": 15}).collect()}
    assert got == {(k, "a" if i < 170 else "b") for i, k in enumerate(keys)} | {(None, None)}
    assert {r.split for r in R.split_positions(df.filter("k IS NOT NULL"), "k", {"all": 1}).collect()} == {"all"}
    assert R.split_positions(df.limit(0), "k", {"a": 1, "b": 1}).count() == 0


def test_cents_round_like_decimals_without_their_text(spark):
    from quartermaster.functions.scalar import cents, half_up
    rng = random.Random(6)
    values = [None, 0.0, -0.0, 0.5, -0.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 4503599627370495.5, -4503599627370495.5, 1e17, -1e17]
    values += [rng.randrange(-10**7, 10**7) / 2 for _ in range(500)] + [round(rng.uniform(-1e4, 1e4), 2) * 100 for _ in range(500)]
    values += [rng.uniform(-1e5, 1e5) * 10.0 ** rng.randrange(-9, 11) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    assert df.filter(~half_up(F.col("x")).eqNullSafe(F.round("x").cast("bigint"))).count() == 0
    steps = df.select(cents("x").alias("c"))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "floor(" in steps and steps.index("floor(") < steps.index("round(")  # decimals beyond 9e15 only


@pytest.mark.parametrize("name", ["class_ix", "class_ix_long"])
def test_requirement_lines_are_shuffled_once_and_narrow(spark, sf_dir, name):
    """Only the scanned columns of a line go through a shuffle, once, and lines are not sorted."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(QUERIES[name](spark, sf_dir)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(i for i, x in enumerate(lines) if "lineitem.parquet" in x)
    moved = [i for i, x in enumerate(lines[:scan]) if "Exchange" in x]
    assert len(moved) == 1 and not any("SortMergeJoin" in x for x in lines)
    assert not any("Project" in x for x in lines[moved[0]:scan])
