"""Null rules N1-N13: each pinned on a hand-made frame (expected values
worked out by hand from the rule)."""

import math

import pytest
from pyspark.sql import functions as F

from quartermaster.functions import nulls as N
from quartermaster.functions.scalar import cube_feet, lookup, numeric_hash, text_bool
from quartermaster.operators import columns as C
from quartermaster.operators import relational as R
from quartermaster.operators import reshape as S


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_n1_nan_becomes_null_and_is_not_positive(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0), (3, None)], "k int, x double")
    clean = N.clean_nan(df)
    assert sorted(rows(clean.filter(F.col("x") > 0), "k")) == [(2,)]
    assert rows(clean.orderBy("k"), "x") == [(None,), (3.0,), (None,)]
    # keep_positive drops NaN even without cleaning
    assert rows(C.keep_positive(df, "x"), "k") == [(2,)]


def test_n2_cast_failures_are_null_and_counted(spark):
    from quartermaster.sources.contract import apply_casts
    df = spark.createDataFrame([("12", "1.5", "a"), (" 7.0 ", "x", "b"), ("", None, "c")],
                               "n string, d string, s string")
    c = {"columns": [{"name": "n", "type": "INTEGER"}, {"name": "d", "type": "DECIMAL"},
                     {"name": "s", "type": "STRING"}]}
    out = apply_casts(df, c).orderBy("s").collect()
    assert [(r.n, r.d, r._bad_cells) for r in out] == [(12, 1.5, 0), (7, None, 1), (None, None, 0)]


def test_n3_null_keys_match_only_when_asked(spark):
    l = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    r = spark.createDataFrame([(None, 10), (2, 20)], "k int, b int")
    assert R.join_on(l, r, "k").count() == 1
    both = R.join_on(l, r, "k", match_nulls=True).orderBy("a").collect()
    assert [(x.k, x.a, x.b) for x in both] == [(None, 1, 10), (2, 2, 20)]


def test_n4_strict_max_propagates_null(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, 1.0)], "a double, b double")
    assert rows(df.select(N.max_strict("a", "b").alias("m")), "m") == [(None,), (2.0,)]


def test_n5_all_null_group_sums_to_zero_and_n6_null_key_dropped(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0), (None, 5.0)], "k string, x double")
    out = sorted(rows(R.group_sum(df, "k", ["x"]), "k", "x"))
    assert out == [("a", 0.0), ("b", 2.0)]


def test_n7_strict_pivot_fails_on_duplicate_cell(spark):
    df = spark.createDataFrame([(1, "m", 1.0), (1, "m", 2.0)], "k int, p string, v double")
    with pytest.raises(Exception, match="duplicate"):
        S.pivot_strict(df, ["k"], "p", ["m"], "v").collect()
    ok = spark.createDataFrame([(1, "m", 1.0), (None, "m", 2.0)], "k int, p string, v double")
    # NULL index keys are kept by DataFrame.pivot
    assert sorted(rows(S.pivot_strict(ok, ["k"], "p", ["m"], "v"), "m")) == [(1.0,), (2.0,)]


def test_n8_first_non_null_in_row_order_and_all_null_rows_vanish(spark):
    df = spark.createDataFrame(
        [(1, "a", None, 1), (1, "a", 5.0, 2), (1, "a", 7.0, 3), (1, "b", 9.0, 0),
         (2, "a", None, 4), (None, "a", 3.0, 5)], "k int, p string, v double, rid int")
    out = S.pivot_first(df, ["k"], "p", ["a", "b"], "v", "rid").collect()
    assert [(r.k, r.a, r.b) for r in out] == [(1, 5.0, 9.0)]


def test_n9_melt_keeps_null_values(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "k int, x double, y double")
    assert sorted(rows(S.melt(df, ["k"], ["x", "y"], "var", "val"), "var", "val")) == [
        ("x", None), ("y", 2.0)]


def test_n10_regex_miss_is_null(spark):
    df = spark.createDataFrame([("POS1_Units",), ("Other",)], "m string")
    assert rows(df.select(N.extract_or_null("m", r"(POS\d)", 1).alias("p")), "p") == [("POS1",), (None,)]


def test_n11_divide_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double")
    assert rows(df.select(N.safe_div("a", "b").alias("r")), "r") == [(None,), (2.0,)]


def test_n12_comparison_with_null_drops_row(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0)], "k int, x double")
    assert rows(df.filter(F.col("x") > 0), "k") == [(2,)]


def test_n13_niin_text_keeps_leading_zero(spark):
    df = spark.createDataFrame([("013689154",), ("13689154",)], "n string")
    assert rows(df, "n") == [("013689154",), ("13689154",)]
    padded = df.select(F.lpad("n", 9, "0").alias("p")).distinct().count()
    assert padded == 1


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("TRUE", "X"), ("false", "MEALS_READY_TO_EAT_MRE"), ("yes", None)],
                               "b string, t string")
    out = df.select(text_bool("b").alias("b"),
                    lookup("t", {"MEALS_READY_TO_EAT_MRE": 119.03}, 0.0).alias("c")).collect()
    assert [(r.b, r.c) for r in out] == [(True, 0.0), (False, 119.03), (None, 0.0)]
    h = spark.createDataFrame([("abc",)], "s string").select(numeric_hash("s").alias("h")).first().h
    import hashlib
    digits = "".join(ch for ch in hashlib.sha256(b"abc").hexdigest() if ch.isdigit())
    assert h == digits[-12:]


def test_cube_feet_sentinels(spark):
    df = spark.createDataFrame([(12.0, 12.0, 24.0, 1.0), (0.0, 12.0, 12.0, 0.5),
                                (9999.0, 1.0, 1.0, 0.25), (12.0, 12.0, 12.0, None)],
                               "l double, w double, h double, c double")
    out = rows(df.select(cube_feet("l", "w", "h", "c").alias("v")), "v")
    assert out == [(2.0,), (0.5,), (0.25,), (None,)]
    assert not math.isnan(out[0][0])
