"""Property checks on generated frames (hypothesis): reshaping round trips,
per-key operators and the decimal-repair search against brute force."""

import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quartermaster.operators import relational as R
from quartermaster.operators import reshape as S
from quartermaster.plans import dimensions as D

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

values = st.one_of(st.none(), st.integers(-50, 50).map(float))


@SETTINGS
@given(st.lists(st.tuples(values, values, values), min_size=1, max_size=12))
def test_melt_then_strict_pivot_is_identity(spark, rows):
    data = [(i,) + r for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, a double, b double, c double")
    back = S.pivot_strict(S.melt(df, ["k"], ["a", "b", "c"], "n", "v"), ["k"], "n", ["a", "b", "c"], "v")
    assert sorted(tuple(r) for r in back.select("k", "a", "b", "c").collect()) == sorted(data)


keyed = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]),
                           st.integers(0, 10_000), st.sampled_from(["x", "y", "z", None])),
                 min_size=1, max_size=40, unique_by=lambda t: t[1])


@SETTINGS
@given(keyed)
def test_list_agg_and_first_per_key_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, o long, v string")
    got = {r.k: r.v for r in R.list_agg(df, "k", ["v"]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        vals = sorted(v for kk, _, v in rows if kk == k and v is not None)
        want[k] = ", ".join(vals) if vals else None
    assert got == want
    first = {r.k: (r.o, r.v) for r in R.first_per_key(df, "k", "o").collect()}
    for k in want:
        o, v = min(((o, v) for kk, o, v in rows if kk == k), key=lambda t: t[0])
        assert first[k] == (o, v)


def _brute_placement(l, w, h, cf, tol=1e-3):
    def cands(x):
        n = len(str(x))
        return [x / 10.0 ** (n - i) for i in range(1, n + 1)]
    for a, b, c in itertools.product(cands(l), cands(w), cands(h)):
        if abs(a * b * c / 1728 - cf) < tol:
            return (a, b, c)
    return (None, None, None)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 9999), st.integers(1, 9999), st.integers(1, 9999),
                          st.floats(0.001, 50.0)), min_size=1, max_size=10))
def test_decimal_repair_matches_nested_search(spark, rows):
    data = [(i,) + r for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, l long, w long, h long, cf double")
    out = {r.id: (r.l_new, r.w_new, r.h_new) for r in D.repair_dimensions(df, "l", "w", "h", "cf").collect()}
    for i, l, w, h, cf in data:
        assert out[i] == _brute_placement(l, w, h, cf)
