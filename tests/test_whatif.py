"""X25 what-if: the scenario axis through a class job."""

from pyspark.sql import functions as F

from quartermaster.plans import whatif as W

SCHEMA = "scenario string, parameter string, factor double"


def test_scenarios_scale_their_periods_and_differ_from_the_base(spark):
    df = spark.createDataFrame([(1, "a", 10.0, 4.0, None), (2, "a", 1.0, None, 8.0)], "AssessmentNumber long, k string, POS1_Units double, Q_POS2 double, BEYOND double")
    scenarios = spark.createDataFrame([("base", None, None), ("s", "POS1", 0.5), ("s", "POS2", 3.0), ("s", "POS2", 2.0), ("t", "BEYOND", 0.0)], SCHEMA)
    out = W.what_if(df, scenarios, lambda d: d.withColumnRenamed("AssessmentNumber", "ASSESSMENTNUMBER"))
    got = {(r.ASSESSMENTNUMBER, r.scenario): (r.POS1_Units, r.Q_POS2, r.BEYOND) for r in out.collect()}
    assert got == {("1", "base"): (10, 4, None), ("1", "s"): (5, 12, None), ("1", "t"): (10, 4, None),
                   ("2", "base"): (1, None, 8), ("2", "s"): (0.5, None, 8), ("2", "t"): (1, None, 0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0]
    diff = W.compare_scenarios(out, "base", ["k"], "POS1_Units")
    assert {r.scenario: r.diff_POS1_Units for r in diff.collect()} == {"base": 0, "s": -5.5, "t": 0}


def test_without_scenarios_or_rows(spark):
    df = spark.createDataFrame([(1, 10.0)], "AssessmentNumber long, POS1_Units double")
    none = spark.createDataFrame([], SCHEMA)
    assert W.what_if(df, none, lambda d: d).count() == 0
    one = spark.createDataFrame([("base", None, None)], SCHEMA)
    assert W.what_if(df.limit(0), one, lambda d: d).count() == 0
    assert W.what_if(df, one, lambda d: d).select(F.sum("POS1_Units")).first()[0] == 10
