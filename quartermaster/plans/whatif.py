"""X25 what-if: class jobs under changed parameters, all scenarios in one plan.

A scenario is a set of parameters, factors by name: a period's label scales
what is required in that period (its days of supply). Every input row is
fanned out to the scenarios before the job, the scenario travels through the job
as part of the run's key, and the results are compared with a base scenario.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.operators.columns import q
from quartermaster.plans import classes as X

SCENARIO, FACTORS, MARK = "scenario", "__factors", "|"


def with_scenarios(df: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Each row once for every scenario of the table (scenario, parameter,
    factor), with the columns ``scenario`` and ``__factors`` (a map). A scenario
    that changes nothing is a row with a null parameter; of repeated parameters
    the largest factor counts. The scenarios are one small value of the plan
    (a list that a user writes down), so there is no join.
    """
    once = scenarios.groupBy(SCENARIO, "parameter").agg(F.max(F.col("factor").cast("double")).alias("factor"))
    pairs = F.collect_list(F.when(F.col("parameter").isNotNull(), F.struct("parameter", "factor")))
    one = once.groupBy(SCENARIO).agg(F.map_from_entries(pairs).alias(FACTORS))
    every = one.agg(F.collect_list(F.struct(SCENARIO, FACTORS)).alias("all")).scalar()
    return df.withColumn("__all", every).select(*[q(c) for c in df.columns], F.inline("__all"))


def factor(name: str) -> Column:
    return F.coalesce(F.try_element_at(FACTORS, F.lit(name)), F.lit(1.0))


def scale_periods(df: DataFrame) -> DataFrame:
    """Every period column (``POS1_...``, ``..._POS1``, ``DOS1_...``, ``BEYOND``) times its period's factor."""
    names = [(label, pos) for pos, dos in zip(X.PERIODS, X.INPUT_PERIODS) for label in dict.fromkeys((pos, dos))]

    def scaled(c: str) -> Column:
        found = [pos for label, pos in names if c == label or c.startswith(label + "_") or c.endswith("_" + label)]
        return (q(c) * factor(found[0])).alias(c) if found else q(c)
    return df.select(*[scaled(c) for c in df.columns])


def what_if(df: DataFrame, scenarios: DataFrame, job: Callable[[DataFrame], DataFrame], run_col: str = "AssessmentNumber") -> DataFrame:
    """``job`` over ``df`` under every scenario: its columns, the run as text, and
    ``scenario``. The job has to keep the run's column (any case) and must not
    mix runs."""
    fanned = scale_periods(with_scenarios(df, scenarios))
    keyed = fanned.withColumn(run_col, F.concat(q(run_col).cast("string"), F.lit(MARK), F.col(SCENARIO))).drop(SCENARIO, FACTORS)
    out = job(keyed)
    run = next(c for c in out.columns if c.upper() == run_col.upper())
    key = q(run)
    return out.withColumns({SCENARIO: F.substring(key, F.length(F.substring_index(key, MARK, 1)) + 2, F.length(key)),
                            run: F.substring_index(key, MARK, 1)})


def compare_scenarios(results: DataFrame, base: str, keys: Sequence[str], measure: str) -> DataFrame:
    """Sums of the measure by ``keys`` and scenario, those of the base scenario, and the difference."""
    return X.compare_runs(results, SCENARIO, base, keys=keys, measure=measure)
