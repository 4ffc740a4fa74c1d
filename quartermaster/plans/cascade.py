"""Which parts of a report definition each run can keep.

A definition's parts depend on each other: an identifier on its dataset, a
calculated field on its identifier and on the fields it uses, a visual on its
sheet and its fields, a sheet or a filter group on any of the datasets mapped to
it, a column configuration on its identifier. The parts a run keeps are the
closure of its available datasets under these edges, worked out for all runs at
once in rounds: each round joins only what the last one added.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.operators.relational import prefix_sum
from quartermaster.plans.publish import DATASET_SHEETS, SHEET_ORDER
from quartermaster.session import cut

# Fixed values (must equal the source system's): the filter groups that a
# dataset's sheet brings along.
DATASET_FILTERS = [
    ("ForceFlow-joined", "89c9153a-994b-4b7d-b21e-ddeb72130861"),
    ("cosix-embark", "0f649f1f-dd14-449f-8348-7fc23438c546"),
    ("cosix-embark", "d9806060-95bb-4e36-bf8a-a940b61ba7ab"),
]

ALL, ANY = "all", "any"
PARTS = ("dataset", "identifier", "sheet", "field", "visual", "filter", "column")


def closure(seeds: DataFrame, edges: DataFrame, run_col: str = "run") -> DataFrame:
    """The least set of (run, node, level) that holds the seeds (run, node) and
    every node whose needs are met in the run.

    ``edges`` (child, parent, need): a node needs all its parents of need 'all',
    and one of those of need 'any' if it has such. ``level`` is the round in
    which it was added (seeds: 0). Nodes that need each other in a circle are
    not added. Repeated edges and seeds count once; null nodes are left out.
    """
    kept, expand = closure_sets(seeds, edges, run_col)
    return expand(kept)


def closure_sets(seeds: DataFrame, edges: DataFrame, run_col: str = "run") -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The closure as (block, node, level, mask): 64 runs are a block, a run a bit
    of its mask, so runs that keep the same node in the same round are one row
    from the first round to the last. And the function that makes a row for each run of
    such rows (block and mask become the run; other columns stay)."""
    edges = edges.select("child", "parent", "need").distinct().filter("child IS NOT NULL AND parent IS NOT NULL")
    is_all = (F.col("need") == ALL).cast("bigint")
    needs = edges.groupBy("child").agg(F.sum(is_all).alias("need_all"), F.sum(1 - is_all).alias("need_any"))
    seeds = seeds.select(F.col(run_col).alias("run"), "node").filter("node IS NOT NULL").distinct()
    given = seeds.select(F.col("node").alias("child"), F.lit(True).alias("given")).distinct()
    # a run meets the only edge of a node once; the others' edges are gathered
    lone = (F.col("need_all") + F.col("need_any") == 1) & F.col("given").isNull()
    edges = cut(edges.join(needs, "child").join(given, "child", "left").select("child", "parent", is_all.alias("is_all"), "need_all", "need_any", lone.alias("lone")))
    place = prefix_sum(seeds.select("run").distinct().withColumn("__one", F.lit(1)), "run", "__one", "__at").select("run", (F.col("__at") - 1).alias("__at"))
    runs = cut(place.select("run", F.floor(F.col("__at") / 64).alias("block"), F.pmod("__at", F.lit(64)).cast("int").alias("bit")))
    numbered = seeds.join(runs, seeds["run"].eqNullSafe(runs["run"])).groupBy("block", "node").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    new, level = cut(numbered), 0
    kept = new.withColumn("level", F.lit(0))
    # what a node has of its parents (and, without a parent, which runs keep it): one row for each edge that was met
    state = new.join(edges.filter("NOT lone").select(F.col("child").alias("node"), "need_all", "need_any").distinct(), "node").select(
        "block", F.col("node").alias("child"), "need_all", "need_any", F.lit(None).cast("string").alias("parent"), F.lit(-1).cast("bigint").alias("is_all"), "mask")
    of = lambda kind: F.when(F.col("is_all") == kind, F.col("mask"))
    all_met = F.when(F.col("need_all") == 0, F.lit(-1)).when(F.col("n_all") == F.col("need_all"), F.col("m_all")).otherwise(F.lit(0))
    any_met = F.when(F.col("need_any") == 0, F.lit(-1)).otherwise(F.coalesce("m_any", F.lit(0)))
    added = all_met.bitwiseAND(any_met).bitwiseAND(F.bitwise_not(F.coalesce("m_kept", F.lit(0).cast("bigint"))))
    while True:
        level += 1
        got = new.join(edges, F.col("node") == F.col("parent")).select("block", "child", "need_all", "need_any", "parent", "is_all", "mask", "lone")
        alone, got = got.filter("lone").drop("lone", "parent", "is_all").withColumn("more", F.lit(False)), got.filter("NOT lone").drop("lone")
        whose = ["block", "child", "need_all", "need_any"]
        state = cut(state.unionByName(got).repartition("block", "child").groupBy(*whose, "parent", "is_all").agg(F.bit_or("mask").alias("mask")))
        met = state.groupBy(*whose).agg(F.count(of(1)).alias("n_all"), F.bit_and(of(1)).alias("m_all"), F.bit_or(of(0)).alias("m_any"),
                                        F.bit_or(of(-1)).alias("m_kept")).select(*whose, added.alias("mask")).filter("mask <> 0").withColumn("more", F.lit(True))
        new = cut(met.unionByName(alone))
        if new.isEmpty():
            break
        state = state.unionByName(new.filter("more").select(*whose, F.lit(None).cast("string").alias("parent"), F.lit(-1).cast("bigint").alias("is_all"), "mask"))
        new = new.select("block", F.col("child").alias("node"), "mask")
        kept = kept.unionByName(new.withColumn("level", F.lit(level)))

    members = runs.groupBy("block").agg(F.collect_list(F.struct("bit", "run")).alias("__runs"))  # 64 at most

    def expand(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in ("block", "mask")]
        found = F.filter("__runs", lambda r: F.call_function("getbit", F.col("mask"), r["bit"]) == 1)
        out = rows.join(members, "block").select(*others, F.explode(found).alias("__run"))
        return out.select(F.col("__run.run").alias(run_col), *others)

    return kept, expand


def node(part: str, name) -> F.Column:
    return F.concat(F.lit(f"{part}:"), name)


def mapping_tables(spark) -> dict[str, DataFrame]:
    """The fixed mapping of datasets to sheets and filter groups as tables."""
    return {"sheets": spark.createDataFrame(DATASET_SHEETS, "dataset string, sheet string"),
            "filters": spark.createDataFrame(DATASET_FILTERS, "dataset string, filter string")}


def definition_edges(definition: Mapping[str, DataFrame]) -> DataFrame:
    """Edges of a report definition given as tables:

    identifiers (identifier, dataset), sheets (sheet, dataset), filters (filter,
    dataset), fields (field, identifier), field_uses (field, uses), visuals
    (visual, sheet), visual_fields (visual, field), columns (column,
    identifier). Tables that are absent have no edges.
    """
    shapes = [("identifiers", "identifier", "identifier", "dataset", "dataset", ALL), ("sheets", "sheet", "sheet", "dataset", "dataset", ANY),
              ("filters", "filter", "filter", "dataset", "dataset", ANY), ("fields", "field", "field", "identifier", "identifier", ALL),
              ("field_uses", "field", "field", "field", "uses", ALL), ("visuals", "visual", "visual", "sheet", "sheet", ALL),
              ("visual_fields", "visual", "visual", "field", "field", ALL), ("columns", "column", "column", "identifier", "identifier", ALL)]
    out = None
    for table, part, col, parent_part, parent_col, need in shapes:
        if table in definition:
            e = definition[table].select(node(part, F.col(col)).alias("child"), node(parent_part, F.col(parent_col)).alias("parent"), F.lit(need).alias("need"))
            out = e if out is None else out.unionByName(e)
    return out


def report_parts(available: DataFrame, definition: Mapping[str, DataFrame], run_col: str = "assessment_id") -> DataFrame:
    """(run, part, name, level, position) of everything a run keeps, its
    datasets included. ``available`` holds (run, dataset); ``position`` is a
    sheet's place in the report, null for the other parts."""
    seeds = available.select(run_col, node("dataset", F.col("dataset")).alias("node"))
    kept, expand = closure_sets(seeds, definition_edges(definition), run_col)
    part = F.substring_index("node", ":", 1)
    kept = kept.select("block", "mask", part.alias("part"), F.substring(F.col("node"), F.length(part) + 2, F.length("node")).alias("name"), "level")
    position = F.array_position(F.array(*[F.lit(s) for s in SHEET_ORDER]), F.col("name")).cast("int")
    return expand(kept.withColumn("position", F.when((F.col("part") == "sheet") & (position > 0), position)))
