"""T6 and T8 inside the lifecycle: what a batch of sync signals refreshes.

All runs of a micro-batch are handled by one job: their rows in the source are
counted, the counts are compared with what was refreshed last, runs that
differ are copied, and every run gets an audit row. The tables of a batch
are committed together (``BatchTables``), so a repeated batch neither
refreshes nor audits twice. Counts alone decide, as in the source system: a
source that changed without changing its number of rows isn't copied.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.streaming.commit import BatchTables
from quartermaster.streaming.sync import SIGNALS

#: Fixed values (must equal the source system's): dataset stems whose signals
#: refresh, and the status of a refreshed run.
REFRESHED_STEMS = ("cos", "aggregated")
INGESTED = "INGEST_COMPLETE"
AUDIT = "assessment_id string, dataset_id string, refresh_id string, status string, source_rows bigint, target_rows bigint, logged_at timestamp"
STATUS = "assessment_id string, dataset_id string, status string, status_timestamp timestamp, sequence decimal(38,0)"


def refresh_tables(spark: SparkSession, base: str, source: DataFrame) -> BatchTables:
    return BatchTables(spark, os.path.join(base, "published"), {
        "signals": SIGNALS, "audit": AUDIT, "status": STATUS, "target": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)})


def refreshed(tables: BatchTables) -> DataFrame:
    """The last refresh of each run: assessment_id, batch_id, target_rows."""
    audit = tables.read("audit").filter("status = 'REFRESHED'")
    return audit.groupBy("assessment_id").agg(F.max("batch_id").alias("batch_id"), F.max_by("source_rows", "batch_id").alias("target_rows"))


def current_target(tables: BatchTables, run_col: str = "assessment_id") -> DataFrame:
    """The published rows: of each run those of its last refresh."""
    last = refreshed(tables).select(F.col("assessment_id").alias("__run"), F.col("batch_id").alias("__batch"))
    rows = tables.read("target")
    kept = rows.join(last, (rows[run_col].cast("string") == F.col("__run")) & (rows["batch_id"] == F.col("__batch")), "left_semi")
    return kept.drop("batch_id")


def publish(tables: BatchTables, source: DataFrame, run_col: str = "assessment_id", stem: str = "aggregated-embark",
            stems: Sequence[str] = REFRESHED_STEMS):
    """The ``foreachBatch`` function of a stream of signals (``SIGNALS``).

    Statuses in the audit: REFRESHED, UNCHANGED (as many rows as at the last
    refresh), NO_DATASET (the source has no rows of the run). A refreshed run
    also gets a status row.
    """
    run = source[run_col].cast("string")

    def work(batch: DataFrame, batch_id: int) -> None:
        signals = tables.write("signals", batch_id, batch)
        runs = signals.select("assessment_id").distinct()
        if not stem.startswith(tuple(stems)):
            runs = runs.limit(0)
        counts = source.join(runs, run == runs["assessment_id"], "left_semi").groupBy(run.alias("assessment_id")).agg(
            F.count(F.lit(1)).alias("source_rows"))
        last = refreshed(tables).drop("batch_id")
        status = F.when(F.col("source_rows").isNull(), F.lit("NO_DATASET")).when(
            F.col("source_rows") == F.col("target_rows"), F.lit("UNCHANGED")).otherwise(F.lit("REFRESHED"))
        dataset = F.concat(F.lit(f"{stem}-dataset-"), F.col("assessment_id"))
        audit = runs.join(counts, "assessment_id", "left").join(last, "assessment_id", "left").select(
            "assessment_id", dataset.alias("dataset_id"), F.concat(F.lit(f"{batch_id}-"), "assessment_id").alias("refresh_id"),
            status.alias("status"), "source_rows", "target_rows", F.current_timestamp().alias("logged_at"))
        changed = tables.write("audit", batch_id, audit).filter("status = 'REFRESHED'")
        tables.write("target", batch_id, source.join(changed, run == changed["assessment_id"], "left_semi"))
        at = signals.groupBy("assessment_id").agg(F.max("signal_at").alias("signal_at"))
        tables.write("status", batch_id, changed.join(at, "assessment_id").select(
            "assessment_id", "dataset_id", F.lit(INGESTED).alias("status"), F.col("signal_at").alias("status_timestamp"),
            F.lit(batch_id).cast("decimal(38,0)").alias("sequence")))

    return tables.once(work)
