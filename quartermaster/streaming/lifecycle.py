"""Dataset lifecycle: change events -> status state, completeness and refresh gates.

Structured Streaming pieces (T2-T9) and the wiring of X24. State lives in
tables under one base folder (on a cluster: under ``spark.checkpoint.dir``,
a shared file system), so a lost executor or a restarted driver resumes
from the streaming checkpoint and the written tables; replaying a batch
does not change the state (status rows are de-duplicated on read, the
completeness gate keeps an emitted flag per run).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.operators.columns import q

SYNCED_SIGNAL = "DATASETS_SYNCED!"

# Fixed values (must equal the source system's): file name -> job, checked
# in this order; a name matching none of them falls through to the glob.
ROUTES = [
    ("RD_I_POS_Pallet_Requirement.csv", "class_i"),
    ("RD_IW_PaxLocationAll_joined.csv", "class_i_water"),
    ("RD_II_VII_DailyTE_WithDimensions.csv", "class_ii_vii"),
    ("RD_IV_Daily_Requirements.csv", "class_iv"),
    ("RD_VI_POS_Pallet_Requirement.csv", "class_vi"),
    ("RD_IIIP_POL_Pkg_NSN_Requirements_PBI.csv", "class_iiip"),
    ("RD_IX_Requirement.csv", "class_ix"),
    ("AssessmentTable.csv", "period_table"),
    ("POS.csv", "force_flow"),
]
GLOB_ROUTE = ("cos*.csv", "aggregated_embark")
NO_ROUTE = "no_match"

STATUSES = ["File_Received", "Datasource_Created", "Dataset_Created", "Embark_Agg_Processed",
            "Embark_Agg_Ingested", "Datasets_Synced", "Ingest_Complete"]


def state_base(spark: SparkSession, name: str) -> str:
    """A fresh folder for one lifecycle run under the session's shared
    checkpoint folder (set by the cluster; tests set a local one)."""
    from quartermaster.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------------------
# T2 routing
# ---------------------------------------------------------------------------
def route(batch: DataFrame, name_col: str = "file_name", routes: Sequence[tuple[str, str]] = ROUTES,
          glob: tuple[str, str] = GLOB_ROUTE) -> DataFrame:
    """Job for each arriving file: exact name first, then the glob, else
    'no_match' (kept as a row to quarantine, never dropped)."""
    n = q(name_col)
    e = None
    for name, job in routes:
        e = F.when(n == name, F.lit(job)) if e is None else e.when(n == name, F.lit(job))
    pattern = "^" + glob[0].replace(".", r"\.").replace("*", ".*") + "$"
    e = e.when(n.rlike(pattern), F.lit(glob[1])).otherwise(F.lit(NO_ROUTE))
    return batch.withColumn("job", e)


# ---------------------------------------------------------------------------
# T4 lifecycle filter
# ---------------------------------------------------------------------------
def on_status(events: DataFrame, statuses: Sequence[str] | None = None,
              kinds: Sequence[str] = ("INSERT", "MODIFY"), key_prefix: str | None = None) -> DataFrame:
    """Events of the given kinds, optionally with one of ``statuses`` and a
    dataset id starting with ``key_prefix`` (the stream trigger's filter)."""
    cond = F.col("event_name").isin(list(kinds))
    if statuses:
        cond = cond & F.col("status").isin(list(statuses))
    if key_prefix:
        cond = cond & F.col("dataset_id").startswith(key_prefix)
    return events.filter(cond)


# ---------------------------------------------------------------------------
# T3 / W5 status state
# ---------------------------------------------------------------------------
def append_status(batch: DataFrame, path: str) -> None:
    """Append the batch's status changes to the status log (one row per
    (run, dataset, status, time)); the state is derived on read."""
    (batch.select("assessment_id", "dataset_id", "status", "status_timestamp", "sequence")
     .write.mode("append").partitionBy("status").parquet(path))


def status_table(log: DataFrame, statuses: Sequence[str] = STATUSES,
                 previous: DataFrame | None = None) -> DataFrame:
    """Keyed state from the status log: per (run, dataset) the latest status
    and its time (max over a struct: partial aggregation, ties broken by the
    sequence number) and one timestamp column per status. Duplicates from a
    replayed batch collapse.

    ``previous`` is an earlier compacted state (this function's output);
    with it only the log written since then needs reading, because the
    latest status and the per-status maxima combine associatively."""
    if previous is not None:
        seq_type = dict(log.dtypes).get("sequence", "decimal(38,0)")
        stamps = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("status_timestamp")) for s in statuses])
        back = previous.select("assessment_id", "dataset_id", F.inline(stamps)).filter(
            F.col("status_timestamp").isNotNull()).withColumn("sequence", F.lit(None).cast(seq_type))
        log = log.select("assessment_id", "dataset_id", "status", "status_timestamp", "sequence").unionByName(back)
    latest = F.max(F.struct("status_timestamp", "sequence", "status"))
    per = [F.max(F.when(F.col("status") == s, F.col("status_timestamp"))).alias(s) for s in statuses]
    g = log.groupBy("assessment_id", "dataset_id").agg(latest.alias("__l"), *per)
    return g.select("assessment_id", "dataset_id", F.col("__l.status").alias("Status"),
                    F.col("__l.status_timestamp").alias("Status_Timestamp"), *statuses)


def compact_status(log: DataFrame, target: str, statuses: Sequence[str] = STATUSES,
                   previous: DataFrame | None = None) -> DataFrame:
    """Write the current state (from ``previous`` plus the log since) as a
    table under ``target`` (in the shared checkpoint folder on a cluster) and
    return it read back, so later reads start from it instead of the whole
    log."""
    status_table(log, statuses, previous).write.mode("errorifexists").parquet(target)
    return log.sparkSession.read.parquet(target)


# ---------------------------------------------------------------------------
# T5 completeness gate
# ---------------------------------------------------------------------------
def completeness_batch(df: DataFrame, keys: Sequence[str], item_col: str, expected: DataFrame,
                       out_col: str = "n_items") -> DataFrame:
    """Groups that hold every expected item (batch form of the sync gate).

    Rows are first restricted to expected items (semi join against the
    expected set), then distinct items are counted per group and compared to
    the size of the expected set (a scalar subquery).
    """
    exp = expected.select(q(item_col)).distinct()
    n_expected = exp.select(F.count(F.lit(1))).scalar()
    kept = df.join(exp, item_col, "left_semi")
    g = kept.groupBy(*[q(k) for k in keys]).agg(F.count_distinct(q(item_col)).alias(out_col))
    return g.filter(F.col(out_col) == n_expected)


def completeness_gate(events: DataFrame, expected: Sequence[str], key: str = "assessment_id",
                      item: str = "item") -> DataFrame:
    """Streaming gate: emit one row (run, 'DATASETS_SYNCED!', n) the first
    time a run has seen every expected item; never again for that run.

    Events outside the list are dropped before the state step. State per run
    is the set of expected items seen so far, and only the emitted flag once
    the signal is out; ``sync.sync_gate`` also forgets finished runs.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    want = list(dict.fromkeys(expected))
    want_set = set(want)
    out_schema = T.StructType([T.StructField(key, T.StringType()),
                               T.StructField("signal", T.StringType()),
                               T.StructField("n_items", T.IntegerType())])
    state_schema = T.StructType([T.StructField("seen", T.ArrayType(T.StringType())),
                                 T.StructField("emitted", T.BooleanType())])

    def gate(k, pdfs, state):
        import pandas as pd
        if state.exists:
            seen, emitted = set(state.get[0] or []), bool(state.get[1])
        else:
            seen, emitted = set(), False
        for pdf in pdfs:
            seen.update(v for v in pdf[item].tolist() if v in want_set)
        if not emitted and want_set <= seen:
            emitted = True
            yield pd.DataFrame({key: [str(k[0])], "signal": [SYNCED_SIGNAL], "n_items": [len(seen)]})
        state.update(([] if emitted else sorted(seen), emitted))

    src = events.filter(F.col(item).isin(want)).select(F.col(key).cast("string").alias(key), item)
    return src.groupBy(key).applyInPandasWithState(gate, out_schema, state_schema, "append",
                                                   GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------------------
# T6 / T8 refresh gate and audit
# ---------------------------------------------------------------------------
def refresh_if_changed(source: DataFrame, target_path: str, audit_path: str, refresh_id: str,
                       fmt: str = "parquet") -> bool:
    """Rewrite the target from the source only when their row counts differ,
    and append an audit row (id, status, rows). Returns whether it refreshed.

    The two counts are aggregates (a driver receives two numbers); the copy
    is a distributed write to the next version folder under ``target_path``.
    Readers take ``current_version``, the newest finished one, so they never
    see a half-written target.
    """
    spark = source.sparkSession
    n_src = source.count()
    now = current_version(spark, target_path)
    n_dst = None if now is None else spark.read.format(fmt).load(now).count()
    changed = n_dst is None or n_src != n_dst
    if changed:
        number = 1 if now is None else int(now.rsplit("-", 1)[1]) + 1
        source.write.mode("overwrite").format(fmt).save(f"{target_path}/version-{number:09d}")
    audit = spark.createDataFrame(
        [(refresh_id, "REFRESHED" if changed else "UNCHANGED", n_src, n_dst)],
        "refresh_id string, status string, source_rows long, target_rows long")
    append_audit(audit, audit_path)
    return changed


def current_version(spark, target_path: str) -> str | None:
    """Path of the newest finished version under ``target_path``, if any."""
    from quartermaster.sources.io import path_exists
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(target_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    paths = sorted(f"{target_path}/{s.getPath().getName()}" for s in fs.listStatus(root)
                   if s.getPath().getName().startswith("version-"))
    done = [p for p in paths if path_exists(spark, f"{p}/_SUCCESS")]
    return done[-1] if done else None


def append_audit(rows: DataFrame, path: str) -> None:
    rows.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


# ---------------------------------------------------------------------------
# T7 content de-duplication, T9 skip processed
# ---------------------------------------------------------------------------
def dedupe_content(events: DataFrame, content_cols: Sequence[str], time_col: str,
                   delay: str = "10 minutes") -> DataFrame:
    """Drop messages whose content was already seen (a content hash), with
    state bounded by the watermark delay."""
    h = F.sha2(F.to_json(F.struct(*[q(c) for c in content_cols])), 256)
    return (events.withColumn("content_hash", h).withWatermark(time_col, delay)
            .dropDuplicatesWithinWatermark(["content_hash"]))


def skip_processed(events: DataFrame, state: DataFrame, keys: Sequence[str] = ("assessment_id", "dataset_id"),
                   stamp: str = "Dataset_Created") -> DataFrame:
    """Events whose (run, dataset) already carries a processed stamp are
    skipped: a stream-static left anti join against the state table."""
    done = state.filter(q(stamp).isNotNull()).select(*[q(k) for k in keys]).distinct()
    return events.join(done, list(keys), "left_anti")


# ---------------------------------------------------------------------------
# X24 dataset lifecycle (streaming)
# ---------------------------------------------------------------------------
def run_lifecycle(spark: SparkSession, events_dir: str, base: str,
                  expected: Sequence[str], item_expr=None,
                  statuses: Sequence[str] = ("Dataset_Created",),
                  max_files_per_trigger: int | None = 1, gate: bool = True, state_partitions: int | None = None,
                  source: DataFrame | None = None, sync: Mapping | None = None) -> Mapping[str, str]:
    """Replay the change events in ``events_dir`` through the lifecycle:

    1. events of kind INSERT / MODIFY (T4) are appended to the status log
       (T3) by ``foreachBatch``;
    2. events with one of ``statuses`` feed the completeness gate (T5),
       whose signals are appended to the gate table;
    3. with a ``source`` (rows of all runs, by ``assessment_id``) the events
       also feed the sync gate by the source system's rule (``sync_gate``,
       whose options are ``sync``); each batch of its signals is refreshed and
       audited (T6, T8) and its tables are committed together under
       ``published`` (``refresh.publish``).

    ``gate=False`` leaves the second out. ``state_partitions`` sets the
    number of state-store partitions of the gate (a stateful query fixes it
    at its first start; default: the session's shuffle partitions). Both
    queries use ``availableNow`` (process what is there, then stop)
    and their own checkpoint under ``base``, so a rerun resumes instead of
    double-counting. Returns the table paths.
    """
    from quartermaster.streaming.sources import read_events

    paths = {"status_log": os.path.join(base, "status_log"), "gate": os.path.join(base, "gate"),
             "chk_status": os.path.join(base, "_chk_status"), "chk_gate": os.path.join(base, "_chk_gate")}
    ev = on_status(read_events(spark, events_dir, max_files_per_trigger))

    def write_status(batch: DataFrame, batch_id: int) -> None:
        append_status(batch, paths["status_log"])

    q1 = (ev.writeStream.foreachBatch(write_status).option("checkpointLocation", paths["chk_status"])
          .trigger(availableNow=True).start())
    started = [q1]
    if gate:
        created = on_status(read_events(spark, events_dir, max_files_per_trigger), statuses=statuses)
        item_expr = item_expr if item_expr is not None else F.regexp_extract("dataset_id", r"^(.*)-dataset-", 1)
        signals = completeness_gate(created.withColumn("item", item_expr), expected)
        key = "spark.sql.shuffle.partitions"
        before = spark.conf.get(key)
        if state_partitions:
            spark.conf.set(key, str(state_partitions))
        try:
            started.append(signals.writeStream.format("parquet").option("path", paths["gate"])
                           .option("checkpointLocation", paths["chk_gate"]).outputMode("append")
                           .trigger(availableNow=True).start())
        finally:
            spark.conf.set(key, before)
    if source is not None:
        from quartermaster.streaming import refresh
        from quartermaster.streaming.sync import STATE_STORE, sync_gate
        tables = refresh.refresh_tables(spark, base, source)
        paths["published"] = tables.base
        item_expr = item_expr if item_expr is not None else F.regexp_extract("dataset_id", r"^(.*)-dataset-", 1)
        seen = on_status(read_events(spark, events_dir, max_files_per_trigger)).withColumn("item", item_expr)
        settings = STATE_STORE | ({"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {})
        held = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            started.append(sync_gate(seen, expected, SYNCED_SIGNAL, **(sync or {})).writeStream
                           .foreachBatch(refresh.publish(tables, source)).option("checkpointLocation", os.path.join(base, "_chk_publish"))
                           .trigger(availableNow=True).start())
        finally:
            for k, v in held.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    wait_until_done(started)
    return paths


def wait_until_done(started) -> None:
    """Wait until every query has processed all there is. A query that fails
    or was stopped before is an error, and the others are stopped with it."""
    try:
        for s in started:
            s.awaitTermination()  # raises the query's own error
            if s.isActive or s.exception() is not None:
                raise RuntimeError(f"stream {s.name or s.id} did not finish: {s.exception()}")
    finally:
        for s in started:
            if s.isActive:
                s.stop()
