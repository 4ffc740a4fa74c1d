"""Registered streaming queries: the dataset lifecycle replayed over change
events derived from the ``events`` table.

A user is a run, an event type a dataset ('error' events only mark the file
as received, the others create the dataset), small values are REMOVE events
that the lifecycle ignores. The derived events are written as JSON lines
(time-ordered files, as many as the shuffle makes) under the session's
checkpoint folder and replayed with ``availableNow``, some files per
micro-batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.plans.table_queries import ORACLE_SQL, QUERIES, register, t
from quartermaster.streaming import dispatch as D
from quartermaster.streaming import lifecycle as L
from quartermaster.streaming.sources import change_event

__all__ = ["QUERIES", "ORACLE_SQL"]

CREATED_TYPES = ["click", "purchase", "signup", "view"]
GATE_SCHEMA = "assessment_id string, signal string, n_items int"


def json_in_order(ev: DataFrame, rec) -> DataFrame:
    """Change events as JSON lines (value), each partition a range of time. The
    narrow rows are dealt out first, as their scan may have one task: dealing
    takes a pass for its sample, which would make the JSON twice."""
    dealt = ev.select("ts", "event_id", "user_id", "event_type", "value").repartitionByRange("ts")
    return dealt.select(F.to_json(rec).alias("value"))


def write_change_events(spark, sf_dir, path: str) -> str:
    status = F.when(F.col("event_type") == "error", F.lit("File_Received")).otherwise(F.lit("Dataset_Created"))
    kind = (F.when(F.col("value") < 5, F.lit("REMOVE")).when(F.col("value") > 50, F.lit("MODIFY"))
            .otherwise(F.lit("INSERT")))
    rec = change_event(F.col("user_id"), F.concat_ws("-dataset-", "event_type", F.col("user_id").cast("string")),
                       status, F.col("ts"), kind, F.col("event_id"), F.col("event_id"))
    json_in_order(t(spark, sf_dir, "events"), rec).write.mode("errorifexists").text(path)
    return path


def _replay(spark, sf_dir, gate: bool = True):
    base = L.state_base(spark, "qm-lifecycle")
    events_dir = write_change_events(spark, sf_dir, os.path.join(base, "events"))
    return L.run_lifecycle(spark, events_dir, base, CREATED_TYPES, gate=gate, max_files_per_trigger=32,
                           state_partitions=spark.sparkContext.defaultParallelism)


@register("stream_lifecycle", f"""
SELECT CAST(user_id AS VARCHAR) AS assessment_id, '{L.SYNCED_SIGNAL}' AS signal,
       CAST(count(DISTINCT event_type) AS INTEGER) AS n_items
FROM events WHERE event_type IN ({", ".join(f"'{x}'" for x in CREATED_TYPES)}) AND value >= 5
GROUP BY user_id HAVING count(DISTINCT event_type) = {len(CREATED_TYPES)}
""")
def q_stream_lifecycle(spark, sf_dir) -> DataFrame:
    paths = _replay(spark, sf_dir)
    return spark.read.schema(GATE_SCHEMA).parquet(paths["gate"])


@register("stream_status_state", """
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS assessment_id,
                  event_type || '-dataset-' || CAST(user_id AS VARCHAR) AS dataset_id,
                  CASE WHEN event_type = 'error' THEN 'File_Received' ELSE 'Dataset_Created' END AS status,
                  ts, event_id FROM events WHERE value >= 5)
SELECT assessment_id, dataset_id, arg_max(status, (ts, event_id)) AS Status,
       epoch_us(max(ts)) AS Status_Timestamp_us,
       epoch_us(max(ts) FILTER (WHERE status = 'File_Received')) AS File_Received_us,
       epoch_us(max(ts) FILTER (WHERE status = 'Dataset_Created')) AS Dataset_Created_us
FROM e GROUP BY assessment_id, dataset_id
""")
def q_stream_status_state(spark, sf_dir) -> DataFrame:
    paths = _replay(spark, sf_dir, gate=False)
    log = spark.read.parquet(paths["status_log"])
    st = L.status_table(log, ["File_Received", "Dataset_Created"])
    return st.select("assessment_id", "dataset_id", "Status",
                     F.unix_micros("Status_Timestamp").alias("Status_Timestamp_us"),
                     F.unix_micros("File_Received").alias("File_Received_us"),
                     F.unix_micros("Dataset_Created").alias("Dataset_Created_us"))


# ---------------------------------------------------------------------------
# T5 by the source's rule, T6 and T8 inside the lifecycle
# ---------------------------------------------------------------------------
SYNC_ITEMS = [f"{kind}-{i}" for kind in ("click", "error", "purchase", "signup", "view") for i in range(2)]
DELAY_S, KEEP_S, LATE_S = 43_200, 10 * 365 * 86_400, 600
_SYNC_EVENTS = """
e AS MATERIALIZED (SELECT CAST(user_id AS VARCHAR) AS run, event_type || '-' || (event_id % 2) AS item,
                          floor(value) % 2 = 1 AS made, epoch_us(ts) // 1000 AS ms FROM events WHERE value >= 5),
first AS MATERIALIZED (SELECT run, item, min(ms) FILTER (NOT made) AS f, min(ms) FILTER (made) AS d FROM e GROUP BY run, item),
ends AS (SELECT run, max(ms) AS last, (SELECT max(ms) FROM e) AS newest FROM e GROUP BY run)"""


def _looks(times: str) -> str:
    """SQL: what the items of a run are at each of its look times."""
    return f"""SELECT t.run, t.tm, count(*) FILTER (f <= t.tm AND d <= t.tm) AS n_matched, count(*) FILTER (f <= t.tm OR d <= t.tm) AS n_there,
       count(*) FILTER (coalesce(f <= t.tm, false) <> coalesce(d <= t.tm, false)) AS n_unmatched
FROM ({times}) t JOIN first USING (run) GROUP BY t.run, t.tm"""


_SIGNALS = f"""{_SYNC_EVENTS},
looks AS MATERIALIZED ({_looks("SELECT DISTINCT run, ms AS tm FROM e WHERE made")}),
second AS ({_looks(f"SELECT DISTINCT run, tm + {DELAY_S * 1000} AS tm FROM looks WHERE n_unmatched BETWEEN 1 AND 2")}),
found AS (SELECT *, false AS second_look FROM looks WHERE n_unmatched = 0 UNION ALL
          SELECT second.*, true FROM second JOIN ends USING (run) WHERE n_unmatched = 0 AND (tm < last OR tm <= newest - {LATE_S * 1000})),
signals AS (SELECT run, arg_min(found, [tm, CAST(second_look AS BIGINT)]) AS s FROM found GROUP BY run)"""


def write_sync_events(spark, sf_dir, path: str) -> str:
    """Events with odd whole values create a dataset, the others deliver its file."""
    status = F.when(F.floor("value") % 2 == 1, F.lit("Dataset_Created")).otherwise(F.lit("File_Received"))
    kind = F.when(F.col("value") < 5, F.lit("REMOVE")).otherwise(F.lit("INSERT"))
    stem = F.concat_ws("-", "event_type", (F.col("event_id") % 2).cast("string"))
    rec = change_event(F.col("user_id"), F.concat_ws("-dataset-", stem, F.col("user_id").cast("string")), status, F.col("ts"), kind,
                       F.col("event_id"), F.col("event_id"))
    json_in_order(t(spark, sf_dir, "events"), rec).write.mode("errorifexists").text(path)
    return path


def _published(spark, sf_dir):
    from quartermaster.streaming.refresh import refresh_tables
    base = L.state_base(spark, "qm-publish")
    events_dir = write_sync_events(spark, sf_dir, os.path.join(base, "events"))
    source = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("assessment_id"), "o_orderkey", "o_totalprice")
    # one micro-batch: the files of one write don't arrive in time order
    L.run_lifecycle(spark, events_dir, base, SYNC_ITEMS, gate=False, max_files_per_trigger=None,
                    state_partitions=spark.sparkContext.defaultParallelism, source=source,
                    sync={"delay_s": DELAY_S, "keep_s": KEEP_S, "late": f"{LATE_S} seconds"})
    return refresh_tables(spark, base, source)


@register("stream_sync_gate", f"""
WITH {_SIGNALS}
SELECT run AS assessment_id, '{L.SYNCED_SIGNAL}' AS signal, s.tm AS signal_ms, s.second_look AS second_look,
       CAST(s.n_matched AS INTEGER) AS n_matched, CAST({len(SYNC_ITEMS)} - s.n_there AS INTEGER) AS n_absent
FROM signals
""")
def q_stream_sync_gate(spark, sf_dir) -> DataFrame:
    """Signals of the sync gate, as the lifecycle committed them."""
    s = _published(spark, sf_dir).read("signals")
    return s.select("assessment_id", "signal", F.unix_millis("signal_at").alias("signal_ms"), "second_look", "n_matched", "n_absent")


@register("lifecycle_audit", f"""
WITH {_SIGNALS},
n AS (SELECT CAST(o_custkey AS VARCHAR) AS run, count(*) AS source_rows, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY 1)
SELECT run AS assessment_id, 'aggregated-embark-dataset-' || run AS dataset_id,
       CASE WHEN source_rows IS NULL THEN 'NO_DATASET' ELSE 'REFRESHED' END AS status, source_rows,
       CASE WHEN source_rows IS NOT NULL THEN 'INGEST_COMPLETE' END AS run_status, coalesce(source_rows, 0) AS published_rows,
       CAST(coalesce(cents, 0) AS BIGINT) AS published_cents
FROM signals LEFT JOIN n USING (run)
""")
def q_lifecycle_audit(spark, sf_dir) -> DataFrame:
    """The audit with what was published and the status row of each run."""
    from quartermaster.streaming.refresh import current_target
    tables = _published(spark, sf_dir)
    published = current_target(tables).groupBy(F.col("assessment_id").cast("string").alias("assessment_id")).agg(
        F.count(F.lit(1)).alias("published_rows"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("published_cents"))
    status = tables.read("status").select("assessment_id", F.col("status").alias("run_status"))
    return (tables.read("audit").select("assessment_id", "dataset_id", "status", "source_rows")
            .join(status, "assessment_id", "left").join(published, "assessment_id", "left").fillna(0, ["published_rows", "published_cents"]))


# ---------------------------------------------------------------------------
# Arrival notices to the sinks of the jobs
# ---------------------------------------------------------------------------
NOTICE_FILES = [*D.ARRIVAL_SUFFIXES, "RD_IX_Requirement_Trimmed.csv", "RD_IW_PaxLocationAll_joined.csv", "cosx_embark.csv", "notes.txt"]


def _file_sql() -> str:
    """SQL rows (place, file name, sink, reason), written down from the routing rules."""
    jobs = dict(L.ROUTES)
    out = []
    for i, name in enumerate(NOTICE_FILES):
        announced = any(name.endswith(s) for s in D.ARRIVAL_SUFFIXES)
        job = jobs.get(name) or ("aggregated_embark" if name.startswith("cos") and name.endswith(".csv") else None)
        if not announced:
            sink, reason = "quarantine", "'not_announced'"
        elif name.endswith(".zip"):
            sink, reason = "unpack", "NULL"
        elif name in D.JOB_FILES:
            sink, reason = (job, "NULL") if job else ("quarantine", "'no_route'")
        else:
            sink, reason = "received", "NULL"
        out.append(f"({i}, '{name}', '{sink}', {reason})")
    return ", ".join(out)


def write_notices(spark, sf_dir, path: str) -> str:
    """One notice for each order: two files of a customer's run, the second
    sometimes without a run, and keys as storage encodes them."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    names = F.array(*[F.lit(n) for n in NOTICE_FILES])

    def record(place, folder):
        name = F.get(names, (place % len(NOTICE_FILES)).cast("int"))
        return F.struct(F.lit("ObjectCreated:Put").alias("eventName"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("eventTime"), F.struct(
            F.struct(F.lit("store").alias("name")).alias("bucket"),
            F.struct(F.concat(folder, name).alias("key"), F.col("o_orderkey").alias("size")).alias("object")).alias("s3"))

    run = F.concat(F.lit("assessments/"), F.col("o_custkey").cast("string"), F.lit("/in+put%2F"))
    alone = F.when(F.col("o_orderkey") % 7 == 0, F.lit("")).otherwise(run)
    records = F.array(record(F.col("o_orderkey"), run), record(F.col("o_orderkey") * 3 + 1, alone))
    o.select(F.to_json(F.struct(records.alias("Records"))).alias("value")).write.mode("errorifexists").text(path)
    return path


@register("dispatch_arrivals", f"""
WITH names AS (SELECT * FROM (VALUES {_file_sql()}) AS v(place, file_name, sink, reason)),
files AS (SELECT o_orderkey, o_custkey, o_orderkey % {len(NOTICE_FILES)} AS place, true AS in_run FROM orders UNION ALL
          SELECT o_orderkey, o_custkey, (o_orderkey * 3 + 1) % {len(NOTICE_FILES)}, o_orderkey % 7 <> 0 FROM orders)
SELECT CASE WHEN in_run THEN sink ELSE 'quarantine' END AS sink,
       CASE WHEN in_run OR reason = 'not_announced' THEN reason ELSE 'no_run' END AS reason,
       CASE WHEN in_run THEN CAST(o_custkey AS VARCHAR) END AS assessment_id, file_name, o_orderkey AS size,
       CASE WHEN in_run THEN 'assessments/' || CAST(o_custkey AS VARCHAR) || '/in put/' ELSE '' END || file_name AS object_key
FROM files JOIN names USING (place)
""")
def q_dispatch_arrivals(spark, sf_dir) -> DataFrame:
    """Every file of the notices, with the one sink it is in."""
    base = L.state_base(spark, "qm-dispatch")
    D.run_dispatch(spark, write_notices(spark, sf_dir, os.path.join(base, "notices")), base)
    return D.dispatch_tables(spark, base).read("sinks").select("sink", "reason", "assessment_id", "file_name", "size", "object_key")
