"""Arrival notices fanned out to one table for each job.

A notice names files that have arrived in storage. In a micro-batch every file
goes to exactly one sink: the job that its name selects, ``received`` (a table
no job waits for), ``unpack`` (an archive) or ``quarantine`` with the reason.
All sinks of a batch are written by one job, and committed together with the
status rows of the files received, so a repeated batch changes nothing.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.streaming.commit import BatchTables
from quartermaster.streaming.lifecycle import NO_ROUTE, route, wait_until_done

# Fixed values (must equal the source system's): names whose arrival is
# announced (an object's key ends with one of them) ...
ARRIVAL_SUFFIXES = [
    "AssessmentTable.csv", "AssessmentParameterDataMapTable.csv", "Locations.csv", "RD_I_PaxLocationAll.csv", "RD_I_POS_Location.csv",
    "RD_I_Ration_Costs.csv", "RD_I_POS_Pallet_Requirement.csv", "RD_IW_PaxLocationAll.csv", "RD_IW_Ration_Costs.csv",
    "RD_IW_POS_Requirement.csv", "RD_II_VII_DailyTE_WithDimensions.csv", "RD_IIIP_POL_Pkg_NSN_Requirements_PBI.csv",
    "RD_II_ICCE_DailyTE.csv", "RD_IV_Daily_Requirements.csv", "RD_VI_POS_Pallet_Requirement.csv", "RD_IX_Requirement.csv", "_RD_I__Input.zip",
    "aggregated_embark.csv", "cosi_embark.csv", "cosi_water_embark.csv", "cosii_vii_embark.csv", "cosiiip_embark.csv", "cosiv_embark.csv",
    "cosvi_embark.csv", "cosix_embark.csv", "ForceFlow_joined.csv", "POS.csv"]
# ... and the files that start a job.
JOB_FILES = [
    "RD_I_POS_Pallet_Requirement.csv", "RD_IW_PaxLocationAll_joined.csv", "RD_II_VII_DailyTE_WithDimensions.csv",
    "RD_IIIP_POL_Pkg_NSN_Requirements_PBI.csv", "RD_IV_Daily_Requirements.csv", "RD_VI_POS_Pallet_Requirement.csv",
    "RD_IX_Requirement_Trimmed.csv", "AssessmentTable.csv", "POS.csv", "cosi_embark.csv", "cosi_water_embark.csv", "cosii_vii_embark.csv",
    "cosiiip_embark.csv", "cosiv_embark.csv", "cosix_embark.csv", "cosvi_embark.csv"]
# The notice as storage sends it.
NOTICE_SCHEMA = ("Records array<struct<eventName: string, eventTime: string, "
                 "s3: struct<bucket: struct<name: string>, object: struct<key: string, size: bigint>>>>")

ARRIVAL = "bucket string, object_key string, size bigint, arrived_at timestamp, assessment_id string, file_name string, dataset_id string, reason string"
STATUS = "assessment_id string, dataset_id string, status string, status_timestamp timestamp"
UNPACK, RECEIVED, QUARANTINE = "unpack", "received", "quarantine"


def read_notices(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None, stream: bool = True) -> DataFrame:
    """One row for each file in the notices (JSON lines) of a folder: bucket,
    object_key (decoded), size, arrived_at. A line that can't be read, or names
    no file, is a row of nulls."""
    if stream:
        r = spark.readStream.schema(NOTICE_SCHEMA)
        raw = (r.option("maxFilesPerTrigger", str(max_files_per_trigger)) if max_files_per_trigger else r).json(directory)
    else:
        raw = spark.read.schema(NOTICE_SCHEMA).json(directory)
    one = raw.select(F.explode_outer("Records").alias("r"))
    return one.select(F.col("r.s3.bucket.name").alias("bucket"), F.try_url_decode(F.col("r.s3.object.key")).alias("object_key"),
                      F.col("r.s3.object.size").alias("size"), F.try_to_timestamp("r.eventTime").alias("arrived_at"))


def routed_arrivals(files: DataFrame, suffixes=ARRIVAL_SUFFIXES, job_files=JOB_FILES) -> DataFrame:
    """``ARRIVAL`` columns and ``sink`` of each file (``read_notices``)."""
    parts = F.split("object_key", "/")
    name = F.element_at(parts, -1)
    run = F.when(F.size(parts) > 1, F.element_at(parts, 2))
    named = files.withColumns({"file_name": name, "assessment_id": run})
    stem = F.regexp_replace(F.regexp_replace("file_name", r"\.[^.]*$", ""), "_", "-")
    named = route(named.withColumn("dataset_id", F.concat(stem, F.lit("-dataset-"), "assessment_id")), "file_name")
    announced = F.lit(False)
    for s in suffixes:
        announced = announced | F.endswith("object_key", F.lit(s))
    low = F.lower("object_key")
    reason = (F.when(F.col("object_key").isNull(), F.lit("unreadable"))
              .when(~announced, F.lit("not_announced"))
              .when(F.col("assessment_id").isNull(), F.lit("no_run"))
              .when(~low.endswith(".zip") & ~low.endswith(".csv"), F.lit("not_a_table"))
              .when(F.col("file_name").isin(list(job_files)) & (F.col("job") == NO_ROUTE), F.lit("no_route")))
    sink = (F.when(F.col("reason").isNotNull(), F.lit(QUARANTINE)).when(low.endswith(".zip"), F.lit(UNPACK))
            .when(F.col("file_name").isin(list(job_files)), F.col("job")).otherwise(F.lit(RECEIVED)))
    out = named.withColumn("reason", reason).withColumn("sink", sink)
    return out.select("bucket", "object_key", "size", "arrived_at", "assessment_id", "file_name", "dataset_id", "reason", "sink")


def dispatch_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, os.path.join(base, "dispatch"), {"status": STATUS, "sinks": f"{ARRIVAL}, sink string"})


def dispatch(tables: BatchTables):
    """The ``foreachBatch`` function of a stream of files (``read_notices``)."""
    def work(batch: DataFrame, batch_id: int) -> None:
        files = tables.write("sinks", batch_id, routed_arrivals(batch), by="sink")
        got = files.filter((F.col("sink") != QUARANTINE) & (F.col("sink") != UNPACK))
        tables.write("status", batch_id, got.select(
            "assessment_id", "dataset_id", F.lit("File_Received").alias("status"), F.col("arrived_at").alias("status_timestamp")))

    return tables.once(work)


def sink_rows(tables: BatchTables, sink: str) -> DataFrame:
    """The files of one sink (only its folders are read)."""
    return tables.read("sinks").filter(F.col("sink") == sink).drop("sink")


def run_dispatch(spark: SparkSession, notices_dir: str, base: str, max_files_per_trigger: int | None = None) -> Mapping[str, str]:
    """Process the notices that are there; a rerun goes on where the last one ended."""
    tables = dispatch_tables(spark, base)
    wait_until_done([read_notices(spark, notices_dir, max_files_per_trigger).writeStream.foreachBatch(dispatch(tables))
                     .option("checkpointLocation", os.path.join(base, "_chk_dispatch")).trigger(availableNow=True).start()])
    return {"dispatch": tables.base}
