"""Streaming sources: file arrival (T1) and state-change events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (the change-stream record format, field names as delivered):
# one record of the state table's change stream, keys plus old and new
# images, each attribute a typed value ({"S": text} or {"N": number-text}).
_VALUE = T.StructType([T.StructField("S", T.StringType()), T.StructField("N", T.StringType())])
_IMAGE = T.MapType(T.StringType(), _VALUE)
CHANGE_EVENT_SCHEMA = T.StructType([
    T.StructField("eventID", T.StringType()),
    T.StructField("eventName", T.StringType()),
    T.StructField("dynamodb", T.StructType([
        T.StructField("ApproximateCreationDateTime", T.LongType()),
        T.StructField("Keys", _IMAGE),
        T.StructField("NewImage", _IMAGE),
        T.StructField("OldImage", _IMAGE),
        T.StructField("SequenceNumber", T.StringType())]))])


def file_stream(spark: SparkSession, directory: str, schema: T.StructType | str, fmt: str = "csv",
                suffixes: Sequence[str] = (), max_files_per_trigger: int | None = None,
                options: dict | None = None) -> DataFrame:
    """New files of a folder as a stream (T1); only names ending in one of
    ``suffixes`` pass. Each row carries ``file_name``. The source schema is
    fixed (no inference on a stream); ``max_files_per_trigger`` bounds a
    micro-batch."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(directory).withColumn("file_name", F.col("_metadata.file_name"))
    if suffixes:
        cond = F.lit(False)
        for s in suffixes:
            cond = cond | F.col("file_name").endswith(s)
        df = df.filter(cond)
    return df


def read_events(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None,
                stream: bool = True) -> DataFrame:
    """Change events (JSON lines, one record per line) flattened to
    (event_id, event_name, assessment_id, dataset_id, status,
    status_timestamp, sequence, new_image, old_image)."""
    if stream:
        r = spark.readStream.schema(CHANGE_EVENT_SCHEMA).format("json")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        raw = r.load(directory)
    else:
        raw = spark.read.schema(CHANGE_EVENT_SCHEMA).json(directory)
    return flatten_events(raw)


def flatten_events(raw: DataFrame) -> DataFrame:
    d = F.col("dynamodb")
    new = d["NewImage"]
    return raw.select(
        F.col("eventID").alias("event_id"), F.col("eventName").alias("event_name"),
        d["Keys"]["assessment_id"]["S"].alias("assessment_id"),
        d["Keys"]["dataset_id"]["S"].alias("dataset_id"),
        new["Status"]["S"].alias("status"),
        F.to_timestamp(new["Status_Timestamp"]["S"]).alias("status_timestamp"),
        d["SequenceNumber"].cast("decimal(38,0)").alias("sequence"),
        new.alias("new_image"), d["OldImage"].alias("old_image"))


def change_event(assessment_id, dataset_id, status, status_ts, event_name, event_id, sequence) -> F.Column:
    """Build one change-event record (as a struct matching
    ``CHANGE_EVENT_SCHEMA``) from column expressions; ``to_json`` of it is a
    line the event source reads."""
    def s(c):
        return F.struct(c.cast("string").alias("S"), F.lit(None).cast("string").alias("N"))
    keys = F.create_map(F.lit("assessment_id"), s(assessment_id), F.lit("dataset_id"), s(dataset_id))
    new = F.create_map(F.lit("assessment_id"), s(assessment_id), F.lit("dataset_id"), s(dataset_id),
                       F.lit("Status"), s(status), F.lit("Status_Timestamp"), s(status_ts),
                       status, s(status_ts))
    return F.struct(event_id.cast("string").alias("eventID"), event_name.alias("eventName"),
                    F.struct(F.unix_seconds(status_ts.cast("timestamp")).alias("ApproximateCreationDateTime"),
                             keys.alias("Keys"), new.alias("NewImage"),
                             F.lit(None).cast(_IMAGE).alias("OldImage"),
                             sequence.cast("string").alias("SequenceNumber")).alias("dynamodb"))
