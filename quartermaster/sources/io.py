"""Scans, sinks and file-listing sources.

File listings are DataFrames built from the ``binaryFile`` source without
its ``content`` column, so Spark lists files (in parallel on large folders)
and reads no bytes. Only presence checks of a handful of named inputs use the
Hadoop FileSystem API on the driver, which is metadata work either way.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.functions.nulls import clean_nan, extract_or_null, to_bigint
from quartermaster.operators.columns import q
from quartermaster.sources.archives import read_zip_csv  # noqa: F401 - S8

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "false"}


def read_text_columns(spark: SparkSession, path, names: Sequence[str] | None = None,
                      null_value: str | None = None) -> DataFrame:
    """CSV cells as text, by the header's names. Files whose header differs
    from the first one's fail (``enforceSchema=false``); a wanted name that
    the header lacks is an error. Only the chosen columns are parsed."""
    r = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false")
    if null_value is not None:
        r = r.option("nullValue", null_value)
    df = r.csv([path] if isinstance(path, str) else list(path))
    if names is None:
        return df
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the header {df.columns}: {missing}")
    return df.select([q(n) for n in names])


def _typed(name: str, kind: T.DataType):
    if isinstance(kind, T.StringType):
        return q(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return to_bigint(q(name)).try_cast(kind).alias(name)
    return F.trim(q(name)).try_cast(kind).alias(name)


# S1 / S2
def read_table(spark: SparkSession, path, schema: T.StructType | str | None = None,
               columns: Sequence[str] | None = None, null_value: str | None = None,
               infer: bool = True) -> DataFrame:
    """CSV with header. ``schema`` names and types the wanted columns: they
    are taken by header name (whatever the file's column order, further
    columns ignored, a missing one an error) and cells that don't parse are
    NULL. ``columns`` prunes. Without a schema types are inferred. A Parquet
    path is read as Parquet. NaN doubles become NULL (pandas reads NaN)."""
    paths = [path] if isinstance(path, str) else list(path)
    if all(p.endswith(".parquet") for p in paths):
        df = spark.read.parquet(*paths)
    elif schema is not None:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        wanted = [f for f in fields if columns is None or f.name in columns]
        df = read_text_columns(spark, paths, [f.name for f in wanted], null_value)
        df = df.select([_typed(f.name, f.dataType) for f in wanted])
    else:
        r = spark.read.options(**CSV_OPTIONS)
        if null_value is not None:
            r = r.option("nullValue", null_value)
        df = (r.option("inferSchema", "true") if infer else r).option("enforceSchema", "false").csv(paths)
    if columns is not None:
        df = df.select([q(c) for c in columns])
    return clean_nan(df)


# S5
def csv_to_parquet(spark: SparkSession, src, dst: str, schema: T.StructType | str,
                   null_value: str = ".", mode: str = "overwrite",
                   partition_by: Sequence[str] = ()) -> DataFrame:
    df = read_table(spark, src, schema=schema, null_value=null_value)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(dst)
    return spark.read.parquet(dst)


# S6
def register_table(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


# S7
def read_many(spark: SparkSession, directory: str, glob: str, by_name: bool = True,
              schema=None) -> DataFrame:
    """All files matching ``glob`` (e.g. ``cos*embark.csv``), one scan per
    file (each may have its own header), unioned by name (missing -> NULL).
    Meant for a run's handful of per-class outputs; many files of one
    layout belong in a single ``read_table`` call on the glob. Each row
    carries ``source_file``."""
    listing = list_files(spark, directory, glob)
    paths = [r.path for r in listing.select("path").collect()]  # file names only
    if not paths:
        raise FileNotFoundError(f"no file matches {glob} in {directory}")
    out = None
    for p in paths:
        df = read_table(spark, p, schema=schema)
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=by_name)
    return out


# S9
def write_manifest(spark: SparkSession, entries: DataFrame, dst: str) -> None:
    """Manifest rows (url, mandatory) as JSON lines."""
    entries.select(F.col("url").cast("string"), F.col("mandatory").cast("boolean")) \
        .coalesce(1).write.mode("overwrite").json(dst)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("url string, mandatory boolean").json(path)


def read_from_manifest(spark: SparkSession, manifest: DataFrame, schema=None) -> DataFrame:
    """Read every listed file; a missing mandatory one is an error."""
    rows = manifest.collect()  # a manifest is a short list of paths, not data
    missing = [r.url for r in rows if r.mandatory and not path_exists(spark, r.url)]
    if missing:
        raise FileNotFoundError(f"mandatory inputs missing: {missing}")
    present = [r.url for r in rows if path_exists(spark, r.url)]
    return read_table(spark, present, schema=schema)


# S10
def bundled_dimension(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A small table that comes with the jobs. No broadcast hint: AQE decides
    from the measured size."""
    return read_table(spark, path, schema=schema)


# S11
def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(header="true").csv(path)
    else:
        w.format(fmt).save(path)


# S12
def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a finished write (its ``_SUCCESS`` marker) or a plain file stands there."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    return bool(fs.getFileStatus(hpath).isFile() or path_exists(spark, f"{path}/_SUCCESS"))


def materialize_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write unless the finished output exists; what a failed write has left
    is overwritten. True when written."""
    if is_complete(df.sparkSession, path):
        return False
    write_table(df, path, fmt=fmt, mode="overwrite")
    return True


def materialize_missing(outputs: Mapping[str, DataFrame], fmt: str = "parquet") -> list[str]:
    """The job form with several outputs (path -> table): nothing runs if all
    are finished, else the unfinished ones are written. Returns their paths."""
    return [path for path, df in outputs.items() if materialize_if_absent(df, path, fmt)]


# S13
def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def require_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise with the full list of missing inputs (the reference answers 404)."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing inputs: {missing}")


def list_files(spark: SparkSession, directory: str, glob: str = "*",
               recursive: bool = True) -> DataFrame:
    """(path, name, modificationTime, length) of matching files; no bytes read."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(directory).select("path", "modificationTime", "length")
    return df.withColumn("name", F.element_at(F.split("path", "/"), -1))


# S14
def profile_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per CSV file (or CSV member of a ZIP): path, archive, name and
    the header's column list; failures are captured in ``error``.

    Plain CSVs are read as lines and each file's first line is kept: the line
    of the least running number in the file's first split, which lies in one
    task (``min_by`` combines there). A ZIP has its member directory at the
    end of the file, so each archive is opened inside one task.
    """
    schema = ("path string, archive string, name string, columns array<string>, "
              "error string")

    def split_headers(batches):
        import csv

        import pandas as pd
        for b in batches:
            rows = []
            for fp, line in zip(b["file_path"], b["line"]):
                try:
                    rows.append((fp, None, fp.split("/")[-1], next(csv.reader([line])), None))
                except Exception as e:  # reported, not hidden
                    rows.append((fp, None, fp.split("/")[-1], None, repr(e)))
            yield pd.DataFrame(rows, columns=["path", "archive", "name", "columns", "error"])

    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(path)
             .select("value", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_block_start").alias("start"))
             .filter(F.col("start") == 0).withColumn("place", F.monotonically_increasing_id()))
    first = lines.groupBy("file_path").agg(F.min_by("value", "place").alias("line"))
    plain = first.mapInPandas(split_headers, schema)

    def zip_headers(batches):
        import csv

        import pandas as pd
        for b in batches:
            rows = []
            for zpath, content in zip(b["path"], b["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as zf:
                        for name in zf.namelist():
                            if name.lower().endswith(".csv"):
                                first = zf.open(name).readline().decode("utf-8", "replace")
                                cols = next(csv.reader([first.strip("\r\n")]))
                                rows.append((name, zpath, name.split("/")[-1], cols, None))
                except Exception as e:  # reported, not hidden
                    rows.append((zpath, None, zpath.split("/")[-1], None, repr(e)))
            yield pd.DataFrame(rows, columns=["path", "archive", "name", "columns", "error"])

    zips = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.zip").load(path).select("path", "content"))
    return plain.unionByName(zips.mapInPandas(zip_headers, schema))


# S15
def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


# S16
def latest_run(files: DataFrame, required: Sequence[str], months: int = 3,
               now=None) -> DataFrame:
    """Newest complete run folder and the next free id.

    ``files`` has (path, modificationTime). Run folder = numeric path segment
    before the file name. Complete = modified within ``months`` and holding
    every ``required`` file name.
    """
    now = now if now is not None else F.current_timestamp()
    parts = files.select(
        extract_or_null(F.col("path"), r"/([0-9]+)/[^/]+$", 1).cast("bigint").alias("run_id"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("modificationTime"))
    runs = parts.filter(F.col("run_id").isNotNull())
    want = sorted(set(required))
    complete = (runs.filter(F.col("modificationTime") >= F.add_months(now, -months))
                .filter(F.col("name").isin(want))
                .groupBy("run_id").agg(F.count_distinct("name").alias("n_required"))
                .filter(F.col("n_required") == len(want)))
    latest = complete.agg(F.max("run_id").alias("latest_complete_run"))
    nxt = runs.select((F.max("run_id") + 1).alias("next_run_id")).scalar()
    return latest.withColumn("next_run_id", nxt)


# S17
def with_file_ids(df: DataFrame, path_col: str = "path", run_col: str | None = "run_id") -> DataFrame:
    """file name, stem (no extension, no 'manifest_' prefix), file id
    ('_' -> '-') and dataset id '<file id>-dataset-<run>'."""
    name = F.element_at(F.split(q(path_col), "/"), -1)
    stem = F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), "^manifest_", "")
    fid = F.regexp_replace(stem, "_", "-")
    out = df.withColumns({"file_name": name, "file_stem": stem, "file_id": fid})
    if run_col:
        out = out.withColumn("dataset_id", F.concat(fid, F.lit("-dataset-"), q(run_col).cast("string")))
    return out


# S18
RUN_PATH = r"^[a-z0-9]+://([^/]+)/assessments/([^/]+)/(.+)$"


def parse_run_path(df: DataFrame, col: str, pattern: str = RUN_PATH) -> DataFrame:
    """(bucket, run_id, file) from an object path; no match -> all NULL and
    ``path_error`` true (reported per row instead of failing the job)."""
    out = df.withColumns({
        "bucket": extract_or_null(q(col), pattern, 1),
        "run_id": extract_or_null(q(col), pattern, 2),
        "file": extract_or_null(q(col), pattern, 3)})
    return out.withColumn("path_error", F.col("bucket").isNull())
