"""CSV members of ZIP archives, a task for each bundle of members.

A data source whose partitions are members: the archives' directories (at
their ends) are read first, then every task opens its archive, seeks to its
members and streams their rows in chunks. So an archive may be of any size, its
members are read in several tasks, and a task holds one chunk.
"""

from __future__ import annotations

import json
import re
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "zip_members"


def open_file(path: str):
    """A seekable file on any file system that Arrow knows, from a path as Hadoop writes it."""
    from pyarrow import fs
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem().open_input_file(re.sub("^/+", "/", rest) if scheme == "file" else path)
    system, inner = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return system.open_input_file(inner)


def create_file(path: str):
    """A new file to write to, from a path as Hadoop writes it."""
    from pyarrow import fs
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem().open_output_stream(re.sub("^/+", "/", rest) if scheme == "file" else path)
    system, inner = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return system.open_output_stream(inner)


class Members(InputPartition):
    def __init__(self, archive: str, members: list[str], error: str | None = None):
        self.archive, self.members, self.error = archive, members, error


class ZipMembers(DataSource):
    """Options: archives (JSON list of paths), pattern, columns (JSON list or
    none), chunk_rows, bundle_bytes (of members to a task)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return members_schema(json.loads(self.options.get("columns", "null")))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZipReader(self.options)


def members_schema(columns: Sequence[str] | None) -> T.StructType:
    cells = ([T.StructField(c, T.StringType()) for c in columns] if columns is not None
             else [T.StructField("cells", T.MapType(T.StringType(), T.StringType()))])
    return T.StructType([T.StructField("archive", T.StringType()), T.StructField("member", T.StringType()),
                         T.StructField("row_number", T.LongType()), *cells, T.StructField("error", T.StringType())])


class ZipReader(DataSourceReader):
    def __init__(self, options):
        self.archives = json.loads(options["archives"])
        self.pattern = options.get("pattern", r".*\.csv$")
        self.columns = json.loads(options.get("columns", "null"))
        self.chunk_rows = int(options.get("chunk_rows", 100_000))
        self.bundle_bytes = int(options.get("bundle_bytes", 64 << 20))

    def partitions(self) -> list[InputPartition]:
        out, wanted = [], re.compile(self.pattern)
        for path in self.archives:
            try:
                with open_file(path) as f, zipfile.ZipFile(f) as z:
                    infos = [i for i in z.infolist() if wanted.search(i.filename)]
            except Exception as e:  # reported as a row, not hidden
                out.append(Members(path, [], repr(e)))
                continue
            bundle, size = [], 0
            for i in infos:
                if bundle and size + i.file_size > self.bundle_bytes:
                    out.append(Members(path, bundle))
                    bundle, size = [], 0
                bundle.append(i.filename)
                size += i.file_size
            if bundle:
                out.append(Members(path, bundle))
        return out or [Members("", [])]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        if partition.error is not None:
            yield self.failed(partition.archive, None, partition.error)
            return
        if not partition.members:
            return
        import pandas as pd
        with open_file(partition.archive) as f, zipfile.ZipFile(f) as z:
            for member in partition.members:
                start = 0
                try:
                    with z.open(member) as text:
                        for chunk in pd.read_csv(text, dtype=str, keep_default_na=False, na_values=[""], chunksize=self.chunk_rows):
                            yield self.rows(partition.archive, member, start, chunk)
                            start += len(chunk)
                except Exception as e:  # the rows read so far stay, the error is a row
                    yield self.failed(partition.archive, member, repr(e))

    def rows(self, archive: str, member: str, start: int, chunk) -> pa.RecordBatch:
        n = len(chunk)
        cells = chunk.astype(object).where(chunk.notna(), None)
        if self.columns is None:
            values = [pa.array([list(r.items()) for r in cells.to_dict("records")], pa.map_(pa.string(), pa.string()))]
        else:
            values = [pa.array(cells[c].tolist() if c in cells.columns else [None] * n, pa.string()) for c in self.columns]
        return self.batch(pa.array([archive] * n), pa.array([member] * n), pa.array(range(start, start + n), pa.int64()), values, pa.nulls(n, pa.string()))

    def failed(self, archive: str, member: str | None, error: str) -> pa.RecordBatch:
        kind = pa.map_(pa.string(), pa.string()) if self.columns is None else pa.string()
        values = [pa.nulls(1, kind)] * (1 if self.columns is None else len(self.columns))
        return self.batch(pa.array([archive]), pa.array([member], pa.string()), pa.nulls(1, pa.int64()), values, pa.array([error]))

    def batch(self, archive, member, number, values, error) -> pa.RecordBatch:
        names = ["archive", "member", "row_number", *(["cells"] if self.columns is None else self.columns), "error"]
        return pa.RecordBatch.from_arrays([archive, member, number, *values, error], names)


def read_zip_csv(spark: SparkSession, path: str, member_pattern: str = r".*\.csv$", columns: Sequence[str] | None = None,
                 chunk_rows: int = 100_000, bundle_bytes: int = 64 << 20) -> DataFrame:
    """CSV members of the ZIP archives at ``path`` (a Hadoop pattern) as rows of
    text cells: (archive, member, row_number, cells, error).

    With ``columns`` the cells are these columns (a member without one: NULL),
    else one map of name to text. Members are dealt into tasks of about
    ``bundle_bytes`` and streamed in chunks of ``chunk_rows`` rows; one member
    is never split, since it is one compressed stream. An archive or member that
    can't be read gives a row with ``error`` set and doesn't stop the others.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    archives = sorted(s.getPath().toString() for s in found or [] if s.isFile())
    spark.dataSource.register(ZipMembers)
    options = {"archives": json.dumps(archives), "pattern": member_pattern, "chunk_rows": str(chunk_rows), "bundle_bytes": str(bundle_bytes)}
    if columns is not None:
        options["columns"] = json.dumps(list(columns))
    return spark.read.format(FORMAT).options(**options).load()
