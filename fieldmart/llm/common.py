"""Shared helpers: written tables, files of executors, memory of workers, identifiers of parts, safe column choice."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # when the execution that made them ends
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Written tables and files of one query, below the shared folder; removed when the driver ends.

    A written table cuts the lineage: what was computed survives lost executors, and the shuffle files
    behind it go at once. They would stay on disk until the driver happens to collect its garbage.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def pin(self, df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
        """Write df as Parquet and return the written table. Its Python functions get so many rows at a time, if it is given."""
        path = f"{self.path}/{name}"
        settings = {SHUFFLES_GO: "true"} | ({BATCH_ROWS: str(batch_rows)} if batch_rows else {})
        before = {key: self.spark.conf.get(key, None) for key in settings}
        for key, value in settings.items():
            self.spark.conf.set(key, value)
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Remove a table that nothing reads any more, or all of them."""
        try:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session may have ended already
            pass


def write_file(uri: str, data: bytes) -> None:
    """Called by tasks: the file appears whole or not at all, so a repeated task does no harm."""
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, path)


def read_file(uri: str) -> bytes:
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as source:
        return source.read()


def read_table(uri: str) -> pa.Table:
    """Called by tasks: a written table that is known to be small."""
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    return pyarrow.parquet.read_table(path, filesystem=fs)


_kept: dict[tuple, object] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc


def kept(key: tuple, make: Callable[[], object]):
    """What a worker keeps from task to task. Stages share workers, so it is one thing: what was kept before goes."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Drops what the worker keeps."""
    _kept.clear()
    give_back()


def give_back() -> None:
    """Returns free memory to the system, which the allocators of Arrow and C hold on to."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def tidy(work: Callable[[Iterator], Iterator], keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """A task's function that leaves no free memory in its worker; unless it `keeps` things itself, nothing that others kept."""

    def run(batches: Iterator) -> Iterator:
        if not keeps:
            forget()
        yield from work(batches)
        give_back()

    return run


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column], F.lit(""))


def share_smallest(rows: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Add the smallest value of each row's group, where one group may hold a large part of all rows.

    `rows` must be a written table with a column `part`: each part has one entry per group at
    most, so no task meets more entries of a group than there are parts, and rows meet their
    entry by part and group.
    """
    leaves = rows.groupBy("part", group).agg(F.min(value).alias("__leaf"))
    tops = leaves.groupBy(group).agg(F.min("__leaf").alias(out))
    found = leaves.select("part", group).join(tops, group)
    return rows.join(found, ["part", group])


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
_ARROW |= {"string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def batch(ddl: str, columns: list) -> pa.RecordBatch:
    """Columns of a task as a record batch of this schema; whole numbers stay exact beside nulls."""
    fields = [field.split(" ", 1) for field in ddl.split(", ")]
    arrays = [pa.array(column, type=_ARROW[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def batch_of_rows(ddl: str, rows: list[tuple]) -> pa.RecordBatch:
    return batch(ddl, list(zip(*rows, strict=True)) if rows else [[] for _ in ddl.split(", ")])


def lists(rows: pa.RecordBatch, *names: str) -> zip:
    """The rows of a batch as tuples of plain values."""
    return zip(*[rows.column(name).to_pylist() for name in names], strict=True)
