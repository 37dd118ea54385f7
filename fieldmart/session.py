"""Session settings the plans are written for, and the place for checkpoints."""

from __future__ import annotations

import atexit
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

MB = 1024 * 1024


def split_bytes(input_bytes: int) -> int:
    """Bytes of a scan's and of a shuffle's partition. A shuffle has a block for each pair of them, so
    they grow with the input: 100 TB in partitions of 1 GB are 10^10 blocks of 10 kB, which calls
    for a push-based or remote shuffle service, or a run per affiliate."""
    return 16 * MB if input_bytes <= 1024 * MB else 256 * MB if input_bytes <= 1024**4 else 1024 * MB


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int | None = None) -> int:
    """Partitions of about target_bytes, in whole waves of cores."""
    target_bytes = target_bytes or max(256 * MB, split_bytes(input_bytes))
    needed = max(1, -(-input_bytes // target_bytes))
    return max(cores, -(-needed // cores) * cores)


# One shuffle by call id (or customer) serves every join whose keys contain it.
SHARED_SHUFFLE = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def tune(spark: SparkSession) -> None:
    """For sessions made elsewhere: the one setting the product's plan counts on."""
    spark.conf.set(*SHARED_SHUFFLE)


# The code generated for rows this wide is longer than what the JVM compiles by default.
JVM = "-XX:-DontCompileHugeMethods"


def settings(cores: int, input_bytes: int = 0) -> dict[str, str]:
    large = input_bytes > 1024 * MB
    return {
        "spark.driver.extraJavaOptions": JVM,
        "spark.executor.extraJavaOptions": JVM,
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes, cores)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB if large else 64 * MB),
        # Hash joins where the measured partitions of the right side are small: no sort of wide rows.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(256 * MB if large else 64 * MB),
        SHARED_SHUFFLE[0]: SHARED_SHUFFLE[1],
        "spark.sql.files.maxPartitionBytes": str(split_bytes(input_bytes)),
        # Checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; make one only in local mode, where none is named."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="fieldmart-")
    context.setCheckpointDir(folder)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder, not made yet, beside the checkpoints, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Compute once and keep in shared storage, so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def _held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Shuffle files go with the write; they would stay until the driver happens to collect its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "4"}  # no sort by bucket: a task's rows have one


def written(df: DataFrame, name: str) -> str:
    """The folder of df written as Parquet. The shuffle files behind it go at once, the table when the driver ends."""
    folder = shared_folder(df.sparkSession, name)
    atexit.register(_remove, df.sparkSession, folder)
    with _held(df.sparkSession, SHUFFLES_GO):
        df.write.option("compression", "zstd").parquet(folder)
    return folder


def in_buckets(df: DataFrame, column: str) -> DataFrame:
    """df written as Parquet where its tasks made it, bucketed by a column that has one value in a task.

    The shuffle files behind it go at once, the table when the driver ends. Readers find the rows of a value in
    one partition without a shuffle. There are twice as many buckets as shuffle partitions, as values meet by hash.
    """
    spark = df.sparkSession
    folder, name = shared_folder(spark, "rows"), f"fieldmart_{uuid4().hex}"
    atexit.register(_remove, spark, folder)
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _held(spark, SHUFFLES_GO | UNSORTED):
        df.write.bucketBy(buckets, column).option("path", folder).option("compression", "zstd").saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its name alone: the files are needed
    return rows


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may have ended already
        pass
