"""Writing the data product, so that readers see a run wholly or not at all.

Every run writes to a folder of its own. What it replaces is settled by one record in the log of commits,
which is a single small file that appears at once. Readers take from each run the folders that no later
commit has replaced, so a run that was killed before its commit changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce
from urllib.parse import unquote

from pyarrow.fs import FileSelector, FileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from fieldmart.functions.normalise import UNASSIGNED_TA
from fieldmart.params import JobParams
from fieldmart.schema import OUTPUT

ROWS_PER_FILE = 5_000_000
# Copies of the columns that scope a run, so that the files keep all columns in their order.
PARTITIONS = {"part_affiliate": "affiliate_code", "part_therapy_area": "therapy_area_TA"}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's name for NULL
FOLDER = re.compile("/".join(f"{part}=([^/]*)" for part in PARTITIONS) + "/[^/]*$")
COMMIT = "version long, run string, scope string, folders array<struct<affiliate:string,area:string>>, schema string"

Folder = tuple[str | None, str | None]


def _folders(spark: SparkSession, path: str) -> list[Folder]:
    """The folders a run has written, found in its own files."""
    try:
        files = spark.read.parquet(path).inputFiles()
    except AnalysisException:  # it had no rows
        return []
    found = {FOLDER.search(file).groups() for file in files}
    # A file's name is escaped twice: as a folder, and as an address.
    names = (tuple(unquote(unquote(value)) for value in folder) for folder in found)
    return [tuple(None if name == NULL_FOLDER else name for name in folder) for folder in names]


def _covers(scope: dict | None, folder: Folder) -> bool:
    """Whether a run of this scope replaces the folder even if it has no rows for it."""
    if scope is None:
        return False
    affiliate, area = folder
    if scope["affiliate"] is not None and (affiliate or "").upper() != scope["affiliate"]:
        return False
    return scope["therapy_areas"] is None or (UNASSIGNED_TA if area is None else area).upper() in scope["therapy_areas"]


def _commits(spark: SparkSession, path: str) -> list:
    """The log, in order: a row per run."""
    try:
        log = spark.read.schema(COMMIT).parquet(f"{path}/commits")
    except AnalysisException:  # nothing was committed yet
        return []
    return log.orderBy("version", "run").collect()


def _live(commits: list) -> dict[Folder, str]:
    """The run that holds each folder of the product now."""
    held: dict[Folder, str] = {}
    for commit in commits:
        scope = json.loads(commit["scope"])
        held = {folder: run for folder, run in held.items() if not _covers(scope, folder)}
        held.update({(f["affiliate"], f["area"]): commit["run"] for f in commit["folders"]})
    return held


def _commit(spark: SparkSession, path: str, record: tuple) -> None:
    spark.createDataFrame([record], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def write_product(df: DataFrame, path: str, params: JobParams | None = None) -> None:
    """Parquet under `path`, one folder per run, affiliate and therapy area.

    A run replaces the folders it has rows for and leaves those of other affiliates and therapy
    areas as they are. With `params`, folders within the run's scope for which it has no rows any
    more are gone too. Runs of different scopes may write at the same time. Replaced files stay
    until clean_product.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    copies = [F.col(source).cast("string").alias(part) for part, source in PARTITIONS.items()]
    data = df.select(*[name for name, _ in OUTPUT], *copies)
    writer = data.write.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*PARTITIONS)
    writer.parquet(f"{path}/data/run={run}")
    folders = _folders(spark, f"{path}/data/run={run}")
    scope = None if params is None else {"affiliate": params.affiliate, "therapy_areas": params.therapy_areas}
    version = 1 + max([0, *[c["version"] for c in _commits(spark, path)]])
    columns = StructType([f for f in data.schema.fields if f.name not in PARTITIONS])
    _commit(spark, path, (version, run, json.dumps(scope), folders, columns.json()))


def _is_live(held: dict[Folder, str]) -> Column:
    """On partition columns alone, so files of replaced folders are not opened."""
    by_run: dict[str, list[Folder]] = {}
    for folder, run in held.items():
        by_run.setdefault(run, []).append(folder)

    def within(folder: Folder) -> Column:
        return reduce(Column.__and__, [F.col(part).eqNullSafe(F.lit(v)) for part, v in zip(PARTITIONS, folder, strict=True)])

    runs = [(F.col("run") == run) & reduce(Column.__or__, map(within, folders)) for run, folders in by_run.items()]
    return reduce(Column.__or__, runs)


def read_product(spark: SparkSession, path: str) -> DataFrame:
    """The product as of the last commit, its columns in their order."""
    commits = _commits(spark, path)
    if not commits:
        raise FileNotFoundError(f"no product was committed below {path}")
    held = _live(commits)
    schema = StructType.fromJson(json.loads(commits[-1]["schema"]))
    if not held:
        return spark.createDataFrame([], schema)
    for part in ("run", *PARTITIONS):
        schema = schema.add(part, StringType())
    folders = [f"{path}/data/run={run}" for run in sorted(set(held.values()))]
    found = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return found.where(_is_live(held)).select(*[name for name, _ in OUTPUT])


def clean_product(spark: SparkSession, path: str) -> list[str]:
    """Remove the runs that hold no folder any more, and those that were never committed; returns them.

    Not while a run is writing or a reader may still use an older state.
    """
    held = set(_live(_commits(spark, path)).values())
    files, folder = FileSystem.from_uri(path if "://" in path else f"file://{path}")
    runs = [info.path for info in files.get_file_info(FileSelector(f"{folder}/data", allow_not_found=True))]
    gone = [run for run in runs if run.rpartition("run=")[2] not in held]
    for run in gone:
        files.delete_dir(run)
    return [run.rpartition("run=")[2] for run in gone]
