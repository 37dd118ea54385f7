"""Several runs of the data product over one selection of its inputs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from fieldmart.params import JobParams
from fieldmart.plans.product import build_product, scope_of
from fieldmart.sources.tables import Tables

SCOPED = ("call_detail", "discussion_sample", "cycle_plan", "emp_territory")
RUN = "__run"


def rows_of_runs(df: DataFrame, runs: list[JobParams]) -> DataFrame:
    """Each row once for every run whose scope it is in, with the number of the run."""
    scopes = [reduce(Column.__and__, scope_of(df, params), F.lit(True)) for params in runs]
    numbers = [F.when(scope, F.lit(i)) for i, scope in enumerate(scopes)]
    # The filter says nothing new, but reaches the files.
    chosen = df.where(reduce(Column.__or__, scopes))
    return chosen.withColumn(RUN, F.explode(F.array_compact(F.array(*numbers))))


def split_by_run(df: DataFrame, runs: list[JobParams], path: str) -> list[DataFrame]:
    """The rows of each run, after one scan of df. No rows are shuffled: a task writes a file for
    each run it has rows of, which is one where the table is partitioned by affiliate."""
    rows_of_runs(df, runs).write.mode("overwrite").partitionBy(RUN).parquet(path)
    # With the schema given, runs without a row read as empty, and numbers stay numbers.
    stored = df.sparkSession.read.schema(df.schema.add(RUN, IntegerType())).parquet(path)
    return [stored.where(F.col(RUN) == i).drop(RUN) for i in range(len(runs))]


def build_products(tables: Tables, runs: Mapping[str, JobParams], folder: str) -> dict[str, DataFrame]:
    """The data product of each run, equal to what build_product gives for it alone.

    The tables that a run's scope narrows are read once for all runs and written below `folder`, which
    all executors share; the caller removes it when the products are written. Without runs
    there are no products, and nothing is read. The selection is not bucketed, so `bucketed_by_call`
    has no effect here.
    """
    if not runs:
        return {}
    scoped = {
        name: split_by_run(getattr(tables, name), list(runs.values()), f"{folder}/{name}") for name in SCOPED
    }
    return {
        name: build_product(
            replace(tables, **{table: parts[i] for table, parts in scoped.items()}),
            replace(params, bucketed_by_call=False),
        )
        for i, (name, params) in enumerate(runs.items())
    }
