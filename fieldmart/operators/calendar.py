"""The calendar of planning cycles per affiliate and therapy area."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.schema import CALENDAR_COLUMNS, WALL_CLOCK

# Bucket codes, cycle codes and the length of a cycle.
CURRENT_BUCKET = "4MC"
PREVIOUS_BUCKET = "P4MC"
ACTIVITY = "ACTIVITY"
CURRENT, PREVIOUS, BEFORE_PREVIOUS = "CC", "PC", "PPC"
CYCLE_MONTHS = 4
ROLLED_AFFILIATES = ("IT",)


def bucket_bounds(buckets: DataFrame, code: str) -> DataFrame:
    """One row: the latest start and the latest end of a bucket, each on its own."""
    kept = (F.col("bckt_cd") == code) & (F.upper("sbjct_area") == ACTIVITY)
    return buckets.where(kept).agg(
        F.max("time_perd_strt_dt").cast(WALL_CLOCK).alias("strt_dt"),
        F.max("time_perd_end_dt").cast(WALL_CLOCK).alias("end_dt"),
    )


def shifted(bounds: DataFrame, months: int = -CYCLE_MONTHS) -> DataFrame:
    """The same bounds some months away, as whole days, clamped to the end of the month."""
    return bounds.select(
        *[F.add_months(F.col(c).cast("date"), months).cast(WALL_CLOCK).alias(c) for c in ("strt_dt", "end_dt")]
    )


def with_bounds(keys: DataFrame, cycle: str, bounds: DataFrame) -> DataFrame:
    """Every key with the one row of bounds, as cycle rows of the given code."""
    return keys.crossJoin(F.broadcast(bounds)).withColumn("spl_cyc", F.lit(cycle)).select(*CALENDAR_COLUMNS)


def without_cycle(keys: DataFrame, cycles: DataFrame, code: str = CURRENT) -> DataFrame:
    """Keys (affiliate, therapy area) that have no cycle of the code. A NULL key never has one."""
    present = cycles.where(F.col("spl_cyc") == code).select("afl_id", "ta").distinct()
    return keys.join(present, ["afl_id", "ta"], "left_anti")


def build_calendar(
    cycles: DataFrame, keys: DataFrame, buckets: DataFrame, rolled: tuple[str, ...] = ROLLED_AFFILIATES
) -> DataFrame:
    """Planned cycles, a current cycle for keys that lack one, rolled cycles for some affiliates.

    `keys` are the distinct (afl_id, ta) of the calls. Of a rolled affiliate only the planned
    current cycles count; its earlier ones come from the time buckets.
    """
    affiliate = F.col("afl_id")
    planned = cycles.where(~affiliate.isin(*rolled) | (F.col("spl_cyc") == CURRENT)).where(affiliate.isNotNull())
    previous = bucket_bounds(buckets, PREVIOUS_BUCKET)
    rolled_keys = keys.where(affiliate.isin(*rolled))
    parts = [
        planned.select(*CALENDAR_COLUMNS),
        with_bounds(without_cycle(keys, cycles), CURRENT, bucket_bounds(buckets, CURRENT_BUCKET)),
        with_bounds(rolled_keys, PREVIOUS, previous),
        with_bounds(rolled_keys, BEFORE_PREVIOUS, shifted(previous)),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()
