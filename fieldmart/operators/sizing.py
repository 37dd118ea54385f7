"""Measured sizes: the check in front of every broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from fieldmart.limits import DEFAULT, Limits

PER_VALUE = 16  # bytes of row layout per value


def _values(schema: StructType, path: str = "") -> list[tuple[str, bool]]:
    """Every value of a row, inside structs too: its path, and whether it is text."""
    found = []
    for field in schema.fields:
        name = f"{path}`{field.name}`"
        if isinstance(field.dataType, StructType):
            found += _values(field.dataType, name + ".")
        else:
            found.append((name, isinstance(field.dataType, StringType)))
    return found


def _bytes_of(df: DataFrame):
    values = _values(df.schema)
    total = F.lit(PER_VALUE * (len(values) + 1))
    for name, is_text in values:
        if is_text:
            total = total + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return F.coalesce(F.sum(total.cast("long")), F.lit(0))


def which_fit(sides: dict[str, DataFrame], limits: Limits = DEFAULT) -> dict[str, bool]:
    """For each side, whether it is small enough to broadcast. One job for all of them."""
    sums = [df.agg(_bytes_of(df).alias("size")).select(F.lit(n).alias("side"), "size") for n, df in sides.items()]
    measured = reduce(DataFrame.union, sums).collect()
    return {row["side"]: row["size"] <= limits.broadcast_bytes for row in measured}


def fits(df: DataFrame, limits: Limits = DEFAULT) -> bool:
    return which_fit({"side": df}, limits)["side"]
