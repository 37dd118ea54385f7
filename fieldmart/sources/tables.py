"""Input tables: which physical table and column stands behind each logical name."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.schema import CALL_COLUMNS, CYCLE_COLUMNS, GEO_COLUMNS, HISTORY_COLUMNS, SAMPLE_COLUMNS, WALL_CLOCK

_history = ["id", *HISTORY_COLUMNS[:2], "clm_vod__c"]

LOGICAL_COLUMNS = {
    "call_detail": CALL_COLUMNS,
    "discussion_sample": ["call_id", "src_prod_nm", *SAMPLE_COLUMNS, "afl_id"],
    "cycle_plan": CYCLE_COLUMNS,
    "time_bucket": ["bckt_cd", "sbjct_area", "time_perd_strt_dt", "time_perd_end_dt"],
    "call_history": _history,
    "call_history_jp": _history,
    "country": ["cntry_id", "country_name", "afl_id", "pt_batch_id"],
    "customer": ["eid", "primary_address_line_3", "primary_address_line_4", "edw_actv_flg"],
    "emp_territory": ["terr_id", "ta", "afl_id", "territory_status", "edw_actv_flg", "geo_lvl_cd"],
    "geography": ["afl_id", "brik_id", "brik_nm", "ta", *GEO_COLUMNS, "hier_type", "is_actv"],
    "geography_reference": ["global_region_name", "global_subregion_name", "affiliate_code", "country_name"],
    "non_promotional": ["source_product_name", "promotional_call_yn"],
    "postal_mapping": ["plz", "ort", "ortkurz", "ims"],
}
WALL_CLOCK_COLUMNS = {"cycle_plan": ["strt_dt", "end_dt"]}


@dataclass(frozen=True)
class Tables:
    call_detail: DataFrame
    discussion_sample: DataFrame
    cycle_plan: DataFrame
    time_bucket: DataFrame
    call_history: DataFrame
    call_history_jp: DataFrame
    country: DataFrame
    customer: DataFrame
    emp_territory: DataFrame
    geography: DataFrame
    geography_reference: DataFrame
    non_promotional: DataFrame
    postal_mapping: DataFrame


def mapped(df: DataFrame, logical: list[str], physical: Mapping[str, str] | None = None) -> DataFrame:
    """The logical columns of a table, read from the physical columns named for them."""
    physical = physical or {}
    unknown = sorted(set(physical) - set(logical))
    if unknown:
        raise ValueError(f"no logical columns: {unknown}")
    return df.select(*[F.col(f"`{physical.get(name, name)}`").alias(name) for name in logical])


def mapped_table(name: str, df: DataFrame, physical: Mapping[str, str] | None = None) -> DataFrame:
    """A table under its logical names; the dates of the plan become wall-clock times."""
    read = mapped(df, LOGICAL_COLUMNS[name], physical)
    casts = {c: F.col(c).cast(WALL_CLOCK) for c in WALL_CLOCK_COLUMNS.get(name, [])}
    return read.withColumns(casts) if casts else read


def map_all(tables: Mapping[str, DataFrame], physical: Mapping[str, Mapping[str, str]] | None = None) -> Tables:
    physical = physical or {}
    return Tables(**{f.name: mapped_table(f.name, tables[f.name], physical.get(f.name)) for f in fields(Tables)})


def table_name(template: str, region: str = "") -> str:
    """A catalog name, with {region} filled in. Only plain identifiers pass."""
    name = template.replace("{region}", region)
    if not re.fullmatch(r"\w+(\.\w+)*", name, flags=re.ASCII):
        raise ValueError(f"not a table name: {name!r}")
    return name


def from_catalog(spark: SparkSession, names: Mapping[str, str], region: str = "", physical=None) -> Tables:
    return map_all({k: spark.table(table_name(v, region)) for k, v in names.items()}, physical)


def from_parquet(spark: SparkSession, paths: Mapping[str, str], physical=None) -> Tables:
    return map_all({k: spark.read.parquet(v) for k, v in paths.items()}, physical)
