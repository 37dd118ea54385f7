"""Left-join lookups and the dimensions they read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions import normalise as n
from fieldmart.limits import DEFAULT, Limits
from fieldmart.operators.sizing import fits
from fieldmart.operators.skew import heavy_keys, spread_left_join
from fieldmart.schema import GEO_COLUMNS

# Affiliate and hierarchy codes with rules of their own.
SPLIT_AFFILIATE = "UKI"
GEOGRAPHY = "GEOGRAPHY"
ANALYSIS_GROUP = "ANALYSIS GROUP"


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: dict[str, str | Column],
    when: Column | None = None,
    small: bool | None = None,
    balanced: bool = False,
    hot: DataFrame | None = None,
    keys_from: DataFrame | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """LEFT JOIN dim ON dim key = value on the row, for rows where `when` holds.

    Keeps every row once per match, and once with NULLs where there is none. `on` maps each key
    column of dim to a column or expression of df; the key columns of dim are not kept.
    `small` says whether dim may be broadcast; if not given, it is measured. A dim that is not
    small is joined by shuffle, plainly when the caller states that no key is hot (`balanced`), and
    otherwise with hot keys split. These are `hot`, as spread_left_join takes it, or are counted
    on `keys_from`: any rows with the columns `on` reads, best a plain scan instead of all of df.
    """
    keys = {f"__key_{i}": (dim_key, value) for i, (dim_key, value) in enumerate(on.items())}
    if small is None and not balanced and hot is None:
        small = fits(dim, limits)
    dim = dim.withColumnsRenamed({dim_key: k for k, (dim_key, _) in keys.items()})
    if small or balanced:
        # A plain column stays the join key itself, so that an existing partitioning is used.
        made = {}
        condition = []
        for key, (_, value) in keys.items():
            if isinstance(value, str) and when is None:
                condition.append(F.col(value) == F.col(key))
            else:
                made[f"{key}_of_row"] = _guarded(value, when)
                condition.append(F.col(f"{key}_of_row") == F.col(key))
        side = F.broadcast(dim) if small else dim
        joined = df.withColumns(made) if made else df
        return joined.join(side, reduce(Column.__and__, condition), "left").drop(*keys, *made)
    left = df.withColumns({key: _guarded(value, when) for key, (_, value) in keys.items()})
    known = hot is not None
    if hot is None and keys_from is not None:
        known = True
        counted = keys_from.select(*[_guarded(value, None).alias(key) for key, (_, value) in keys.items()])
        hot = heavy_keys([counted, dim.select(*keys)], limits)
    return spread_left_join(left, dim, list(keys), hot=hot, counted=known, limits=limits).drop(*keys)


def _guarded(value: str | Column, when: Column | None) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column if when is None else F.when(when, column)


def packed(dim: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """The key columns and one struct column with all others."""
    return dim.select(*keys, F.struct(*[c for c in dim.columns if c not in keys]).alias(name))


def latest_snapshot(df: DataFrame, batch: str) -> DataFrame:
    """The rows of the newest batch; the batch is found by a scalar subquery."""
    return df.where(F.col(batch) == df.select(F.max(batch)).scalar())


def first_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key: the first in the order of `columns`, NULLs last. Aggregated before the
    shuffle."""
    order = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    first = F.min(F.struct(*[part.alias(f"c{i}") for i, part in enumerate(order)]))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(first.alias("__first"))
        .select(key, *[F.col(f"__first.c{2 * i + 1}").alias(c) for i, c in enumerate(columns)])
    )


def active_customers(customers: DataFrame) -> DataFrame:
    active = customers.where(n.is_yes(F.col("edw_actv_flg")))
    return first_per_key(active, "eid", ["primary_address_line_3", "primary_address_line_4"])


def call_history(*histories: DataFrame) -> DataFrame:
    """All history tables as one, duplicates kept: id, products, display name, 0/1 flag."""
    return reduce(
        DataFrame.unionByName,
        [
            h.select(
                "id",
                "source_g360_product_detailed",
                "entity_display_name_vod__c",
                n.text_flag(F.col("clm_vod__c")).alias("is_clm_call"),
            )
            for h in histories
        ],
    )


def active_territories(territories: DataFrame) -> DataFrame:
    kept = n.is_yes(F.col("edw_actv_flg")) & (F.upper("geo_lvl_cd") == "TERRITORY")
    return territories.where(kept).select("terr_id", "ta", "afl_id", "territory_status").distinct()


def split_geography(geo: DataFrame) -> DataFrame:
    """For the affiliate with two hierarchies: brick levels from the analysis groups, subterritory
    levels from the geography rows of the same subterritory name and therapy area."""
    active = geo.where((F.col("is_actv") == "Y") & (F.col("afl_id") == SPLIT_AFFILIATE))
    groups = active.where(F.col("hier_type") == ANALYSIS_GROUP)
    areas = active.where(F.col("hier_type") == GEOGRAPHY)
    levels = [c for c in GEO_COLUMNS if c.startswith("subterritory_")]
    # Both sides are reduced before the many-to-many join; its result is made distinct anyway.
    rest = [c for c in GEO_COLUMNS if c not in levels]
    groups = groups.select("afl_id", "brik_id", "brik_nm", "ta", *rest).distinct()
    areas = areas.select(
        F.col("affiliate_subterritory_name").alias("__name"), F.col("ta").alias("__ta"), *levels
    ).distinct()
    same = (F.col("affiliate_subterritory_name") == F.col("__name")) & (F.col("ta") == F.col("__ta"))
    joined = groups.join(areas, same, "left")
    return joined.select("afl_id", "brik_id", "brik_nm", "ta", *GEO_COLUMNS).distinct()


def geo_dimension(geo: DataFrame) -> DataFrame:
    plain = geo.where(
        (F.col("hier_type") == GEOGRAPHY) & (F.col("is_actv") == "Y") & (F.col("afl_id") != SPLIT_AFFILIATE)
    )
    none = F.lit(None).cast("string")
    plain = plain.withColumns({c: none for c in GEO_COLUMNS if c.startswith("subterritory_")})
    wanted = ["afl_id", "brik_id", "brik_nm", "ta", *GEO_COLUMNS]
    return plain.select(*wanted).unionByName(split_geography(geo))


def region_reference(reference: DataFrame) -> DataFrame:
    wanted = reference.select("global_region_name", "global_subregion_name", "affiliate_code", "country_name").distinct()
    return wanted.select(
        "global_region_name",
        "global_subregion_name",
        F.col("affiliate_code").alias("ref_affiliate"),
        F.upper("country_name").alias("ref_country"),
    )


def country_dimension(country: DataFrame, reference: DataFrame) -> DataFrame:
    """Countries of the newest batch with the regions found by affiliate and country name.

    The region depends on the country row alone, so the two lookups of a call become one.
    """
    newest = latest_snapshot(country, "pt_batch_id").drop("pt_batch_id")
    same = (F.col("afl_id") == F.col("ref_affiliate")) & (F.upper("country_name") == F.col("ref_country"))
    return newest.join(region_reference(reference), same, "left").drop("ref_affiliate", "ref_country")


def listed_products(products: DataFrame) -> DataFrame:
    wanted = products.select("source_product_name", "promotional_call_yn").distinct()
    return wanted.select(
        F.upper("source_product_name").alias("listed_product"), F.col("promotional_call_yn").alias("listed_flag")
    )
