"""The registered queries: one per operator, each over the whole of its input tables."""

from __future__ import annotations

from functools import cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from fieldmart.functions import normalise as n
from fieldmart.limits import DEFAULT, Limits
from fieldmart.operators import calendar as cal
from fieldmart.operators import flags as fl
from fieldmart.operators import lookups as look
from fieldmart.operators import waterfall as wf
from fieldmart.operators.attribution import attribute, overlap_count, with_one_cycle
from fieldmart.operators.sizing import fits
from fieldmart.operators.skew import distinct_by, distinct_in_place, split_hot, together, weighed
from fieldmart.params import JobParams
from fieldmart.plans.product import build_product, final_projection
from fieldmart.plans.runs import build_products
from fieldmart.schema import CYCLE_COLUMNS, FLAG_GRAINS, OUTPUT, TIEBREAK, WALL_CLOCK
from fieldmart.session import pin, shared_folder, tune
from fieldmart.sources.tables import map_all, mapped, mapped_table, table_name

AFFILIATE = "DE"
THERAPY_AREAS = ("ECONOMY", "MEDIUM", n.UNASSIGNED_TA)
DATA_SOURCE = "CRM"
CALL_KEY = ["call_id", "brd_nm", "src_prod_nm", "ta", "afl_id", "wtg"]

REGISTRY: dict = {}


class Inputs:
    """The stand-in tables of one test folder, under their logical names."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.read = partial(fixtures.table, spark, sf_dir)
        self.made_once = partial(fixtures.made_once, spark, sf_dir)

    @property
    def call_rows(self) -> DataFrame:
        rows = self.read("fx_call_dtl")
        return rows.withColumn("call_dt", F.col("call_dt").cast(WALL_CLOCK))

    @property
    def calls(self) -> DataFrame:
        return self.call_rows.distinct()

    @property
    def plan_rows(self) -> DataFrame:
        """Duplicates still in, as the calendar takes them."""
        return mapped_table("cycle_plan", self.read("fx_cycle_plan"))

    @property
    def plan(self) -> DataFrame:
        return distinct_by(self.plan_rows)

    @property
    def call_keys(self) -> DataFrame:
        return self.call_rows.select("afl_id", "ta").distinct()

    def new_calendar(self) -> DataFrame:
        return cal.build_calendar(self.plan_rows, self.call_keys, self.read("fx_time_bckt"))

    @cached_property
    def calendar(self) -> DataFrame:
        """Made once: it is measured and then joined, in some queries twice."""
        return pin(self.new_calendar())

    @property
    def histories(self) -> DataFrame:
        return look.call_history(self.read("fx_call_hist_a"), self.read("fx_call_hist_b"))

    @property
    def countries(self) -> DataFrame:
        return look.latest_snapshot(self.read("fx_cntry"), "pt_batch_id").drop("pt_batch_id")


def register(function):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Inputs(spark, sf_dir))

    query.__name__ = function.__name__
    REGISTRY[function.__name__] = query
    return function


# Sources


@register
def q_scan_mapped(t):
    names = {"cust_id": "c_custkey", "cust_nm": "c_name", "clsfn": "c_mktsegment", "wtg": "c_acctbal"}
    return mapped(t.read("customer"), list(names), names)


@register
def q_scan_by_region(t):
    """All columns of the call table, found by the name its region gives it."""
    t.read("fx_call_dtl_wide").createOrReplaceTempView("eu_call_detail")
    calls = t.spark.table(table_name("{region}_call_detail", "eu"))
    return mapped_table("call_detail", calls).where(n.equals_ignoring_case(F.col("afl_id"), AFFILIATE))


@register
def q_samples_scan(t):
    samples = t.read("fx_samples")
    return samples.where(n.equals_ignoring_case(F.col("afl_id"), "FR"))


@register
def q_cycle_scan(t):
    plan = mapped_table("cycle_plan", t.read("fx_cycle_plan"))
    return distinct_by(plan.where(n.in_list_with_default(F.col("ta"), THERAPY_AREAS)).select(*CYCLE_COLUMNS))


@register
def q_distinct_calls(t):
    return t.calls


# Filters and scalar expressions


@register
def q_affiliate_filter(t):
    return t.call_rows.where(n.equals_ignoring_case(F.col("afl_id"), AFFILIATE)).select("call_id", "afl_id", "ta")


@register
def q_ta_filter_default(t):
    return t.call_rows.where(n.in_list_with_default(F.col("ta"), THERAPY_AREAS)).select("call_id", "ta")


@register
def q_active_flag(t):
    return t.read("fx_cust").where(n.is_yes(F.col("edw_actv_flg"))).select("eid", "edw_actv_flg")


@register
def q_null_dropping_neq(t):
    return t.call_rows.where(F.col("ta") != "PROMO").select("call_id", "ta")


@register
def q_interaction_default(t):
    kind = n.interaction_type(F.col("intractn_typ")).alias("interaction_type")
    return t.call_rows.select("call_id", "brd_nm", "src_prod_nm", kind)


@register
def q_clm_flag(t):
    both = t.read("fx_call_hist_a").unionByName(t.read("fx_call_hist_b"))
    return both.select("id", n.text_flag(F.col("clm_vod__c")).alias("is_clm_call"))


@register
def q_cycle_label(t):
    return t.plan.select("cust_id", "spl_cyc", n.cycle_label(F.col("spl_cyc")).alias("cycle"))


@register
def q_normalise_city(t):
    return t.call_rows.select("call_id", n.city_key(F.col("pri_city")).alias("city_norm"))


@register
def q_text_null_literal(t):
    return t.read("customer").select("c_custkey", n.text_null().alias("ms_name"))


# Calendar


@register
def q_bucket_bounds(t):
    return cal.bucket_bounds(t.read("fx_time_bckt"), cal.CURRENT_BUCKET)


@register
def q_bucket_shift_months(t):
    bounds = cal.bucket_bounds(t.read("fx_time_bckt"), cal.PREVIOUS_BUCKET)
    earlier = cal.shifted(bounds).select(F.col("strt_dt").alias("strt_before"), F.col("end_dt").alias("end_before"))
    return bounds.crossJoin(F.broadcast(earlier))


@register
def q_cross_one_row(t):
    bounds = cal.bucket_bounds(t.read("fx_time_bckt"), cal.CURRENT_BUCKET)
    return cal.with_bounds(t.call_keys, cal.CURRENT, bounds)


@register
def q_anti_missing_cycle(t):
    return cal.without_cycle(t.call_keys, t.plan)


@register
def q_cycle_calendar(t):
    return t.new_calendar()


# Attribution, counts and flags


@register
def q_cycle_attribution(t):
    return attribute(t.calls, t.calendar).select(*CALL_KEY, "call_dt", "spl_cyc", "cycle_end")


@register
def q_overlap_count_as_written(t):
    return overlap_count(t.call_rows, t.calendar, "as_written")


@register
def q_overlap_count_ordered(t):
    return overlap_count(t.call_rows, t.calendar, "ordered")


RANKS = {"ranking_call": [], "ranking_product": ["brd_nm"], "ranking_ta": ["ta"]}


FLAG_WAYS = {fl.first_flags: (fl.first_flags, fl.first_flags_of_hot), fl.row_numbers: (fl.row_numbers, fl.numbers_of_hot)}


def _order_of(rows):
    order = [c for c in TIEBREAK if c in rows.columns]
    return order + [c for c in rows.columns if c not in [*order, "n"]]


def _with_cycles(t, calls, bounds, **way):
    counts = overlap_count(t.call_rows, t.calendar, bounds)
    return attribute(look.lookup(calls, counts, {"call_id": "call_id"}, **way), t.calendar)


def _flagged(t, bounds="ordered", add=fl.first_flags, grains=FLAG_GRAINS, limits=DEFAULT):
    plain, spread = FLAG_WAYS[add]
    calls = t.call_rows
    count, hot = weighed([calls.select("call_id")], limits)
    ordinary, crowded = (calls, None) if hot is None else split_hot(calls, "call_id", hot, limits)
    ordinary = distinct_by(ordinary, count[0], "call_id", limits=limits)
    if bounds == "ordered":  # one join with the calendar tells both
        rows = with_one_cycle(attribute(ordinary, t.calendar))
    else:
        rows = _with_cycles(t, ordinary, bounds, balanced=True)
    rows = plain(rows, "call_id", fl.deciding_date(), _order_of(rows), grains)
    if hot is None:
        return rows
    # Rows of a crowded call never meet in one task: a distinct over all columns, a split join.
    found = _with_cycles(t, crowded.distinct(), bounds, hot=hot.withColumn("rows_1", F.lit(1).cast("long")), limits=limits)
    return rows.unionByName(spread(found, "call_id", fl.deciding_date(), _order_of(found), grains, limits=limits))


@register
def q_first_flags(t):
    return _flagged(t).select(*CALL_KEY, "call_dt", "spl_cyc", "cycle_end", *FLAG_GRAINS)


@register
def q_first_flags_as_written(t):
    return _flagged(t, "as_written").select(*CALL_KEY, "call_dt", "spl_cyc", "cycle_end", *FLAG_GRAINS)


@register
def q_row_numbers(t):
    return _flagged(t, add=fl.row_numbers, grains=RANKS).select(*CALL_KEY, "call_dt", "spl_cyc", "cycle_end", *RANKS)


@register
def q_metric_rollup(t):
    calls = t.call_rows
    count, hot = weighed([calls.select("call_id")])
    calls = calls if hot is not None else together(calls, count[0], "call_id")
    rows = _with_cycles(t, calls, "ordered", balanced=True)
    return fl.rollup_of_rows(rows, "call_id", fl.deciding_date(), _order_of(rows), ["afl_id", "ta"])


@register
def q_metric_rollup_of_flags(t):
    return fl.metric_rollup(_flagged(t), ["afl_id", "ta"])


# Lookups


def _look_up(t, dim, on, key, measured=None, by=None, prepare=lambda calls: calls, limits=DEFAULT):
    """Lookup on the distinct calls, which are shuffled once, by a key column among `on`, unless it is hot.

    Hot keys are counted on narrow scans, so that the distinct is made once. `measured` stands for dim where it is
    measured and counted, `by` gives dim for so many rows and where the key brings them, `prepare` adds to the calls.
    """
    measured = dim if measured is None else measured
    if fits(measured, limits):
        return look.lookup(prepare(t.calls), dim, on, small=True)
    tune(t.spark)
    name = next(name for name, column in on.items() if isinstance(column, str) and column == key)
    counts, hot = weighed([t.call_rows.select(key), measured.select(F.col(name).alias(key))], limits)
    if hot is None:
        calls = distinct_by(t.call_rows, max(counts), key, limits=limits)
        return look.lookup(prepare(calls), by(max(counts)) if by else dim, on, balanced=True)
    return look.lookup(prepare(t.calls), dim, on, small=False, keys_from=prepare(t.call_rows), limits=limits)


@register
def q_latest_snapshot(t):
    found = look.lookup(t.calls, t.countries, {"cntry_id": "src_cntry_id", "afl_id": "afl_id"})
    return found.select(*CALL_KEY, "country_name")


@register
def q_dedup_lookup(t):
    found = _look_up(t, look.active_customers(t.read("fx_cust")), {"eid": "cust_id"}, "cust_id")
    return found.select(*CALL_KEY, "primary_address_line_3", "primary_address_line_4")


@register
def q_history_union(t):
    return t.histories


@register
def q_history_lookup(t):
    found = _look_up(t, t.histories, {"id": "call_id"}, "call_id")
    return found.select(*CALL_KEY, "source_g360_product_detailed", "entity_display_name_vod__c", "is_clm_call")


@register
def q_territory_status(t):
    territories = look.active_territories(t.read("fx_emp_terr"))
    found = look.lookup(t.calls, territories, {"terr_id": "terr_id", "ta": "ta", "afl_id": "afl_id"})
    return found.select(*CALL_KEY, "terr_id", "territory_status")


@register
def q_conditional_lookup(t):
    samples = t.read("fx_samples").select("call_id", "src_prod_nm", "sample_name", "quantity_vod__c")
    # No key, no match: the condition on one key does for both.
    on = {"call_id": "call_id", "src_prod_nm": F.when(F.col("afl_id") == "FR", F.col("src_prod_nm"))}
    found = _look_up(t, samples, on, "call_id")
    return found.select(*CALL_KEY, "sample_name", "quantity_vod__c")


@register
def q_geo_hierarchy(t):
    geo = look.geo_dimension(t.read("fx_geo")).drop("brik_nm")
    found = look.lookup(t.calls, geo, {"brik_id": "brik_id", "afl_id": "afl_id", "ta": "ta"})
    return found.select(
        *CALL_KEY,
        "brik_id",
        "affiliate_subterritory_name",
        "subterritory_hiearachy_level_1",
        "brick_hierarchy_level_1",
    )


@register
def q_geo_uki_self_join(t):
    return look.split_geography(t.read("fx_geo"))


@register
def q_region_reference(t):
    countries = look.country_dimension(t.read("fx_cntry"), t.read("fx_geo_ref"))
    found = look.lookup(t.calls, countries, {"cntry_id": "src_cntry_id", "afl_id": "afl_id"})
    return found.select(*CALL_KEY, "country_name", "global_region_name", "global_subregion_name")


@register
def q_promo_flag(t):
    listed = look.listed_products(t.read("fx_nonpromo"))
    found = look.lookup(t.calls, listed, {"listed_product": F.upper("src_prod_nm")})
    flag = n.promotional(F.col("src_prod_nm"), F.col("listed_flag"))
    return found.select(*CALL_KEY, flag.alias("promotional_call_yn"))


@register
def q_segment_priority(t):
    on = {k: k for k in ("ta", "afl_id", "spl_cyc", "cust_id")}
    kept = [*on, "sgmnt_prty"]
    found = _look_up(
        t,
        t.plan_rows.distinct().select(*kept),
        on,
        "cust_id",
        measured=t.plan_rows.select(*kept),
        by=lambda count: distinct_by(t.plan_rows, count, "cust_id").select(*kept),
        prepare=lambda calls: attribute(calls, t.calendar),
    )
    return found.select(*CALL_KEY, "cust_id", "spl_cyc", "sgmnt_prty")


# Postal waterfall


@register
def q_ims_count_distinct(t):
    return wf.value_counts(t.read("fx_plz"))


@register
def q_ims_class_split(t):
    classed = wf.classify(t.call_rows, wf.value_counts(t.read("fx_plz")), "pri_zip", "afl_id")
    kind = wf.ambiguity_class(F.col("ims_cnt")).alias("class")
    return classed.groupBy("afl_id", kind).agg(F.count("*").alias("rows"))


@register
def q_plz_waterfall(t):
    return wf.waterfall(t.call_rows, t.read("fx_plz")).select(
        "call_id", "brd_nm", "src_prod_nm", "afl_id", "pri_zip", "pri_city", "ims_cnt", "ims"
    )


# The data product


MADE_ONCE = {"call_detail", "discussion_sample"}  # the product scans these several times, and both are joins


def product(t, **options) -> DataFrame:
    whole = options.get("affiliate") is None  # else a scan of them all would do more than several of one affiliate's
    tables = {
        name: (t.made_once if whole and name in MADE_ONCE else t.read)(fixture)
        for name, fixture in fixtures.PRODUCT_TABLES.items()
    }
    tables = map_all(tables)
    return build_product(tables, JobParams(data_source=DATA_SOURCE, **options))


@register
def q_data_product(t):
    return product(t).drop("last_data_refresh_timestamp")


@register
def q_data_product_one_affiliate(t):
    return product(t, affiliate=AFFILIATE, therapy_areas=THERAPY_AREAS).drop("last_data_refresh_timestamp")


@register
def q_data_product_late_flags(t):
    found = product(t, overlap_bounds="ordered", flags_after_enrichment=True)
    return found.drop("last_data_refresh_timestamp")


@register
def q_data_product_runs(t):
    """Two affiliates in one job, which reads the calls once."""
    tables = map_all({name: t.read(fixture) for name, fixture in fixtures.PRODUCT_TABLES.items()})
    runs = {
        "DE": JobParams(affiliate="DE", therapy_areas=THERAPY_AREAS, data_source=DATA_SOURCE),
        "FR": JobParams(affiliate="FR", data_source=DATA_SOURCE, overlap_bounds="ordered"),
    }
    products = build_products(tables, runs, shared_folder(t.spark, "runs"))
    named = [df.drop("last_data_refresh_timestamp").withColumn("run", F.lit(name)) for name, df in products.items()]
    return reduce(DataFrame.unionByName, named)


@register
def q_final_projection(t):
    calls = distinct_in_place(mapped_table("call_detail", t.read("fx_call_dtl_wide")))
    found = {source for _, source in OUTPUT} | {"spl_cyc", "listed_flag", "ims"}
    rows = calls.withColumns({c: F.lit(None).cast("string") for c in sorted(found) if c not in calls.columns})
    return final_projection(rows, JobParams(data_source=DATA_SOURCE)).drop("last_data_refresh_timestamp")
