"""DuckDB statement per registered query, written on its own from the operators' definitions."""

from __future__ import annotations

from checks.catalog import AFFILIATE, CALL_KEY, DATA_SOURCE, RANKS, THERAPY_AREAS
from checks.fixtures import CALL_RULES, with_clause
from fieldmart.schema import CALL_COLUMNS, FLAG_GRAINS, GEO_COLUMNS, HISTORY_COLUMNS, OUTPUT, PACKED, SAMPLE_COLUMNS, TIEBREAK

AREAS = ", ".join(f"'{a}'" for a in THERAPY_AREAS)
KEY = ", ".join(CALL_KEY)
C_KEY = ", ".join(f"c.{k}" for k in CALL_KEY)

PLAN = """plan AS (SELECT DISTINCT spl_cyc, ta, afl_id, cast(strt_dt AS timestamp) AS strt_dt,
    cast(end_dt AS timestamp) AS end_dt, sgmnt_prty, cust_id FROM fx_cycle_plan)"""


def _bounds(name: str, code: str) -> str:
    return f"""{name} AS (SELECT cast(max(time_perd_strt_dt) AS timestamp) AS s, cast(max(time_perd_end_dt) AS timestamp) AS e
    FROM fx_time_bckt WHERE bckt_cd = '{code}' AND upper(sbjct_area) = 'ACTIVITY')"""


def _earlier(column: str) -> str:
    return f"cast(cast(cast({column} AS date) - INTERVAL 4 MONTH AS date) AS timestamp)"


def _calendar(calls: str = "fx_call_dtl") -> str:
    return f"""{_bounds('b4', '4MC')}, {_bounds('p4', 'P4MC')},
pairs AS (SELECT DISTINCT afl_id, ta FROM {calls}),
lacking AS (SELECT p.afl_id, p.ta FROM pairs p WHERE NOT EXISTS
    (SELECT 1 FROM plan x WHERE x.spl_cyc = 'CC' AND x.afl_id = p.afl_id AND x.ta = p.ta)),
calendar AS (
    SELECT afl_id, ta, spl_cyc, strt_dt, end_dt FROM plan WHERE afl_id <> 'IT' OR spl_cyc = 'CC'
    UNION SELECT afl_id, ta, 'CC', s, e FROM lacking, b4
    UNION SELECT afl_id, ta, 'PC', s, e FROM pairs, p4 WHERE afl_id = 'IT'
    UNION SELECT afl_id, ta, 'PPC', {_earlier('s')}, {_earlier('e')} FROM pairs, p4 WHERE afl_id = 'IT')"""


CALLS = "calls AS (SELECT DISTINCT * FROM fx_call_dtl)"
CYCLES = f"{PLAN}, {_calendar()}"
IN_CYCLE = "y.ta = c.ta AND y.afl_id = c.afl_id AND c.call_dt BETWEEN y.strt_dt AND y.end_dt"
ATTRIBUTED = f"""attributed AS (SELECT c.*, y.spl_cyc, y.end_dt AS cycle_end
    FROM calls c LEFT JOIN calendar y ON {IN_CYCLE})"""


def _counts(low: str, high: str) -> str:
    return f"""counts AS (SELECT c.call_id, count(DISTINCT y.spl_cyc) AS n FROM calls c LEFT JOIN calendar y
    ON y.ta = c.ta AND y.afl_id = c.afl_id AND c.call_dt BETWEEN y.{low} AND y.{high} GROUP BY c.call_id)"""


ORDERED, AS_WRITTEN = _counts("strt_dt", "end_dt"), _counts("end_dt", "strt_dt")
HISTORY = """history AS (SELECT id, source_g360_product_detailed, entity_display_name_vod__c,
    CASE WHEN upper(clm_vod__c) = 'TRUE' THEN 1 WHEN upper(clm_vod__c) = 'FALSE' THEN 0 END AS is_clm_call
    FROM (SELECT * FROM fx_call_hist_a UNION ALL SELECT * FROM fx_call_hist_b) both_tables)"""
COUNTRY = "country AS (SELECT * FROM fx_cntry WHERE pt_batch_id = (SELECT max(pt_batch_id) FROM fx_cntry))"
CUSTOMER = """customer_one AS (SELECT eid, primary_address_line_3, primary_address_line_4 FROM
    (SELECT *, row_number() OVER (PARTITION BY eid ORDER BY primary_address_line_3 NULLS LAST,
        primary_address_line_4 NULLS LAST) AS nr FROM fx_cust WHERE upper(edw_actv_flg) = 'Y') x WHERE nr = 1)"""
TERRITORY = """territory AS (SELECT DISTINCT terr_id, ta, afl_id, territory_status FROM fx_emp_terr
    WHERE upper(edw_actv_flg) = 'Y' AND upper(geo_lvl_cd) = 'TERRITORY')"""
REGION = "region_ref AS (SELECT DISTINCT * FROM fx_geo_ref)"
LISTED = "listed AS (SELECT DISTINCT * FROM fx_nonpromo)"

_sub = [c for c in GEO_COLUMNS if c.startswith("subterritory_")]
SPLIT_GEO = f"""split_geo AS (SELECT DISTINCT a.afl_id, a.brik_id, a.brik_nm, a.ta,
    {', '.join(('b.' if c in _sub else 'a.') + c for c in GEO_COLUMNS)}
    FROM (SELECT * FROM fx_geo WHERE hier_type = 'ANALYSIS GROUP' AND is_actv = 'Y' AND afl_id = 'UKI') a
    LEFT JOIN (SELECT * FROM fx_geo WHERE hier_type = 'GEOGRAPHY' AND is_actv = 'Y' AND afl_id = 'UKI') b
    ON a.ta = b.ta AND a.affiliate_subterritory_name = b.affiliate_subterritory_name)"""
GEO = f"""{SPLIT_GEO}, geo AS (SELECT * FROM split_geo UNION ALL SELECT afl_id, brik_id, brik_nm, ta,
    {', '.join(f'cast(NULL AS varchar) AS {c}' if c in _sub else c for c in GEO_COLUMNS)}
    FROM fx_geo WHERE hier_type = 'GEOGRAPHY' AND is_actv = 'Y' AND afl_id <> 'UKI')"""


def _order(columns: list[str]) -> str:
    return "CASE WHEN n = 1 THEN NULL ELSE cycle_end END DESC NULLS LAST, " + ", ".join(
        f"{c} ASC NULLS FIRST" for c in columns
    )


def _flags(columns: list[str]) -> str:
    order = _order(columns)
    return ",\n    ".join(
        f"CASE WHEN row_number() OVER (PARTITION BY {', '.join(['call_id', *finer])} ORDER BY {order}) = 1"
        f" THEN 1 ELSE 0 END AS {flag}"
        for flag, finer in FLAG_GRAINS.items()
    )


def _ranks(columns: list[str]) -> str:
    return ", ".join(
        f"row_number() OVER (PARTITION BY {', '.join(['call_id', *finer])} ORDER BY {_order(columns)}) AS {rank}"
        for rank, finer in RANKS.items()
    )


_columns = [*CALL_RULES, "spl_cyc", "cycle_end"]
_lead = [c for c in TIEBREAK if c in _columns]
_small_order = _lead + [c for c in _columns if c not in _lead]


def _flagged(counts: str) -> str:
    return f"""WITH {CALLS}, {CYCLES}, {ATTRIBUTED}, {counts},
flagged AS (SELECT a.*, {_flags(_small_order)}, {_ranks(_small_order)} FROM
    (SELECT attributed.*, counts.n FROM attributed LEFT JOIN counts ON attributed.call_id = counts.call_id) a)"""


WHOLE_ORDER = [c for name in TIEBREAK for c in PACKED.get(name, [name])]


# Postal waterfall over `source`, which has pri_zip, pri_city and afl_id.
def _waterfall(source: str) -> str:
    city = "upper(trim(regexp_replace(f.pri_city, ',.*', '', 'g')))"

    def step(place: str) -> str:
        return f"""LEFT JOIN (SELECT DISTINCT plz, ims, {place} FROM fx_plz) m
        ON trim(f.pri_zip) = trim(m.plz) AND {city} = upper(trim(m.{place})) AND trim(f.afl_id) = 'DE'"""

    return f"""zip_counts AS (SELECT plz, count(DISTINCT ims) AS ims_cnt FROM fx_plz GROUP BY plz),
classed AS (SELECT s.*, z.ims_cnt FROM {source} s LEFT JOIN zip_counts z ON s.pri_zip = z.plz AND s.afl_id = 'DE'),
by_ort AS (SELECT f.*, m.ims FROM classed f {step('ort')} WHERE f.ims_cnt <> 1),
resolved AS (
    SELECT f.*, m.ims FROM classed f LEFT JOIN (SELECT DISTINCT plz, ims FROM fx_plz) m
        ON trim(f.pri_zip) = trim(m.plz) WHERE f.ims_cnt = 1
    UNION ALL SELECT * FROM by_ort WHERE ims IS NOT NULL
    UNION ALL SELECT f.*, m.ims FROM (SELECT * EXCLUDE (ims) FROM by_ort WHERE ims IS NULL) f {step('ortkurz')}
    UNION ALL SELECT f.*, cast(NULL AS varchar) AS ims FROM classed f WHERE f.ims_cnt IS NULL)"""


# The whole data product.
_made = {
    "data_source_name": f"'{DATA_SOURCE}'",
    "ms_name": "'NULL'",
    "cycle": """CASE spl_cyc WHEN 'CC' THEN 'current cycle' WHEN 'PC' THEN 'previous cycle'
        WHEN 'PPC' THEN 'previous to previous cycle' ELSE spl_cyc END""",
    "interaction_type": "CASE WHEN coalesce(upper(intractn_typ), 'NULL') = 'NULL' THEN 'F2F' ELSE intractn_typ END",
    "promotional_call_yn": "CASE WHEN src_prod_nm IS NULL THEN 'N' ELSE coalesce(listed_flag, 'Y') END",
    "ims_landscape_germany_only": "ims",
}
FINAL = ",\n    ".join(
    f"{_made.get(source, source)} AS {name}" for name, source in OUTPUT if name != "last_data_refresh_timestamp"
)


def _product(bounds: tuple[str, str], late: bool = False, scope: str = "true", plan_scope: str = "true") -> str:
    joined = f"""joined AS (SELECT c.*, y.spl_cyc, y.end_dt AS cycle_end, k.country_name, r.global_region_name,
    r.global_subregion_name, t.territory_status, {', '.join('g.' + c for c in GEO_COLUMNS)},
    l.promotional_call_yn AS listed_flag, {', '.join('h.' + c for c in HISTORY_COLUMNS)},
    {', '.join('s.' + c for c in SAMPLE_COLUMNS)}, u.primary_address_line_3, u.primary_address_line_4, counts.n
    FROM calls c
    LEFT JOIN country k ON k.cntry_id = c.src_cntry_id AND k.afl_id = c.afl_id
    LEFT JOIN counts ON counts.call_id = c.call_id
    LEFT JOIN customer_one u ON u.eid = c.cust_id
    LEFT JOIN history h ON h.id = c.call_id
    LEFT JOIN territory t ON t.terr_id = c.terr_id AND t.ta = c.ta AND t.afl_id = c.afl_id
    LEFT JOIN calendar y ON {IN_CYCLE}
    LEFT JOIN fx_samples s ON s.call_id = c.call_id AND s.src_prod_nm = c.src_prod_nm AND c.afl_id = 'FR'
    LEFT JOIN geo g ON g.brik_id = c.brik_id AND g.afl_id = c.afl_id AND g.ta = c.ta
    LEFT JOIN region_ref r ON r.affiliate_code = k.afl_id AND upper(r.country_name) = upper(k.country_name)
    LEFT JOIN listed l ON upper(l.source_product_name) = upper(c.src_prod_nm))"""
    flags_now = "joined.*" if late else f"joined.*, {_flags(WHOLE_ORDER)}"
    segments = f"""fact AS (SELECT f.*, p.sgmnt_prty AS prioritization FROM (SELECT {flags_now} FROM joined) f
    LEFT JOIN plan p ON p.ta = f.ta AND p.afl_id = f.afl_id AND p.spl_cyc = f.spl_cyc AND p.cust_id = f.cust_id)"""
    end = "SELECT * FROM resolved"
    if late:
        end = f"SELECT resolved.*, {_flags([*WHOLE_ORDER, 'prioritization', 'ims'])} FROM resolved"
    plan = PLAN.replace("FROM fx_cycle_plan", f"FROM fx_cycle_plan WHERE {plan_scope}")
    calls = f"calls AS (SELECT DISTINCT * FROM fx_call_dtl_wide WHERE {scope})"
    return f"""WITH {calls}, {plan}, {_calendar('calls')}, {_counts(*bounds)}, {HISTORY}, {COUNTRY}, {CUSTOMER},
{TERRITORY}, {REGION}, {LISTED}, {GEO}, {joined}, {segments}, {_waterfall('fact')}
SELECT {FINAL} FROM ({end}) done"""


_french = "upper(afl_id) = 'FR'"
_scope = f"upper(afl_id) = '{AFFILIATE}' AND upper(coalesce(ta, 'UNASSIGNED_TA')) IN ({AREAS})"

STATEMENTS = {
    "q_scan_mapped": "SELECT c_custkey AS cust_id, c_name AS cust_nm, c_mktsegment AS clsfn, c_acctbal AS wtg FROM customer",
    "q_scan_by_region": f"SELECT {', '.join(CALL_COLUMNS)} FROM fx_call_dtl_wide WHERE upper(afl_id) = '{AFFILIATE}'",
    "q_samples_scan": "SELECT * FROM fx_samples WHERE upper(afl_id) = 'FR'",
    "q_cycle_scan": f"WITH {PLAN} SELECT * FROM plan WHERE coalesce(ta, 'UNASSIGNED_TA') IN ({AREAS})",
    "q_distinct_calls": "SELECT DISTINCT * FROM fx_call_dtl",
    "q_affiliate_filter": f"SELECT call_id, afl_id, ta FROM fx_call_dtl WHERE upper(afl_id) = '{AFFILIATE}'",
    "q_ta_filter_default": f"SELECT call_id, ta FROM fx_call_dtl WHERE upper(coalesce(ta, 'UNASSIGNED_TA')) IN ({AREAS})",
    "q_active_flag": "SELECT eid, edw_actv_flg FROM fx_cust WHERE upper(edw_actv_flg) = 'Y'",
    "q_null_dropping_neq": "SELECT call_id, ta FROM fx_call_dtl WHERE ta IS NOT NULL AND ta <> 'PROMO'",
    "q_interaction_default": f"SELECT call_id, brd_nm, src_prod_nm, {_made['interaction_type']} AS interaction_type FROM fx_call_dtl",
    "q_clm_flag": """SELECT id, CASE lower(clm_vod__c) WHEN 'true' THEN 1 WHEN 'false' THEN 0 END AS is_clm_call
        FROM (SELECT * FROM fx_call_hist_a UNION ALL SELECT * FROM fx_call_hist_b)""",
    "q_cycle_label": f"WITH {PLAN} SELECT cust_id, spl_cyc, {_made['cycle']} AS cycle FROM plan",
    "q_normalise_city": "SELECT call_id, upper(trim(split_part(pri_city, ',', 1))) AS city_norm FROM fx_call_dtl",
    "q_text_null_literal": "SELECT c_custkey, 'NULL' AS ms_name FROM customer",
    "q_bucket_bounds": f"WITH {_bounds('b4', '4MC')} SELECT s AS strt_dt, e AS end_dt FROM b4",
    "q_bucket_shift_months": f"""WITH {_bounds('p4', 'P4MC')} SELECT s AS strt_dt, e AS end_dt,
        {_earlier('s')} AS strt_before, {_earlier('e')} AS end_before FROM p4""",
    "q_cross_one_row": f"""WITH {_bounds('b4', '4MC')} SELECT DISTINCT afl_id, ta, 'CC' AS spl_cyc,
        s AS strt_dt, e AS end_dt FROM fx_call_dtl, b4""",
    "q_anti_missing_cycle": f"WITH {CYCLES} SELECT * FROM lacking",
    "q_cycle_calendar": f"WITH {CYCLES} SELECT * FROM calendar",
    "q_cycle_attribution": f"WITH {CALLS}, {CYCLES}, {ATTRIBUTED} SELECT {KEY}, call_dt, spl_cyc, cycle_end FROM attributed",
    "q_overlap_count_as_written": f"WITH {CALLS}, {CYCLES}, {AS_WRITTEN} SELECT * FROM counts",
    "q_overlap_count_ordered": f"WITH {CALLS}, {CYCLES}, {ORDERED} SELECT * FROM counts",
    "q_first_flags": f"{_flagged(ORDERED)} SELECT {KEY}, call_dt, spl_cyc, cycle_end, {', '.join(FLAG_GRAINS)} FROM flagged",
    "q_first_flags_as_written": f"""{_flagged(AS_WRITTEN)}
        SELECT {KEY}, call_dt, spl_cyc, cycle_end, {', '.join(FLAG_GRAINS)} FROM flagged""",
    "q_row_numbers": f"""{_flagged(ORDERED)}
        SELECT {KEY}, call_dt, spl_cyc, cycle_end, {', '.join(RANKS)} FROM flagged""",
    "q_metric_rollup": f"""{_flagged(ORDERED)} SELECT afl_id, ta,
        {', '.join(f'cast(sum({flag}) AS bigint) AS {flag}' for flag in FLAG_GRAINS)} FROM flagged GROUP BY afl_id, ta""",
    "q_metric_rollup_of_flags": f"""{_flagged(ORDERED)} SELECT afl_id, ta,
        {', '.join(f'cast(sum({flag}) AS bigint) AS {flag}' for flag in FLAG_GRAINS)} FROM flagged GROUP BY afl_id, ta""",
    "q_latest_snapshot": f"""WITH {CALLS}, {COUNTRY} SELECT {C_KEY}, k.country_name FROM calls c
        LEFT JOIN country k ON k.cntry_id = c.src_cntry_id AND k.afl_id = c.afl_id""",
    "q_dedup_lookup": f"""WITH {CALLS}, {CUSTOMER} SELECT {C_KEY}, primary_address_line_3, primary_address_line_4
        FROM calls c LEFT JOIN customer_one u ON u.eid = c.cust_id""",
    "q_history_union": f"WITH {HISTORY} SELECT * FROM history",
    "q_history_lookup": f"""WITH {CALLS}, {HISTORY} SELECT {C_KEY}, {', '.join(HISTORY_COLUMNS)}
        FROM calls c LEFT JOIN history h ON h.id = c.call_id""",
    "q_territory_status": f"""WITH {CALLS}, {TERRITORY} SELECT {C_KEY}, c.terr_id, t.territory_status FROM calls c
        LEFT JOIN territory t ON t.terr_id = c.terr_id AND t.ta = c.ta AND t.afl_id = c.afl_id""",
    "q_conditional_lookup": f"""WITH {CALLS} SELECT {C_KEY}, s.sample_name, s.quantity_vod__c FROM calls c
        LEFT JOIN fx_samples s ON s.call_id = c.call_id AND s.src_prod_nm = c.src_prod_nm AND c.afl_id = 'FR'""",
    "q_geo_hierarchy": f"""WITH {CALLS}, {GEO} SELECT {C_KEY}, c.brik_id, g.affiliate_subterritory_name,
        g.subterritory_hiearachy_level_1, g.brick_hierarchy_level_1 FROM calls c
        LEFT JOIN geo g ON g.brik_id = c.brik_id AND g.afl_id = c.afl_id AND g.ta = c.ta""",
    "q_geo_uki_self_join": f"WITH {SPLIT_GEO} SELECT * FROM split_geo",
    "q_region_reference": f"""WITH {CALLS}, {COUNTRY}, {REGION} SELECT {C_KEY}, k.country_name, r.global_region_name,
        r.global_subregion_name FROM calls c
        LEFT JOIN country k ON k.cntry_id = c.src_cntry_id AND k.afl_id = c.afl_id
        LEFT JOIN region_ref r ON r.affiliate_code = k.afl_id AND upper(r.country_name) = upper(k.country_name)""",
    "q_promo_flag": f"""WITH {CALLS}, {LISTED} SELECT {C_KEY},
        CASE WHEN c.src_prod_nm IS NULL THEN 'N' ELSE coalesce(l.promotional_call_yn, 'Y') END AS promotional_call_yn
        FROM calls c LEFT JOIN listed l ON upper(l.source_product_name) = upper(c.src_prod_nm)""",
    "q_segment_priority": f"""WITH {CALLS}, {CYCLES}, {ATTRIBUTED}
        SELECT {', '.join('a.' + k for k in CALL_KEY)}, a.cust_id, a.spl_cyc, p.sgmnt_prty FROM attributed a
        LEFT JOIN plan p ON p.ta = a.ta AND p.afl_id = a.afl_id AND p.spl_cyc = a.spl_cyc AND p.cust_id = a.cust_id""",
    "q_ims_count_distinct": "SELECT plz, count(DISTINCT ims) AS ims_cnt FROM fx_plz GROUP BY plz",
    "q_ims_class_split": f"""WITH {_waterfall('fx_call_dtl')} SELECT afl_id, CASE WHEN ims_cnt = 1 THEN 'one'
        WHEN ims_cnt IS NULL THEN 'none' ELSE 'not_one' END AS class, count(*) AS rows FROM classed GROUP BY 1, 2""",
    "q_plz_waterfall": f"""WITH {_waterfall('fx_call_dtl')}
        SELECT call_id, brd_nm, src_prod_nm, afl_id, pri_zip, pri_city, ims_cnt, ims FROM resolved""",
    "q_data_product": _product(("end_dt", "strt_dt")),
    "q_data_product_one_affiliate": _product(("end_dt", "strt_dt"), scope=_scope, plan_scope=_scope),
    "q_data_product_runs": f"""SELECT *, 'DE' AS run FROM ({_product(("end_dt", "strt_dt"), scope=_scope, plan_scope=_scope)})
        UNION ALL SELECT *, 'FR' AS run FROM ({_product(("strt_dt", "end_dt"), scope=_french, plan_scope=_french)})""",
    "q_data_product_late_flags": _product(("strt_dt", "end_dt"), late=True),
}

_known = {*CALL_COLUMNS, *_made} - {"cycle", "promotional_call_yn", "ims_landscape_germany_only"}
_bare = ",\n    ".join(
    f"{_made.get(source, source)} AS {name}" if source in _known else
    f"CASE WHEN src_prod_nm IS NULL THEN 'N' ELSE 'Y' END AS {name}" if name == "promotional_call_yn" else
    f"cast(NULL AS varchar) AS {name}"
    for name, source in OUTPUT if name != "last_data_refresh_timestamp"
)
STATEMENTS["q_final_projection"] = f"SELECT {_bare} FROM (SELECT DISTINCT * FROM fx_call_dtl_wide) c"


def oracle_sql() -> dict[str, str]:
    return {name: with_clause(sql) for name, sql in STATEMENTS.items()}
