"""Stand-in input tables, derived from the generated test tables.

Each is one SELECT that means the same in Spark SQL and in DuckDB, so that both sides of a check
read equal inputs. {name} stands for a table or for another stand-in.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from fieldmart.schema import CALL_COLUMNS
from fieldmart.session import written

BASE_TABLES = "region nation customer part orders lineitem".split()

# Affiliate of a nation.
AFFILIATE = (
    "CASE n_regionkey WHEN 0 THEN 'FR' WHEN 1 THEN 'IT' WHEN 2 THEN 'DE' WHEN 3 THEN 'UKI' ELSE 'JP' END"
)
AFFILIATES = "(SELECT DISTINCT " + AFFILIATE + " AS afl_id FROM {nation}) a"
TWO = "(SELECT 0 AS copy UNION ALL SELECT 1 AS copy) two"


def text(number: str) -> str:
    return f"cast({number} AS string)"


def _listed(name: str, column: str, values: str) -> str:
    return "(" + " UNION ALL ".join(f"SELECT '{v}' AS {column}" for v in values.split()) + f") {name}"


# The call columns that operators work with; the wide table adds the rest as plain text.
CALL_RULES = {
    "afl_id": AFFILIATE,
    "src_cntry_id": f"'C' || {text('n_nationkey')}",
    "brik_id": f"'B' || {text('c_custkey % 20')}",
    "pri_city": f"""CASE WHEN c_custkey % 7 = 0 THEN NULL
        WHEN c_custkey % 2 = 0 THEN 'City' || {text('c_custkey % 6')} || ', Nord'
        ELSE 'city' || {text('c_custkey % 6')} END""",
    "pri_zip": f"CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE '' END || 'Z' || {text('c_custkey % 30')}",
    "terr_id": f"'T' || {text('c_custkey % 25')}",
    "ta": "CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_type END",
    "src_prod_nm": "CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_name END",
    "cust_id": f"'H' || {text('c_custkey')}",
    "call_dt": "o_orderdate",
    "call_id": f"'O' || {text('o_orderkey')}",
    "intractn_typ": """CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN 'null'
        ELSE o_orderpriority END""",
    "wtg": "l_quantity",
    "brd_nm": "p_brand",
}
CALLS_FROM = f"""
    FROM {{lineitem}} l JOIN {{orders}} o ON l_orderkey = o_orderkey
    JOIN {{part}} p ON l_partkey = p_partkey
    JOIN {{customer}} c ON o_custkey = c_custkey
    JOIN {{nation}} n ON c_nationkey = n_nationkey
    CROSS JOIN {TWO}
    WHERE copy = 0 OR o_orderkey % 20 = 0"""


def _calls(columns: list[str]) -> str:
    # Plain text columns depend on the customer alone and are made before the joins.
    plain = [c for c in columns if c not in CALL_RULES]
    made = "".join(f", '{c}-' || {text('c_custkey % 10')} AS {c}" for c in plain)
    rules = [f"{CALL_RULES.get(c, c)} AS {c}" for c in columns]
    source = CALLS_FROM.replace("{customer} c", f"(SELECT c_custkey, c_nationkey{made} FROM {{customer}}) c")
    return "SELECT " + ",\n    ".join(rules) + source


_sample_text = ", ".join(
    f"'{c}-' || {text('l_linenumber')} AS {c}"
    for c in """objection_gild_e__c ms_slide_decks_used_gild__c discussion_topics_gild__c call_discussion_name
    actions_gild__c indication__C comments__c prod_type call_sample_name""".split()
)


def _history(owner: str, kept: str) -> str:
    return f"""
    SELECT 'O' || {text('o_orderkey')} AS id, o_orderstatus AS source_g360_product_detailed,
        '{owner}' || {text('o_custkey')} AS entity_display_name_vod__c,
        CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'n/a' END AS clm_vod__c
    FROM {{orders}} WHERE {kept}"""


def _levels(prefix: str, key: str) -> str:
    return ", ".join(f"'L{i}-' || tag || {text(key)} AS {prefix}_level_{i}" for i in (1, 2, 3))


FIXTURES = {
    "fx_call_dtl": _calls(list(CALL_RULES)),
    "fx_call_dtl_wide": _calls(CALL_COLUMNS),
    "fx_samples": f"""
    SELECT 'O' || {text('l_orderkey')} AS call_id,
        CASE WHEN l_returnflag = 'R' THEN p_name ELSE 'unsampled ' || p_name END AS src_prod_nm, {_sample_text},
        l_quantity AS quantity_vod__c, 'S' || {text('l_linenumber')} AS sample_name, {AFFILIATE} AS afl_id
    FROM {{lineitem}} l JOIN {{part}} p ON l_partkey = p_partkey
    JOIN {{orders}} o ON l_orderkey = o_orderkey
    JOIN {{customer}} c ON o_custkey = c_custkey JOIN {{nation}} n ON c_nationkey = n_nationkey""",
    "fx_cycle_plan": f"""
    SELECT spl_cyc, ta, {AFFILIATE} AS afl_id, strt_dt, end_dt,
        CASE WHEN copy = 1 THEN 'P9' ELSE 'P' || {text('c_custkey % 4')} END AS sgmnt_prty,
        CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'H' ELSE 'X' END || {text('c_custkey')} AS cust_id
    FROM {{customer}} c JOIN {{nation}} n ON c_nationkey = n_nationkey
    CROSS JOIN (SELECT 'CC' AS spl_cyc, cast('2000-12-01' AS date) AS strt_dt, cast('2001-08-01' AS date) AS end_dt
        UNION ALL SELECT 'PC', cast('2000-06-01' AS date), cast('2000-12-31' AS date)
        UNION ALL SELECT 'PPC', cast('1999-12-01' AS date), cast('2000-06-30' AS date)
        UNION ALL SELECT 'D1', cast('2001-01-17' AS date), cast('2001-01-17' AS date)
        UNION ALL SELECT 'X1', cast('2001-03-31' AS date), cast('2001-03-01' AS date)) cyc
    CROSS JOIN (SELECT DISTINCT p_type AS ta FROM {{part}} WHERE p_type <> 'SMALL') t
    CROSS JOIN {TWO}
    WHERE (copy = 0 OR c_custkey % 5 = 0)
        AND NOT (spl_cyc = 'CC' AND (ta IN ('PROMO', 'LARGE') OR n_regionkey IN (0, 4)))""",
    "fx_time_bckt": """
    SELECT CASE WHEN o_orderdate >= '2001-08-01' THEN 'N4MC' WHEN o_orderdate >= '2001-04-01' THEN '4MC'
            WHEN o_orderdate >= '2000-12-01' THEN 'P4MC' ELSE 'OLD' END AS bckt_cd,
        CASE o_orderstatus WHEN 'O' THEN 'Activity' WHEN 'F' THEN 'ACTIVITY' ELSE 'SALES' END AS sbjct_area,
        CASE WHEN o_orderdate >= '2001-08-01' THEN cast('2001-08-01' AS date)
            WHEN o_orderdate >= '2001-04-01' THEN cast('2001-04-01' AS date)
            WHEN o_orderdate >= '2000-12-01' THEN cast('2000-12-01' AS date)
            ELSE cast(o_orderdate AS date) END AS time_perd_strt_dt,
        CASE WHEN o_orderdate >= '2001-08-01' THEN cast('2001-11-30' AS date)
            WHEN o_orderdate >= '2001-04-01' THEN cast('2001-07-31' AS date)
            WHEN o_orderdate >= '2000-12-01' THEN cast('2001-03-31' AS date)
            ELSE cast(o_orderdate AS date) END AS time_perd_end_dt
    FROM {orders}""",
    "fx_call_hist_a": _history("E", "o_orderstatus <> 'P'"),
    "fx_call_hist_b": _history("J", "o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'"),
    "fx_cntry": f"""
    SELECT 'C' || {text('n_nationkey')} AS cntry_id, n_name || '-b' || {text('copy')} AS country_name,
        {AFFILIATE} AS afl_id, copy AS pt_batch_id
    FROM {{nation}} CROSS JOIN {TWO} WHERE copy = 0 OR n_name NOT LIKE '%7'""",
    "fx_cust": f"""
    SELECT 'H' || {text('c_custkey')} AS eid,
        'A3-' || {text('c_custkey')} || '-' || {text('copy')} AS primary_address_line_3,
        CASE WHEN copy = 0 THEN c_mktsegment END AS primary_address_line_4,
        CASE WHEN c_custkey % 6 = 0 THEN 'N' WHEN c_custkey % 2 = 0 THEN 'y' ELSE 'Y' END AS edw_actv_flg
    FROM {{customer}} CROSS JOIN {TWO} WHERE copy = 0 OR c_custkey % 10 = 0""",
    "fx_emp_terr": f"""
    SELECT 'T' || {text('k')} AS terr_id, ta, afl_id,
        CASE WHEN k % 5 = 0 AND copy = 1 THEN 'Vacant' ELSE 'Active' END AS territory_status,
        CASE WHEN k = 24 THEN 'N' ELSE 'y' END AS edw_actv_flg,
        CASE WHEN k % 6 = 0 THEN 'Region' ELSE 'Territory' END AS geo_lvl_cd
    FROM (SELECT DISTINCT c_custkey % 25 AS k FROM {{customer}}) c CROSS JOIN {AFFILIATES}
    CROSS JOIN {_listed('t', 'ta', 'ECONOMY MEDIUM STANDARD')} CROSS JOIN {TWO}""",
    "fx_geo": f"""
    SELECT afl_id, 'B' || {text('k')} AS brik_id, 'Brick ' || {text('k')} AS brik_nm, ta,
        'SI' || {text('k % 5')} AS affiliate_subterritory_id, 'ST' || {text('k % 5')} AS affiliate_subterritory_name,
        {_levels('subterritory_hiearachy', 'k % 3')}, {_levels('brick_hierarchy', 'k % 3')},
        hier_type, CASE WHEN k = 19 THEN 'N' ELSE 'Y' END AS is_actv
    FROM (SELECT DISTINCT c_custkey % 20 AS k FROM {{customer}}) b CROSS JOIN {AFFILIATES}
    CROSS JOIN {_listed('t', 'ta', 'ECONOMY MEDIUM STANDARD PROMO')}
    CROSS JOIN (SELECT 'GEOGRAPHY' AS hier_type, 'g' AS tag UNION ALL SELECT 'ANALYSIS GROUP', 'a') h""",
    "fx_geo_ref": f"""
    SELECT lower(n_name) || '-B1' AS country_name, r_name AS global_region_name,
        'SR-' || {text('n_regionkey')} AS global_subregion_name, {AFFILIATE} AS affiliate_code
    FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey""",
    "fx_nonpromo": """
    SELECT CASE WHEN p_name LIKE 'red %' THEN '' ELSE 'UNLISTED ' END || upper(p_name) AS source_product_name,
        'N' AS promotional_call_yn
    FROM {part}""",
    "fx_plz": f"""
    SELECT 'Z' || {text('m % 30')} AS plz, 'CITY' || {text('cast(floor(m / 30) AS bigint)')} AS ort,
        'City' || {text('cast(floor(m / 30) AS bigint) + 2')} || ' ' AS ortkurz,
        CASE WHEN m % 30 = 29 OR m = 5 THEN NULL WHEN m % 30 < 12 THEN 'L' || {text('m % 30')}
            ELSE 'L' || {text('m % 4')} END AS ims
    FROM (SELECT c_custkey % 120 AS m FROM {{customer}}) c""",
}

# The stand-in behind each input table of the data product.
PRODUCT_TABLES = {
    "call_detail": "fx_call_dtl_wide",
    "discussion_sample": "fx_samples",
    "cycle_plan": "fx_cycle_plan",
    "time_bucket": "fx_time_bckt",
    "call_history": "fx_call_hist_a",
    "call_history_jp": "fx_call_hist_b",
    "country": "fx_cntry",
    "customer": "fx_cust",
    "emp_territory": "fx_emp_terr",
    "geography": "fx_geo",
    "geography_reference": "fx_geo_ref",
    "non_promotional": "fx_nonpromo",
    "postal_mapping": "fx_plz",
}


def _names_in(sql: str) -> list[str]:
    return sorted(set(re.findall(r"{(\w+)}", sql)))


STORED: dict[tuple[str, str], str] = {}  # written stand-ins, by test folder and name

# Tables a stand-in makes many rows of each row of, and a key: as small files they would be read by one task.
SPREAD = {("fx_cycle_plan", "customer"): "c_custkey"}


def store(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write all stand-ins as Parquet, to be read from there from now on."""
    for name in FIXTURES:
        table(spark, sf_dir, name).write.parquet(f"{folder}/{name}")
        STORED[sf_dir, name] = f"{folder}/{name}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table or a stand-in as a Spark DataFrame."""
    if (sf_dir, name) in STORED:
        return spark.read.parquet(STORED[sf_dir, name])
    if name in FIXTURES:
        sql = FIXTURES[name]
        sources = {used: table(spark, sf_dir, used) for used in _names_in(sql)}
        for used, df in sources.items():
            if (name, used) in SPREAD:
                sources[used] = df.repartition(SPREAD[name, used])
        return spark.sql(sql, **sources)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MADE: dict[tuple, str] = {}  # stand-ins written by `made_once`, by what they were made from


def made_once(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same rows, written before they are read: for jobs that scan a stand-in several times.

    The joins that make it, and their shuffle files, are over when the job begins. A table made from the same
    files is read again.
    """
    if (sf_dir, name) in STORED:
        return table(spark, sf_dir, name)
    made = table(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, name, *_stamps(spark, made.inputFiles()))
    if key not in _MADE:
        _MADE[key] = written(made, name)
    return spark.read.schema(made.schema).parquet(_MADE[key])


def _stamps(spark: SparkSession, files: list[str]) -> list[tuple]:
    found = []
    for file in sorted(files):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        found.append((file, status.getLen(), status.getModificationTime()))
    return found


def with_clause(sql: str) -> str:
    """DuckDB statement: `sql` with the stand-ins it names defined in front."""
    used = [name for name in FIXTURES if re.search(rf"\b{name}\b", sql)]
    parts = [f"{name} AS ({FIXTURES[name].format(**{b: b for b in BASE_TABLES})})" for name in used]
    if not parts:
        return sql
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
