"""The physical plans the operators are written for."""

from dataclasses import replace
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks import catalog, fixtures
from fieldmart.functions import normalise as n
from fieldmart.operators import calendar as cal
from fieldmart.limits import Limits
from fieldmart.operators import lookups as look
from fieldmart.operators import skew
from fieldmart.params import JobParams
from fieldmart.plans.product import build_product
from fieldmart.plans.runs import build_products
from fieldmart.operators.attribution import attribute
from fieldmart.operators.skew import split_hot
from fieldmart.plans import sink
from fieldmart.plans.sink import clean_product, read_product, write_product
from fieldmart.schema import OUTPUT
from fieldmart.session import pin
from fieldmart.sources.tables import from_catalog, from_parquet, mapped, mapped_table


@pytest.fixture(scope="module")
def paths(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    made = {}
    for name, fixture in fixtures.PRODUCT_TABLES.items():
        made[name] = str(folder / name)
        fixtures.table(spark, sf_dir, fixture).write.parquet(made[name])
    return made


@pytest.fixture
def no_automatic_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def nodes(df):
    """(name, output column names, text) of every node of the physical plan."""
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.inputPlan()
        columns = [node.output().apply(i).name() for i in range(node.output().size())]
        yield node.nodeName(), columns, node.toString()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]


def named(df, name):
    return [(columns, text) for node, columns, text in nodes(df) if node == name]


@pytest.mark.parametrize("late", [False, True])
def test_product_shuffles_and_scans_whole_calls_once(spark, paths, no_automatic_broadcast, late):
    df = build_product(from_parquet(spark, paths), JobParams(flags_after_enrichment=late))
    wide = [text.split("\n")[0] for columns, text in named(df, "Exchange") if "rest" in columns]
    assert len(wide) == 1 and "hashpartitioning(call_id" in wide[0]
    scans = [columns for node, columns, _ in nodes(df) if node.startswith("Scan parquet")]
    assert sum("afl_nm" in columns for columns in scans) == 1
    narrow = [columns for columns in scans if "call_dt" in columns and "afl_nm" not in columns]
    assert narrow and all(set(columns) <= {"call_id", "ta", "afl_id", "call_dt", "cust_id"} for columns in narrow)


def test_product_broadcasts_measured_lookups_and_sorts_no_result(spark, paths, no_automatic_broadcast):
    df = build_product(from_parquet(spark, paths), JobParams())
    names = [name for name, _, _ in nodes(df)]
    wide_hash_joins = [c for c, _ in named(df, "BroadcastHashJoin") if "rest" in c]
    assert len(wide_hash_joins) == 6  # calendar, four lookups, the resolved postal codes
    assert len([c for c, _ in named(df, "SortMergeJoin") if "rest" in c]) == 4  # three by call id, and what customers brought
    assert len([c for c, _ in named(df, "Window")]) == 3
    assert "CartesianProduct" not in names and "BroadcastNestedLoopJoin" not in names
    assert not any("rangepartitioning" in text.split("\n")[0] for _, text in named(df, "Exchange"))


def test_calls_bucketed_by_id_are_not_shuffled(spark, paths, no_automatic_broadcast, tmp_path):
    calls = spark.read.parquet(paths["call_detail"])
    writer = calls.write.bucketBy(4, "call_id").sortBy("call_id").option("path", str(tmp_path / "calls"))
    writer.mode("overwrite").saveAsTable("bucketed_calls")
    try:
        tables = replace(from_parquet(spark, paths), call_detail=mapped_table("call_detail", spark.table("bucketed_calls")))
        df = build_product(tables, JobParams(bucketed_by_call=True))
        wide = [text.split("\n")[0] for columns, text in named(df, "Exchange") if "rest" in columns]
        assert not wide
    finally:
        spark.sql("DROP TABLE bucketed_calls")


def test_final_projection_shuffles_only_wide_rows_met_twice(spark, sf_dir, no_automatic_broadcast):
    found = catalog.q_final_projection(catalog.Inputs(spark, sf_dir))
    lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
    shuffled = [line.split("hashpartitioning(")[1] for line in lines if "Exchange hashpartitioning(" in line]
    assert len(shuffled) == 5
    # The tasks and hashes of rows, and rows whose hash was met before: compared whole, by all their columns.
    assert [keys.count("#") > 10 for keys in sorted(shuffled, key=len)] == [False] * 4 + [True]


def test_lookups_of_other_affiliates_are_left_out(spark, paths):
    tables = from_parquet(spark, paths)
    df = build_product(tables, JobParams(affiliate="JP"))
    assert not [c for node, c, _ in nodes(df) if node.startswith("Scan") and ("sample_name" in c or "plz" in c)]
    found = df.select("sample_name", "ims_landscape_germany_only", "affiliate_code").distinct()
    assert rows(found) == [(None, None, "JP")]


def test_affiliate_filter_reaches_the_files(spark, paths):
    calls = spark.read.parquet(paths["call_detail"]).where(n.equals_ignoring_case(F.col("afl_id"), "DE"))
    plan = calls.select("call_id")._jdf.queryExecution().executedPlan().toString()
    assert "In(afl_id, [" in plan
    scan = [c for node, c, _ in nodes(calls.select("call_id")) if node.startswith("Scan parquet")]
    assert set(scan[0]) == {"afl_id", "call_id"}


def test_long_codes_prune_row_groups(spark, tmp_path):
    path = str(tmp_path / "calls")
    codes = ["AUSTRIA", "Germany", "germany", "GERMANS", "ITALIAN", "straßen", None]
    rows_of = spark.createDataFrame([(c, i) for c in codes for i in range(20)], "afl_id string, i int")
    rows_of.repartitionByRange(len(codes), "afl_id").write.parquet(path)

    def read(code):
        df = spark.read.parquet(path).where(n.equals_ignoring_case(F.col("afl_id"), code))
        found = {r[0] for r in df.collect()}
        (scan,) = [node for node in _plan_nodes(df) if node.nodeName().startswith("Scan parquet")]
        return found, scan.metrics().apply("numOutputRows").value()

    assert n.spellings("GERMANY") is None
    found, scanned = read("GERMANY")
    assert found == {"Germany", "germany"} and scanned < 100
    found, scanned = read("STRASSEN")
    assert found == {"straßen"} and scanned <= 40


def _plan_nodes(df):
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        yield node
        todo += [node.children().apply(i) for i in range(node.children().size())]


def test_runs_scan_the_calls_once_and_equal_single_runs(spark, paths, tmp_path):
    tables = from_parquet(spark, paths)
    day = datetime(2024, 1, 1)
    runs = {
        "de": JobParams(affiliate="DE", therapy_areas=catalog.THERAPY_AREAS, refreshed_at=day),
        "fr": JobParams(affiliate="FR", refreshed_at=day, overlap_bounds="ordered"),
        "again": JobParams(affiliate="DE", refreshed_at=day, bucketed_by_call=True),
        "none": JobParams(affiliate="XX", refreshed_at=day),
    }
    products = build_products(tables, runs, str(tmp_path / "runs"))
    assert list(products) == list(runs)
    for name, params in runs.items():
        single = build_product(tables, replace(params, bucketed_by_call=False))
        assert products[name].columns == single.columns
        assert rows(products[name]) == rows(single)
        scans = [text for node, columns, text in nodes(products[name]) if node.startswith("Scan parquet") and "call_dt" in columns]
        assert scans and all(paths["call_detail"] not in text for text in scans)
    assert products["none"].count() == 0 and products["fr"].count() > 0
    assert build_products(tables, {}, str(tmp_path / "no runs")) == {}


def test_snapshot_needs_no_join(spark, paths):
    df = look.latest_snapshot(spark.read.parquet(paths["country"]), "pt_batch_id")
    assert not [name for name, _, _ in nodes(df) if "Join" in name]


def test_missing_cycles_are_an_anti_join(spark, paths):
    tables = from_parquet(spark, paths)
    keys = tables.call_detail.select("afl_id", "ta").distinct()
    plan = cal.without_cycle(keys, tables.cycle_plan)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan


def test_customers_are_aggregated_before_the_shuffle(spark, paths):
    df = look.active_customers(from_parquet(spark, paths).customer)
    names = [name for name, _, _ in nodes(df)]
    assert names.count("SortAggregate") == 2 and "Window" not in names


def test_mapped_columns_prune_the_scan(spark, sf_dir):
    df = mapped(spark.read.parquet(f"{sf_dir}/customer.parquet"), ["cust_id"], {"cust_id": "c_custkey"})
    assert df.columns == ["cust_id"]
    assert [c for node, c, _ in nodes(df) if node.startswith("Scan parquet")] == [["c_custkey"]]


def test_written_product_reads_back_and_replaces_only_its_affiliates(spark, paths, tmp_path):
    tables = from_parquet(spark, paths)
    path = str(tmp_path / "product")
    first = JobParams(refreshed_at=datetime(2024, 1, 1))
    write_product(build_product(tables, first), path, first)
    counts = rows(read_product(spark, path).groupBy("affiliate_code").count())
    second = JobParams(affiliate="DE", refreshed_at=datetime(2024, 2, 2))
    write_product(build_product(tables, second), path, second)
    written = read_product(spark, path)
    assert written.columns == [name for name, _ in OUTPUT]
    assert spark.read.parquet(f"{path}/data").columns[: len(OUTPUT)] == written.columns
    assert rows(written.groupBy("affiliate_code").count()) == counts
    refreshed = written.select("affiliate_code", F.month("last_data_refresh_timestamp")).distinct()
    assert rows(refreshed) == [("DE", 2), ("FR", 1), ("IT", 1), ("JP", 1), ("UKI", 1)]


def test_a_run_replaces_its_scope_and_no_more(spark, tmp_path):
    path = str(tmp_path / "product")
    names = [name for name, _ in OUTPUT]

    def product(*keys):
        base = spark.createDataFrame(keys, "affiliate_code string, therapy_area_TA string, product_name string")
        return base.select(*[F.col(c) if c in base.columns else F.lit(None).cast("string").alias(c) for c in names])

    def stored():
        found = read_product(spark, path).select("affiliate_code", "therapy_area_TA", "product_name")
        return sorted(map(tuple, found.collect()), key=repr)

    write_product(product(("DE", "A", "1"), ("DE", "B/x", "1"), ("DE", None, "1"), ("FR", "A", "1")), path, JobParams())
    write_product(product(("DE", "A", "2")), path, JobParams("DE", ("A",)))
    assert stored() == [("DE", "A", "2"), ("DE", "B/x", "1"), ("DE", None, "1"), ("FR", "A", "1")]
    write_product(product(("DE", "A", "3")), path, JobParams("DE", ("A", "B/X", "UNASSIGNED_TA")))
    assert stored() == [("DE", "A", "3"), ("FR", "A", "1")]
    write_product(product(("FR", "C", "4")), path, JobParams("FR"))
    assert stored() == [("DE", "A", "3"), ("FR", "C", "4")]
    write_product(product(("FR", "D", "5")), path)
    assert stored() == [("DE", "A", "3"), ("FR", "C", "4"), ("FR", "D", "5")]


def _product_of(spark, *keys):
    names = [name for name, _ in OUTPUT]
    base = spark.createDataFrame(keys, "affiliate_code string, therapy_area_TA string, product_name string")
    return base.select(*[F.col(c) if c in base.columns else F.lit(None).cast("string").alias(c) for c in names])


def _stored(spark, path):
    found = read_product(spark, path).select("affiliate_code", "therapy_area_TA", "product_name")
    return sorted(map(tuple, found.collect()), key=repr)


def test_a_run_killed_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "product")
    with pytest.raises(FileNotFoundError):
        read_product(spark, path)
    write_product(_product_of(spark, ("DE", "A", "1"), ("FR", "A", "1")), path, JobParams())
    with monkeypatch.context() as killed:
        killed.setattr(sink, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write_product(_product_of(spark, ("DE", "A", "2")), path, JobParams())
    assert _stored(spark, path) == [("DE", "A", "1"), ("FR", "A", "1")]
    assert len(clean_product(spark, path)) == 1
    write_product(_product_of(spark, ("DE", "A", "3"), ("DE", "%2F a=b/c", "3"), ("DE", "007", "3")), path, JobParams("DE"))
    expected = [("DE", "%2F a=b/c", "3"), ("DE", "007", "3"), ("DE", "A", "3"), ("FR", "A", "1")]
    assert _stored(spark, path) == expected
    assert clean_product(spark, path) == []
    write_product(_product_of(spark), path, JobParams("DE"))
    assert _stored(spark, path) == [("FR", "A", "1")]
    assert len(clean_product(spark, path)) == 2  # the replaced run, and the folder of the one without rows
    write_product(_product_of(spark), path, JobParams())
    assert _stored(spark, path) == [] and len(clean_product(spark, path)) == 2


def test_replaced_files_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "product")
    write_product(_product_of(spark, ("DE", "A", "1"), ("FR", "A", "1")), path, JobParams())
    write_product(_product_of(spark, ("DE", "A", "2")), path, JobParams("DE"))
    read = read_product(spark, path).select("product_name").withColumn("file", F.input_file_name()).collect()
    assert len({r["file"] for r in read}) == 2
    (scan,) = [text for node, _, text in nodes(read_product(spark, path)) if node.startswith("Scan parquet")]
    assert "PartitionFilters: []" not in scan


def test_sums_of_flags_need_no_window(spark, sf_dir):
    plan = [name for name, _, _ in nodes(catalog.REGISTRY["q_metric_rollup"](spark, sf_dir))]
    assert "Window" not in plan and "Sort" not in [n for n in plan if n == "SortAggregate"]


def test_flags_meet_the_calendar_once(spark, sf_dir):
    df = catalog.REGISTRY["q_first_flags"](spark, sf_dir)
    joins = [text for name, _, text in nodes(df) if name in ("BroadcastHashJoin", "BroadcastNestedLoopJoin") and "strt" in text + "__low"]
    assert sum("__low" in text.split("\n")[0] for text in joins) == 1


def test_only_measured_sides_and_single_rows_are_broadcast(spark, no_automatic_broadcast, monkeypatch):
    monkeypatch.setattr(skew, "GRID_ROWS", 0)
    nothing = Limits(broadcast_bytes=0)
    calls = spark.createDataFrame([(str(i % 9), "A", "DE", datetime(2024, 1, i % 28 + 1)) for i in range(60)],
                                  "call_id string, ta string, afl_id string, call_dt timestamp_ntz")
    hot = pin(spark.createDataFrame([("1",), ("2",), (None,)], "call_id string"))
    cold, chosen = split_hot(calls, "call_id", hot, nothing)
    assert cold.count() == 60 - chosen.count() and chosen.select("call_id").distinct().count() == 2
    for part in (cold, chosen):
        assert not [name for name, _, _ in nodes(part) if name == "BroadcastExchange"]
    cycles = spark.createDataFrame([("DE", "A", "CC", datetime(2023, 1, 1), datetime(2025, 1, 1))],
                                   "afl_id string, ta string, spl_cyc string, strt_dt timestamp_ntz, end_dt timestamp_ntz")
    found = attribute(calls, cycles, limits=nothing)
    assert found.where("spl_cyc = 'CC'").count() == 60
    one_row = [columns for name, columns, _ in nodes(found) if name == "BroadcastExchange"]
    assert all(columns == ["__first", "__last"] for columns in one_row)


def test_tables_from_the_catalog(spark, paths):
    for name, path in paths.items():
        view = f"eu_{name}" if name in ("call_detail", "cycle_plan") else name
        spark.read.parquet(path).createOrReplaceTempView(view)
    names = {name: name for name in paths}
    names.update(call_detail="{region}_call_detail", cycle_plan="{region}_cycle_plan")
    tables = from_catalog(spark, names, region="eu")
    assert tables.call_detail.count() == spark.read.parquet(paths["call_detail"]).count()
