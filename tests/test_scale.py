"""What a task holds is bounded by its part of the rows, and wide rows are shuffled once."""

import random
import shutil
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks import catalog, fixtures
from fieldmart.limits import Limits
from fieldmart.operators import skew

SHUFFLED = Limits(broadcast_bytes=0)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_meets_after_the_shuffle_in_parts_of_bounded_rows(spark):
    df = spark.createDataFrame([(i % 100, None if i % 3 else i) for i in range(400)], "k int, v int")
    found = skew.distinct_by(df, limits=Limits(hot_rows=50, task_rows=10))
    assert found.rdd.getNumPartitions() == 40
    assert rows(found) == rows(df.distinct())
    # Both aggregates stand above the only exchange.
    for fresh in (skew.distinct_by(df), skew.distinct_by(df, 400, "k")):
        assert executed(fresh).count("Exchange") == 1


def test_weighed_counts_each_side(spark):
    one = spark.createDataFrame([("a",)] * 7 + [(None,)], "k string")
    two = spark.createDataFrame([("b",)] * 2, "k string")
    counts, hot = skew.weighed([one, two], Limits(hot_rows=6))
    assert counts == [8, 2] and [r["k"] for r in hot.collect()] == ["a"]
    assert skew.weighed([one.limit(0), two], Limits(hot_rows=6)) == ([0, 2], None)


def test_calendar_holds_no_customers(spark, sf_dir):
    plan = executed(catalog.Inputs(spark, sf_dir).new_calendar())
    assert not [line for line in plan.splitlines() if "HashAggregate(keys=" in line and "cust_id" in line]


@pytest.mark.parametrize("name", ["q_cycle_label", "q_cycle_scan"])
def test_plan_is_spread_before_it_is_made_distinct(spark, sf_dir, name):
    lines = executed(catalog.REGISTRY[name](spark, sf_dir)).splitlines()
    held = [i for i, line in enumerate(lines) if "HashAggregate(keys=" in line and "cust_id" in line]
    below = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "cust_id" in line]
    assert held and below and max(held) < min(below)
    made = executed(fixtures.table(spark, sf_dir, "fx_cycle_plan"))
    assert "Exchange hashpartitioning(c_custkey" in made


def _calls(spark):
    rng = random.Random(3)
    made = [
        (rng.choice(["a", "b", "c", None]), rng.choice(["p", "q", None]), rng.choice(["FR", "DE", None]), rng.randrange(3))
        for _ in range(90)
    ]
    df = spark.createDataFrame(made, "call_id string, src_prod_nm string, afl_id string, wtg int")
    return SimpleNamespace(spark=spark, call_rows=df, calls=df.distinct())


def _samples(spark):
    made = [("a", "p", 1), ("a", "p", 1), ("a", "q", 2), ("b", None, 3), (None, "p", 4), ("d", "p", 5)]
    return spark.createDataFrame(made, "call_id string, src_prod_nm string, n int")


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED, Limits(broadcast_bytes=0, hot_rows=4)])
def test_look_up_gives_the_same_by_every_way(spark, limits):
    t, samples = _calls(spark), _samples(spark)
    on = {"call_id": "call_id", "src_prod_nm": F.when(F.col("afl_id") == "FR", F.col("src_prod_nm"))}
    s = samples.toDF("s_call", "s_prod", "n")
    same = (F.col("call_id") == F.col("s_call")) & (F.col("src_prod_nm") == F.col("s_prod")) & (F.col("afl_id") == "FR")
    expected = rows(t.calls.join(s, same, "left").drop("s_call", "s_prod"))
    assert rows(catalog._look_up(t, samples, on, "call_id", limits=limits)) == expected


def test_look_up_shuffles_wide_calls_once(spark):
    t = _calls(spark)
    found = catalog._look_up(t, _samples(spark), {"call_id": "call_id", "src_prod_nm": "src_prod_nm"}, "call_id", limits=SHUFFLED)
    wide = [line for line in executed(found).splitlines() if "Exchange" in line]
    assert len(wide) == 2  # the calls, and the samples


def test_whole_product_reads_joined_stand_ins_as_written_once(spark, sf_dir, tmp_path):
    shutil.copytree(sf_dir, tmp_path / "in")
    inputs = catalog.Inputs(spark, str(tmp_path / "in"))
    for late in (False, True):
        made = catalog.product(inputs, flags_after_enrichment=late)
        assert not [file for file in made.inputFiles() if "lineitem" in file]
    one = catalog.product(inputs, affiliate="DE")
    assert [file for file in one.inputFiles() if "lineitem" in file]
    calls = inputs.made_once("fx_call_dtl_wide")
    assert rows(calls) == rows(inputs.read("fx_call_dtl_wide"))
    assert calls.inputFiles() == inputs.made_once("fx_call_dtl_wide").inputFiles()
    # Other files are another table.
    half = pq.read_table(f"{sf_dir}/lineitem.parquet").slice(0, 1000)
    (tmp_path / "in" / "lineitem.parquet").chmod(0o600)
    pq.write_table(half, tmp_path / "in" / "lineitem.parquet")
    assert inputs.made_once("fx_call_dtl_wide").count() == inputs.read("fx_call_dtl_wide").count() < calls.count()
