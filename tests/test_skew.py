"""The ways around hot keys and large lookup sides give the rows of the plain ways."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks import catalog, fixtures
from checks.compare import difference
from fieldmart.limits import Limits
from fieldmart.operators.attribution import attribute, overlap_count
from fieldmart.operators.flags import deciding_date, first_flags, row_numbers
from fieldmart.operators import skew
from fieldmart.operators.sizing import fits, which_fit
from fieldmart.operators.skew import heavy_keys, spread_left_join
from fieldmart.params import JobParams
from fieldmart.plans.product import build_product
from fieldmart.sources.tables import map_all

TINY = Limits(broadcast_bytes=0, hot_rows=5)
KEYS = ["a", "b", None, "c", "d", "e"]


def skewed(rng, count, keys=KEYS):
    """Rows of which about a third hold the first key, some of them equal copies."""
    return [(keys[0] if rng.random() < 0.34 else rng.choice(keys), rng.randrange(6)) for _ in range(count)]


@pytest.mark.parametrize("seed", range(4))
def test_spread_join_equals_plain_join(spark, seed):
    rng = random.Random(seed)
    left = spark.createDataFrame(skewed(rng, 120), "k string, v int")
    right = spark.createDataFrame(skewed(rng, 60, ["a", "c", None, "x", "e", "y"]), "k string, w int")
    expected = rows(left.join(right, "k", "left").select("k", "v", "w"))
    assert rows(spread_left_join(left, right, ["k"], limits=TINY).select("k", "v", "w")) == expected
    assert rows(spread_left_join(left, right, ["k"], limits=Limits()).select("k", "v", "w")) == expected


def test_spread_join_with_residual_keeps_rows_without_match(spark):
    rng = random.Random(7)
    left = spark.createDataFrame(skewed(rng, 120), "k string, v int")
    right = spark.createDataFrame(skewed(rng, 60), "k string, w int")
    r = right.withColumnRenamed("k", "rk")
    expected = rows(left.join(r, (F.col("k") == F.col("rk")) & (F.col("v") + 3 < F.col("w")), "left").select("k", "v", "w"))
    found = spread_left_join(left, right, ["k"], residual=F.col("v") + 3 < F.col("w"), limits=TINY)
    assert rows(found.select("k", "v", "w")) == expected


def test_no_cell_holds_a_whole_hot_group(spark):
    left = spark.createDataFrame([("a", i) for i in range(400)] + [("b", 0)], "k string, v int")
    right = spark.createDataFrame([("a", i) for i in range(40)], "k string, w int")
    joined = spread_left_join(left, right, ["k"], limits=Limits(hot_rows=10))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__line" in plan and "__column" in plan
    assert joined.count() == 400 * 40 + 1


def test_heavy_keys_are_all_found_and_see_null(spark):
    one = spark.createDataFrame([(None,)] * 20 + [("a",)] * 10 + [("b",)], "k string")
    two = spark.createDataFrame([("b",)] * 30, "k string")
    found = {tuple(r) for r in heavy_keys([one, two], Limits(hot_rows=9)).collect()}
    assert found == {(None, 20, 0), ("a", 10, 0), ("b", 1, 30)}
    many = spark.range(100_000).select((F.col("id") % 50).cast("string").alias("k"))
    assert heavy_keys([many], Limits(hot_rows=100)).count() == 50
    assert heavy_keys([many], Limits(hot_rows=2000)) is None


def test_keys_are_hot_by_their_joined_rows(spark):
    left = spark.range(60).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    right = spark.range(60).select(F.lit("a").alias("k"), F.col("id").alias("w"))
    assert [tuple(r) for r in heavy_keys([left.select("k"), right.select("k")], Limits(hot_rows=100)).collect()] == [("a", 60, 60)]
    joined = spread_left_join(left, right, ["k"], limits=Limits(hot_rows=100))
    assert joined.count() == 3600
    per_task = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 3600


@pytest.mark.parametrize("most", [0, 10_000])
def test_many_hot_keys_are_joined_without_a_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(skew, "GRID_ROWS", most)
    left = spark.range(600).select((F.col("id") % 40).cast("string").alias("k"), F.col("id").alias("v"))
    right = spark.range(400).select((F.col("id") % 50).cast("string").alias("k"), (F.col("id") % 3).alias("w"))
    found = spread_left_join(left, right, ["k"], limits=TINY)
    assert rows(found.select("k", "v", "w")) == rows(left.join(right, "k", "left").select("k", "v", "w"))


def test_measured_sizes(spark):
    small = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert fits(small, Limits(broadcast_bytes=2000)) and not fits(small, Limits(broadcast_bytes=900))
    packed = small.select(F.struct("s").alias("p"))
    assert fits(packed, Limits(broadcast_bytes=2000)) and not fits(packed, Limits(broadcast_bytes=900))
    assert which_fit({"none": small.where("false"), "some": small}, Limits(broadcast_bytes=10)) == {"none": True, "some": False}


def _calls(spark, seed, count=150):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    made = []
    for _ in range(count):
        call = "a" if rng.random() < 0.34 else rng.choice(["b", "c", None, "d", "e", "f"])
        end = rng.choice([None, start, start + timedelta(days=30, hours=5, microseconds=7), start + timedelta(days=31)])
        made.append((call, rng.choice(["x", "y", None]), rng.choice(["A", "B", None]), end, rng.choice([0.5, 2.0]), len(str(call))))
    return spark.createDataFrame(made, "call_id string, brd_nm string, ta string, cycle_end timestamp_ntz, wtg double, n long")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("add", [first_flags, row_numbers])
def test_hot_flags_and_numbers_equal_plain_ones(spark, seed, add):
    df = _calls(spark, seed)
    grains = {"f_call": [], "f_brand": ["brd_nm"], "f_ta": ["ta"]}
    order = ["brd_nm", "ta", "wtg", "cycle_end", "n"]
    prefer = deciding_date()
    plain = add(df, "call_id", prefer, order, grains)
    for hot in (["a", None], [None], ["a", "b", "c"]):
        keys = spark.createDataFrame([(k,) for k in hot], "call_id string")
        found = add(df, "call_id", prefer, order, grains, keys, TINY)
        if add is first_flags:
            assert rows(found) == rows(plain)
        else:  # equal rows may share out their numbers between grains
            for rank in grains:
                assert rows(found.select(*df.columns, rank)) == rows(plain.select(*df.columns, rank))


@pytest.mark.parametrize("bounds", [("strt_dt", "end_dt"), ("end_dt", "strt_dt")])
def test_monthly_join_equals_broadcast_join(spark, bounds):
    rng = random.Random(3)
    start = datetime(2023, 11, 15)

    def when():
        return rng.choice([None, start + timedelta(days=rng.randrange(200), hours=rng.choice([0, 10]))])

    calls = spark.createDataFrame(
        [(str(i % 40), rng.choice(["A", "B", None]), rng.choice(["DE", "FR"]), when()) for i in range(200)],
        "call_id string, ta string, afl_id string, call_dt timestamp_ntz",
    )
    calendar = spark.createDataFrame(
        [(rng.choice(["DE", "FR"]), rng.choice(["A", "B", None]), f"C{i}", when(), when()) for i in range(30)],
        "afl_id string, ta string, spl_cyc string, strt_dt timestamp_ntz, end_dt timestamp_ntz",
    )
    for how in ("left", "inner"):
        expected = rows(attribute(calls, calendar, bounds=bounds, how=how, small=True))
        assert rows(attribute(calls, calendar, bounds=bounds, how=how, limits=TINY)) == expected
    name = "ordered" if bounds[0] == "strt_dt" else "as_written"
    assert rows(overlap_count(calls, calendar, name, limits=TINY)) == rows(overlap_count(calls, calendar, name, small=True))


@pytest.mark.parametrize(
    "limits",
    [Limits(broadcast_bytes=1 << 26, hot_rows=7), Limits(broadcast_bytes=0), Limits(broadcast_bytes=0, hot_rows=60)],
    ids=["hot keys", "nothing small", "nothing small, hot lookup keys"],
)
def test_product_is_the_same_by_every_way(spark, sf_dir, duck, limits):
    statement = driver.oracle_sql()["q_data_product_one_affiliate"]
    inputs = catalog.Inputs(spark, sf_dir)
    found = catalog.product(inputs, affiliate="DE", therapy_areas=catalog.THERAPY_AREAS, limits=limits)
    assert difference(found.drop("last_data_refresh_timestamp"), duck, statement) is None


def test_product_with_hot_calls_of_all_affiliates(spark, sf_dir, duck):
    found = catalog.product(catalog.Inputs(spark, sf_dir), limits=Limits(hot_rows=7))
    assert difference(found.drop("last_data_refresh_timestamp"), duck, driver.oracle_sql()["q_data_product"]) is None


def test_product_with_a_third_of_the_rows_in_one_call_and_some_without_id(spark, sf_dir):
    t = catalog.Inputs(spark, sf_dir)
    tables = map_all({name: t.read(fixture) for name, fixture in fixtures.PRODUCT_TABLES.items()})
    number = F.pmod(F.xxhash64("call_id", "src_prod_nm", "wtg"), F.lit(6))
    calls = tables.call_detail.withColumns(
        {
            "call_id": F.when(number < 2, "O3").when(number == 2, F.lit(None)).otherwise(F.col("call_id")),
            "cust_id": F.when(number < 2, "H10").when(number == 3, F.lit(None)).otherwise(F.col("cust_id")),
        }
    )
    history = tables.call_history.withColumn("id", F.when(F.col("clm_vod__c") == "n/a", "O3").otherwise(F.col("id")))
    tables = replace(tables, call_detail=calls, call_history=history)
    when = datetime(2024, 1, 1)
    expected = build_product(tables, JobParams(affiliate="DE", refreshed_at=when))
    assert expected.count() > 10_000
    found = build_product(tables, JobParams(affiliate="DE", refreshed_at=when, limits=Limits(hot_rows=100)))
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


@pytest.mark.parametrize("name, add, grains", [
    ("q_first_flags", first_flags, catalog.FLAG_GRAINS), ("q_row_numbers", row_numbers, catalog.RANKS)
])
def test_registered_flags_with_hot_calls(spark, sf_dir, duck, name, add, grains):
    flagged = catalog._flagged(catalog.Inputs(spark, sf_dir), add=add, grains=grains, limits=Limits(hot_rows=2))
    columns = catalog.REGISTRY[name](spark, sf_dir).columns
    assert difference(flagged.select(columns), duck, driver.oracle_sql()[name]) is None


def test_distinct_in_place_equals_distinct(spark):
    rng = random.Random(3)
    values = [None, "a", "b", ""]  # the hash passes over NULLs: such rows meet, and differ
    made = [(rng.choice(values), rng.choice(values), rng.choice([None, 0.0, -0.0, 1.5, float("nan")])) for _ in range(300)]
    made += [("hot", "row", 2.0)] * 500 + [(f"once {i}", None, float(i)) for i in range(50)]
    df = spark.createDataFrame(made, "`a.b` string, c string, d double").repartition(7)
    found = skew.distinct_in_place(df)
    assert found.schema == df.schema
    assert repr(rows(found)) == repr(rows(df.distinct()))  # NaN, and 0.0 for -0.0
    assert skew.distinct_in_place(df.where("false")).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fieldmart")]
