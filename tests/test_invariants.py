"""Properties that hold on any input, checked on the stand-in tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks import catalog
from fieldmart.functions import normalise as n
from fieldmart.operators import calendar as cal
from fieldmart.operators import waterfall as wf
from fieldmart.operators.attribution import attribute
from fieldmart.operators.flags import first_flags
from fieldmart.schema import FLAG_GRAINS


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return catalog.Inputs(spark, sf_dir)


def test_flags_count_groups(inputs):
    flagged = catalog._flagged(inputs)
    for flag, finer in FLAG_GRAINS.items():
        assert flagged.agg(F.sum(flag)).first()[0] == inputs.calls.select("call_id", *finer).distinct().count()


def test_late_flags_count_groups_where_early_ones_may_exceed_them(inputs):
    calls = inputs.calls.select("call_id").distinct().count()
    flag = "overall_number_of_actual_calls"
    early = catalog.product(inputs).agg(F.sum(flag)).first()[0]
    late = catalog.product(inputs, flags_after_enrichment=True).agg(F.sum(flag)).first()[0]
    assert late == calls < early


def test_attribution_keeps_every_call_and_every_match(inputs):
    calendar, calls = inputs.calendar, inputs.calls
    matched = attribute(calls, calendar, how="inner")
    per_call = matched.groupBy(*calls.columns).count()
    total = per_call.agg(F.sum("count"), F.count("*")).first()
    assert attribute(calls, calendar).count() == calls.count() - total[1] + total[0]


def test_made_cycles_are_no_planned_cycles(inputs):
    lacking = cal.without_cycle(inputs.call_keys, inputs.plan)
    planned = inputs.plan.where("spl_cyc = 'CC'").select("afl_id", "ta").distinct()
    assert lacking.join(planned, ["afl_id", "ta"], "left_semi").count() == 0


def test_waterfall_loses_no_row(inputs):
    calls = inputs.call_rows.withColumn("id", F.monotonically_increasing_id())
    found = wf.waterfall(calls, inputs.read("fx_plz"))
    assert found.select("id").distinct().count() == calls.count()
    # Class, value and step exclude each other as the steps say.
    assert found.where("ims_cnt IS NULL AND ims IS NOT NULL").count() == 0
    assert found.where((F.col("ims_cnt") > 1) & F.col("ims").isNull()).count() > 0


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_flags_do_not_depend_on_partitions_or_order(inputs, parts):
    attributed = attribute(inputs.calls, inputs.calendar).withColumn("n", F.lit(2))
    order = ["src_prod_nm", "brd_nm", "ta", "spl_cyc", *[c for c in inputs.calls.columns]]
    plain = first_flags(attributed, "call_id", F.col("cycle_end"), order)
    mixed = first_flags(attributed.repartition(parts, F.xxhash64("wtg", "call_id")), "call_id", F.col("cycle_end"), order)
    assert rows(mixed) == rows(plain)


def test_default_interaction_never_is_null_text(inputs):
    kinds = inputs.call_rows.select(n.interaction_type(F.col("intractn_typ")).alias("k")).distinct()
    assert not {r["k"] for r in kinds.collect()} & {None, "null", "NULL"}
