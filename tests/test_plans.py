"""What the plans must and must not contain."""

import pytest

import __spark_entry__ as entry
from tableloom import session

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
# Queries that write or stream first are left to the SQL comparison.
PLANNED = sorted(n for n in QUERIES if n[0] in "pjgnosfcqxl")


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cartesian_products_or_row_functions(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text
    assert "NestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "p6_filter")
    assert "GreaterThan(o_totalprice,300000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    assert "l_tax" not in plan(spark, "g1_group")


@pytest.mark.parametrize("name", ["n11_top_k", "q10_rule_results"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


def test_aggregates_are_combined_before_the_shuffle(spark):
    assert "partial_count" in plan(spark, "g22_map_side_combine")


def test_empty_input(spark):
    from tableloom.operators import ordered, quality

    none = spark.createDataFrame([], "k int, v double")
    assert ordered.numbered(none, ["k"], ["v"], "rn").count() == 0
    assert ordered.ntiles(none, 4, ["v"], "t").count() == 0
    assert quality.validate(none, [quality.completeness("k")]).first()["pass_rate"] == 0.0


def test_scratch_is_below_the_shared_folder(spark):
    root = session.shared_root(spark)
    a, b = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))
    assert session._own_root() == session._own_root()
