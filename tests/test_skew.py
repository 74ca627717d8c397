import pytest
from pyspark.sql import functions as F

from panelcast.operators.skew import lookup_unique, unique_rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = [("hot", i % 2, i) for i in range(60)] + [(f"k{i}", 0, i) for i in range(30)]
    rows += [(None, 0, -1), ("k1", None, -2), ("none", 0, -3), ("hot", 0, 0)]
    left = spark.createDataFrame(rows, "k string, j int, v int")
    right = spark.createDataFrame(
        [("hot", 0, "a"), ("hot", 1, "b")] + [(f"k{i}", 0, f"r{i}") for i in range(40)],
        "k string, j int, name string",
    )
    return left, right


@pytest.mark.parametrize("hot_keys,min_hot_rows", [(5, 3), (1, 1000), (10_000, 0), (10_000, 100)])
def test_result_equals_a_plain_join(tables, hot_keys, min_hot_rows):
    left, right = tables
    got = lookup_unique(left, right, ["k", "j"], hot_keys, min_hot_rows)
    want = left.join(right, ["k", "j"], "left").select(*got.columns)
    assert got.columns == ["k", "j", "v", "name"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_rows_are_not_shuffled(tables):
    left, right = tables
    df = lookup_unique(left, right, ["k", "j"], 5, 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("LeftSemi") >= 2 and "LeftAnti" in plan


@pytest.mark.parametrize("hot_keys,min_hot_rows", [(5, 3), (1, 1000)])
def test_a_repeated_right_key_fails(spark, tables, hot_keys, min_hot_rows):
    left, right = tables
    for copy in (("k3", 0, "other"), ("hot", 1, "b")):
        repeated = right.union(spark.createDataFrame([copy], right.schema))
        df = lookup_unique(left, repeated, ["k", "j"], hot_keys, min_hot_rows)
        with pytest.raises(Exception, match=f"duplicate key: {copy[0]} {copy[1]}"):
            df.collect()
        with pytest.raises(Exception, match="duplicate key"):
            df.select("v").agg(F.sum("v")).collect()


def test_right_rows_without_a_key_match_nothing_and_are_no_copies(spark, tables):
    left, right = tables
    more = right.union(spark.createDataFrame([(None, 0, "x")] * 2 + [("k1", None, "y")] * 2, right.schema))
    got = lookup_unique(left, more, ["k", "j"], 5, 3)
    want = lookup_unique(left, right, ["k", "j"], 5, 3)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_the_check_uses_the_shuffle_and_sort_of_the_join(spark, tables):
    left, right = tables
    plans = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for side in (right.where("k IS NOT NULL AND j IS NOT NULL"), unique_rows(right, ["k", "j"])):
            df = left.join(side, ["k", "j"], "left")
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plain, checked = plans
    assert "SortMergeJoin" in plain and "SortMergeJoin" in checked and "Window" in checked
    for node in ("Exchange hashpartitioning", "Sort ["):
        assert plain.count(node) == checked.count(node)
