import re

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from panelcast.operators.split import WEIGHT, with_class_weight
from panelcast.operators.splits import best_split, candidate_cuts, equal_width_bins
from workload.model_queries import BINS, status_features, stump_table
from workload.panels import SPEC

SF_DIR = "/root/testdata/sf0.01"


def root_of(forest):
    """(slot, cut) of the root of a forest's only tree."""
    found = re.search(r"If \(feature (\d+) <= ([-\d.E]+)\)", forest.toDebugString)
    return int(found[1]), float(found[2])


@pytest.mark.parametrize("task", ["value", "flag"])
def test_best_split_is_the_root_of_a_tree(spark, task):
    """A forest of one tree of depth 1 over all rows and features."""
    binned, numeric = stump_table(status_features(spark, SF_DIR))
    settings = {
        "featuresCol": "x", "numTrees": 1, "maxDepth": 1, "bootstrap": False, "subsamplingRate": 1.0,
        "featureSubsetStrategy": "all", "maxBins": BINS + 1, "seed": 1,
    }
    if task == "value":
        label, weight = SPEC.value_target.alias, None
        estimator = RandomForestRegressor(labelCol=label, **settings)
    else:
        label, weight = SPEC.flag_target.alias, WEIGHT
        binned = with_class_weight(binned, label)
        estimator = RandomForestClassifier(labelCol=label, weightCol=WEIGHT, **settings)
    rows = VectorAssembler(inputCols=numeric, outputCol="x").transform(binned)
    slot, cut = root_of(estimator.fit(rows))
    best = best_split(binned, numeric, label, weight).first()
    assert best.feature == numeric[slot]
    # The forest looks at a sample of rows for its cuts, so its value may lie elsewhere in the gap.
    assert best.below <= cut < best.above


def plain_gains(x, y, w):
    total = lambda m: (w[m] * y[m] ** 2).sum() - (w[m] * y[m]).sum() ** 2 / w[m].sum()
    out = {}
    values = np.unique(x)
    for a, b in zip(values, values[1:]):
        left = x <= a
        out[(a + b) / 2] = 1 - (total(left) + total(~left)) / total(x == x)
    return out


def test_gains_against_plain_arithmetic(spark):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 5, 80).astype(float), rng.normal(size=80).round(1)
    y, w = (a > 2) + rng.normal(size=80), rng.integers(1, 4, 80).astype(float)
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), y.tolist(), w.tolist())), "a double, b double, y double, w double").repartition(3)
    found = {(r.feature, r.cut): r for r in candidate_cuts(df, ["a", "b"], "y", "w").collect()}
    want = {(n, c): g for n, x in (("a", a), ("b", b)) for c, g in plain_gains(x, y, w).items()}
    assert set(found) == set(want)
    for k, g in want.items():
        assert found[k].gain == pytest.approx(g, abs=1e-9)
        assert found[k].left_rows + found[k].right_rows == 80
    best = best_split(df, ["a", "b"], "y", "w").first()
    assert (best.feature, best.cut) == max(want, key=want.get)
    few = candidate_cuts(df, ["a", "b"], "y", "w", least_rows=20).collect()
    assert few and all(min(r.left_rows, r.right_rows) >= 20 for r in few)


def test_odd_tables(spark):
    rows = [(None, 1.0), (float("nan"), 2.0), (1.0, 3.0), (2.0, None), (1.0, 4.0)]
    df = spark.createDataFrame(rows, "a double, y double")
    assert best_split(df, ["a"], "y").count() == 0
    assert best_split(df.where("false"), ["a"], "y").count() == 0
    constant = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "a double, y double")
    assert best_split(constant, ["a"], "y").count() == 0
    tied = spark.createDataFrame([(0.0, 0.0, 1.0), (1.0, 1.0, 2.0)], "a double, b double, y double")
    assert best_split(tied, ["b", "a"], "y").first().feature == "b"


def test_bins(spark):
    df = spark.createDataFrame([(0.0, 5, None), (10.0, 5, 1.0), (4.9, 5, float("nan")), (None, 5, None)], "a double, b int, c double")
    out = equal_width_bins(df, ["a", "b", "c"], 2).collect()
    assert [r.a for r in out] == [0.0, 1.0, 0.0, None]
    assert [r.b for r in out] == [0.0] * 4 and [r.c for r in out] == [None, 0.0, None, None]
    beyond = equal_width_bins(spark.createDataFrame([(-3.0,), (99.0,)], "a double"), ["a"], 4, reference=df.select("a"))
    assert [r.a for r in beyond.collect()] == [0.0, 3.0]
    assert equal_width_bins(df.where("false"), ["a"], 2).count() == 0
    assert [f.name for f in equal_width_bins(df.withColumn("d", F.lit(1)), ["a"], 2).schema] == ["a", "b", "c", "d"]
