"""Exact quantiles by rank: against numpy on values of every shape."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import estimate as E
from lodgeframe.operators import explore as X
from lodgeframe.operators.order_stats import exact_quantiles

QS = [0.0, 0.02, 0.25, 0.5, 0.75, 0.99, 1.0]
RNG = np.random.default_rng(0)
SHAPES = {
    "all distinct": RNG.normal(size=3000),
    "few distinct": RNG.integers(0, 5, 1000).astype(float),
    "one value": np.full(7, 3.5),
    "one row": np.array([-2.0]),
    "far apart": np.array([1e-300, 1e300, -1e300, 0.0, 5e-324, 1.0, -1.0] * 3),
    "all scales": 10.0 ** RNG.uniform(-250, 250, 2000),
    "close together": 1.7e9 + RNG.uniform(0, 1e-3, 2000),
    "one far value": np.append(RNG.uniform(0, 1, 1500), 1e18),
    "a hot value": np.append(np.full(5000, 0.1), RNG.normal(size=900)),
    "infinite": np.array([np.inf, -np.inf, 1.0, 2.0, np.inf, 0.0]),
}


def _plain(values, q):
    v = np.sort(values)
    at = (len(v) - 1) * q
    lo, hi = int(np.floor(at)), int(np.ceil(at))
    return v[lo] if v[lo] == v[hi] else (hi - at) * v[lo] + (at - lo) * v[hi]


@pytest.mark.parametrize("buckets,levels", [(4096, 2), (8, 1), (4, 3)])
def test_quantiles_of_groups_equal_a_sort(spark, buckets, levels):
    rows = [(g, float(x)) for g, v in SHAPES.items() for x in v] + [("nulls", None), (None, None), (None, 4.0)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, ["x"], QS, ["g"], levels=levels, buckets=buckets).collect()}
    assert set(got) == {*SHAPES, "nulls", None}
    for name, values in SHAPES.items():
        want = [_plain(values, q) for q in QS]
        assert got[name].n == len(values)
        for a, b in zip(got[name].q, want):
            assert a == b or (np.isnan(a) and np.isnan(b)), (name, got[name].q, want)
    assert got["nulls"].n == 0 and got["nulls"].q == [None] * len(QS)
    assert got[None].q == [4.0] * len(QS)


def test_nan_is_the_greatest_value(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    row = exact_quantiles(df, ["x"], [0.0, 1 / 3, 2 / 3, 1.0]).first()
    assert row.n == 4 and row.q[:3] == [1.0, 2.0, float("inf")] and np.isnan(row.q[3])


def test_columns_share_the_passes_and_an_empty_table_gives_nulls(spark):
    df = spark.range(1001).select(F.col("id").alias("a"), (F.col("id") * 0.25 - 7).alias("b"))
    assert {r.column_name: r.q for r in exact_quantiles(df, ["a", "b"], [0.5, 0.001]).collect()} == {
        "a": [500.0, 1.0], "b": [118.0, -6.75]}
    assert E.global_medians(df, ["a", "b"]).first() == (500.0, 118.0)
    none = df.limit(0)
    assert exact_quantiles(none, ["a"], [0.5]).collect() == []
    assert E.global_medians(none, ["a", "b"]).first() == (None, None)
    assert X.value_bounds(none, "a").first() == (None, None, None)


def test_grouping_sets(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("a", None, 4.0), ("b", "x", 8.0)], "z string, k string, v double")
    got = {(r.set_number, r.z, r.k): (r.n, r.q[0]) for r in
           exact_quantiles(df, ["v"], [0.5], ["z", "k"], sets=[["z", "k"], ["z"], []]).collect()}
    assert got == {(0, "a", "x"): (1, 1.0), (0, "a", "y"): (1, 2.0), (0, "a", None): (1, 4.0), (0, "b", "x"): (1, 8.0),
                   (1, "a", None): (3, 2.0), (1, "b", None): (1, 8.0), (2, None, None): (4, 3.0)}


def test_no_value_map_of_a_column_in_the_plan(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    for out in (X.box_stats(df, ["v"]), E.global_medians(df, ["v"]), X.value_bounds(df, "v"),
                E.group_medians(df.withColumn("g", F.lit(1)), ["g"], ["v"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile" not in plan.lower() and "median(" not in plan
