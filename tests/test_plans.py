"""Physical-plan shape: the properties the operators rely on at scale."""
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from lodgeframe.columns import COLS
from lodgeframe.operators import clean as Q
from lodgeframe.operators import explore as X
from lodgeframe.operators import filters as FL
from lodgeframe.operators import rank as R
from lodgeframe.operators import sampling as T
from lodgeframe.operators.enrich import dashboard_frame, gold_features
from lodgeframe.plans import listings as L
from lodgeframe.plans.bindings import listings_typed
from lodgeframe.plans.registry import GOLD_NUMERIC, QUERIES
from lodgeframe.sources import sinks as SK


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def written(spark, sf_small):
    d = tempfile.mkdtemp(prefix="lf-plans-")
    SK.write_partitioned(L.silver(spark, sf_small), f"{d}/silver", COLS.zone)
    silver = spark.read.parquet(f"{d}/silver")
    SK.write_features(gold_features(silver), f"{d}/gold", COLS.zone)
    return silver, spark.read.parquet(f"{d}/gold")


def test_dedup_aggregates_partially_before_the_shuffle(spark, sf_small):
    p = plan(Q.dedup(L.typed(spark, sf_small), [COLS.key]))
    assert "partial_min" in p and "Window" not in p
    assert p.index("Exchange hashpartitioning(id") < p.index("partial_min")  # printed top-down


def test_binding_runs_each_join_once(spark, sf_small):
    p = plan(listings_typed(spark, sf_small))
    assert "Union" not in p and "Window" not in p
    assert p.count("FileScan parquet") == 6   # orders (rows, host counts), lineitem, customer, nation, region


def test_gold_uses_broadcast_lookups_not_windows(spark, written):
    silver, _ = written
    p = plan(gold_features(silver))
    assert "Window" not in p and p.count("BroadcastHashJoin") == 2
    # The lookups read only the value and group columns.
    assert "ReadSchema: struct<price:int>" in p
    assert "Window" in plan(gold_features(silver, form="window"))


def test_filters_reach_the_scan(spark, written):
    _, gold = written
    q = FL.listing_filter(gold, zones=["AMERICA"], price_max=300)
    p = plan(q)
    assert re.search(r"PartitionFilters: \[.*neighbourhood_group", p)
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(price,300\)", p)


def test_top_k_without_global_sort(spark, written):
    _, gold = written
    assert "TakeOrderedAndProject" in plan(R.rank_subzones(dashboard_frame(gold), 10))
    assert "TakeOrderedAndProject" in plan(T.sample_n(gold, 100, COLS.key))


def test_one_subquery_for_normalisation(spark, written):
    _, gold = written
    p = plan(R.compromise_score(dashboard_frame(gold)))
    assert len(set(re.findall(r"Subquery subquery#(\d+)", p))) == 1
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_correlations_unpivot_in_the_map_stage(spark, written):
    _, gold = written
    p = plan(X.correlation_matrix(gold, GOLD_NUMERIC))
    assert "Generate stack" in p and "partial_" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_leakage_screen_computes_pairs_with_the_label_only(spark, written):
    _, gold = written
    p = plan(X.leakage_screen(gold, "price_log", GOLD_NUMERIC))
    assert f"stack({len(GOLD_NUMERIC) - 1}," in p


def test_indexed_columns_are_made_once(spark, sf_small):
    for name in ("m1_string_index", "m2_one_hot"):
        assert "InMemoryTableScan" in plan(QUERIES[name](spark, sf_small))
