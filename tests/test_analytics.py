"""Aggregations, rankings, lookups, sampling and their properties."""
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.columns import COLS
from lodgeframe.operators import estimate as E
from lodgeframe.operators import explore as X
from lodgeframe.operators import filters as FL
from lodgeframe.operators import kpis as K
from lodgeframe.operators import rank as R
from lodgeframe.operators import sampling as T
from lodgeframe.operators.enrich import gold_features
from lodgeframe.plans import listings as L


def test_window_and_join_forms_agree(spark, sf_small):
    silver = L.silver(spark, sf_small)
    a = gold_features(silver, form="join")
    b = gold_features(silver, form="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hash_split_disjoint_complete_and_layout_free(spark, sf_small):
    g = L.gold(spark, sf_small)
    tagged = T.split(g, 0.8, COLS.key, 42).select(COLS.key, "split")
    again = T.split(g.repartition(7), 0.8, COLS.key, 42).select(COLS.key, "split")
    assert tagged.count() == g.count()
    assert tagged.groupBy(COLS.key).count().filter("count > 1").count() == 0
    assert tagged.exceptAll(again).count() == 0
    s1 = T.sample_fraction(g, 0.1, COLS.key, 42).select(COLS.key)
    s2 = T.sample_fraction(g.repartition(5), 0.1, COLS.key, 42).select(COLS.key)
    assert s1.exceptAll(s2).count() == 0


def test_sample_n_is_bounded(spark, sf_small):
    d = L.dash(spark, sf_small)
    assert T.sample_n(d, 100, COLS.key).count() == 100
    assert T.sample_n(d, 10 ** 7, COLS.key).count() == d.count()


def test_minmax_constant_gives_zero(spark):
    rows = [(f"s{i}", "z", 100, 50, 3, 0.5) for i in range(4) for _ in range(30)]
    df = spark.createDataFrame(rows, f"{COLS.subzone} string, {COLS.zone} string, "
                                     f"{COLS.value} int, {COLS.availability} int, "
                                     f"{COLS.reviews} int, {COLS.occupancy} double")
    scores = [r.score for r in R.compromise_score(df).collect()]
    assert scores == [0.5] * 4                       # 0.5 * (1 - 0) + 0 + 0


def test_compromise_score_empty_when_groups_small(spark, sf_small):
    d = L.dash(spark, sf_small)
    assert R.compromise_score(d, min_rows=10 ** 6).count() == 0
    row = K.global_kpis(d.limit(0)).first()
    assert row.n_listings == 0 and row.cheapest_subzone == "—" and row.mean_price == 0.0


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, float(i), None if i == 3 else 2.0 * i) for i in range(6)],
                               "c double, x double, y double")
    m = {(r.column_a, r.column_b): r.corr for r in X.correlation_matrix(df, ["c", "x", "y"]).collect()}
    assert m[("c", "x")] is None
    assert m[("x", "y")] == 1.0                       # pairwise: the null row is ignored


def test_correlations_with_every_pattern_of_nulls(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(1e6, 1, (400, 4)) @ rng.normal(0, 1, (4, 4))
    x[rng.random(x.shape) < 0.3] = np.nan
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows + [[None] * 4], "a double, `b.c` double, d double, e double")
    names = ["a", "b.c", "d", "e"]
    m = {(r.column_a, r.column_b): r.corr for r in X.correlation_matrix(df, names).collect()}
    assert len(m) == 6
    for (i, a), (j, b) in itertools.combinations(enumerate(names), 2):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert abs(m[a, b] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 2e-6
    assert X.correlation_matrix(df.limit(0), names).collect() == []


def test_box_stats_whiskers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "v double")
    r = X.box_stats(df, ["v"]).first()
    assert (r.q1, r.median, r.q3) == (3.0, 5.0, 7.0)
    assert r.whisker_high == 8.0 and r.outliers_high == 1 and r.outliers_low == 0


def test_histogram_has_every_bin(spark, sf_small):
    d = L.dash(spark, sf_small)
    h = X.histogram(d, COLS.value, bins=40, lo=0.0, hi=500.0).collect()
    assert [r.bin for r in h] == list(range(40))
    assert sum(r.n for r in h) == d.filter((F.col(COLS.value) >= 0) & (F.col(COLS.value) <= 500)).count()


def test_estimate_range_fallbacks(spark, sf_small):
    d = L.dash(spark, sf_small)
    req = spark.createDataFrame(
        [(1, "AMERICA", "Private room"), (2, "AMERICA", "Hotel room"), (3, "ATLANTIS", "x")],
        f"id long, {COLS.zone} string, {COLS.kind} string")
    got = {r.id: r.basis for r in E.estimate_range(req, d, COLS.zone, COLS.kind, COLS.value).collect()}
    assert got == {1: "zone_kind", 2: "zone", 3: "all"}


def test_impute_and_centroid_fallbacks(spark, sf_small):
    d = L.dash(spark, sf_small)
    req = spark.createDataFrame([(1, "nowhere", "Private room")],
                                f"id long, {COLS.subzone} string, {COLS.kind} string")
    feats = E.imputed_features(COLS)
    imp = E.impute_from_group(req, d, [COLS.subzone, COLS.kind], feats).first()
    glob = E.global_medians(d, feats).first()
    assert all(imp[f] == glob[f] for f in feats)
    cent = E.attach_centroid(req, d, COLS.subzone, COLS.lat, COLS.lon).first()
    mean_of_centroids = E.centroids(d, COLS.subzone, COLS.lat, COLS.lon).agg(
        F.avg(COLS.lat)).first()[0]
    assert abs(cent[COLS.lat] - mean_of_centroids) < 1e-9


def test_filter_empty_list_means_no_restriction(spark, sf_small):
    d = L.dash(spark, sf_small)
    assert FL.listing_filter(d).count() == d.count()
    share = FL.match_share(d, FL.listing_predicate(zones=["AMERICA"])).first()
    assert share.n_total == d.count() and 0 < share.share < 1


def test_percentile_approx_matches_exact_on_integer_prices(spark, sf_small):
    s = L.silver(spark, sf_small)
    a = {(r[0], r[1]): r.median_price for r in K.zone_kind_kpis(s, median_kind="approx").collect()}
    b = {(r[0], r[1]): r.median_price for r in K.zone_kind_kpis(s, median_kind="disc").collect()}
    assert a == b


def test_seeds_and_operations_are_independent(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    keys = lambda d: {r.k for r in d.collect()}
    one, two = keys(T.sample_fraction(df, 0.1, "k", 1)), keys(T.sample_fraction(df, 0.1, "k", 2))
    assert 1700 < len(one) < 2300 and len(one & two) < 400
    test = keys(T.split(df, 0.8, "k", 1).filter("split = 'test'"))
    assert 0.12 < len(one & test) / len(one) < 0.28
    assert keys(T.sample_n(df, 50, "k", 3)) == keys(T.sample_n(df.repartition(9), 50, "k", 3))
    assert keys(T.sample_n(df, 50, "k", 3)) != keys(T.sample_n(df, 50, "k", 4))


def test_pivot_refuses_an_unlisted_value(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "hotel", 2.0)], "r string, c string, v double")
    with pytest.raises(Exception, match="not listed"):
        X.pivot_median(df, "r", "c", "v", ["x"]).collect()


def test_approx_median_rank_error_is_bounded(spark):
    """percentile_approx (accuracy 10000) is within n/10000 + 1 ranks of
    the exact median in every zone x kind group."""
    s = L.silver(spark, "/root/testdata/sf0.01")
    approx = K.zone_kind_kpis(s, median_kind="approx").select(COLS.zone, COLS.kind, "median_price")
    j = s.join(approx, [COLS.zone, COLS.kind])
    ranks = j.groupBy(COLS.zone, COLS.kind).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(COLS.value) < F.col("median_price")).alias("below"),
        F.count_if(F.col(COLS.value) <= F.col("median_price")).alias("at_or_below")).collect()
    for r in ranks:
        target, slack = 0.5 * r.n, r.n / 10000 + 1
        assert r.below <= target + slack and r.at_or_below >= target - slack


def test_pivot_discovers_values(spark, sf_small):
    d = L.dash(spark, sf_small)
    given = X.pivot_median(d, COLS.zone, COLS.kind, COLS.value,
                           ["Entire home/apt", "Private room", "Shared room"])
    found = X.pivot_median(d, COLS.zone, COLS.kind, COLS.value)
    assert sorted(found.columns) == sorted(given.columns)
    assert sorted(found.collect()) == sorted(given.select(*found.columns).collect())
