"""Ranking: extreme sub-zones (A3), top sub-zones (A6, T5), the compromise
score (A7) and its report projection (F18).

Sub-zone statistics are one grouped aggregation. Ties are always broken by
the group keys, so the order never depends on partitioning. Min-max
normalisation uses scalar subqueries over the (small) grouped result: no
join, and no window over a single partition.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.columns import COLS, MIN_GROUP_ROWS, SCORE_WEIGHTS, ListingColumns


def subzone_stats(df: DataFrame, cols: ListingColumns = COLS,
                  min_rows: int = MIN_GROUP_ROWS) -> DataFrame:
    """Per (sub-zone, zone): median price, mean availability, mean reviews,
    mean occupancy and count, keeping groups of at least ``min_rows``."""
    return (df.groupBy(cols.subzone, cols.zone).agg(
        F.median(cols.value).alias("median_price"),
        F.avg(cols.availability).alias("mean_availability"),
        F.avg(cols.reviews).alias("mean_reviews"),
        F.avg(cols.occupancy).alias("mean_occupancy"),
        F.count(F.lit(1)).alias("n"),
    ).filter(F.col("n") >= min_rows))


def extreme_groups(df: DataFrame, cols: ListingColumns = COLS,
                   min_rows: int = MIN_GROUP_ROWS) -> DataFrame:
    """A3: the sub-zones with the lowest and highest median price (groups of
    at least ``min_rows``), ties broken by name. One row; nulls if none."""
    g = (df.groupBy(cols.subzone)
         .agg(F.median(cols.value).alias("m"), F.count(F.lit(1)).alias("n"))
         .filter(F.col("n") >= min_rows))
    lo = F.min(F.struct("m", cols.subzone))
    # Highest median; among equal medians the first name (as a sort would).
    hi = F.min(F.struct((-F.col("m")).alias("negm"), F.col(cols.subzone).alias("s")))
    return g.agg(lo.alias("lo"), hi.alias("hi")).select(
        F.col(f"lo.{cols.subzone}").alias("cheapest_subzone"),
        F.col("lo.m").alias("cheapest_median"),
        F.col("hi.s").alias("dearest_subzone"),
        (-F.col("hi.negm")).alias("dearest_median"),
    )


def rank_subzones(df: DataFrame, n: int = 10, cheapest: bool = True,
                  cols: ListingColumns = COLS, min_rows: int = MIN_GROUP_ROWS) -> DataFrame:
    """The ``n`` cheapest (or dearest) sub-zones by median price.
    ``orderBy().limit()`` plans a top-k (TakeOrderedAndProject): each task
    keeps ``n`` rows, no full sort."""
    s = subzone_stats(df, cols, min_rows)
    order = F.col("median_price").asc() if cheapest else F.col("median_price").desc()
    return (s.orderBy(order, F.col(cols.subzone), F.col(cols.zone)).limit(n)
            .select(cols.subzone, cols.zone, "median_price",
                    F.round("mean_availability", 4).alias("mean_availability"),
                    F.round("mean_occupancy", 4).alias("mean_occupancy"), "n"))


def _normalised(stats: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<c>_norm`` in [0, 1] over all groups for each column; a
    constant column gives 0. The bounds are one scalar subquery (one small
    job over the grouped result), projected once and read by field."""
    bounds = stats.agg(F.struct(*[F.min(c).alias(f"lo_{c}") for c in columns],
                                *[F.max(c).alias(f"hi_{c}") for c in columns])).scalar()
    with_b = stats.select("*", bounds.alias("_b"))
    return with_b.select(*stats.columns, *[
        F.coalesce(F.try_divide(F.col(c) - F.col(f"_b.lo_{c}"),
                                F.col(f"_b.hi_{c}") - F.col(f"_b.lo_{c}")),
                   F.lit(0.0)).alias(f"{c}_norm") for c in columns])


def compromise_score(df: DataFrame, cols: ListingColumns = COLS,
                     min_rows: int = MIN_GROUP_ROWS,
                     weights: tuple[float, float, float] = SCORE_WEIGHTS) -> DataFrame:
    """``w0 (1 - price_n) + w1 availability_n + w2 reviews_n`` per
    sub-zone, 3 dp, best first. Empty when no group is large enough."""
    s = _normalised(subzone_stats(df, cols, min_rows),
                    ["median_price", "mean_availability", "mean_reviews"])
    w_price, w_avail, w_rev = weights
    score = (F.lit(w_price) * (F.lit(1.0) - F.col("median_price_norm"))
             + F.lit(w_avail) * F.col("mean_availability_norm")
             + F.lit(w_rev) * F.col("mean_reviews_norm"))
    return (s.select(cols.subzone, cols.zone, "median_price",
                     F.round("mean_availability", 4).alias("mean_availability"),
                     F.round("mean_reviews", 4).alias("mean_reviews"),
                     F.round("mean_occupancy", 4).alias("mean_occupancy"), "n",
                     F.round(score, 3).alias("score"))
            .orderBy(F.col("score").desc(), F.col(cols.subzone), F.col(cols.zone)))


def recommendation_table(df: DataFrame, k: int = 8, cols: ListingColumns = COLS) -> DataFrame:
    """The ``k`` best compromise sub-zones, renamed and rounded for
    the final report (occupancy in percent)."""
    top = compromise_score(df, cols).limit(k)
    return top.select(
        F.col(cols.subzone).alias("subzone"),
        F.col(cols.zone).alias("zone"),
        F.round("median_price", 0).alias("median_price"),
        F.round("mean_availability", 0).alias("availability_days"),
        F.round("mean_reviews", 0).alias("mean_reviews"),
        F.round(F.col("mean_occupancy") * 100, 0).alias("occupancy_pct"),
        F.col("n").alias("listings"),
        "score",
    )
