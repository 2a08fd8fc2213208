"""KPI aggregations: per (zone, kind) (A1), global cards (A2), per zone
(A4, A19, A20) and per kind (A5). Each is one grouped aggregation; partial
aggregation happens on the map side, so a hot group costs no more than its
share of the scan."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.columns import COLS, LONG_AVAILABILITY_DAYS, MIN_GROUP_ROWS, ListingColumns
from lodgeframe.functions.aggregates import median
from lodgeframe.operators.rank import extreme_groups


def zone_kind_kpis(silver: DataFrame, cols: ListingColumns = COLS,
                   median_kind: str = "approx") -> DataFrame:
    """A1: per (zone, kind) count, mean price (2 dp), median, min, max, mean
    availability (1 dp), mean reviews (1 dp), mean reviews/month (2 dp),
    sorted by the keys. The reference median is ``percentile_approx``."""
    return (silver.groupBy(cols.zone, cols.kind).agg(
        F.count(F.lit(1)).alias("nb_listings"),
        F.round(F.avg(cols.value), 2).alias("avg_price"),
        median(cols.value, median_kind).cast("int").alias("median_price"),
        F.min(cols.value).alias("min_price"),
        F.max(cols.value).alias("max_price"),
        F.round(F.avg(cols.availability), 1).alias("avg_availability"),
        F.round(F.avg(cols.reviews), 1).alias("avg_reviews"),
        F.round(F.avg(cols.reviews_per_month), 2).alias("avg_reviews_per_month"),
    ).orderBy(cols.zone, cols.kind))


def global_kpis(df: DataFrame, cols: ListingColumns = COLS,
                min_rows: int = MIN_GROUP_ROWS,
                long_days: int = LONG_AVAILABILITY_DAYS) -> DataFrame:
    """A2: one row of headline figures, with A3's cheapest and dearest
    sub-zones. Every column is present even for an empty input (zeros and
    a dash). The A3 part is a scalar subquery, so no join is planned."""
    ext = extreme_groups(df, cols, min_rows)
    base = df.agg(
        F.count(F.lit(1)).alias("n_listings"),
        F.avg(cols.value).alias("_mean"),
        F.median(cols.value).alias("_median"),
        F.avg(cols.availability).alias("_avail"),
        (F.avg(cols.occupancy) * 100).alias("_occ"),
        F.avg(cols.reviews).alias("_reviews"),
        F.count_if(F.col(cols.availability) > long_days).alias("n_long_availability"),
    )
    z = F.lit(0.0)
    ext_struct = F.col("_ext")
    base = base.select("*", ext.select(F.struct(*ext.columns)).scalar().alias("_ext"))
    return base.select(
        "n_listings",
        F.round(F.coalesce("_mean", z), 2).alias("mean_price"),
        F.round(F.coalesce("_median", z), 2).alias("median_price"),
        F.round(F.coalesce("_avail", z), 2).alias("mean_availability"),
        F.round(F.coalesce("_occ", z), 2).alias("mean_occupancy_pct"),
        F.round(F.coalesce("_reviews", z), 2).alias("mean_reviews"),
        "n_long_availability",
        F.coalesce(ext_struct["cheapest_subzone"], F.lit("—")).alias("cheapest_subzone"),
        F.coalesce(ext_struct["cheapest_median"], z).alias("cheapest_median"),
        F.coalesce(ext_struct["dearest_subzone"], F.lit("—")).alias("dearest_subzone"),
        F.coalesce(ext_struct["dearest_median"], z).alias("dearest_median"),
    )


def price_by_zone(df: DataFrame, cols: ListingColumns = COLS) -> DataFrame:
    """A4: median, mean and count of price per zone, by median then zone."""
    return (df.groupBy(cols.zone).agg(
        F.median(cols.value).alias("median_price"),
        F.round(F.avg(cols.value), 4).alias("mean_price"),
        F.count(F.lit(1)).alias("n"),
    ).orderBy("median_price", cols.zone))


def price_by_kind(df: DataFrame, cols: ListingColumns = COLS) -> DataFrame:
    """A5: median, mean, count of price and mean availability per kind."""
    return (df.groupBy(cols.kind).agg(
        F.median(cols.value).alias("median_price"),
        F.round(F.avg(cols.value), 4).alias("mean_price"),
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(cols.availability), 4).alias("mean_availability"),
    ).orderBy("median_price", cols.kind))


def count_by_zone(df: DataFrame, cols: ListingColumns = COLS) -> DataFrame:
    """Rows per zone."""
    return df.groupBy(cols.zone).agg(F.count(F.lit(1)).alias("n")).orderBy(cols.zone)


def occupancy_by_zone(df: DataFrame, cols: ListingColumns = COLS) -> DataFrame:
    """Mean occupancy per zone (4 dp)."""
    return (df.groupBy(cols.zone)
            .agg(F.round(F.avg(cols.occupancy), 4).alias("mean_occupancy"))
            .orderBy(cols.zone))
