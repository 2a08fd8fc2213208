"""Query-surface filters: the listing filter (P1), the option lists of the
filter controls (P2) and the matching share (P3)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.columns import COLS, ListingColumns


def listing_predicate(zones: Sequence[str] = (), subzones: Sequence[str] = (),
                      kinds: Sequence[str] = (), price_max: float | None = None,
                      avail_min: float | None = None, occ_min_pct: float | None = None,
                      cols: ListingColumns = COLS) -> Column:
    """AND of three optional IN-lists and three bounds. An empty list means
    no restriction; the occupancy bound is given in percent."""
    cond = F.lit(True)
    if zones:
        cond = cond & F.col(cols.zone).isin(list(zones))
    if subzones:
        cond = cond & F.col(cols.subzone).isin(list(subzones))
    if kinds:
        cond = cond & F.col(cols.kind).isin(list(kinds))
    if price_max is not None:
        cond = cond & (F.col(cols.value) <= price_max)
    if avail_min is not None:
        cond = cond & (F.col(cols.availability) >= avail_min)
    if occ_min_pct is not None:
        cond = cond & (F.col(cols.occupancy) >= occ_min_pct / 100)
    return cond


def listing_filter(df: DataFrame, cols: ListingColumns = COLS, **bounds) -> DataFrame:
    """Rows satisfying ``listing_predicate``; the IN-lists and bounds
    reach the Parquet scan as pushed filters (and partition filters on a
    table partitioned by zone)."""
    return df.filter(listing_predicate(cols=cols, **bounds))


def filter_options(df: DataFrame, zones: Sequence[str] = (),
                   cols: ListingColumns = COLS) -> DataFrame:
    """Sorted distinct zones, kinds, and sub-zones of the chosen zones
    (all sub-zones when no zone is chosen), as (option, value) rows."""
    in_zones = F.col(cols.zone).isin(list(zones)) if zones else F.lit(True)
    tagged = df.select(
        F.explode(F.array(
            F.struct(F.lit("zone").alias("option"), F.col(cols.zone).alias("value")),
            F.struct(F.lit("kind").alias("option"), F.col(cols.kind).alias("value")),
            F.when(in_zones, F.struct(F.lit("subzone").alias("option"),
                                      F.col(cols.subzone).alias("value"))),
        )).alias("o")).select("o.option", "o.value").filter(F.col("option").isNotNull())
    return tagged.distinct().orderBy("option", "value")


def match_share(df: DataFrame, predicate: Column) -> DataFrame:
    """Matching rows, all rows and the share (4 dp) in one pass."""
    return df.agg(F.count_if(predicate).alias("n_matching"),
                  F.count(F.lit(1)).alias("n_total")).select(
        "n_matching", "n_total",
        F.round(F.try_divide(F.col("n_matching"), F.col("n_total")), 4).alias("share"))
