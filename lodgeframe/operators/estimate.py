"""Estimation lookups: group and global medians (A12, A13), centroids
(A14), and their use on a table of requests (J1, J2), plus the comparable
range estimate with its fallbacks (J3).

Lookups are aggregates whose size is the number of groups; they are joined
with a size check (see ``plans.joins``). Global values (one row) are read
as scalar subqueries, never through a cross join.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.columns import COLS, ListingColumns
from lodgeframe.operators.order_stats import exact_quantiles, one_row
from lodgeframe.plans.joins import attach_lookup


def imputed_features(cols: ListingColumns = COLS) -> list[str]:
    """The features a request does not give, filled from medians."""
    return [cols.reviews, cols.reviews_per_month, cols.host_listings, cols.nights,
            cols.occupancy]


def group_medians(df: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Exact (interpolated) median of each feature per group."""
    return one_row(exact_quantiles(df, features, [0.5], by), features, by)


def global_medians(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact (interpolated) median of each feature, one row."""
    return one_row(exact_quantiles(df, features, [0.5]), features)


def centroids(df: DataFrame, by: str, lat: str, lon: str) -> DataFrame:
    """Mean coordinates per group."""
    return df.groupBy(by).agg(F.avg(lat).alias(lat), F.avg(lon).alias(lon))


def impute_from_group(requests: DataFrame, df: DataFrame, keys: Sequence[str],
                      features: Sequence[str]) -> DataFrame:
    """For each request, the group's median of every feature, or the
    global median when the group is unknown (or its median is null)."""
    return impute_from_lookup(requests, group_medians(df, keys, features), global_medians(df, features), keys, features)


def impute_from_lookup(requests: DataFrame, groups: DataFrame, overall: DataFrame, keys: Sequence[str],
                       features: Sequence[str]) -> DataFrame:
    """J1 with medians already made: per group (``groups``) and in all
    (``overall``, one row)."""
    lookup = groups.select(*keys, *[F.col(f).alias(f"_g_{f}") for f in features])
    glob = overall.select(F.struct(*features).alias("g")).scalar()
    joined = attach_lookup(requests, lookup, list(keys)).select("*", glob.alias("_glob"))
    return joined.select(*requests.columns,
                         *[F.coalesce(F.col(f"_g_{f}"), F.col(f"_glob.{f}")).alias(f)
                           for f in features])


def attach_centroid(requests: DataFrame, df: DataFrame, by: str, lat: str,
                    lon: str) -> DataFrame:
    """The group's centroid, else the mean of all centroids (of groups,
    not of rows)."""
    return attach_known_centroid(requests, centroids(df, by, lat, lon), by, lat, lon)


def attach_known_centroid(requests: DataFrame, cent: DataFrame, by: str, lat: str, lon: str) -> DataFrame:
    """J2 with centroids already made."""
    fallback = cent.agg(F.struct(F.avg(lat).alias(lat), F.avg(lon).alias(lon))).scalar()
    lookup = cent.select(by, F.col(lat).alias("_c_lat"), F.col(lon).alias("_c_lon"))
    joined = attach_lookup(requests, lookup, [by]).select("*", fallback.alias("_fb"))
    return joined.select(*requests.columns,
                         F.coalesce("_c_lat", F.col(f"_fb.{lat}")).alias(lat),
                         F.coalesce("_c_lon", F.col(f"_fb.{lon}")).alias(lon))


def estimate_range(requests: DataFrame, df: DataFrame, zone: str, kind: str,
                   value: str) -> DataFrame:
    """p25 / median / p75 / count of ``value`` over comparable rows:
    same (zone, kind); if there are none, same zone; if none, all rows.

    The three levels are grouping sets of one exact quantile pass. Each is
    joined to the requests; the first level present wins.
    """
    # A row counts for its group even without a value.
    rows = df.rollup(zone, kind).agg(F.count(F.lit(1)).alias("rows"), F.grouping_id().alias("level")).select(
        F.struct(zone, kind, F.col("level").cast("int").alias("level")).alias("group"), "rows")
    levels = {0: 0, 1: 1, 2: 3}  # number of the set -> grouping id
    stats = exact_quantiles(df, [value], [0.25, 0.5, 0.75], [zone, kind], sets=[[zone, kind], [zone], []])
    level = F.element_at(F.create_map(*[F.lit(v) for kv in levels.items() for v in kv]), F.col("set_number"))
    stats = (stats.select(F.struct(zone, kind, level.alias("level")).alias("own"), "q")
             .join(rows, F.col("own") == F.col("group"))
             .select("own.*", F.struct(F.col("q")[1].alias("estimate"), F.col("q")[0].alias("low"),
                                       F.col("q")[2].alias("high"), F.col("rows").alias("n")).alias("r")))
    pair = stats.filter(F.col("level") == 0).select(zone, kind, F.col("r").alias("_r_pair"))
    by_zone = stats.filter(F.col("level") == 1).select(zone, F.col("r").alias("_r_zone"))
    overall = stats.filter(F.col("level") == 3).select(F.col("r")).scalar()
    out = attach_lookup(attach_lookup(requests, pair, [zone, kind]), by_zone, [zone])
    # The one-row fallback is projected once, then its fields are read.
    picked = out.select(*requests.columns,
                        F.coalesce("_r_pair", "_r_zone", overall).alias("_r"),
                        F.when(F.col("_r_pair").isNotNull(), F.lit("zone_kind"))
                         .when(F.col("_r_zone").isNotNull(), F.lit("zone"))
                         .otherwise(F.lit("all")).alias("basis"))
    return picked.select(*requests.columns, F.col("_r.estimate").alias("estimate"),
                         F.col("_r.low").alias("low"), F.col("_r.high").alias("high"),
                         F.col("_r.n").alias("n_comparable"), "basis")
