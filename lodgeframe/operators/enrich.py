"""Listing-grain enrichment: the feature (Gold-ML) table (F1-F6, W1, W2),
the dashboard frame (S11 + Q11 + F7 + F8) and the model frame (F9-F12)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lodgeframe.columns import (COLS, LAT_CENTER, LAT_JFK, LON_CENTER, LON_JFK,
                                MODEL_TEXT_FILL, PREMIUM_WORDS, PRICE_CAP, SHAPE_WORDS,
                                ListingColumns)
from lodgeframe.functions import scalars as S
from lodgeframe.operators.clean import cap_filter, fill_numeric
from lodgeframe.plans.joins import attach_lookup
from lodgeframe.sources.tables import project_known

#: Pieces that a group's rows are dealt into for window averages.
WINDOW_PIECES = 64


def group_average(df: DataFrame, by: Sequence[str], value: str, alias: str,
                  digits: int = 2) -> DataFrame:
    """Rounded mean of ``value`` per group: the lookup behind W1 and W2."""
    return df.groupBy(*by).agg(F.round(F.avg(value), digits).alias(alias))


def with_group_average(df: DataFrame, by: Sequence[str], value: str, alias: str,
                       digits: int = 2, form: str = "join") -> DataFrame:
    """Attach a per-group mean to every row.

    ``form="join"`` (default): a partial aggregate per group, then a join that
    leaves the rows in place, for groups that are few. ``form="window"``: see
    ``with_window_averages``, for any number of groups of any size.
    """
    if form == "window":
        return with_window_averages(df, value, {alias: by}, digits)
    return attach_lookup(df, group_average(df, by, value, alias, digits), list(by))


def with_window_averages(df: DataFrame, value: str, averages: Mapping[str, Sequence[str]],
                         digits: int = 2, pieces: int = WINDOW_PIECES) -> DataFrame:
    """Attach to every row the mean of ``value`` ``over (partition by ...)`` per
    entry of ``averages``, a name with its group.

    A window over the rows would hold a group's rows in one task. They are
    dealt into ``pieces`` by a hash of the row instead; the windows run over
    the sums and counts of a group's pieces, and each piece's rows get the
    means by an ordinary join on group and piece. So no task sees more than
    the rows of its pieces, and nothing is broadcast by hint.
    """
    keys = list(dict.fromkeys(c for by in averages.values() for c in by))
    spread = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    rows = df.withColumn("_piece", F.pmod(F.xxhash64(*spread), F.lit(pieces)).cast("int"))
    sums = rows.groupBy(*keys, "_piece").agg(F.sum(F.col(value).cast("double")).alias("_sum"),
                                             F.count(value).alias("_n"))

    def mean(by: Sequence[str]):
        own = Window.partitionBy(*by)
        return F.round(F.try_divide(F.sum("_sum").over(own), F.sum("_n").over(own)), digits)

    means = sums.select(*keys, "_piece", *[mean(by).alias(alias) for alias, by in averages.items()])
    return attach_lookup(rows, means, [*keys, "_piece"], few=False).drop("_piece")


def gold_features(silver: DataFrame, cols: ListingColumns = COLS,
                  form: str = "join") -> DataFrame:
    """The 22-column feature table: Silver + price_log, has_reviews,
    occupancy_rate, zone_avg_price, price_vs_zone_pct, zone_type_avg_price.

    Both averages come from one pass over Silver per grain; the percentage
    uses the already rounded zone average, like the reference.
    """
    base = silver.select(
        *[F.col(c) for c in silver.columns],
        S.price_log(cols.value).alias("price_log"),
        S.has_reviews(cols.reviews).alias("has_reviews"),
        S.occupancy_rate(cols.availability).alias(cols.occupancy),
    )
    if form == "window":
        zk = with_window_averages(base, cols.value, {"zone_avg_price": [cols.zone],
                                                     "zone_type_avg_price": [cols.zone, cols.kind]})
    else:
        # Both lookups aggregate Silver itself, not the output of a join.
        zk = attach_lookup(
            attach_lookup(base, group_average(base, [cols.zone], cols.value,
                                              "zone_avg_price"), [cols.zone]),
            group_average(base, [cols.zone, cols.kind], cols.value, "zone_type_avg_price"),
            [cols.zone, cols.kind])
    zk = zk.withColumn("price_vs_zone_pct", S.pct_vs(cols.value, "zone_avg_price"))
    return zk.select(*silver.columns, "price_log", "has_reviews", cols.occupancy,
                     "zone_avg_price", "price_vs_zone_pct", "zone_type_avg_price")


#: Feature columns computed from the value: never inputs of a model that predicts it.
VALUE_DERIVED = ("price_log", "zone_avg_price", "price_vs_zone_pct", "zone_type_avg_price")


def dashboard_columns(cols: ListingColumns = COLS) -> list[str]:
    return [cols.key, cols.zone, cols.subzone, cols.kind, cols.value, cols.nights,
            cols.reviews, cols.reviews_per_month, cols.host_listings, cols.availability,
            cols.occupancy, "zone_avg_price", "price_vs_zone_pct", "zone_type_avg_price",
            cols.lat, cols.lon]


def dashboard_frame(gold: DataFrame, cols: ListingColumns = COLS,
                    price_cap: int = PRICE_CAP) -> DataFrame:
    """Known columns that exist, 0 < price <= cap, plus the long-availability
    flag and occupancy in percent."""
    df = cap_filter(project_known(gold, dashboard_columns(cols)), cols.value, 0, price_cap)
    return df.select("*", S.long_availability(cols.availability).alias("long_availability"),
                     S.occupancy_pct(cols.occupancy).alias("occupancy_pct"))


def model_frame(gold: DataFrame, cols: ListingColumns = COLS,
                label: str = "price_log") -> DataFrame:
    """Text and location features for the second modelling iteration.

    Text nulls become ``unknown``; numeric nulls become 0 except the label.
    """
    df = gold.fillna({cols.name: MODEL_TEXT_FILL})
    df = fill_numeric(df, 0.0, exclude=[label])
    name = F.col(cols.name)
    shape = S.keyword_flags(name, SHAPE_WORDS, prefix="is_")
    return df.select(
        "*", *shape,
        S.extract_count(name, S.keyword_flag(name, "studio")).alias("bedrooms_extracted"),
        *S.keyword_flags(name, PREMIUM_WORDS),
        S.planar_distance(cols.lat, cols.lon, LAT_CENTER, LON_CENTER).alias("distance_center"),
        S.planar_distance(cols.lat, cols.lon, LAT_JFK, LON_JFK).alias("distance_jfk"),
        S.name_length(name).alias("name_length"),
    )
