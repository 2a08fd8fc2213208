"""Bind the driver's star-schema tables to a listing-shaped raw table.

Each order becomes one listing: the customer is the host, the customer's
nation and region are the sub-zone and zone, the order status picks the
room kind, and the order's line items stand in for reviews. Defects are
injected by key (missing names, bad prices, out-of-range nights, missing
coordinates, duplicated rows) so every cleaning rule has work to do at
every scale. The rule set is fixed; see FIXTURES.md section 4.

Scale notes: line items are pre-aggregated per order before the join (map
side partial aggregation), host listing counts come from an aggregate
joined on the customer key rather than a window (a window over one hot
customer would put all its orders in one task), and only the two
fixed-size dimension tables (25 nations, 5 regions) are broadcast.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.columns import COLS, ListingColumns
from lodgeframe.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the binding (FIXTURES.md section 4).
# ---------------------------------------------------------------------------
NAMES_BY_KEY_MOD_8 = [
    "Cozy studio",
    "Spacious 2BR with view",
    "Private 1 bedroom",
    "Huge loft",
    "Renovated 3 bdrm",
    "Luxury 4br",
    "Room near 5 brooklyn stops",
    "Plain room",
]
KIND_BY_STATUS = {"F": "Entire home/apt", "O": "Private room"}
KIND_OTHER = "Shared room"
DUPLICATE_EVERY = 500


def _name(k: Column) -> Column:
    by_mod = F.element_at(F.array(*[F.lit(n) for n in NAMES_BY_KEY_MOD_8]),
                          (k % 8 + 1).cast("int"))
    return (F.when(k % 3000 == 5, F.lit(None).cast("string"))
            .when(k % 3500 == 21, F.lit("   "))
            .otherwise(by_mod))


def listings_typed(spark: SparkSession, sf_dir: str,
                   cols: ListingColumns = COLS) -> DataFrame:
    """The listing binding with its natural types (before the CSV edge)."""
    orders = read_table(spark, f"{sf_dir}/orders.parquet",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    customer = read_table(spark, f"{sf_dir}/customer.parquet",
                          ["c_custkey", "c_name", "c_nationkey"])
    nation = read_table(spark, f"{sf_dir}/nation.parquet",
                        ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, f"{sf_dir}/region.parquet", ["r_regionkey", "r_name"])
    lineitem = read_table(spark, f"{sf_dir}/lineitem.parquet",
                          ["l_orderkey", "l_shipdate"])

    reviews = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("_n"), F.max("l_shipdate").alias("_d"))
    host_counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_hosted"))
    # nation x region: 25 rows by construction of the schema.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")

    base = (
        orders.join(reviews, orders.o_orderkey == reviews.l_orderkey, "left")
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(host_counts, "o_custkey")
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    k = F.col("o_orderkey")
    kind = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in KIND_BY_STATUS.items() for x in kv]),
                     F.col("o_orderstatus")),
        F.lit(KIND_OTHER))
    price = (F.when(k % 6000 == 19, F.lit(None).cast("int"))
             .when(k % 1000 == 7, F.lit(0))
             .when(k % 4000 == 13, F.lit(-10))
             .otherwise(F.floor(F.col("o_totalprice") / 1000).cast("int")))
    nights = (F.when(k % 1500 == 11, F.lit(400))
              .when(k % 7000 == 23, F.lit(0))
              .otherwise((k % 30 + 1).cast("int")))
    lat = F.when(k % 5000 == 17, F.lit(None).cast("double")).otherwise(
        (F.lit(405000) + (k * 7919) % 4000).cast("double") / 10000)
    lon = (F.lit(-742000) + (k * 104729) % 5000).cast("double") / 10000
    listing = base.select(
        k.alias(cols.key),
        _name(k).alias(cols.name),
        F.col("o_custkey").alias(cols.host),
        F.when(k % 2500 == 9, F.lit(None).cast("string"))
         .otherwise(F.col("c_name")).alias(cols.host_name),
        F.col("r_name").alias(cols.zone),
        F.col("n_name").alias(cols.subzone),
        lat.alias(cols.lat),
        lon.alias(cols.lon),
        kind.alias(cols.kind),
        price.alias(cols.value),
        nights.alias(cols.nights),
        F.coalesce(F.col("_n"), F.lit(0)).cast("int").alias(cols.reviews),
        F.date_format(F.col("_d").cast("date"), "yyyy-MM-dd").alias(cols.last_review),
        F.round(F.col("_n").cast("double") / 12, 2).alias(cols.reviews_per_month),
        F.col("_hosted").cast("int").alias(cols.host_listings),
        ((k * 13) % 366).cast("int").alias(cols.availability),
    )
    # Injected exact duplicates: a second copy of every 500th listing, made
    # in the same pass (a union would run the joins twice).
    copies = F.when(F.col(cols.key) % DUPLICATE_EVERY == 0, 2).otherwise(1)
    return (listing.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
            .drop("_copy"))


def listings_raw(spark: SparkSession, sf_dir: str,
                 cols: ListingColumns = COLS) -> DataFrame:
    """The Bronze form: every column a string, as a header CSV reads."""
    typed = listings_typed(spark, sf_dir, cols)
    return typed.select([F.col(c).cast("string").alias(c) for c in typed.columns])
