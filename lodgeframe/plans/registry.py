"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame``
per operator of the inventory, and its SQL twin for the DuckDB oracle.

Every query reads the driver tables of ``sf_dir`` in full (through the
listing binding, or directly for ``documents`` and ``lineitem``).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.columns import COLS, KIND_LABELS, MAP_SAMPLE_ROWS, PREMIUM_WORDS
from lodgeframe.functions import scalars as S
from lodgeframe.operators import clean as Q
from lodgeframe.operators import estimate as E
from lodgeframe.operators import explore as X
from lodgeframe.operators import filters as FL
from lodgeframe.operators import kpis as K
from lodgeframe.operators import profile as P
from lodgeframe.operators import rank as R
from lodgeframe.operators import sampling as T
from lodgeframe.operators.enrich import dashboard_columns, model_frame
from lodgeframe.plans import bundle as B
from lodgeframe.plans import listings as L
from lodgeframe.plans import ml as M
from lodgeframe.plans.oracle import RAW_COLUMNS, with_ctes
from lodgeframe.session import checkpoint_root, scratch_path
from lodgeframe.sources import raw as SR
from lodgeframe.sources import sinks as SK
from lodgeframe.sources import tables as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn
    return deco


# --------------------------------------------------------------------------
# Profiling and cleaning (Q1-Q12)
# --------------------------------------------------------------------------
def _null_profile_sql(table: str, columns: list[str]) -> str:
    def miss(c: str) -> str:
        return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"
    parts = [f"SELECT '{c}' AS column_name, {i} AS position, "
             f"CAST(sum(CASE WHEN {miss(c)} THEN 1 ELSE 0 END) AS BIGINT) AS missing, "
             f"count(*) AS total FROM {table}" for i, c in enumerate(columns)]
    body = " UNION ALL ".join(parts)
    return (f"SELECT column_name, CAST(position AS INTEGER) AS position, missing, "
            f"round(missing / total * 100, 2) AS missing_pct, total "
            f"FROM ({body}) WHERE total > 0")


_RAW = [c.strip() for c in RAW_COLUMNS.split(",")]


@register("q1_null_profile_raw", _null_profile_sql("typed", _RAW))
def q1_null_profile_raw(spark, sf_dir):
    return P.null_profile(L.raw(spark, sf_dir))


@register("q1_null_profile_silver", _null_profile_sql("silver", _RAW))
def q1_null_profile_silver(spark, sf_dir):
    return P.null_profile(L.silver(spark, sf_dir))


_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@register("q1_null_profile_documents", _null_profile_sql("documents", _DOC_COLS))
def q1_null_profile_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*_DOC_COLS)
    return P.null_profile(docs)


@register("q2_clean_audit", """
SELECT CAST(step AS INTEGER) AS step, rule, CAST(removed AS BIGINT) AS removed FROM (
  SELECT 1 AS step, 'price' AS rule, count(*) FILTER (WHERE rule = 'price') AS removed FROM ruled
  UNION ALL SELECT 2, 'nights', count(*) FILTER (WHERE rule = 'nights') FROM ruled
  UNION ALL SELECT 3, 'coordinates', count(*) FILTER (WHERE rule = 'coordinates') FROM ruled
  UNION ALL SELECT 4, 'duplicates',
    count(*) FILTER (WHERE rule IS NULL) - count(DISTINCT id) FILTER (WHERE rule IS NULL) FROM ruled
  UNION ALL SELECT 5, 'remaining', count(DISTINCT id) FILTER (WHERE rule IS NULL) FROM ruled)
""")
def q2_clean_audit(spark, sf_dir):
    return P.clean_audit(L.typed(spark, sf_dir))


@register("q3_retention", """
SELECT CAST((SELECT count(*) FROM typed) AS BIGINT) AS rows_in,
       CAST((SELECT count(*) FROM silver) AS BIGINT) AS rows_out,
       CAST((SELECT count(*) FROM typed) - (SELECT count(*) FROM silver) AS BIGINT) AS rows_removed,
       round((SELECT count(*) FROM silver) * 100.0 / (SELECT count(*) FROM typed), 2)
         AS retention_pct
""")
def q3_retention(spark, sf_dir):
    return P.retention(L.raw(spark, sf_dir), L.silver(spark, sf_dir))


@register("q4_cast", "SELECT * FROM typed")
def q4_cast(spark, sf_dir):
    return Q.cast_columns(L.raw(spark, sf_dir))


@register("q5_fill", "SELECT * FROM filled")
def q5_fill(spark, sf_dir):
    return L.typed(spark, sf_dir)


@register("q6_filter_price", "SELECT * FROM filled WHERE price IS NOT NULL AND price >= 1")
def q6_filter_price(spark, sf_dir):
    return Q.filter_min(L.typed(spark, sf_dir), COLS.value, 1)


@register("q7_filter_nights",
          "SELECT * FROM filled WHERE minimum_nights IS NOT NULL AND minimum_nights BETWEEN 1 AND 365")
def q7_filter_nights(spark, sf_dir):
    return Q.filter_between(L.typed(spark, sf_dir), COLS.nights, 1, 365)


@register("q8_require_coordinates", """
SELECT * FROM filled WHERE latitude IS NOT NULL AND NOT isnan(latitude)
  AND longitude IS NOT NULL AND NOT isnan(longitude)""")
def q8_require_coordinates(spark, sf_dir):
    return Q.require_columns(L.typed(spark, sf_dir), [COLS.lat, COLS.lon])


@register("q9_dedup_listings", f"""
SELECT * FROM filled QUALIFY row_number() OVER (PARTITION BY id ORDER BY
  {RAW_COLUMNS.replace('id, ', '', 1).replace(', ', ' NULLS FIRST, ')} NULLS FIRST) = 1""")
def q9_dedup_listings(spark, sf_dir):
    return Q.dedup(L.typed(spark, sf_dir), [COLS.key])


_LI = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
       "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@register("q9_dedup_lineitem", f"""
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, {_LI.replace('l_orderkey, ', '', 1).replace('l_linenumber, ', '', 1).replace(', l_shipdate', '').replace(', ', ' NULLS FIRST, ')} NULLS FIRST) = 1""")
def q9_dedup_lineitem(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # Latest shipment first: order by the negated microseconds since the
    # epoch (wall clock, no time zone involved), then by every column.
    keyed = li.withColumn("_neg_ship", -F.expr(
        "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', l_shipdate)"))
    return Q.dedup(keyed, ["l_orderkey", "l_linenumber"], order=["_neg_ship"]).drop("_neg_ship")


@register("q10_fill_numeric", f"""
SELECT id, name, host_id, host_name, neighbourhood_group, neighbourhood,
  coalesce(latitude, 0.0) AS latitude, longitude, room_type, price,
  minimum_nights, number_of_reviews, last_review,
  coalesce(reviews_per_month, 0.0) AS reviews_per_month,
  calculated_host_listings_count, availability_365
FROM typed""")
def q10_fill_numeric(spark, sf_dir):
    # The label (price) keeps its nulls; every other numeric null becomes 0.
    return Q.fill_numeric(Q.cast_columns(L.raw(spark, sf_dir)), 0.0, exclude=[COLS.value])


@register("q11_cap_filter", "SELECT * FROM gold WHERE price > 0 AND price <= 2000")
def q11_cap_filter(spark, sf_dir):
    return Q.cap_filter(L.gold(spark, sf_dir), COLS.value, 0, 2000)


@register("q12_silver", "SELECT * FROM silver")
def q12_silver(spark, sf_dir):
    return L.silver(spark, sf_dir)


# --------------------------------------------------------------------------
# Features and windows
# --------------------------------------------------------------------------
@register("w1_w2_gold_features", "SELECT * FROM gold")
def w1_w2_gold_features(spark, sf_dir):
    return L.gold(spark, sf_dir)


@register("w1_w2_gold_features_window", "SELECT * FROM gold")
def w1_w2_gold_features_window(spark, sf_dir):
    return L.gold(spark, sf_dir, form="window")


# --------------------------------------------------------------------------
# KPIs (A1, A2, A4, A5, A19, A20)
# --------------------------------------------------------------------------
_A1_SQL = """
SELECT neighbourhood_group, room_type, count(*) AS nb_listings,
  round(avg(price), 2) AS avg_price,
  CAST(quantile_disc(price, 0.5) AS INTEGER) AS median_price,
  min(price) AS min_price, max(price) AS max_price,
  round(avg(availability_365), 1) AS avg_availability,
  round(avg(number_of_reviews), 1) AS avg_reviews,
  round(avg(reviews_per_month), 2) AS avg_reviews_per_month
FROM silver GROUP BY neighbourhood_group, room_type ORDER BY 1, 2"""


@register("a1_zone_kind_kpis", _A1_SQL)
def a1_zone_kind_kpis(spark, sf_dir):
    """With the exact discrete median, the SQL ``quantile_disc``."""
    return K.zone_kind_kpis(L.silver(spark, sf_dir), median_kind="disc")


@register("a1_zone_kind_kpis_approx")
def a1_zone_kind_kpis_approx(spark, sf_dir):
    """The reference's ``percentile_approx`` median (bounded memory per
    group). It can sit a rank away from the exact median on large groups,
    so it has no SQL twin; a unit test bounds its rank error."""
    return K.zone_kind_kpis(L.silver(spark, sf_dir), median_kind="approx")


# --------------------------------------------------------------------------
# Dashboard analytics over the dashboard frame (A2-A21, P1-P3, T*, F7-F18)
# --------------------------------------------------------------------------

SEED = 42
KINDS = ["Entire home/apt", "Private room", "Shared room"]
KIND_ALIASES = ["entire_home", "private_room", "shared_room"]
# Fixed query parameters of the filter queries.
P1_ZONES = ["AMERICA", "EUROPE"]
P1_KINDS = ["Entire home/apt", "Private room"]
P1_PRICE_MAX, P1_AVAIL_MIN, P1_OCC_MIN_PCT = 300, 30, 20
P2_ZONES = ["ASIA"]


def _sz_cte(min_rows: int = 30) -> str:
    return (f", sz AS (SELECT neighbourhood, median(price) AS m, count(*) AS n FROM dash "
            f"GROUP BY neighbourhood HAVING count(*) >= {min_rows})")


@register("a2_global_kpis", _sz_cte() + """
SELECT count(*) AS n_listings,
  round(coalesce(avg(price), 0.0), 2) AS mean_price,
  round(coalesce(median(price), 0.0), 2) AS median_price,
  round(coalesce(avg(availability_365), 0.0), 2) AS mean_availability,
  round(coalesce(avg(occupancy_rate) * 100, 0.0), 2) AS mean_occupancy_pct,
  round(coalesce(avg(number_of_reviews), 0.0), 2) AS mean_reviews,
  count(*) FILTER (WHERE availability_365 > 180) AS n_long_availability,
  coalesce((SELECT neighbourhood FROM sz ORDER BY m, neighbourhood LIMIT 1), '—') AS cheapest_subzone,
  coalesce((SELECT m FROM sz ORDER BY m, neighbourhood LIMIT 1), 0.0) AS cheapest_median,
  coalesce((SELECT neighbourhood FROM sz ORDER BY m DESC, neighbourhood LIMIT 1), '—') AS dearest_subzone,
  coalesce((SELECT m FROM sz ORDER BY m DESC, neighbourhood LIMIT 1), 0.0) AS dearest_median
FROM dash""")
def a2_global_kpis(spark, sf_dir):
    return K.global_kpis(L.dash(spark, sf_dir))


@register("a3_extreme_groups", _sz_cte() + """
SELECT (SELECT neighbourhood FROM sz ORDER BY m, neighbourhood LIMIT 1) AS cheapest_subzone,
  (SELECT m FROM sz ORDER BY m, neighbourhood LIMIT 1) AS cheapest_median,
  (SELECT neighbourhood FROM sz ORDER BY m DESC, neighbourhood LIMIT 1) AS dearest_subzone,
  (SELECT m FROM sz ORDER BY m DESC, neighbourhood LIMIT 1) AS dearest_median""")
def a3_extreme_groups(spark, sf_dir):
    return R.extreme_groups(L.dash(spark, sf_dir))


@register("a4_price_by_zone", """
SELECT neighbourhood_group, median(price) AS median_price, round(avg(price), 4) AS mean_price,
  count(*) AS n FROM dash GROUP BY neighbourhood_group""")
def a4_price_by_zone(spark, sf_dir):
    return K.price_by_zone(L.dash(spark, sf_dir))


@register("a5_price_by_kind", """
SELECT room_type, median(price) AS median_price, round(avg(price), 4) AS mean_price,
  count(*) AS n, round(avg(availability_365), 4) AS mean_availability
FROM dash GROUP BY room_type""")
def a5_price_by_kind(spark, sf_dir):
    return K.price_by_kind(L.dash(spark, sf_dir))


def _rank_sql(n: int, cheapest: bool) -> str:
    direction = "ASC" if cheapest else "DESC"
    return f"""
SELECT neighbourhood, neighbourhood_group, median(price) AS median_price,
  round(avg(availability_365), 4) AS mean_availability,
  round(avg(occupancy_rate), 4) AS mean_occupancy, count(*) AS n
FROM dash GROUP BY neighbourhood, neighbourhood_group HAVING count(*) >= 30
ORDER BY median_price {direction}, neighbourhood, neighbourhood_group LIMIT {n}"""


@register("a6_t5_cheapest_subzones", _rank_sql(10, True))
def a6_t5_cheapest_subzones(spark, sf_dir):
    return R.rank_subzones(L.dash(spark, sf_dir), n=10, cheapest=True)


@register("a6_t5_dearest_subzones", _rank_sql(12, False))
def a6_t5_dearest_subzones(spark, sf_dir):
    return R.rank_subzones(L.dash(spark, sf_dir), n=12, cheapest=False)


@register("a6_t5_ten_dearest_subzones", _rank_sql(10, False))
def a6_t5_ten_dearest_subzones(spark, sf_dir):
    return R.rank_subzones(L.dash(spark, sf_dir), n=10, cheapest=False)


_SCORE_CTES = """
, st AS (
  SELECT neighbourhood, neighbourhood_group, median(price) AS mp, avg(availability_365) AS ma,
         avg(number_of_reviews) AS mr, avg(occupancy_rate) AS mo, count(*) AS n
  FROM dash GROUP BY neighbourhood, neighbourhood_group HAVING count(*) >= 30),
mm AS (SELECT min(mp) AS lp, max(mp) AS hp, min(ma) AS la, max(ma) AS ha,
              min(mr) AS lr, max(mr) AS hr FROM st),
scored AS (
  SELECT neighbourhood, neighbourhood_group, mp AS median_price,
    round(ma, 4) AS mean_availability, round(mr, 4) AS mean_reviews,
    round(mo, 4) AS mean_occupancy, n,
    round(0.5 * (1.0 - coalesce((mp - lp) / nullif(hp - lp, 0), 0.0))
          + 0.3 * coalesce((ma - la) / nullif(ha - la, 0), 0.0)
          + 0.2 * coalesce((mr - lr) / nullif(hr - lr, 0), 0.0), 3) AS score
  FROM st CROSS JOIN mm)"""


@register("a7_compromise_score", _SCORE_CTES + """
SELECT * FROM scored ORDER BY score DESC, neighbourhood, neighbourhood_group""")
def a7_compromise_score(spark, sf_dir):
    return R.compromise_score(L.dash(spark, sf_dir))


@register("a7_t5_best_subzones", _SCORE_CTES + """
SELECT * FROM scored ORDER BY score DESC, neighbourhood, neighbourhood_group LIMIT 12""")
def a7_t5_best_subzones(spark, sf_dir):
    return R.compromise_score(L.dash(spark, sf_dir)).limit(12)


@register("f18_t5_recommendations", _SCORE_CTES + """
SELECT neighbourhood AS subzone, neighbourhood_group AS zone,
  round(median_price, 0) AS median_price, round(mean_availability, 0) AS availability_days,
  round(mean_reviews, 0) AS mean_reviews, round(mean_occupancy * 100, 0) AS occupancy_pct,
  n AS listings, score
FROM scored ORDER BY score DESC, neighbourhood, neighbourhood_group LIMIT 8""")
def f18_t5_recommendations(spark, sf_dir):
    return R.recommendation_table(L.dash(spark, sf_dir), k=8)


@register("a8_pivot_median", """
SELECT neighbourhood_group,
  median(price) FILTER (WHERE room_type = 'Entire home/apt') AS entire_home,
  median(price) FILTER (WHERE room_type = 'Private room') AS private_room,
  median(price) FILTER (WHERE room_type = 'Shared room') AS shared_room
FROM dash GROUP BY neighbourhood_group""")
def a8_pivot_median(spark, sf_dir):
    return X.pivot_median(L.dash(spark, sf_dir), COLS.zone, COLS.kind, COLS.value,
                          KINDS, KIND_ALIASES)


@register("a9_p4_value_bounds", """
SELECT min(price) AS value_min, CAST(trunc(quantile_cont(price, 0.99)) AS INTEGER) AS value_p99,
  max(price) AS value_max FROM dash""")
def a9_p4_value_bounds(spark, sf_dir):
    return X.value_bounds(L.dash(spark, sf_dir), COLS.value)


@register("a10_t2_color_range", f"""
, smp AS (SELECT * FROM dash ORDER BY {T.key_hash_sql('id', SEED, 'sample_n')}, id LIMIT {MAP_SAMPLE_ROWS})
SELECT round(quantile_cont(price, 0.02), 6) AS color_low,
  round(quantile_cont(price, 0.95), 6) AS color_high FROM smp""")
def a10_t2_color_range(spark, sf_dir):
    smp = T.sample_n(L.dash(spark, sf_dir), MAP_SAMPLE_ROWS, COLS.key, SEED)
    out = X.color_range(smp, COLS.value)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@register("a11_p5_histogram", """
, bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(40)),
cnt AS (SELECT CAST(least(floor((CAST(price AS DOUBLE) - 0.0) / 12.5), 39) AS INTEGER) AS bin,
          count(*) AS n
        FROM dash WHERE CAST(price AS DOUBLE) >= 0.0 AND CAST(price AS DOUBLE) <= 500.0 GROUP BY 1)
SELECT bins.bin, round(CAST(0.0 AS DOUBLE) + bins.bin * CAST(12.5 AS DOUBLE), 6) AS bin_low,
  round(CAST(0.0 AS DOUBLE) + (bins.bin + 1) * CAST(12.5 AS DOUBLE), 6) AS bin_high,
  CAST(coalesce(cnt.n, 0) AS BIGINT) AS n,
  (SELECT median(price) FROM dash) AS overall_median
FROM bins LEFT JOIN cnt ON bins.bin = cnt.bin""")
def a11_p5_histogram(spark, sf_dir):
    return X.histogram(L.dash(spark, sf_dir), COLS.value, bins=40, lo=0.0, hi=500.0)


@register("a15_price_grid", """
SELECT cell_y, cell_x,
  round((CAST(cell_y AS DOUBLE) + 0.5) * CAST(0.01 AS DOUBLE), 6) AS center_lat,
  round((CAST(cell_x AS DOUBLE) + 0.5) * CAST(0.01 AS DOUBLE), 6) AS center_lon,
  count(*) AS n, CAST(sum(price) AS BIGINT) AS value_sum, round(avg(price), 4) AS value_mean
FROM (SELECT CAST(floor(latitude / CAST(0.01 AS DOUBLE)) AS BIGINT) AS cell_y,
             CAST(floor(longitude / CAST(0.01 AS DOUBLE)) AS BIGINT) AS cell_x, price FROM dash)
GROUP BY cell_y, cell_x""")
def a15_price_grid(spark, sf_dir):
    return X.price_grid(L.dash(spark, sf_dir), 0.01)


GOLD_NUMERIC = ["price", "minimum_nights", "number_of_reviews", "reviews_per_month",
                "calculated_host_listings_count", "availability_365", "price_log",
                "has_reviews", "occupancy_rate", "zone_avg_price", "price_vs_zone_pct",
                "zone_type_avg_price", "latitude", "longitude"]


def _box_sql(columns: list[str]) -> str:
    parts = []
    for c in columns:
        parts.append(f"""
SELECT '{c}' AS column_name, round(q[1], 6) AS q1, round(q[2], 6) AS median, round(q[3], 6) AS q3,
  round(q[3] - q[1], 6) AS iqr,
  round(min(x) FILTER (WHERE x >= q[1] - 1.5 * (q[3] - q[1])), 6) AS whisker_low,
  round(max(x) FILTER (WHERE x <= q[3] + 1.5 * (q[3] - q[1])), 6) AS whisker_high,
  count(*) FILTER (WHERE x < q[1] - 1.5 * (q[3] - q[1])) AS outliers_low,
  count(*) FILTER (WHERE x > q[3] + 1.5 * (q[3] - q[1])) AS outliers_high,
  count(x) AS n
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM gold) t
CROSS JOIN (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM gold) s
GROUP BY q""")
    return " UNION ALL ".join(parts)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (interpolated quantiles and means)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


@register("a16_box_stats", _box_sql(GOLD_NUMERIC))
def a16_box_stats(spark, sf_dir):
    return _rounded(X.box_stats(L.gold(spark, sf_dir), GOLD_NUMERIC))


def _corr_sql(columns: list[str]) -> str:
    parts = []
    for i, a in enumerate(columns):
        for b in columns[i + 1:]:
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
                         f"round(CASE WHEN isnan(corr({a}, {b})) THEN NULL "
                         f"ELSE corr({a}, {b}) END, 6) AS corr FROM gold")
    return " UNION ALL ".join(parts)


@register("a17_correlation_matrix", _corr_sql(GOLD_NUMERIC))
def a17_correlation_matrix(spark, sf_dir):
    return X.correlation_matrix(L.gold(spark, sf_dir), GOLD_NUMERIC)


@register("a18_leakage_screen", f"""
SELECT column_b AS column_name, corr FROM ({_corr_sql(['price_log'] + [c for c in GOLD_NUMERIC if c != 'price_log'])})
WHERE column_a = 'price_log' AND abs(corr) > 0.9""")
def a18_leakage_screen(spark, sf_dir):
    return X.leakage_screen(L.gold(spark, sf_dir), "price_log", GOLD_NUMERIC)


@register("a19_count_by_zone", """
SELECT neighbourhood_group, count(*) AS n FROM silver GROUP BY neighbourhood_group""")
def a19_count_by_zone(spark, sf_dir):
    return K.count_by_zone(L.silver(spark, sf_dir))


@register("a20_occupancy_by_zone", """
SELECT neighbourhood_group, round(avg(occupancy_rate), 4) AS mean_occupancy
FROM gold GROUP BY neighbourhood_group""")
def a20_occupancy_by_zone(spark, sf_dir):
    return K.occupancy_by_zone(L.gold(spark, sf_dir))


def _pairs_sql(x: str, y: str, xw: float, yw: float) -> str:
    return f"""
SELECT x_bin, y_bin, CAST(x_bin AS DOUBLE) * {xw} AS x_low, CAST(y_bin AS DOUBLE) * {yw} AS y_low,
  count(*) AS n
FROM (SELECT CAST(floor(CAST({x} AS DOUBLE) / {xw}) AS BIGINT) AS x_bin,
             CAST(floor(CAST({y} AS DOUBLE) / {yw}) AS BIGINT) AS y_bin
      FROM dash WHERE {x} IS NOT NULL AND {y} IS NOT NULL)
GROUP BY x_bin, y_bin"""


@register("a21_availability_vs_price", _pairs_sql("availability_365", "price", 30.0, 25.0))
def a21_availability_vs_price(spark, sf_dir):
    return X.binned_pairs(L.dash(spark, sf_dir), COLS.availability, COLS.value, 30.0, 25.0)


@register("a21_reviews_vs_price", _pairs_sql("number_of_reviews", "price", 1.0, 25.0))
def a21_reviews_vs_price(spark, sf_dir):
    return X.binned_pairs(L.dash(spark, sf_dir), COLS.reviews, COLS.value, 1.0, 25.0)


def _in(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_P1_WHERE = (f"neighbourhood_group IN ({_in(P1_ZONES)}) AND room_type IN ({_in(P1_KINDS)}) "
             f"AND price <= {P1_PRICE_MAX} AND availability_365 >= {P1_AVAIL_MIN} "
             f"AND occupancy_rate >= {P1_OCC_MIN_PCT} / 100")


def _p1_predicate():
    return FL.listing_predicate(zones=P1_ZONES, kinds=P1_KINDS, price_max=P1_PRICE_MAX,
                                avail_min=P1_AVAIL_MIN, occ_min_pct=P1_OCC_MIN_PCT)


@register("p1_listing_filter", f"SELECT * FROM dash WHERE {_P1_WHERE}")
def p1_listing_filter(spark, sf_dir):
    return L.dash(spark, sf_dir).filter(_p1_predicate())


@register("p2_filter_options", f"""
SELECT DISTINCT * FROM (
  SELECT 'zone' AS option, neighbourhood_group AS value FROM dash
  UNION ALL SELECT 'kind', room_type FROM dash
  UNION ALL SELECT 'subzone', neighbourhood FROM dash WHERE neighbourhood_group IN ({_in(P2_ZONES)}))""")
def p2_filter_options(spark, sf_dir):
    return FL.filter_options(L.dash(spark, sf_dir), zones=P2_ZONES)


@register("p3_match_share", f"""
SELECT count(*) FILTER (WHERE {_P1_WHERE}) AS n_matching, count(*) AS n_total,
  round(count(*) FILTER (WHERE {_P1_WHERE}) / count(*), 4) AS share FROM dash""")
def p3_match_share(spark, sf_dir):
    return FL.match_share(L.dash(spark, sf_dir), _p1_predicate())


@register("t1_sample_fraction", f"""
SELECT * FROM gold WHERE {T.key_hash_sql('id', SEED)} < {int(0.1 * T.SPACE)}""")
def t1_sample_fraction(spark, sf_dir):
    return T.sample_fraction(L.gold(spark, sf_dir), 0.1, COLS.key, SEED)


@register("t2_sample_n", f"""
SELECT * FROM dash ORDER BY {T.key_hash_sql('id', SEED, 'sample_n')}, id LIMIT {MAP_SAMPLE_ROWS}""")
def t2_sample_n(spark, sf_dir):
    return T.sample_n(L.dash(spark, sf_dir), MAP_SAMPLE_ROWS, COLS.key, SEED)


@register("t3_split", f"""
SELECT *, CASE WHEN {T.key_hash_sql('id', SEED, 'split')} < {int(0.8 * T.SPACE)} THEN 'train'
  ELSE 'test' END AS split FROM gold""")
def t3_split(spark, sf_dir):
    return T.split(L.gold(spark, sf_dir), 0.8, COLS.key, SEED)


@register("f7_f8_dashboard_frame", "SELECT * FROM dash")
def f7_f8_dashboard_frame(spark, sf_dir):
    return L.dash(spark, sf_dir)


_BED = r"(\d+)\s*(?:br|bdrm|bedroom|bed|bdr)"


def _flag_sql(text: str, word: str, alias: str) -> str:
    return (f"CASE WHEN regexp_matches(lower({text}), '{word}') THEN CAST(1.0 AS DOUBLE) "
            f"ELSE CAST(0.0 AS DOUBLE) END AS {alias}")


@register("f9_f12_model_frame", f"""
SELECT gold.*, {_flag_sql('name', 'studio', 'is_studio')}, {_flag_sql('name', 'loft', 'is_loft')},
  CASE WHEN regexp_matches(lower(name), 'studio') THEN 0.0
       ELSE CAST(CASE WHEN regexp_extract(lower(name), '{_BED}', 1) = '' THEN '0'
                      ELSE regexp_extract(lower(name), '{_BED}', 1) END AS DOUBLE) END
    AS bedrooms_extracted,
  {', '.join(_flag_sql('name', w, 'has_' + w) for w in ['luxury', 'spacious', 'view', 'private', 'renovated', 'huge'])},
  sqrt((latitude - 40.7580) * (latitude - 40.7580)
       + (longitude - (-73.9855)) * (longitude - (-73.9855))) AS distance_center,
  sqrt((latitude - 40.6413) * (latitude - 40.6413)
       + (longitude - (-73.7781)) * (longitude - (-73.7781))) AS distance_jfk,
  CAST(length(name) AS INTEGER) AS name_length
FROM gold""")
def f9_f12_model_frame(spark, sf_dir):
    return model_frame(L.gold(spark, sf_dir))


@register("f9_f12_document_text", f"""
SELECT doc_id,
  {', '.join(_flag_sql('text', w, 'has_' + w) for w in ['luxury', 'spacious', 'view', 'private', 'renovated', 'huge'])},
  CAST(CASE WHEN regexp_extract(lower(text), '{_BED}', 1) = '' THEN '0'
            ELSE regexp_extract(lower(text), '{_BED}', 1) END AS DOUBLE) AS bedrooms_extracted,
  CAST(length(text) AS INTEGER) AS text_length
FROM documents""")
def f9_f12_document_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.select("doc_id", *S.keyword_flags("text", PREMIUM_WORDS),
                       S.extract_count("text").alias("bedrooms_extracted"),
                       S.name_length("text").alias("text_length"))


@register("f13_log_label", """
SELECT id, price, round(CASE WHEN price > 0 THEN ln(price) END, 6) AS log_label FROM dash""")
def f13_log_label(spark, sf_dir):
    d = L.dash(spark, sf_dir)
    return d.select(COLS.key, COLS.value, F.round(S.log_label(COLS.value), 6).alias("log_label"))


@register("f14_map_labels", f"""
SELECT id, room_type, CASE room_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in KIND_LABELS.items())}
  ELSE room_type END AS kind_label FROM dash""")
def f14_map_labels(spark, sf_dir):
    d = L.dash(spark, sf_dir)
    return d.select(COLS.key, COLS.kind, S.map_labels(COLS.kind, KIND_LABELS).alias("kind_label"))


F16_MAE = 25.0


@register("f16_f17_price_interval", f"""
SELECT id, minimum_nights, round(exp(price_log) - 1, 4) AS estimate,
  round(greatest(0.0, exp(price_log) - 1 - {F16_MAE}), 4) AS estimate_low,
  round(exp(price_log) - 1 + {F16_MAE}, 4) AS estimate_high,
  round((exp(price_log) - 1) * minimum_nights, 4) AS stay_cost,
  round(greatest(0.0, exp(price_log) - 1 - {F16_MAE}) * minimum_nights, 4) AS stay_cost_low,
  round((exp(price_log) - 1 + {F16_MAE}) * minimum_nights, 4) AS stay_cost_high
FROM gold""")
def f16_f17_price_interval(spark, sf_dir):
    """The log-price column stands in for a model's log prediction."""
    g = L.gold(spark, sf_dir).select(COLS.key, COLS.nights, "price_log")
    iv = g.select(COLS.key, COLS.nights, *S.price_interval("price_log", F16_MAE, plus_one=True))
    return iv.select(
        COLS.key, COLS.nights,
        *[F.round(c, 4).alias(c) for c in ("estimate", "estimate_low", "estimate_high")],
        F.round(S.stay_cost("estimate", COLS.nights), 4).alias("stay_cost"),
        F.round(S.stay_cost("estimate_low", COLS.nights), 4).alias("stay_cost_low"),
        F.round(S.stay_cost("estimate_high", COLS.nights), 4).alias("stay_cost_high"))


# --------------------------------------------------------------------------
# Estimation lookups (A12-A14, J1-J3). Requests: every dashboard listing,
# with some sub-zones, zones and kinds renamed (by key) to unseen values so
# every fallback is exercised.
# --------------------------------------------------------------------------
UNKNOWN_SUBZONE, UNKNOWN_ZONE, UNKNOWN_KIND = "Unknown district", "ATLANTIS", "Hotel room"
FEATS = E.imputed_features(COLS)


def _requests(spark, sf_dir) -> DataFrame:
    d = L.dash(spark, sf_dir)
    k = F.col(COLS.key)
    return d.select(
        COLS.key,
        F.when(k % 13 == 4, F.lit(UNKNOWN_SUBZONE)).otherwise(F.col(COLS.subzone)).alias(COLS.subzone),
        F.when(k % 11 == 5, F.lit(UNKNOWN_ZONE)).otherwise(F.col(COLS.zone)).alias(COLS.zone),
        F.when(k % 7 == 3, F.lit(UNKNOWN_KIND)).otherwise(F.col(COLS.kind)).alias(COLS.kind),
        COLS.availability)


_REQ_CTE = f"""
, req AS (
  SELECT id,
    CASE WHEN id % 13 = 4 THEN '{UNKNOWN_SUBZONE}' ELSE neighbourhood END AS neighbourhood,
    CASE WHEN id % 11 = 5 THEN '{UNKNOWN_ZONE}' ELSE neighbourhood_group END AS neighbourhood_group,
    CASE WHEN id % 7 = 3 THEN '{UNKNOWN_KIND}' ELSE room_type END AS room_type,
    availability_365
  FROM dash)"""


@register("a12_group_medians", f"""
SELECT neighbourhood, room_type, {', '.join(f'round(median({f}), 6) AS {f}' for f in FEATS)}
FROM dash GROUP BY neighbourhood, room_type""")
def a12_group_medians(spark, sf_dir):
    return _rounded(E.group_medians(L.dash(spark, sf_dir), [COLS.subzone, COLS.kind], FEATS))


@register("a13_global_medians", f"""
SELECT {', '.join(f'round(median({f}), 6) AS {f}' for f in FEATS)} FROM dash""")
def a13_global_medians(spark, sf_dir):
    return _rounded(E.global_medians(L.dash(spark, sf_dir), FEATS))


@register("a14_centroids", """
SELECT neighbourhood, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude
FROM dash GROUP BY neighbourhood""")
def a14_centroids(spark, sf_dir):
    return _rounded(E.centroids(L.dash(spark, sf_dir), COLS.subzone, COLS.lat, COLS.lon))


@register("j1_impute_from_group", _REQ_CTE + f"""
, gm AS (SELECT neighbourhood, room_type, {', '.join(f'median({f}) AS {f}' for f in FEATS)}
         FROM dash GROUP BY neighbourhood, room_type),
gmed AS (SELECT {', '.join(f'median({f}) AS {f}' for f in FEATS)} FROM dash)
SELECT req.*, {', '.join(f'round(coalesce(gm.{f}, gmed.{f}), 6) AS {f}' for f in FEATS)}
FROM req LEFT JOIN gm ON req.neighbourhood IS NOT DISTINCT FROM gm.neighbourhood
  AND req.room_type IS NOT DISTINCT FROM gm.room_type CROSS JOIN gmed""")
def j1_impute_from_group(spark, sf_dir):
    out = E.impute_from_group(_requests(spark, sf_dir), L.dash(spark, sf_dir),
                              [COLS.subzone, COLS.kind], FEATS)
    return _rounded(out)


@register("j2_attach_centroid", _REQ_CTE + """
, cent AS (SELECT neighbourhood, avg(latitude) AS lat, avg(longitude) AS lon
           FROM dash GROUP BY neighbourhood),
fb AS (SELECT avg(lat) AS lat, avg(lon) AS lon FROM cent)
SELECT req.*, round(coalesce(cent.lat, fb.lat), 6) AS latitude,
  round(coalesce(cent.lon, fb.lon), 6) AS longitude
FROM req LEFT JOIN cent ON req.neighbourhood IS NOT DISTINCT FROM cent.neighbourhood
CROSS JOIN fb""")
def j2_attach_centroid(spark, sf_dir):
    out = E.attach_centroid(_requests(spark, sf_dir), L.dash(spark, sf_dir),
                            COLS.subzone, COLS.lat, COLS.lon)
    return _rounded(out)


@register("j3_estimate_range", _REQ_CTE + """
, pk AS (SELECT neighbourhood_group, room_type, quantile_cont(price, [0.25, 0.5, 0.75]) AS q,
                count(*) AS n FROM dash GROUP BY neighbourhood_group, room_type),
pz AS (SELECT neighbourhood_group, quantile_cont(price, [0.25, 0.5, 0.75]) AS q, count(*) AS n
       FROM dash GROUP BY neighbourhood_group),
pa AS (SELECT quantile_cont(price, [0.25, 0.5, 0.75]) AS q, count(*) AS n FROM dash)
SELECT req.*,
  round(coalesce(pk.q[2], pz.q[2], pa.q[2]), 6) AS estimate,
  round(coalesce(pk.q[1], pz.q[1], pa.q[1]), 6) AS low,
  round(coalesce(pk.q[3], pz.q[3], pa.q[3]), 6) AS high,
  coalesce(pk.n, pz.n, pa.n) AS n_comparable,
  CASE WHEN pk.n IS NOT NULL THEN 'zone_kind' WHEN pz.n IS NOT NULL THEN 'zone' ELSE 'all' END
    AS basis
FROM req
LEFT JOIN pk ON req.neighbourhood_group IS NOT DISTINCT FROM pk.neighbourhood_group
  AND req.room_type IS NOT DISTINCT FROM pk.room_type
LEFT JOIN pz ON req.neighbourhood_group IS NOT DISTINCT FROM pz.neighbourhood_group
CROSS JOIN pa""")
def j3_estimate_range(spark, sf_dir):
    out = E.estimate_range(_requests(spark, sf_dir), L.dash(spark, sf_dir),
                           COLS.zone, COLS.kind, COLS.value)
    return _rounded(out)


# --------------------------------------------------------------------------
# Machine learning (M1-M16, S10, T6). Stages and metrics that SQL can express
# have their own queries with a twin; fitted models are checked by unit tests.
# --------------------------------------------------------------------------
_IN_TRAIN = f"{T.key_hash_sql('id', SEED, 'split')} < {int(0.8 * T.SPACE)}"
_INDEX_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS label, "
    f"CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS idx, "
    f"count(*) OVER () AS n_labels FROM gold WHERE {_IN_TRAIN} GROUP BY {c}"
    for c in M.CATEGORICAL)


def _indexed(spark, sf_dir) -> DataFrame:
    """Gold rows with the index and the one-hot slot of each categorical
    column, both fitted on the training part. Every fit and the result read
    these columns, so they are made once."""
    from pyspark.ml import Pipeline
    g = L.gold(spark, sf_dir).select(COLS.key, *M.CATEGORICAL).persist()
    train, _ = T.train_test(g, 0.8, COLS.key, SEED)
    stages = M.feature_stages(g, numeric=[])[:-1]
    return Pipeline(stages=stages).fit(train).transform(g)


@register("m1_string_index", f"""
SELECT g.column_name, g.label, coalesce(i.idx, m.n_labels) AS idx, g.n FROM (
  {" UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS label, count(*) AS n FROM gold GROUP BY {c}"
                      for c in M.CATEGORICAL)}) g
LEFT JOIN ({_INDEX_SQL}) i ON g.column_name = i.column_name AND g.label = i.label
JOIN (SELECT DISTINCT column_name, CAST(n_labels AS DOUBLE) AS n_labels FROM ({_INDEX_SQL})) m
  ON g.column_name = m.column_name""")
def m1_string_index(spark, sf_dir):
    """Index by frequency in the training part, ties by label; a label unseen
    there gets the number of labels."""
    pairs = ", ".join(f"'{c}', `{c}`, `{c}_code`" for c in M.CATEGORICAL)
    long = _indexed(spark, sf_dir).selectExpr(
        f"stack({len(M.CATEGORICAL)}, {pairs}) AS (column_name, label, idx)")
    return long.groupBy("column_name", "label", "idx").agg(F.count(F.lit(1)).alias("n"))


@register("m2_one_hot", f"""
SELECT g.id, (SELECT CAST(max(n_labels) AS INTEGER) FROM ({_INDEX_SQL})
              WHERE column_name = '{COLS.kind}') AS n_slots,
  CAST(CASE WHEN i.label IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS total, CAST(i.idx AS INTEGER) AS slot
FROM gold g LEFT JOIN ({_INDEX_SQL}) i ON i.column_name = '{COLS.kind}' AND i.label = g.{COLS.kind}""")
def m2_one_hot(spark, sf_dir):
    """Per listing the size of the one-hot vector of its kind and the slot set."""
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(f"{COLS.kind}_slots")
    at = F.array_position(arr, F.lit(1.0)).cast("int") - 1
    return _indexed(spark, sf_dir).select(
        COLS.key, F.size(arr).alias("n_slots"),
        F.aggregate(arr, F.lit(0.0), lambda a, v: a + v).alias("total"),
        F.when(at >= 0, at).alias("slot"))


_ASSEMBLED = [COLS.lat, COLS.lon, COLS.value, COLS.nights, COLS.reviews, COLS.reviews_per_month]


@register("m3_assemble_skipped", f"""
SELECT CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows,
  count(*) FILTER (WHERE {" OR ".join(f"{c} IS NULL" for c in _ASSEMBLED)}) AS n_skipped,
  CAST({len(_ASSEMBLED)} AS INTEGER) AS n_features
FROM typed GROUP BY split""")
def m3_assemble_skipped(spark, sf_dir):
    """Rows of each part that the assembler skips for a missing feature."""
    from pyspark.ml.functions import vector_to_array
    tagged = T.split(Q.cast_columns(L.raw(spark, sf_dir)), 0.8, COLS.key, SEED)
    assembler = M.feature_stages(tagged, categorical=[], numeric=_ASSEMBLED)[-1]
    kept = assembler.transform(tagged).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_kept"), F.max(F.size(vector_to_array("features"))).alias("n_features"))
    rows = tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(kept, "split", "left").select(
        "split", "n_rows", (F.col("n_rows") - F.coalesce("n_kept", F.lit(0))).alias("n_skipped"),
        "n_features")


@register("m4_m5_words", r"""
SELECT id, CAST(len(regexp_extract_all(lower(name), '[a-z0-9_]+')) AS INTEGER) AS n_words,
  CAST(len(regexp_extract_all(lower(name), '[a-z0-9_]+'))
       - len(regexp_extract_all(lower(name), '\bwith\b')) AS INTEGER) AS n_kept
FROM gold""")
def m4_m5_words(spark, sf_dir):
    """Words of a name, and those left after the stop words (of which only
    "with" occurs in listing names)."""
    g = L.gold(spark, sf_dir).select(COLS.key, COLS.name)
    tokens, stop = M.feature_stages(g, categorical=[], text=COLS.name, numeric=[])[:2]
    return stop.transform(tokens.transform(g)).select(
        COLS.key, F.size("tokens").alias("n_words"), F.size("kept_tokens").alias("n_kept"))


def _fixed_predictions(spark, sf_dir) -> DataFrame:
    """Gold keys and labels with a prediction both engines can compute."""
    return L.gold(spark, sf_dir).select(
        COLS.key, M.LABEL, (F.floor(F.col(M.LABEL) * 2) / F.lit(2.0)).alias("prediction"))


_FIXED_SQL = "SELECT id, price_log, floor(price_log * 2) / 2 AS prediction FROM gold"


@register("m11_metrics", f"""
SELECT round(1 - avg((price_log - prediction) * (price_log - prediction)) / var_pop(price_log), 6) AS r2,
  round(sqrt(avg((price_log - prediction) * (price_log - prediction))), 6) AS rmse,
  round(avg(abs(exp(price_log) - exp(prediction))), 4) AS mae_price, count(*) AS n
FROM ({_FIXED_SQL})""")
def m11_metrics(spark, sf_dir):
    m = M.metrics(_fixed_predictions(spark, sf_dir))
    return m.select(F.round("r2", 6).alias("r2"), F.round("rmse", 6).alias("rmse"),
                    F.round("mae_price", 4).alias("mae_price"), "n")


@register("m16_sampled_pairs", f"""
SELECT id, price_log, prediction, least(min(price_log) OVER (), min(prediction) OVER ()) AS axis_min,
  greatest(max(price_log) OVER (), max(prediction) OVER ()) AS axis_max
FROM ({_FIXED_SQL}) WHERE {T.key_hash_sql('id', SEED, 'prediction_pairs')} < {int(0.1 * T.SPACE)}""")
def m16_sampled_pairs(spark, sf_dir):
    return M.prediction_pairs(_fixed_predictions(spark, sf_dir), 0.1)


@register("s10_model_mismatches", f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_mismatches FROM gold WHERE NOT ({_IN_TRAIN})""")
def s10_model_mismatches(spark, sf_dir):
    """Rows on which the saved and reloaded pipeline predicts otherwise than
    the fitted one."""
    g = L.gold(spark, sf_dir).persist()
    train, test = T.train_test(g, 0.8, COLS.key, SEED)
    model = M.fit(train, M.feature_stages(g), M.estimator("lr", 1))
    path = scratch_path(spark, "model")
    M.save_model(model, path)
    own = model.transform(test).select(COLS.key, F.col("prediction").alias("own"))
    again = M.load_model(path).transform(test).select(COLS.key, "prediction")
    return own.join(again, COLS.key, "full").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("own").eqNullSafe(F.col("prediction"))).alias("n_mismatches"))


@register("m1_m3_m8_m11_linear_baseline")
def m1_m3_m8_m11_linear_baseline(spark, sf_dir):
    return M.compare_models(L.gold(spark, sf_dir), ["lr"], iteration=1)


@register("m9_random_forest_baseline")
def m9_random_forest_baseline(spark, sf_dir):
    return M.compare_models(L.gold(spark, sf_dir), ["rf"], iteration=1)


@register("m10_gradient_boosted_baseline")
def m10_gradient_boosted_baseline(spark, sf_dir):
    return M.compare_models(L.gold(spark, sf_dir), ["gbt"], iteration=1)


@register("m12_m13_compare_advanced_linear")
def m12_m13_compare_advanced_linear(spark, sf_dir):
    """Iteration 2 features (text TF-IDF, keyword flags, distances) with the
    linear model."""
    return M.compare_models(model_frame(L.gold(spark, sf_dir)), ["lr"], iteration=2,
                            text=COLS.name)


@register("m13_compare_grid")
def m13_compare_grid(spark, sf_dir):
    """Three models in both iterations, six rows; each iteration's stages are
    fitted once and its models run side by side."""
    g = L.gold(spark, sf_dir)
    return M.compare_grid({1: (g, None), 2: (model_frame(g), COLS.name)})


GRAM = [COLS.lat, COLS.nights, COLS.reviews, COLS.reviews_per_month, COLS.host_listings, COLS.availability]
_GRAM_TERMS = ["one", *GRAM, M.LABEL]


@register("m8_gram_sums", " UNION ALL ".join(
    f"SELECT '{x}' AS term_a, '{y}' AS term_b, round(sum({'1.0' if x == 'one' else f'CAST({x} AS DOUBLE)'} * "
    f"{'1.0' if y == 'one' else f'CAST({y} AS DOUBLE)'}), 2) AS total FROM gold"
    for i, x in enumerate(_GRAM_TERMS) for y in _GRAM_TERMS[i:]))
def m8_gram_sums(spark, sf_dir):
    """The sums of products from which the linear model follows."""
    sums = M.gram_sums(L.gold(spark, sf_dir), GRAM)
    cells = ", ".join(f"'{c.split('*')[0]}', '{c.split('*')[1]}', round(`{c}`, 2)" for c in sums.columns)
    return sums.selectExpr(f"stack({len(sums.columns)}, {cells}) AS (term_a, term_b, total)")


@register("m8_coefficients", f"""
SELECT CAST({len(GRAM) + 1} AS INTEGER) AS n_coefficients, CAST(0 AS INTEGER) AS n_apart""")
def m8_coefficients(spark, sf_dir):
    """Coefficients and intercept of the fitted linear model that differ by
    over 1e-6 from those of coordinate descent on the sums of products."""
    from pyspark.ml.feature import VectorAssembler
    g = L.gold(spark, sf_dir).select(*GRAM, M.LABEL)
    own, base = M.elastic_net(M.gram_sums(g, GRAM).first().asDict(), GRAM)
    model = M.estimator("lr", 1).setTol(1e-13).setMaxIter(1000).fit(
        VectorAssembler(inputCols=GRAM, outputCol="features", handleInvalid="skip").transform(g))
    apart = [abs(a - b) > 1e-6 for a, b in zip([*own, base], [*model.coefficients, model.intercept])]
    return spark.createDataFrame([(len(apart), int(sum(apart)))], "n_coefficients int, n_apart int")


_CODES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS label, CAST(row_number() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS code "
    f"FROM (SELECT DISTINCT {c} FROM gold WHERE {_IN_TRAIN} AND {c} IS NOT NULL)" for c in M.CATEGORICAL)


@register("m1_ordinal_codes", f"""
, codes AS ({_CODES_SQL}),
asked AS (SELECT id, CASE WHEN id % 17 = 3 THEN NULL WHEN id % 13 = 4 THEN 'never seen' ELSE room_type END AS room_type,
                 neighbourhood FROM gold)
SELECT a.id, coalesce(k.code, -1.0) AS room_type_code, coalesce(n.code, -1.0) AS neighbourhood_code FROM asked a
LEFT JOIN codes k ON k.column_name = 'room_type' AND k.label = a.room_type
LEFT JOIN codes n ON n.column_name = 'neighbourhood' AND n.label = a.neighbourhood""")
def m1_ordinal_codes(spark, sf_dir):
    """Ordinal codes fitted on the training part and applied to all rows, some
    with a kind that training never saw, or none."""
    g = L.gold(spark, sf_dir).select(COLS.key, *M.CATEGORICAL)
    train, _ = T.train_test(g, 0.8, COLS.key, SEED)
    k = F.col(COLS.key)
    asked = g.withColumn(COLS.kind, F.when(k % 17 == 3, F.lit(None)).when(k % 13 == 4, F.lit("never seen"))
                         .otherwise(F.col(COLS.kind)))
    return M.apply_ordinal(asked, M.ordinal_codes(train, M.CATEGORICAL), M.CATEGORICAL).select(
        COLS.key, "room_type_code", "neighbourhood_code")


@register("m4_m7_text_features")
def m4_m7_text_features(spark, sf_dir):
    """Tokenise, drop stop words, hash to 100 slots and weight by IDF (fitted
    on the training split), then summarise each listing's vector."""
    g = L.gold(spark, sf_dir).select(COLS.key, COLS.name)
    train, _ = T.train_test(g, 0.8, COLS.key, SEED)
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    stages = M.feature_stages(g, categorical=[], text=COLS.name, numeric=[])[:-1]
    model = Pipeline(stages=stages).fit(train)
    out = model.transform(g)
    arr = vector_to_array("token_weights")
    return out.select(COLS.key, F.size("tokens").alias("n_words"),
                      F.size("kept_tokens").alias("n_kept"),
                      F.size(F.filter(arr, lambda v: v != 0)).alias("n_slots"),
                      F.round(F.aggregate(arr, F.lit(0.0), lambda a, v: a + v), 6)
                       .alias("tf_idf_sum"))


@register("m4_m7_document_tfidf")
def m4_m7_document_tfidf(spark, sf_dir):
    """The same text stages over every full document: tokens, stop words
    removed, 100 hashed slots weighted by IDF (fitted on a key-hash 80 %
    of the documents; the document-frequency vector has 100 entries)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    train, _ = T.train_test(docs, 0.8, "doc_id", SEED)
    stages = M.feature_stages(docs, categorical=[], text="text", numeric=[])[:-1]
    out = Pipeline(stages=stages).fit(train).transform(docs)
    arr = vector_to_array("token_weights")
    return out.select("doc_id", F.size("tokens").alias("n_words"),
                      F.size("kept_tokens").alias("n_kept"),
                      F.size(F.filter(arr, lambda v: v != 0)).alias("n_slots"),
                      F.round(F.aggregate(arr, F.lit(0.0), lambda a, v: a + v), 6)
                       .alias("tf_idf_sum"))


def _bundle(spark, sf_dir) -> B.Bundle:
    """The newest model bundle of a folder of tables; trained if there is none
    in the shared folder."""
    import hashlib
    root = f"{checkpoint_root(spark)}/bundles/{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    if not B.versions(spark, root):
        B.train(L.dash(spark, sf_dir), root)
    return B.load(spark, root)


@register("s10_model_bundle", f"""
SELECT 'group_medians' AS table_name, count(*) AS n_rows, CAST({2 + len(FEATS)} AS INTEGER) AS n_columns
FROM (SELECT DISTINCT neighbourhood, room_type FROM dash)
UNION ALL SELECT 'global_medians', CAST(1 AS BIGINT), CAST({len(FEATS)} AS INTEGER)
UNION ALL SELECT 'centroids', count(*), CAST(3 AS INTEGER) FROM (SELECT DISTINCT neighbourhood FROM dash)
UNION ALL SELECT 'codes', count(*), CAST(3 AS INTEGER)
FROM (SELECT DISTINCT 'k', room_type FROM dash WHERE {_IN_TRAIN}
      UNION ALL SELECT DISTINCT 'n', neighbourhood FROM dash WHERE {_IN_TRAIN})""")
def s10_model_bundle(spark, sf_dir):
    """The tables of a bundle that was trained, saved and loaded."""
    return B.contents(_bundle(spark, sf_dir))


@register("m15_j1_j2_batch_scoring")
def m15_j1_j2_batch_scoring(spark, sf_dir):
    """Requests scored from the saved bundle, with stay cost for 7 nights."""
    requests = _requests(spark, sf_dir).drop(COLS.zone).withColumn("nights", F.lit(7))
    return B.score(_bundle(spark, sf_dir), requests, nights="nights")


@register("t6_m14_top_importances")
def t6_m14_top_importances(spark, sf_dir):
    """The most important features of the bundle's model."""
    model = _bundle(spark, sf_dir).pipeline
    rows = B.with_distances(L.dash(spark, sf_dir))
    return M.top_importances(spark, model, model.transform(rows))


@register("m16_prediction_pairs")
def m16_prediction_pairs(spark, sf_dir):
    g = L.gold(spark, sf_dir).persist()
    train, test = T.train_test(g, 0.8, COLS.key, SEED)
    model = M.fit(train, M.feature_stages(g), M.estimator("lr", 1))
    return M.prediction_pairs(model.transform(test), 0.1)


@register("s10_model_roundtrip")
def s10_model_roundtrip(spark, sf_dir):
    """Save the whole fitted pipeline, load it back and score raw rows."""
    g = L.gold(spark, sf_dir).persist()
    train, test = T.train_test(g, 0.8, COLS.key, SEED)
    model = M.fit(train, M.feature_stages(g), M.estimator("lr", 1))
    path = scratch_path(spark, "model")
    M.save_model(model, path)
    return M.load_model(path).transform(test).select(COLS.key, M.LABEL, "prediction")


# --------------------------------------------------------------------------
# Sources and sinks (S1-S12): written to the shared checkpoint folder, read
# back, and compared with the in-memory result.
# --------------------------------------------------------------------------


def _landed(spark, sf_dir):
    """The raw binding written as CSV by Spark, then landed in Bronze."""
    src = scratch_path(spark, "source-csv")
    SR.write_raw_csv(L.raw(spark, sf_dir), src)
    return SR.land_raw(spark, src, scratch_path(spark, "bronze"))


@register("s1_s3_csv_to_silver", "SELECT * FROM silver")
def s1_s3_csv_to_silver(spark, sf_dir):
    landing = _landed(spark, sf_dir)
    return Q.clean(SR.read_raw_csv(spark, landing.path, recursive=True))


@register("s3_land_raw", "SELECT count(*) AS n_rows, 16 AS n_columns FROM typed")
def s3_land_raw(spark, sf_dir):
    landing = _landed(spark, sf_dir)
    return spark.createDataFrame([(landing.rows, landing.columns)], "n_rows long, n_columns int")


def _silver_written(spark, sf_dir) -> str:
    path = scratch_path(spark, "silver")
    SK.write_partitioned(L.silver(spark, sf_dir), path, COLS.zone)
    return path


@register("s2_s4_partitioned_roundtrip", "SELECT * FROM silver")
def s2_s4_partitioned_roundtrip(spark, sf_dir):
    path = _silver_written(spark, sf_dir)
    back = ST.read_table(spark, path, schema=Q.silver_schema(), partition_by=[COLS.zone])
    return back.select(*L.silver(spark, sf_dir).columns)


@register("s5_features_roundtrip", "SELECT * FROM gold")
def s5_features_roundtrip(spark, sf_dir):
    g = L.gold(spark, sf_dir)
    path = scratch_path(spark, "gold")
    SK.write_features(g, path, COLS.zone)
    back = ST.read_table(spark, path, schema=SK.written_schema(g, [COLS.zone]), partition_by=[COLS.zone])
    return back.select(*g.columns)


@register("s6_small_roundtrip", _A1_SQL)
def s6_small_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "kpis")
    SK.write_small(K.zone_kind_kpis(L.silver(spark, sf_dir), median_kind="disc"), path)
    return spark.read.parquet(path)


@register("s7_quality_report")
def s7_quality_report(spark, sf_dir):
    raw_df, silver_df = L.raw(spark, sf_dir), L.silver(spark, sf_dir)
    report = SK.quality_report(spark, P.retention(raw_df, silver_df),
                               P.null_profile(raw_df), P.null_profile(silver_df))
    path = scratch_path(spark, "quality-report")
    SK.write_quality_report(report, path)
    return spark.read.json(path).drop("generated_at")


_RETENTION_SQL = """
SELECT CAST((SELECT count(*) FROM typed) AS BIGINT) AS rows_in,
       CAST((SELECT count(*) FROM silver) AS BIGINT) AS rows_out,
       CAST((SELECT count(*) FROM typed) - (SELECT count(*) FROM silver) AS BIGINT) AS rows_removed,
       round((SELECT count(*) FROM silver) * 100.0 / (SELECT count(*) FROM typed), 2)
         AS retention_pct
"""


@register("s7_quality_report_summary", _RETENTION_SQL)
def s7_quality_report_summary(spark, sf_dir):
    """The run summary of the quality report, read back from its JSON."""
    return s7_quality_report(spark, sf_dir).select("rows_in", "rows_out", "rows_removed",
                                                   "retention_pct")


@register("s8_resolve_source", "SELECT * FROM silver")
def s8_resolve_source(spark, sf_dir):
    path = _silver_written(spark, sf_dir)
    df, _ = SR.resolve_source(spark, [("parquet", scratch_path(spark, "missing")),
                                      ("parquet", path)],
                              schema=Q.silver_schema(), partition_by=[COLS.zone])
    return df.select(*L.silver(spark, sf_dir).columns)


@register("s9_register_table", """
SELECT neighbourhood_group, count(*) AS n FROM silver GROUP BY neighbourhood_group""")
def s9_register_table(spark, sf_dir):
    path = _silver_written(spark, sf_dir)
    SK.register_table(spark, "lodgeframe_silver", path, schema=Q.silver_schema(), by=[COLS.zone])
    return spark.sql(f"SELECT {COLS.zone}, count(*) AS n FROM lodgeframe_silver "
                     f"GROUP BY {COLS.zone}")


@register("s11_project_known", f"""
SELECT {', '.join(c for c in dashboard_columns(COLS))} FROM gold""")
def s11_project_known(spark, sf_dir):
    return ST.project_known(L.gold(spark, sf_dir), dashboard_columns(COLS) + ["host_since"])


@register("s12_verify_table", """
SELECT CAST(neighbourhood_group AS VARCHAR) AS group_value, 0 AS is_total, count(*) AS n_rows,
  16 AS n_columns FROM silver GROUP BY neighbourhood_group
UNION ALL SELECT NULL, 1, count(*), 16 FROM silver""")
def s12_verify_table(spark, sf_dir):
    path = _silver_written(spark, sf_dir)
    return ST.verify_table(ST.read_table(spark, path, schema=Q.silver_schema(), partition_by=[COLS.zone]), COLS.zone)
