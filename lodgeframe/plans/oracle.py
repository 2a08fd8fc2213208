"""ANSI SQL twins of the queries, for the DuckDB oracle.

Every statement starts from the same CTEs: ``typed`` (the listing binding
of FIXTURES.md section 4), ``silver`` (cleaned), ``gold`` (features) and
``dash`` (the dashboard frame). The text is plain SQL over the driver's
pre-registered views.
"""
from __future__ import annotations

_NAMES = """CASE k % 8 WHEN 0 THEN 'Cozy studio' WHEN 1 THEN 'Spacious 2BR with view'
      WHEN 2 THEN 'Private 1 bedroom' WHEN 3 THEN 'Huge loft' WHEN 4 THEN 'Renovated 3 bdrm'
      WHEN 5 THEN 'Luxury 4br' WHEN 6 THEN 'Room near 5 brooklyn stops' ELSE 'Plain room' END"""

RAW_COLUMNS = ("id, name, host_id, host_name, neighbourhood_group, neighbourhood, latitude, "
               "longitude, room_type, price, minimum_nights, number_of_reviews, last_review, "
               "reviews_per_month, calculated_host_listings_count, availability_365")

BASE_CTES = f"""
rev AS (
  SELECT l_orderkey, count(*) AS n, max(l_shipdate) AS d FROM lineitem GROUP BY l_orderkey
),
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_totalprice, c.c_name,
         na.n_name, re.r_name, rev.n, rev.d,
         count(*) OVER (PARTITION BY o.o_custkey) AS hosted
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation na ON c.c_nationkey = na.n_nationkey
  JOIN region re ON na.n_regionkey = re.r_regionkey
  LEFT JOIN rev ON rev.l_orderkey = o.o_orderkey
),
one AS (
  SELECT
    k AS id,
    CASE WHEN k % 3000 = 5 THEN NULL WHEN k % 3500 = 21 THEN '   ' ELSE {_NAMES} END AS name,
    o_custkey AS host_id,
    CASE WHEN k % 2500 = 9 THEN NULL ELSE c_name END AS host_name,
    r_name AS neighbourhood_group,
    n_name AS neighbourhood,
    CASE WHEN k % 5000 = 17 THEN NULL
         ELSE CAST(405000 + (k * 7919) % 4000 AS DOUBLE) / 10000 END AS latitude,
    CAST(-742000 + (k * 104729) % 5000 AS DOUBLE) / 10000 AS longitude,
    CASE o_orderstatus WHEN 'F' THEN 'Entire home/apt' WHEN 'O' THEN 'Private room'
         ELSE 'Shared room' END AS room_type,
    CASE WHEN k % 6000 = 19 THEN NULL WHEN k % 1000 = 7 THEN 0 WHEN k % 4000 = 13 THEN -10
         ELSE CAST(floor(o_totalprice / 1000) AS INTEGER) END AS price,
    CASE WHEN k % 1500 = 11 THEN 400 WHEN k % 7000 = 23 THEN 0
         ELSE CAST(1 + k % 30 AS INTEGER) END AS minimum_nights,
    CAST(coalesce(n, 0) AS INTEGER) AS number_of_reviews,
    CAST(CAST(d AS DATE) AS VARCHAR) AS last_review,
    round(CAST(n AS DOUBLE) / 12, 2) AS reviews_per_month,
    CAST(hosted AS INTEGER) AS calculated_host_listings_count,
    CAST((k * 13) % 366 AS INTEGER) AS availability_365
  FROM base
),
typed AS (
  SELECT * FROM one UNION ALL SELECT * FROM one WHERE id % 500 = 0
),
filled AS (
  SELECT id, coalesce(name, 'Unknown') AS name, host_id,
         coalesce(host_name, 'Unknown') AS host_name, neighbourhood_group, neighbourhood,
         latitude, longitude, room_type, price, minimum_nights, number_of_reviews,
         coalesce(last_review, 'No review') AS last_review,
         coalesce(reviews_per_month, 0.0) AS reviews_per_month,
         calculated_host_listings_count, availability_365
  FROM typed
),
ruled AS (
  SELECT *, CASE
      WHEN NOT (price IS NOT NULL AND price >= 1) THEN 'price'
      WHEN NOT (minimum_nights IS NOT NULL AND minimum_nights BETWEEN 1 AND 365) THEN 'nights'
      WHEN NOT (latitude IS NOT NULL AND NOT isnan(latitude)
                AND longitude IS NOT NULL AND NOT isnan(longitude)) THEN 'coordinates'
    END AS rule
  FROM filled
),
silver AS (
  SELECT {RAW_COLUMNS} FROM ruled WHERE rule IS NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY {RAW_COLUMNS.replace('id, ', '', 1).replace(', ', ' NULLS FIRST, ')} NULLS FIRST) = 1
),
gold0 AS (
  SELECT *, round(ln(price + 1), 4) AS price_log,
         CAST(number_of_reviews > 0 AS INTEGER) AS has_reviews,
         round(1 - availability_365 / 365, 4) AS occupancy_rate,
         round(avg(price) OVER (PARTITION BY neighbourhood_group), 2) AS zone_avg_price,
         round(avg(price) OVER (PARTITION BY neighbourhood_group, room_type), 2)
           AS zone_type_avg_price
  FROM silver
),
gold AS (
  SELECT {RAW_COLUMNS}, price_log, has_reviews, occupancy_rate, zone_avg_price,
         round((price - zone_avg_price) / nullif(zone_avg_price, 0) * 100, 2) AS price_vs_zone_pct,
         zone_type_avg_price
  FROM gold0
),
dash AS (
  SELECT id, neighbourhood_group, neighbourhood, room_type, price, minimum_nights,
         number_of_reviews, reviews_per_month, calculated_host_listings_count,
         availability_365, occupancy_rate, zone_avg_price, price_vs_zone_pct,
         zone_type_avg_price, latitude, longitude,
         availability_365 > 180 AS long_availability,
         round(occupancy_rate * 100, 1) AS occupancy_pct
  FROM gold WHERE price > 0 AND price <= 2000
)"""


def with_ctes(select: str) -> str:
    """A full statement: the shared CTEs followed by ``select``. A ``select``
    starting with a comma adds its own CTEs after the shared ones."""
    body = select.strip()
    joiner = "" if body.startswith(",") else "\n"
    return f"WITH {BASE_CTES.strip()}{joiner}{body}"
