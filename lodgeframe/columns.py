"""Column roles and the fixed values the listing operators rely on.

Operators never hard-code a column name: they read it from a
``ListingColumns`` instance, so the same code serves any listing-shaped
table (zone / subzone / kind / value).
"""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ListingColumns:
    key: str = "id"
    name: str = "name"
    host: str = "host_id"
    host_name: str = "host_name"
    zone: str = "neighbourhood_group"
    subzone: str = "neighbourhood"
    lat: str = "latitude"
    lon: str = "longitude"
    kind: str = "room_type"
    value: str = "price"
    nights: str = "minimum_nights"
    reviews: str = "number_of_reviews"
    last_review: str = "last_review"
    reviews_per_month: str = "reviews_per_month"
    host_listings: str = "calculated_host_listings_count"
    availability: str = "availability_365"
    occupancy: str = "occupancy_rate"

    @property
    def raw_order(self) -> list[str]:
        """The 16 raw columns in source order."""
        return [self.key, self.name, self.host, self.host_name, self.zone,
                self.subzone, self.lat, self.lon, self.kind, self.value,
                self.nights, self.reviews, self.last_review,
                self.reviews_per_month, self.host_listings, self.availability]


COLS = ListingColumns()

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for equal results.
# ---------------------------------------------------------------------------
PRICE_MIN = 1                 # price must be >= 1
MIN_NIGHTS_LO = 1             # minimum nights within [1, 365]
MIN_NIGHTS_HI = 365
FILL_TEXT = "Unknown"         # name, host_name
FILL_LAST_REVIEW = "No review"
FILL_RATE = 0.0               # reviews_per_month
MODEL_TEXT_FILL = "unknown"   # text default before modelling
LONG_AVAILABILITY_DAYS = 180  # "available a long time" threshold
PRICE_CAP = 2000              # dashboard keeps 0 < price <= 2000
MIN_GROUP_ROWS = 30           # sub-zones need at least 30 listings
SCORE_WEIGHTS = (0.5, 0.3, 0.2)  # price (inverted), availability, reviews
HIST_BINS = 40
HIST_MAX = 500
MAP_SAMPLE_ROWS = 6000
COLOR_QUANTILES = (0.02, 0.95)
BOUNDS_QUANTILE = 0.99
LEAKAGE_THRESHOLD = 0.9
TOP_IMPORTANCES = 15
# Reference points (degrees): city centre and the airport.
LAT_CENTER, LON_CENTER = 40.7580, -73.9855
LAT_JFK, LON_JFK = 40.6413, -73.7781
# Keyword flags taken from the listing name.
SHAPE_WORDS = ["studio", "loft"]
PREMIUM_WORDS = ["luxury", "spacious", "view", "private", "renovated", "huge"]
# Integer followed by a bedroom word.
BEDROOM_PATTERN = r"(\d+)\s*(?:br|bdrm|bedroom|bed|bdr)"
# Display labels of the room kinds.
KIND_LABELS = {
    "Entire home/apt": "Logement entier",
    "Private room": "Chambre privée",
    "Shared room": "Chambre partagée",
}
# Quality rules, in the order they are applied.
RULES = ["price", "nights", "coordinates", "duplicates"]
