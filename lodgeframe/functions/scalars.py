"""Column expressions (F1-F18). Each returns a ``Column`` built only from
built-in functions, so it stays inside whole-stage code generation."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeframe.columns import BEDROOM_PATTERN, LONG_AVAILABILITY_DAYS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def price_log(value) -> Column:
    """``round(ln(value + 1), 4)``."""
    return F.round(F.log(_c(value) + F.lit(1)), 4)


def has_reviews(reviews) -> Column:
    """1 when there is at least one review, else 0."""
    return (_c(reviews) > 0).cast("int")


def occupancy_rate(availability, days: int = 365) -> Column:
    """``round(1 - availability / days, 4)``."""
    return F.round(F.lit(1) - _c(availability) / F.lit(days), 4)


def pct_vs(value, reference) -> Column:
    """``round((value - reference) / reference * 100, 2)``; null if the
    reference is 0 (no division error under ANSI)."""
    return F.round(F.try_divide(_c(value) - _c(reference), _c(reference)) * 100, 2)


def long_availability(availability, days: int = LONG_AVAILABILITY_DAYS) -> Column:
    """available more than ``days`` days a year."""
    return _c(availability) > days


def occupancy_pct(occupancy) -> Column:
    """F8: occupancy in percent, 1 dp."""
    return F.round(_c(occupancy) * 100, 1)


def keyword_flag(text, word: str) -> Column:
    """1.0 when the lower-cased text matches ``word`` (a regex), else 0.0."""
    return F.coalesce(F.regexp_like(F.lower(_c(text)), F.lit(word)), F.lit(False)).cast("double")


def keyword_flags(text, words: Sequence[str], prefix: str = "has_") -> list[Column]:
    return [keyword_flag(text, w).alias(f"{prefix}{w}") for w in words]


def extract_count(text, studio_flag=None, pattern: str = BEDROOM_PATTERN,
                  word_boundary: bool = False) -> Column:
    """the integer before a bedroom word, 0 when absent, forced to 0 for
    studios; a double. By default it matches inside words too ("5 brooklyn"
    gives 5), as the reference pattern has no word boundary;
    ``word_boundary=True`` requires the bedroom word to end there."""
    low = F.lower(_c(text))
    digits = F.regexp_extract(low, pattern + (r"\b" if word_boundary else ""), 1)
    count = F.coalesce(F.nullif(digits, F.lit("")).cast("double"), F.lit(0.0))
    studio = F.lit(False) if studio_flag is None else F.coalesce(_c(studio_flag) == 1.0, F.lit(False))
    return F.when(studio, 0.0).when(low.isNotNull(), count)


def planar_distance(lat, lon, point_lat: float, point_lon: float) -> Column:
    """Euclidean distance in degrees to a fixed point. Squares are
    products, not ``pow``: IEEE multiplication and square root round the
    same way in every engine, library ``pow`` functions may not."""
    dy = _c(lat) - F.lit(point_lat)
    dx = _c(lon) - F.lit(point_lon)
    return F.sqrt(dy * dy + dx * dx)


def name_length(text) -> Column:
    """number of characters."""
    return F.length(_c(text))


def log_label(value) -> Column:
    """``ln(value)`` without the +1 of F1; null for value <= 0."""
    return F.when(_c(value) > 0, F.log(_c(value)))


def map_labels(code, mapping: Mapping[str, str]) -> Column:
    """code -> display label; an unknown code keeps its own value."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(code)), _c(code))


def price_interval(log_prediction, mae: float, plus_one: bool = False) -> list[Column]:
    """F16: point estimate back in price units, with a +-MAE interval
    (low floored at 0). ``plus_one`` inverts F1's ``ln(x + 1)`` label."""
    p = F.expm1(_c(log_prediction)) if plus_one else F.exp(_c(log_prediction))
    return [p.alias("estimate"),
            F.greatest(F.lit(0.0), p - F.lit(mae)).alias("estimate_low"),
            (p + F.lit(mae)).alias("estimate_high")]


def stay_cost(nightly, nights) -> Column:
    """nightly amount times the number of nights."""
    return _c(nightly) * _c(nights)
