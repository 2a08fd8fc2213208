"""Cleaning: casts (Q4), fills (Q5, Q10), row filters (Q6-Q8, Q11),
de-duplication (Q9) and the composed Silver step (Q12)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from lodgeframe.columns import (COLS, FILL_LAST_REVIEW, FILL_RATE, FILL_TEXT,
                                MIN_NIGHTS_HI, MIN_NIGHTS_LO, PRICE_CAP, PRICE_MIN,
                                ListingColumns)


def listing_types(cols: ListingColumns = COLS) -> dict[str, str]:
    """Target types of the raw listing columns. Keys are bigint (ids beyond
    2^31 must not null out and then collapse in de-duplication)."""
    return {
        cols.key: "bigint", cols.host: "bigint",
        cols.value: "int", cols.nights: "int", cols.reviews: "int",
        cols.host_listings: "int", cols.availability: "int",
        cols.lat: "double", cols.lon: "double", cols.reviews_per_month: "double",
    }


def cast_columns(df: DataFrame, types: Mapping[str, str] | None = None,
                 strict: bool = False, cols: ListingColumns = COLS) -> DataFrame:
    """One ``select`` casting the listed columns; others pass through.

    Default ``try_cast``: text that does not parse (``'abc'``, ``'1.5'`` as
    int, an int overflow) becomes null and is then handled by the fill and
    filter rules. ``strict=True`` keeps the raising ANSI cast.
    """
    types = dict(types or listing_types(cols))
    def conv(c: str) -> Column:
        if c not in types:
            return F.col(c)
        t = types[c]
        return (F.col(c).cast(t) if strict else F.col(c).try_cast(t)).alias(c)
    return df.select(*[conv(c) for c in df.columns])


def cast_losses(raw: DataFrame, types: Mapping[str, str] | None = None,
                cols: ListingColumns = COLS) -> DataFrame:
    """Per cast column: values present in the text but lost by ``try_cast``."""
    types = dict(types or listing_types(cols))
    aggs = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
            for c, t in types.items()]
    pairs = ", ".join(f"'{c}', `{c}`" for c in types)
    return raw.agg(*aggs).selectExpr(f"stack({len(types)}, {pairs}) AS (column_name, lost)")


def listing_fills(cols: ListingColumns = COLS) -> dict:
    return {cols.name: FILL_TEXT, cols.host_name: FILL_TEXT,
            cols.reviews_per_month: FILL_RATE, cols.last_review: FILL_LAST_REVIEW}


def fill_missing(df: DataFrame, values: Mapping[str, object] | None = None,
                 blank_as_missing: bool = False, cols: ListingColumns = COLS) -> DataFrame:
    """Meaning-preserving defaults; the row is kept.

    Fill values must match the column type (a string column is never filled
    with a number). ``blank_as_missing`` also fills strings that are blank
    after ``trim``.
    """
    values = dict(values or listing_fills(cols))
    dtypes = dict(df.dtypes)
    for c, v in values.items():
        is_text = dtypes[c] == "string"
        if is_text != isinstance(v, str):
            raise TypeError(f"fill value {v!r} does not match {c} ({dtypes[c]})")
    def filled(c: str) -> Column:
        if c not in values:
            return F.col(c)
        missing = F.col(c).isNull()
        if blank_as_missing and dtypes[c] == "string":
            missing = missing | (F.trim(F.col(c)) == "")
        return F.when(missing, F.lit(values[c])).otherwise(F.col(c)).alias(c)
    return df.select(*[filled(c) for c in df.columns])


def _not_nan(c: str, df: DataFrame) -> Column:
    if dict(df.dtypes)[c] in ("double", "float"):
        return ~F.isnan(F.col(c))
    return F.lit(True)


def min_rule(df: DataFrame, c: str, lo) -> Column:
    return F.col(c).isNotNull() & _not_nan(c, df) & (F.col(c) >= lo)


def between_rule(df: DataFrame, c: str, lo, hi) -> Column:
    return F.col(c).isNotNull() & _not_nan(c, df) & F.col(c).between(lo, hi)


def present_rule(df: DataFrame, columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull() & _not_nan(c, df)
    return cond


def filter_min(df: DataFrame, c: str, lo) -> DataFrame:
    """Keep rows with ``c`` present and >= ``lo`` (NaN fails)."""
    return df.filter(min_rule(df, c, lo))


def filter_between(df: DataFrame, c: str, lo, hi) -> DataFrame:
    """Keep rows with ``c`` present and in [lo, hi]."""
    return df.filter(between_rule(df, c, lo, hi))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows missing any of ``columns`` (null or NaN)."""
    return df.filter(present_rule(df, columns))


def cap_filter(df: DataFrame, c: str, lo_exclusive=0, hi=PRICE_CAP) -> DataFrame:
    """Keep lo < c <= hi."""
    return df.filter((F.col(c) > lo_exclusive) & (F.col(c) <= hi))


def failed_rule(df: DataFrame, cols: ListingColumns = COLS) -> Column:
    """The first quality rule a typed row fails, or null if it passes."""
    return (F.when(~min_rule(df, cols.value, PRICE_MIN), F.lit("price"))
            .when(~between_rule(df, cols.nights, MIN_NIGHTS_LO, MIN_NIGHTS_HI), F.lit("nights"))
            .when(~present_rule(df, [cols.lat, cols.lon]), F.lit("coordinates")))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row that is smallest by ``order`` then by every
    other column (a total order, so the survivor never depends on layout).

    Expressed as ``min(struct(...))`` per key: an aggregate, so each map task
    first reduces its own copies of a key before the shuffle. A key holding a
    third of all rows therefore sends one row per task, not a third of the
    table, to a single reducer (a ``row_number`` window would sort them all
    in one task).
    """
    keys = list(keys)
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = order + rest
    if not ranked:
        return df.dropDuplicates(keys)
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ranked)])
    out = df.groupBy(*keys).agg(F.min(packed).alias("_r"))
    return out.select(*[F.col(c) for c in keys],
                      *[F.col(f"_r._{i}").alias(c) for i, c in enumerate(ranked)]
                      ).select(*df.columns)


def fill_numeric(df: DataFrame, value: float = 0.0, exclude: Sequence[str] = ()) -> DataFrame:
    """Every numeric null to ``value``, except the excluded (label) columns."""
    targets = [f.name for f in df.schema.fields
               if isinstance(f.dataType, NumericType) and f.name not in exclude]
    return df.select(*[F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)).alias(c)
                       if c in targets else F.col(c) for c in df.columns])


def clean(raw: DataFrame, cols: ListingColumns = COLS, strict: bool = False) -> DataFrame:
    """Silver: cast, fill, then the filters in rule order, then de-duplicate."""
    return keep_rows(fill_missing(cast_columns(raw, strict=strict, cols=cols), cols=cols), cols)


def keep_rows(typed: DataFrame, cols: ListingColumns = COLS) -> DataFrame:
    """The rows of a cast and filled table that pass the rules, one per key."""
    return dedup(typed.filter(failed_rule(typed, cols).isNull()), [cols.key])


def silver_schema(cols: ListingColumns = COLS) -> StructType:
    """The schema of the cleaned table as written: the zone, its partition
    column, comes last and is a string whatever its values look like."""
    types = listing_types(cols)
    order = [c for c in cols.raw_order if c != cols.zone] + [cols.zone]
    return StructType.fromDDL(", ".join(f"`{c}` {types.get(c, 'string')}" for c in order))
