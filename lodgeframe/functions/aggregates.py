"""Aggregate expressions shared by the KPI, ranking and exploration queries.

Three medians exist and are named apart:

* ``median_approx``: ``percentile_approx`` (an element of the data; bounded
  memory per group whatever the number of distinct values);
* ``median_disc``: the exact discrete median (an element of the data);
* ``median_interp``: the exact interpolated median (pandas ``median``).

The exact ones keep a value -> count map per group, partially aggregated on
the map side: cheap for integer prices, heavy for many distinct doubles.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def median_approx(x) -> Column:
    return F.percentile_approx(_c(x), 0.5)


def median_disc(x) -> Column:
    return quantile_disc(x, 0.5)


def quantile_disc(x, q: float) -> Column:
    name = x if isinstance(x, str) else None
    if name is None:
        raise TypeError("quantile_disc needs a column name")
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY `{name}`)")


def median_interp(x) -> Column:
    return F.median(_c(x))


def quantiles_interp(x, qs) -> Column:
    """Exact interpolated quantiles as an array (pandas ``quantile``)."""
    return F.percentile(_c(x), F.array(*[F.lit(float(q)) for q in qs]))


MEDIANS = {"approx": median_approx, "disc": median_disc, "interp": median_interp}


def median(x, kind: str = "interp") -> Column:
    return MEDIANS[kind](x)
