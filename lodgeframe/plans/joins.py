"""Joins against derived lookup tables (group averages, medians, centroids).

A lookup over categories has a row per group and goes to every executor: an
ordinary join would deal the rows out by the group first, before the lookup is
measured, and all rows of a zone would end in one task. With ``few=False`` (as
many groups as the rows call for) the join is an ordinary one. Neither starts
a job while the plan is built.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[str] | str,
                  how: str = "left", few: bool = True) -> DataFrame:
    """Join ``lookup`` on ``on`` with null-safe key equality (a null group
    key matches its own aggregate, as a window partition would). ``few``: the
    lookup's groups are few next to the rows, so the rows stay where they are."""
    on = [on] if isinstance(on, str) else list(on)
    right = lookup.select(*[F.col(c).alias(f"_lk_{c}") if c in on else F.col(c)
                            for c in lookup.columns])
    cond = None
    for c in on:
        term = df[c].eqNullSafe(right[f"_lk_{c}"])
        cond = term if cond is None else cond & term
    return df.join(F.broadcast(right) if few else right, cond, how).drop(*[f"_lk_{c}" for c in on])
