"""Exact quantiles without a column's values in one task.

Values are counted per (group, column, value) first, with partial sums on the
map side, so a column of few distinct values is small from there on. The rows
wanted by their rank are then closed in on: a histogram over the value range
says, with sums over at most ``BUCKETS`` rows per group, which bucket holds a
rank and how many rows lie before it; the next histogram divides that bucket
only, between its own least and greatest value. The first histogram is spaced
by logarithm, the others evenly. What remains of a rank's bucket after
``LEVELS`` of them is sorted, and the value picked.

No step holds more of a group than ``BUCKETS`` sums or one bucket of the last
histogram, and the plan starts no job. Ranks of a group share the passes.
Infinite values and NaN (the greatest) have buckets of their own. Nulls do not
count; a group or column of nulls gives nulls.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096
LEVELS = 2


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def _bucket(x: Column, lo: Column, hi: Column, logarithmic: bool, buckets: int) -> Column:
    """The bucket of ``x`` between ``lo`` and ``hi``; never falls as x rises."""
    def place(v: Column) -> Column:
        # Halves, so that a difference of two large values stays finite.
        return F.signum(v) * F.log1p(F.abs(v)) if logarithmic else v * 0.5

    share = F.coalesce(F.try_divide(place(x) - place(lo), place(hi) - place(lo)), F.lit(0.0))
    return (F.when(lo.eqNullSafe(hi), 0).when(F.isnan(x), buckets + 1)
            .when(x == float("inf"), buckets).when(x == float("-inf"), -1)
            .otherwise(F.least(F.floor(share * buckets), F.lit(buckets - 1)))).cast("int")


def _within(counted: DataFrame, spans: DataFrame) -> DataFrame:
    """Counted values that lie in a span, with its ``lo``, ``hi``, ``base`` and ``ranks``."""
    x = F.col("x")
    inside = (x >= F.col("lo")) & (x <= F.col("hi"))
    return (counted.join(spans, (F.col("k") == F.col("span_k")) & ((F.col("whole") & x.isNotNull()) | inside))
            .drop("span_k", "whole"))


def _ranked(rows: DataFrame, by: str) -> DataFrame:
    """The rows (in the order of ``by`` within a span) that hold ranks, with
    these, and ``base``, the number of values before the row."""
    before = Window.partitionBy("k", "lo").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("base", F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0)))
    held = F.filter("ranks", lambda r: (r >= F.col("base")) & (r < F.col("base") + F.col("n")))
    return placed.withColumn("ranks", held).filter(F.size("ranks") > 0)


def _position(total: Column, q: float) -> Column:
    return (total - 1) * F.lit(float(q))


def exact_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float], by: Sequence[str] = (),
                    sets: Sequence[Sequence[str]] | None = None, levels: int = LEVELS,
                    buckets: int = BUCKETS) -> DataFrame:
    """One row per group and column: ``by``..., ``column_name``, ``n`` (values
    present) and ``q``, the interpolated quantiles ``qs`` as an array.

    ``sets`` lists subsets of ``by`` to group by instead of all of ``by``; the
    columns left out are null and ``set_number`` says which set a row is of.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.select(*by, F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, x)"))
    grouped = long.groupBy(*by, "column_name", "x").agg(F.count(F.lit(1)).alias("n"))
    key = [*by, "column_name"] if sets is None else [*by, "column_name", "set_number"]
    if sets is not None:
        each = F.array(*[F.struct(*[(F.col(c) if c in s else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in by],
                                  F.lit(i).alias("set_number")) for i, s in enumerate(sets)])
        grouped = (grouped.select(F.explode(each).alias("g"), "column_name", "x", "n")
                   .select("g.*", "column_name", "x", "n").groupBy(*key, "x").agg(F.sum("n").alias("n")))
    # Structs are equal where their nulls are, as group keys are.
    counted = grouped.select(F.struct(*key).alias("k"), "x", "n")
    x = F.col("x")
    totals = counted.groupBy("k").agg(
        F.coalesce(F.sum(F.when(x.isNotNull(), F.col("n"))), F.lit(0)).alias("total"),
        F.min(F.when(_finite(x), x)).alias("least"), F.max(F.when(_finite(x), x)).alias("most"))
    wanted = F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(_position(F.col("total"), q)), F.ceil(_position(F.col("total"), q))) for q in qs])))
    spans = totals.filter("total > 0").select(
        F.col("k").alias("span_k"), F.col("least").alias("lo"), F.col("most").alias("hi"),
        F.lit(0).cast("long").alias("base"), wanted.alias("ranks"), F.lit(True).alias("whole"))
    for level in range(levels):
        bucket = _bucket(x, F.col("lo"), F.col("hi"), level == 0, buckets)
        histogram = (_within(counted, spans).groupBy("k", "lo", "base", "ranks", bucket.alias("bucket"))
                     .agg(F.sum("n").alias("n"), F.min("x").alias("x_lo"), F.max("x").alias("x_hi")))
        spans = _ranked(histogram, "bucket").select(F.col("k").alias("span_k"), F.col("x_lo").alias("lo"),
                                                    F.col("x_hi").alias("hi"), "base", "ranks", F.lit(False).alias("whole"))
    picked = (_ranked(_within(counted, spans), "x").select("k", "x", F.explode("ranks").alias("rank"))
              .groupBy(F.col("k").alias("found_k"))
              # Two values per quantile at most.
              .agg(F.map_from_entries(F.collect_set(F.struct("rank", "x"))).alias("values")))

    def value(q: float) -> Column:
        at = _position(F.col("total"), q)
        low, high = F.floor(at), F.ceil(at)
        a, b = F.try_element_at("values", low), F.try_element_at("values", high)
        return F.when(a.eqNullSafe(b), a).otherwise((high - at) * a + (at - low) * b)

    return (totals.join(picked, F.col("k") == F.col("found_k"), "left")
            .select("k.*", F.col("total").alias("n"), F.array(*[value(q) for q in qs]).alias("q")))


def one_row(quantiles: DataFrame, columns: Sequence[str], by: Sequence[str] = (), at: int = 0) -> DataFrame:
    """``exact_quantiles`` with a column per column name, holding the
    quantile number ``at``: one row per group, or one row in all."""
    cells = [F.max(F.when(F.col("column_name") == c, F.col("q")[at])).alias(c) for c in columns]
    return quantiles.groupBy(*by).agg(*cells) if by else quantiles.agg(*cells)
