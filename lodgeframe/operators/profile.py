"""Profiling: missing values per column (Q1), the per-rule cleaning audit
(Q2) and retention (Q3). Each is a single aggregation pass."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from lodgeframe.columns import COLS, ListingColumns, RULES
from lodgeframe.operators.clean import failed_rule


def _is_missing(df: DataFrame, c: str, treat_nan_as_missing: bool) -> Column:
    """Null, or blank after ``trim`` (trim strips spaces only, not tabs)."""
    dtype = df.schema[c].dataType
    missing = F.col(c).isNull()
    if isinstance(dtype, StringType):
        missing = missing | (F.trim(F.col(c)) == "")
    elif treat_nan_as_missing and isinstance(dtype, (DoubleType, FloatType)):
        missing = missing | F.isnan(F.col(c))
    return F.coalesce(missing, F.lit(False))


def missing_metrics(df: DataFrame, columns: Sequence[str] | None = None,
                    treat_nan_as_missing: bool = False) -> list[Column]:
    """The aggregate expressions of a null profile: the row count
    (``total``) and one missing count per column (``m0``, ``m1``, ...).
    Usable in ``agg`` or, to profile a table while it is being written,
    in ``observe``."""
    columns = list(columns or df.columns)
    return [F.count(F.lit(1)).alias("total")] + [
        F.sum(_is_missing(df, c, treat_nan_as_missing).cast("long")).alias(f"m{i}")
        for i, c in enumerate(columns)]


def _stack_profile(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"{i}, '{c.replace(chr(39), chr(39) * 2)}', m{i}"
                      for i, c in enumerate(columns))
    long = wide.selectExpr("total", f"stack({len(columns)}, {pairs}) AS (position, column_name, missing)")
    return (long.filter(F.col("total") > 0)
            .select(F.col("column_name"), F.col("position").cast("int").alias("position"),
                    F.coalesce(F.col("missing"), F.lit(0)).cast("long").alias("missing"),
                    F.round(F.coalesce(F.col("missing"), F.lit(0)) / F.col("total") * 100, 2)
                     .alias("missing_pct"),
                    F.col("total").cast("long").alias("total")))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None,
                 treat_nan_as_missing: bool = False) -> DataFrame:
    """(column_name, position, missing, missing_pct, total) for every column.

    One aggregation computes the row count and every missing count; the
    one-row result is unpivoted with ``stack``. An empty input gives 0 rows.
    """
    columns = list(columns or df.columns)
    return _stack_profile(df.agg(*missing_metrics(df, columns, treat_nan_as_missing)), columns)


def profile_from_metrics(spark, metrics: dict, columns: Sequence[str]) -> DataFrame:
    """The same profile from observed ``missing_metrics`` values (one row of
    numbers, one per column)."""
    columns = list(columns)
    names = ["total"] + [f"m{i}" for i in range(len(columns))]
    schema = ", ".join(f"{n} long" for n in names)
    wide = spark.createDataFrame([tuple(int(metrics.get(n) or 0) for n in names)], schema)
    return _stack_profile(wide, columns)


def clean_audit(df: DataFrame, cols: ListingColumns = COLS,
                deduplicated: DataFrame | int | None = None) -> DataFrame:
    """Rows removed by each rule, in rule order, plus the rows remaining.

    Each typed row is labelled with the first rule it fails (a ``when``
    chain). Duplicates are the rows passing every filter minus the distinct
    keys among them. All counts come from one aggregation. When the
    de-duplicated table already exists (say, the written Silver table),
    pass it (or its row count) as ``deduplicated``: that count replaces the
    distinct count, which saves a shuffle of every key.
    """
    rule = failed_rule(df, cols)
    aggs = rule_metrics(df, cols)
    if deduplicated is None:
        aggs.append(F.count_distinct(F.when(rule.isNull(), F.col(cols.key))).alias("remaining"))
        agg = df.agg(*aggs)
    elif isinstance(deduplicated, int):
        agg = df.agg(*aggs).select("*", F.lit(deduplicated).cast("long").alias("remaining"))
    else:
        remaining = deduplicated.agg(F.count(F.lit(1))).scalar()
        agg = df.agg(*aggs).select("*", remaining.alias("remaining"))
    return _stack_audit(agg)


def rule_metrics(df: DataFrame, cols: ListingColumns = COLS) -> list[Column]:
    """The counts behind the audit: rows by the first rule they fail, and
    those that pass all. Usable in ``agg`` or, during a write, in ``observe``."""
    rule = failed_rule(df, cols)
    return ([F.count_if(rule == r).alias(r) for r in RULES if r != "duplicates"]
            + [F.count_if(rule.isNull()).alias("_passed")])


def _stack_audit(counts: DataFrame) -> DataFrame:
    wide = counts.withColumn("duplicates", F.col("_passed") - F.col("remaining"))
    names = RULES + ["remaining"]
    pairs = ", ".join(f"{i + 1}, '{r}', `{r}`" for i, r in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (step, rule, removed)").select(
        F.col("step").cast("int"), "rule", F.col("removed").cast("long"))


def audit_from_metrics(spark, metrics: dict, remaining: int) -> DataFrame:
    """The audit from observed ``rule_metrics`` and the rows that remained."""
    names = [r for r in RULES if r != "duplicates"] + ["_passed"]
    schema = ", ".join(f"`{n}` long" for n in [*names, "remaining"])
    return _stack_audit(spark.createDataFrame(
        [tuple(int(metrics.get(n) or 0) for n in names) + (int(remaining),)], schema))


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """rows_in, rows_out, rows_removed, retention_pct (2 dp; null for no input).

    The two counts are scalar subqueries, so no join is planned.
    """
    counts = before.sparkSession.range(1).select(
        before.agg(F.count(F.lit(1))).scalar().cast("long").alias("n_in"),
        after.agg(F.count(F.lit(1))).scalar().cast("long").alias("n_out"))
    return counts.select(
        F.col("n_in").alias("rows_in"), F.col("n_out").alias("rows_out"),
        (F.col("n_in") - F.col("n_out")).alias("rows_removed"),
        F.round(F.try_divide(F.col("n_out") * 100.0, F.col("n_in")), 2).alias("retention_pct"))


def retention_from_counts(spark, rows_in: int, rows_out: int) -> DataFrame:
    """``retention`` from counts already known (e.g. observed during writes)."""
    one = spark.createDataFrame([(int(rows_in), int(rows_out))], "n_in long, n_out long")
    return one.select(
        F.col("n_in").alias("rows_in"), F.col("n_out").alias("rows_out"),
        (F.col("n_in") - F.col("n_out")).alias("rows_removed"),
        F.round(F.try_divide(F.col("n_out") * 100.0, F.col("n_in")), 2).alias("retention_pct"))
