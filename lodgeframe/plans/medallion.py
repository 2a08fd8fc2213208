"""The two batch jobs: raw -> silver (with profile, audit and quality
report) and silver -> features (the feature table and the zone x kind KPI
table).

The raw -> silver job reads the source once and its own staged copy once. The
source is cast and filled and written as Parquet to the shared checkpoint
folder; the raw missing-value profile and the rows that each rule rejects are
observed during that write. Silver is then written from the staged copy, with
its own profile and row count observed, and the staged copy is deleted.
Observed metrics are gathered in each write's final stage, where Spark applies
every task's update exactly once, even when a task is retried (an observation
before a shuffle would not be). A lost executor re-reads its split of the
staged copy, not the source.

Partitioned tables are read with their schema, so zones called "2019" or ""
stay what they are from raw to KPIs.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from lodgeframe.columns import COLS, ListingColumns
from lodgeframe.operators import clean as Q
from lodgeframe.operators import kpis as K
from lodgeframe.operators import profile as P
from lodgeframe.operators.enrich import gold_features
from lodgeframe.session import scratch_path
from lodgeframe.sources import files as FS
from lodgeframe.sources import sinks as SK
from lodgeframe.sources import tables as ST


@dataclass
class SilverRun:
    silver_path: str
    audit: DataFrame
    profile_before: DataFrame
    profile_after: DataFrame
    report: DataFrame


def raw_to_silver(spark: SparkSession, raw: DataFrame, silver_path: str,
                  report_path: str | None = None, cols: ListingColumns = COLS) -> SilverRun:
    """Clean ``raw`` (all-string listing rows) into a zone-partitioned
    Silver table, with the per-rule audit and a before/after quality report."""
    raw_columns = raw.columns
    staged_path = scratch_path(spark, "typed-staged")
    seen_raw, seen_rules = Observation("raw_profile"), Observation("rules")
    typed = Q.fill_missing(Q.cast_columns(raw.observe(seen_raw, *P.missing_metrics(raw)), cols=cols), cols=cols)
    typed.observe(seen_rules, *P.rule_metrics(typed, cols)).write.mode("overwrite").parquet(staged_path)

    cleaned = Q.keep_rows(spark.read.schema(typed.schema).parquet(staged_path), cols)
    seen_silver = Observation("silver_profile")
    SK.write_partitioned(cleaned.observe(seen_silver, *P.missing_metrics(cleaned)),
                         silver_path, cols.zone, rebalance=False)
    FS.delete(spark, staged_path)
    before = P.profile_from_metrics(spark, seen_raw.get, raw_columns)
    after = P.profile_from_metrics(spark, seen_silver.get, cleaned.columns)
    n_in, n_out = int(seen_raw.get["total"]), int(seen_silver.get["total"])
    audit = P.audit_from_metrics(spark, seen_rules.get, n_out)
    run = P.retention_from_counts(spark, n_in, n_out)
    report = SK.quality_report(spark, run, before, after)
    if report_path:
        SK.write_quality_report(report, report_path)
    return SilverRun(silver_path, audit, before, after, report)


def silver_to_features(spark: SparkSession, silver_path: str, gold_path: str,
                   kpi_path: str, cols: ListingColumns = COLS) -> tuple[DataFrame, DataFrame]:
    """Feature table (partitioned like Silver) and the small KPI table."""
    silver = ST.read_table(spark, silver_path, schema=Q.silver_schema(cols), partition_by=[cols.zone])
    features = gold_features(silver, cols)
    SK.write_features(features, gold_path, cols.zone)
    SK.write_small(K.zone_kind_kpis(silver, cols), kpi_path)
    gold = ST.read_table(spark, gold_path, schema=SK.written_schema(features, [cols.zone]), partition_by=[cols.zone])
    return gold, spark.read.parquet(kpi_path)
