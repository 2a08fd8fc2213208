"""Sinks: partitioned tables (S4, S5), small one-file outputs (S6), the
quality report (S7) and catalog registration (S9)."""
from __future__ import annotations

import logging
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lodgeframe.columns import COLS, MIN_NIGHTS_HI, MIN_NIGHTS_LO, PRICE_MIN, ListingColumns
from lodgeframe.operators.clean import listing_fills
from lodgeframe.sources.tables import EMPTY_PARTITION

log = logging.getLogger(__name__)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] | str, dynamic: bool = False,
                      max_records_per_file: int = 1_000_000, rebalance: bool = True) -> None:
    """Idempotent overwrite of a table partitioned by ``by``.

    ``dynamic=False`` (a full reload) replaces every partition; ``True``
    replaces only the partitions present in ``df``.

    With ``rebalance`` rows are dealt by ``by`` first, under adaptive
    execution: small partitions share a task and a large one is split over
    several (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so the
    number of files follows the size of the data and a zone with a third of
    the rows is no single task. Without it no shuffle is added and each task
    writes a file per zone it meets. Empty strings in ``by`` are written as
    ``EMPTY_PARTITION`` (``read_table`` restores them).
    """
    by = [by] if isinstance(by, str) else list(by)
    out = df.select(*[F.when(F.col(c) == "", F.lit(EMPTY_PARTITION)).otherwise(F.col(c)).alias(c)
                      if c in by and isinstance(df.schema[c].dataType, StringType) else F.col(c) for c in df.columns])
    if rebalance:
        out = out.hint("rebalance", *[F.col(c) for c in by])
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*by)
        .parquet(path))


def written_schema(df: DataFrame, by: Sequence[str]) -> StructType:
    """The schema a table partitioned by ``by`` has when it is read back."""
    return StructType([f for f in df.schema.fields if f.name not in by] + [df.schema[c] for c in by])


def write_features(df: DataFrame, path: str, by: str) -> None:
    """The feature table uses the same layout as the cleaned table."""
    write_partitioned(df, path, by)


def write_small(df: DataFrame, path: str) -> None:
    """One-file output; only for results whose size is bounded (aggregates)."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def quality_report(spark: SparkSession, run: DataFrame, before: DataFrame,
                   after: DataFrame, cols: ListingColumns = COLS,
                   write_mode: str = "overwrite") -> DataFrame:
    """One-row report: run summary, the cleaning rules and the user, plus
    per-column metrics before and after.

    ``run`` is the one-row retention summary (Q3); ``before``/``after`` are
    null profiles (Q1) in long form. Column metrics are nested as arrays of
    structs, collected from profiles whose size is the column count.
    """
    def nested(profile: DataFrame):
        return profile.agg(F.sort_array(F.collect_list(F.struct(
            F.col("position"), F.col("column_name"), F.col("missing").alias("nulls"),
            F.col("missing_pct").alias("null_rate_pct"))))).scalar()

    fills = F.create_map(*[F.lit(str(x)) for pair in listing_fills(cols).items() for x in pair])
    rules = F.struct(F.lit(PRICE_MIN).alias("price_min"), F.lit(MIN_NIGHTS_LO).alias("minimum_nights_min"),
                     F.lit(MIN_NIGHTS_HI).alias("minimum_nights_max"), fills.alias("fills"),
                     F.lit(cols.zone).alias("partition_column"), F.lit("parquet").alias("format"),
                     F.lit(write_mode).alias("write_mode"))
    return run.select("*", nested(before).alias("columns_before"),
                      nested(after).alias("columns_after"), rules.alias("rules"),
                      F.current_user().alias("generated_by"),
                      F.current_timestamp().alias("generated_at"))


def write_quality_report(report: DataFrame, path: str) -> bool:
    """Overwrite the JSON report. A failed write is logged, not fatal."""
    try:
        report.coalesce(1).write.mode("overwrite").json(path)
        return True
    except (PySparkException, Py4JError) as exc:  # a failed write must not fail the load
        log.warning("quality report not written to %s: %s", path, exc)
        return False


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = True,
                   schema: StructType | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Catalog a Parquet folder and recover its partitions so SQL sees rows.
    With ``schema`` and ``by`` the table is declared column by column, so a
    partition called ``2019`` stays a string."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = "" if schema is None else "(" + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ")"
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if schema is not None and by else ""
    spark.sql(f"CREATE TABLE {name} {columns} USING PARQUET{parts} LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)
