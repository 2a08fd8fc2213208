"""Columnar reads (S2), known-column projection (S11) and load checks."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


#: What a partition folder of an empty string is called: by itself Spark writes
#: "" into the folder of nulls, and it comes back as one.
EMPTY_PARTITION = "__EMPTY__"


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               schema: StructType | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Parquet read with partition discovery.

    Passing ``schema`` pins the types of partition columns too (a zone
    called ``2019`` would otherwise come back as an int); the string columns
    of ``partition_by`` get their empty strings back that
    ``write_partitioned`` wrote as ``EMPTY_PARTITION``.
    Selecting ``columns`` here lets the scan read only those columns.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    texts = [c for c in partition_by if isinstance(df.schema[c].dataType, StringType)]
    if texts:
        df = df.select(*[F.when(F.col(c) != EMPTY_PARTITION, F.col(c)).when(F.col(c).isNotNull(), F.lit("")).alias(c)
                         if c in texts else F.col(c) for c in df.columns])
    if columns is not None:
        df = df.select(*columns)
    return df


def project_known(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def verify_table(df: DataFrame, by: str) -> DataFrame:
    """Per-group row counts plus the table's total and column count, in one
    aggregation: a rollup, whose grand-total row has ``is_total = 1``."""
    n_cols = len(df.columns)
    return (df.rollup(by).agg(F.count(F.lit(1)).alias("n_rows"),
                              F.grouping(by).cast("int").alias("is_total"))
            .select(F.col(by).cast("string").alias("group_value"), "is_total",
                    "n_rows", F.lit(n_cols).alias("n_columns")))


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as a DataFrame of (position, column, type)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, type string")
