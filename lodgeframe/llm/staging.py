"""Intermediate tables in the shared checkpoint folder."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.session import scratch_path

#: Text bytes that one exchange partition is to stand for.
PARTITION_BYTES = 16 << 20


BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows sent to a worker at a time: whole texts, so fewer than Spark's default.
BATCH_ROWS = 2_400
#: Spark's setting to delete a query's shuffle files when the query has ended.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``stage``, and the folder written. The shuffle files behind the table
    go when it is written: what reads it later does not need them."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    own = {CLEANUP_CONF: "true", BATCH_CONF: str(min(BATCH_ROWS, int(spark.conf.get(BATCH_CONF))))}
    before = {CLEANUP_CONF: spark.conf.get(CLEANUP_CONF, "false"), BATCH_CONF: spark.conf.get(BATCH_CONF)}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends
    there, and a lost executor costs a re-read only."""
    return stage_at(df, label)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def partitions_for(df: DataFrame, text: str, per: int = PARTITION_BYTES) -> int:
    """Exchange partitions for a table of texts: one per ``per`` bytes, and at
    least the session's number."""
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total) // per))


def words(text: Column) -> Column:
    """Array of the words of a text, without Python; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
