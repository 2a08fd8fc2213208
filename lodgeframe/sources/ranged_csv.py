"""Quoted CSV with line breaks inside fields, read in many ranges of a file.

A line break ends a record only outside quotes, so a reader that starts in the
middle of a file must know whether it starts inside a quoted field. Lines are
read by Spark's text source, which splits files; a doubled quote counts twice,
so a line is inside a field exactly when an odd number of quotes came before.

Per range of a file the quotes are counted, and the sums of the ranges before
(two narrow windows, one row per range) give the parity at its start. Lines get
the number of the record they belong to: within a range by a running sum, and
across ranges by the numbers of records that start in the ranges before. The
lines of a record are put together and parsed by Spark's own CSV expression.
Most records are one line and skip that step.

Ordering: a range's lines lie in one partition in file order, so
``monotonically_increasing_id`` orders them. A task holds a range of
``spark.sql.files.maxPartitionBytes``, whatever the size of the file. A record
may cross any number of ranges.

Limits: quotes must be balanced as RFC 4180 has it (a stray quote inside an
unquoted field is no field quote and breaks the parity), line breaks are ``\\n``
or ``\\r\\n`` (the ``\\r`` before a record's end is dropped), compressed files are
one range. Lines without any character between records are skipped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUOTE = '"'


def file_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """file, range (its first byte), pos (order within the range), line, quotes."""
    reader = spark.read.option("lineSep", "\n")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    lines = reader.text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))).alias("quotes"))


def _before(by: list[str], order: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines with ``starts`` (a record begins here) and ``record``, the number
    of its record within the file, from 1."""
    ranges = lines.groupBy("file", "range").agg(F.sum("quotes").alias("own"))
    opened = ranges.select(F.col("file").alias("of_file"), F.col("range").alias("of_range"),
                           (F.coalesce(F.sum("own").over(_before(["file"], "range")), F.lit(0)) % 2).alias("open"))
    at = lines.join(opened, (F.col("file") == F.col("of_file")) & (F.col("range") == F.col("of_range")))
    inside = (F.col("open") + F.coalesce(F.sum("quotes").over(_before(["file", "range"], "pos")), F.lit(0))) % 2
    own = Window.partitionBy("file", "range").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = (at.withColumn("starts", inside == 0)
            .withColumn("within", F.sum(F.col("starts").cast("long")).over(own)))
    begun = told.groupBy("file", "range").agg(F.sum(F.col("starts").cast("long")).alias("begun"))
    base = begun.select(F.col("file").alias("of_file"), F.col("range").alias("of_range"),
                        F.coalesce(F.sum("begun").over(_before(["file"], "range")), F.lit(0)).alias("base"))
    return (told.drop("of_file", "of_range", "open")
            .join(base, (F.col("file") == F.col("of_file")) & (F.col("range") == F.col("of_range")))
            .select("file", "range", "pos", "line", "quotes", "starts", (F.col("base") + F.col("within")).alias("record")))


def records(lines: DataFrame) -> DataFrame:
    """file, record (its number in the file), text of each record."""
    told = numbered_lines(lines)
    # A line that starts a record and has balanced quotes is the whole record.
    whole = F.col("starts") & (F.col("quotes") % 2 == 0)
    single = told.filter(whole).select("file", "record", F.col("line").alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("range", "pos", "line")))
    several = (told.filter(~whole).groupBy("file", "record")
               .agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("text")))
    return (single.unionByName(several).withColumn("text", F.regexp_replace("text", r"\r$", ""))
            .filter(F.length("text") > 0))


def read_ranged_csv(spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True,
                    recursive: bool = False) -> DataFrame:
    """The records of ``path`` as rows of ``schema``; with ``header`` each
    file's first record is left out. Malformed records are read as far as they
    go, missing fields as null."""
    rows = records(file_lines(spark, path, recursive))
    if header:
        # The first that is not an empty line.
        first = rows.groupBy("file").agg(F.min("record").alias("top")).withColumnRenamed("file", "of_file")
        rows = (rows.join(first, F.col("file") == F.col("of_file")).filter(F.col("record") > F.col("top")))
    options = {"quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("text", ddl, options).alias("row")).select("row.*")
