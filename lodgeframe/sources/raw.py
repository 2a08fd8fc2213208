"""Raw (Bronze) edge: CSV reads (S1), landing a source file (S3) and
choosing the first available source (S8)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodgeframe.columns import COLS, ListingColumns
from lodgeframe.sources.landing import Landing, copy_all
from lodgeframe.sources.ranged_csv import read_ranged_csv
from lodgeframe.sources.tables import read_table


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_raw_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                 cols: ListingColumns = COLS, recursive: bool = False, whole_files: bool = False) -> DataFrame:
    """Header CSV with quoted multi-line fields; every column a string.

    ``"`` is both quote and escape, so a doubled quote inside a quoted field
    is one literal quote. The schema is fixed (never inferred). Files are read
    in ranges (``ranged_csv``), so a large file is work for many tasks;
    ``whole_files`` reads each by one task with Spark's multi-line reader.
    ``recursive`` reads every file below ``path`` (as ``land_raw`` lays them out).
    """
    schema = schema or string_schema(cols.raw_order)
    if not whole_files:
        return read_ranged_csv(spark, path, schema, recursive=recursive)
    reader = (spark.read
              .schema(schema)
              .option("header", "true")
              .option("multiLine", "true")
              .option("quote", '"')
              .option("escape", '"')
              .option("mode", "PERMISSIVE"))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.csv(path)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write a Bronze table as header CSV readable by ``read_raw_csv``."""
    (df.write.mode("overwrite")
       .option("header", "true").option("quote", '"').option("escape", '"')
       # The writer trims by default, which would turn a blank name into null.
       .option("ignoreLeadingWhiteSpace", "false")
       .option("ignoreTrailingWhiteSpace", "false")
       .csv(path))


def land_raw(spark: SparkSession, src: str, dst: str, cols: ListingColumns = COLS) -> Landing:
    """S3: land raw CSV files in Bronze, byte for byte (``landing``), and
    report their shape. Rows are counted in one parse of the landed copy. A
    missing source raises ``FileNotFoundError``."""
    total = copy_all(spark, src, dst).agg(F.count(F.lit(1)), F.sum("bytes")).first()
    parsed = read_raw_csv(spark, dst, cols=cols, recursive=True)
    return Landing(dst, total[0], total[1] or 0, parsed.count(), len(parsed.columns))


def resolve_source(spark: SparkSession, candidates: Sequence[tuple[str, str]], cols: ListingColumns = COLS,
                   schema: StructType | None = None, partition_by: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """Return the first readable source and a label saying which one won.

    ``candidates`` are ``(format, path)`` pairs tried in order, format being
    ``parquet`` or ``csv``. Only a missing path moves on to the next one;
    any other error is raised. ``schema`` and ``partition_by`` describe a
    Parquet table, whose partition values are else guessed from folder names.
    """
    for fmt, path in candidates:
        if not path:
            continue
        try:
            if fmt == "parquet":
                df = read_table(spark, path, schema=schema, partition_by=partition_by)
            else:
                df = read_raw_csv(spark, path, cols=cols)
                df.schema  # noqa: B018 - forces path resolution
            return df, f"{fmt}:{path}"
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                continue
            raise
    raise FileNotFoundError("no source found among: "
                            + ", ".join(f"{f}:{p}" for f, p in candidates if p))
