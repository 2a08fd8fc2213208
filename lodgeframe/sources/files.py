"""Files and folders of any store that Spark reaches, by its own file systems."""
from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark reports file paths."""
    place, system = _place(spark, path)
    return system.makeQualified(place).toString()


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def is_file(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place) and system.getFileStatus(place).isFile()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    place, system = _place(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)
