"""S3: landing source files in Bronze, byte for byte.

Files are listed by Spark (paths and lengths; no content is read) and copied by
tasks, one file each, through a buffer of bounded size, so a file may be of any
length. A copy keeps its path below the source folder; two files of one name in
different folders stay apart. It appears under its name when it is whole, so a
repeated task replaces it by an equal one. The list of copies, with size and
SHA-256 of the bytes that went through, is written last: a landing without it
is not whole.

Spark has no sink for raw bytes; this is the one step of the library (outside
``llm``) that runs Python in tasks. Stores are opened as mounted folders or by
``pyarrow.fs``.
"""
from __future__ import annotations

import contextlib
import hashlib
import os
import sys
import uuid
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.sources import files as FS

# Tasks need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "relative_path string, bytes bigint, sha256 string"
BUFFER_BYTES = 8 << 20


@dataclass(frozen=True)
class Landing:
    path: str
    files: int
    bytes: int
    rows: int
    columns: int


def _system(uri: str):
    """(None, path) of a mounted file, else its file system and path there."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return None, uri.removeprefix("file://").removeprefix("file:")
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def copy_file(src: str, dst: str, buffer_bytes: int = BUFFER_BYTES) -> tuple[int, str]:
    """Copy one file; its size and checksum."""
    (reads, src), (writes, dst) = _system(src), _system(dst)
    folder, name = dst.rsplit("/", 1)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    size, told = 0, hashlib.sha256()
    if writes is None:
        os.makedirs(folder, exist_ok=True)
    else:
        writes.create_dir(folder, recursive=True)
    with contextlib.ExitStack() as stack:
        source = stack.enter_context(open(src, "rb") if reads is None else reads.open_input_stream(src))
        target = stack.enter_context(open(part, "wb") if writes is None else writes.open_output_stream(part))
        while block := source.read(buffer_bytes):
            target.write(block)
            told.update(block)
            size += len(block)
    if writes is None:
        os.replace(part, dst)
    else:
        writes.move(part, dst)
    return size, told.hexdigest()


def source_files(spark: SparkSession, src: str) -> DataFrame:
    """path, length, relative_path of the files at ``src`` (a file, or a
    folder with all below it); hidden files are left out as in any read."""
    root = FS.qualified(spark, src).rstrip("/")
    if FS.is_file(spark, src):
        root = root.rsplit("/", 1)[0]
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(src) from exc
        raise
    found = listed.select("path", "length")
    # Scans leave empty files out; the driver's listing, which any read makes, has them.
    seen = found.withColumnRenamed("path", "seen").select("seen")
    every = [FS.qualified(spark, unquote(p)) for p in listed.inputFiles()]
    if len(every) > found.count():
        none = (spark.createDataFrame([(p,) for p in every], "path string")
                .join(seen, F.col("path") == F.col("seen"), "left_anti"))
        found = found.unionByName(none.select("path", F.lit(0).cast("bigint").alias("length")))
    return found.select("path", "length", F.substring(F.col("path"), len(root) + 2, 1 << 20).alias("relative_path"))


def copy_all(spark: SparkSession, src: str, dst: str, buffer_bytes: int = BUFFER_BYTES) -> DataFrame:
    """Copy the files at ``src`` below ``dst`` and write the list of copies;
    that list, read back. What was at ``dst`` before goes."""
    found = source_files(spark, src)
    if FS.qualified(spark, src).startswith(FS.qualified(spark, dst)):
        raise ValueError("a source cannot be landed over itself")
    FS.delete(spark, dst)
    target = FS.qualified(spark, dst).rstrip("/")

    def run(batches):
        for batch in batches:
            rows = []
            for path, relative, length in zip(*(c.to_pylist() for c in batch.columns)):
                size, told = copy_file(path, f"{target}/{relative}", buffer_bytes)
                if size != length:
                    raise OSError(f"{path} changed while it was copied: {size} bytes, listed with {length}")
                rows.append((relative, size, told))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["relative_path", "bytes", "sha256"])

    tasks = max(1, min(found.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    copied = found.select("path", "relative_path", "length").repartition(tasks, "path").mapInArrow(run, MANIFEST_SCHEMA)
    copied.write.mode("overwrite").json(f"{dst}/{MANIFEST}")
    return manifest(spark, dst)


def manifest(spark: SparkSession, dst: str) -> DataFrame:
    """The list of a landing; an error if it was not finished."""
    if not FS.exists(spark, f"{dst}/{MANIFEST}/_SUCCESS"):
        raise FileNotFoundError(f"{dst} holds no finished landing")
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{dst}/{MANIFEST}")


def differences(spark: SparkSession, dst: str) -> DataFrame:
    """Files of a landing that are missing, new, or of another size than listed."""
    listed = manifest(spark, dst).select("relative_path", "bytes")
    there = source_files(spark, dst).select(F.col("relative_path").alias("found_path"), F.col("length").alias("found_bytes"))
    return (listed.join(there, F.col("relative_path") == F.col("found_path"), "full")
            .filter(~F.col("bytes").eqNullSafe(F.col("found_bytes")))
            .select(F.coalesce("relative_path", "found_path").alias("relative_path"), "bytes", "found_bytes"))
