"""Token ids of documents in files of byte-aligned codes.

Ids are ranked by their frequency in the whole corpus, so frequent ids are
small numbers. A rank takes one to four bytes; the lengths stand apart, two
bits each, four to a control byte. A reader looks the four lengths of a control
byte up in a table, adds them up to places, and reads all values of a block at
once with numpy.

A folder holds ``ids_by_rank.npy`` and files named by their place in the order
of documents. A file is a row of blocks and a table of documents::

    block    n_values u32, data_bytes u32, control bytes, data bytes
    table    per document: id i64, known u8, number of ids i64
    trailer  n_documents u64, n_blocks u64, mark (8 bytes)

A document's ids may cross blocks but not files. All numbers are little-endian.

Shape of the job: texts are tokenised once and staged as compressed ids; ids
are counted per task (a row per id of the vocabulary) and summed. Rows are then
dealt by ranges of (id, length, checksum, number), so rows that share an id,
null included, spread over many tasks; each task writes the files of its range
under names that follow from its place, whole or not at all, so that a
repeated task replaces a file by an equal one. The number of ids before a file
comes from sums over the list of files, a file being some ten megabytes.

Edge cases: a null or empty text is the end id alone; documents without an id
come after all others; documents of one id come by length, then checksum; an
empty table gives no file and an empty result. Extra columns are ignored.
"""
from __future__ import annotations

import contextlib
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.llm.packing import ENCODE_BYTES, TextEncoder, vocabulary_path
from lodgeframe.llm.shared_arrays import _local, load, save
from lodgeframe.llm.staging import discard, stage, stage_at
from lodgeframe.llm.words import chunks
from lodgeframe.session import scratch_path

END = 2
BLOCK_VALUES = 1 << 16
FILE_VALUES = 1 << 23
TASK_VALUES = 1 << 23
MARK = b"LFTOKEN1"
SUFFIX = ".tokens"

#: The four lengths that a control byte stands for, and a value's mask by length.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    more = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    quads[:len(values)] = more
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    held = np.arange(4) <= more[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[held].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of a block."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    place = np.cumsum(length) - length
    padded = np.frombuffer(data + bytes(4), np.uint8)
    lanes = np.ndarray(shape=(len(padded) - 3,), dtype="<u4", buffer=padded, strides=(1,))
    return lanes[place] & MASKS[length]


@contextlib.contextmanager
def _written(folder: str, name: str):
    """A stream into a file that appears under its name when it is whole."""
    path = _local(folder)
    part = f".{name}-{uuid.uuid4().hex}.tmp"
    if path is not None:
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{part}", "wb") as f:
            yield f
        os.replace(f"{path}/{part}", f"{path}/{name}")
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{part}") as f:
        yield f
    system.move(f"{path}/{part}", f"{path}/{name}")


def _opened(folder: str, name: str):
    path = _local(folder)
    if path is not None:
        return open(f"{path}/{name}", "rb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    return system.open_input_file(f"{path}/{name}")


class FileWriter:
    """Documents one after another into one file."""

    def __init__(self, stream, block_values: int = BLOCK_VALUES):
        self.stream, self.block_values = stream, block_values
        self.ids, self.known, self.sizes = [], [], []
        self.held, self.n_held, self.blocks, self.values = [], 0, 0, 0

    def add(self, doc: int | None, ranks: np.ndarray) -> None:
        self.ids.append(doc or 0)
        self.known.append(doc is not None)
        self.sizes.append(len(ranks))
        self.values += len(ranks)
        self.held.append(ranks)
        self.n_held += len(ranks)
        if self.n_held >= self.block_values:
            every = np.concatenate(self.held)
            whole = len(every) // self.block_values * self.block_values
            for at in range(0, whole, self.block_values):
                self._block(every[at:at + self.block_values])
            self.held, self.n_held = [every[whole:]], len(every) - whole

    def _block(self, values: np.ndarray) -> None:
        control, data = encode(values)
        self.stream.write(np.array([len(values), len(data)], "<u4").tobytes() + control + data)
        self.blocks += 1

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        self.stream.write(np.array(self.ids, "<i8").tobytes() + np.array(self.known, np.uint8).tobytes()
                          + np.array(self.sizes, "<i8").tobytes()
                          + np.array([len(self.ids), self.blocks], "<u8").tobytes() + MARK)


def read_file(stream):
    """(doc_id, ranks) of a file's documents, block by block."""
    stream.seek(0, 2)
    size = stream.tell()
    stream.seek(max(size - 24, 0))
    tail = stream.read(24)
    if tail[16:] != MARK:
        raise ValueError("not a whole token file")
    docs, blocks = (int(x) for x in np.frombuffer(tail[:16], "<u8"))
    stream.seek(size - 24 - 17 * docs)
    table = stream.read(17 * docs)
    ids = np.frombuffer(table, "<i8", docs)
    known = np.frombuffer(table, np.uint8, docs, 8 * docs)
    sizes = np.frombuffer(table, "<i8", docs, 9 * docs)
    stream.seek(0)
    held, n_held = [np.empty(0, np.uint32)], 0
    for doc, own, n in zip(ids.tolist(), known.tolist(), sizes.tolist()):
        while n_held < n:
            if not blocks:
                raise ValueError("a token file ends before its last document")
            blocks -= 1
            values, length = (int(x) for x in np.frombuffer(stream.read(8), "<u4"))
            held.append(decode(stream.read(-(-values // 4)), stream.read(length), values))
            n_held += values
        every = held[0] if len(held) == 1 else np.concatenate(held)
        yield (doc if own else None), every[:n]
        held, n_held = [every[n:]], n_held - n


def tokens(docs: DataFrame, id_col: str, text_col: str, path: str, end: int) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 and the ids, compressed."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        encoder, squeeze = TextEncoder(path), zstandard.ZstdCompressor(level=1)
        for chunk in chunks(batches, "text", ENCODE_BYTES):
            ids = [i + tail for i in encoder.column(chunk.column(1))]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                 pa.array([squeeze.compress(i) for i in ids], pa.binary())],
                names=["doc_id", "n_tokens", "ids_crc32", "ids"])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_crc32 bigint, ids binary"))


def frequencies(coded: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs. A task sends a row per id."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for block in batch.column(0):
                own = np.bincount(np.frombuffer(zstandard.ZstdDecompressor().decompress(block.as_py()), "<u4"))
                if len(own) > len(total):
                    own, total = total, own
                total[:len(own)] += own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    return coded.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write(coded: DataFrame, folder: str, file_values: int = FILE_VALUES, task_values: int = TASK_VALUES,
          block_values: int = BLOCK_VALUES) -> DataFrame:
    """Write staged ``tokens`` to ``folder``; the list of files (part, seq,
    name, n_docs, n_values), which must be staged to run the job once."""
    spark = coded.sparkSession
    # One row per id of the vocabulary: its size bounds what the driver gets.
    ranked = frequencies(coded).orderBy(F.col("n").desc(), "id").select("id").toPandas()["id"].to_numpy(np.int64)
    save(folder, "ids_by_rank", ranked.astype("<u4"))
    total = coded.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // task_values))

    def run(batches):
        by_rank = load(folder, "ids_by_rank")
        rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 0, np.uint32)
        rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
        part, made, squeezed = TaskContext.get().partitionId(), [], zstandard.ZstdDecompressor()
        rows = ((d, b) for batch in batches for d, b in zip(batch.column(0).to_pylist(), batch.column(1)))
        row = next(rows, None)
        while row is not None:
            name = f"{part:08d}-{len(made):06d}{SUFFIX}"
            with _written(folder, name) as stream:
                out = FileWriter(stream, block_values)
                while row is not None and out.values < file_values:
                    out.add(row[0], rank_of[np.frombuffer(squeezed.decompress(row[1].as_py()), "<u4")])
                    row = next(rows, None)
                out.close()
            made.append((part, len(made), name, len(out.ids), out.values))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)],
                                             names=["part", "seq", "name", "n_docs", "n_values"])

    order = [F.col("doc_id").asc_nulls_last(), F.col("n_tokens"), F.col("ids_crc32")]
    # The number of a row parts rows that are equal in all else.
    dealt = (coded.withColumn("number", F.monotonically_increasing_id())
             .repartitionByRange(parts, *order, F.col("number")).sortWithinPartitions(*order))
    return dealt.select("doc_id", "ids").mapInArrow(
        run, "part bigint, seq bigint, name string, n_docs bigint, n_values bigint")


def with_starts(files: DataFrame, group: int = 1024) -> DataFrame:
    """The list of files with ``start``, the number of ids before a file. Sums
    go by groups of ``group`` tasks first, so no window holds all files."""
    own = files.withColumn("of", F.floor(F.col("part") / group).cast("bigint"))
    groups = (own.groupBy("of").agg(F.sum("n_values").alias("n"))
              .select(F.col("of").alias("group"),
                      F.coalesce(F.sum("n").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)),
                                 F.lit(0)).alias("base")))
    inner = Window.partitionBy("of").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return (own.withColumn("within", F.coalesce(F.sum("n_values").over(inner), F.lit(0)))
            .join(groups, F.col("of") == F.col("group"))
            .select("part", "seq", "name", "n_docs", "n_values",
                    (F.col("base") + F.col("within")).cast("bigint").alias("start")))


def read(files: DataFrame, folder: str, keep_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, and with
    ``keep_ids`` its ids as an array. ``files`` has ``name`` and ``start``."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * keep_ids
    most = 10_000

    def run(batches):
        by_rank = np.asarray(load(folder, "ids_by_rank"))
        for batch in batches:
            for name, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                with _opened(folder, name) as stream:
                    for doc, ranks in read_file(stream):
                        ids = by_rank[ranks]
                        rows.append((doc, at, len(ids), zlib.crc32(ids.tobytes())) + ((ids.astype("<i4"),) if keep_ids else ()))
                        at += len(ids)
                        held += len(ids)
                        if len(rows) == most or (keep_ids and held > BLOCK_VALUES):
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names[:len(kinds)])

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, files.count())
    return files.select("name", "start").repartition(tasks).mapInArrow(run, schema)


def store(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
          end: int = END, **sizes) -> DataFrame:
    """Tokenise ``docs`` into files in ``folder``; the list of files with starts."""
    coded, place = stage_at(tokens(docs, id_col, text_col, path or vocabulary_path(), end), "token-ids")
    files = stage(write(coded, folder, **sizes), "token-file-list")
    discard(docs.sparkSession, place)
    return with_starts(files)


def round_trip(docs: DataFrame, folder: str | None = None, keep_ids: bool = False, **options) -> DataFrame:
    """Write ``docs`` as token files and give what the files hold."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return read(store(docs, folder, **options), folder, keep_ids)
