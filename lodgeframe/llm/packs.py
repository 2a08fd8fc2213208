"""Texts in packs of a few megabytes, and questions that packs ask of all others.

A pack sends its distinct keys with one value each, by key range; the task of
a range sees all packs' entries of a key and answers every pack with one bit
per key. So a key that most documents hold is one entry per pack, and answers
are small.
"""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.blocks import exchange, unpack
from lodgeframe.llm.words import CHUNK_BYTES, Words, chunks, give_back, ids_of, text_buffer

PACK_BYTES = 2 * CHUNK_BYTES


def packs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """pack, ids, bounds, texts (compressed): a row per few megabytes of text."""
    def run(batches):
        for chunk in chunks(batches, "text", PACK_BYTES):
            data, bounds = text_buffer(chunk.column(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([ids_of(chunk, "doc_id").tobytes()]),
                 pa.array([bounds.tobytes()]), pa.array([zstandard.ZstdCompressor(level=3).compress(data.tobytes())])],
                names=["pack", "ids", "bounds", "texts"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "pack bigint, ids binary, bounds binary, texts binary")


def opened(row: dict, lower: bool = False) -> tuple[np.ndarray, Words]:
    """A pack's ids and words."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["texts"]), np.uint8)
    return np.frombuffer(row["ids"], np.int64), Words(data, np.frombuffer(row["bounds"], np.int64), lower)


def flags_of(replies, n: int) -> np.ndarray:
    """A pack's reply bits in key order, from its ranges' replies."""
    parts = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["size"]) for r in
             sorted(replies or [], key=lambda r: r["range"])]
    flags = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
    assert len(flags) == n, "a reply is missing"
    return flags


def rows_of(batches):
    """Rows as dictionaries, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
            give_back()


def sent(pack: int, blocks) -> pa.RecordBatch:
    """A pack's (range, block) pairs as rows."""
    blocks = list(blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array([pack] * len(blocks), pa.int64()), pa.array([r for r, _ in blocks], pa.int32()),
         pa.array([b for _, b in blocks], pa.binary())], names=["pack", "range", "block"])


def answer(blocks: DataFrame, ranges: int, judge) -> DataFrame:
    """Per pack its replies. ``judge(keys, values, head, group)`` sees a
    range's entries in key order and gives a bit for each."""
    def run(batches):
        held, own = [], None

        def replies():
            unpacked = [unpack(b, 1) for _, b in held]
            keys = np.concatenate([k for k, _ in unpacked])
            values = np.concatenate([v for _, v in unpacked])
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(keys))))
            bits = np.empty(len(keys), bool)
            bits[order] = judge(values[order], head, group)
            ends = np.cumsum([len(k) for k, _ in unpacked])
            for (pack, _), a, b in zip(held, ends - [len(k) for k, _ in unpacked], ends):
                yield pack, own, int(b - a), np.packbits(bits[a:b]).tobytes()

        def batch_of(rows):
            rows = list(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                names=["pack", "range", "size", "bits"])

        for batch in batches:
            for p, r, b in zip(*(c.to_pylist() for c in batch.columns)):
                if r != own and held:
                    yield batch_of(replies())
                    held = []
                own = r
                held.append((p, b))
        if held:
            yield batch_of(replies())

    return (exchange(blocks, ranges).mapInArrow(run, "pack bigint, range int, size int, bits binary")
            # As many replies per pack as there are ranges.
            .groupBy("pack").agg(F.collect_list(F.struct("range", "size", "bits")).alias("replies")))


def shared_by_two(values, head, group):
    """Whether a key's values sum to two or more."""
    return (np.add.reduceat(values, head) >= 2)[group]
