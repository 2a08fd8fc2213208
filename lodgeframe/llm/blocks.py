"""Sorted keys with counts, exchanged as compressed blocks.

A task sums what it has per key and sends, per key range, one block: so a key
with a third of all rows is one entry per chunk, and the exchange moves a few
large rows instead of one row per key. A range's task merges its blocks; the
number of ranges follows the size of the input, so a range's keys fit a task.
"""
from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame


def borders_of(ranges: int, top: int = 1 << 64) -> np.ndarray:
    return np.array([top * i // ranges for i in range(1, ranges)], np.uint64)


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return (key[head], *(np.add.reduceat(v[order], head) if len(key) else v for v in values))


@functools.cache
def _coders() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Made once in a worker: small blocks take less time than these."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(key: np.ndarray, *values: np.ndarray) -> bytes:
    """Sorted keys as differences, and counts, each byte plane by itself,
    compressed."""
    step = np.diff(key, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(key), -1).T).tobytes()
              for a in (step, *(v.astype("<i8") for v in values))]
    return _coders()[0].compress(
        len(key).to_bytes(8, "little") + b"".join(planes))


def unpack(block: bytes, n_values: int) -> tuple[np.ndarray, ...]:
    raw = _coders()[1].decompress(block)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for width, kind in ((8, "<u8"), *((8, "<i8"),) * n_values):
        plane = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += n * width
    return (np.cumsum(out[0], dtype=np.uint64), *out[1:])


def by_range(key: np.ndarray, borders: np.ndarray, *values: np.ndarray):
    """(range, packed block) of each range that sorted keys meet."""
    cut = [0, *np.searchsorted(key, borders).tolist(), len(key)]
    for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
        if b > a:
            yield r, pack(key[a:b], *(v[a:b] for v in values))


def exchange(blocks: DataFrame, ranges: int) -> DataFrame:
    """Blocks dealt so that each task holds whole ranges, sorted by range."""
    return blocks.repartition(ranges, "range").sortWithinPartitions("range")


def merged(batches, n_values: int):
    """(range, keys, sums) for each range of a task's sorted blocks."""
    held, own = [], None
    for batch in batches:
        for r, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if r != own and held:
                yield own, *summed(*(np.concatenate(c) for c in zip(*held)))
                held = []
            own = r
            held.append(unpack(block, n_values))
    if held:
        yield own, *summed(*(np.concatenate(c) for c in zip(*held)))


def as_batch(pairs) -> pa.RecordBatch:
    pairs = list(pairs)
    return pa.RecordBatch.from_arrays([pa.array([r for r, _ in pairs], pa.int32()),
                                       pa.array([b for _, b in pairs], pa.binary())], names=["range", "block"])
