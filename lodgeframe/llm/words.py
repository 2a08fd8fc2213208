"""Words of whole texts inside tasks, as arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. A batch's texts stay one byte buffer: word borders
come from one pass over the bytes, and a word's 64-bit name from its bytes
eight at a time, so no Python object is made per word.
"""
from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
END_ID = np.int64(2**63 - 1)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0xAEF17502108EF2D9, 0xD1B54A32D192ED03],
                dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """Words of consecutive texts: ``first`` (per text, and one at the end)
    points into ``start``, ``end`` (byte places) and ``name`` (64 bits)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False, gap: np.ndarray = _SPACE):
        self.data, self.bounds = data, bounds
        n = len(data)
        space = gap[data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], before[1:] = True, space[:-1]
            after[-1], after[:-1] = True, space[1:]
            filled = bounds[1:] > bounds[:-1]
            before[bounds[:-1][filled]] = True
            after[bounds[1:][filled] - 1] = True
        word = ~space
        self.start = np.flatnonzero(word & before)
        self.end = np.flatnonzero(word & after) + 1
        self.first = np.searchsorted(self.start, bounds)
        padded = np.zeros(n + 8, np.uint8)
        padded[:n] = _LOWER[data] if lower else data
        self.bytes = padded
        self.name = _names(padded, self.start, self.end - self.start)

    def text_of(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k-word windows that lie in one text, and their names."""
        text = self.text_of()
        n = len(text) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(text[:n] == text[k - 1:])
        return at, window_names(self.name, k)[at]


LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LETTER[128:] = True


def cores(words: Words, kind: np.ndarray = LETTER) -> tuple[np.ndarray, np.ndarray]:
    """Each word's first and last byte of a kind (letters; every byte of a
    letter beyond ASCII counts), as start and end; empty if it has none."""
    data = words.bytes
    start, end = words.start.copy(), words.end.copy()
    live = np.flatnonzero(~kind[data[start]])
    while len(live):
        start[live] += 1
        live = live[start[live] < end[live]]
        live = live[~kind[data[start[live]]]]
    live = np.flatnonzero((end > start) & ~kind[data[end - 1]])
    while len(live):
        end[live] -= 1
        live = live[~kind[data[end[live] - 1]]]
    return start, end


def names_between(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of byte ranges; ``data`` ends with eight spare bytes."""
    return _names(data, start, end - start)


def names_of(texts: list[str]) -> np.ndarray:
    """Names of given strings, as ``names_between`` gives them."""
    raw = [t.encode() for t in texts]
    end = np.cumsum([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
    return _names(data, np.concatenate([[0], end[:-1]]).astype(np.int64) if len(raw) else end,
                  np.array([len(r) for r in raw], np.int64))


def window_names(name: np.ndarray, k: int) -> np.ndarray:
    """Names of all windows of k consecutive values."""
    n = len(name) - k + 1
    total = name[:n] * _ODD[0]
    for j in range(1, k):
        total = total + name[j:n + j] * _ODD[j % 16] * np.uint64(2 * (j // 16) + 1)
    return mix(total)


def _names(padded: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    lanes = np.ndarray(shape=(max(len(padded) - 7, 0),), dtype="<u8", buffer=padded, strides=(1,))
    name = length.astype(np.uint64) * _ODD[1]
    if not len(start):
        return name
    left = np.minimum(length, 8)
    name = mix(name ^ (lanes[start] & _MASK[left]) * _ODD[0])
    at, offset = np.flatnonzero(length > 8), 8
    while len(at):
        left = np.minimum(length[at] - offset, 8)
        name[at] = mix(name[at] + _ODD[2] ^ (lanes[start[at] + offset] & _MASK[left]) * _ODD[0])
        offset += 8
        at = at[length[at] > offset]
    return name


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string or binary column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and what
    it keeps adds to the next task's need in another worker."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def chunks(batches, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about ``most`` bytes (one longer
    text alone may hold more). Every row comes once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = text_buffer(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(bounds, bounds[lo] + most, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi
        del batch
        give_back()


def words_of(batch: pa.RecordBatch, column: str, lower: bool = False) -> Words:
    return Words(*text_buffer(batch.column(batch.schema.get_field_index(column))), lower)


def ids_of(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A bigint column; a null counts as the largest value."""
    return batch.column(batch.schema.get_field_index(column)).fill_null(int(END_ID)).to_numpy(
        zero_copy_only=False).astype(np.int64)
