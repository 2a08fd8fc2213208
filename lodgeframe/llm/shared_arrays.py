"""Sorted arrays in the shared folder, written by tasks and memory-mapped by workers.

A table of arrays is a folder of ``.npy`` files, one per key range. Files
appear under their final name only when whole, so a retried task replaces a
file by an equal one. Arrays that are looked up together lie in one file. A
worker keeps at most ``MOST_OPEN`` files mapped, without a descriptor where
Python can do so. Sorted keys are kept as 32-bit differences to
the start of their stretch, counts as bytes with the few greater ones apart.
Where the shared folder is no mounted file system, a
worker fetches the file once into its own temporary folder and maps that.
"""
from __future__ import annotations

import functools
import mmap
import os
import sys
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np

#: Without descriptors only the system's limit of mappings (65,530 by default) counts.
MOST_OPEN = 16_384 if sys.version_info >= (3, 13) else 256
#: Types of the arrays in a file of several.
KINDS = [np.dtype(t) for t in ("u1", "<u2", "<u4", "<u8", "<i8")]
#: A stretch with fewer sought keys than this is not searched by itself.
FEW_SOUGHT = 32


def _local(uri: str) -> str | None:
    """Path of a folder that is mounted, else None."""
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def save(folder: str, name: str, array: np.ndarray) -> None:
    path = _local(folder)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        part = f"{path}/.{name}-{uuid.uuid4().hex}.tmp"
        with open(part, "wb") as f:
            np.save(f, array)
        os.replace(part, f"{path}/{name}.npy")
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(part) as f:
        np.save(f, array)
    system.move(part, f"{path}/{name}.npy")


def load(folder: str, name: str) -> np.ndarray:
    path = _local(folder)
    if path is not None:
        return np.load(f"{path}/{name}.npy", mmap_mode="r")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    own = f"{tempfile.gettempdir()}/{uuid.uuid5(uuid.NAMESPACE_URL, f'{folder}/{name}').hex}.npy"
    if not os.path.exists(own):
        part = f"{own}.{uuid.uuid4().hex}"
        with system.open_input_stream(f"{path}/{name}.npy") as src, open(part, "wb") as out:
            while block := src.read(1 << 24):
                out.write(block)
        os.replace(part, own)
    return np.load(own, mmap_mode="r")


def save_parts(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Arrays of ``KINDS``, of one dimension, in one file."""
    head = [len(arrays), *(x for a in arrays for x in (KINDS.index(a.dtype), len(a)))]
    parts = [np.array(head, "<i8"), *arrays]
    file = np.zeros(sum(-(-a.nbytes // 8) * 8 for a in parts), np.uint8)
    at = 0
    for a in parts:
        file[at:at + a.nbytes] = np.ascontiguousarray(a).view(np.uint8)
        at += -(-a.nbytes // 8) * 8
    save(folder, name, file)


def _bytes(folder: str, name: str) -> np.ndarray:
    """``load`` of an array of bytes, without the general reader."""
    path = _local(folder)
    if path is None:
        return load(folder, name)
    own = {"trackfd": False} if sys.version_info >= (3, 13) else {}
    with open(f"{path}/{name}.npy", "rb") as f:
        held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **own)
    return np.frombuffer(held, np.uint8, offset=10 + int.from_bytes(held[8:10], "little"))


@functools.lru_cache(MOST_OPEN)
def mapped(folder: str, name: str) -> tuple[np.ndarray, ...]:
    """The arrays of a file that is written once, kept open for a while."""
    file = _bytes(folder, name)
    n = int(file[:8].view("<i8")[0])
    head = file[8:8 + 16 * n].view("<i8").tolist()
    at, out = 8 + 16 * n, []
    for kind, size in zip(head[::2], head[1::2]):
        end = at + size * KINDS[kind].itemsize
        out.append(file[at:end].view(KINDS[kind]))
        at = -(-end // 8) * 8
    return tuple(out)


def _stretch(step: np.ndarray, wide: bool) -> np.ndarray:
    return np.zeros(len(step), np.int64) if wide else (step >> np.uint64(32)).astype(np.int64)


def save_keys(folder: str, name: str, key: np.ndarray) -> None:
    """Sorted, distinct 64-bit keys: the first one and where each stretch of
    2**32 begins, and the differences. Where stretches outnumber the keys, one
    stretch with 64-bit differences."""
    step = key - key[:1]
    wide = len(key) and int(step[-1] >> np.uint64(32)) >= len(key)
    high = _stretch(step, wide)
    starts = np.searchsorted(high, np.arange(int(high[-1]) + 2 if len(key) else 1))
    save_parts(folder, name, step if wide else step.astype(np.uint32), key[:1], starts.astype(np.int64))


def _bisect(low: np.ndarray, sought: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """``searchsorted`` of each value in its own part of ``low``."""
    at, last = lo.copy(), len(low) - 1
    step = 1 << max(int((hi - lo).max()).bit_length() - 1, 0)
    while step:
        probe = at + (step - 1)
        at += step * ((probe < hi) & (low[np.minimum(probe, last)] < sought))
        step >>= 1
    return at


def find_keys(folder: str, name: str, key: np.ndarray) -> np.ndarray:
    """Places of sorted keys among the saved ones, -1 if absent."""
    low, base, starts = mapped(folder, name)
    place = np.full(len(key), -1, np.int64)
    if not len(low):
        return place
    # Below the first key differences wrap around, and no saved one equals them.
    step = key - base[0]
    if low.dtype == np.uint64 or len(starts) == 2:
        at = np.minimum(np.searchsorted(low, step.astype(low.dtype)), len(low) - 1)
        return np.where(low[at].astype(np.uint64) == step, at, -1)
    high = step >> np.uint64(32)
    inside = np.flatnonzero(high < len(starts) - 1)
    if not len(inside):
        return place
    high, sought = high[inside].astype(np.int64), step[inside].astype(low.dtype)
    head = np.concatenate([[0], np.flatnonzero(high[1:] != high[:-1]) + 1])
    if len(head) * FEW_SOUGHT > len(high):
        hi = starts[high + 1]
        at = _bisect(low, sought, starts[high], hi)
        same = low[np.minimum(at, len(low) - 1)] == sought
        place[inside] = np.where(same & (at < hi), at, -1)
        return place
    for a, b in zip(head.tolist(), [*head[1:].tolist(), len(high)]):
        lo, hi = starts[high[a]], starts[high[a] + 1]
        if lo < hi:
            at = np.minimum(lo + np.searchsorted(low[lo:hi], sought[a:b]), hi - 1)
            place[inside[a:b]] = np.where(low[at] == sought[a:b], at, -1)
    return place


def keys_at(folder: str, name: str, place: np.ndarray) -> np.ndarray:
    """The saved keys at given places."""
    low, base, starts = mapped(folder, name)
    high = np.searchsorted(starts, place, "right") - 1
    return base[:1] + (high.astype(np.uint64) << np.uint64(32)) + low[place].astype(np.uint64)


def _count_parts(count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts in a byte each; places and values of those of 255 and more
    apart, unless they are many."""
    great, none = np.flatnonzero(count >= 255), np.empty(0, np.int64)
    if len(great) * 16 > len(count):
        return count.astype(np.min_scalar_type(max(int(count.max()), 256))), none, none
    return np.minimum(count, 255).astype(np.uint8), great.astype(np.int64), count[great].astype(np.int64)


def save_counts(folder: str, name: str, *counts: np.ndarray) -> None:
    """One or more fields of counts of the same things, in one file."""
    save_parts(folder, name, *(p for c in counts for p in _count_parts(c)))


def counts_at(folder: str, name: str, place: np.ndarray, field: int = 0) -> np.ndarray:
    """The saved counts of a field at given places."""
    saved, at, value = mapped(folder, name)[3 * field:3 * field + 3]
    count = saved[place].astype(np.int64)
    if len(at):
        great = np.flatnonzero(count == 255)
        count[great] = value[np.searchsorted(at, place[great])]
    return count
