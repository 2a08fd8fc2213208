"""Sorted keys and counts in the shared folder."""
import numpy as np
import pytest

from lodgeframe.llm import shared_arrays

TOP = 2**64 - 1


@pytest.mark.parametrize("key", [
    [], [0], [TOP], [0, TOP], [5, 6, 7, 2**32 + 4, 2**32 + 5, 2**32 + 6, 2**34], [2**63 - 1, 2**63, 2**63 + 1],
    list(range(2**40, 2**40 + 70000, 7)), [i << 33 for i in range(1, 3000)],
    np.unique(np.random.default_rng(3).integers(0, 2**36, 5000)).tolist()])
def test_keys_are_found_at_their_places_and_no_other(tmp_path, key):
    key = np.array(key, np.uint64)
    folder = str(tmp_path)
    shared_arrays.save_keys(folder, "key", key)
    asked = np.unique(np.concatenate([key, key + np.uint64(1), key - np.uint64(1), np.array([0, 9, TOP], np.uint64)]))
    at = {k: i for i, k in enumerate(key.tolist())}
    assert shared_arrays.find_keys(folder, "key", asked).tolist() == [at.get(k, -1) for k in asked.tolist()]
    place = np.arange(len(key))[::-1]
    assert shared_arrays.keys_at(folder, "key", place).tolist() == key[place].tolist()


@pytest.mark.parametrize("count", [[], [0, 1, 254], [1] * 40 + [255, 256, 10**12] + [3] * 40, [300] * 9 + [2**40]])
def test_counts_keep_their_values(tmp_path, count):
    count = np.array(count, np.int64)
    shared_arrays.save_counts(str(tmp_path), "count", count)
    place = np.arange(len(count))[::-1]
    assert shared_arrays.counts_at(str(tmp_path), "count", place).tolist() == count[place].tolist()


def test_few_arrays_stay_mapped(tmp_path):
    for i in range(shared_arrays.MOST_OPEN + 50):
        shared_arrays.save_counts(str(tmp_path), f"count-{i}", np.array([i % 200], np.int64))
        assert shared_arrays.counts_at(str(tmp_path), f"count-{i}", np.array([0])).tolist() == [i % 200]
    assert shared_arrays.mapped.cache_info().currsize <= shared_arrays.MOST_OPEN


@pytest.mark.parametrize("count", [[255] * 9, [255] * 9 + [0], [256] * 3])
def test_many_counts_of_255_keep_their_values(tmp_path, count):
    count = np.array(count, np.int64)
    shared_arrays.save_counts(str(tmp_path), "count", count)
    assert shared_arrays.counts_at(str(tmp_path), "count", np.arange(len(count))).tolist() == count.tolist()


def test_fields_of_a_range_lie_in_one_file(tmp_path):
    fields = [np.array(c, np.int64) for c in ([1, 2, 3] * 20, [7] * 59 + [10**9], [300] * 60)]
    shared_arrays.save_counts(str(tmp_path), "counts", *fields)
    shared_arrays.save_keys(str(tmp_path), "key", np.arange(60, dtype=np.uint64) << np.uint64(34))
    assert sorted(f.name for f in tmp_path.iterdir()) == ["counts.npy", "key.npy"]
    place = np.arange(60)[::-1]
    for i, f in enumerate(fields):
        assert shared_arrays.counts_at(str(tmp_path), "counts", place, i).tolist() == f[place].tolist()


@pytest.mark.parametrize("asked", [40, 4_000])
def test_few_and_many_keys_are_sought_in_many_stretches(tmp_path, asked):
    rng = np.random.default_rng(5)
    key = np.unique(rng.integers(0, 2**40, 30_000).astype(np.uint64))
    shared_arrays.save_keys(str(tmp_path), "key", key)
    some = np.unique(np.concatenate([rng.choice(key, asked), rng.integers(0, 2**41, asked).astype(np.uint64)]))
    at = {k: i for i, k in enumerate(key.tolist())}
    assert shared_arrays.find_keys(str(tmp_path), "key", some).tolist() == [at.get(k, -1) for k in some.tolist()]
    dense = np.arange(int(key[0]), int(key[0]) + 50_000, dtype=np.uint64)
    assert shared_arrays.find_keys(str(tmp_path), "key", dense).tolist() == [at.get(k, -1) for k in dense.tolist()]
