"""Interpolated modified Kneser-Ney language model and its text scores.

Words are named by 64-bit hashes; every text ends with one end token and
starts after one start token. The model has ``order`` levels (two or more):

    p(w | h) = max(a(hw) - D(a(hw)), 0) / a(h) + gamma(h) * p(w | h')
    p(w)     = max(t(w) - D'(t(w)), 0) / T + gamma' / (V + 1)

h' is h without its first word. a counts an n-gram itself at the highest level
and where it begins a text, else the distinct words before it; a(h) sums it
over w. t(w) counts distinct words before w, T distinct bigrams; D has
three values per level from the counts of counts; gamma gives back what the
discounts take. An unseen context leaves p(w), an unseen word gamma' / (V + 1),
so the probabilities of the V words and one unknown sum to 1.

Counting. Pass 1 counts words: each task sums its chunks and sends, per key
range, one block of sorted names and counts; a range's task merges its blocks
and writes sorted arrays. A word's number is its place in them. Pass k counts k-grams (place of the first
k - 1 words and number of the last, in one 64-bit key) the same way; the blocks
are compressed. From the highest level down, a range's task writes its sorted
keys and counts, and sends the context sums and what it adds to the next level
on; those are merged by range into arrays too. An n-gram or word with a third
of all rows is one entry per chunk. Only counts of counts (numbers) come to the driver. All counts
cover every training text; what is gathered grows with the corpus.

Scoring. Workers memory-map the arrays and look up a chunk's distinct words
and n-grams in key order.

Edge cases: a null or empty text is its end token alone; a null id is not held
out; repeated rows count as often as they stand; without training rows every
token has 1 / (V + 1) = 1. Extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm import shared_arrays
from lodgeframe.llm.blocks import as_batch, borders_of, by_range, exchange, merged, summed
from lodgeframe.llm.staging import discard, partitions_for, stage_at
from lodgeframe.llm.words import CHUNK_BYTES, Words, chunks, words_of
from lodgeframe.session import scratch_path

END_NAME = np.uint64(0x9B6D3F1AC5E84D27)
COUNT_CHUNK = 6 * CHUNK_BYTES
SCORE_CHUNK = 4 * CHUNK_BYTES
ORDER = 3
SUMS = ("total", "one", "two", "more", "before")


def held_out(ident: Column, parts: int = 7, part: int = 2) -> Column:
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % parts == part


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Names of all texts' tokens, ends included, and where each text starts."""
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    name = np.full(int(first[-1]) if n else 0, END_NAME, np.uint64)
    name[np.arange(len(w.name)) + w.text_of()] = w.name
    return name, first


def sum_fields(k: int) -> tuple[str, ...]:
    """Only words, the contexts of level 2, have distinct words before them."""
    return SUMS if k == 2 else SUMS[:4]


class Ranged:
    """Arrays sorted by key over several files, as one array."""

    def __init__(self, folder: str, sizes: list[tuple[int, int]], fields: tuple[str, ...] = ("count",)):
        self.folder, self.fields = folder, fields
        self.ranges = [r for r, _ in sizes]
        self.base = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).astype(np.int64)

    def find(self, key: np.ndarray, borders: np.ndarray, *fields: str) -> list[np.ndarray]:
        """For sorted keys: their places (-1 if absent) and fields (0 if absent)."""
        place = np.full(len(key), -1, np.int64)
        out = [(self.fields.index(f), np.zeros(len(key), np.int64)) for f in fields]
        cut = [0, *np.searchsorted(key, borders).tolist(), len(key)]
        for i, r in enumerate(self.ranges):
            a, b = cut[r], cut[r + 1]
            if a == b:
                continue
            at = shared_arrays.find_keys(self.folder, f"key-{r}", key[a:b])
            has = np.flatnonzero(at >= 0)
            place[a + has] = self.base[i] + at[has]
            for f, o in out if len(has) else ():
                o[a + has] = shared_arrays.counts_at(self.folder, f"counts-{r}", at[has], f)
        return [place, *(o for _, o in out)]

    def keys(self, place: np.ndarray) -> np.ndarray:
        """The keys at given places."""
        out = np.zeros(len(place), np.uint64)
        of = np.searchsorted(self.base, place, "right") - 1
        for i in np.unique(of).tolist():
            at = np.flatnonzero(of == i)
            out[at] = shared_arrays.keys_at(self.folder, f"key-{self.ranges[i]}", place[at] - self.base[i])
        return out


def _writer(folder: str, n_values: int, n_fields: int, tail, with_key: bool = True):
    """Task function: merge blocks, write the keys and the first ``n_fields``
    values, report each range's size, and what ``tail`` makes of them."""
    def run(batches):
        for r, key, *values in merged(batches, n_values):
            if with_key:
                shared_arrays.save_keys(folder, f"key-{r}", key)
            if n_fields:
                shared_arrays.save_counts(folder, f"counts-{r}", *values[:n_fields])
            yield tail(r, key, values)
    return run


def _discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of items counted once to four times; where
    a number is missing, half of the count is kept as discount."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    guess = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0,
             3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.0), float(i + 1)) for i, d in enumerate(guess)]


def _count_classes(c: np.ndarray) -> list[int]:
    return [int((c == i).sum()) for i in (1, 2, 3, 4)]


class Model:
    """Where the arrays lie, and the numbers that go with them."""

    def __init__(self, **known):
        self.__dict__.update(known)

    def level(self, k: int) -> Ranged:
        return Ranged(f"{self.folder}/{k}", self.sizes[k])

    def opened(self):
        return ({k: self.level(k) for k in self.sizes},
                {k: Ranged(f"{self.folder}/sums-{k}", self.sum_sizes[k], sum_fields(k)) for k in self.sum_sizes})

    def contexts(self, k: int) -> int:
        """Contexts of level k: the places of level k - 1, and the start."""
        return sum(n for _, n in self.sizes[k - 1]) + (k == 2)

    def borders(self, k: int) -> np.ndarray:
        if k == 1:
            return borders_of(self.ranges)
        return borders_of(self.ranges, max(self.contexts(k) * max(self.n_words, 1), self.ranges))

    def sum_borders(self, k: int) -> np.ndarray:
        return borders_of(self.ranges, max(self.contexts(k), self.ranges))

    def grams(self, levels: dict, name: np.ndarray, first: np.ndarray, top: int, *fields: str):
        """Yields (k, contexts' places, keys, own places, ``fields``, distinct)
        of the k-grams that end at each token, up to level ``top`` (whose places
        are left out if it is not in ``levels``); -1 where unknown. Level 1 comes
        with counts for contexts. ``distinct`` are the different places in
        order, -1 among them where unknown, and each token's place in these."""
        words, inverse = np.unique(name, return_inverse=True)
        own, count = levels[1].find(words, self.borders(1), "count")
        ids = own[inverse]
        yield 1, count[inverse], None, ids, (), (own, inverse)
        place = ids
        for k in range(2, top + 1):
            before = np.concatenate([[-1], place[:-1]])[:len(place)]
            before[first[:-1]] = self.n_words if k == 2 else -1
            known = (before >= 0) & (ids >= 0)
            key = np.where(known, before, 0).astype(np.uint64) * np.uint64(max(self.n_words, 1)) \
                + np.where(known, ids, 0).astype(np.uint64)
            place = np.full(len(ids), -1, np.int64)
            values = [np.zeros(len(ids), np.int64) for _ in fields]
            distinct = None
            if k in levels:
                grams, inverse = np.unique(key[known], return_inverse=True)
                found = levels[k].find(grams, self.borders(k), *fields)
                for own, f in zip((place, *values), found):
                    own[known] = f[inverse]
                index = np.full(len(ids), -1, np.int64)
                index[known] = inverse
                distinct = found[0], index
            yield k, before, np.where(known, key, np.uint64(0)), np.where(known, place, -2), values, distinct

    def begins(self, levels: dict, context: np.ndarray, k: int) -> np.ndarray:
        """Whether the contexts of level k begin with the start token."""
        for j in range(k - 1, 1, -1):
            context = (levels[j].keys(context) // np.uint64(self.n_words)).astype(np.int64)
        return context == self.n_words

    def shortened(self, levels: dict, context: np.ndarray, k: int) -> np.ndarray:
        """Places of level-k contexts (k > 2) without their first word."""
        before, last = np.divmod(levels[k - 1].keys(context), np.uint64(self.n_words))
        if k == 3:
            return last.astype(np.int64)
        key = self.shortened(levels, before.astype(np.int64), k - 1).astype(np.uint64) * np.uint64(self.n_words) + last
        distinct, inverse = np.unique(key, return_inverse=True)
        return levels[k - 2].find(distinct, self.borders(k - 2))[0][inverse]


def train(docs: DataFrame, text_col: str = "text", order: int = 2) -> Model:
    """Count all texts of ``docs`` into shared arrays."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark, text = docs.sparkSession, docs.select(F.col(text_col).alias("text"))
    folder = scratch_path(spark, "kneser-ney")
    ranges = partitions_for(text, "text")
    sized = "range int, size bigint, total bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, n5 bigint"

    def count_words(batches):
        for chunk in chunks(batches, "text", COUNT_CHUNK):
            name, _ = tokens(words_of(chunk, "text", True))
            key, n = np.unique(name, return_counts=True)
            yield as_batch(by_range(key, borders_of(ranges), n))

    def report(r, size, n):
        return pa.RecordBatch.from_pydict(
            {"range": pa.array([r], pa.int32()), "size": [size], "total": [int(n.sum())],
             **{f"n{i + 1}": [x] for i, x in enumerate(_count_classes(n))}, "n5": [int((n > 2).sum())]})

    def word_report(r, key, values):
        return report(r, len(key), values[0])

    counted = exchange(text.mapInArrow(count_words, "range int, block binary"), ranges)
    words = counted.mapInArrow(_writer(f"{folder}/1", 1, 1, word_report), sized).collect()
    model = Model(folder=folder, ranges=ranges, order=order, sizes={1: sorted((r["range"], r["size"]) for r in words)},
                  sum_sizes={}, discounts={}, n_tokens=sum(r["total"] for r in words))
    model.n_words = sum(n for _, n in model.sizes[1])

    def tagged(r, size, n, *parts):
        """A range's report, and blocks for part i as range + i * ranges."""
        head = np.array([r, size, *_count_classes(n)], "<i8").tobytes()
        return as_batch([(-1, head), *((x + i * ranges, b) for i, p in enumerate(parts) for x, b in p)])

    def passer(k):
        """What a range of level k passes on: context sums, and the distinct
        words before the next level's n-grams."""
        def pass_on(r, key, values):
            (n,) = values
            context, w = np.divmod(key, np.uint64(max(model.n_words, 1)))
            one, zero = np.ones(len(key), np.int64), np.zeros(len(key), np.int64)
            own = (n, (n == 1) * one, (n == 2) * one, (n > 2) * one, zero)
            if k == 2:
                sums = summed(np.concatenate([context, w]),
                              *(np.concatenate(p) for p in zip(own, (zero, zero, zero, zero, one))))
                return tagged(r, len(key), n, by_range(sums[0], model.sum_borders(2), *sums[1:]))
            sums = summed(context, *own)
            levels = model.opened()[0]
            place = sums[0].astype(np.int64)
            shorter = model.shortened(levels, place, k)[np.searchsorted(sums[0], context)]
            lower = summed(shorter.astype(np.uint64) * np.uint64(model.n_words) + w, one)
            return tagged(r, len(key), n, by_range(sums[0], model.sum_borders(k), *sums[1:]),
                          by_range(lower[0], model.borders(k - 1), lower[1]))
        return pass_on

    def counter(k):
        def count_grams(batches):
            levels = model.opened()[0]
            for chunk in chunks(batches, "text", COUNT_CHUNK):
                name, first = tokens(words_of(chunk, "text", True))
                *_, (_, _, key, place, _, _) = model.grams(levels, name, first, k)
                key, n = np.unique(key[place > -2], return_counts=True)
                yield as_batch(by_range(key, model.borders(k), n))
        return count_grams

    def opener(k):
        """Level k's n-grams that begin a text keep their counts."""
        def keep(r, key, values):
            context = (key // np.uint64(max(model.n_words, 1))).astype(np.int64)
            at = model.begins(model.opened()[0], context, k)
            return tagged(r, len(key), values[0], by_range(key[at], model.borders(k), values[0][at]))
        return keep

    blocks = "range int, block binary"

    def reports(passed):
        return [np.frombuffer(r[0], "<i8").tolist() for r in passed.filter("range < 0").select("block").collect()]

    def part(passed, i):
        own = F.col("range") - i * ranges
        return passed.filter((F.col("range") >= i * ranges) & (F.col("range") < (i + 1) * ranges)) \
            .select(own.cast("int").alias("range"), "block")

    openers = {}
    for k in range(2, order + 1):
        grams = exchange(text.mapInArrow(counter(k), blocks), ranges)
        # Below the highest level, counts are known only when the next one has passed them on.
        written = _writer(f"{folder}/{k}", 1, 0, opener(k)) if k < order else \
            _writer(f"{folder}/{k}", 1, 1, passer(k))
        passed, passed_at = openers[k] = stage_at(grams.mapInArrow(written, blocks), "kneser-ney-sums")
        # One report row per range.
        rows = reports(passed)
        model.sizes = {**model.sizes, k: sorted((r[0], r[1]) for r in rows)}
    for k in range(order, 1, -1):
        if k < order:
            both = exchange(part(openers[k][0], 0).union(part(passed, 1)), ranges)
            used = openers[k][1], passed_at
            passed, passed_at = stage_at(
                both.mapInArrow(_writer(f"{folder}/{k}", 1, 1, passer(k), False), blocks), "kneser-ney-sums")
            discard(spark, *used)
            rows = reports(passed)
            assert sorted((r[0], r[1]) for r in rows) == model.sizes[k], "an n-gram has no count"
        model.discounts[k] = _discounts([sum(r[2 + i] for r in rows) for i in range(4)])

        def sum_report(r, key, values, k=k):
            t = values[4][key < np.uint64(model.n_words)] if k == 2 else values[4][:0]
            return report(r, len(key), t)

        sums = exchange(part(passed, 0), ranges) \
            .mapInArrow(_writer(f"{folder}/sums-{k}", len(SUMS), len(sum_fields(k)), sum_report), sized).collect()
        model.sum_sizes = {**model.sum_sizes, k: sorted((r["range"], r["size"]) for r in sums)}
    discard(spark, passed_at)
    model.types = sum(r["total"] for r in sums)
    t = [sum(r[f"n{i}"] for r in sums) for i in (1, 2, 3, 4, 5)]
    low = model.low = _discounts(t[:4])
    model.low_gamma = (low[0] * t[0] + low[1] * t[1] + low[2] * t[4]) / model.types if model.types else 1.0
    return model


def _discount(count: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(count, 3)]


def chunk_scores(model: Model, opened, name: np.ndarray, first: np.ndarray):
    """Per text: tokens, known tokens, base score, model score (log10)."""
    levels, sums = opened
    n = model.n_words
    grams = model.grams(levels, name, first, model.order, "count")
    _, count, _, ids, _, distinct = next(grams)
    base = np.log10((count + 1) / (model.n_tokens + n + 1))
    known = np.flatnonzero(ids >= 0)

    def context_sums(k: int, own: np.ndarray) -> list[np.ndarray]:
        """The sums of contexts in order; in the last place those of the start."""
        has = np.flatnonzero(own >= 0)
        asked = own[has] if k > 2 else np.append(own[has], n)
        out = []
        for found in sums[k].find(asked.astype(np.uint64), model.sum_borders(k), *sum_fields(k))[1:]:
            x = np.zeros(len(own) + 1, np.int64)
            x[has] = found[:len(has)]
            x[-1:] = found[len(has):] if k == 2 else 0
            out.append(x)
        return out

    p = np.full(len(ids), model.low_gamma / (n + 1))
    *found, t = context_sums(2, distinct[0])
    t = t[distinct[1][known]]
    p[known] += np.maximum(t - _discount(t, model.low), 0) / max(model.types, 1)
    for k, before, _, place, (c,), here in grams:
        if k > 2:
            found = context_sums(k, distinct[0])
        # The context ends with the token before; a text's first one has the start.
        index = np.concatenate([[-1], distinct[1][:-1]])[:len(ids)]
        index[first[:-1]] = -1
        distinct = here
        ctx = np.flatnonzero(before >= 0)
        if not len(ctx) or not model.n_tokens:
            continue
        total, one, two, more = (x[index[ctx]] for x in found)
        seen = total > 0
        ctx, total, one, two, more = (x[seen] for x in (ctx, total, one, two, more))
        d1, d2, d3 = model.discounts[k]
        p[ctx] *= (d1 * one + d2 * two + d3 * more) / total
        both = place[ctx] >= 0
        at = ctx[both]
        p[at] += np.maximum(c[at] - _discount(c[at], model.discounts[k]), 0) / total[both]
    score = np.log10(p)

    def per_text(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, first[:-1]) if len(first) > 1 else x

    return np.diff(first), per_text((ids >= 0).astype(np.int64)), per_text(base), per_text(score)


def score(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text",
          order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    Without a model, learns from the rows not held out."""
    if model is None:
        model = train(docs.filter(~held_out(F.col(id_col))), text_col, order)

    def run(batches):
        opened = model.opened()
        for chunk in chunks(batches, "text", SCORE_CHUNK):
            name, first = tokens(words_of(chunk, "text", True))
            n, known, base, value = chunk_scores(model, opened, name, first)
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), chunk.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(np.full(len(n), model.n_tokens), pa.int64()), pa.array(base), pa.array(value)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                         "train_tokens bigint, base_score double, score double")
