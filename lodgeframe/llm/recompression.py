"""Long repeats across documents, found by recompression.

A window is ``window`` consecutive words of one document; a word is removed if
it lies in a window whose word sequence also starts in a document with a
smaller id. Windows are judged on the input.

Recompression rewrites each text as a sequence of symbols, in rounds. A round
names maximal runs of equal symbols and pairs of a left and a right symbol
(each symbol's side in a round is a bit of its name) as one symbol each. Names
are hashes of the parts, so they agree across the whole corpus, and whether
two neighbours join depends on the two alone: equal substrings get equal
interior symbols, wherever they stand. Each symbol carries the context within
which that holds.

1. Texts are staged once in packs, a row per few megabytes.
2. Every pack sends its distinct symbols, by range; a symbol is shared if two
   documents have it. The reply is one bit per symbol and pack.
3. Windows whose interior symbols are all shared are candidates. Every pack
   sends its distinct candidates' names with its smallest document of each;
   the reply is a bit: a smaller document has it too.
4. Packs drop the covered words.

A symbol or window with a third of all rows is one entry per pack. The symbol
filter only saves work (its names are cut to ``SYMBOL_BITS``); windows are
compared by 64-bit names. All texts are processed whole.

Edge cases: a null or empty text has no words; texts shorter than a window
keep all; rows with one id are one document, so they do not remove each
other's words; a null id counts as the largest. An empty table gives an empty
result. Extra columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.blocks import borders_of, by_range
from lodgeframe.llm.packs import answer, flags_of, opened, packs, rows_of, sent, shared_by_two
from lodgeframe.llm.staging import partitions_for, stage
from lodgeframe.llm.words import END_ID, Words, mix, window_names

WINDOW = 13
ROUNDS = 2
SYMBOL_BITS = 48
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.int64(1 << 40)


def next_round(name, text, ctx_from, ctx_to, number: int):
    """One round over the symbols of consecutive texts. A symbol is certain
    within any window that holds its context; a text's outer symbols never are."""
    n = len(name)
    if not n:
        return name, text, ctx_from, ctx_to
    side = mix(name + _BASE * np.arange(number + 1, number + 2, dtype=np.uint64)) & np.uint64(1)
    same = text[:-1] == text[1:]
    join = same & ((name[:-1] == name[1:]) | ((side[:-1] == 0) & (side[1:] == 1)))
    head = np.flatnonzero(np.concatenate([[True], ~join]))
    size = np.diff(np.append(head, n))
    place = np.arange(n) - np.repeat(head, size)
    power = np.cumprod(np.full(int(size.max()), _BASE, np.uint64))
    named = mix(np.add.reduceat(name * power[place], head) ^ size.astype(np.uint64))
    last = head + size - 1
    before, after = np.maximum(head - 1, 0), np.minimum(last + 1, n - 1)
    opens = (head == 0) | (text[before] != text[head])
    closes = (last == n - 1) | (text[after] != text[head])
    return (named, text[head], np.where(opens, -_FAR, ctx_from[before]),
            np.where(closes, _FAR, ctx_to[after]))


def symbols(w: Words, rounds: int = ROUNDS):
    """Names of the last round's symbols and their contexts (word places)."""
    at = np.arange(len(w.name), dtype=np.int64)
    now = (w.name, w.text_of(), at, at + 1)
    for r in range(rounds):
        now = next_round(*now, r)
    return now


def symbol_keys(w: Words, rounds: int, bits: int = SYMBOL_BITS):
    """Distinct cut names of the symbols, in how many texts each is (2: more),
    and per symbol its key's place, context from and to."""
    name, text, ctx_from, ctx_to = symbols(w, rounds)
    key = name >> np.uint64(64 - bits) << np.uint64(64 - bits)
    order = np.argsort(key, kind="stable")
    sorted_key, sorted_text = key[order], text[order]
    head = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if len(key) else order[:0]
    size = np.diff(np.append(head, len(key)))
    spread = sorted_text[head + size - 1] > sorted_text[head] if len(key) else head
    place = np.empty(len(key), np.int64)
    place[order] = np.repeat(np.arange(len(head)), size)
    return sorted_key[head], 1 + spread.astype(np.int64), place, ctx_from, ctx_to


def candidate_windows(w: Words, window: int, shared: np.ndarray, place, ctx_from, ctx_to):
    """Places and names of the windows whose certain symbols are all shared."""
    lone = ~shared[place] & (ctx_to - ctx_from <= window) if len(place) else np.empty(0, bool)
    n = len(w.name)
    change = np.zeros(n + 2, np.int64)
    np.add.at(change, np.maximum(ctx_to[lone] - window, 0), 1)
    np.add.at(change, ctx_from[lone] + 1, -1)
    ruled_out = np.cumsum(change)[:n] > 0
    text = w.text_of()
    m = n - window + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero((text[:m] == text[window - 1:]) & ~ruled_out[:m])
    return at, window_names(w.name, window)[at]


def _judge_smaller(values, head, group):
    return np.minimum.reduceat(values, head)[group] < values


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   rounds: int = ROUNDS, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with ``keep_text`` the kept
    words joined by blanks."""
    ranges = partitions_for(docs, text_col)
    borders = borders_of(ranges)
    packed = stage(packs(docs, id_col, text_col), "recompression-packs")

    def send_symbols(batches):
        for row in rows_of(batches):
            _, w = opened(row)
            key, n, *_ = symbol_keys(w, rounds)
            yield sent(row["pack"], by_range(key, borders, n))

    shared = stage(answer(packed.mapInArrow(send_symbols, "pack bigint, range int, block binary"),
                          ranges, shared_by_two), "recompression-symbols")

    def windows(row):
        ids, w = opened(row)
        key, _, place, ctx_from, ctx_to = symbol_keys(w, rounds)
        at, name = candidate_windows(w, window, flags_of(row["replies"], len(key)), place, ctx_from, ctx_to)
        own = ids[w.text_of()[at]]
        order = np.lexsort((own, name))
        named, least = name[order], own[order]
        head = np.flatnonzero(np.concatenate([[True], named[1:] != named[:-1]])) if len(name) else order[:0]
        group = np.empty(len(name), np.int64)
        group[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(name))))
        return ids, w, at, own, group, named[head], least[head]

    def send_windows(batches):
        for row in rows_of(batches):
            *_, name, least = windows(row)
            yield sent(row["pack"], by_range(name, borders, least))

    marked = packed.join(shared, "pack", "left")
    smaller = answer(marked.mapInArrow(send_windows, "pack bigint, range int, block binary"),
                     ranges, _judge_smaller).withColumnRenamed("replies", "smaller")

    def drop(batches):
        for row in rows_of(batches):
            ids, w, at, own, group, name, least = windows(row)
            elsewhere = flags_of(row["smaller"], len(name))
            gone = at[elsewhere[group] | (least[group] < own)]
            change = np.zeros(len(w.name) + 1, np.int64)
            change[gone] += 1
            change[gone + window] -= 1
            covered = np.cumsum(change)[:-1] > 0
            total = np.concatenate([[0], np.cumsum(covered)])
            removed = total[w.first[1:]] - total[w.first[:-1]]
            raw = w.data.tobytes()
            kept = []
            for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
                words = raw[w.bounds[i]:w.bounds[i + 1]].split() if removed[i] < b - a else []
                if removed[i] and words:
                    words = [x for x, c in zip(words, covered[a:b].tolist()) if not c]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if i == END_ID else i for i in ids.tolist()], pa.int64()),
                 pa.array(np.diff(w.first), pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 *([pa.array(kept, pa.binary()).cast(pa.string())] if keep_text else [])],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", *["text"] * keep_text])

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", text string" * keep_text
    return marked.join(smaller, "pack", "left").mapInArrow(drop, schema)


DIGEST_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS w
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM texts WHERE len(ws) >= {WINDOW})),
found AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY w) AS least FROM windows)
  WHERE least < coalesce(doc_id, 9223372036854775807)),
gone AS (
  SELECT DISTINCT r, i + k AS i FROM found, (SELECT unnest(range(0, {WINDOW})) AS k)),
lists AS (SELECT r, list(i) AS gone FROM gone GROUP BY r),
kept AS (
  SELECT doc_id, ws, coalesce(gone, []) AS gone,
         list_filter(ws, lambda x, j: NOT list_contains(coalesce(gone, []), j)) AS left_words
  FROM texts LEFT JOIN lists USING (r))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
       sha256(array_to_string(left_words, ' ')) AS kept_sha256
FROM kept
"""
