"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are dealt into blocks of some megabytes of text. A block's grid has a
row per term and a column per document; a cell holds the impact of the term in
the document. The grid is kept as a compressed quadtree: level by level, four
bits per cell say which of its quarters hold anything, and each cell has the
greatest impact below it, stored as the difference from its parent's. Rows come
by falling document frequency and columns by their commonest term, then size,
so that documents of one language lie together and quarters are empty or alike.

A search follows an item's terms down at once: a state is a range of columns
with, for each term, the cell on the term's row path that spans the range. The
sum of weight * greatest impact over the terms bounds the scores in the range.
The states with the greatest bounds are split first (some hundred at a time),
empty cells fall away, and a state goes when its bound is below the k-th score
known so far; at the last level the bound is the score itself, so results are
exact. A task carries each item's best documents from block to block.

Score of a document: sum over the item's distinct terms of
w * ((10**9 * tf) div (1000 * tf + 20 * m)), in 64-bit integers, where
w = floor(1000 * ln((2 N + 2) / (2 df + 1))) and
m = 100 - B + (B * n * N) div L with B = 50.

Shape of the job: texts are read twice, for N and L, and to build the index,
which is staged and may serve many searches. Document frequencies come from
the index: a block has them per row, and only names and counts are read. Items
are taken in blocks; a task answers all items of a block for its part of the
index and gives at most k rows an item. Nothing is shuffled but those.

Terms are compared by 64-bit names. That a term of an item shares its name
with another term of the corpus has a chance of about items' terms * corpus'
terms / 2**64, 2e-7 for 4,000 and 1e9.

Edge cases: documents and items without terms (null, empty) take no part; rows
of equal id are documents of their own, as are items of equal id (both get
their lists); documents without an id come last among equal scores; a term in
all documents may weigh 0 and then adds nothing. Empty tables give an empty
result. Extra columns are ignored.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.llm.staging import stage
from lodgeframe.llm.words import Words, chunks, text_buffer

K = 50
SHARE = 50
BLOCK_BYTES = 8 << 20
BLOCK_ITEMS = 256
BATCH = 512

#: Bytes outside terms: ASCII other than letters and digits.
GAP = np.ones(256, bool)
GAP[48:58] = GAP[65:91] = GAP[97:123] = False
GAP[128:] = False
#: Cells among a cell's four quarters, and those before a given quarter.
QUARTERS = np.array([bin(b).count("1") for b in range(16)], np.int64)
BEFORE = np.array([[bin(b & ((1 << q) - 1)).count("1") for q in range(4)] for b in range(16)], np.int64)


def _squeeze(array: np.ndarray) -> bytes:
    """An array of integers as compressed byte planes."""
    planes = np.ascontiguousarray(np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _expand(block: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _spread(x: np.ndarray) -> np.ndarray:
    """Each of 32 bits moved to the even place of twice its number."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """A quadtree over a square grid, cells numbered level by level from the
    root. ``quarters`` (four bits) covers all levels but the last; ``first``
    is a cell's first child; ``most`` its greatest impact. The number after
    the last cell stands for an empty one."""

    def __init__(self, height: int, quarters: np.ndarray, most: np.ndarray):
        self.height, self.empty = height, len(most)
        self.quarters = np.zeros(self.empty + 1, np.uint8)
        self.quarters[:len(quarters)] = quarters
        self.first = np.zeros(self.empty + 1, np.int64)
        self.first[:len(quarters)] = 1 + np.cumsum(QUARTERS[quarters]) - QUARTERS[quarters]
        self.most = np.zeros(self.empty + 1, np.int64)
        self.most[:-1] = most

    @staticmethod
    def built(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> tuple[int, bytes, bytes]:
        """Height, packed quarters and packed differences of a filled grid."""
        height = int(max(rows.max(), columns.max())).bit_length()
        code = _spread(rows) << np.uint64(1) | _spread(columns)
        order = np.argsort(code, kind="stable")
        code, most = code[order], impacts[order].astype(np.int64)
        quarters, steps = [], []
        for _ in range(height):
            up = code >> np.uint64(2)
            head = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]]))
            above = np.maximum.reduceat(most, head)
            steps.append(np.repeat(above, np.diff(np.append(head, len(up)))) - most)
            quarters.append(np.bitwise_or.reduceat((1 << (code & np.uint64(3)).astype(np.int64)).astype(np.uint8), head))
            code, most = up[head], above
        steps.append(most)
        bits = np.concatenate(quarters[::-1]) if quarters else np.empty(0, np.uint8)
        bits = np.append(bits, np.zeros(len(bits) % 2, np.uint8))
        return height, _squeeze(bits[0::2] | bits[1::2] << 4), _squeeze(np.concatenate(steps[::-1]).astype("<u4"))

    @classmethod
    def opened(cls, height: int, quarters: bytes, steps: bytes) -> Treap:
        pairs, step = _expand(quarters, "u1"), _expand(steps, "<u4").astype(np.int64)
        bits = np.stack([pairs & 15, pairs >> 4], axis=1).ravel()
        most, at, size = step, 0, 1
        for _ in range(height):
            children = QUARTERS[bits[at:at + size]]
            below = int(children.sum())
            most[at + size:at + size + below] = np.repeat(most[at:at + size], children) - step[at + size:at + size + below]
            at, size = at + size, below
        return cls(height, bits[:at], most)

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int,
             batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores, among them all of the k best columns with a
        score of ``least`` or more."""
        cells = np.zeros((1, len(rows)), np.int64)
        level, column = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = self.most[cells] @ weights
        found, scores = [], np.empty(0, np.int64)
        if not self.height:
            return column[bound >= least], bound[bound >= least]
        while len(bound):
            if len(bound) > batch:
                order = np.argpartition(-bound, batch - 1)
                now, later = order[:batch], order[batch:]
            else:
                now, later = slice(None), slice(0, 0)
            down, own, where = level[now], cells[now], column[now]
            bits, first = self.quarters[own], self.first[own]
            high = (rows[None, :] >> (self.height - 1 - down)[:, None] & 1) << 1
            cells, level, column, bound = cells[later], level[later], column[later], bound[later]
            for half in (0, 1):
                quarter = high | half
                child = np.where(bits >> quarter & 1, first + BEFORE[bits, quarter], self.empty)
                limit = self.most[child] @ weights
                live = limit >= least
                last = live & (down == self.height - 1)
                if last.any():
                    found.append(2 * where[last] + half)
                    scores = np.concatenate([scores, limit[last]])
                live &= ~last
                if live.any():
                    cells = np.concatenate([cells, child[live]])
                    level = np.concatenate([level, down[live] + 1])
                    column = np.concatenate([column, 2 * where[live] + half])
                    bound = np.concatenate([bound, limit[live]])
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                if len(bound) and bound.min() < least:
                    live = bound >= least
                    cells, level, column, bound = cells[live], level[live], column[live], bound[live]
        return (np.concatenate(found) if found else np.empty(0, np.int64)), scores


def terms_of(column: pa.Array) -> Words:
    return Words(*text_buffer(column), lower=True, gap=GAP)


def totals(docs: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """N (documents with a term) and L (all terms)."""
    def run(batches):
        n = total = 0
        for chunk in chunks(batches, "text", block_bytes):
            sizes = np.diff(terms_of(chunk.column(0)).first)
            n, total = n + int((sizes > 0).sum()), total + int(sizes.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "total"])

    row = (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "n bigint, total bigint")
           .agg(F.sum("n"), F.sum("total")).first())
    return row[0] or 0, row[1] or 0


def impact(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    m = 100 - SHARE + SHARE * n * docs // total
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def grid(words: Words, docs: int, total: int) -> dict | None:
    """A block of texts as row names and counts, column places and the treap."""
    if not len(words.name):
        return None
    sizes = np.diff(words.first)
    names, term = np.unique(words.name, return_inverse=True)
    code, tf = np.unique(term * np.int64(len(sizes)) + words.text_of(), return_counts=True)
    term, doc = np.divmod(code, len(sizes))
    held = np.bincount(term)
    order = np.argsort(-held, kind="stable")
    row_of = np.empty(len(names), np.int64)
    row_of[order] = np.arange(len(names))
    rows = row_of[term]
    common = np.full(len(sizes), len(names))
    np.minimum.at(common, doc, rows)
    place = np.lexsort((sizes, common))[:int((sizes > 0).sum())]
    column_of = np.zeros(len(sizes), np.int64)
    column_of[place] = np.arange(len(place))
    height, quarters, steps = Treap.built(rows, column_of[doc], impact(tf.astype(np.int64), sizes[doc], docs, total))
    # Rows are found by name: names in order, and the row of each.
    return {"names": _squeeze(np.diff(names, prepend=np.uint64(0))), "rows": _squeeze(row_of.astype("<u4")),
            "held": _squeeze(held.astype("<u4")), "place": place,
            "height": height, "quarters": quarters, "steps": steps}


INDEX = "names binary, rows binary, held binary, ids binary, known binary, height int, quarters binary, steps binary"


def index(docs: DataFrame, n_docs: int, total: int, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index: a row per block of documents."""
    def run(batches):
        for chunk in chunks(batches, "text", block_bytes):
            own = grid(terms_of(chunk.column(1)), n_docs, total)
            if own is None:
                continue
            ids = chunk.column(0).take(pa.array(own.pop("place")))
            own |= {"ids": _squeeze(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")),
                    "known": _squeeze(ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8))}
            yield pa.RecordBatch.from_pylist(
                [{k: own[k] for k in ("names", "rows", "held", "ids", "known", "height", "quarters", "steps")}],
                schema=pa.schema([(k, pa.int32() if k == "height" else pa.binary()) for k in
                                  ("names", "rows", "held", "ids", "known", "height", "quarters", "steps")]))

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, INDEX))


def _found(names: bytes, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a block's names among which ``asked`` (in order) are, and
    which of the asked these are."""
    own = np.cumsum(_expand(names, "<u8"), dtype=np.uint64)
    at = np.minimum(np.searchsorted(own, asked), len(own) - 1)
    hit = np.flatnonzero(own[at] == asked)
    return at[hit], hit


def document_frequencies(blocks: DataFrame, asked: np.ndarray) -> np.ndarray:
    """Documents that hold each of the names ``asked`` (in order)."""
    def run(batches):
        total = np.zeros(len(asked), np.int64)
        for batch in batches:
            for names, held in zip(batch.column(0), batch.column(1)):
                at, hit = _found(names.as_py(), asked)
                total[hit] += _expand(held.as_py(), "<u4")[at]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["term", "n"])

    out = np.zeros(len(asked), np.int64)
    # As many rows as the items of a block have terms.
    for term, n in (blocks.select("names", "held").mapInArrow(run, "term bigint, n bigint")
                    .groupBy("term").agg(F.sum("n")).collect()):
        out[term] = n
    return out


def weight(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def _kept(score: np.ndarray, doc: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    best = np.lexsort((doc, ~known, -score))[:k]
    return score[best], doc[best], known[best]


def answers(blocks: DataFrame, items: list[tuple], n_docs: int, k: int) -> DataFrame:
    """q, item_id, doc_id, score: per task its best documents for each item.
    ``items``: (q, item_id, distinct term names)."""
    asked = np.unique(np.concatenate([names for _, _, names in items]))
    df = document_frequencies(blocks, asked)
    weights = np.where(df > 0, weight(df, n_docs), 0)
    terms = [(at := np.searchsorted(asked, names))[weights[at] > 0] for _, _, names in items]

    def run(batches):
        none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        best = [none] * len(items)
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                at, hit = _found(block["names"], asked)
                row = np.full(len(asked), -1, np.int64)
                row[hit] = _expand(block["rows"], "<u4")[at]
                ids, known = _expand(block["ids"], "<i8"), _expand(block["known"], "u1").astype(bool)
                tree = Treap.opened(block["height"], block["quarters"], block["steps"])
                for j, own in enumerate(terms):
                    own = own[row[own] >= 0]
                    if not len(own):
                        continue
                    score, doc, sure = best[j]
                    column, more = tree.best(row[own], weights[own], k, max(int(score[k - 1]) if len(score) == k else 1, 1))
                    if len(column):
                        best[j] = _kept(np.concatenate([score, more]), np.concatenate([doc, ids[column]]),
                                        np.concatenate([sure, known[column]]), k)
        for (q, item, _), (score, doc, sure) in zip(items, best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(score), pa.int64()), pa.array([item] * len(score), pa.int64()),
                     pa.array(doc, pa.int64(), mask=~sure), pa.array(score, pa.int64())],
                    names=["q", "item_id", "doc_id", "score"])

    return blocks.mapInArrow(run, "q bigint, item_id bigint, doc_id bigint, score bigint")


def asked_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """q, item_id and the distinct names of its terms, for items with terms."""
    def run(batches):
        for chunk in chunks(batches, "text"):
            words = terms_of(chunk.column(2))
            names = [np.unique(words.name[a:b]).tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays([chunk.column(0), chunk.column(1), pa.array(names, pa.binary())],
                                             names=["q", "item_id", "names"])

    return (items.select(F.monotonically_increasing_id().alias("q"), F.col(id_col).cast("bigint").alias("item_id"),
                         F.col(text_col).alias("text"))
            .mapInArrow(run, "q bigint, item_id bigint, names binary").filter(F.length("names") > 0))


def search(blocks: DataFrame, items: DataFrame, n_docs: int, id_col: str = "item_id", text_col: str = "text",
           k: int = K, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each item, over
    a staged ``index``. Items pass in blocks; each block's answers are staged."""
    asked = stage(asked_items(items, id_col, text_col), "treap-items")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    parts, held = [], []

    def answer():
        parts.append(stage(answers(blocks, held, n_docs, k)
                           .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                           .select("item_id", "rank", "doc_id", "score"), "treap-answers"))
        held.clear()

    for q, item, names in asked.toLocalIterator():
        held.append((q, item, np.frombuffer(names, np.uint64)))
        if len(held) == block_items:
            answer()
    if held:
        answer()
    if not parts:
        return blocks.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rank(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES,
         block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The k best documents of each item, with an index built for the call."""
    n_docs, total = totals(docs, block_bytes=block_bytes)
    blocks = stage(index(docs, n_docs, total, block_bytes=block_bytes), "treap-index")
    return search(blocks, items, n_docs, k=k, block_items=block_items)


TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
DIGEST_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, {LOWER}), '{TERMS}') AS ts FROM documents),
sized AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM texts WHERE len(ts) > 0),
totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS total FROM sized),
items AS (
  SELECT q, item_id, unnest(list_distinct(regexp_extract_all(translate(text, {LOWER}), '{TERMS}'))) AS term
  FROM (SELECT row_number() OVER () AS q, * FROM benchmark)),
held AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, n, unnest(ts) AS term FROM sized)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * (SELECT nd FROM totals) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held GROUP BY term),
impacts AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // total)) AS impact
  FROM held, totals),
scores AS (
  SELECT q, item_id, r, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM items JOIN impacts USING (term) JOIN weights USING (term) GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= {K}
"""
