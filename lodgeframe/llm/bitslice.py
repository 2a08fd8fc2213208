"""Exact top-k search over a bit-sliced index.

Each vector component becomes the integer floor(256 * x). Rows are dealt into
blocks by hash; within a block the index holds, for each attribute, the bits
of its quantised distance from the attribute's least value (and from its
greatest, for negative query weights) as bitmaps over the rows. A query's
scores are added up with bitmap arithmetic: for each set bit of a query
weight, the attribute's slices are added to the sum's slices, shifted. The
top rows are selected from the most significant slice downward. The
quantisation drops ``DROPPED`` low bits, so rows whose sum comes within the
error bound of the k-th exact score are boundary rows; these few are found by
a bit-sliced comparison and resolved with exact inner products.

Blocks of queries meet blocks of rows, both of bounded size, in a cogroup;
each pair of blocks yields at most k rows per query, ranked at the end. The
index covers every row; nothing is sampled.

Edge cases: vectors that are null, or hold null or non-finite components, and
rows without an id take no part; only vectors of equal length are compared;
empty vectors score 0. Scores are 64-bit sums: a component of 2**31 or more
(after scaling), or a block and a query whose products could sum beyond 2**63,
raises OverflowError, so no score is ever wrapped around. Rows with equal id and vector count once; a query meets
no row of its own id. Ties go to the smaller id. An empty table gives an empty
result; extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.llm.staging import stage

SCALE = 256.0
K = 5
EVERY = 50
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 64
DROPPED = 2
LARGEST = 2.0**31


def codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, dims, code (little-endian 64-bit integers) of the rows that take part."""
    def run(batches):
        for batch in batches:
            ids, out, dims = [], [], []
            for ident, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if ident is None or not v.is_valid:
                    continue
                values = v.values
                if values.null_count:
                    continue
                x = np.floor(SCALE * values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all():
                    if (np.abs(x) >= LARGEST).any():
                        raise OverflowError(f"vector {ident} has a component beyond {LARGEST / SCALE:.0f}")
                    ids.append(ident)
                    out.append(x.astype("<i8").tobytes())
                    dims.append(len(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                names=["vec_id", "dims", "code"])

    narrow = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))
    return narrow.mapInArrow(run, "vec_id bigint, dims int, code binary").dropDuplicates()


def _bitmaps(values: np.ndarray, bits: int) -> np.ndarray:
    """[bit, words] bitmaps over the rows of non-negative integers."""
    rows = np.zeros((bits, -(-len(values) // 64) * 64), np.uint8)
    for b in range(bits):
        rows[b, :len(values)] = (values >> b) & 1
    return np.packbits(rows, axis=1, bitorder="little").view(np.uint64)


class SlicedBlock:
    """The index of one block of rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, dropped: int = DROPPED):
        self.ids, self.rows, self.dropped = ids, rows, dropped
        self.low, self.high = rows.min(axis=0), rows.max(axis=0)
        width = [max(int(h - l) >> dropped, 0).bit_length() for l, h in zip(self.low, self.high)]
        self.up = [_bitmaps((rows[:, d] - self.low[d]) >> dropped, w) for d, w in enumerate(width)]
        self.down = [_bitmaps((self.high[d] - rows[:, d]) >> dropped, w) for d, w in enumerate(width)]
        self.all = _bitmaps(np.ones(len(ids), np.int64), 1)[0]

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """Slices of the sum of |weight| * quantised distance, least first."""
        most = sum(abs(int(w)) * (int(h - l) >> self.dropped)
                   for w, l, h in zip(weights, self.low, self.high))
        total = np.zeros((most.bit_length() + 1, len(self.all)), np.uint64)
        for d, w in enumerate(weights.tolist()):
            slices, left = (self.up[d] if w > 0 else self.down[d]), abs(w)
            at = 0
            while left and len(slices):
                if left & 1:
                    _add(total, slices, at)
                left >>= 1
                at += 1
        return total

    def top(self, weights: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those of the id ``own``."""
        live = self.all & ~_bitmaps((self.ids == own).astype(np.int64), 1)[0]
        count = int(np.bitwise_count(live).sum())
        if not count:
            return self.ids[:0], self.ids[:0]
        total = self.sums(weights)
        if count > k:
            first = _rows(_select(total, live, k), len(self.ids))
            kth = np.sort(self.rows[first] @ weights)[-k]
            # score = sum * 2**dropped + base + error, error in [0, most].
            base = int(sum(int(w) * int(self.low[d] if w > 0 else self.high[d])
                           for d, w in enumerate(weights.tolist())))
            most = int(np.abs(weights).sum()) * ((1 << self.dropped) - 1)
            least = -((-(int(kth) - base - most)) >> self.dropped)
            live = _at_least(total, live, max(least, 0))
        at = _rows(live, len(self.ids))
        score = self.rows[at] @ weights
        best = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at][best], score[best]


def _add(total: np.ndarray, slices: np.ndarray, at: int) -> None:
    """total += slices << at, by ripple carry."""
    a = total[at]
    carry = a & slices[0]
    a ^= slices[0]
    for i in range(1, len(slices)):
        a, s = total[at + i], slices[i]
        half = a ^ s
        both = a & s
        np.bitwise_xor(half, carry, out=a)
        carry = both | (half & carry)
    i = at + len(slices)
    while i < len(total) and carry.any():
        a = total[i]
        both = a & carry
        a ^= carry
        carry = both
        i += 1


def _select(total: np.ndarray, live: np.ndarray, k: int) -> np.ndarray:
    """At least k rows of the greatest sums: more only if equal ones tie."""
    sure, maybe = np.zeros_like(live), live
    for s in total[::-1]:
        ones = maybe & s
        n = int(np.bitwise_count(sure | ones).sum())
        if n > k:
            maybe = ones
        else:
            sure, maybe = sure | ones, maybe & ~s
            if n == k:
                return sure
    return sure | maybe


def _at_least(total: np.ndarray, live: np.ndarray, least: int) -> np.ndarray:
    """Rows whose sum is ``least`` or more."""
    if least.bit_length() > len(total):
        return np.zeros_like(live)
    above, equal = np.zeros_like(live), live
    for b in range(len(total) - 1, -1, -1):
        if least >> b & 1:
            equal = equal & total[b]
        else:
            above, equal = above | (equal & total[b]), equal & ~total[b]
    return above | equal


def _rows(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:n])


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = EVERY,
          k: int = K, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for rows whose id is divisible by
    ``every``, the k best others."""
    coded = stage(codes(vectors, id_col, vector_col), "bitslice-codes")
    asks = coded.filter(F.col("vec_id") % every == 0)
    row_blocks = max(1, -(-coded.count() // block_rows))
    ask_blocks = max(1, -(-asks.count() // block_queries))
    dealt = F.xxhash64("vec_id", "code")
    # Every block of queries meets every block of rows, once each.
    rows = (coded.withColumn("rb", F.pmod(dealt, F.lit(row_blocks)))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1)))))
    asked = (asks.withColumn("qb", F.pmod(dealt, F.lit(ask_blocks)).cast("int"))
             .withColumn("rb", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                    F.lit(row_blocks - 1).cast("bigint")))))

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        found = ([], [], [])
        if queries.num_rows and block.num_rows:
            ids = block.column("vec_id").to_numpy()
            dims = block.column("dims")[0].as_py()
            matrix = np.frombuffer(b"".join(block.column("code").to_pylist()), "<i8").reshape(len(ids), dims)
            index, top = SlicedBlock(ids, matrix), int(np.abs(matrix).max(initial=0))
            for own, code in zip(queries.column("vec_id").to_pylist(), queries.column("code").to_pylist()):
                # Sums of differences from the least values are up to twice as large.
                if 2 * top * int(np.abs(np.frombuffer(code, "<i8")).sum()) >= 1 << 63:
                    raise OverflowError(f"scores of vector {own} do not fit 64 bits")
                best, score = index.top(np.frombuffer(code, "<i8"), own, k)
                found[0].extend([own] * len(best))
                found[1].extend(best.tolist())
                found[2].extend(score.tolist())
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), found)})

    best = (asked.groupBy("qb", "rb", "dims").cogroup(rows.groupBy("qb", "rb", "dims"))
            .applyInArrow(run, "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


DIGEST_SQL = f"""
WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.c AS DOUBLE[]), CAST(r.c AS DOUBLE[])) AS BIGINT) AS score
  FROM codes q JOIN codes r ON q.vec_id % {EVERY} = 0 AND r.vec_id <> q.vec_id AND len(q.c) = len(r.c))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= {K}
"""
