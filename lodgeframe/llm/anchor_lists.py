"""Hard-negative mining over lists that clusters of anchors share.

Each vector component becomes the integer floor(256 * x); a score is an inner
product of such vectors. Anchors are clustered by angle. For a cluster and a
block of rows, the rows are sorted once by an upper bound of their score with
any member of the cluster: the row's length times the cosine of its angle from
the cluster's centre less the widest angle of a member (times the member's own
length). Every member walks that one list from the top, some hundred rows at a
time, all members together, and stops when the bound of what is left is below
what it holds: the result is certified, not guessed.

A first walk finds each anchor's positives, its best rows of the same label; a
second finds, per positive, the best rows of other labels whose score lies
between 50 % and 95 % of the positive's. A member stops in the second walk when
for each of its positives the bound falls below the window, or below the last
of the negatives it needs.

Shape of the job: rows are dealt into blocks and staged once, a row of arrays
per block. Anchors go in rounds of bounded size; a round's anchors are
clustered in one task and stored in the shared folder, where every task maps
them. A task walks its blocks one after another and carries what each anchor of
the round holds, so later blocks stop early, and gives a few rows per anchor.
Rows are thus read once a round and never copied per anchor.

Scores are sums of float64 products while those stay exact (below 2**46), else
of Python integers; a score beyond 64 bits raises OverflowError.

Edge cases: rows whose id, label or vector is null, or with a null, NaN or
infinite component, take no part; rows equal in id, label and vector count
once; an anchor meets no row of its own id; only vectors of one length meet; a
zero vector scores 0 with all. Negative positives have an empty window.
Anchors without positives give nothing. Ties go to the smaller id. An empty
table gives an empty result. Extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.llm.shared_arrays import load, save
from lodgeframe.llm.staging import stage
from lodgeframe.session import scratch_path

SCALE = 256.0
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
CHANGED_EVERY, LABELS = 7, 10
BLOCK_ROWS = 16_384
ROUND = 65_536
STEP = 512
SAMPLE = 8_192
# Products with 100 stay exact as well below this.
EXACT = float(2**46)


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
          label_col: str = "label") -> DataFrame:
    """vec_id, label, dims, code (integers as float64) of the rows that take part, once each."""
    def run(batches):
        for batch in batches:
            kept, out, dims = [], [], []
            for i, v in enumerate(batch.column(2)):
                if not v.is_valid or v.values.null_count:
                    continue
                # Integers of this size and below are doubles, so nothing is lost.
                x = np.floor(SCALE * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all():
                    kept.append(i)
                    out.append((x + 0.0).tobytes())
                    dims.append(len(x))
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at),
                                              pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                                             names=["vec_id", "label", "dims", "code"])

    narrow = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"),
                            F.col(vector_col).alias("v")).filter("vec_id IS NOT NULL AND label IS NOT NULL")
    return narrow.mapInArrow(run, "vec_id bigint, label bigint, dims int, code binary").dropDuplicates()


def row_blocks(coded: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per block: dims, ids, labels, codes."""
    spark = coded.sparkSession
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(least, -(-coded.count() // block_rows))

    def run(batches):
        held, size = [], 0

        def blocks():
            table = pa.Table.from_batches(held)
            dims = table.column("dims").to_numpy()
            for d in np.unique(dims).tolist():
                own = table.filter(pa.array(dims == d))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d], pa.int32()), pa.array([own.column("vec_id").to_numpy().tobytes()]),
                     pa.array([own.column("label").to_numpy().tobytes()]),
                     pa.array([b"".join(own.column("code").to_pylist())])], names=["dims", "ids", "labels", "codes"])

        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                held.append(part)
                size += part.num_rows
                if size >= block_rows:
                    yield from blocks()
                    held, size = [], 0
        if size:
            yield from blocks()

    return (coded.repartition(tasks, F.xxhash64("vec_id", "code"))
            .mapInArrow(run, "dims int, ids binary, labels binary, codes binary"))


def clustered(matrix: np.ndarray, n: int, sample: int = SAMPLE, turns: int = 6) -> np.ndarray:
    """The cluster of each row, by angle. Centres are fitted on at most
    ``sample`` rows; every row is then given to the centre nearest to it."""
    length = np.linalg.norm(matrix, axis=1)
    unit = matrix / np.where(length > 0, length, 1)[:, None]
    fit = unit[np.linspace(0, len(unit) - 1, min(sample, len(unit))).astype(int)]
    centre = fit[np.linspace(0, len(fit) - 1, n).astype(int)]
    for _ in range(turns):
        near = (fit @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, fit)
        size = np.linalg.norm(total, axis=1)
        centre = np.where(size[:, None] > 0, total / np.where(size > 0, size, 1)[:, None], centre)
    return np.concatenate([(unit[a:a + 4096] @ centre.T).argmax(axis=1) for a in range(0, len(unit), 4096)])


def store_anchors(coded: DataFrame, folder: str, every: int = EVERY, round_rows: int = ROUND) -> list[tuple[int, int]]:
    """Write the anchors' arrays to ``folder``, by round; (dims, round) pairs."""
    asked = coded.filter(F.col("vec_id") % every == 0)
    rounds = max(1, -(-asked.count() // round_rows))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["vec_id", "label", "code"])
        dims, own = int(frame["dims"].iloc[0]), int(frame["round"].iloc[0])
        matrix = np.frombuffer(b"".join(frame["code"]), "<f8").reshape(len(frame), dims)
        group = clustered(matrix, max(1, int(len(frame) ** 0.5)))
        order = np.argsort(group, kind="stable")
        name = f"{dims}-{own}"
        save(folder, f"{name}-codes", matrix[order])
        save(folder, f"{name}-ids", frame["vec_id"].to_numpy(np.int64)[order])
        save(folder, f"{name}-labels", frame["label"].to_numpy(np.int64)[order])
        save(folder, f"{name}-ends", np.cumsum(np.bincount(group)))
        return pd.DataFrame({"dims": [dims], "round": [own]})

    dealt = asked.withColumn("round", F.pmod(F.xxhash64("vec_id", "label", "code"), F.lit(rounds)))
    return sorted((r.dims, r.round) for r in stage(
        dealt.groupBy("dims", "round").applyInPandas(run, "dims int, round bigint"), "anchor-rounds").collect())


class Lists:
    """A block's rows in the order of each cluster of a round."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, ends: np.ndarray):
        self.anchors, self.ends = anchors, ends
        self.exact = rows.shape[1] * np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) < EXACT
        self.rows = rows if self.exact else _integers(rows)
        self.length = np.linalg.norm(rows, axis=1)
        self.unit = rows / np.where(self.length > 0, self.length, 1)[:, None]

    def __iter__(self):
        """(first, end) of a cluster's members, the list, the bound per row of
        the list for a member of length 1, and the members' lengths."""
        start = 0
        for end in self.ends.tolist():
            if end > start:
                own = self.anchors[start:end]
                size = np.linalg.norm(own, axis=1)
                unit = own / np.where(size > 0, size, 1)[:, None]
                centre = unit.sum(axis=0)
                centre = centre / (np.linalg.norm(centre) or 1)
                wide = np.arccos(np.clip(unit @ centre, -1, 1)).max()
                if not size.all():  # a zero vector has no angle; its bound is 0
                    wide = max(wide, np.pi)
                angle = np.arccos(np.clip(self.unit @ centre, -1, 1))
                # A little more than the bound, for the rounding above.
                bound = self.length * (np.cos(np.maximum(angle - wide, 0)) + 1e-6) + 1e-6
                order = np.argsort(-bound, kind="stable")
                yield start, end, order, bound[order], size
            start = end

    def scores(self, members: np.ndarray, at: np.ndarray) -> np.ndarray:
        own = self.anchors[members]
        return self.rows[at] @ own.T if self.exact else self.rows[at] @ _integers(own).T


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)


class Holders:
    """Up to ``k`` rows for each of ``n`` holders: best scores, then least ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def last(self, at) -> np.ndarray:
        return self.score[at, self.k - 1]

    def offer(self, holder: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(holder):
            return
        if score.dtype == object and self.score.dtype != object:
            self.score = self.score.astype(object)
        who = np.unique(holder)
        every = np.concatenate([np.repeat(who, self.k), holder])
        points = np.concatenate([self.score[who].ravel(), score])
        names = np.concatenate([self.id[who].ravel(), ids])
        order = np.lexsort((names, -points, every))
        every, points, names = every[order], points[order], names[order]
        first = np.searchsorted(every, who)
        pick = first[:, None] + np.arange(self.k)
        self.score[who], self.id[who] = points[pick], names[pick]


def _longs(values) -> pa.Array:
    return pa.array([int(v) for v in values], pa.int64())


def walk(blocks: DataFrame, folder: str, dims: int, own_round: int, positives: bool, k: int, low: int, high: int,
         step: int = STEP, most_positives: int = POSITIVES) -> DataFrame:
    """(anchor, slot, vec_id, score) of a round: what each task found."""
    name = f"{dims}-{own_round}"

    def run(batches):
        anchors, own_ids, own_labels, ends = (np.asarray(load(folder, f"{name}-{x}")) for x in
                                              ("codes", "ids", "labels", "ends"))
        slots = 1
        if not positives:
            goal = np.asarray(load(folder, f"{name}-positives"))
            slots = goal.shape[1]
        held = Holders(len(anchors) * slots, k)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in (1, 2))
                rows = np.frombuffer(batch.column(3)[i].as_py(), "<f8").reshape(len(ids), dims)
                lists = Lists(rows, anchors, ends)
                for first, end, order, bound, size in lists:
                    active = np.arange(first, end)
                    for at in range(0, len(order), step):
                        limit = bound[at] * size[active - first]
                        if positives:
                            go = held.last(active) <= limit
                        else:
                            spots = active[:, None] * slots + np.arange(slots)
                            aim = goal[active].astype(float)
                            # An empty window, or none (NaN), never goes on.
                            go = ((aim >= 0) & (low * aim <= 100 * limit[:, None])
                                  & (held.last(spots) <= limit[:, None])).any(axis=1)
                        active = active[go]
                        if not len(active):
                            break
                        at = order[at:at + step]
                        score = lists.scores(active, at)
                        same = labels[at][:, None] == own_labels[active]
                        if positives:
                            r, a = np.nonzero(same & (ids[at][:, None] != own_ids[active]) & (score >= held.last(active)))
                            held.offer(active[a], score[r, a], ids[at][r])
                        else:
                            for s in range(slots):
                                aim, spot = goal[active, s], active * slots + s
                                aim = aim if lists.exact else aim.astype(object)
                                fits = ~same & (aim >= 0) & (low * aim <= 100 * score) & (100 * score <= high * aim)
                                r, a = np.nonzero(fits & (ids[at][:, None] != own_ids[active]) & (score >= held.last(spot)))
                                held.offer(spot[a], score[r, a], ids[at][r])
        spot, n = np.nonzero(held.score != -np.inf)
        if len(spot):
            yield pa.RecordBatch.from_arrays(
                [pa.array(spot // slots, pa.int64()), pa.array(spot % slots, pa.int64()),
                 _longs(held.id[spot, n]), _longs(held.score[spot, n])], names=["anchor", "slot", "vec_id", "score"])

    return (blocks.filter(F.col("dims") == dims).mapInArrow(run, "anchor bigint, slot bigint, vec_id bigint, score bigint")
            .select(F.lit(dims).alias("dims"), F.lit(own_round).cast("bigint").alias("round"),
                    "anchor", "slot", "vec_id", "score"))


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mine(coded: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS, round_rows: int = ROUND,
         step: int = STEP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score over ``codes``: for rows whose id is divisible by ``every``."""
    spark = coded.sparkSession
    coded = stage(coded, "anchor-codes")
    folder = scratch_path(spark, "anchor-arrays")
    rounds = store_anchors(coded, folder, every, round_rows)
    if not rounds:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    blocks = stage(row_blocks(coded, block_rows), "anchor-blocks")
    best = _best(_union([walk(blocks, folder, d, r, True, positives, low, high, step) for d, r in rounds]),
                 ["dims", "round", "anchor"], positives)
    found = stage(best.withColumnRenamed("vec_id", "positive_id").withColumnRenamed("score", "positive_score"),
                  "anchor-positives")

    def goals(frame: pd.DataFrame) -> pd.DataFrame:
        name = f"{frame['dims'].iloc[0]}-{frame['round'].iloc[0]}"
        ids = np.asarray(load(folder, f"{name}-ids"))
        goal = np.full((len(ids), positives), -1, np.int64)
        goal[frame["anchor"], frame["rank"] - 1] = frame["positive_score"]
        save(folder, f"{name}-positives", goal)
        return pd.DataFrame({"dims": frame["dims"], "round": frame["round"], "anchor": frame["anchor"],
                             "slot": frame["rank"].astype("int64") - 1, "positive_id": frame["positive_id"],
                             "positive_score": frame["positive_score"], "anchor_id": ids[frame["anchor"]]})

    known = stage(found.groupBy("dims", "round").applyInPandas(
        goals, "dims int, round bigint, anchor bigint, slot bigint, positive_id bigint, positive_score bigint, "
               "anchor_id bigint"), "anchor-goals")
    held = sorted((r.dims, r.round) for r in known.select("dims", "round").distinct().collect())
    if not held:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    hard = _best(_union([walk(blocks, folder, d, r, False, negatives, low, high, step) for d, r in held]),
                 ["dims", "round", "anchor", "slot"], negatives)
    return (known.join(hard, ["dims", "round", "anchor", "slot"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def changed_labels(coded: DataFrame, every: int = CHANGED_EVERY, labels: int = LABELS) -> DataFrame:
    """Where the id is divisible by ``every``, the next label."""
    return coded.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels)
                            .otherwise(F.col("label")))


def hard_negatives(vectors: DataFrame, **options) -> DataFrame:
    # Rows that become equal by their new labels count once too.
    return mine(changed_labels(codes(vectors)).dropDuplicates(), **options)


DIGEST_SQL = f"""
WITH codes AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % {CHANGED_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT *, row_number() OVER () AS a FROM codes),
scores AS (
  SELECT q.a, q.vec_id AS anchor_id, r.vec_id, q.label = r.label AS same,
         CAST(list_inner_product(q.c, r.c) AS BIGINT) AS score
  FROM numbered q JOIN numbered r ON q.vec_id % {EVERY} = 0 AND r.vec_id <> q.vec_id AND len(q.c) = len(r.c)),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS n FROM scores WHERE same)
  WHERE n <= {POSITIVES}),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.n ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scores s ON p.a = s.a AND NOT s.same
   AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= {NEGATIVES}
"""
