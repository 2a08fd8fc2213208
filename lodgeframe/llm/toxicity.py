"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features per whole text, computed in one pass over its bytes: densities of a
short insult list and of a lexicon learned from labelled rows (plain, and
after undoing digit and sign substitutions), the log-odds weights of the
learned lexicon, second-person words and insults near them, capitals,
punctuation, signs inside words, digits and lengths.

Training uses a bounded sample: about ``per_class`` labelled documents of each
class, drawn by hash. Two fifths of it learn the lexicon, nine twentieths the trees, the
rest the isotonic calibration, so no part is scored on what it was fitted
to. Trees and calibration are Spark ML's; every document is then scored by
the JVM, with one Python pass for the features and no shuffle.

Edge cases: a null or empty text gets the features of an empty one; labels
without a document, and null labels, teach nothing; an id labelled more than
once counts once, as toxic if any label says so, and teaches the least of its
texts if documents share it. A null id is not held out and has no label. Without
labelled rows of both classes every score is the share of class 1 (0 if there
is none). Extra columns are ignored.
"""
from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.staging import stage
from lodgeframe.llm.words import LETTER, Words, chunks, cores, names_between, names_of, text_buffer

PER_CLASS = 3000
LEXICON_WORDS = 400
LEAST_TEXTS = 4
LEAST_ODDS = 1.5
NEAR = 4
TREES = 30
DEPTH = 4
CUT = 0.3

INSULTS = ("idiot idiots moron morons stupid scum trash loser losers clown clowns disgusting worthless "
           "pathetic dumb fool ugly garbage hate filthy shut kill").split()
YOU = ("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre "
       "usted ustedes ti tus vosotros").split()

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
for _from, _to in zip(b"013457@$!|", b"oieastasii"):
    _PLAIN[_from] = _to
_WORDLIKE = LETTER.copy()
_WORDLIKE[48:58] = True
_WORDLIKE[[ord("@"), ord("$")]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*b".,;:!?'\"()-"]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*b"#*$%&@^~_|<>=+\\/"]] = True

FEATURES = ("words", "insults", "insult_rate", "learned", "learned_rate", "odds", "odds_rate", "top_odds",
            "masked", "you_rate", "near_you", "capitals", "shouted", "punctuation", "exclaimed",
            "asked", "signs", "inner_signs", "digits", "mean_length")


def held_out(ident: Column, parts: int = 4, part: int = 2) -> Column:
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % parts == part


def learn_lexicon(toxic: list[str], clean: list[str], most: int = LEXICON_WORDS) -> dict[str, float]:
    """Words with the greatest smoothed log-odds of document frequency."""
    def texts_with(texts: list[str]) -> Counter:
        count: Counter = Counter()
        for t in texts:
            count.update({c for c in (w.strip(".,;:!?'\"()-#*$%&@^~_|<>=+\\/0123456789") for w in t.lower().split()) if c})
        return count
    bad, good = texts_with(toxic), texts_with(clean)
    odds = {w: math.log((n + 0.5) / (len(toxic) - n + 0.5)) - math.log((good[w] + 0.5) / (len(clean) - good[w] + 0.5))
            for w, n in bad.items() if n >= LEAST_TEXTS}
    best = sorted(((o, w) for w, o in odds.items() if o >= LEAST_ODDS), reverse=True)[:most]
    return {w: o for o, w in best}


def _lookup(table: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each name is in the sorted table, and where."""
    if not len(table):
        return np.zeros(len(name), bool), np.zeros(len(name), np.int64)
    at = np.minimum(np.searchsorted(table, name), len(table) - 1)
    return table[at] == name, at


def dense(data: np.ndarray, bounds: np.ndarray, lexicon: dict[str, float]) -> np.ndarray:
    """[text, feature] for texts in one byte buffer."""
    w = Words(data, bounds, lower=True)
    start, end = cores(w)
    name = names_between(w.bytes, start, end)
    learned = names_of(list(lexicon))
    order = np.argsort(learned)
    learned, odds = learned[order], np.array(list(lexicon.values()))[order]
    listed = np.sort(names_of(INSULTS))
    bad, _ = _lookup(listed, name)
    hit, at = _lookup(learned, name)
    weight = np.where(hit, odds[at] if len(odds) else 0.0, 0.0)
    # Masked insults: digits and signs read as the letters they stand for.
    ws, we = cores(w, _WORDLIKE)
    plain = _PLAIN[w.bytes]
    changed = np.concatenate([[0], np.cumsum(plain[:len(data)] != w.bytes[:len(data)])])
    altered = np.flatnonzero(changed[np.maximum(we, ws)] > changed[ws])
    unmasked = names_between(plain, ws[altered], we[altered])
    masked = np.zeros(len(name), bool)
    masked[altered] = (_lookup(listed, unmasked)[0] | _lookup(learned, unmasked)[0]) & ~bad[altered] & ~hit[altered]
    you, _ = _lookup(np.sort(names_of(YOU)), name)
    insult = bad | hit | masked
    text = w.text_of()
    near = np.zeros(len(name), bool)
    for d in range(1, NEAR + 1):
        if len(text) > d:
            both = text[:-d] == text[d:]
            near[:-d] |= both & insult[:-d] & you[d:]
            near[d:] |= both & insult[d:] & you[:-d]
    letters_in = np.concatenate([[0], np.cumsum(LETTER[data])])
    upper_in = np.concatenate([[0], np.cumsum(_UPPER[data])])
    core = end - start
    upper = upper_in[end] - upper_in[start]
    inner = core - (letters_in[end] - letters_in[start])

    def per_text(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
        return total[w.first[1:]] - total[w.first[:-1]]

    def per_bytes(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind)])
        return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)

    n = np.diff(w.first).astype(float)
    words, size = np.maximum(n, 1), np.maximum(np.diff(bounds), 1)
    top = np.zeros(len(n))
    np.maximum.at(top, text, weight)
    listed_n, learned_n, total_odds = per_text(bad), per_text(hit), per_text(weight)
    letters = np.maximum(per_bytes(LETTER[data]), 1)
    return np.stack([
        np.log1p(n), np.log1p(listed_n), listed_n / words, np.log1p(learned_n), learned_n / words,
        np.log1p(total_odds), total_odds / words, top, per_text(masked), per_text(you) / words, per_text(near),
        per_bytes(_UPPER[data]) / letters, per_text((upper == core) & (core > 2)) / words,
        per_bytes(_PUNCT[data]) / size, per_bytes(data == 33) / size, per_bytes(data == 63) / size,
        per_bytes(_SIGN[data]) / size, per_text((inner > 0) & (core > 0)) / words, per_bytes(_DIGIT[data]) / size,
        letters / words], axis=1)


def with_features(docs: DataFrame, text_col: str, lexicon: dict[str, float]) -> DataFrame:
    """``docs`` with its texts replaced by ``features`` (array of doubles)."""
    rest = [c for c in docs.columns if c != text_col]
    fields = [docs.schema[c] for c in rest]

    def run(batches):
        for chunk in chunks(batches, text_col):
            x = dense(*text_buffer(chunk.column(chunk.schema.get_field_index(text_col))), lexicon)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()),
                                            pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(chunk.column(chunk.schema.get_field_index(c)) for c in rest), flat],
                names=[*rest, "features"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.select(*rest, text_col).mapInArrow(run, f"{schema}, features array<double>")


def draw_sample(docs: DataFrame, labels: DataFrame, rate: dict[int, float]) -> DataFrame:
    """label, text, part in [0, 1): rows of each class at its rate."""
    chance = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("label") == 1, rate[1]).otherwise(rate[0])
    # Ids are unique here: about 2 * per_class narrow rows, so broadcasting them is bounded.
    drawn = labels.filter(chance < share).select(
        F.col("doc_id").alias("labelled"), "label",
        (F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 30)) / float(1 << 30)).alias("part"))
    # An id that many documents share gives one text, so the sample stays bounded.
    return (docs.join(F.broadcast(drawn), docs["doc_id"] == F.col("labelled"))
            .groupBy("labelled").agg(F.min("label").alias("label"), F.min("part").alias("part"),
                                     F.min(F.coalesce("text", F.lit(""))).alias("text"))
            .select("label", "text", "part"))


def _constant(out: DataFrame, share: float, cut: float) -> DataFrame:
    return out.select("doc_id", "held_out", F.lit(share).alias("score"), F.lit(int(share >= cut)).alias("predicted"))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_class: int = PER_CLASS, trees: int = TREES, depth: int = DEPTH,
          cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted. Learns from labels not held out."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    labels = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    out = docs.withColumn("held_out", held_out(F.col("doc_id")))
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r[0]: r[1] for r in usable.groupBy("label").count().collect()}
    if len(counts) < 2:
        return _constant(out, float(1 in counts), cut)
    rate = {y: min(1.0, per_class / n) for y, n in counts.items()}
    drawn = stage(draw_sample(docs, usable, rate), "toxicity-sample")
    for_words = drawn.filter(F.col("part") < 0.4).select("label", "text").collect()
    lexicon = learn_lexicon([t for y, t in for_words if y == 1], [t for y, t in for_words if y == 0])
    rest = with_features(drawn.filter(F.col("part") >= 0.4), "text", lexicon)
    # A few thousand narrow rows: two partitions suit the many small passes.
    rest = stage(rest.coalesce(2), "toxicity-train").coalesce(2) \
        .withColumn("vector", array_to_vector("features")).withColumn("label", F.col("label").cast("double"))
    fitted = rest.filter(F.col("part") < 0.85).cache()
    both = {r[0] for r in fitted.select("label").distinct().collect()}
    if len(both) < 2:
        return _constant(out, float(both == {1.0}), cut)
    forest = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=4,
                           subsamplingRate=0.8, seed=3).fit(fitted)
    fitted.unpersist()
    graded = forest.transform(rest.filter(F.col("part") >= 0.85)) \
        .withColumn("raw", vector_to_array("probability")[1])
    # Classes were drawn at other rates than they occur: weigh them back.
    graded = graded.withColumn("weight", F.when(F.col("label") == 1, 1 / rate[1]).otherwise(1 / rate[0]))
    scored = forest.transform(with_features(out, "text", lexicon)
                              .withColumn("vector", array_to_vector("features"))) \
        .withColumn("raw", vector_to_array("probability")[1])
    if graded.isEmpty():
        final = scored.withColumn("score", F.col("raw"))
    else:
        level = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight",
                                   predictionCol="level").fit(graded)
        # The raw score orders what the calibration's steps leave equal.
        final = level.transform(scored).withColumn("score", F.col("level") * 0.99 + F.col("raw") * 0.01)
    return final.select("doc_id", "held_out", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score")) \
        .withColumn("predicted", (F.col("score") >= cut).cast("int"))
