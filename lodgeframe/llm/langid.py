"""Language identification of code-switched text by a linear-chain CRF.

Every word of a text gets a distribution over languages: emission scores sum
learned weights of its affixes, byte n-grams and its place in a lexicon, and
learned transitions tie neighbours; forward-backward over the whole text gives
the word marginals. A document's language is the one with the greatest sum of
marginals, and its score that language's share. ``label_spans`` gives the
words' own languages, a row per stretch of words with one language.

Training fits a classifier on a bounded sample: at most about ``per_label``
distinct texts of each label (drawn by their hash, whole texts), whatever the
number of labels and copies. Their texts are cut into segments of random length and
strung together across languages, so transitions are learned from text that
does switch; gradients of the chain's log-likelihood come from
forward-backward, steps from AdaGrad. Features are hashed into ``BUCKETS``
weights per label.

Labelling is one pass without a shuffle: a chunk's distinct words are scored
once, and the chain is run over blocks of ``BLOCK`` words side by side.
Transfer matrices of the blocks, multiplied along each text, give every
block's exact in- and outgoing messages, so long texts cost no more per word.
Beyond ``MANY_LABELS`` labels transfer matrices cost more than they save: texts
are run side by side whole, in chunks smaller by as much.

Edge cases: a text that is null or has no letter gives ``und`` with score 0;
so do all texts when no labelled row exists. A null id is not held out. Rows
with null labels teach nothing. Extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.words import CHUNK_BYTES, LETTER, Words, chunks, cores, mix, names_between, text_buffer

UNKNOWN = "und"
PER_LABEL = 120
MANY_LABELS = 64
BUCKETS = 1 << 16
BLOCK = 128
LONGEST = 24
PLACES = 1 << 14
SEGMENT = 24
ROUNDS = 5


def held_out(ident: Column, parts: int = 3, part: int = 1) -> Column:
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % parts == part


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Yields (words, bucket): prefixes and suffixes of one to three bytes, all
    two- and three-byte runs, and the word itself (the lexicon). Bytes come
    lower-cased. Words are in order; one beyond ``LONGEST`` bytes comes several
    times in a yield, ``PLACES`` at most at once."""
    size = end - start
    rows = np.arange(len(start))

    def bucket(kind: int, value: np.ndarray) -> np.ndarray:
        return (mix(value + np.uint64(kind << 56)) % np.uint64(BUCKETS)).astype(np.int64)

    def run(at: np.ndarray, n: int) -> np.ndarray:
        value = np.zeros(len(at), np.uint64)
        for j in range(n):
            value = value << np.uint64(8) | data[at + j].astype(np.uint64)
        return value

    yield rows, bucket(1, names_between(data, start, end))
    for n in (1, 2, 3):
        k = rows[size >= n]
        yield k, bucket(1 + n, run(start[k], n))
        yield k, bucket(4 + n, run(end[k] - n, n))
    short, long = rows[size <= LONGEST], rows[size > LONGEST]
    for n in (2, 3):
        for j in range(LONGEST):
            k = short[size[short] - n >= j]
            if not len(k):
                break
            yield k, bucket(8 + n, run(start[k] + j, n))
        places = np.concatenate([[0], np.cumsum(size[long] - n + 1)])
        for lo in range(0, int(places[-1]), PLACES):
            place = np.arange(lo, min(lo + PLACES, int(places[-1])))
            of = np.searchsorted(places, place, "right") - 1
            yield long[of], bucket(8 + n, run(start[long[of]] + place - places[of], n))


def emissions(weights: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Scores [word, label]: the mean weight over a word's features."""
    total = np.zeros((len(start), weights.shape[1]))
    count = np.zeros(len(start))
    for k, b in features(data, start, end):
        head = np.flatnonzero(np.diff(k, prepend=-1))
        if len(head) == len(k):
            total[k] += weights[b]
            count[k] += 1
        else:
            total[k[head]] += np.add.reduceat(weights[b], head, axis=0, dtype=float)
            count[k[head]] += np.diff(head, append=len(k))
    return total / np.maximum(count, 1)[:, None] ** 0.5


def _chain(score: np.ndarray, trans: np.ndarray):
    """Forward-backward over sequences [sequence, time, label] of one length:
    marginals and expected transition counts."""
    n, t, l = score.shape
    e = np.exp(score - score.max(axis=2, keepdims=True))
    a = np.exp(trans - trans.max())
    alpha, beta = np.empty_like(e), np.empty_like(e)
    alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, t):
        x = (alpha[:, i - 1] @ a) * e[:, i]
        alpha[:, i] = x / x.sum(axis=1, keepdims=True)
    beta[:, -1] = 1 / l
    for i in range(t - 2, -1, -1):
        x = (beta[:, i + 1] * e[:, i + 1]) @ a.T
        beta[:, i] = x / x.sum(axis=1, keepdims=True)
    m = alpha * beta
    m /= m.sum(axis=2, keepdims=True)
    pair = np.zeros((l, l))
    for i in range(t - 1):
        after = beta[:, i + 1] * e[:, i + 1]
        whole = ((alpha[:, i] @ a) * after).sum(axis=1, keepdims=True)
        pair += a * ((alpha[:, i] / whole).T @ after)
    return m, pair


def _word_ids(w: Words):
    """Per word its distinct core's number (-1 without letters), and the cores."""
    start, end = cores(w)
    has = end > start
    name = names_between(w.bytes, start[has], end[has])
    _, first, inverse = np.unique(name, return_index=True, return_inverse=True)
    ids = np.full(len(start), -1)
    ids[has] = inverse
    return ids, start[has][first], end[has][first]


def train(texts: list[str], labels: list[int], n_labels: int, rounds: int = ROUNDS,
          length: int = 64, batch: int = 128, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights [bucket, label] and transitions [label, label]."""
    rng = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    w = Words(np.frombuffer(b"".join(raw), np.uint8), bounds, lower=True)
    ids, start, end = _word_ids(w)
    segments = []
    for i, y in enumerate(labels):
        own = ids[w.first[i]:w.first[i + 1]]
        own, at = own[own >= 0], 0
        while at < len(own):
            n = 1 + int(rng.geometric(1 / SEGMENT))
            segments.append((own[at:at + n], y))
            at += n
    weights, trans = np.zeros((BUCKETS, n_labels)), np.zeros((n_labels, n_labels))
    if not segments:
        return weights, trans
    # Each distinct word's buckets, as pairs, so gradients scatter in one pass.
    pairs = list(features(w.bytes, start, end))
    word = np.concatenate([k for k, _ in pairs])
    bucket = np.concatenate([b for _, b in pairs])
    scale = 1 / np.maximum(np.bincount(word, minlength=len(start)), 1) ** 0.5
    seen, seen_t = np.full_like(weights, 1e-6), np.full_like(trans, 1e-6)
    for _ in range(rounds):
        order = rng.permutation(len(segments))
        flow = np.concatenate([segments[i][0] for i in order])
        goal = np.concatenate([np.full(len(segments[i][0]), segments[i][1]) for i in order])
        pad = -len(flow) % length
        flow, goal = np.pad(flow, (0, pad), "wrap"), np.pad(goal, (0, pad), "wrap")
        flow, goal = flow.reshape(-1, length), goal.reshape(-1, length)
        for lo in range(0, len(flow), batch):
            x, y = flow[lo:lo + batch], goal[lo:lo + batch]
            used, local = np.unique(x, return_inverse=True)
            local = local.reshape(x.shape)
            mine = np.isin(word, used)
            at = np.searchsorted(used, word[mine])
            table = np.zeros((len(used), n_labels))
            np.add.at(table, at, weights[bucket[mine]])
            table *= scale[used][:, None]
            m, pair = _chain(table[local], trans)
            m[np.arange(len(x))[:, None], np.arange(length), y] -= 1
            g_word = np.zeros_like(table)
            np.add.at(g_word, local.ravel(), m.reshape(-1, n_labels))
            g_word *= scale[used][:, None]
            touched, place = np.unique(bucket[mine], return_inverse=True)
            grad = np.zeros((len(touched), n_labels))
            np.add.at(grad, place, g_word[at])
            grad /= len(x)
            np.subtract.at(pair, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            pair /= len(x)
            seen[touched] += grad ** 2
            seen_t += pair ** 2
            weights[touched] -= 0.2 * grad / np.sqrt(seen[touched])
            trans -= 0.2 * pair / np.sqrt(seen_t)
    return weights, trans


def marginals(score: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Every word's distribution over labels. ``score`` [word, label] holds the
    words of all texts in order; ``first`` points at each text's first."""
    n_labels = score.shape[1]
    sizes = np.diff(first)
    size = BLOCK if n_labels <= MANY_LABELS else max(BLOCK, int(sizes.max(initial=0)))
    n_blocks = -(-sizes // size)
    head = np.concatenate([[0], np.cumsum(n_blocks)])
    total = int(head[-1])
    if not total:
        return np.zeros((0, n_labels))
    text =np.repeat(np.arange(len(sizes)), n_blocks)
    begin = first[text] + (np.arange(total) - head[text]) * size
    used = np.minimum(first[text + 1] - begin, size)
    e = np.exp(score - score.max(axis=1, keepdims=True))
    a = np.exp(trans - trans.max())

    opens = begin == first[text]

    def step(i: int):
        live = np.flatnonzero(used > i)
        return live, e[begin[live] + i]

    def moved(message: np.ndarray, live: np.ndarray, i: int) -> np.ndarray:
        """Messages after a transition; none comes before a text's first word."""
        after = message @ a
        if i == 0:
            start = opens[live]
            after[start] = message[start]
        return after

    # A block's transfer: incoming message to outgoing one.
    most = int(n_blocks.max())
    if most > 1:
        through = np.broadcast_to(np.eye(n_labels), (total, n_labels, n_labels)).copy()
        for i in range(int(used.max())):
            live, emit = step(i)
            x = moved(through[live], live, i) * emit[:, None, :]
            through[live] = x / x.max(axis=(1, 2), keepdims=True)
    into, back = np.empty((total, n_labels)), np.empty((total, n_labels))
    for i in range(most):
        live = np.flatnonzero(n_blocks > i)
        at = head[live] + i
        into[at] = 1 / n_labels if i == 0 else _unit(np.einsum("bi,bij->bj", into[at - 1], through[at - 1]))
        at = head[live + 1] - 1 - i
        back[at] = 1 / n_labels if i == 0 else _unit(np.einsum("bij,bj->bi", through[at + 1], back[at + 1]))
    alpha = np.empty_like(e)
    message = into
    for i in range(int(used.max())):
        live, emit = step(i)
        message[live] = alpha[begin[live] + i] = _unit(moved(message[live], live, i) * emit)
    message = back
    for i in range(int(used.max()) - 1, -1, -1):
        live, emit = step(i)
        alpha[begin[live] + i] = _unit(alpha[begin[live] + i] * message[live])
        message[live] = _unit((message[live] * emit) @ a.T)
    return alpha


def marginal_sums(score: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Per text the sum of its words' marginals."""
    out = np.zeros((len(first) - 1, score.shape[1]))
    filled = np.flatnonzero(first[1:] > first[:-1])
    if len(filled):
        out[filled] = np.add.reduceat(marginals(score, first, trans), first[:-1][filled], axis=0)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=1, keepdims=True), 1e-300)


def _scored(w: Words, weights: np.ndarray):
    """Which words have letters, their emission scores, and where each text's
    first one is."""
    ids, start, end = _word_ids(w)
    has = ids >= 0
    return (has, emissions(weights, w.bytes, start, end)[ids[has]],
            np.concatenate([[0], np.cumsum(has)])[w.first])


def _with_letters(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts have a letter."""
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    lettered = letters[bounds[1:]] > letters[bounds[:-1]]
    plain = np.concatenate([[0], np.cumsum(LETTER[data] & (data < 128))])
    unsure = np.flatnonzero(lettered & (plain[bounds[1:]] == plain[bounds[:-1]]))
    for i in unsure:  # bytes beyond ASCII may be no letters
        lettered[i] = any(c.isalpha() for c in data[bounds[i]:bounds[i + 1]].tobytes().decode("utf-8", "replace"))
    return lettered


def span_chunk(chunk: pa.RecordBatch, column: int, weights: np.ndarray, trans: np.ndarray):
    """Stretches of words with one language: text, start and end (code points),
    label, and the mean marginal of its words."""
    data, bounds = text_buffer(chunk.column(column))
    w = Words(data, bounds, lower=True)
    has, score, first = _scored(w, weights)
    m = marginals(score, first, trans)
    text, (start, end) = w.text_of()[has], (x[has] for x in cores(w))
    sure = np.flatnonzero(_with_letters(data, bounds)[text])
    m, text, start, end = m[sure], text[sure], start[sure], end[sure]
    label = m.argmax(axis=1)
    if not len(label):
        return text, start, end, label, np.zeros(0)
    head = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (label[1:] != label[:-1])]))
    size = np.diff(head, append=len(label))
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    text, before = text[head], point[bounds[text[head]]]
    return (text, point[start[head]] - before, point[end[head + size - 1]] - before, label[head],
            np.add.reduceat(m.max(axis=1), head) / size)


def label_chunk(chunk: pa.RecordBatch, column: int, names: list[str], weights: np.ndarray,
                trans: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    data, bounds = text_buffer(chunk.column(column))
    _, score, first = _scored(Words(data, bounds, lower=True), weights)
    sums = marginal_sums(score, first, trans)
    lettered = _with_letters(data, bounds)
    best = sums.argmax(axis=1)
    share = sums.max(axis=1) / np.maximum(sums.sum(axis=1), 1e-300)
    return ([names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)],
            np.where(lettered, np.clip(share, 0, 1), 0.0))


def sample(docs: DataFrame, text_col: str, label_col: str, per_label: int) -> list[tuple[str, str]]:
    """About ``per_label`` distinct texts of every label, all where it has
    fewer. Rates and draws go by distinct texts, however often one is repeated."""
    known = (docs.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(label_col).alias("label"), F.col(text_col).alias("text")))
    counts = (known.select("label", F.xxhash64("text").alias("name")).distinct()
              .groupBy("label").agg(F.count("*").alias("n")).collect())
    if not counts:
        return []
    shares = F.create_map(*[x for r in counts for x in (F.lit(r[0]), F.lit(min(1.0, per_label / r[1])))])
    chance = F.pmod(F.xxhash64("text", F.lit(29)), F.lit(1 << 30)) / float(1 << 30)
    picked = known.filter(chance < shares[F.col("label")])
    return sorted((r[0], r[1]) for r in picked.distinct().collect())


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        per_label: int = PER_LABEL):
    """The model for ``identify`` and ``label_spans``, from rows not held out:
    label names (none where no row has a label), weights and transitions."""
    drawn = sample(docs.filter(~held_out(F.col(id_col))), text_col, label_col, per_label)
    names = sorted({y for y, _ in drawn})
    number = {y: i for i, y in enumerate(names)}
    weights, trans = train([t for _, t in drawn], [number[y] for y, _ in drawn], max(len(names), 1))
    return docs.sparkSession.sparkContext.broadcast((names, weights.astype(np.float32), trans))


def _chunk_bytes(names: list[str]) -> int:
    return CHUNK_BYTES * MANY_LABELS // max(MANY_LABELS, len(names))


def label_spans(docs: DataFrame, model=None, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "lang", per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, start, end, lang, score: the languages of a text's words, a row
    per stretch of words with one language. Places are code points, from the
    first word's first letter to the last word's last one; words without
    letters neither end a stretch nor begin one (within a text that has a
    letter, signs beyond ASCII count as letters). The score is the mean marginal
    of its words. Texts without a letter have no row, nor has any text when
    nothing was learned."""
    model = model or fit(docs, id_col, text_col, label_col, per_label)

    def run(batches):
        names, weights, trans = model.value
        for chunk in chunks(batches, "text", _chunk_bytes(names)) if names else ():
            text, start, end, label, score = span_chunk(chunk, 1, weights, trans)
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0).take(pa.array(text, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(end, pa.int64()), pa.array([names[i] for i in label.tolist()], pa.string()),
                 pa.array(score, pa.float64())], names=["doc_id", "start", "end", "lang", "score"])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id bigint, start bigint, end bigint, lang string, score double"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             per_label: int = PER_LABEL, model=None) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Learns from rows not held out."""
    model = model or fit(docs, id_col, text_col, label_col, per_label)

    def run(batches):
        names, weights, trans = model.value
        learned = bool(names)
        names = names or [UNKNOWN]
        for chunk in chunks(batches, "text", _chunk_bytes(names)):
            lang, score = label_chunk(chunk, 2, names, weights, trans)
            if not learned:
                lang, score = [UNKNOWN] * len(lang), score * 0
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), chunk.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                        F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double"))
