"""Personal data by weak supervision.

Candidate spans come from the strict patterns of each kind and from wider
ones (an address written with words for its signs, a phone number without a
plus, numbers grouped in other ways). Labelers vote on every candidate: the
strict pattern, checks and gazetteers (domain endings, address blocks, number
prefixes), and the words before it, each for, against or silent. Votes of all
candidates of the whole corpus are counted per vote pattern (at most
3 ** labelers per kind, whatever the corpus). Expectation-maximisation over
those counts estimates each labeler's reliability. A span classifier (logistic
regression) is then trained on the posteriors. Besides the votes it sees the
span's shape and length, the signs beside it and the words around it, hashed
to ``SLOTS`` weights, so it learns contexts that no labeler names: what stands
before strict spans counts for wider ones too. It is fitted on a bounded
sample: the ``PER_KIND`` distinct candidates (votes and features) of each kind
with the least hash, a repeated one weighing 1 + ln(its number). A candidate
is marked when the classifier gives it at least ``threshold``. Spans of the
strict patterns are always kept; a candidate that overlaps one is dropped, so
the method only adds.

The corpus is read twice: for the counts and for the marks. Patterns use
possessive or bounded repeats, so a text is scanned in linear time.

Edge cases: a null or empty text has no spans; null or repeated ids keep one
row each; an empty table trains nothing and marks nothing. Extra columns are
ignored by ``find``; ``redact`` keeps the columns of its input.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.llm.staging import discard, stage_at

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.9
CONTEXT = 24
SLOTS = 1024
PER_KIND = 4000
#: Distinct candidates a task counts before it passes them on.
HELD = 50_000
_WORD = re.compile(r"[^\W\d_]+")

# The strict patterns. Repeats of single classes are possessive
# where nothing can be given back.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Wider candidates, bounded in length.
BRACKETED_DOT = r" ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?"
WORDED_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?:"
    rf" ?[\[({{<] ?(?:at|AT|@) ?[\])}}>] ?[A-Za-z0-9-]{{1,63}}(?:(?:{BRACKETED_DOT}| (?:dot|DOT) |\.)[A-Za-z0-9-]{{2,24}}){{1,3}}"
    rf"| (?:at|AT) [A-Za-z0-9-]{{1,63}}(?:(?:{BRACKETED_DOT}| (?:dot|DOT) )[A-Za-z0-9-]{{2,24}}){{1,3}})(?![A-Za-z0-9-])")
LOOSE_PHONE = re.compile(
    r"(?<![0-9A-Za-z+.-])(?:00[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])"
    r"[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.-])")
LOOSE_CARD = re.compile(r"(?<![0-9.])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9.])")
WORDED_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?[\[(] ?(?:dot|\.) ?[\])] ?[0-9]{1,3}){3}(?![0-9.])")

# Gazetteers.
ENDINGS = frozenset("com org net edu gov info biz io de fr es uk eu it nl ch at be us ca example test".split())
CARD_STARTS = ("34", "37", "4", "51", "52", "53", "54", "55", "2", "6", "30", "36", "38")
CUES = {
    "email": ("mail", "contact", "write", "reach", "address", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr", "ping", "client", "login"),
    "card": ("card", "visa", "master", "amex", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "contact", "ruf"),
}
COUNTER_CUES = {
    "email": ("meet", "look", "arrive"),
    "ip": ("version", "section", "v.", "release", "chapter"),
    "card": ("isbn", "serial", "order", "invoice", "id"),
    "phone": ("isbn", "order", "invoice", "page", "score", "version", "total"),
}
LABELERS = ("strict", "check", "gazetteer", "shape", "cue", "counter_cue")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = 2 * v - 9 * (v > 4)
        total += v
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in s.split("."))


def is_card(s: str) -> bool:
    d = only_digits(s)
    return 16 <= len(d) <= 19 and luhn(d)


def strict_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches without overlap. Each at-sign is tried once with the
    longest name before it, from the end of the last match on, so long runs
    without an at-sign cost nothing."""
    spans, last, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > last and (text[start - 1] in "._%+-" or text[start - 1].isascii()
                                    and text[start - 1].isalnum()):
                start -= 1
            if start < at:
                spans.append((start, domain.end()))
                last = domain.end()
                at = last - 1
        at = text.find("@", at + 1)
    return spans


def strict_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = strict_emails(text)
    found["ip"] = [m.span() for m in IP.finditer(text) if is_ip(m.group())]
    found["card"] = [m.span() for m in CARD.finditer(text) if m.end() - m.start() >= 16 and is_card(m.group())]
    if "+" in text:
        found["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= len(only_digits(m.group())) <= 15]
    return found


def wide_spans(text: str, strict: dict[str, list[tuple[int, int]]], digits: bool) -> list[tuple[str, int, int]]:
    """Candidates that overlap no strict span and none found before."""
    taken = sorted(s for spans in strict.values() for s in spans)
    out: list[tuple[str, int, int]] = []
    low = text.lower()
    tries = []
    if re.search(r"[\[({<] ?(?:at|@) ?[\])}>]| at .{1,66}dot", low):
        tries.append(("email", WORDED_EMAIL))
    if digits:
        tries += [("phone", LOOSE_PHONE), ("card", LOOSE_CARD), ("ip", WORDED_IP)]
    for kind, pattern in tries:
        for m in pattern.finditer(text):
            a, b = m.span()
            if all(b <= s or e <= a for s, e in taken):
                out.append((kind, a, b))
                taken.append((a, b))
    return out


def votes(kind: str, text: str, a: int, b: int, strict: bool) -> tuple[int, ...]:
    """1 for, -1 against, 0 silent; in the order of LABELERS."""
    span, before = text[a:b], text[max(0, a - CONTEXT):a].lower()
    d = only_digits(span)
    if kind == "email":
        ending = re.split(r"dot|[.\s\])}>]+", span.lower())[-1]
        check = 1 if " " not in span.strip() or re.search(r"dot|[\])}>]", span.lower()) else -1
        gazetteer = 1 if ending in ENDINGS else -1
        shape = 1 if re.search(r"[\[({<@]", span) else 0
    elif kind == "ip":
        parts = [int(p) for p in re.findall(r"[0-9]{1,9}", span)[:4]]
        check = 1 if all(p <= 255 for p in parts) else -1
        gazetteer = 1 if parts and 0 < parts[0] < 224 else -1
        shape = 1 if max(parts, default=0) > 31 else -1
    elif kind == "card":
        check = 1 if luhn(d) else -1
        gazetteer = 1 if d.startswith(CARD_STARTS) else -1
        shape = 1 if len(d) == 16 and len(set(d)) > 3 else 0
    else:
        check = 1 if 9 <= len(d) <= 13 else -1
        gazetteer = 1 if d.startswith(("00", "0", "1")) else 0
        shape = 1 if "(" in span or "555" in d else -1 if "." in span else 0
    cue = 1 if any(c in before for c in CUES[kind]) else 0
    counter = -1 if any(c in before for c in COUNTER_CUES[kind]) else 0
    return (1 if strict else 0, check, gazetteer, shape, cue, counter)


def candidates(text: str):
    """(kind, start, end, strict, votes) of a text."""
    digits = re.search("[0-9]", text) is not None
    strict = strict_spans(text)
    for kind in KINDS:
        for a, b in strict[kind]:
            yield kind, a, b, True, votes(kind, text, a, b, True)
    for kind, a, b in wide_spans(text, strict, digits):
        yield kind, a, b, False, votes(kind, text, a, b, False)


def features(kind: str, text: str, a: int, b: int) -> list[int]:
    """Slots of the span's shape and length, its neighbours and the words
    around it; at most seven."""
    before, span, after = text[max(0, a - CONTEXT):a], text[a:b], text[b:b + CONTEXT]
    shape = re.sub("[0-9]+", lambda m: str(min(len(m.group()), 9)), re.sub(r"[^\W\d_]+", "a", span[:64]))
    words = _WORD.findall(before.lower())[-2:]
    seen = [f"shape {shape}", f"length {min(b - a, 40) // 4}", f"left {before[-1:]}", f"right {after[:1]}",
            *(f"word -{len(words) - i} {w}" for i, w in enumerate(words)),
            *(f"word 1 {w}" for w in _WORD.findall(after.lower())[:1])]
    return sorted({zlib.crc32(f"{kind} {t}".encode()) % SLOTS for t in seen})


def candidate_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """kind, votes (a string of + - 0), slots, n: the distinct candidates of
    all texts."""
    schema = "kind string, votes string, slots array<int>, n bigint"

    def rows(counts):
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in keys]), pa.array([v for _, v, _ in keys]),
             pa.array([list(s) for _, _, s in keys], pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())],
            names=["kind", "votes", "slots", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update((k, "".join("-0+"[v + 1] for v in vs), tuple(features(k, text, a, b)))
                                  for k, a, b, _, vs in candidates(text))
                if len(counts) >= HELD:
                    yield rows(counts)
                    counts.clear()
        if counts:
            yield rows(counts)
    return (docs.select(text_col).mapInArrow(run, schema)
            .groupBy("kind", "votes", "slots").agg(F.sum("n").alias("n")))


def vote_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """kind, votes, n: over all candidates of all texts."""
    return candidate_counts(docs, text_col).groupBy("kind", "votes").agg(F.sum("n").alias("n"))


def sampled(counted: DataFrame, distinct: dict[str, int], per_kind: int = PER_KIND) -> DataFrame:
    """kind, votes, slots, n: of each kind the ``per_kind`` candidates with the
    least hash. A bound on the hash, from the number of distinct ones, leaves
    about twice as many for the ranking, whatever the corpus."""
    span = 1 << 40
    bound = F.lit(0).cast("bigint")
    for kind, n in distinct.items():
        bound = F.when(F.col("kind") == kind, F.lit(min(span, 2 * per_kind * span // n + 1))).otherwise(bound)
    hashed = F.xxhash64("kind", "votes", "slots")
    order = Window.partitionBy("kind").orderBy("hash", "votes", "slots")
    return (counted.withColumn("hash", hashed).filter(F.pmod("hash", F.lit(span)) < bound)
            .withColumn("hash", F.pmod("hash", F.lit(span)))
            .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_kind)
            .select("kind", "votes", "slots", "n"))


def reliabilities(patterns: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation for two classes and independent labelers with
    three answers. Returns the prior, (class, labeler, answer) probabilities
    and each pattern's posterior. Starts from the vote balance; one count is
    added to every cell, so no probability is 0."""
    posterior = np.clip(0.5 + patterns.mean(axis=1) / 2, 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * n, posterior * n])
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        table = np.stack([[[((patterns[:, j] == a) * w).sum() + 1 for a in (-1, 0, 1)]
                           for j in range(patterns.shape[1])] for w in weight])
        table = table / table.sum(axis=2, keepdims=True)
        log = np.log(table)
        picked = sum(log[:, j, patterns[:, j] + 1] for j in range(patterns.shape[1]))
        gap = picked[1] - picked[0] + np.log(prior / (1 - prior))
        posterior = 1 / (1 + np.exp(-np.clip(gap, -50, 50)))
    return float(prior), table, posterior


def train(counts: list[tuple[str, str, int]], sample: list[tuple[str, str, list[int], int]] | None = None,
          rounds: int = 400, step: float = 0.5, decay: float = 1e-3) -> dict:
    """Per kind the classifier's weights of the votes, weights of the slots
    {slot: weight} and offset. ``counts`` (kind, votes, n) are of all
    candidates and give the posteriors; the classifier is fitted on ``sample``
    (kind, votes, slots, n), or on the counts alone without it."""
    if sample is None:
        sample = [(k, v, [], n) for k, v, n in counts]
    else:
        sample = [(k, v, s, 1 + np.log(n)) for k, v, s, n in sample]
    models = {}
    read = lambda v: ["-0+".index(c) - 1 for c in v]
    for kind in KINDS:
        own = sorted((v, n) for k, v, n in counts if k == kind)
        drawn = sorted((v, list(s), n) for k, v, s, n in sample if k == kind)
        if not own or not drawn:
            continue
        _, _, posterior = reliabilities(np.array([read(v) for v, _ in own]), np.array([c for _, c in own], float))
        goal_of = dict(zip((v for v, _ in own), posterior))
        slots = sorted({i for _, s, _ in drawn for i in s})
        at = {slot: len(LABELERS) + i for i, slot in enumerate(slots)}
        x = np.zeros((len(drawn), len(LABELERS) + len(slots)))
        for i, (v, s, _) in enumerate(drawn):
            x[i, :len(LABELERS)] = read(v)
            x[i, [at[j] for j in s]] = 1
        goal = np.array([goal_of[v] for v, _, _ in drawn])
        share = np.array([n for _, _, n in drawn], float)
        share /= share.sum()
        w, bias = np.zeros(x.shape[1]), 0.0
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-(x @ w + bias)))
            g = (p - goal) * share
            w -= step * (x.T @ g + decay * w)
            bias -= step * g.sum()
        models[kind] = (w[:len(LABELERS)].tolist(), dict(zip(slots, w[len(LABELERS):].tolist())), float(bias))
    return models


def probability(models: dict, kind: str, text: str, a: int, b: int, vs: tuple[int, ...]) -> float:
    """The classifier's verdict on one candidate; 0 for a kind never seen."""
    if kind not in models:
        return 0.0
    w, slots, bias = models[kind]
    z = sum(x * y for x, y in zip(w, vs)) + bias
    if slots:
        z += sum(slots.get(i, 0.0) for i in features(kind, text, a, b))
    return float(1 / (1 + np.exp(-z)))


def marks(text: str | None, models: dict, threshold: float = THRESHOLD):
    """Strict spans and marked spans, (kind, start, end), by kind, then start."""
    base, marked = [], []
    for kind, a, b, strict, vs in candidates(text or ""):
        if strict:
            base.append((kind, a, b))
        elif probability(models, kind, text, a, b, vs) >= threshold:
            marked.append((kind, a, b))
    place = lambda s: (KINDS.index(s[0]), s[1])
    return sorted(base, key=place), sorted(base + marked, key=place)


def fit(docs: DataFrame, text_col: str = "text", per_kind: int = PER_KIND) -> dict:
    """Reliabilities from all candidates of all texts, the classifier from a
    sample of them; at most 4 * 3 ** 6 counts and 4 * ``per_kind`` candidates
    come to the driver."""
    counted, counted_at = stage_at(candidate_counts(docs, text_col), "pii-candidates")
    per_vote = (counted.groupBy("kind", "votes").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect())
    distinct: Counter = Counter()
    for r in per_vote:
        distinct[r["kind"]] += r["distinct"]
    drawn = sampled(counted, dict(distinct), per_kind).collect() if distinct else []
    discard(docs.sparkSession, counted_at)
    return train([(r["kind"], r["votes"], r["n"]) for r in per_vote], [tuple(r) for r in drawn])


def find(docs: DataFrame, models: dict | None = None, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (strict spans),
    base_sha256, spans (all)."""
    models = fit(docs, text_col) if models is None else models

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = marks(text, models, threshold)
                line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
                n = Counter(k for k, _, _ in base)
                rows.append((*(n[k] for k in KINDS), hashlib.sha256(line.encode()).hexdigest(),
                             ",".join(f"{k}:{a}:{b}" for k, a, b in every)))
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, " \
             "base_sha256 string, spans string"
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def redacted(text: str | None, models: dict, threshold: float = THRESHOLD) -> str | None:
    """The text with each span replaced by its kind in angle brackets.
    Overlapping spans (two strict kinds over one number) become one mark."""
    if not text:
        return text
    out, last = [], 0
    for kind, a, b in sorted(marks(text, models, threshold)[1], key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"<{kind}>"]
        last = max(last, b)
    return "".join([*out, text[last:]]) if out else text


def redact(docs: DataFrame, models: dict | None = None, text_col: str = "text",
           size_col: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with personal data replaced in its texts."""
    models = fit(docs, text_col) if models is None else models
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            new = pa.array([redacted(t, models, threshold) for t in batch.column(at).to_pylist()],
                           batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), new)

    out = docs.mapInArrow(run, docs.schema)
    if size_col and size_col in docs.columns:
        out = out.withColumn(size_col, F.length(text_col).cast(docs.schema[size_col].dataType))
    return out
