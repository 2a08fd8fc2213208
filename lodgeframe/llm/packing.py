"""Best-fit packing of tokenised documents by sums of squares.

Every text becomes token ids plus an end id; only documents longer than a
sequence are cut, into full pieces and a rest. Pieces are dealt by hash, which takes
in a number that each piece is staged with, into
shards of about ``shard_pieces`` and packed per shard, longest first: a piece
goes to the open sequence whose choice leaves the smallest sum, over residual
gaps g, of (open sequences with gap g) squared, and to a new one if none has
room. Closed (full) sequences do not
count. Each shard's work is bounded and shards are independent, so shards grow
in number with the data, not in size.

Tokenising: the tokenizer merges only within the parts its pattern cuts. A
chunk's texts are cut into parts as one byte buffer, and a task keeps the ids
of the parts it has met in sorted arrays, ``CACHE_PARTS`` of them at most (some
16 MB); beyond, it starts anew.

Edge cases: a null or empty text is the end id alone; repeated rows are packed
each; null ids pack like others; an empty table gives an empty result. Extra
columns are ignored.
"""
from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.staging import stage
from lodgeframe.llm.words import chunks, names_between, text_buffer

SEQUENCE = 2048
END = 0
SHARD_PIECES = 50_000
CACHE_PARTS = 400_000
#: Text bytes encoded at a time.
ENCODE_BYTES = 1 << 20
VOCABULARY = "word_bpe_49k.json"


# The split pattern that the vocabulary file states.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHORT_FORMS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")

#: Bytes of the characters that are cut here: ASCII from tab to carriage return and from space to tilde,
#: and the letters from U+00C0 to U+00FF (0xC3 and a byte from 0x80).
SPACE, LETTER, DIGIT, OTHER, FOREIGN = range(5)
KIND = np.full(256, FOREIGN, np.uint8)
KIND[32:127] = OTHER
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[48:58] = DIGIT
KIND[65:91] = KIND[97:123] = KIND[0x80:0xC0] = KIND[0xC3] = LETTER
#: The first bytes of a part of a length, out of eight read.
LEADS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Parts:
    """The parts of the plain texts in a buffer, lower-cased: ``start`` and
    ``end`` (byte places), the text of each, and which texts are plain."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        n, texts = len(data), len(bounds) - 1
        kind = KIND[data]
        after_c3 = np.zeros(n, bool)
        after_c3[1:] = data[:-1] == 0xC3
        after_c3[bounds[:-1][bounds[:-1] < n]] = False
        # 0xC3 leads every second byte, the signs U+00D7 and U+00F7 are no letters, and "<|" opens special tokens.
        odd = (kind == FOREIGN) | ((data >= 0x80) & (data < 0xC0) & ~after_c3) | (after_c3 & ((data == 0x97) | (data == 0xB7)))
        odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
        of = np.repeat(np.arange(texts), np.diff(bounds))
        self.plain = np.ones(texts, bool)
        self.plain[of[odd]] = False
        raise_by = ((data >= 65) & (data <= 90)) | (after_c3 & (data >= 0x80) & (data <= 0x9E))
        self.bytes = np.zeros(n + 8, np.uint8)
        self.bytes[:n] = data + raise_by.astype(np.uint8) * 32
        begins = np.zeros(n, bool)
        begins[bounds[:-1][bounds[:-1] < n]] = True
        starts = begins.copy()
        starts[1:] |= kind[1:] != kind[:-1]
        starts |= kind == DIGIT
        starts &= kind != SPACE
        for form in SHORT_FORMS:
            at = np.flatnonzero(starts[:max(n - len(form) + 1, 0)] & (self.bytes[:max(n - len(form) + 1, 0)] == 39))
            for i, b in enumerate(form[1:], 1):
                at = at[(self.bytes[at + i] == b) & ~begins[at + i]]
            starts[at + 1] = False
            after = at + len(form)
            after = after[after < n]
            starts[after[kind[after] == LETTER]] = True
        self.start = np.flatnonzero(starts)
        # A part ends where the next begins, or at the first space or text border before.
        stops = np.append(np.flatnonzero(starts | (kind == SPACE) | begins), n)
        self.end = stops[np.searchsorted(stops, self.start, "right")]
        self.of = of[self.start]
        if not self.plain.all():
            keep = self.plain[self.of]
            self.start, self.end, self.of = self.start[keep], self.end[keep], self.of[keep]


class TextEncoder:
    """Ids of texts as little-endian 32-bit bytes.

    The tokenizer merges within parts that its pattern cuts, so a text's ids
    are its parts' ids one after another. Texts of plain characters are cut
    here and the ids of parts are kept; all others, and all texts of
    a vocabulary with another pattern, go to the tokenizer whole.

    Parts are found by a 64-bit name, and compared by their length and first
    eight bytes, so parts of up to eight bytes are never mistaken."""

    def __init__(self, path: str, most: int = CACHE_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.most = most
        self.cuts = json.dumps(SPLIT) in self.tokenizer.to_str()
        self._start_anew()

    def _start_anew(self) -> None:
        #: Known parts by name: first bytes, length, and place and number of their ids.
        self.name, self.lead = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.length, self.at, self.n = (np.empty(0, np.int32) for _ in range(3))
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _merge(self, part: bytes) -> list[int]:
        text = part.decode() if part.isascii() else "".join([self.letters[b] for b in part])
        return [t.id for t in self.tokenizer.model.tokenize(text)]

    def _learn(self, raw: bytes, name, lead, start, length) -> None:
        if len(self.name) + len(name) > self.most:
            self._start_anew()
        merged = [self._merge(raw[a:a + n]) for a, n in zip(start.tolist(), length.tolist())]
        sizes = np.array([len(m) for m in merged], np.int32)
        new = np.array([i for m in merged for i in m], np.uint32)
        if self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.empty(max(len(self.ids), len(new)), np.uint32)])
        self.ids[self.used:self.used + len(new)] = new
        place = np.searchsorted(self.name, name)
        for field, values in (("lead", lead), ("length", length), ("n", sizes), ("name", name),
                              ("at", self.used + np.cumsum(sizes) - sizes)):
            setattr(self, field, np.insert(getattr(self, field), place, values))
        self.used += len(new)

    def _known(self, name, lead, length) -> tuple[np.ndarray, np.ndarray]:
        """Places of parts among the known, and which are there."""
        place = np.minimum(np.searchsorted(self.name, name), max(len(self.name) - 1, 0))
        if not len(self.name):
            return place, np.zeros(len(name), bool)
        return place, (self.name[place] == name) & (self.lead[place] == lead) & (self.length[place] == length)

    def column(self, texts: pa.Array) -> list[bytes]:
        """Ids of the texts of an Arrow column; a null is empty."""
        data, bounds = text_buffer(texts)
        if not self.cuts:
            return self._encode([t or "" for t in texts.to_pylist()])
        parts = Parts(data, bounds)
        length = parts.end - parts.start
        name = names_between(parts.bytes, parts.start, parts.end)
        lanes = np.ndarray(shape=(len(parts.bytes) - 7,), dtype="<u8", buffer=parts.bytes, strides=(1,))
        lead = lanes[parts.start] & LEADS[np.minimum(length, 8)]
        own, first, which = np.unique(name, return_index=True, return_inverse=True)
        same = bool((lead == lead[first][which]).all() and (length == length[first][which]).all())
        lead, length, start = lead[first], length[first], parts.start[first]
        place, known = self._known(own, lead, length)
        if same and not known.all():
            new = ~known
            if len(self.name) + int(new.sum()) > self.most:
                self._start_anew()
                new[:] = True
            # A part that shares its name with a known one of other bytes stays out.
            taken = self.name[np.minimum(np.searchsorted(self.name, own), max(len(self.name) - 1, 0))] == own \
                if len(self.name) else np.zeros(len(own), bool)
            new &= ~taken
            self._learn(parts.bytes.tobytes(), own[new], lead[new], start[new], length[new])
            place, known = self._known(own, lead, length)
        if not same or not known.all():
            return self._encode([t or "" for t in texts.to_pylist()])
        place = place[which]
        n, text = self.n[place], parts.of
        ends = np.cumsum(n, dtype=np.int64)
        flat = self.ids[np.repeat(self.at[place] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        stops = np.concatenate([[0], ends])[np.searchsorted(text, np.arange(len(bounds)))].tolist()
        raw = flat.astype("<u4").tobytes()
        out = [raw[4 * a:4 * b] for a, b in zip(stops[:-1], stops[1:])]
        whole = np.flatnonzero(~parts.plain).tolist()
        if whole:
            for i, ids in zip(whole, self._encode([texts[i].as_py() for i in whole])):
                out[i] = ids
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        return self.column(pa.array(texts, pa.string()))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           sequence: int = SEQUENCE, end: int = END, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and with
    ``keep_ids`` the ids as an array."""
    path = path or vocabulary_path()
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    types = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
             ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if keep_ids:
        schema, types = schema + ", ids array<int>", [*types, ("ids", pa.list_(pa.int32()))]
    tail, step = np.array([end], "<u4").tobytes(), 4 * sequence

    def run(batches):
        encode = TextEncoder(path)
        for chunk in chunks(batches, "text", ENCODE_BYTES):
            rows = ([], [], [], [], [], [])
            for doc, ids in zip(chunk.column(0).to_pylist(), encode.column(chunk.column(1))):
                ids += tail
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    for r, v in zip(rows, (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part)):
                        r.append(v)
            if keep_ids:
                rows = (*rows[:5], [np.frombuffer(p, "<i4") for p in rows[5]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, t) for r, (_, t) in zip(rows, types)], names=[n for n, _ in types])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for each length, placed in the given order.

    Placing a piece of length s in a gap g changes the sum by
    2 * (N[g - s] - N[g]) + 2, and by 1 - 2 * N[g] if it fills the gap; ties go
    to the smallest gap. A new sequence is opened where no open one has room:
    longest first, that takes fewer sequences than opening by the sum too."""
    count = np.zeros(sequence + 1, np.int64)
    open_in: list[list[int]] = [[] for _ in range(sequence + 1)]
    where = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        best, gap = 1 << 39, sequence
        if count[s]:
            best, gap = 1 - 2 * int(count[s]), s
        held = count[s + 1:sequence]
        if len(held):
            change = 2 * (count[1:sequence - s] - held) + 2
            change[held == 0] = 1 << 40
            k = int(change.argmin())
            if change[k] <= best and (gap != s or change[k] < best):
                gap = s + 1 + k
        if gap == sequence:
            where[i], made = made, made + 1
        else:
            where[i] = open_in[gap].pop()
            count[gap] -= 1
        offset[i] = sequence - gap
        if gap > s:
            open_in[gap - s].append(int(where[i]))
            count[gap - s] += 1
    return where, offset


def pack(cut: DataFrame, sequence: int = SEQUENCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``cut`` (any columns with doc_id, piece, length) with sequence_id and
    offset. ``cut`` is read twice; stage it first. A column ``salt`` that
    differs from row to row deals rows with equal ids apart, and is dropped."""
    shards = max(1, -(-cut.count() // shard_pieces))
    fields = [f for f in cut.schema.fields if f.name != "salt"]
    names = [f.name for f in fields]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        where, offset = sum_of_squares(frame["length"].to_numpy(), sequence)
        shard = int(frame["shard"].iloc[0])
        return frame[names].assign(sequence_id=(shard << 40) + where, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    own = [c for c in ("ids_crc32", "salt") if c in cut.columns]
    shard = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "piece", "start", *own), F.lit(shards))
    return (cut.withColumn("shard", shard).groupBy("shard")
            .applyInPandas(run, f"{schema}, sequence_id bigint, offset bigint"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   path: str | None = None, sequence: int = SEQUENCE, end: int = END,
                   shard_pieces: int = SHARD_PIECES) -> DataFrame:
    cut = stage(pieces(docs, id_col, text_col, path, sequence, end)
                .withColumn("salt", F.monotonically_increasing_id()), "packing-pieces")
    return pack(cut, sequence, shard_pieces)
