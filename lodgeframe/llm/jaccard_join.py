"""N-gram Jaccard join by parity sketches, and its connected components.

A text's set holds its distinct k-word shingles (lower-cased); with fewer
words the whole sequence is one shingle, without words the set is empty. Two
sets link when their Jaccard similarity is at least ``percent`` / 100.

Sketch. Sets are compared within size bands [2**b, 2**(b+1)); a set whose
smallest possible partner lies in the band below is sketched there too. In a
band every shingle is hashed to one of P blocks, and its 64-bit code is XORed
into the block. Every element of the symmetric difference changes one block,
so the number of blocks that differ (the sketches' Hamming distance in blocks)
is at most the symmetric difference, which for a linked pair is at most
d = (100 - percent) / percent * size.

Pigeonhole. Take the first block, filled in either, that agrees. Every filled
block before it differs, so it is among the first d + 1 filled blocks of both
sets: these are a set's signatures. If a set has no more than d filled blocks,
it gets a further signature, common to all such sets of its band, so no pair
is lost. Sets with equal signatures are candidates, and every candidate pair
that matters is verified on its exact sets.

Components. Equal sets are one node from the start, so copies are never
paired. Of signatures with the same nodes one is kept. First the nodes of a signature are compared with its most popular
node, and connected components are taken of the links. Then nodes that share a
signature, but no component, are compared, block by block of a signature's
nodes. Nodes of crowded signatures know which of these they have, and a pair
is compared in the least it shares only. Pairs inside a component need no test: they cannot change it. So no
link between different texts is lost.

Comparing. Each node also has a bit sketch (each shingle flips one bit) of 4
to 8 bits per shingle, and a brief one of 1 to 2 bits, which is the other
folded; a wider one folds onto a narrower. A pair whose bit sketches differ in
more than d bits cannot link. Members of a signature carry brief sketches only,
as a node has many signatures; pairs that pass are compared by the whole
sketches, then verified on their exact sets, whose texts are fetched through a
broadcast bit filter of bounded size.

Shuffle shape: packs send distinct signatures by range and learn by one bit
which ones another node shares; only shared ones become rows. Rows are then
grouped with partial aggregation and joined with adaptive skew splitting; a
signature with very many nodes is compared in blocks of bounded size.

Edge cases: a null or empty text has an empty set and links with nothing;
repeated rows have equal sets and share a component; a null id is its text's
component only if no other id is there. An empty table gives an empty result.
Extra columns are ignored; ``deduplicate`` keeps the columns of its input,
whatever their names. Tables on the way are deleted when they are used up.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.blocks import borders_of, by_range
from lodgeframe.llm.packs import answer, flags_of, opened, packs, rows_of, sent, shared_by_two
from lodgeframe.llm.staging import discard, partitions_for, stage, stage_at
from lodgeframe.llm.words import END_ID, Words, mix

SHINGLE = 5
PERCENT = 80
#: A signature with more nodes than this is crowded.
CROWD = 64
#: The filter by which texts are fetched has up to 2**FILTER_BITS bits: a table
#: of 4 MB at most, whatever the input.
FILTER_BITS = 24
_SALT = np.array([0x8F14E45FCEEA167A, 0x6512BD43D9CAA6E0, 0x3C59DC048E885024], np.uint64)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle name) pairs, sorted."""
    text = w.text_of()
    at, name = w.grams(k)
    text = text[at]
    count = np.diff(w.first)
    for n in range(1, k):
        short = np.flatnonzero(count == n)
        if len(short):
            start = w.first[short]
            total = np.full(len(short), _SALT[0] ^ np.uint64(n), np.uint64)
            for j in range(n):
                total = mix(total + w.name[start + j])
            text, name = np.concatenate([text, short]), np.concatenate([name, total])
    order = np.lexsort((name, text))
    text, name = text[order], name[order]
    if len(text):
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (name[1:] != name[:-1])])
        text, name = text[new], name[new]
    return text, name


def nodes_of(text: np.ndarray, name: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text its set's size and 64-bit name (0 for the empty set)."""
    size = np.bincount(text, minlength=n_texts).astype(np.int64)
    node = np.zeros(n_texts, np.uint64)
    if len(text):
        head = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        node[text[head]] = mix(np.add.reduceat(mix(name ^ _SALT[1]), head) ^ size[text[head]].astype(np.uint64))
    return size, node.view(np.int64)


def differing(size: np.ndarray, percent: int) -> np.ndarray:
    """The greatest symmetric difference of a set of this size and a linked one."""
    return size * (100 - percent) // percent


def signatures(text: np.ndarray, name: np.ndarray, size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature) of all texts' sets."""
    band = np.zeros(len(size), np.int64)
    band[size > 0] = np.floor(np.log2(size[size > 0])).astype(np.int64)
    least = -(-size * percent // 100)
    below = (size > 0) & (least < (1 << band)) & (band > 0)
    out_text, out_sig = [], []
    for down in (0, 1):
        use = (size > 0) if down == 0 else below
        b = band - down
        low = np.int64(1) << np.maximum(b, 0)
        share = (100 - percent) / percent
        # Blocks: enough that d + 1 of them are filled, few enough to be choosy.
        blocks = np.ceil(low * share * 2.27).astype(np.int64) + 12
        most = np.minimum(differing(size, percent), differing(2 * low - 1, percent))
        pick = use[text]
        t, x = text[pick], name[pick]
        if not len(t):
            continue
        salt = mix(b.astype(np.uint64) + _SALT[2])
        block = (mix(x ^ salt[t]) % blocks[t].astype(np.uint64)).astype(np.int64)
        key = t << 32 | block
        order = np.argsort(key, kind="stable")
        key, code = key[order], mix(x[order] + _SALT[0])
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        value = np.bitwise_xor.reduceat(code, head)
        of, block = key[head] >> 32, key[head] & 0xFFFFFFFF
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        filled = np.diff(np.append(starts, len(of)))
        rank = np.arange(len(of)) - np.repeat(starts, filled)
        first = rank <= most[of]
        out_text.append(of[first])
        out_sig.append(mix(value[first] + mix(salt[of[first]] ^ block[first].astype(np.uint64))))
        sparse = of[starts][filled <= differing(size[of[starts]], percent)]
        out_text.append(sparse)
        out_sig.append(mix(salt[sparse] + _SALT[1]))
    if not out_text:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(out_text), np.concatenate(out_sig)


def bit_sketches(text: np.ndarray, name: np.ndarray, size: np.ndarray, per: int = 8) -> list[bytes]:
    """Per text its parity bits: ``per`` (a power of two) * 2**band, but 64 at
    least."""
    bits = np.maximum(per << np.floor(np.log2(np.maximum(size, 1))).astype(np.int64), 64)
    at = np.concatenate([[0], np.cumsum(bits)])
    flips = np.bincount(at[text] + (mix(name + _SALT[2]) % bits[text].astype(np.uint64)).astype(np.int64),
                        minlength=int(at[-1]))
    raw = np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()
    return [raw[a // 8:b // 8] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches as 64-bit words [sketch, word], folded to ``width`` bytes."""
    out = np.empty((len(sketches), width // 8), np.uint64)
    for i, s in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, width // 8), axis=0)
    return out


def possible(size_a, size_b, percent: int):
    """Whether sets of these sizes can link."""
    return 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)


def sketched(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int):
    """Staged: texts (doc_id, size, node), members (sig, node) of signatures
    that several nodes share, nodes (node, size, brief, sketch, text); and the
    folder of members."""
    ranges = partitions_for(docs, text_col)
    borders = borders_of(ranges)
    packed, packs_at = stage_at(packs(docs, id_col, text_col), "jaccard-packs")

    def own_signatures(row):
        ids, w = opened(row, lower=True)
        text, name = shingles(w, k)
        size, node = nodes_of(text, name, len(ids))
        # Texts with equal sets: the first one stands for them.
        _, first = np.unique(node, return_index=True)
        stands = np.zeros(len(ids), bool)
        stands[first] = size[first] > 0
        keep = stands[text]
        text, name = text[keep], name[keep]
        of, sig = signatures(text, name, np.where(stands, size, 0), percent)
        return ids, w, size, node, text, name, of, sig

    def list_texts(batches):
        for row in rows_of(batches):
            ids, w = opened(row, lower=True)
            size, node = nodes_of(*shingles(w, k), len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if i == END_ID else i for i in ids.tolist()], pa.int64()), pa.array(size),
                 pa.array(node)], names=["doc_id", "size", "node"])

    def send(batches):
        for row in rows_of(batches):
            *_, sig = own_signatures(row)
            key, n = np.unique(sig, return_counts=True)
            yield sent(row["pack"], by_range(key, borders, np.minimum(n, 2)))

    schema = "sig bigint, node bigint, size bigint, brief binary, sketch binary, text binary"

    def list_members(batches):
        press = zstandard.ZstdCompressor(level=3)
        for row in rows_of(batches):
            _, w, size, node, text, name, of, sig = own_signatures(row)
            key = np.unique(sig)
            shared = flags_of(row["replies"], len(key))[np.searchsorted(key, sig)]
            of, sig = of[shared], sig[shared]
            used = np.unique(of)
            brief, sketches = bit_sketches(text, name, size, 2), bit_sketches(text, name, size)
            raw = w.data.tobytes()
            texts = [press.compress(raw[w.bounds[i]:w.bounds[i + 1]]) for i in used.tolist()]
            none = [None] * len(sig)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*sig.view(np.int64).tolist(), *[None] * len(used)], pa.int64()),
                 pa.array([*node[of].tolist(), *node[used].tolist()], pa.int64()),
                 pa.array([*none, *size[used].tolist()], pa.int64()),
                 pa.array([*none, *[brief[i] for i in used.tolist()]], pa.binary()),
                 pa.array([*none, *[sketches[i] for i in used.tolist()]], pa.binary()),
                 pa.array([*none, *texts], pa.binary())],
                names=["sig", "node", "size", "brief", "sketch", "text"])

    texts = stage(packed.mapInArrow(list_texts, "doc_id bigint, size bigint, node bigint"), "jaccard-texts")
    replies = answer(packed.mapInArrow(send, "pack bigint, range int, block binary"), ranges, shared_by_two)
    found, found_at = stage_at(packed.join(replies, "pack", "left").mapInArrow(list_members, schema), "jaccard-members")
    discard(docs.sparkSession, packs_at)
    # Packs that hold equal sets list their signatures alike.
    listed, listed_at = stage_at(found.filter("sig is not null").select("sig", "node").distinct(), "jaccard-listed")
    nodes = stage(found.filter("sig is null").drop("sig"), "jaccard-nodes")
    members, members_at = stage_at(telling(listed), "jaccard-signatures")
    discard(docs.sparkSession, found_at, listed_at)
    return texts, members, nodes, members_at


def telling(members: DataFrame) -> DataFrame:
    """The members of one signature of those that have the same nodes: the
    others give the same pairs."""
    name = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"name_{i}") for i in (0, 1)]
    same = members.groupBy("sig").agg(F.count("*").alias("crowd"), *name)
    kept = same.filter("crowd > 1").groupBy("crowd", "name_0", "name_1").agg(F.min("sig").alias("sig")).select("sig")
    return members.join(kept, "sig", "left_semi")


def _sketch_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and bit sketches allow."""
    light = nodes.groupBy("node").agg(F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    both = (pairs.join(light.select(F.col("node").alias("a"), F.col("size").alias("size_a"),
                                    F.col("sketch").alias("sketch_a")), "a")
            .join(light.select(F.col("node").alias("b"), F.col("size").alias("size_b"),
                               F.col("sketch").alias("sketch_b")), "b")
            .filter(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")))

    def run(batches):
        for batch in batches:
            keep = []
            for sa, sb, x, y in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                width = min(len(x), len(y))
                diff = folded([x], width) ^ folded([y], width)
                keep.append(int(np.bitwise_count(diff).sum()) <= min(sa, sb) * (100 - percent) // percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b") \
        .mapInArrow(run, "a bigint, b bigint")


def likely(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """All rows of ``nodes`` that are in ``pairs`` (a, b), and few others: those
    whose first bits are a paired node's. These bits are set in 64-bit words,
    16 bits for each node of ``pairs`` or 2**FILTER_BITS in all, and the words
    are broadcast, so the texts of the other nodes are not exchanged."""
    bits = min(FILTER_BITS, max(7, (32 * pairs.count()).bit_length()))
    word = F.shiftrightunsigned("node", 64 - bits + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(node, {64 - bits}) & 63 as int))")
    words = (pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy(word.alias("word"))
             .agg(F.bit_or(bit).alias("bits")))
    # A semi join: Spark would move that of ``verified`` in front of an inner one.
    return nodes.join(F.broadcast(words), (word == F.col("word")) & (F.col("bits").bitwiseAND(bit) != 0), "left_semi")


def verified(pairs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose exact sets link. Texts are fetched for these only."""
    pairs, pairs_at = stage_at(pairs, "jaccard-pairs")
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts, texts_at = stage_at(likely(nodes.select("node", "text"), pairs).join(needed, "node", "left_semi")
                               .dropDuplicates(["node"]), "jaccard-pair-texts")
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    def run(batches):
        for batch in batches:
            press = zstandard.ZstdDecompressor()
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                raw = [press.decompress(t.as_py()) for c in ("text_a", "text_b")
                       for t in part.column(part.schema.get_field_index(c))]
                bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
                text, name = shingles(Words(np.frombuffer(b"".join(raw), np.uint8), bounds, True), k)
                at = np.searchsorted(text, np.arange(len(raw) + 1))
                n, keep = part.num_rows, []
                for i in range(n):
                    x, y = name[at[i]:at[i + 1]], name[at[n + i]:at[n + i + 1]]
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * same >= percent * (len(x) + len(y) - same))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = stage(both.mapInArrow(run, "a bigint, b bigint"), "jaccard-links")
    discard(nodes.sparkSession, pairs_at, texts_at)
    return links


def star_pairs(members: DataFrame) -> DataFrame:
    """Each node of a signature with the signature's most popular node: the one
    whose signatures have the most members."""
    crowd = members.groupBy("sig").agg(F.count("*").alias("crowd"))
    fame = members.join(crowd, "sig").groupBy("node").agg(F.sum("crowd").alias("fame"))
    hub = (members.join(fame, "node").groupBy("sig")
           .agg(F.max(F.struct("fame", "node")).alias("top")).select("sig", F.col("top.node").alias("a")))
    return (members.join(hub, "sig").filter(F.col("a") != F.col("node"))
            .select("a", F.col("node").alias("b")).distinct())


def cross_pairs(members: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int,
                block: int = 4096, crowd: int = CROWD) -> DataFrame:
    """Pairs that share a signature but no component, and that sizes and brief
    sketches allow. A signature's nodes are dealt into blocks; every two
    blocks are compared once. The nodes of crowded signatures bring whole
    sketches and the list of these signatures, as many as a node has."""
    placed = stage(members.join(labels, "node", "left")
                   .select("sig", "node", F.coalesce("label", "node").alias("label")), "jaccard-placed")
    open_ = (placed.groupBy("sig").agg(F.count("*").alias("crowd"), F.min("label").alias("low"),
                                       F.max("label").alias("high"))
             .filter("low < high").select("sig", F.ceil(F.col("crowd") / block).cast("int").alias("blocks"),
                                          (F.col("crowd") > crowd).alias("crowded")))
    shared = (placed.join(open_.filter("crowded"), "sig").groupBy("node")
              .agg(F.sort_array(F.collect_set("sig")).alias("crowds")))
    light = nodes.groupBy("node").agg(F.first("size").alias("size"), F.first("brief").alias("brief"),
                                      F.first("sketch").alias("sketch")).join(shared, "node", "left")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.least(F.col("own"), x).alias("i"), F.greatest(F.col("own"), x).alias("j")))
    dealt = (placed.join(open_, "sig").withColumn("own", own).withColumn("part", F.explode(each))
             .select("sig", "part.i", "part.j", "own", "node", "label", "crowded").join(light, "node")
             .select("sig", "i", "j", "own", "node", "label", "size",
                     F.when(F.col("crowded"), F.col("sketch")).otherwise(F.col("brief")).alias("brief"),
                     F.when(F.col("crowded"), F.col("crowds")).alias("crowds")))
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compared(group: pa.RecordBatch):
        """Index pairs of one signature's block pair."""
        own, node, label, size = (group.column(c).to_numpy() for c in (3, 4, 5, 6))
        i, j = group.column(1)[0].as_py(), group.column(2)[0].as_py()
        raw = group.column(7).to_pylist()
        bits = folded(raw, min(map(len, raw)))
        sig, crowds = group.column(0)[0].as_py(), group.column(8).to_pylist()
        # The signatures before this one: where a pair shares one, it is compared there.
        before = [frozenset(c[:c.index(sig)]) for c in crowds] if crowds[0] is not None else None
        left = np.flatnonzero(own == i)
        right = np.flatnonzero(own == j)
        for x in left.tolist():
            y = right[right > x] if i == j else right
            y = y[(label[y] != label[x])]
            y = y[possible(size[x], size[y], percent)]
            if len(y):
                apart = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1)
                for z in y[apart <= differing(np.minimum(size[x], size[y]), percent)].tolist():
                    if before is None or before[x].isdisjoint(before[z]):
                        yield int(node[x]), int(node[z])

    def run(batches):
        held, own = [], None

        def flush():
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            pairs = list(compared(table)) if table.num_rows > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([min(p) for p in pairs], pa.int64()),
                                               pa.array([max(p) for p in pairs], pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (0, 1, 2)])
            cut = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cut[:-1], cut[1:]):
                key = tuple(keys[:, lo].tolist())
                if key != own and held:
                    yield flush()
                    held = []
                own = key
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield flush()

    return (dealt.repartition(parts, "sig", "i", "j").sortWithinPartitions("sig", "i", "j")
            .mapInArrow(run, "a bigint, b bigint").distinct())


def components(links: DataFrame) -> DataFrame:
    """node, label (the least node reachable) of all nodes in ``links`` (a, b),
    by alternating large and small stars; every step aggregates and joins, and
    ends in a staged table."""
    spark = links.sparkSession
    edges, edges_at = stage_at(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                               .distinct(), "components")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, large_at = stage_at(large.filter("u != v").distinct(), "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        new, new_at = stage_at(small.filter("u != v").distinct(), "components")
        discard(spark, edges_at, large_at)
        # Done when every node has one edge and no centre has any.
        if new.groupBy("u").count().filter("count > 1").isEmpty() and \
                new.join(new.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                new.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        edges, edges_at = new, new_at


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
            percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: per row."""
    texts, members, nodes, members_at = sketched(docs, id_col, text_col, k, percent)
    links = verified(_sketch_pairs(star_pairs(members), nodes, percent), nodes, k, percent)
    labels = components(links)
    pairs = cross_pairs(members, labels, nodes, percent)
    discard(docs.sparkSession, members_at)
    more = verified(_sketch_pairs(pairs, nodes, percent), nodes, k, percent)
    labels = stage(components(links.union(more)), "jaccard-labels")
    named = stage(texts.filter("size > 0").join(labels, "node", "left")
                  .select("doc_id", "size", F.coalesce("label", "node").alias("label")), "jaccard-classes")
    first = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return (named.join(first, "label").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
            .union(texts.filter("size = 0").select("doc_id", "size", "doc_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """One row of each class: the one with the least id (none comes after all),
    then the least number in the staged table. Classes decide, not ids: rows
    with one id and different texts each count for their class."""
    # The document travels as one struct, so no name of its columns can clash.
    rows = stage(docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"),
                             F.monotonically_increasing_id().alias("number")), "jaccard-rows")
    ids = rows.select(F.col("number").alias("of"), "id")
    texts = rows.select("number", F.col("row").getField(text_col).alias("text"))
    kept = (classes(texts, "number", "text", k, percent).join(ids, F.col("doc_id") == F.col("of"))
            .groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "of")).alias("least"))
            .select(F.col("least.of").alias("kept")))
    return rows.join(kept, F.col("number") == F.col("kept"), "left_semi").select("row.*")
