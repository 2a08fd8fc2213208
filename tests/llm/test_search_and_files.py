"""Token files, the treap search and shared lists: round trips, brute force
and edge cases on small tables."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodgeframe.llm import anchor_lists, impact_treap, token_files
from lodgeframe.llm.packing import vocabulary_path
from lodgeframe.llm.shared_arrays import load
from lodgeframe.session import scratch_path

LONG = "word " * 30000 + "x" * 70000
DOCS = [(7, "The quick brown fox", "n"), (None, "ünder été 12 The", "s"), (-3, None, "x"), (4, "", "x"),
        (4, "The quick brown fox", "x"), (4, "The quick brown fox", "x"), (2, LONG, None), (None, "The", "x"), (9, " \n\t", "x")]
DOC_SCHEMA = "doc_id bigint, text string, name string"


@pytest.mark.parametrize("top", [1 << 8, 1 << 16, 1 << 24, 1 << 32])
def test_codes_round_trip(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        values = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        values[:2] = [0, top - 1][:n]
        control, data = token_files.encode(values)
        assert len(control) == -(-n // 4)
        assert token_files.decode(control, data, n).tolist() == values.tolist()


def test_token_files_hold_all_documents_in_order(spark):
    docs = spark.createDataFrame(DOCS, DOC_SCHEMA).repartition(3)
    folder = scratch_path(spark, "token-test")
    files = token_files.store(docs, folder, block_values=1000, file_values=500, task_values=4000).cache()
    rows = token_files.read(files, folder, keep_ids=True).collect()
    rows.sort(key=lambda r: r.start)
    tok = Tokenizer.from_file(vocabulary_path())
    want = Counter((i, tuple([*tok.encode(t or "", add_special_tokens=False).ids, 2])) for i, t, _ in DOCS)
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    order = [(r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in rows]
    assert order == sorted(order)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    assert all(r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    counts = Counter(i for r in rows for i in r.ids)
    assert np.asarray(load(folder, "ids_by_rank")).tolist() == sorted(counts, key=lambda i: (-counts[i], i))
    assert files.count() > 3 and files.agg({"n_docs": "sum"}).first()[0] == len(DOCS)


def test_token_files_of_an_empty_table(spark):
    assert token_files.round_trip(spark.createDataFrame([], DOC_SCHEMA)).collect() == []


def test_a_file_that_was_cut_is_refused(tmp_path):
    with open(tmp_path / "a", "wb") as f:
        out = token_files.FileWriter(f, 4)
        for i in range(5):
            out.add(i, np.arange(i * 3, dtype=np.uint32))
        out.close()
    with open(tmp_path / "a", "rb") as f:
        assert [(d, r.tolist()) for d, r in token_files.read_file(f)] == [(i, list(range(i * 3))) for i in range(5)]
    whole = (tmp_path / "a").read_bytes()
    (tmp_path / "b").write_bytes(whole[:-3])
    with open(tmp_path / "b", "rb") as f, pytest.raises(ValueError):
        list(token_files.read_file(f))


def plain_ranking(docs, items, k):
    def terms(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    n_docs, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 100 - 50 + 50 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("k,block_bytes", [(3, 200), (5, 2000), (50, 1 << 20)])
def test_treap_search_matches_brute_force(spark, k, block_bytes):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(60)] + ["Été", "été", "12", "x-y", "日本"]
    docs = [(rng.choice([None, i, i, i, i // 2]), " ".join(words[min(int(rng.paretovariate(0.5)), 64)] for _ in range(rng.randrange(40))))
            for i in range(250)] + [(900, None), (901, ""), (902, "... !"), (903, "w1 " * 30000), (904, "w1 " * 30000)]
    items = [(i % 9, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "nowhere"), (None, "w2 w2 w3")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, score bigint").repartition(3)
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, names string")
    got = impact_treap.rank(d, b, k=k, block_bytes=block_bytes, block_items=7).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_ranking(docs, items, k))


def test_treap_search_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert impact_treap.rank(d.limit(0), b).collect() == []
    assert impact_treap.rank(d, b.limit(0)).collect() == []
    assert impact_treap.rank(d, b).collect()[0].asDict() == {"item_id": 1, "rank": 1, "doc_id": 1, "score": 287 * (10**9 // 3000)}


def test_a_treap_cell_holds_the_greatest_impact_below_it():
    rng = np.random.default_rng(0)
    at = rng.choice(37 * 21, 200, replace=False)
    rows, columns, impacts = at // 21, at % 21, rng.integers(0, 1000, 200)
    tree = impact_treap.Treap.opened(*impact_treap.Treap.built(rows, columns, impacts))
    full = np.zeros((64, 64), np.int64)
    full[rows, columns] = impacts

    def check(cell, row, column, size):
        assert tree.most[cell] == full[row:row + size, column:column + size].max()
        if size > 1:
            for q in range(4):
                if tree.quarters[cell] >> q & 1:
                    child = tree.first[cell] + impact_treap.BEFORE[tree.quarters[cell], q]
                    check(child, row + (q >> 1) * size // 2, column + (q & 1) * size // 2, size // 2)
    check(0, 0, 0, 1 << tree.height)


def plain_negatives(rows, every=50, low=50, high=95):
    held = set()
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a, ya, va in held:
        if a % every:
            continue
        near = sorted((-sum(x * y for x, y in zip(va, v)), i, y) for i, y, v in held if i != a and len(v) == len(va))
        for p, i, _ in [n for n in near if n[2] == ya][:5]:
            fit = [n for n in near if n[2] != ya and low * -p <= 100 * -n[0] <= high * -p]
            out += [(a, i, r + 1, j, -p, -s) for r, (s, j, _) in enumerate(fit[:3])]
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"block_rows": 40, "round_rows": 4, "step": 7}])
def test_hard_negatives_match_brute_force(spark, options):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(6, 8))
    rows = [(int(i), (centre[rng.integers(6)] + rng.normal(size=8) * 0.6).tolist(), int(rng.integers(10))) for i in range(400)]
    rows += [(1000 + i, rows[3][1], 3) for i in range(150)]  # one vector, many ids: ties by id
    rows += [(50, None, 1), (None, rows[0][1], 1), (2000, [None] * 8, 1), (2050, [float("nan")] * 8, 2), (2100, rows[9][1], None),
             (2150, [float("inf")] * 8, 2), (2200, [1.0, 2.0], 1), (2201, [1.0, 2.5], 1), (2202, [1.0, 1.0], 2),
             (2250, [0.0] * 8, 1), (2251, [], 1), (2300, [], 1), rows[0], rows[0]]
    d = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, label int, anchor int, code int")
    got = Counter(tuple(r) for r in anchor_lists.hard_negatives(d.repartition(3), **options)
                  .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == plain_negatives(rows) and len(got) > 100
    assert anchor_lists.hard_negatives(d.limit(0)).collect() == []


def test_hard_negatives_of_large_values_are_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(0.5, 1) * 1e6 for _ in range(3)], i % 2) for i in range(1, 120)]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = Counter(tuple(r) for r in anchor_lists.hard_negatives(d).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == plain_negatives(rows) and got
    far = spark.createDataFrame([(50, [1e20], 1), (51, [1e20], 1)], "vec_id bigint, embedding array<double>, label int")
    with pytest.raises(Exception, match="OverflowError"):
        anchor_lists.hard_negatives(far).collect()


def test_a_walk_stops_before_the_end_of_its_list():
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(size=(4000, 4)) * 256)
    lists = anchor_lists.Lists(rows, rows[:8], np.array([8]))
    for first, end, order, bound, size in lists:
        exact = lists.scores(np.arange(first, end), order)
        assert (exact <= bound[:, None] * size).all() and (np.diff(bound) <= 0).all()


def test_clusters_put_near_anchors_together():
    rng = np.random.default_rng(3)
    centre = np.eye(5) * 100
    group = anchor_lists.clustered(np.repeat(centre, 30, axis=0) + rng.normal(size=(150, 5)), 5)
    assert all(len(set(group[30 * i:30 * i + 30].tolist())) == 1 for i in range(5))
