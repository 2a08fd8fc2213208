"""Spark ML: finite metrics, no leakage of test rows, round trip, top-k."""
import math
import re
import tempfile
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StopWordsRemover, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lodgeframe.columns import COLS
from lodgeframe.operators import sampling as T
from lodgeframe.plans import listings as L
from lodgeframe.plans import ml as M


def test_linear_model_metrics_are_finite(spark, sf_small):
    out = M.compare_models(L.gold(spark, sf_small), ["lr"], 1).first()
    assert out.model == "linear_regression"
    assert all(math.isfinite(v) for v in (out.r2, out.rmse, out.mae_price))
    assert out.n_train + out.n_test == L.gold(spark, sf_small).count()


def test_features_exclude_leakage(spark, sf_small):
    feats = M.numeric_features(L.gold(spark, sf_small))
    assert not {"price", "price_vs_zone_pct", "zone_avg_price", "zone_type_avg_price", M.LABEL, "id", "host_id"} & set(feats)
    leaky = L.gold(spark, sf_small).withColumn("twin", F.col(M.LABEL) * 3 + 1)
    assert M.screened_leaks(leaky) == ["twin"] and "twin" not in M.numeric_features(leaky, leaks=["twin"])


def test_model_roundtrip_and_importances(spark, sf_small):
    g = L.gold(spark, sf_small)
    train, test = T.train_test(g, 0.8, COLS.key, 42)
    model = M.fit(train, M.feature_stages(g), M.estimator("rf", 1))
    path = tempfile.mkdtemp(prefix="lf-model-")
    M.save_model(model, path)
    a = model.transform(test).select(COLS.key, "prediction")
    b = M.load_model(path).transform(test).select(COLS.key, "prediction")
    assert a.exceptAll(b).count() == 0 and b.count() == test.count()
    top = M.top_importances(spark, model, model.transform(test), k=15).collect()
    assert len(top) == 15 and top[0].importance >= top[-1].importance


@pytest.fixture(scope="module")
def signal(spark):
    """A label that follows three of six columns closely, one of them by steps."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 5))
    y = 3 * x[:, 0] - 2 * np.sign(x[:, 1]) + 0.5 * x[:, 2] + rng.normal(size=3000) * 0.1 + 10
    rows = [(i, *map(float, v), "abc"[i % 3], float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x0 double, x1 double, x2 double, x3 double, x4 double, "
                                       "kind string, price_log double").persist()


def _fit(signal, est):
    train, test = T.train_test(signal, 0.8, "id", 42)
    model = M.fit(train, M.feature_stages(signal, categorical=["kind"], numeric=[f"x{i}" for i in range(5)]), est)
    pred = model.transform(test)
    return model, pred, M.evaluate(pred)


def test_models_find_a_strong_signal(spark, signal):
    r2 = {}
    for kind in ("lr", "rf", "gbt"):
        model, pred, m = _fit(signal, M.estimator(kind, 1))
        r2[kind] = m["r2"]
        if kind != "lr":
            top = [r.feature for r in M.top_importances(spark, model, pred, 3).collect()]
            assert top[:2] == ["x0", "x1"]
    assert r2["lr"] > 0.8 and r2["rf"] > 0.85 and r2["gbt"] > 0.95


def test_the_trainers_booster_beats_a_small_one(signal):
    small = _fit(signal, M.estimator("gbt", 1).setMaxIter(5).setMaxDepth(2))[2]
    large = _fit(signal, M.estimator("gbt", 3).setMaxIter(40).setMaxDepth(4))[2]
    assert large["r2"] > small["r2"] + 0.05
    full = M.estimator("gbt", 3)
    assert (full.getMaxIter(), full.getMaxDepth(), full.getStepSize()) == (400, 8, 0.06)


def test_elastic_net_on_sums_equals_the_estimator(signal):
    names = [f"x{i}" for i in range(5)]
    for reg, mix in ((0.01, 0.3), (0.5, 0.9), (0.2, 0.0)):
        own, base = M.elastic_net(M.gram_sums(signal, names).first().asDict(), names, reg=reg, mix=mix)
        est = M.estimator("lr", 1).setRegParam(reg).setElasticNetParam(mix).setTol(1e-13).setMaxIter(1000)
        model = est.fit(VectorAssembler(inputCols=names, outputCol="features").transform(signal))
        assert np.allclose([*own, base], [*model.coefficients, model.intercept], atol=1e-6)
    constant = signal.withColumn("x3", F.lit(2.0))
    assert M.elastic_net(M.gram_sums(constant, names).first().asDict(), names)[0][3] == 0


def test_the_grid_has_a_row_per_model_and_iteration(signal, monkeypatch):
    small = {k: {"lr": {}, "rf": dict(numTrees=3, maxDepth=2), "gbt": dict(maxIter=2, maxDepth=2)} for k in (1, 2)}
    monkeypatch.setattr(M, "ITERATION_PARAMS", small)
    fits, times, fit = [], {}, Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, params=None: fits.append(1) or fit(self, df, params))
    named = signal.withColumn("name", F.concat_ws(" ", "kind", F.lit("flat")))
    out = M.compare_grid({1: (signal, None), 2: (named, "name")}, categorical=["kind"], times=times).collect()
    assert {(r.model, r.iteration) for r in out} == {(m, i) for m in M.MODEL_NAMES.values() for i in (1, 2)}
    assert len(fits) == 2 and set(times) == {(k, i) for k in M.MODEL_NAMES for i in (1, 2)}
    assert all(r.n_train + r.n_test == 3000 and math.isfinite(r.r2) for r in out)


def _murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3 (32 bits, little-endian), signed."""
    h, mask = seed, 0xFFFFFFFF

    def stir(k):
        k = k * 0xCC9E2D51 & mask
        k = (k << 15 | k >> 17) & mask
        return k * 0x1B873593 & mask
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h ^= stir(int.from_bytes(data[i:i + 4], "little"))
        h = (h << 13 | h >> 19) & mask
        h = (h * 5 + 0xE6546B64) & mask
    if data[whole:]:
        h ^= stir(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h ^= h >> shift
        h = h * factor & mask
    return h - (1 << 32) if h >> 31 else h


def test_every_slot_and_weight_of_the_text_features(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    train, _ = T.train_test(docs, 0.8, "doc_id", 42)
    stages = M.text_stages("text")
    out = Pipeline(stages=stages).fit(train).transform(docs).select(
        "doc_id", "text", "tokens", "kept_tokens", vector_to_array("token_counts").alias("tf"),
        vector_to_array("token_weights").alias("w")).collect()
    stop = set(StopWordsRemover.loadDefaultStopWords("english"))
    taught = {r.doc_id for r in train.select("doc_id").collect()}
    counts = {}
    for r in out:
        words = [t for t in re.split(r"[^a-zA-Z0-9_]", r.text.lower()) if t]
        kept = [t for t in words if t not in stop]
        assert r.tokens == words and r.kept_tokens == kept
        counts[r.doc_id] = Counter(_murmur3(t.encode()) % 100 for t in kept)
        assert {i: n for i, n in enumerate(r.tf) if n} == counts[r.doc_id]
    df = Counter(i for d, c in counts.items() if d in taught for i in c)
    idf = [math.log((len(taught) + 1) / (df[i] + 1)) for i in range(100)]
    for r in out:
        assert np.allclose(r.w, [counts[r.doc_id][i] * idf[i] for i in range(100)], rtol=1e-12)


def test_ordinal_codes_of_unknown_labels(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "x"), ("b", "z")], "k string, z string")
    codes = M.ordinal_codes(df, ["k", "z"])
    asked = spark.createDataFrame([("a", "z"), ("c", None), (None, "x")], "k string, z string")
    assert [(r.k_code, r.z_code) for r in M.apply_ordinal(asked, codes, ["k", "z"]).orderBy("z").collect()] == [
        (-1.0, -1.0), (-1.0, 0.0), (0.0, 2.0)]


def test_training_rows_lie_in_few_partitions(spark, sf_small):
    cores = spark.sparkContext.defaultParallelism
    g = L.gold(spark, sf_small).repartition(5 * cores, COLS.key)
    held = M.prepared(g)[:2]
    assert all(1 <= part.rdd.getNumPartitions() <= cores for part in held)
    assert sum(part.count() for part in held) == g.count()
    # Many rows keep their partitions.
    assert M.evened(g, 10 * cores, each=1).rdd.getNumPartitions() == 5 * cores
    for part in held:
        part.unpersist()


def test_training_rows_of_few_partitions_are_dealt_anew(spark):
    cores = spark.sparkContext.defaultParallelism
    n = 100 * cores
    df = spark.range(n).select("id", (F.col("id") % 7).cast("double").alias("x"),
                               F.log1p(F.col("id") % 11).alias(M.LABEL)).coalesce(1).persist()
    stages, seen = [VectorAssembler(inputCols=["x"], outputCol="features")], []
    est = M.estimator("lr")
    fit = est.fit

    class Watched(type(est)):
        def fit(self, rows):
            seen.extend(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
            return fit(rows)
    est.__class__ = Watched
    model = M.fit_evened(df, n, stages, est, each=25)
    # One partition held them all.
    assert sum(seen) == n and len(seen) == 4 * cores and max(seen) <= 50
    plain = M.fit(df, stages, M.estimator("lr"))
    assert model.stages[-1].coefficients[0] == pytest.approx(plain.stages[-1].coefficients[0])
    assert len(model.stages) == 2 and model.transform(df).count() == n
    df.unpersist()
