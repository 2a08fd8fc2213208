"""Model bundles: whole versions only, and scoring that fits nothing."""
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from lodgeframe.columns import COLS
from lodgeframe.operators import estimate as E
from lodgeframe.plans import bundle as B
from lodgeframe.plans import listings as L
from lodgeframe.plans import ml as M
from lodgeframe.sources import files as FS


@pytest.fixture(scope="module")
def root(spark, sf_small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bundles"))
    assert B.train(L.dash(spark, sf_small), root, kind="lr") == 1
    return root


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame([(1, "FRANCE", "Private room", 10), (2, "nowhere", "Private room", 200), (3, None, None, 365),
                                  (4, "FRANCE", "Hotel room", 0)],
                                 f"{COLS.key} bigint, {COLS.subzone} string, {COLS.kind} string, {COLS.availability} int")


def test_scoring_fits_nothing_and_reads_only_the_requests(spark, root, requests, monkeypatch):
    def refuse(*_):
        raise AssertionError("fitted while scoring")
    monkeypatch.setattr(Pipeline, "fit", refuse)
    monkeypatch.setattr(M, "fit", refuse)
    bundle = B.load(spark, root)
    out = B.score(bundle, requests.withColumn("nights", F.lit(7)), nights="nights")
    assert not [f for f in out.inputFiles() if "testdata" in f]
    rows = {r[COLS.key]: r for r in out.collect()}
    assert sorted(rows) == [1, 2, 3, 4] and all(r.estimate > 0 and r.estimate_low <= r.estimate <= r.estimate_high for r in rows.values())
    assert all(abs(r.stay_estimate - 7 * r.estimate) < 1e-9 for r in rows.values())
    overall = bundle.tables["global_medians"].first()
    assert rows[2][COLS.nights] == overall[COLS.nights]


def test_a_bundle_scores_as_the_lookups_it_was_made_from(spark, root, requests, sf_small):
    bundle, d = B.load(spark, root), L.dash(spark, sf_small)
    own = E.attach_centroid(E.impute_from_group(requests, d, [COLS.subzone, COLS.kind], E.imputed_features()), d,
                            COLS.subzone, COLS.lat, COLS.lon)
    plain = {r[COLS.key]: r for r in own.collect()}
    for r in B.score(bundle, requests).collect():
        for c in [*E.imputed_features(), COLS.lat, COLS.lon]:
            assert r[c] == pytest.approx(plain[r[COLS.key]][c], rel=1e-12)


def test_half_written_versions_are_refused_and_not_reused(spark, root, tmp_path):
    whole = B.load(spark, root)
    at = str(tmp_path / "b")
    tables = {n: t for n, t in whole.tables.items()}
    assert B.save(spark, at, whole.pipeline, tables, {"r2": 0.5}) == 1
    whole.pipeline.write().save(f"{at}/v000002/pipeline")  # a save that died here
    assert B.versions(spark, at) == [1] and B.load(spark, at).version == 1
    with pytest.raises(B.IncompleteBundle):
        B.load(spark, at, 2)
    with pytest.raises(FileNotFoundError):
        B.load(spark, at, 9)
    assert B.save(spark, at, whole.pipeline, tables, {"r2": 0.6}) == 3
    assert B.load(spark, at).metrics == {"r2": 0.6} and B.load(spark, at, 1).metrics == {"r2": 0.5}
    FS.delete(spark, f"{at}/v000003/centroids")
    with pytest.raises(B.IncompleteBundle):
        B.load(spark, at)
    with pytest.raises(FileNotFoundError):
        B.load(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        B.save(spark, at, whole.pipeline, {}, {})


def test_a_bundle_with_a_changed_table_is_refused(spark, root, tmp_path):
    whole = B.load(spark, root)
    at = str(tmp_path / "c")
    B.save(spark, at, whole.pipeline, whole.tables, {})
    whole.tables["centroids"].limit(1).write.mode("append").parquet(f"{at}/v000001/centroids")
    with pytest.raises(B.IncompleteBundle):
        B.load(spark, at)
