"""Model bundles (S10): all that scoring needs, saved as one version.

A bundle holds the fitted pipeline, the group and global medians, the
centroids, the ordinal codes of the categories and the metrics. Each save is a
new folder below the bundle's root::

    v000001/pipeline  group_medians  global_medians  centroids  codes  manifest

The manifest names the tables with their schemas and row counts, the roles of
columns, and the metrics; it is written last. A folder without it is half
written: it is never loaded by itself, an explicit request for it is refused,
and its number is not used again. Readers of an older version are not
disturbed by a save.
"""
from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodgeframe.columns import COLS, LAT_CENTER, LAT_JFK, LON_CENTER, LON_JFK, ListingColumns
from lodgeframe.functions import scalars as S
from lodgeframe.operators import estimate as E
from lodgeframe.plans import ml as M
from lodgeframe.sources import files as FS

FORMAT = 1
MANIFEST = "manifest"
TABLES = ("group_medians", "global_medians", "centroids", "codes")


class IncompleteBundle(ValueError):
    """A version without a whole manifest, or not as its manifest says."""


@dataclass(frozen=True)
class Bundle:
    path: str
    version: int
    pipeline: PipelineModel
    tables: dict[str, DataFrame]
    manifest: dict

    @property
    def metrics(self) -> dict:
        return self.manifest["metrics"]


def _folder(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v{version:06d}"


def versions(spark: SparkSession, root: str, whole: bool = True) -> list[int]:
    """Numbers of the versions there, by default only whole ones."""
    found = [int(n[1:]) for n in FS.children(spark, root) if n[:1] == "v" and n[1:].isdigit()]
    return [v for v in found if not whole or FS.exists(spark, f"{_folder(root, v)}/{MANIFEST}/_SUCCESS")]


def save(spark: SparkSession, root: str, pipeline: PipelineModel, tables: Mapping[str, DataFrame],
         metrics: Mapping[str, float], **about) -> int:
    """Save a new version; its number."""
    if set(tables) != set(TABLES):
        raise ValueError(f"a bundle has the tables {TABLES}")
    version = max(versions(spark, root, whole=False), default=0) + 1
    path = _folder(root, version)
    pipeline.write().save(f"{path}/pipeline")
    listed = {}
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
        back = spark.read.schema(table.schema).parquet(f"{path}/{name}")
        listed[name] = {"schema": json.loads(table.schema.json()), "rows": back.count()}
    note = json.dumps({"format": FORMAT, "version": version, "tables": listed, "metrics": dict(metrics), **about})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.text(f"{path}/{MANIFEST}")
    return version


def load(spark: SparkSession, root: str, version: int | None = None) -> Bundle:
    """A version, the newest whole one by default. Tables are checked against
    the manifest's row counts."""
    there = versions(spark, root)
    if version is None:
        if not there:
            raise FileNotFoundError(f"no whole bundle at {root}")
        version = max(there)
    path = _folder(root, version)
    if not FS.exists(spark, path):
        raise FileNotFoundError(path)
    if version not in there:
        raise IncompleteBundle(f"{path} has no whole manifest")
    note = json.loads(spark.read.text(f"{path}/{MANIFEST}").first()[0])
    if note.get("format") != FORMAT:
        raise IncompleteBundle(f"{path} is of format {note.get('format')}, not {FORMAT}")
    tables = {}
    for name, told in note["tables"].items():
        if not FS.exists(spark, f"{path}/{name}"):
            raise IncompleteBundle(f"{path} lacks {name}")
        tables[name] = spark.read.schema(StructType.fromJson(told["schema"])).parquet(f"{path}/{name}")
        if tables[name].count() != told["rows"]:
            raise IncompleteBundle(f"{path}/{name} has not {told['rows']} rows")
    return Bundle(path, version, PipelineModel.load(f"{path}/pipeline"), tables, note)


def with_distances(df: DataFrame, cols: ListingColumns = COLS) -> DataFrame:
    return df.select("*", S.planar_distance(cols.lat, cols.lon, LAT_CENTER, LON_CENTER).alias("distance_center"),
                     S.planar_distance(cols.lat, cols.lon, LAT_JFK, LON_JFK).alias("distance_jfk"))


def request_features(cols: ListingColumns = COLS) -> list[str]:
    """What a request has or gets: its availability, the imputed features, a
    place, and the distances from it."""
    return [cols.availability, *E.imputed_features(cols), cols.lat, cols.lon, "distance_center", "distance_jfk"]


def train(df: DataFrame, root: str, kind: str = "gbt", iteration: int = 1, cols: ListingColumns = COLS,
          categorical: Sequence[str] | None = None, train_fraction: float = 0.8) -> int:
    """Fit the estimator behind batch scoring on ``ln(value)`` of the
    dashboard frame, and save it with its lookups; the version's number."""
    spark = df.sparkSession
    categorical = list(categorical or (cols.kind, cols.subzone))
    label = "log_label"
    used = dict.fromkeys([cols.key, cols.subzone, cols.kind, *categorical, *request_features(cols), label])
    data = with_distances(df, cols).withColumn(label, S.log_label(cols.value)).select(*used).persist()
    try:
        fitted_on, test = M.train_test(data, train_fraction, cols.key, M.SEED)
        stages = M.feature_stages(data, categorical=categorical, numeric=request_features(cols))
        model = M.fit_evened(fitted_on, data.count(), stages, M.estimator(kind, iteration, label=label))
        metrics = M.evaluate(model.transform(test), label, plus_one=False)
        features = E.imputed_features(cols)
        tables = {"group_medians": E.group_medians(data, [cols.subzone, cols.kind], features),
                  "global_medians": E.global_medians(data, features),
                  "centroids": E.centroids(data, cols.subzone, cols.lat, cols.lon),
                  "codes": M.ordinal_codes(fitted_on, categorical)}
        return save(spark, root, model, tables, metrics, estimator=kind, iteration=iteration, label=label,
                    keys=[cols.subzone, cols.kind], features=features, plus_one=False)
    finally:
        data.unpersist()


def score(bundle: Bundle, requests: DataFrame, nights: str | None = None, cols: ListingColumns = COLS) -> DataFrame:
    """Requests (sub-zone, kind, availability) with medians (J1), centroid
    (J2), distances (F11), price interval (F16) and stay cost (F17), all from
    the bundle: nothing is fitted, and only the requests are read."""
    note, t = bundle.manifest, bundle.tables
    out = E.impute_from_lookup(requests, t["group_medians"], t["global_medians"], note["keys"], note["features"])
    out = E.attach_known_centroid(out, t["centroids"], cols.subzone, cols.lat, cols.lon)
    return M.score_requests(bundle.pipeline, with_distances(out, cols), bundle.metrics["mae_price"], nights=nights,
                            label_plus_one=note["plus_one"])


def contents(bundle: Bundle) -> DataFrame:
    """table_name, n_rows, n_columns of a bundle's tables, read back."""
    spark, parts = next(iter(bundle.tables.values())).sparkSession, None
    for name, table in bundle.tables.items():
        own = table.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(table.columns)).alias("n_columns"))
        parts = own if parts is None else parts.unionByName(own)
    return parts if parts is not None else spark.createDataFrame([], "table_name string, n_rows long, n_columns int")
