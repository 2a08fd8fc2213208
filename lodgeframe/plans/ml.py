"""Price regression with Spark ML.

Feature stages (string index, one-hot, tokenise, stop words, hashed TF,
IDF, assemble) and the regressor form one ``Pipeline`` that is fitted on the
training split only, so nothing learnt from test rows leaks into the
stages. The split is the key-hash split (T3): the same rows whatever the
partitioning.

Which numeric columns may be features follows from their roles (keys, the
value, what is derived from it, the label) and from the leakage screen (A18)
on the training part. Training frames are persisted (memory, then disk) while
the iterative estimators run; tree estimators checkpoint every 10 iterations
to the session's checkpoint folder (forests keep node ids for that), so a
lost executor does not replay the whole lineage.
"""
from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (IDF, HashingTF, OneHotEncoder, RegexTokenizer,
                                StopWordsRemover, StringIndexer, VectorAssembler)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lodgeframe.columns import COLS, LEAKAGE_THRESHOLD, ListingColumns, TOP_IMPORTANCES
from lodgeframe.operators.enrich import VALUE_DERIVED
from lodgeframe.operators.explore import leakage_screen
from lodgeframe.operators.sampling import SPACE, key_hash, train_test
from lodgeframe.plans.joins import attach_lookup
from lodgeframe.session import checkpoint_root

LABEL = "price_log"
CATEGORICAL = [COLS.kind, COLS.subzone]
SEED = 42
#: Rows that one task of an iterative estimator takes, where there are enough.
ROWS_PER_TASK = 200_000

# Estimator settings of the two modelling iterations.
ITERATION_PARAMS = {
    1: {"lr": dict(regParam=0.01, elasticNetParam=0.3),
        "rf": dict(numTrees=50, maxDepth=5),
        "gbt": dict(maxIter=30, maxDepth=4, stepSize=0.1)},
    2: {"lr": dict(regParam=0.01, elasticNetParam=0.3),
        "rf": dict(numTrees=120, maxDepth=8),
        "gbt": dict(maxIter=175, maxDepth=6, stepSize=0.05)},
    # The booster of the dashboard's trainer.
    3: {"gbt": dict(maxIter=400, maxDepth=8, stepSize=0.06)},
}
MODEL_NAMES = {"lr": "linear_regression", "rf": "random_forest", "gbt": "gradient_boosted_trees"}


def unusable(label: str = LABEL, cols: ListingColumns = COLS) -> set[str]:
    """Columns whose role rules them out as features: the label, the value,
    what is computed from it, and identifiers."""
    return {label, cols.value, cols.key, cols.host, *VALUE_DERIVED}


def numeric_features(df: DataFrame, label: str = LABEL, leaks: Sequence[str] = (), cols: ListingColumns = COLS) -> list[str]:
    """The numeric columns that may be features; ``leaks`` go too."""
    out = unusable(label, cols) | set(leaks)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in out]


def screened_leaks(train: DataFrame, label: str = LABEL, threshold: float = LEAKAGE_THRESHOLD) -> list[str]:
    """Numeric columns, fit by role, that follow the label too closely on the
    training rows (A18). At most one name per column comes back."""
    names = numeric_features(train, label)
    return [r.column_name for r in leakage_screen(train, label, names, threshold).collect()] if names else []


def category_stages(column: str) -> list:
    """Index and one-hot slots of a column; labels unseen in training share
    one more index."""
    code = f"{column}_code"
    return [StringIndexer(inputCol=column, outputCol=code, handleInvalid="keep"),
            OneHotEncoder(inputCol=code, outputCol=f"{column}_slots")]


def text_stages(column: str, slots: int = 100) -> list:
    """Words, without stop words, counted in hashed slots, weighted by rarity."""
    chain = [RegexTokenizer(outputCol="tokens", pattern="\\W"), StopWordsRemover(outputCol="kept_tokens"),
             HashingTF(outputCol="token_counts", numFeatures=slots), IDF(outputCol="token_weights")]
    source = column
    for stage in chain:
        stage.setInputCol(source)
        source = stage.getOutputCol()
    return chain


def feature_stages(df: DataFrame, categorical: Sequence[str] = CATEGORICAL, text: str | None = None,
                   output: str = "features", num_text_features: int = 100, leaks: Sequence[str] = (),
                   numeric: Sequence[str] | None = None, label: str = LABEL) -> list:
    """The stages up to the assembled vector: ``numeric`` columns (by default
    all that may be features), categories, and the words of ``text``. Rows
    with a null or NaN feature are skipped by the assembler."""
    groups = [category_stages(c) for c in categorical] + ([text_stages(text, num_text_features)] if text else [])
    inputs = [*(numeric_features(df, label, leaks) if numeric is None else numeric),
              *(g[-1].getOutputCol() for g in groups)]
    return [s for g in groups for s in g] + [VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="skip")]


def estimator(kind: str, iteration: int = 1, label: str = LABEL, features: str = "features"):
    params = dict(ITERATION_PARAMS[iteration][kind])
    common = dict(featuresCol=features, labelCol=label)
    if kind == "lr":
        return LinearRegression(**common, **params)
    if kind == "rf":
        return RandomForestRegressor(**common, seed=SEED, checkpointInterval=10, cacheNodeIds=True, **params)
    return GBTRegressor(**common, seed=SEED, checkpointInterval=10, **params)


def fit(train: DataFrame, stages: list, est) -> PipelineModel:
    """Fit feature stages and estimator together, on the training rows."""
    checkpoint_root(train.sparkSession)  # tree checkpoints need the folder
    return Pipeline(stages=list(stages) + [est]).fit(train)


def metrics(predictions: DataFrame, label: str = LABEL, plus_one: bool = True) -> DataFrame:
    """One row (r2, rmse, mae_price, n) from one aggregation. R2 and
    RMSE are on the log label, MAE back in price units (``expm1`` inverts an
    ``ln(1 + price)`` label, ``exp`` an ``ln(price)`` one). A constant label
    gives a null R2, no rows give nulls."""
    back = F.expm1 if plus_one else F.exp
    y, p = F.col(label), F.col("prediction")
    squared = (y - p) * (y - p)
    both = predictions.filter(y.isNotNull() & p.isNotNull())
    return both.agg(
        (1 - F.try_divide(F.avg(squared), F.var_pop(y))).alias("r2"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        F.avg(F.abs(back(y) - back(p))).alias("mae_price"),
        F.count(F.lit(1)).alias("n"))


def evaluate(predictions: DataFrame, label: str = LABEL, plus_one: bool = True) -> dict:
    """The row of ``metrics`` as a dict; NaN where it is null."""
    row = metrics(predictions, label, plus_one).first()
    return {k: math.nan if row[k] is None else row[k] for k in ("r2", "rmse", "mae_price", "n")}


def evened(df: DataFrame, n_rows: int, each: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` (of ``n_rows`` rows) for an estimator that runs many short jobs:
    partitions are merged to about ``each`` rows, but one per core stays. Rows
    are not dealt anew, and large inputs keep their partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-n_rows // each)))


def dealt(df: DataFrame, n_rows: int, each: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` (of ``n_rows`` rows), dealt anew in turn if its partitions are too
    few for ``each`` rows: a fixed number of them grows with the input."""
    wanted = -(-n_rows // each)
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


def fit_evened(train: DataFrame, n_rows: int, stages: list, est, each: int = ROWS_PER_TASK) -> PipelineModel:
    """``fit``, but the estimator runs on even partitions of about ``each``
    rows; they hold label and vector only, and are persisted meanwhile."""
    checkpoint_root(train.sparkSession)  # tree checkpoints need the folder
    fitted = Pipeline(stages=list(stages)).fit(train)
    rows = fitted.transform(train).select(est.getLabelCol(), est.getFeaturesCol())
    rows = evened(dealt(rows, n_rows, each), n_rows, each).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([*fitted.stages, est.fit(rows)])
    finally:
        rows.unpersist()


def prepared(df: DataFrame, text: str | None = None, key: str = COLS.key, train_fraction: float = 0.8,
             label: str = LABEL, categorical: Sequence[str] = CATEGORICAL) -> tuple[DataFrame, DataFrame, int]:
    """(train, test, test rows skipped): key, label and assembled features,
    both persisted. The stages are fitted once, on the training rows."""
    used = set(numeric_features(df, label)) | set(categorical) | {label, key} | ({text} if text else set())
    data = (df.select(*[c for c in df.columns if c in used])
            .filter(F.col(label).isNotNull()).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        train, test = train_test(data, train_fraction, key, SEED)
        stages = feature_stages(data, categorical, text, leaks=screened_leaks(train, label), label=label)
        model = Pipeline(stages=stages).fit(train)
        n = data.count()
        held = [evened(dealt(model.transform(part).select(key, label, "features"), n), n)
                .persist(StorageLevel.MEMORY_AND_DISK) for part in (train, test)]
        held[0].count()
        skipped = test.count() - held[1].count()
    finally:
        data.unpersist()
    return held[0], held[1], skipped


GRID_SCHEMA = ("model string, iteration int, r2 double, rmse double, mae_price double, n_train long, n_test long, "
               "n_skipped long")


def compare_grid(frames: Mapping[int, tuple[DataFrame, str | None]], kinds: Sequence[str] = ("lr", "rf", "gbt"),
                 key: str = COLS.key, label: str = LABEL, categorical: Sequence[str] = CATEGORICAL,
                 times: dict | None = None) -> DataFrame:
    """A row per (model, iteration). ``frames`` gives each iteration its
    table and text column. The stages of an iteration are fitted once; its
    estimators then run side by side, each in a scheduler pool of its own, on
    the same persisted vectors. ``times`` is filled with seconds per fit."""
    spark, rows = next(iter(frames.values()))[0].sparkSession, []
    for iteration, (df, text) in frames.items():
        train, test, skipped = prepared(df, text, key, label=label, categorical=categorical)
        try:
            checkpoint_root(df.sparkSession)  # tree checkpoints need the folder
            n_train, n_test = train.count(), test.count() + skipped

            def one(kind: str):
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{kind}")
                begun = time.monotonic()
                m = evaluate(estimator(kind, iteration, label).fit(train).transform(test), label)
                if times is not None:
                    times[kind, iteration] = time.monotonic() - begun
                return (MODEL_NAMES[kind], iteration, m["r2"], m["rmse"], m["mae_price"], n_train, n_test, skipped)

            with ThreadPoolExecutor(len(kinds)) as pool:
                rows += list(pool.map(inheritable_thread_target(spark)(one), kinds))
        finally:
            train.unpersist()
            test.unpersist()
    return spark.createDataFrame(rows, GRID_SCHEMA)


def compare_models(df: DataFrame, kinds: Sequence[str] = ("lr", "rf", "gbt"),
                   iteration: int = 1, text: str | None = None, key: str = COLS.key,
                   label: str = LABEL) -> DataFrame:
    """``compare_grid`` for one iteration."""
    return compare_grid({iteration: (df, text)}, kinds, key, label)


def ordinal_codes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M1, ordinal form: column_name, label, code. Codes follow the order of
    the labels seen in training, from 0. Labels are few next to rows; the
    numbering holds a column's labels in one task."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    seen = train.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, label)").filter("label IS NOT NULL").distinct()
    order = Window.partitionBy("column_name").orderBy("label")
    return seen.select("column_name", "label", (F.row_number().over(order) - 1).cast("double").alias("code"))


def apply_ordinal(df: DataFrame, codes: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """``df`` with a code per column; -1 for a label that ``codes`` lacks, and for null."""
    for c in columns:
        own = codes.filter(F.col("column_name") == c).select(F.col("label").alias(c), F.col("code").alias(f"{c}{suffix}"))
        df = attach_lookup(df, own, c).withColumn(f"{c}{suffix}", F.coalesce(f"{c}{suffix}", F.lit(-1.0)))
    return df


def gram_sums(df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """One row: for every two of (1, features, label) the sum of their
    products, over the rows where none is null. One pass, partial on the map side."""
    names = [*features, label]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names]).dropna()
    terms = [("one", F.lit(1.0)), *((c, F.col(c)) for c in names)]
    return rows.agg(*[F.sum(a * b).alias(f"{x}*{y}") for i, (x, a) in enumerate(terms) for y, b in terms[i:]])


def elastic_net(sums: Mapping[str, float], features: Sequence[str], label: str = LABEL, reg: float = 0.01,
                mix: float = 0.3, turns: int = 10_000, tolerance: float = 1e-14) -> tuple[np.ndarray, float]:
    """M8, an independent fit: coefficients and intercept of the elastic net
    by coordinate descent on ``gram_sums``. The driver holds a matrix of
    features x features, whatever the number of rows. Columns and label are
    scaled by their deviation, as the estimator does; a constant gets 0."""
    names = ["one", *features, label]

    def product(a, b):
        return sums.get(f"{a}*{b}", sums.get(f"{b}*{a}"))
    total = product("one", "one")
    mean = np.array([product("one", c) / total for c in names[1:]])
    cov = np.array([[product(a, b) / total for b in names[1:]] for a in names[1:]]) - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov), 0))
    safe = np.where(scale > 0, scale, 1)
    corr = cov / np.outer(safe, safe)
    inner, target = corr[:-1, :-1], corr[:-1, -1]
    lasso, ridge = mix * reg / safe[-1], (1 - mix) * reg / safe[-1]
    beta = np.zeros(len(features))
    for _ in range(turns):
        before = beta.copy()
        for j in np.flatnonzero(scale[:-1] > 0):
            rest = target[j] - inner[j] @ beta + inner[j, j] * beta[j]
            beta[j] = np.sign(rest) * max(abs(rest) - lasso, 0) / (inner[j, j] + ridge)
        if np.abs(beta - before).max() < tolerance:
            break
    coefficients = np.where(scale[:-1] > 0, beta * scale[-1] / safe[:-1], 0.0)
    return coefficients, float(mean[-1] - coefficients @ mean[:-1])


def feature_names(predictions: DataFrame, features: str = "features") -> list[str]:
    """Assembled slot names from the vector column's metadata."""
    attrs = predictions.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    slots = [a for group in attrs.values() for a in group]
    size = predictions.schema[features].metadata.get("ml_attr", {}).get("num_attrs", len(slots))
    names = {a["idx"]: a.get("name", f"feature_{a['idx']}") for a in slots}
    return [names.get(i, f"feature_{i}") for i in range(size)]


def top_importances(spark: SparkSession, model: PipelineModel, predictions: DataFrame,
                    k: int = TOP_IMPORTANCES, features: str = "features") -> DataFrame:
    """The ``k`` most important features with their names. The
    importance vector has one entry per feature slot (model metadata, not
    data), so it is turned into rows directly."""
    imp = model.stages[-1].featureImportances.toArray()
    names = feature_names(predictions, features)
    rows = [(names[i] if i < len(names) else f"feature_{i}", float(v)) for i, v in enumerate(imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(k)


def save_model(model: PipelineModel, path: str) -> None:
    """Overwrite-save the whole fitted pipeline (stages + estimator),
    so the saved model scores raw feature rows."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_requests(model: PipelineModel, requests: DataFrame, mae: float,
                   nights: str | None = None, label_plus_one: bool = True) -> DataFrame:
    """Score a table of requests and turn the log prediction into a
    nightly price with a +-MAE interval (F16) and, given a nights column, a
    stay cost (F17)."""
    from lodgeframe.functions import scalars as S
    pred = model.transform(requests)
    cols = [c for c in requests.columns]
    out = pred.select(*cols, *S.price_interval("prediction", mae, plus_one=label_plus_one))
    if nights is not None:
        out = out.select("*", *[S.stay_cost(c, nights).alias(f"stay_{c}")
                                for c in ("estimate", "estimate_low", "estimate_high")])
    return out


def prediction_pairs(predictions: DataFrame, fraction: float, key: str = COLS.key,
                     label: str = LABEL) -> DataFrame:
    """A key-hash sample of (label, prediction) pairs with the common
    axis range (min and max over both), for error plots."""
    # Its own operation name makes the draw independent of the split's.
    h = key_hash(key, SEED, "prediction_pairs")
    smp = predictions.select(key, label, "prediction").filter(h < F.lit(int(fraction * SPACE)))
    axis = smp.agg(F.struct(F.least(F.min(label), F.min("prediction")).alias("lo"),
                            F.greatest(F.max(label), F.max("prediction")).alias("hi"))).scalar()
    with_axis = smp.select(key, label, "prediction", axis.alias("_axis"))
    return with_axis.select(key, label, "prediction", F.col("_axis.lo").alias("axis_min"),
                            F.col("_axis.hi").alias("axis_max"))
