"""The layered tables over the driver binding: raw (Bronze strings),
silver (cleaned), gold (features) and the dashboard frame."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgeframe.columns import COLS, ListingColumns
from lodgeframe.operators.clean import cast_columns, clean, fill_missing
from lodgeframe.operators.enrich import dashboard_frame, gold_features
from lodgeframe.plans.bindings import listings_raw


def raw(spark: SparkSession, sf_dir: str, cols: ListingColumns = COLS) -> DataFrame:
    return listings_raw(spark, sf_dir, cols)


def typed(spark: SparkSession, sf_dir: str, cols: ListingColumns = COLS) -> DataFrame:
    """Raw, cast (Q4) and filled (Q5): the input of the rule filters."""
    return fill_missing(cast_columns(raw(spark, sf_dir, cols), cols=cols), cols=cols)


def silver(spark: SparkSession, sf_dir: str, cols: ListingColumns = COLS) -> DataFrame:
    return clean(raw(spark, sf_dir, cols), cols)


def gold(spark: SparkSession, sf_dir: str, cols: ListingColumns = COLS,
         form: str = "join") -> DataFrame:
    return gold_features(silver(spark, sf_dir, cols), cols, form=form)


def dash(spark: SparkSession, sf_dir: str, cols: ListingColumns = COLS) -> DataFrame:
    return dashboard_frame(gold(spark, sf_dir, cols), cols)
