"""One test per semantic decision of SURVEY section 1.4 not covered elsewhere."""
import tempfile

import pytest
from pyspark.sql import functions as F

from lodgeframe.columns import COLS
from lodgeframe.functions import aggregates as AG
from lodgeframe.operators import clean as Q
from lodgeframe.operators import explore as X
from lodgeframe.operators import rank as R
from lodgeframe.operators import sampling as T
from lodgeframe.sources import sinks as SK
from lodgeframe.sources import tables as ST
from tests.fixtures import raw_df, row


def test_d1_strict_cast_raises(spark):
    df = raw_df(spark, [row("1", price="abc")])
    with pytest.raises(Exception):
        Q.cast_columns(df, strict=True).collect()
    assert Q.cast_columns(df).first().price is None


def test_d4_blank_is_kept_unless_asked(spark):
    df = Q.cast_columns(raw_df(spark, [row("1", name="   ")]))
    assert Q.fill_missing(df).first().name == "   "
    assert Q.fill_missing(df, blank_as_missing=True).first().name == "Unknown"


def test_d8_three_medians(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 10]], "x int")
    r = df.agg(AG.median_approx("x").alias("a"), AG.median_disc("x").alias("d"),
               AG.median_interp("x").alias("i")).first()
    assert r.i == 2.5 and r.d == 2 and r.a == 2


def test_d10_round_is_half_up(spark):
    r = spark.range(1).select(F.round(F.lit(2.675), 2).alias("a"),
                              F.round(F.lit(0.125), 2).alias("b")).first()
    assert (r.a, r.b) == (2.68, 0.13)


def test_d13_ties_broken_by_keys(spark):
    rows = [(s, "z", 100, 10, 1, 0.5) for s in ["b", "a", "c"] for _ in range(30)]
    df = spark.createDataFrame(rows, f"{COLS.subzone} string, {COLS.zone} string, "
                                     f"{COLS.value} int, {COLS.availability} int, "
                                     f"{COLS.reviews} int, {COLS.occupancy} double")
    got = [r[COLS.subzone] for r in R.rank_subzones(df.repartition(3), n=3).collect()]
    assert got == ["a", "b", "c"]


def test_d15_partition_values_retyped_without_schema(spark):
    d = tempfile.mkdtemp(prefix="lf-d15-")
    df = spark.createDataFrame([(1, "2019"), (2, "2020")], "id long, zone string")
    SK.write_partitioned(df, d, "zone")
    assert dict(spark.read.parquet(d).dtypes)["zone"] == "int"
    assert dict(ST.read_table(spark, d, schema=df.schema).dtypes)["zone"] == "string"


def test_d18_nan_fails_range_filters(spark):
    df = spark.createDataFrame([(float("nan"),), (6.0,)], "x double")
    assert df.filter(F.col("x") > 5).count() == 2          # Spark: NaN > 5
    assert Q.filter_min(df, "x", 5).count() == 1            # ours drops NaN


def test_d19_one_bin_formula(spark):
    df = spark.createDataFrame([(40.70, -74.0, 100)], f"{COLS.lat} double, {COLS.lon} double, "
                                                      f"{COLS.value} int")
    r = X.price_grid(df, 0.01).first()
    assert r.cell_y == int(40.70 // 0.01) and r.n == 1


def test_t7_preview(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert T.preview(df, 5).count() == 5
    assert T.preview(df, 5, sample_fraction_of=0.5, key="k").count() == 5


def test_f10_word_boundary_option(spark):
    from lodgeframe.functions import scalars as S
    df = spark.createDataFrame([("Room near 5 brooklyn stops",), ("Huge 3br loft",)], "t string")
    plain = [r.n for r in df.select(S.extract_count("t").alias("n")).collect()]
    strict = [r.n for r in df.select(S.extract_count("t", word_boundary=True).alias("n")).collect()]
    assert plain == [5.0, 3.0] and strict == [0.0, 3.0]


def test_d14_random_methods_are_options(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    n = T.sample_fraction(df, 0.1, "k", 7, method="random").count()
    assert 100 < n < 300
    train, test = T.train_test(df, 0.8, "k", 7, method="random")
    assert train.count() + test.count() == 2000
