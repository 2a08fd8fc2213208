"""Casting, filling, filtering and de-duplication on the defect table."""
import math

from pyspark.sql import functions as F

from lodgeframe.columns import COLS
from lodgeframe.operators import clean as Q
from lodgeframe.operators import profile as P
from tests.fixtures import DEFECTS, raw_df, row


def test_cast_numeric_types(spark):
    typed = Q.cast_columns(raw_df(spark))
    types = dict(typed.dtypes)
    assert types["id"] == "bigint" and types["host_id"] == "bigint"
    for c in ["price", "minimum_nights", "number_of_reviews",
              "calculated_host_listings_count", "availability_365"]:
        assert types[c] == "int"
    for c in ["latitude", "longitude", "reviews_per_month"]:
        assert types[c] == "double"


def test_cast_keeps_strings_and_values(spark):
    typed = Q.cast_columns(raw_df(spark))
    types = dict(typed.dtypes)
    for c in ["name", "host_name", "neighbourhood_group", "neighbourhood", "room_type",
              "last_review"]:
        assert types[c] == "string"
    first = typed.filter(F.col("id") == 1).first()
    assert first.price == 120 and first.latitude == 40.71 and first.reviews_per_month == 0.5


def test_malformed_values_become_null_not_errors(spark):
    rows = [row("11", price="abc"), row("12", price="1.5"), row("13", price=None),
            row("3000000000"), row("14", lat="north")]
    typed = Q.cast_columns(raw_df(spark, rows))
    got = {r.id: r for r in typed.collect()}
    assert got[11].price is None and got[12].price is None and got[13].price is None
    assert got[3000000000].id == 3000000000          # key above 2^31 survives
    assert got[14].latitude is None
    losses = {r.column_name: r.lost for r in Q.cast_losses(raw_df(spark, rows)).collect()}
    assert losses["price"] == 2 and losses["latitude"] == 1


def test_fill_missing(spark):
    filled = Q.fill_missing(Q.cast_columns(raw_df(spark)))
    r2 = filled.filter(F.col("id") == 2).first()
    assert r2.reviews_per_month == 0.0 and r2.last_review == "No review"
    r6 = filled.filter(F.col("id") == 6).first()
    assert r6.name == "Unknown" and r6.host_name == "Unknown"
    assert filled.count() == len(DEFECTS)            # fills never drop rows


def test_fill_value_type_is_checked(spark):
    typed = Q.cast_columns(raw_df(spark))
    try:
        Q.fill_missing(typed, {"name": 0.0})
    except TypeError:
        pass
    else:
        raise AssertionError("a numeric fill of a string column must be refused")


def test_filters_and_survivors(spark):
    silver = Q.clean(raw_df(spark))
    assert sorted(r.id for r in silver.collect()) == [1, 2, 6]
    typed = Q.fill_missing(Q.cast_columns(raw_df(spark)))
    assert Q.filter_min(typed, "price", 1).filter(F.col("price") < 1).count() == 0
    nights = Q.filter_between(typed, "minimum_nights", 1, 365)
    assert nights.filter(F.col("id") == 5).count() == 0


def test_extra_defects(spark):
    rows = [row("20", lat=None), row("21", nights="0"), row("22", nights="1"),
            row("23", nights="365"), row("24", lat="NaN"), row("25", price="1")]
    got = sorted(r.id for r in Q.clean(raw_df(spark, rows)).collect())
    assert got == [22, 23, 25]


def test_dedup_survivor_is_deterministic(spark):
    rows = [row("30", price="90"), row("30", price="80"), row("30", price="85")]
    df = Q.cast_columns(raw_df(spark, rows))
    a = Q.dedup(df, ["id"], order=["price"]).first()
    b = Q.dedup(df.repartition(3), ["id"], order=["price"]).first()
    assert a.price == 80 and a == b


def test_audit_in_rule_order(spark):
    typed = Q.fill_missing(Q.cast_columns(raw_df(spark)))
    audit = {r.rule: r.removed for r in P.clean_audit(typed).collect()}
    assert audit == {"price": 2, "nights": 1, "coordinates": 0, "duplicates": 1,
                     "remaining": 3}
    assert sum(v for k, v in audit.items() if k != "remaining") == len(DEFECTS) - 3


def test_null_profile_before_and_after(spark):
    raw = raw_df(spark)
    prof = {r.column_name: r for r in P.null_profile(raw).collect()}
    assert prof["id"].total == 7
    assert prof["name"].missing == 1 and prof["reviews_per_month"].missing == 1
    assert math.isclose(prof["name"].missing_pct, round(100 / 7, 2))
    after = P.null_profile(Q.clean(raw)).collect()
    filled = {"name", "host_name", "reviews_per_month", "last_review"}
    assert all(r.missing == 0 for r in after if r.column_name in filled)


def test_blank_is_missing_but_tab_is_not(spark):
    rows = [row("40", name="   "), row("41", name="\t"), row("42")]
    prof = {r.column_name: r.missing for r in P.null_profile(raw_df(spark, rows)).collect()}
    assert prof["name"] == 1


def test_nan_is_not_missing_unless_asked(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert P.null_profile(df).first().missing == 1
    assert P.null_profile(df, treat_nan_as_missing=True).first().missing == 2


def test_empty_input(spark):
    empty = raw_df(spark, [])
    assert P.null_profile(empty).count() == 0
    audit = {r.rule: r.removed for r in P.clean_audit(Q.cast_columns(empty)).collect()}
    assert all(v == 0 for v in audit.values())
    ret = P.retention(empty, Q.clean(empty)).first()
    assert ret.rows_in == 0 and ret.retention_pct is None


def test_clean_is_idempotent(spark):
    once = Q.clean(raw_df(spark))
    strings = once.select([F.col(c).cast("string").alias(c) for c in COLS.raw_order])
    twice = Q.clean(strings)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_fill_numeric_excludes_label(spark):
    df = spark.createDataFrame([(None, None, 1)], "label double, x double, k int")
    r = Q.fill_numeric(df, 0.0, exclude=["label"]).first()
    assert r.label is None and r.x == 0.0


def test_audit_with_deduplicated_table(spark):
    raw = raw_df(spark)
    typed = Q.fill_missing(Q.cast_columns(raw))
    a = sorted(P.clean_audit(typed).collect())
    b = sorted(P.clean_audit(typed, deduplicated=Q.clean(raw)).collect())
    assert a == b


def test_raw_to_silver_job(spark):
    import tempfile
    from lodgeframe.plans import medallion
    d = tempfile.mkdtemp(prefix="lf-job-")
    run = medallion.raw_to_silver(spark, raw_df(spark), f"{d}/silver", f"{d}/report")
    assert sorted(r.id for r in spark.read.parquet(f"{d}/silver").collect()) == [1, 2, 6]
    assert {r.rule: r.removed for r in run.audit.collect()}["duplicates"] == 1
    rep = spark.read.json(f"{d}/report").first()
    assert rep.rows_in == 7 and rep.rows_out == 3 and rep.retention_pct == round(300 / 7, 2)


def test_observed_metrics_equal_standalone_passes(spark):
    import tempfile
    from lodgeframe.plans import listings as L
    from lodgeframe.plans import medallion
    sf = "/root/testdata/sf0.001"
    d = tempfile.mkdtemp(prefix="lf-obs-")
    run = medallion.raw_to_silver(spark, L.raw(spark, sf), f"{d}/silver")
    silver = spark.read.parquet(f"{d}/silver")
    assert sorted(run.profile_before.collect()) == sorted(P.null_profile(L.raw(spark, sf)).collect())
    assert sorted(run.profile_after.collect()) == sorted(P.null_profile(L.silver(spark, sf)).collect())
    assert sorted(run.audit.collect()) == sorted(P.clean_audit(L.typed(spark, sf)).collect())
    rep = run.report.first()
    assert (rep.rows_in, rep.rows_out) == (1503, 1493) and silver.count() == 1493
