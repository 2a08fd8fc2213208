"""A key, a zone and a host each holding a third of the rows: results stay
whole and exact, and no operator needs the hot group in one task."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodgeframe.columns import COLS
from lodgeframe.operators import clean as Q
from lodgeframe.operators import kpis as K
from lodgeframe.operators.enrich import gold_features, with_window_averages
from tests.fixtures import raw_df, row


def _skewed(spark, n=3000):
    rows = []
    for i in range(n):
        if i % 3 == 0:       # one id holds a third of the rows, with different payloads
            rows.append(row("999", price=str(100 + i % 50), zone="Hot", host_id="1"))
        else:
            rows.append(row(str(i), price=str(50 + i % 200),
                            zone="Hot" if i % 3 == 1 else f"Z{i % 4}", host_id=str(i % 7)))
    return raw_df(spark, rows)


def test_hot_key_dedup_is_exact(spark):
    df = Q.cast_columns(_skewed(spark)).repartition(8)
    out = Q.dedup(df, [COLS.key], order=[COLS.value])
    hot = out.filter(F.col(COLS.key) == 999).collect()
    assert len(hot) == 1 and hot[0][COLS.value] == 100
    assert out.count() == df.select(COLS.key).distinct().count()


def test_hot_zone_aggregates_are_whole(spark):
    silver = Q.clean(_skewed(spark))
    kpis = {r[COLS.zone]: r.nb_listings for r in
            K.zone_kind_kpis(silver, median_kind="disc").collect()}
    assert sum(kpis.values()) == silver.count()
    g = gold_features(silver)
    assert g.count() == silver.count()
    assert g.filter(F.col("zone_avg_price").isNull()).count() == 0


def test_session_has_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


@pytest.fixture
def unmeasured(spark):
    """As for large tables: no lookup is known to be small, no partition is merged."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("form", ["join", "window"])
def test_a_hot_zone_is_not_one_task_when_averages_are_attached(spark, unmeasured, form):
    silver = Q.clean(_skewed(spark))
    g = gold_features(silver, form=form)
    sizes = [r["count"] for r in g.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == silver.count()
    # The zone holds half of the rows.
    assert max(sizes) < 0.4 * sum(sizes)


def test_window_averages_are_those_of_a_plain_window(spark, unmeasured):
    rows = [("a", "x", 1.0), ("a", "x", 1.0), ("a", None, 4.0), (None, "x", 2.5), (None, None, None),
            ("b", "y", None), ("b", "y", float("nan")), ("c", "y", None)] * 3
    df = spark.createDataFrame(rows, "zone string, kind string, price double")
    wanted = {"by_zone": ["zone"], "by_both": ["zone", "kind"]}
    plain = df.select("*", *[F.round(F.avg("price").over(Window.partitionBy(*by)), 2).alias(c) for c, by in wanted.items()])
    found = with_window_averages(df, "price", wanted)
    assert found.columns == plain.columns and found.schema == plain.schema
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
