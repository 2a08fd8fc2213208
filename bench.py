"""Benchmark: the layered listing jobs and the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. The raw -> silver and silver -> features jobs
write their tables once (to a fresh folder); the analytics then read the
written tables, as they would in production. Each query is forced to run
completely with a ``noop`` write (no rows pulled to the driver).

Before timing, the two jobs run once, untimed, on the smallest driver scale
factor (sf0.001, when present). This warms the JVM and Spark's
generated-code cache, so the figures are steady-state times and not the
one-off start-up of the first query. Set $BENCH_EVENT_LOG_DIR to write
Spark's event log (stage and task times) to that folder.
"""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from lodgeframe.columns import COLS, MAP_SAMPLE_ROWS  # noqa: E402
from lodgeframe.operators import estimate as E  # noqa: E402
from lodgeframe.operators import explore as X  # noqa: E402
from lodgeframe.operators import filters as FL  # noqa: E402
from lodgeframe.operators import kpis as K  # noqa: E402
from lodgeframe.operators import profile as P  # noqa: E402
from lodgeframe.operators import rank as R  # noqa: E402
from lodgeframe.operators import sampling as T  # noqa: E402
from lodgeframe.operators.enrich import dashboard_frame  # noqa: E402
from lodgeframe.plans import medallion, ml  # noqa: E402
from lodgeframe.plans.bindings import listings_raw  # noqa: E402
from lodgeframe.plans.registry import GOLD_NUMERIC, KIND_ALIASES, KINDS  # noqa: E402
from lodgeframe.session import local_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # Stage and task times for later reading, without the web UI.
        extra = {"spark.eventLog.enabled": "true",
                 "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="lodgeframe-bench",
                          extra_conf=extra)
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="lodgeframe-bench-")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    out = f"{root}/bench-{int(time.time())}"
    run(spark.range(1000).select(F.sum("id")))
    warm_dir = str(Path(sf_dir).parent / "sf0.001")
    if Path(warm_dir).is_dir() and Path(warm_dir) != Path(sf_dir):
        medallion.raw_to_silver(spark, listings_raw(spark, warm_dir), f"{out}-warm/silver")
        medallion.silver_to_features(spark, f"{out}-warm/silver", f"{out}-warm/gold",
                                     f"{out}-warm/kpis")

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    state = {}

    def b2s():
        state["s"] = medallion.raw_to_silver(spark, listings_raw(spark, sf_dir),
                                                f"{out}/silver", f"{out}/report")

    def s2g():
        state["g"] = medallion.silver_to_features(spark, f"{out}/silver", f"{out}/gold",
                                              f"{out}/kpis")

    timed("raw_to_silver", b2s)
    timed("silver_to_features", s2g)
    silver = spark.read.parquet(f"{out}/silver")
    gold = spark.read.parquet(f"{out}/gold")
    dash = dashboard_frame(gold)
    pred = FL.listing_predicate(zones=["AMERICA", "EUROPE"], kinds=KINDS[:2], price_max=300,
                                avail_min=30, occ_min_pct=20)
    queries = {
        "a1_zone_kind_kpis": lambda: run(K.zone_kind_kpis(silver)),
        "q1_null_profile_silver": lambda: run(P.null_profile(silver)),
        "a2_global_kpis": lambda: run(K.global_kpis(dash)),
        "a7_compromise_score": lambda: run(R.compromise_score(dash)),
        "a6_cheapest_subzones": lambda: run(R.rank_subzones(dash, 10)),
        "a8_pivot_median": lambda: run(X.pivot_median(dash, COLS.zone, COLS.kind, COLS.value,
                                                      KINDS, KIND_ALIASES)),
        "a11_histogram": lambda: run(X.histogram(dash, COLS.value)),
        "a15_price_grid": lambda: run(X.price_grid(dash)),
        "a16_box_stats": lambda: run(X.box_stats(gold, GOLD_NUMERIC)),
        "a17_correlation_matrix": lambda: run(X.correlation_matrix(gold, GOLD_NUMERIC)),
        "j3_estimate_range": lambda: run(E.estimate_range(
            dash.select(COLS.key, COLS.zone, COLS.kind), dash, COLS.zone, COLS.kind, COLS.value)),
        "j1_impute_from_group": lambda: run(E.impute_from_group(
            dash.select(COLS.key, COLS.subzone, COLS.kind), dash, [COLS.subzone, COLS.kind],
            E.imputed_features(COLS))),
        "p1_p3_filter_share": lambda: (run(dash.filter(pred)), run(FL.match_share(dash, pred))),
        "t2_sample_n": lambda: run(T.sample_n(dash, MAP_SAMPLE_ROWS, COLS.key, 42)),
        "m8_linear_baseline": lambda: ml.compare_models(gold, ["lr"], 1).collect(),
    }
    for name, fn in queries.items():
        timed(name, fn)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name.replace("sf", ""),
                      "rows_silver": silver.count()}))


if __name__ == "__main__":
    main()
