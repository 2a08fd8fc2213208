"""CSV edge, Parquet round trips, partition typing, catalog registration."""
import hashlib
import os
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodgeframe.columns import COLS
from lodgeframe.operators import clean as Q
from lodgeframe.sources import landing as LD
from lodgeframe.sources import ranged_csv as RC
from lodgeframe.sources import raw as SR
from lodgeframe.sources import sinks as SK
from lodgeframe.sources import tables as ST
from tests.fixtures import raw_df


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_quotes_commas_newlines(spark):
    d = tempfile.mkdtemp(prefix="lf-csv-")
    header = ",".join(COLS.raw_order)
    body = ('1,"Loft, ""river"" view\nsecond line",10,Ana,Harbour,Docks,40.7,-74.0,'
            'Private room,100,2,3,2019-01-01,0.1,1,20\n'
            '2,,10,Ana,Harbour,Docks,40.7,-74.0,Private room,100,2,3,,,1,20\n'
            '3,   ,10,null,Harbour,Docks,40.7,-74.0,Private room,100,2,3,"",,1,20\n')
    _write(os.path.join(d, "a.csv"), header + "\n" + body)
    rows = {r.id: r for r in SR.read_raw_csv(spark, d).collect()}
    assert rows["1"].name == 'Loft, "river" view\nsecond line'
    assert rows["2"].name is None and rows["2"].last_review is None
    assert rows["3"].name == "   " and rows["3"].host_name == "null"
    assert rows["3"].last_review is None


def test_csv_roundtrip_keeps_blank_strings(spark):
    d = tempfile.mkdtemp(prefix="lf-csv-")
    df = raw_df(spark).withColumn("name", F.lit("   "))
    SR.write_raw_csv(df, d)
    assert SR.read_raw_csv(spark, d).filter(F.col("name") == "   ").count() == df.count()


def test_land_raw_missing_source(spark):
    with pytest.raises(FileNotFoundError):
        SR.land_raw(spark, "/nonexistent/path/raw.csv", tempfile.mkdtemp())


def test_resolve_source_order(spark):
    d = tempfile.mkdtemp(prefix="lf-src-")
    spark.range(3).write.mode("overwrite").parquet(f"{d}/good")
    df, label = SR.resolve_source(spark, [("parquet", f"{d}/missing"), ("parquet", f"{d}/good")])
    assert label.endswith("/good") and df.count() == 3
    with pytest.raises(FileNotFoundError):
        SR.resolve_source(spark, [("parquet", f"{d}/missing")])


def test_partition_values_keep_their_type_with_schema(spark):
    d = tempfile.mkdtemp(prefix="lf-part-")
    df = spark.createDataFrame([(1, "2019"), (2, "Harbour")], "id long, zone string")
    SK.write_partitioned(df, d, "zone")
    inferred = dict(spark.read.parquet(d).dtypes)
    assert inferred["zone"] == "int" or inferred["zone"] == "string"
    pinned = ST.read_table(spark, d, schema=df.schema)
    assert sorted(r.zone for r in pinned.collect()) == ["2019", "Harbour"]


def test_static_and_dynamic_overwrite(spark):
    d = tempfile.mkdtemp(prefix="lf-ow-")
    df = spark.createDataFrame([(i, z) for i, z in enumerate("abcde")], "id long, zone string")
    SK.write_partitioned(df, d, "zone")
    SK.write_partitioned(df.filter("zone = 'a'"), d, "zone", dynamic=True)
    assert spark.read.parquet(d).count() == 5
    SK.write_partitioned(df.filter("zone = 'a'"), d, "zone")
    assert spark.read.parquet(d).count() == 1


def test_register_table_recovers_partitions(spark):
    d = tempfile.mkdtemp(prefix="lf-cat-")
    df = spark.createDataFrame([(i, z) for i, z in enumerate("abcab")], "id long, zone string")
    SK.write_partitioned(df, d, "zone")
    t = SK.register_table(spark, "lf_test_table", d)
    assert t.count() == 5


def test_verify_and_project(spark):
    df = Q.clean(raw_df(spark))
    v = {r.group_value: r.n_rows for r in ST.verify_table(df, COLS.zone).collect()}
    assert v[None] == 3 and v["Harbour"] == 3
    p = ST.project_known(df, ["price", "not_there", "id"])
    assert p.columns == ["price", "id"]


def test_quality_report_json(spark):
    from lodgeframe.operators import profile as P
    raw = raw_df(spark)
    silver = Q.clean(raw)
    rep = SK.quality_report(spark, P.retention(raw, silver), P.null_profile(raw),
                            P.null_profile(silver))
    d = tempfile.mkdtemp(prefix="lf-rep-")
    assert SK.write_quality_report(rep, f"{d}/r")
    back = spark.read.json(f"{d}/r").first()
    assert back.rows_in == 7 and back.rows_out == 3 and len(back.columns_before) == 16
    assert back.rules.price_min == 1 and back.rules.minimum_nights_max == 365
    assert back.rules.fills.name == "Unknown" and back.rules.partition_column == COLS.zone
    assert back.rules.write_mode == "overwrite" and back.generated_by


def test_land_raw_keeps_each_file_whole(spark):
    src = tempfile.mkdtemp(prefix="lf-land-src-")
    header = ",".join(COLS.raw_order)
    line = ('{i},"multi\nline, ""quoted""",10,Ana,Harbour,Docks,40.7,-74.0,'
            'Private room,100,2,3,2019-01-01,0.1,1,20\n')
    for f in range(3):
        _write(os.path.join(src, f"part{f}.csv"),
               header + "\n" + "".join(line.format(i=f * 100 + i) for i in range(50)))
    landing = SR.land_raw(spark, src, tempfile.mkdtemp(prefix="lf-land-dst-"))
    assert (landing.rows, landing.columns) == (150, 16)
    back = SR.read_raw_csv(spark, landing.path, recursive=True)
    assert back.filter(F.col("name") == 'multi\nline, "quoted"').count() == 150


def test_schema_rows(spark):
    df = Q.cast_columns(raw_df(spark))
    rows = ST.schema_rows(spark, df).orderBy("position").collect()
    assert len(rows) == 16 and rows[0].column == "id" and rows[0].type == "bigint"


def _files(folder):
    out = {}
    for root, _, names in os.walk(folder):
        for n in names:
            if "_manifest" not in root and not n.startswith((".", "_")):
                with open(os.path.join(root, n), "rb") as f:
                    out[os.path.relpath(os.path.join(root, n), folder)] = f.read()
    return out


def test_landing_keeps_bytes_and_paths(spark):
    src, dst = tempfile.mkdtemp(prefix="lf-bytes-src-"), tempfile.mkdtemp(prefix="lf-bytes-dst-")
    header = (",".join(COLS.raw_order) + "\n").encode()
    want = {"2019/part.csv": header + b"1,no line break at the end", "2020/part.csv": header + b'2,"a\r\nb",x\r\n',
            "a b.csv": header + b"3,\xff\xfe not UTF-8,x\n", "empty.csv": b""}
    for name, data in want.items():
        os.makedirs(os.path.dirname(os.path.join(src, name)), exist_ok=True)
        with open(os.path.join(src, name), "wb") as f:
            f.write(data)
    landing = SR.land_raw(spark, src, dst)
    assert _files(dst) == want
    assert (landing.files, landing.bytes, landing.rows) == (4, sum(map(len, want.values())), 3)
    listed = {r.relative_path: (r.bytes, r.sha256) for r in LD.manifest(spark, dst).collect()}
    assert listed == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in want.items()}
    assert LD.differences(spark, dst).collect() == []
    os.remove(os.path.join(dst, "a b.csv"))
    with open(os.path.join(dst, "2019/part.csv"), "ab") as f:
        f.write(b"x")
    assert {r.relative_path for r in LD.differences(spark, dst).collect()} == {"a b.csv", "2019/part.csv"}
    # A second landing replaces the first one.
    one = SR.land_raw(spark, os.path.join(src, "2020", "part.csv"), dst)
    assert one.files == 1 and _files(dst) == {"part.csv": want["2020/part.csv"]}


def test_landing_reads_no_content_into_rows_and_copies_by_the_buffer(spark, tmp_path):
    (tmp_path / "a").write_bytes(bytes(range(256)) * 50)
    plan = LD.source_files(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]
    assert LD.copy_file(f"file:{tmp_path}/a", f"{tmp_path}/deep/b", 7) == (
        12800, hashlib.sha256((tmp_path / "a").read_bytes()).hexdigest())
    assert (tmp_path / "deep" / "b").read_bytes() == (tmp_path / "a").read_bytes()


def test_a_landing_without_its_list_is_refused(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        LD.manifest(spark, str(tmp_path))
    with pytest.raises(ValueError):
        (tmp_path / "x").write_bytes(b"1")
        LD.copy_all(spark, str(tmp_path), str(tmp_path))


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[1], "1")
    yield lambda size: spark.conf.set(names[0], str(size))
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [37, 100, 1 << 20])
def test_ranges_of_a_file_give_what_the_whole_file_gives(spark, small_ranges, size):
    rng = random.Random(size)
    bits = ["a", "é", '""', ",", "\n", "\n\n", "\r\n", "x y", " ", "日本", '""""']

    def field():
        k = rng.random()
        if k < 0.5:
            return '"' + "".join(rng.choice(bits) for _ in range(rng.randrange(12))) + '"' if k > 0.25 else ""
        return rng.choice(["abc", "1.5", "   ", "null", '""', "x" * rng.randrange(60)])

    d = tempfile.mkdtemp(prefix="lf-ranges-")
    for f in range(2):
        lines = [",".join(COLS.raw_order)] + [",".join([str(i)] + [field() for _ in range(15)]) + "\n" * (i % 20 == 0)
                                              for i in range(90)]
        with open(f"{d}/f{f}.csv", "w", newline="", encoding="utf-8") as fh:
            fh.write("\n".join(lines) + "\n" * f)
    want = Counter(tuple(r) for r in SR.read_raw_csv(spark, d, whole_files=True).collect())
    small_ranges(size)
    assert Counter(tuple(r) for r in SR.read_raw_csv(spark, d).collect()) == want and sum(want.values()) == 180
    if size < 1000:
        assert RC.file_lines(spark, d).select("file", "range").distinct().count() > 100


def test_a_quoted_line_break_at_every_cut(spark, small_ranges):
    d = tempfile.mkdtemp(prefix="lf-cuts-")
    schema = SR.string_schema(["a", "b"])
    # Every record is longer than a range and breaks its line at every other byte.
    want = [(str(i), "\n".join("xy" for _ in range(30 + i))) for i in range(20)]
    _write(f"{d}/f.csv", "a,b\n" + "".join(f'{a},"{b}"\n' for a, b in want))
    small_ranges(20)
    rows = RC.read_ranged_csv(spark, d, schema)
    assert sorted(map(tuple, rows.collect())) == sorted(want)
    assert RC.file_lines(spark, d).select("range").distinct().count() > 90


def test_csv_without_rows_or_header(spark):
    d = tempfile.mkdtemp(prefix="lf-none-")
    schema = SR.string_schema(["a", "b"])
    _write(f"{d}/empty.csv", "")
    assert RC.read_ranged_csv(spark, d, schema).collect() == []
    _write(f"{d}/head.csv", "\n\na,b\n")
    assert RC.read_ranged_csv(spark, d, schema).collect() == []
    assert [tuple(r) for r in RC.read_ranged_csv(spark, d, schema, header=False).collect()] == [("a", "b")]
    _write(f"{d}/short.csv", "a,b\n1\n2,3,4\n")
    assert sorted((r.a, r.b) for r in RC.read_ranged_csv(spark, d, schema).collect()) == [("1", None), ("2", "3")]


def test_zones_survive_from_raw_to_kpis(spark):
    from lodgeframe.plans import medallion
    from tests.fixtures import row
    d = tempfile.mkdtemp(prefix="lf-zones-")
    zones = ["2019", "", None, "Harbour", "2019-01-01", "true"]
    rows = [row(str(i), zone=z) for i, z in enumerate(zones)]
    run = medallion.raw_to_silver(spark, raw_df(spark, rows), f"{d}/silver")
    gold, kpis = medallion.silver_to_features(spark, run.silver_path, f"{d}/gold", f"{d}/kpi")
    assert {r[COLS.zone] for r in gold.collect()} == set(zones)
    assert {r[COLS.zone]: r.nb_listings for r in kpis.collect()} == dict.fromkeys(zones, 1)
    t = SK.register_table(spark, "lf_zones", run.silver_path, schema=Q.silver_schema(), by=[COLS.zone])
    assert t.filter(f"{COLS.zone} = '2019'").count() == 1 and dict(t.dtypes)[COLS.zone] == "string"


def test_raw_to_silver_reads_the_source_once_and_leaves_nothing_staged(spark):
    from lodgeframe.plans import medallion
    from lodgeframe.session import checkpoint_root
    from lodgeframe.sources import files as FS
    d = tempfile.mkdtemp(prefix="lf-reads-")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    raw = raw_df(spark).coalesce(1)
    before = set(FS.children(spark, checkpoint_root(spark)))
    medallion.raw_to_silver(spark, raw.mapInArrow(counted, raw.schema), f"{d}/silver", f"{d}/report")
    assert reads.value == 1 and set(FS.children(spark, checkpoint_root(spark))) == before


def test_a_hot_zone_is_written_by_several_tasks_and_small_zones_share_files(spark):
    d = tempfile.mkdtemp(prefix="lf-rebalance-")
    zone = F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("z"), (F.col("id") % 7).cast("string")))
    df = spark.range(0, 200000, 1, 40).select("id", zone.alias("zone"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)
    spark.conf.set(names[0], "2m")
    try:
        SK.write_partitioned(df, d, "zone")
    finally:
        spark.conf.unset(names[0])
    files = {z: [f for f in os.listdir(f"{d}/{z}") if f.endswith(".parquet")] for z in os.listdir(d) if z.startswith("zone=")}
    # 40 tasks would write 320 files; a small zone may share a partition with the hot one, and its cuts.
    assert len(files["zone=hot"]) > 2 and len(files) == 8 and sum(map(len, files.values())) <= 30
    assert spark.read.parquet(d).count() == 200000
