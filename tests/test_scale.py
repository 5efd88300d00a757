"""Positions and ranks at sizes where partitions are not merged into one."""
import os

import pytest
from pyspark.sql import functions as F

from labelweave.operators import latest as L
from labelweave.operators import metrics as M
from labelweave.operators import requests as RQ
from labelweave.sources import readers as RD


@pytest.fixture(params=["true", "false"])
def plain_plans(spark, request):
    """Shuffle partitions stay apart; exchanges are shared or not."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.exchange.reuse")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


N = 1_000_000


def test_dense_index_keeps_every_row(spark, plain_plans):
    df = spark.range(N).select((F.col("id") * 7919 % N).alias("k"), F.lit("text").alias("text"), F.col("id").alias("other"))
    r = RQ.dense_index(df, ["k"]).agg(F.count("*"), F.countDistinct("row_index"), F.min("row_index"), F.max("row_index"),
                                      F.max(F.abs(F.col("row_index") - F.col("k")))).first()
    assert tuple(r) == (N, N, 0, N - 1, 0)


def test_surrogate_ids_are_unique(spark, plain_plans):
    df = spark.range(N).select(F.col("id").alias("input_index"), F.array(F.lit("x")).alias("override"))
    r = L.with_surrogate_ids(df, 41, ["input_index"]).agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
    assert tuple(r) == (N, N, 42, N + 41)


def test_order_stats_are_exact(spark, plain_plans):
    df = spark.range(N).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
                               (F.col("id") * 7919 % N).cast("double").alias("v"))
    got = {(r["g"], r["p"]): r["value"] for r in M.order_stats(df, ["g"], "v", [0.0, 50.0, 95.0, 100.0]).collect()}
    want = df.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.0), F.lit(0.5), F.lit(0.95), F.lit(1.0))).alias("q")).collect()
    for r in want:
        for p, q in zip((0.0, 50.0, 95.0, 100.0), r["q"]):
            assert got[(r["g"], p)] == pytest.approx(q)
    assert len(got) == 4 * len(want)


def test_reading_order_of_many_rows(spark, tmp_path):
    df = spark.range(300_000).select(F.format_string("2024Test.%010d", "id").alias("id"), F.lit("t, quoted").alias("t"), F.lit("a").alias("a"))
    df.repartition(7).write.option("escape", '"').csv(str(tmp_path / "in"))
    r = RD.read_new_records(spark, str(tmp_path / "in"), batch_size=1000, multi_line=False)
    got = r.agg(F.count("*"), F.countDistinct("bibcode"), F.countDistinct("input_index"), F.max("input_index"),
                F.countDistinct("batch_id")).first()
    assert tuple(got) == (300_000, 300_000, 300_000, 299_999, 300)


def test_missing_stage_counts_as_unknown(spark):
    ev = spark.createDataFrame([("r", None, 4.0, "ok", None), ("r", "", 6.0, "error", None), ("r", "classify", 8.0, "ok", 2)],
                               "run_id string, stage string, duration_ms double, status string, record_count long")
    lat = {r["stage"]: r["count"] for r in M.stage_latency(ev).collect()}
    assert lat == {"unknown": 2, "classify": 1}
    assert [(r["stage"], r["errors"]) for r in M.errors_by_stage(ev).collect()] == [("unknown", 1)]


def _split_files(spark, folder, files=3, rows=4000):
    for n in range(files):
        with open(os.path.join(folder, f"f{n}.csv"), "w") as f:
            f.write("bibcode,title,abstract\n" + "".join(f"2024Test.{n * rows + i:010d},t{i},a\n" for i in range(rows)))


def test_reading_order_needs_no_sort(spark, tmp_path, monkeypatch):
    _split_files(spark, str(tmp_path))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")  # a file is many splits
    monkeypatch.setattr(RD, "dense_index", lambda *a: pytest.fail("rows were sorted"))
    try:
        got = {r["bibcode"]: r["input_index"] for r in RD.read_new_records(spark, str(tmp_path), multi_line=False).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert got == {f"2024Test.{i:010d}": i for i in range(12_000)}


def test_reading_order_after_rows_were_dropped(spark, tmp_path):
    _split_files(spark, str(tmp_path))
    rows = RD.with_file_position(RD._csv(spark, str(tmp_path), multi_line=False)).filter("not _first and c0 like '%7'")
    got = sorted((r["input_index"], r["c0"]) for r in RD.reading_order_index(rows).collect())
    assert got == [(i, f"2024Test.{i * 10 + 7:010d}") for i in range(1200)]


def test_csv_files_do_not_grow_with_the_input(spark, tmp_path):
    from labelweave.plans.catalog import _csv_out
    keep = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    most = []
    try:
        for n in (20_000, 80_000):
            out = str(tmp_path / str(n))
            df = spark.range(0, n, 1, n // 5000).select(F.format_string("2024Test.%010d", "id").alias("bibcode"), F.md5(F.col("id").cast("string")).alias("title"),
                                       F.lit("two\nlines").alias("abstract"))
            _csv_out(df, out)
            most.append(max(os.path.getsize(os.path.join(out, f)) for f in os.listdir(out) if f.startswith("part-")))
            r = RD.read_new_records(spark, out).agg(F.count("*"), F.countDistinct("bibcode"), F.countDistinct("input_index"),
                                                    F.max("input_index"), F.min("abstract"), F.max("abstract")).first()
            assert tuple(r) == (n, n, n, n - 1, "two\nlines", "two\nlines")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keep)
    assert most[1] < 1.5 * most[0]


def test_request_files_follow_the_splits(spark, sf_small, tmp_path):
    from labelweave.plans.catalog import _write_request_files
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert _write_request_files(spark, sf_small, str(tmp_path / "few")) == 4
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        n = _write_request_files(spark, sf_small, str(tmp_path / "many"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    sizes = {k: [os.path.getsize(tmp_path / k / f) for f in os.listdir(tmp_path / k) if f.startswith("part-")] for k in ("few", "many")}
    assert n > 8 and len(sizes["many"]) > 8 and max(sizes["many"]) < max(sizes["few"])
    assert spark.read.json(str(tmp_path / "many")).count() == spark.read.json(str(tmp_path / "few")).count()


def test_appended_rows_are_classified_once(spark, sf_small, monkeypatch):
    import uuid

    from labelweave import config as C
    from labelweave.plans import catalog as K
    once = F.udf(lambda: uuid.uuid4().hex).asNondeterministic()
    monkeypatch.setattr(K, "_classified_rows", lambda spark, d: spark.range(50).select(
        *[once().alias(h) if h == "bibcode" else F.lit("x").alias(h) for h in C.OUTPUT_HEADER]))
    got = [r["bibcode"] for r in K.QUERIES["a10_append_classified_tsv"](spark, sf_small).collect()]
    assert len(got) == 100 and all(got.count(b) == 2 for b in set(got))


def test_classify_ids_looks_the_catalogue_up_once(spark, tmp_path):
    from labelweave.operators import scoring as SC
    n = spark.sparkContext.accumulator(0)

    def read(x):
        n.add(1)
        return x
    ids = spark.range(40).select("id", F.format_string("2024Test.%010d", "id").alias("identifier"))
    ids.filter("id < 30").select(F.col("identifier").alias("bibcode")).write.option("header", True).csv(str(tmp_path / "ids"))
    titles = ids.withColumn("title", F.udf(read)(F.format_string("title %d", "id")))
    cat = titles.select(F.col("id").alias("input_index"), "identifier", "title", F.lit("stars").alias("abstract"))
    out = SC.classify_ids(spark, str(tmp_path / "ids"), cat, str(tmp_path / "out"), SC.HashedLinearScorer(SC.default_weights(spark)))
    rows = out.collect()
    assert sorted(r["identifier"] for r in rows) == [f"2024Test.{i:010d}" for i in range(30)]
    low = [float(r["minimum_collection_score"]) for r in rows if r["minimum_collection_score"]]
    assert low == sorted(low)
    assert 30 <= n.value <= 40
