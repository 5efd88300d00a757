import random

import pytest
from pyspark.sql import functions as F

from labelweave.operators import metrics as M

EV_SCHEMA = ("ts double, stage string, duration_ms double, status string, run_id string, name string, "
             "record_count long, batch_mode boolean")


def _events(spark, rows):
    return spark.createDataFrame(rows, EV_SCHEMA)


def test_percentile_interpolation(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (10, 20, 30, 40)], "g string, v double")
    got = {r["p"]: r["value"] for r in M.order_stats(df, ["g"], "v", [0, 50, 95, 100]).collect()}
    assert got == {0.0: 10.0, 50.0: 25.0, 95.0: 38.5, 100.0: 40.0}


@pytest.mark.parametrize("method", ["sort", "agg"])
def test_stats_methods_agree_with_python(spark, method):
    random.seed(3)
    rows = [(random.choice("abc"), random.random() * 100) for _ in range(500)] + [("hot", 1.0)] * 300

    def pct(vals, p):
        d = sorted(vals)
        idx = (len(d) - 1) * p / 100
        lo = int(idx)
        hi = min(lo + 1, len(d) - 1)
        return d[lo] * (1 - (idx - lo)) + d[hi] * (idx - lo)
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r["g"]: r for r in M.numeric_stats(df, ["g"], "v", True, method).collect()}
    for g in "abc":
        vals = [v for k, v in rows if k == g]
        assert got[g]["count"] == len(vals)
        for p in (50, 95, 99):
            assert got[g][f"p{p}"] == pytest.approx(pct(vals, p), rel=1e-12)
    assert got["hot"]["p95"] == 1.0


def test_counts_latency_and_named(spark):
    ev = _events(spark, [
        (1.0, "ingest_enqueue", 5.0, "ok", "r", None, 2, None),
        (2.0, "classify", 15.0, "ok", "r", None, None, None),
        (2.5, "task_timing", 12.0, "ok", "r", "task_update_record", None, None),
        (2.6, "app_timing", 8.0, "ok", "r", "index_run", None, None),
        (2.7, "classifier_timing", 4.0, "ok", "r", "tokenizer_call", None, None),
        (2.8, "classifier_batch_shape", 12.0, "ok", "r", "total_chunks", None, None),
        (3.0, "index", 25.0, "ok", "r", None, None, None),
        (4.0, "forward", 10.0, "error", "r", None, None, None)])
    s = M.summarize_events(ev, F.lit(2)).first()
    assert (s["records_submitted"], s["records_indexed"], s["records_forwarded"], s["failures"]) == (2, 1, 1, 1)
    assert s["status"] == "incomplete"
    lat = {r["stage"]: r for r in M.stage_latency(ev).collect()}
    assert lat["classify"]["count"] == 1 and lat["classify"]["p95"] == 15.0
    assert set(lat) == {"ingest_enqueue", "classify", "index", "forward"}
    named = {(r["stage"], r["name"]): r["p95"] for r in M.named_timings(ev).collect()}
    assert named[("task_timing", "task_update_record")] == 12.0
    assert named[("classifier_batch_shape", "total_chunks")] == 12.0


def test_batched_latency_normalisation(spark):
    ev = _events(spark, [(1.0, "classify", 40.0, "ok", "r", None, 4, True),
                         (1.0, "index_db", 100.0, "ok", "r", None, 10, True)])
    lat = {r["stage"]: r["p95"] for r in M.stage_latency(ev).collect()}
    assert lat == {"classify": 10.0, "index_db": 10.0}
    b, sizes = M.batch_stats(ev)
    assert {r["stage"]: r["p95"] for r in b.collect()} == {"classify": 40.0, "index_db": 100.0}
    assert {r["stage"]: r["p95"] for r in sizes.collect()} == {"classify": 4.0, "index_db": 10.0}


def _summary(spark, rpm, adj, load, mem):
    return spark.createDataFrame([(rpm, adj, load, mem)],
                                 "overall_records_per_minute double, load_adjusted_records_per_minute double, "
                                 "mean_load_1m double, mean_memory_ratio double")


def _lat(spark, d):
    return spark.createDataFrame(list(d.items()), "stage string, p95 double")


def test_gate_pass_and_fail(spark):
    base = _summary(spark, 100.0, 105.0, 1.05, 0.4)
    base_lat = _lat(spark, {"classify": 100.0, "index": 50.0})
    ok = M.evaluate_gate(_summary(spark, 120.0, 126.0, 1.1, 0.35), base,
                         M.compare_stages(_lat(spark, {"classify": 105.0, "index": 52.0}), base_lat)).first()
    assert ok["pass"] is True
    assert ok["load_adjusted_throughput_delta_pct"] == pytest.approx(20.0)
    assert ok["candidate_mean_normalized_load_1m"] == pytest.approx(1.1)
    bad = M.evaluate_gate(_summary(spark, 103.0, 103.0, 0.9, 0.32), base,
                          M.compare_stages(_lat(spark, {"classify": 130.0, "index": 55.0}), base_lat)).first()
    assert bad["pass"] is False and len(bad["reasons"]) == 2


def test_load_adjustment(spark):
    thr = spark.createDataFrame([("a", 60.0), ("b", 60.0), ("c", None)],
                                "run_id string, overall_records_per_minute double")
    sysm = spark.createDataFrame([("a", "normalized_load_1m", 2.5), ("b", "normalized_load_1m", 0.5)],
                                 "run_id string, metric string, mean double")
    got = {r["run_id"]: (r["host_load_adjustment_factor"], r["load_adjusted_records_per_minute"])
           for r in M.load_adjust(thr, sysm).collect()}
    assert got == {"a": (2.5, 150.0), "b": (1.0, 60.0), "c": (1.0, None)}


def test_throughput_zero_wall(spark):
    ev = _events(spark, [(5.0, "index", 1.0, "ok", "r", None, None, None)])
    r = M.throughput(ev).first()
    assert r["wall_clock_s"] == 0.0 and r["overall_records_per_minute"] is None


def test_order_stats_hot_group_spans_partitions(spark):
    # one group holds 60 % of the rows; it must be ranked across partitions
    rows = [("hot", float(i % 997)) for i in range(6000)] + [(f"g{i % 7}", float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    got = {(r["g"], r["p"]): r["value"] for r in M.order_stats(df, ["g"], "v", [0, 50, 99, 100]).collect()}
    hot = sorted(v for g, v in rows if g == "hot")

    def pct(d, p):
        idx = (len(d) - 1) * p / 100
        lo = int(idx)
        hi = min(lo + 1, len(d) - 1)
        return d[lo] * (1 - (idx - lo)) + d[hi] * (idx - lo)
    for p in (0, 50, 99, 100):
        assert got[("hot", float(p))] == pytest.approx(pct(hot, p))
    s = (df.repartitionByRange(8, "g", "v").withColumn("pid", F.spark_partition_id())
         .filter("g = 'hot'").select("pid").distinct().count())
    assert s > 1


def test_a_value_that_most_rows_share_is_one_row(spark):
    import numpy as np
    rows = [("hot", 5.0)] * 8000 + [("hot", float(i)) for i in range(2000)] + [("small", 1.0), ("small", 4.0), (None, 7.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    kept = M._ranked_values(df, ["g"], "v")
    assert kept.filter("g = 'hot'").count() == 2000 and kept.agg({"_c": "sum"}).first()[0] == len(rows)
    got = {r["g"]: r for r in M.numeric_stats(df, ["g"], "v").collect()}
    for g in ("hot", "small", None):
        x = [v for k, v in rows if k == g and v is not None]
        assert got[g]["count"] == len(x) and abs(got[g]["mean"] - np.mean(x)) < 1e-9
        if g is not None:
            assert [got[g][p] for p in ("p50", "p95", "p99")] == [float(np.percentile(x, p)) for p in (50, 95, 99)]
    weighted = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("a", 9.0, 4)], "g string, v double, n long")
    (r,) = M.numeric_stats(weighted, ["g"], "v", weight="n").collect()
    x = [1.0] * 3 + [2.0] + [9.0] * 4
    assert (r["count"], r["p50"], r["p95"]) == (8, float(np.percentile(x, 50)), float(np.percentile(x, 95)))
