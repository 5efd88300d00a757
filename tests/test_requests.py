from pyspark.sql import functions as F

from labelweave.operators import metrics as M
from labelweave.operators import requests as RQ


def test_batch_defaults_first_record_wins(spark):
    df = spark.createDataFrame([(0, 0, None, None), (1, 0, "classify", 7), (2, 1, "pre_ingest", None),
                                (3, 1, "classify", 9)],
                               "input_index long, batch_id long, operation_step string, run_id long")
    out = {r["input_index"]: (r["operation_step"], r["run_id"]) for r in
           RQ.apply_batch_defaults(df, new_run=F.lit(100) + F.col("batch_id")).collect()}
    assert out == {0: ("classify_verify", 100), 1: ("classify_verify", 100), 2: ("pre_ingest", 101),
                   3: ("pre_ingest", 101)}


def test_output_path_rules(spark):
    df = spark.createDataFrame([("classify", "/x/y/name", 5), ("pre_ingest", "/abs/keep.tsv", 5),
                                ("pre_ingest", None, 6), ("classify", "", 7)],
                               "operation_step string, output_path string, run_id long")
    got = [r[0] for r in df.select(RQ.output_path("/home")).collect()]
    assert got == ["/home/logs/name_5_classified.tsv", "/abs/keep.tsv", "/home/logs/pre-ingest_6_classified.tsv",
                   "/home/logs/pre-ingest_7_classified.tsv"]


def test_dense_index_over_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(13)
    out = RQ.dense_index(df, ["k"], "ix").collect()
    pairs = sorted((r["k"], r["ix"]) for r in out)
    assert [ix for _, ix in pairs] == list(range(5000))


def test_assign_batches(spark):
    df = spark.range(0, 10).withColumnRenamed("id", "input_index")
    b = [r["batch_id"] for r in RQ.assign_batches(df, 4).orderBy("input_index").collect()]
    assert b == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_event_context(spark):
    ev = spark.createDataFrame([(1, "r1", None), (2, "r1", "c-off"), (3, "r2", None), (4, "r9", "x")],
                               "event_id long, run_id string, context_id string")
    ctx = spark.createDataFrame([("r1", None, True, "ctx-r1"), ("r1", "c-off", False, None),
                                 ("r2", None, False, "ctx-r2")],
                                "run_id string, context_id string, enabled boolean, default_context_id string")
    got = {r["event_id"]: r["context_id"] for r in M.resolve_event_context(ev, ctx).collect()}
    assert got == {1: "ctx-r1", 4: "x"}


def test_system_summary_skips_nulls(spark):
    s = spark.createDataFrame([("r", 1.0, 2.0, None, 0.5, 0.1, "linux"), ("r", 2.0, 4.0, None, 0.7, 0.3, "mac")],
                              "run_id string, ts double, normalized_load_1m double, normalized_load_5m double, "
                              "normalized_load_15m double, memory_available_ratio double, platform string")
    out = {r["metric"]: r for r in M.system_summary(s).collect()}
    assert out["normalized_load_1m"]["mean"] == 3.0 and out["normalized_load_1m"]["p50"] == 3.0
    assert out["normalized_load_5m"]["count"] == 0 and out["normalized_load_5m"]["mean"] is None
    assert out["memory_available_ratio"]["platform"] == "linux" and out["memory_available_ratio"]["sample_count"] == 2
