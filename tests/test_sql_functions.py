import os
import tempfile


from labelweave.functions import ids as I
from labelweave.functions import scores as S
from labelweave.functions import text as T
from labelweave.operators import requests as RQ
from labelweave.plans.sql_functions import register_sql_functions
from labelweave.streaming import jobs as PL


def test_sql_functions_match_dataframe_functions(spark):
    register_sql_functions(spark)
    rows = [("scix:AB12-CD34-EF56", " a  b\n", ["Physics", "general"], [0.5, 0.1, 0.2, 0.3, 0.0, 0.5, 0.1, 0.0],
             "Hello, World! x-y"),
            ("short", "", ["nope"], [0.0, 0.0, 0.0, 0.9, 0.0, 0.1, 0.0, 0.0], ""),
            ("2019J....123..456AB", None, [], [0.1, 0.1, 0.1, 0.1, 0.1, 0.2, 0.1, 0.1], None)]
    df = spark.createDataFrame(rows, "x string, t string, cats array<string>, s array<double>, txt string")
    a = df.select(I.identifier_kind("x"), I.normalize_ws("t"), RQ.is_allowed("cats"), S.gross_collection("s"),
                  T.token_ids("txt")).collect()
    df.createOrReplaceTempView("lw_fn_rows")
    b = spark.sql("select lw_identifier_kind(x), lw_normalize_ws(t), lw_is_allowed_category(cats), "
                  "lw_gross_collection(s), lw_token_ids(txt) from lw_fn_rows").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    w = spark.sql("select chunk, window from lw_windows(array(1L, 2L, 3L, 4L, 5L, 6L), 4, 2)").collect()
    assert [(r[0], r[1]) for r in w] == [(0, [1, 2, 3, 4]), (1, [3, 4, 5, 6]), (2, [5, 6])]


def test_replay_dedupe_on_a_stream(spark):
    base = tempfile.mkdtemp(prefix="lw-h4-")
    rows = [(1, "2019J....123..456AB", None, "t", "a"), (1, None, None, "t", "a"), (1, None, None, " t", "a ")]
    schema = "run_id long, bibcode string, scix_id string, title string, abstract string"
    for i in range(3):  # the same rows arrive three times, in three files
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in"))
    q = (PL.drop_replays(src).writeStream.format("parquet").option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    assert out.count() == 2 and out.select("fingerprint").distinct().count() == 2
