import datetime as dt

from pyspark.sql import functions as F

from labelweave.operators import latest as L
from labelweave.operators import state as ST

T0 = dt.datetime(2024, 1, 1)


def ts(m):
    return T0 + dt.timedelta(minutes=m)


OV = "id long, bibcode string, scix_id string, override array<string>, created timestamp"
SC = "id long, bibcode string, scix_id string, scores string, created timestamp, overrides_id long, run_id long"
FC = ("id long, bibcode string, scix_id string, score_id long, collection array<string>, validated boolean, "
      "validated_at timestamp, created timestamp")
REC = "input_index long, bibcode string, scix_id string, collections array<string>, run_id long, payload string"


def _state(spark, ov=(), sc=(), fc=()):
    return ST.State(spark.createDataFrame(list(ov), OV), spark.createDataFrame(list(sc), SC),
                    spark.createDataFrame(list(fc), FC))


def test_override_wins_scix_first(spark):
    st = _state(spark, ov=[(1, "B1", None, ["general"], ts(5)), (2, None, "S1", ["physics"], ts(1)),
                           (3, "B1", None, ["planetary"], ts(9))])
    recs = spark.createDataFrame([(0, "B1", "S1", ["astrophysics"], 1, "p"), (1, "B1", None, ["x"], 1, "p"),
                                  (2, "B9", None, ["x"], 1, "p")], REC)
    batch = {r[0]: (r[1], r[2]) for r in ST.resolve_override(recs, st.overrides, "batch")
             .select("input_index", "overrides_id", "final_collections").collect()}
    assert batch == {0: (2, ["physics"]), 1: (3, ["planetary"]), 2: (None, ["x"])}
    newest = {r[0]: r[1] for r in ST.resolve_override(recs, st.overrides, "newest")
              .select("input_index", "overrides_id").collect()}
    assert newest[0] == 3


def test_index_batch_reuses_scores_and_upserts_final(spark):
    st = _state(spark,
                sc=[(10, "B1", None, "p", ts(1), None, 1)],
                fc=[(100, "B1", None, 10, ["old"], True, ts(2), ts(1))])
    recs = spark.createDataFrame([(0, "B1", None, ["astrophysics"], 1, "p"),
                                  (1, "B2", None, ["general"], 1, "q")], REC)
    ch, res = ST.index_batch(st, recs, F.lit(ts(60)))
    st2 = st.apply(ch)
    r = {x["input_index"]: x for x in res.collect()}
    assert r[0]["score_id"] == 10 and not r[0]["new_score"] and r[0]["final_updated"]
    assert r[1]["score_id"] == 11 and r[1]["new_score"] and not r[1]["final_updated"] and r[1]["final_id"] == 101
    fin = {x["id"]: x for x in st2.final.collect()}
    assert fin[100]["collection"] == ["astrophysics"] and fin[100]["validated"] is True  # Q25
    assert fin[101]["collection"] == ["general"] and fin[101]["validated"] is False
    assert st2.scores.count() == 2
    c = ST.index_counters(res).first()
    assert (c["record_count"], c["new_score_rows"], c["reused_score_rows"], c["new_final_rows"],
            c["updated_final_rows"]) == (2, 1, 1, 1, 1)


def test_duplicate_ids_in_batch_last_wins(spark):
    st = _state(spark)
    recs = spark.createDataFrame([(0, "B1", None, ["a"], 1, "p"), (5, "B1", None, ["b"], 1, "p")], REC)
    ch, res = ST.index_batch(st, recs, F.lit(ts(1)))
    st2 = st.apply(ch)
    assert res.count() == 1 and st2.final.first()["collection"] == ["b"]


def test_validation_outcomes(spark):
    st = _state(spark,
                ov=[(1, "B2", None, ["general"], ts(1))],
                sc=[(10, "B1", None, "p", ts(1), None, 1), (11, "B1", None, "p", ts(2), None, 2)],
                fc=[(100, "B1", None, 11, ["x"], False, None, ts(3)),
                    (101, "B2", None, 12, ["y"], False, None, ts(3)),
                    (102, "B3", None, 13, ["z"], False, None, ts(3)),
                    (103, "B4", None, 14, ["w"], True, ts(1), ts(3))])
    reqs = spark.createDataFrame([(0, "B1", None, ["Physics"]), (1, "B2", None, ["general"]),
                                  (2, "B3", None, [""]), (3, "B4", None, [""]), (4, "B1", None, ["Nope"])],
                                 "input_index long, bibcode string, scix_id string, override array<string>")
    ch, res = ST.validate(st, reqs.filter("input_index < 4"), F.lit(ts(100)))
    st2 = st.apply(ch)
    out = {r["input_index"]: r["outcome"] for r in res.collect()}
    assert out == {0: "record_validated", 1: "record_previously_validated", 2: "record_validated",
                   3: "record_previously_validated"}
    fin = {r["id"]: r for r in st2.final.collect()}
    assert fin[100]["collection"] == ["Physics"] and fin[100]["validated"] and fin[100]["validated_at"] == ts(100)
    assert fin[102]["validated"] and fin[102]["collection"] == ["z"]
    assert fin[103]["validated_at"] == ts(1)
    sc = {r["id"]: r["overrides_id"] for r in st2.scores.collect()}
    assert sc[10] == sc[11] == 2
    _, res2 = ST.validate(st, reqs.filter("input_index = 4"), F.lit(ts(100)))
    assert res2.first()["outcome"] == "other_failure"


def test_run_results_and_recent(spark):
    st = _state(spark,
                sc=[(10, "B1", None, "p", ts(1), None, 1), (11, None, "S2", "p", ts(1), None, 1),
                    (12, "B1", None, "p", ts(1), None, 2)],
                fc=[(100, "B1", None, 10, ["a"], True, ts(50), ts(1)),
                    (101, "B1", None, 10, ["b"], True, ts(60), ts(2)),
                    (102, "", "", 11, ["c"], False, None, ts(1))])
    rr = {(r["bibcode"], r["scix_id"]): r["id"] for r in ST.run_results(st.final, st.scores, 1).collect()}
    assert rr == {("B1", None): 101, (None, "S2"): 102}
    rec = ST.recently_validated(st.final, 1, F.lit(ts(60 + 60 * 24 - 5))).collect()
    assert [r["id"] for r in rec] == [101]


def test_latest_per_key_tie_break(spark):
    df = spark.createDataFrame([("k", 1, ts(1)), ("k", 2, ts(1)), ("j", 3, ts(0))], "key string, id long, created timestamp")
    got = {r["key"]: r["id"] for r in L.latest_per_key(df, "key", ["created", "id"]).collect()}
    assert got == {"k": 2, "j": 3}


def test_set_validation(spark):
    df = spark.createDataFrame([(1, ts(1)), (2, None)], "id long, validated_at timestamp")
    out = {r["id"]: (r["validated"], r["validated_at"]) for r in
           ST.set_validation(df, F.col("id") == 2, F.lit(ts(9))).collect()}
    assert out == {1: (False, None), 2: (True, ts(9))}


def test_rows_without_ids_all_stay(spark):
    st = _state(spark)
    reqs = spark.createDataFrame([(0, None, None, ["x"]), (1, "", None, ["general"]), (2, "B1", None, ["x"]),
                                  (3, "B1", None, ["general"])],
                                 "input_index long, bibcode string, scix_id string, override array<string>")
    _, res = ST.validate(st, reqs, F.lit(ts(1)))
    assert sorted(r["input_index"] for r in res.collect()) == [0, 1, 3]


def test_single_record_rule_takes_the_newest_of_either_id(spark):
    st = _state(spark,
                sc=[(10, None, "S1", "p", ts(1), None, 1), (11, "B1", None, "p", ts(5), None, 1)],
                fc=[(1, None, "S1", 10, ["old"], False, None, ts(1)), (2, "B1", None, 11, ["new"], False, None, ts(9))])
    recs = spark.createDataFrame([(0, "B1", "S1", ["a"], 1, "p")], REC)
    _, res = ST.index_batch(st, recs, F.lit(ts(60)), override_mode="newest")
    r = res.first()
    assert (r["score_id"], r["final_id"], r["new_score"]) == (11, 2, False)
    _, res = ST.index_batch(st, recs, F.lit(ts(60)))
    assert res.first()["final_id"] == 1


def test_changes_hold_only_touched_rows(spark):
    st = _state(spark, sc=[(10, "B1", None, "p", ts(1), None, 1), (11, "B9", None, "p", ts(1), None, 1)],
                fc=[(1, "B1", None, 10, ["x"], False, None, ts(1)), (2, "B9", None, 11, ["y"], False, None, ts(1))])
    ch, _ = ST.validate(st, spark.createDataFrame([(0, "B1", None, ["general"])],
                                                  "input_index long, bibcode string, scix_id string, override array<string>"),
                        F.lit(ts(5)))
    assert [r["id"] for r in ch.final.collect()] == [1] and [r["id"] for r in ch.scores.collect()] == [10]
    assert ch.overrides.count() == 1


def test_compaction_survives_a_replay(spark, tmp_path):
    from labelweave import schemas
    from labelweave.sources.writers import SnapshotStore
    store = SnapshotStore(spark, str(tmp_path))
    rows = lambda ids, v: spark.createDataFrame(
        [(i, f"B{i}", None, i, [v], False, None, ts(1)) for i in ids], FC)
    store.write_changes("final_collection", rows([1, 2], "a"), 0)
    store.write_changes("final_collection", rows([2, 3], "b"), 1)
    store.write_changes("final_collection", rows([4], "c"), 2)
    now = lambda before=None: {r["id"]: r["collection"][0] for r in store.current(
        "final_collection", schemas.FINAL_COLLECTION, before).collect()}
    store.compact("final_collection")
    assert now() == {1: "a", 2: "b", 3: "b", 4: "c"}
    assert now(2) == {1: "a", 2: "b", 3: "b"}
    store.write_changes("final_collection", rows([4], "d"), 2)
    assert now() == {1: "a", 2: "b", 3: "b", 4: "d"}
    store.compact("final_collection")
    assert now() == {1: "a", 2: "b", 3: "b", 4: "d"}


def test_every_identified_row_is_asked_for(spark, sf_small):
    from labelweave.plans import catalog
    rows = catalog._requests_split(spark, sf_small)
    asked = catalog.fixture_resend_requests(spark, sf_small, every=True).filter("run_id is null")
    for c in ("bibcode", "scix_id"):
        want = {(r[0], r[1]) for r in rows.filter(f"{c} is not null").select("input_index", c).collect()}
        assert {(r[0], r[1]) for r in asked.filter(f"{c} is not null").select("request_id", c).collect()} == want
