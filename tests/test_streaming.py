import os
import random
import tempfile

from pyspark.sql import functions as F

from labelweave.session import stamp_in_name_order
from labelweave.streaming import claims as CL
from labelweave.streaming import jobs as PL


def _brute(events):
    state = {}
    out = {}
    for eid, fp, ts, op in sorted(events, key=lambda e: (e[1], e[2], e[0])):
        kind, target = op.split(":")
        st, lease = state.get(fp, (None, None))
        g, st, lease = CL.transition(st, lease, kind, target, ts)
        state[fp] = (st, lease)
        out[eid] = g
    return out


def _events(n=400, keys=7, seed=1):
    random.seed(seed)
    ops = ["claim:classify_inflight", "mark:classify_done", "claim:index_inflight", "mark:indexed_done"]
    return [(i, random.randrange(keys), float(random.randrange(0, 3000)), random.choice(ops[:3] if i % 9 else ops))
            for i in range(n)]


def test_transition_table():
    t = CL.transition
    assert t(None, None, "claim", "classify_inflight", 0)[0]
    assert t(None, None, "claim", "index_inflight", 0)[0]
    assert not t("classify_inflight", 300.0, "claim", "classify_inflight", 10)[0]
    assert t("classify_inflight", 300.0, "claim", "classify_inflight", 300)[0]
    assert not t("classify_inflight", 0.0, "claim", "index_inflight", 999)[0]
    assert not t("classify_done", None, "claim", "classify_inflight", 1)[0]
    assert t("classify_done", None, "claim", "index_inflight", 1)[0]
    assert not t("index_inflight", 200.0, "claim", "index_inflight", 100)[0]
    assert t("index_inflight", 200.0, "claim", "index_inflight", 200)[0]
    assert not t("index_inflight", 0.0, "claim", "classify_inflight", 999)[0]
    assert not t("indexed_done", None, "claim", "index_inflight", 1)[0]


def test_batch_and_stream_match_brute_force(spark):
    ev = _events()
    expect = _brute(ev)
    df = spark.createDataFrame(ev, "event_id long, fp long, ts double, op string")
    got = {r["event_id"]: r["granted"] for r in CL.claims_batch(df).collect()}
    assert got == expect
    base = tempfile.mkdtemp(prefix="lw-stream-")
    df.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(os.path.join(base, "in"))
    stamp_in_name_order(spark, os.path.join(base, "in"))
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in"))
    q = (CL.claims_stream(s).writeStream.format("parquet").option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got_s = {r["event_id"]: r["granted"] for r in spark.read.parquet(os.path.join(base, "out")).collect()}
    assert got_s == expect


def test_replay_dedupe_batch(spark):
    df = spark.createDataFrame([(1, "2019J....123..456AB", None, "t", "a"), (1, "2019J....123..456AB", None, "t", "a"),
                                (1, None, None, " t ", "a"), (1, None, None, "t", "a")],
                               "run_id long, bibcode string, scix_id string, title string, abstract string")
    assert PL.drop_replays(df).count() == 2
    done = PL.drop_replays(df).limit(1)
    assert PL.drop_replays(df, done=done).count() == 1


def test_stream_classify_equals_batch(spark, sf_small):
    from labelweave.plans.catalog import QUERIES
    a = {r[0]: tuple(r[1:]) for r in QUERIES["c13_classify"](spark, sf_small).collect()}
    b = {r[0]: tuple(r[1:]) for r in QUERIES["h01_stream_classify"](spark, sf_small).collect()}
    assert a == b


def test_claims_replay_matches_brute_force(spark):
    ev = _events(n=300, keys=3, seed=5)
    expect = _brute(ev)
    df = spark.createDataFrame(ev, "event_id long, fp long, ts double, op string")
    got = {r["event_id"]: r["granted"] for r in CL.claims_replay(df, tempfile.mkdtemp(prefix="lw-cr-"), 60).collect()}
    assert got == expect


def test_classify_index_stream_is_replay_safe(spark, sf_small):
    from labelweave.operators import scoring as SC
    from labelweave.plans.catalog import _write_request_files
    from labelweave.sources.writers import SnapshotStore
    from labelweave import schemas
    from labelweave.functions import ids as I
    base = tempfile.mkdtemp(prefix="lw-h1-")
    _write_request_files(spark, sf_small, os.path.join(base, "in"))
    store = SnapshotStore(spark, os.path.join(base, "store"))
    scorer = SC.HashedLinearScorer(SC.default_weights(spark))
    sink = PL.index_sink(store, os.path.join(base, "tsv"), os.path.join(base, "fwd"), now=F.lit(0).cast("timestamp"))
    q = PL.start_classify_stream(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                                 os.path.join(base, "ckpt"), scorer, on_batch=sink)
    q.awaitTermination()
    n_in = spark.read.json(os.path.join(base, "in")).count()
    out = spark.read.parquet(os.path.join(base, "out")).withColumn("kind", I.record_key_kind()).withColumn("value", I.record_key_value())
    named = out.filter("coalesce(bibcode, '') <> '' or coalesce(scix_id, '') <> ''")
    records = named.select("kind", "value").distinct().count()
    # a record asked for twice in one micro-batch has one row of scores, the last request's
    scored = named.select("batch", "kind", "value").distinct().count()
    cur = store.current("final_collection", schemas.FINAL_COLLECTION)
    assert cur.count() == records and cur.select("id").distinct().count() == records
    assert store.current("scores", schemas.SCORES).count() == scored
    tsv = spark.read.option("sep", "\t").option("header", True).option("multiLine", True).option(
        "escape", '"').csv(os.path.join(base, "tsv"))
    assert tsv.count() == n_in
    src = spark.read.json(os.path.join(base, "in"))
    assert tsv.filter("abstract is not null").count() == src.filter("abstract <> ''").count()
    # replay the last batch: same state
    before = sorted(map(tuple, cur.select("id", "score_id").collect()))
    last = max(int(p.split("=")[1]) for p in os.listdir(os.path.join(base, "out")) if p.startswith("batch="))
    sink(spark.read.parquet(os.path.join(base, "out", f"batch={last}")), last)
    after = sorted(map(tuple, store.current("final_collection", schemas.FINAL_COLLECTION).select("id", "score_id").collect()))
    assert before == after and store.current("scores", schemas.SCORES).count() == scored


def test_event_stream_approx_mode(spark, sf_small):
    from labelweave.plans.catalog import _events_jsonl
    from labelweave.sources.readers import PERF_EVENT
    base = tempfile.mkdtemp(prefix="lw-h5-")
    _events_jsonl(spark, sf_small, os.path.join(base, "in"))
    q = PL.start_event_stream(spark, os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "ck"),
                              PERF_EVENT, exact=False)
    q.awaitTermination()
    got = {(r["run_id"], r["stage"]): r["count"] for r in spark.read.parquet(os.path.join(base, "out")).collect()}
    ev = spark.read.schema(PERF_EVENT).option("mode", "DROPMALFORMED").json(os.path.join(base, "in"))
    exp = {(r["run_id"], r["stage"]): r["count"] for r in ev.groupBy("run_id", "stage").count().collect()}
    assert got == exp


def test_claims_on_a_busy_key(spark):
    rng = random.Random(8)
    ops = ["claim:classify_inflight", "mark:classify_done", "claim:index_inflight", "claim:index_inflight"]
    ev = [(i, 1, float(i * 40), rng.choice(ops)) for i in range(45_000)]
    expect = _brute(ev)
    rng.shuffle(ev)
    df = spark.createDataFrame(ev, "event_id long, fp long, ts double, op string")
    assert {r["event_id"]: r["granted"] for r in CL.claims_batch(df).collect()} == expect
    got = {r["event_id"]: r["granted"] for r in CL.claims_replay(df, tempfile.mkdtemp(prefix="lw-busy-")).collect()}
    assert got == expect


def test_stream_routes_validation(spark, tmp_path):
    from labelweave import schemas
    from labelweave.operators import scoring as SC
    from labelweave.sources.writers import SnapshotStore
    rows = [(0, "2024Test.0000000001", "classify", None), (1, None, "pre_ingest", None),
            (2, "2024Test.0000000002", "classify", None)]
    later = [(3, "2024Test.0000000001", "validate", ["general"]), (4, None, "validate", ["general"])]
    schema = "input_index long, bibcode string, operation_step string, override array<string>"
    store = SnapshotStore(spark, str(tmp_path / "store"))
    sink = PL.index_sink(store, str(tmp_path / "tsv"), str(tmp_path / "fwd"), now=F.lit(0).cast("timestamp"))
    write = PL.classify_batch_writer(SC.HashedLinearScorer(SC.default_weights(spark)), str(tmp_path / "out"), on_batch=sink)
    for n, part in enumerate((rows, later, later)):
        df = spark.createDataFrame(part, schema).selectExpr("*", "cast(null as string) as scix_id", "cast(1 as long) as run_id",
                                                            "'a title' as title", "'an abstract' as abstract")
        write(df, min(n, 1))  # the second batch is replayed
    final = {r["bibcode"]: r for r in store.current("final_collection", schemas.FINAL_COLLECTION).collect()}
    assert set(final) == {"2024Test.0000000001", "2024Test.0000000002"}
    assert final["2024Test.0000000001"]["collection"] == ["general"] and final["2024Test.0000000001"]["validated"]
    assert store.read("overrides").count() == 2
    scores = {r["bibcode"]: r["overrides_id"] for r in store.current("scores", schemas.SCORES).collect()}
    assert scores["2024Test.0000000001"] is not None and scores["2024Test.0000000002"] is None


def test_stream_indexes_a_row_with_an_empty_bibcode_and_a_scix_id(spark, tmp_path):
    from labelweave import schemas
    from labelweave.operators import scoring as SC
    from labelweave.sources.writers import SnapshotStore
    rows = [(0, "", "scix:AAAA-BBBB-CCCC", "classify"), (1, "", "scix:AAAA-BBBB-DDDD", "pre_ingest"),
            (2, "2024Test.0000000001", "", "classify"), (3, "", "", "classify"), (4, "", None, "pre_ingest")]
    store = SnapshotStore(spark, str(tmp_path / "store"))
    sink = PL.index_sink(store, str(tmp_path / "tsv"), str(tmp_path / "fwd"), now=F.lit(0).cast("timestamp"))
    df = spark.createDataFrame(rows, "input_index long, bibcode string, scix_id string, operation_step string").selectExpr(
        "*", "cast(null as array<string>) as override", "cast(1 as long) as run_id", "'a title' as title", "'an abstract' as abstract")
    PL.classify_batch_writer(SC.HashedLinearScorer(SC.default_weights(spark)), str(tmp_path / "out"), on_batch=sink)(df, 0)
    ids = {("", "scix:AAAA-BBBB-CCCC"), ("", "scix:AAAA-BBBB-DDDD"), ("2024Test.0000000001", "")}
    for name, schema in (("scores", schemas.SCORES), ("final_collection", schemas.FINAL_COLLECTION)):
        assert {(r["bibcode"] or "", r["scix_id"] or "") for r in store.current(name, schema).collect()} == ids
    sent = spark.read.text(str(tmp_path / "fwd")).collect()
    assert len(sent) == 2 and sum("scix:AAAA-BBBB-CCCC" in r[0] for r in sent) == 1


def test_stream_claims_pre_ingest_rows_once(spark, tmp_path):
    from labelweave.operators import scoring as SC
    from labelweave.sources.writers import SnapshotStore
    store = SnapshotStore(spark, str(tmp_path / "store"))
    seen = []
    scorer = SC.HashedLinearScorer(SC.default_weights(spark))

    def write(rows, batch_id, at, on_batch):
        df = spark.createDataFrame(rows, "input_index long, title string, abstract string, operation_step string").selectExpr(
            "*", "cast(null as string) as bibcode", "cast(null as string) as scix_id", "cast(1 as long) as run_id",
            "'out' as output_path")
        PL.classify_batch_writer(scorer, str(tmp_path / "out"), on_batch=on_batch, claims=store, now=F.lit(at))(df, batch_id)

    def note(df, batch_id):
        seen.append((batch_id, sorted(r["input_index"] for r in df.collect())))

    def fail(df, batch_id):
        raise RuntimeError("lost")
    write([(0, "a", "x", "pre_ingest"), (1, " a ", "x", "pre_ingest"), (2, "b", "x", "pre_ingest"), (3, "a", "x", "classify")],
          0, 100, note)
    write([(4, "a", "x", "pre_ingest"), (5, "c", "x", "pre_ingest")], 1, 200, note)  # 4 is done already
    try:
        write([(6, "d", "x", "pre_ingest")], 2, 300, fail)
    except RuntimeError:
        pass
    write([(7, "d", "x", "pre_ingest")], 3, 400, note)  # batch 2 got to the index step: no second classification,
    write([(8, "d", "x", "pre_ingest")], 4, 900, note)  # also after its lease
    write([(6, "d", "x", "pre_ingest")], 2, 300, note)  # batch 2 again: decides as before
    assert len(seen[0][1]) == 3 and {2, 3} < set(seen[0][1])
    assert seen[1:] == [(1, [5]), (3, []), (4, []), (2, [6])]


def test_grant_expression_is_the_table(spark):
    stages = [None, "classify_inflight", "classify_done", "index_inflight", "indexed_done"]
    rows = [(s, lease) for s in stages for lease in (None, 50.0, 100.0, 150.0)]
    df = spark.createDataFrame(rows, "stage string, lease double")
    for target in CL.LEASES:
        got = df.select("stage", "lease", CL.granted(target, F.col("stage"), F.col("lease"), F.lit(100.0)).alias("g")).collect()
        assert all(r["g"] == CL.transition(r["stage"], r["lease"], "claim", target, 100.0)[0] for r in got)


def test_unknown_ops_are_refused_and_change_nothing(spark):
    ops = ["claim:classify_inflight", None, "", "claim", "claim:indexed_done", "mark:nothing", "drop:classify_done",
           "mark:classify_done", "claim:index_inflight"]
    ev = spark.createDataFrame([(1, i, float(i), op) for i, op in enumerate(ops)], "fp long, event_id long, ts double, op string")
    got = [(r["granted"], r["stage"]) for r in CL.claims_batch(ev).orderBy("event_id").collect()]
    assert got == [(True, "classify_inflight")] + [(False, "classify_inflight")] * 6 + [(True, "classify_done"), (True, "index_inflight")]


def test_claims_are_scoped_by_output_path(spark, tmp_path):
    from pyspark.sql import functions as F

    from labelweave import schemas
    from labelweave.operators import scoring as SC
    from labelweave.sources.writers import SnapshotStore
    rows = [(i, 0, None, None, "same title", "same text", "pre_ingest", None, path, None)
            for i, path in enumerate(["a", "a", "b", None, None, "", "c"])] + [(9, 0, "x", None, "t", "t", "classify", None, "a", None)]
    df = spark.createDataFrame(rows, PL.REQUEST)
    store, ts = SnapshotStore(spark, str(tmp_path / "store")), F.lit(1000.0)
    on, claimed = PL.claim_pre_ingest(df, store, 0, ts)
    kept = sorted((r["output_path"] or "", r["input_index"]) for r in on.collect())
    # one replay a path goes on; rows without a path and of other steps always do
    assert [p for p, _ in kept] == ["", "", "", "a", "a", "b", "c"] and claimed.count() == 3
    assert PL.claim_pre_ingest(df, store, 0, ts)[1].count() == 3  # the batch is replayed: same decisions
    again, none = PL.claim_pre_ingest(df, store, 1, ts + 10)  # leases run
    assert none.count() == 0 and sorted(r["output_path"] or "" for r in again.collect()) == ["", "", "", "a"]
    assert PL.claim_pre_ingest(df, store, 2, ts + 400)[1].count() == 3  # leases ran out
    seen = []
    PL.classify_batch_writer(SC.HashedLinearScorer(SC.default_weights(spark)), str(tmp_path / "out"), on_batch=lambda d, i: seen.extend(
        store.current("claims", schemas.CLAIMS).select("stage").distinct().collect()), claims=store, now=ts + 5000)(df, 3)
    assert [r["stage"] for r in seen] == ["index_inflight"]
    stages = {r["stage"]: r["lease_until"] for r in store.current("claims", schemas.CLAIMS).collect()}
    assert stages == {"indexed_done": None}


def test_a_batch_killed_between_its_writes_is_not_seen(spark, tmp_path):
    import pytest

    from labelweave import schemas
    from labelweave.operators import scoring as SC
    from labelweave.operators import state as ST
    from labelweave.sources.writers import SnapshotStore

    class Killed(SnapshotStore):
        at = None

        def _stop(self, step):
            if step == self.at:
                raise RuntimeError("killed")

        def write_changes(self, name, changes, batch_id):
            self._stop(name)
            super().write_changes(name, changes, batch_id)

        def commit(self, batch_id, digest=""):
            self._stop("commit")
            super().commit(batch_id, digest)

    tsv, fwd = str(tmp_path / "tsv"), str(tmp_path / "fwd")
    store = Killed(spark, str(tmp_path / "store"))
    write = PL.classify_batch_writer(SC.HashedLinearScorer(SC.default_weights(spark)), str(tmp_path / "out"),
                                     on_batch=PL.index_sink(store, tsv, fwd, now=F.lit(0).cast("timestamp")))

    def batch(ids, path):
        return spark.createDataFrame([(i, f"2024Test.{i:010d}", "classify", path) for i in ids],
                                     "input_index long, bibcode string, operation_step string, output_path string").selectExpr(
            "*", "cast(null as string) as scix_id", "cast(null as array<string>) as override", "cast(1 as long) as run_id",
            "'a title' as title", "'an abstract' as abstract")

    def seen():
        csv = spark.read.schema("bibcode string, batch long, output_path string").option("sep", "\t").option("header", True)
        return (store.current_committed("scores", schemas.SCORES).count(),
                store.current_committed("final_collection", schemas.FINAL_COLLECTION).count(),
                sorted((r["batch"], r["output_path"]) for r in store.committed_files(csv.csv, tsv).collect()),
                store.committed_files(lambda p: spark.read.text(p), fwd).count())

    assert store.committed() == -1
    write(batch([1, 2], "a/b"), 0)
    first = (2, 2, [(0, "a/b")] * 2, 2)
    assert seen() == first
    for step in ("scores", "final_collection", "commit"):
        store.at = step
        with pytest.raises(RuntimeError):
            write(batch([2, 3, 4], None), 1)
        assert seen() == first and store.committed() == 0
    store.at = None
    for _ in range(2):  # the second time it is committed already
        write(batch([2, 3, 4], None), 1)
        assert seen() == (4, 4, [(0, "a/b")] * 2 + [(1, None)] * 3, 5) and store.committed() == 1
    with pytest.raises(ValueError):
        write(batch([9], None), 0)  # of another checkpoint
    write(batch([2, 3, 4, 5], None), 1)  # the last batch came out larger: written anew
    assert seen()[:2] == (5, 5) and seen()[3] == 6
    counted = store.read_committed("counters", ST.COUNTERS).collect()
    assert sorted(tuple(r) for r in counted) == [(2, 2, 0, 2, 0), (4, 3, 1, 3, 1)]
