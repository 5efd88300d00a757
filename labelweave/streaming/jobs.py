"""H1, H4, H5: the classify stream, replay dedupe and the event-metrics
stream.  Streams read files (``readStream``), checkpoint to the shared
folder, and write through ``foreachBatch`` keyed by the batch id so a
replayed micro-batch rewrites the same output (exactly-once results)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from labelweave import config as C
from labelweave.functions.ids import fingerprint, nonblank
from labelweave.operators import scoring as SC
from labelweave.session import cut_lineage
from labelweave.streaming import claims as CL

REQUEST = StructType([
    StructField("input_index", LongType()), StructField("batch_id", LongType()),
    StructField("bibcode", StringType()), StructField("scix_id", StringType()),
    StructField("title", StringType()), StructField("abstract", StringType()),
    StructField("operation_step", StringType()), StructField("run_id", LongType()),
    StructField("output_path", StringType()), StructField("override", ArrayType(StringType())),
])


def claim_key() -> F.Column:
    """A claim is scoped by the output it is for: one replay of a record goes
    on per output path."""
    return F.sha2(F.concat_ws("|", F.octet_length("output_path").cast("string"), "output_path", "fingerprint"), 256)


def claim_pre_ingest(df: DataFrame, store, batch_id: int, ts) -> tuple[DataFrame, DataFrame]:
    """H2 / H4 before classification: of the pre-ingest rows that name an
    output path, one per path and replay fingerprint goes on, and only if its
    claim of ``classify_inflight`` is granted on the state before this batch (a
    replayed batch decides alike).  The claims are stored with their lease.
    Rows of other steps, and pre-ingest rows without an output path, always go
    on.  Returns the rows that go on and the claims' keys."""
    from labelweave import schemas
    if "output_path" not in df.columns:
        df = df.withColumn("output_path", F.lit(None).cast("string"))
    pre = F.coalesce((F.col("operation_step") == "pre_ingest") & nonblank("output_path").isNotNull(), F.lit(False))
    states = store.current("claims", schemas.CLAIMS, batch_id).withColumnRenamed("id", "claim")
    rows = df.filter(pre).withColumn("fingerprint", fingerprint(df)).withColumn("claim", claim_key())
    once = rows.dropDuplicates(["claim"]).join(states, "claim", "left")
    mine = cut_lineage(once.filter(CL.granted("classify_inflight", F.col("stage"), F.col("lease_until"), ts)))
    claimed = mine.select(F.col("claim").alias("id"))
    mark_claims(store, claimed, "classify_inflight", batch_id, ts + F.lit(float(C.CLASSIFY_LEASE_S)))
    return df.filter(~pre).unionByName(mine.select(*df.columns)), claimed


def mark_claims(store, claimed: DataFrame, stage: str, batch_id: int, lease_until=None) -> None:
    """Store the stage of this batch's claims (H3); a batch's later stage takes
    the place of its earlier one, also when the batch is replayed."""
    lease = lease_until if lease_until is not None else F.lit(None)
    store.write_changes("claims", claimed.select("id", F.lit(stage).alias("stage"), lease.cast("double").alias("lease_until")), batch_id)


def classify_batch_writer(scorer, sink: str, cfg: C.ClassifierConfig = C.DEFAULT, on_batch=None, claims=None, now=None):
    """foreachBatch body: classify the micro-batch and write its results to
    ``sink/batch=<id>`` (overwritten on replay); ``on_batch(df, id)`` can
    chain index / TSV / forward steps, and gets the written results.  With a
    ``claims`` store, pre-ingest rows claim classification first, then are
    marked classified, claim the index step and are marked indexed."""
    def run(df: DataFrame, batch_id: int) -> None:
        ts = (now if now is not None else F.unix_timestamp()).cast("double")
        claimed = None
        if claims is not None:
            df, claimed = claim_pre_ingest(df, claims, batch_id, ts)
        out = SC.classify(df, scorer, cfg, keys=("input_index",), carry=tuple(
            f.name for f in REQUEST if f.name in df.columns and f.name != "input_index"))
        path = os.path.join(sink, f"batch={batch_id}")
        out.write.mode("overwrite").parquet(path)
        if claimed is not None:
            mark_claims(claims, claimed, "classify_done", batch_id)
        if on_batch is not None:
            if claimed is not None:  # classify_done always grants the index claim
                mark_claims(claims, claimed, "index_inflight", batch_id, ts + F.lit(float(C.INDEX_LEASE_S)))
            on_batch(df.sparkSession.read.parquet(path), batch_id)
            if claimed is not None:
                mark_claims(claims, claimed, "indexed_done", batch_id)
    return run


def start_classify_stream(spark: SparkSession, src: str, sink: str, checkpoint: str, scorer,
                          cfg: C.ClassifierConfig = C.DEFAULT, files_per_trigger: int = 1,
                          available_now: bool = True, on_batch=None, claims=None):
    """H1: requests arrive as JSON files in ``src``."""
    stream = (spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", files_per_trigger).json(src))
    w = (stream.writeStream.foreachBatch(classify_batch_writer(scorer, sink, cfg, on_batch, claims))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def drop_replays(df: DataFrame, done: DataFrame | None = None, watermark: str | None = None,
                 within: str = "7 days") -> DataFrame:
    """H4: rows classified once per fingerprint.  Batch: drop keys already
    done (anti join) and duplicates; stream: ``dropDuplicatesWithinWatermark``
    when an event-time column is given (bounded state; replays up to
    ``within`` apart are found), else ``dropDuplicates`` (state grows with the
    distinct keys)."""
    fp = df if "fingerprint" in df.columns else df.withColumn("fingerprint", fingerprint(df))
    if done is not None:
        fp = fp.join(done.select("fingerprint"), "fingerprint", "left_anti")
    if df.isStreaming and watermark:
        return fp.withWatermark(watermark, within).dropDuplicatesWithinWatermark(["fingerprint"])
    return fp.dropDuplicates(["fingerprint"])


def event_stats_stream(events: DataFrame) -> DataFrame:
    """H5 live view: per (run, stage) count and approximate p50/p95 of the
    durations (complete mode; ``percentile_approx`` keeps bounded state)."""
    d = F.col("duration_ms")
    return events.groupBy("run_id", "stage").agg(
        F.count(F.lit(1)).alias("count"),
        F.percentile_approx(d, F.lit(0.5), 10000).cast("double").alias("p50"),
        F.percentile_approx(d, F.lit(0.95), 10000).cast("double").alias("p95"))


def start_event_stream(spark: SparkSession, src: str, sink: str, checkpoint: str, schema, exact: bool = True,
                       available_now: bool = True, table: str | None = None):
    """H5: JSONL events appended by many workers, folded per run/stage.

    ``exact=True``: each micro-batch appends its (run, stage, duration, count)
    runs to ``table`` (partition ``batch=<id>``, replaced on replay) and the
    exact per-stage statistics are merged from all runs with the distributed
    weighted order statistics (no group is held in one task or in state; the
    work follows the distinct durations, not the events).
    ``exact=False``: a complete-mode aggregate with approximate percentiles.
    Either way ``sink`` holds the current result after every micro-batch."""
    from labelweave.operators.metrics import numeric_stats

    ev = spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(src)
    ev = ev.select("run_id", "stage", "duration_ms")
    if exact:
        table = table or sink + "_events"

        def write(df: DataFrame, batch_id: int) -> None:
            (df.groupBy("run_id", "stage", "duration_ms").agg(F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(table))
            allev = spark.read.parquet(table)
            st = numeric_stats(allev, ["run_id", "stage"], "duration_ms", include_p99=False, weight="n")
            st.select("run_id", "stage", "count", "p50", "p95").write.mode("overwrite").parquet(sink)
        w = ev.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    else:
        agg = event_stats_stream(ev)

        def write(df: DataFrame, batch_id: int) -> None:
            df.write.mode("overwrite").parquet(sink)
        w = agg.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def input_digest(df: DataFrame) -> str:
    """Rows and the sum of their hashes over the request's own columns: equal
    for the same rows in any order (scores may differ in their last digits)."""
    cols = [f.name for f in REQUEST if f.name in df.columns]
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first()
    return f"{r[0]}-{r[1] or 0}"


def index_sink(store, tsv_root: str, forward_root: str, now=None, default_step: str = C.DEFAULT_OPERATION_STEP):
    """H1 ``on_batch`` step after classification.  G8 routes every row by its
    own step: to G1 index, to G3-G5 validation, or straight to the TSV; both
    transitions see the stored state as of before this batch, and only their
    changes are stored.  A10 TSV rows and A11 responses follow G9; TSV rows lie
    under their own ``output_path`` (a partition folder) where rows name one.

    The batch's E16 counters are taken by its own write and kept in the table
    ``counters``.  Every output of batch ``n`` is written under ``batch=<n>`` and the batch is
    committed to the store last: a crash between the writes shows none of them
    to readers of committed batches (``current_committed``,
    ``committed_files``), and the replay writes them all again.  The replay of
    a committed batch changes nothing.  Of requests for one record in a
    micro-batch the last one is indexed, so the number of score rows follows
    the batch cut; TSV rows are one per request."""
    from labelweave import schemas
    from labelweave.operators import latest as L
    from labelweave.operators import state as ST
    from labelweave.operators.output import output_row, score_payload
    from labelweave.sources.writers import _tsv_writer, to_response

    def last_id(name, batch_id):
        log = store.log(name, batch_id)
        return L.max_id(log) if log is not None else F.lit(0)

    def on_batch(classified: DataFrame, batch_id: int) -> None:
        digest = input_digest(classified)
        if not store.begin(batch_id, digest):
            return
        ts = now if now is not None else F.current_timestamp()
        recs = classified
        for c, t in (("run_id", "long"), ("operation_step", "string"), ("bibcode", "string"),
                     ("scix_id", "string"), ("override", "array<string>")):
            if c not in recs.columns:
                recs = recs.withColumn(c, F.lit(None).cast(t))
        recs = recs.withColumn("operation_step", F.coalesce(F.col("operation_step"), F.lit(default_step)))
        recs = recs.withColumn("payload", score_payload())
        recs = recs.withColumn("route", ST.route_index(recs))
        # only what indexing needs: texts and score arrays stay out of its shuffles and copies
        ident = recs.filter((F.col("route") == "index") & (nonblank("bibcode").isNotNull() | nonblank("scix_id").isNotNull())).select(
            "input_index", "bibcode", "scix_id", "run_id", "collections", "payload")
        checks = recs.filter(F.col("route") == "validate")
        known = recs.filter(F.col("route") != "pass_through").select("bibcode", "scix_id")
        state = ST.State(store.read("overrides", schemas.OVERRIDES, batch_id),
                         store.current("scores", schemas.SCORES, batch_id, known),
                         store.current("final_collection", schemas.FINAL_COLLECTION, batch_id, known))
        counted = Observation(f"index-{batch_id}")
        indexed, res = ST.index_batch(state, ident, ts, score_id_base=last_id("scores", batch_id),
                                      final_id_base=last_id("final_collection", batch_id), observe=counted)
        store.append("counters", ST.observed_counters(classified.sparkSession, counted), batch_id)
        checked, outcome = ST.validate(state.apply(indexed), checks.select(
            "input_index", "bibcode", "scix_id", "override"), ts)
        changes = indexed.then(checked)
        store.append("overrides", changes.overrides, batch_id)
        store.write_changes("scores", changes.scores, batch_id)
        store.write_changes("final_collection", changes.final, batch_id)
        write_tsv, fwd = ST.output_actions(F.col("operation_step"), F.lit(C.STATUS_INDEXED))
        by_path = "output_path" in recs.columns
        recs = recs.withColumn("output_path", nonblank("output_path")) if by_path else recs
        tsv = _tsv_writer(output_row(recs.filter(write_tsv), ("output_path",) if by_path else ()), "overwrite")
        (tsv.partitionBy("output_path") if by_path else tsv).csv(os.path.join(tsv_root, f"batch={batch_id}"))
        sent = res.join(recs.filter(fwd).select("input_index"), "input_index", "left_semi").select(
            "bibcode", "scix_id", F.lit("success").alias("status"), F.col("final_collections").alias("collections"))
        validated = outcome.join(checks.select("input_index", "override"), "input_index").select(
            "bibcode", "scix_id", "status", F.col("override").alias("collections"))
        to_response(sent.unionByName(validated)).write.mode("overwrite").text(
            os.path.join(forward_root, f"batch={batch_id}"))
        store.commit(batch_id, digest)
    return on_batch
