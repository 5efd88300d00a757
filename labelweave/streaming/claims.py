"""H2 / H3: per-fingerprint lease state machine (claim / mark).

State per fingerprint: (stage, lease_until).  ``claim`` of
``classify_inflight`` (lease 300 s) or ``index_inflight`` (lease 120 s)
succeeds or not by the table below; a success stores the stage with
``ts + lease``.  ``mark`` stores a stage and clears the lease.

  current stage                 claim classify   claim index
  none                          yes              yes
  classify_inflight, live       no               no
  classify_inflight, expired    yes              no
  classify_done                 no               yes
  index_inflight, live          no               no
  index_inflight, expired       no               yes
  indexed_done                  no               no

Decisions of a key follow one another, so a key is folded in order; the state
is one small row.  A stored table is sorted by (key, ts, event_id) and folded
in one pass that holds one Arrow batch at a time (``claims_batch``).  Streams
use ``applyInPandasWithState``: a key's events of a micro-batch are put in
order before they are folded.  ``claims_replay`` runs a stored table through
the streaming form in time-ordered slices.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from labelweave import config as C
from labelweave.session import ship_package

LEASES = {"classify_inflight": C.CLASSIFY_LEASE_S, "index_inflight": C.INDEX_LEASE_S}

OUT = StructType([StructField("fp", LongType()), StructField("event_id", LongType()),
                  StructField("ts", DoubleType()), StructField("op", StringType()),
                  StructField("granted", BooleanType()), StructField("stage", StringType()),
                  StructField("lease_until", DoubleType())])
STATE = StructType([StructField("stage", StringType()), StructField("lease_until", DoubleType())])


ALWAYS, EXPIRED, NEVER = "always", "once the lease has run out", "never"
#: When a claim is granted, by current stage and claimed stage (fixed values).
GRANTS = {
    None: {"classify_inflight": ALWAYS, "index_inflight": ALWAYS},
    "classify_inflight": {"classify_inflight": EXPIRED, "index_inflight": NEVER},
    "classify_done": {"classify_inflight": NEVER, "index_inflight": ALWAYS},
    "index_inflight": {"classify_inflight": NEVER, "index_inflight": EXPIRED},
    "indexed_done": {"classify_inflight": NEVER, "index_inflight": NEVER},
}


def transition(stage, lease_until, op: str, target: str, ts: float):
    """One event: (granted, stage after it, lease after it).  A mark always
    holds and ends the lease; a claim holds as ``GRANTS`` says; anything else
    (also null, or a stage that is not known) is refused and changes nothing."""
    if op == "mark" and target in GRANTS:
        return True, target, None
    if op != "claim" or target not in LEASES:
        return False, stage, lease_until
    when = GRANTS[stage][target]
    if when == ALWAYS or (when == EXPIRED and (lease_until or 0.0) <= ts):
        return True, target, ts + LEASES[target]
    return False, stage, lease_until


def granted(target: str, stage: Column, lease_until: Column, ts: Column) -> Column:
    """``GRANTS`` as a column expression: whether a claim of ``target`` at
    ``ts`` is granted to a key in ``stage`` (null: no state yet)."""
    def rule(when):
        return {ALWAYS: F.lit(True), NEVER: F.lit(False), EXPIRED: F.coalesce(lease_until, F.lit(0.0)) <= ts}[when]
    out = F.when(stage.isNull(), rule(GRANTS[None][target]))
    for name, rules in GRANTS.items():
        if name is not None:
            out = out.when(stage == name, rule(rules[target]))
    return out


def _fold(fps, ids, times, ops, fp=None, stage=None, lease=None):
    """Rows of events given in order, and the state after the last; a change
    of key starts from no state."""
    rows = []
    for key, eid, ts, op in zip(fps, ids, times, ops):
        if key != fp:
            fp, stage, lease = key, None, None
        kind, _, target = (op if isinstance(op, str) else "").partition(":")
        granted, stage, lease = transition(stage, lease, kind, target, float(ts))
        rows.append((int(key), int(eid), float(ts), op, granted, stage, lease))
    return rows, fp, stage, lease


def _events(events: DataFrame, key: str) -> DataFrame:
    ship_package(events.sparkSession)
    return events.select(F.col(key).cast("long").alias("fp"), F.col("event_id").cast("long"),
                         F.coalesce(F.col("ts").cast("double"), F.lit(0.0)).alias("ts"), "op")


def claims_by_output(events: DataFrame) -> DataFrame:
    """H2 in its scope: ``output_path, fp, operation_step, event_id, ts, op``
    -> per event whether it is granted and the state after it.

    A claim belongs to (output path, fingerprint); events of other steps than
    pre-ingest, or without an output path, always hold and have no state."""
    from labelweave.functions.ids import nonblank
    scoped = F.coalesce((F.col("operation_step") == "pre_ingest") & nonblank("output_path").isNotNull(), F.lit(False))
    schema = StructType([StructField("output_path", StringType()), *OUT.fields])

    def fold(batches):
        path = fp = stage = lease = None
        for pdf in batches:
            rows = []
            for where, run in pdf.groupby("output_path", sort=False):
                if where != path:
                    path, fp, stage, lease = where, None, None, None
                found, fp, stage, lease = _fold(run["fp"], run["event_id"], run["ts"], run["op"], fp, stage, lease)
                rows += [(where, *r) for r in found]
            yield pd.DataFrame(rows, columns=schema.fieldNames())
    ship_package(events.sparkSession)
    ev = events.select("output_path", F.col("fp").cast("long").alias("fp"), F.col("event_id").cast("long").alias("event_id"),
                       F.coalesce(F.col("ts").cast("double"), F.lit(0.0)).alias("ts"), "op", scoped.alias("scoped"))
    held = (ev.filter("scoped").drop("scoped").repartition("output_path", "fp")
            .sortWithinPartitions("output_path", "fp", "ts", "event_id").mapInPandas(fold, schema))
    free = ev.filter("not scoped").select("output_path", "fp", "event_id", "ts", "op", F.lit(True).alias("granted"),
                                          F.lit(None).cast("string").alias("stage"), F.lit(None).cast("double").alias("lease_until"))
    return held.unionByName(free)


def claims_batch(events: DataFrame, key: str = "fp") -> DataFrame:
    """Stored events: ``key, event_id, ts, op`` ('claim:<stage>' /
    'mark:<stage>') -> per event granted flag and the state after it."""
    def fold(batches):
        fp = stage = lease = None
        for pdf in batches:
            rows, fp, stage, lease = _fold(pdf["fp"], pdf["event_id"], pdf["ts"], pdf["op"], fp, stage, lease)
            yield pd.DataFrame(rows, columns=OUT.fieldNames())
    ev = _events(events, key).repartition("fp").sortWithinPartitions("fp", "ts", "event_id")
    return ev.mapInPandas(fold, OUT)


def claims_stream(events: DataFrame, key: str = "fp") -> DataFrame:
    """Streaming form: state carried across micro-batches per key.  Spark
    hands a key's events over in chunks of no order, so the key's events of
    the micro-batch (bounded by the trigger) are gathered and sorted first."""
    def per_key(k, pdfs, state):
        stage, lease = (state.get if state.exists else (None, None))
        pdf = pd.concat(list(pdfs)).sort_values(["ts", "event_id"], kind="mergesort")
        rows, _, stage, lease = _fold(pdf["fp"], pdf["event_id"], pdf["ts"], pdf["op"], int(k[0]), stage, lease)
        state.update((stage, lease))
        yield pd.DataFrame(rows, columns=OUT.fieldNames())
    return _events(events, key).groupBy("fp").applyInPandasWithState(per_key, OUT, STATE, "append", "NoTimeout")


def final_states(claims: DataFrame, key: str = "fp") -> DataFrame:
    """H3 view: the state of every key after its last event."""
    return claims.groupBy(key).agg(F.max_by(F.struct("stage", "lease_until"), F.struct("ts", "event_id")).alias(
        "s")).select(key, "s.stage", "s.lease_until")


def claims_replay(events: DataFrame, base: str, slice_rows: int = 1_000_000, key: str = "fp") -> DataFrame:
    """Claims over a stored event table, run through the streaming form: the
    events are written as time-ordered files of about ``slice_rows`` rows
    (range-partitioned on ts), replayed one file per micro-batch with per-key
    state, and the decisions read back."""
    import os

    from labelweave.session import stamp_in_name_order
    spark = events.sparkSession
    ev = events.select(F.col(key).cast("long").alias("fp"), F.col("event_id").cast("long"),
                       F.col("ts").cast("double"), "op")
    slices = max(1, -(-events.count() // slice_rows))
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    ev.repartitionByRange(slices, "ts", "event_id").sortWithinPartitions("ts", "event_id").write.parquet(src)
    stamp_in_name_order(spark, src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (claims_stream(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
