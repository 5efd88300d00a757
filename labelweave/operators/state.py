"""Table state: score/override/final-collection lookups and the index,
validate and resend transitions (D3 D4 D6 D7 D8 D11, F2, G1..G11).

Every transition is a pure function of the old state and a batch that gives
``Changes``: the rows it inserts or changes, never whole tables.
``State.apply`` shows the tables after them; ``SnapshotStore`` persists them
(append-only ``overrides``/``runs``/``models``, change logs for ``scores`` and
``final_collection``).

Table schemas (ids are longs, times are timestamps in UTC):
  overrides(id, bibcode, scix_id, override array<string>, created)
  scores(id, bibcode, scix_id, scores string, created, overrides_id, run_id)
  final_collection(id, bibcode, scix_id, score_id, collection array<string>,
                   validated boolean, validated_at timestamp, created)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from labelweave import config as C
from labelweave.functions.ids import nonblank, record_key_kind, record_key_value
from labelweave.operators import latest as L
from labelweave.operators.latest import exists_by_either_id
from labelweave.operators.requests import is_allowed, is_single_empty
from labelweave.session import cut_lineage

ORDER = ["created", "id"]


@dataclass
class State:
    overrides: DataFrame
    scores: DataFrame
    final: DataFrame
    runs: DataFrame | None = None
    models: DataFrame | None = None

    def apply(self, c: "Changes") -> "State":
        """The tables after the changes (rows replaced or added by id)."""
        return State(merged(self.overrides, c.overrides), merged(self.scores, c.scores), merged(self.final, c.final),
                     self.runs, self.models)


@dataclass
class Changes:
    """Inserted and changed rows of each table (None: none)."""
    overrides: DataFrame | None = None
    scores: DataFrame | None = None
    final: DataFrame | None = None

    def then(self, later: "Changes") -> "Changes":
        both = [merged(a, b) if a is not None else b for a, b in (
            (self.overrides, later.overrides), (self.scores, later.scores), (self.final, later.final))]
        return Changes(*both)


def merged(table: DataFrame, changed: DataFrame | None) -> DataFrame:
    if changed is None:
        return table
    return table.join(changed.select("id"), "id", "left_anti").unionByName(changed.select(*table.columns))


def _row_key(df: DataFrame) -> DataFrame:
    return df.withColumn("_kk", record_key_kind()).withColumn("_kv", record_key_value())


def dedupe_batch(records: DataFrame, key: str = "input_index") -> DataFrame:
    """Q8: one row per record key inside a batch, the last input wins; rows
    without any id are records of their own and all stay."""
    named = nonblank("scix_id").isNotNull() | nonblank("bibcode").isNotNull()
    last = L.latest_per_key(_row_key(records.filter(named)), ["_kk", "_kv"], [key]).drop("_kk", "_kv")
    return last.unionByName(records.filter(~named))


def resolve_override(records: DataFrame, overrides: DataFrame, mode: str = "batch",
                     collections_col: str = "collections", key: str = "input_index",
                     ids_from: DataFrame | None = None, ids_small: bool = False) -> DataFrame:
    """D1 (mode 'batch': scix_id first, then bibcode) / D2 (mode 'newest':
    newest of either id).  Adds ``overrides_id`` and ``final_collections``."""
    if mode == "batch":
        j = L.resolve_by_either_id(records, overrides, ORDER, "ov_", ids_from=ids_from, ids_small=ids_small)
    else:
        j = L.resolve_newest_either(records, overrides, ORDER, "ov_", key, ids_from=ids_from, ids_small=ids_small)
    has = F.col("ov_id").isNotNull()
    return j.select(*records.columns, F.col("ov_id").alias("overrides_id"),
                    F.when(has, F.col("ov_override")).otherwise(F.col(collections_col)).alias("final_collections"))


def match_scores(specs: DataFrame, scores: DataFrame, payload_col: str = "payload",
                 ids_from: DataFrame | None = None, ids_small: bool = False) -> DataFrame:
    """D3: newest existing score row with the same (key kind, key value,
    payload, overrides_id [NULL matches NULL], run_id).  Adds
    ``existing_score_id`` (NULL -> a new row is needed)."""
    k = specs.withColumn("_kk", record_key_kind()).withColumn("_kv", record_key_value())
    # prefetch the score rows of the batch's keys and runs only
    src = ids_from if ids_from is not None else specs
    want = src.select(record_key_kind().alias("_kk"), record_key_value().alias("_kv"), "run_id")
    s = _row_key(scores).join(F.broadcast(want) if ids_small else want, ["_kk", "_kv", "run_id"], "left_semi")
    s = L.latest_per_key(s, ["_kk", "_kv", "scores", "overrides_id", "run_id"], ORDER)
    s = s.select(F.col("_kk").alias("_s_kk"), F.col("_kv").alias("_s_kv"), F.col("scores").alias("_s_payload"),
                 F.col("overrides_id").alias("_s_ov"), F.col("run_id").alias("_s_run"),
                 F.col("id").alias("existing_score_id"))
    cond = ((F.col("_kk") == F.col("_s_kk")) & (F.col("_kv") == F.col("_s_kv"))
            & (F.col(payload_col) == F.col("_s_payload")) & F.col("overrides_id").eqNullSafe(F.col("_s_ov"))
            & (F.col("run_id") == F.col("_s_run")))
    return k.join(s, cond, "left").select(*specs.columns, "existing_score_id")


def match_scores_either(specs: DataFrame, scores: DataFrame, payload_col: str = "payload",
                        ids_from: DataFrame | None = None, ids_small: bool = False) -> DataFrame:
    """G2's lookup: newest existing score row with EITHER id of the record and
    the same payload, overrides_id and run_id: the newer of the newest by
    scix_id and the newest by bibcode."""
    src = ids_from if ids_from is not None else specs
    out = specs
    for c in ("scix_id", "bibcode"):
        want = src.select(nonblank(c).alias(c), "run_id").filter(F.col(c).isNotNull())
        s = scores.join(F.broadcast(want) if ids_small else want, [c, "run_id"], "left_semi")
        s = L.latest_per_key(s, [c, "scores", "overrides_id", "run_id"], ORDER).select(
            F.col(c).alias("_k"), F.col("scores").alias("_p"), F.col("overrides_id").alias("_o"),
            F.col("run_id").alias("_r"), F.struct(*ORDER).alias(f"_by_{c}"))
        out = out.join(s, (nonblank(F.col(c)) == F.col("_k")) & (F.col(payload_col) == F.col("_p"))
                       & F.col("overrides_id").eqNullSafe(F.col("_o")) & (F.col("run_id") == F.col("_r")),
                       "left").drop("_k", "_p", "_o", "_r")
    return out.select(*specs.columns, F.greatest("_by_scix_id", "_by_bibcode")["id"].alias("existing_score_id"))


def get_or_create_model(models: DataFrame, runs: DataFrame, model: Column, postprocessing: Column,
                        run_ids: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, Column]:
    """Newest models row with this (model, postprocessing), inserted when
    absent; every run of ``run_ids`` is bound to it.  Returns (models, runs,
    model_id scalar).  Lookups are filters + scalar subqueries (the wanted
    key is a literal, so a join would degenerate into a nested loop)."""
    found = models.filter((F.col("model") == model) & (F.col("postprocessing") == postprocessing))
    n_found = found.select(F.count(F.lit(1))).scalar()
    new = (models.sparkSession.range(1).filter(n_found == 0)
           .select((L.max_id(models) + 1).alias("id"), model.alias("model"), postprocessing.alias("postprocessing"),
                   now.alias("created")))
    models2 = models.unionByName(new.select(*models.columns))
    mid = (models2.filter((F.col("model") == model) & (F.col("postprocessing") == postprocessing))
           .select(F.max_by("id", F.struct("created", "id"))).scalar())
    bind = run_ids.select(F.col("run_id").alias("id")).distinct()
    runs2 = runs.join(bind.withColumn("_bind", F.lit(True)), "id", "left").select(
        *[F.when(F.col("_bind"), mid).otherwise(F.col("model_id")).alias("model_id") if c == "model_id"
          else F.col(c) for c in runs.columns])
    return models2, runs2, mid


def index_batch(state: State, records: DataFrame, now: Column, payload_col: str = "payload",
                override_mode: str = "batch", score_id_base: Column | None = None,
                final_id_base: Column | None = None,
                observe: Observation | None = None) -> tuple[Changes, DataFrame]:
    """G1 (mode 'batch') / G2 (mode 'newest'): resolve overrides, reuse or
    append score rows, update or insert final rows.  G1 matches scix_id first,
    then bibcode; G2 takes the newest row of either id, also for scores and
    final rows.  Returns the changes and per-record results
    (``status='record_indexed'``, score/final ids, flags for E16).

    The resolved batch is materialised once (checkpoint) and new ids are
    assigned on that copy, so every output (score rows, final upserts,
    results) sees the same ids and no branch re-derives the joins.  With
    ``observe`` the E16 counters are taken while that copy is written
    (``observed_counters``)."""
    # ``*_id_base``: current max ids when ``state`` holds only a prefetched
    # subset of the tables (default: max over the given tables)
    # the deduplicated batch is materialised once: every lookup prefetches by
    # its ids and the derived frames are not re-derived for that
    recs = cut_lineage(dedupe_batch(records))
    small = recs.count() <= L.MAX_BROADCAST_IDS  # parquet footers: no scan
    r = resolve_override(recs, state.overrides, override_mode, ids_from=recs, ids_small=small)
    if override_mode == "batch":
        r = match_scores(r, state.scores, payload_col, ids_from=recs, ids_small=small)
        f = L.resolve_by_either_id(r, state.final, ORDER, "fc_", ids_from=recs, ids_small=small)
    else:
        r = match_scores_either(r, state.scores, payload_col, ids_from=recs, ids_small=small)
        f = L.resolve_newest_either(r, state.final, ORDER, "fc_", ids_from=recs, ids_small=small)
    f = cut_lineage(f.select("input_index", "bibcode", "scix_id", "run_id", F.col(payload_col).alias("_payload"),
                             "overrides_id", "final_collections", "existing_score_id", "fc_id"))
    new_sc = L.with_surrogate_ids(f.filter(F.col("existing_score_id").isNull()).select("input_index"),
                                  score_id_base if score_id_base is not None else L.max_id(state.scores),
                                  ["input_index"], "new_score_id")
    new_fc = L.with_surrogate_ids(f.filter(F.col("fc_id").isNull()).select("input_index"),
                                  final_id_base if final_id_base is not None else L.max_id(state.final),
                                  ["input_index"], "new_final_id")
    res = (f.join(new_sc, "input_index", "left").join(new_fc, "input_index", "left")
           .withColumn("score_id", F.coalesce(F.col("existing_score_id"), F.col("new_score_id"))))
    if observe is not None:
        res = res.observe(observe, *_counters(F.col("new_score_id").isNotNull(), F.col("fc_id").isNotNull()))
    res = cut_lineage(res)
    score_rows = res.filter(F.col("new_score_id").isNotNull()).select(
        F.col("new_score_id").alias("id"), "bibcode", "scix_id", F.col("_payload").alias("scores"),
        now.alias("created"), F.col("overrides_id").cast("long").alias("overrides_id"),
        F.col("run_id").cast("long").alias("run_id"))
    upd = L.latest_per_key(res.filter(F.col("fc_id").isNotNull()).select(
        "fc_id", "input_index", "final_collections", "score_id"), "fc_id", ["input_index"])
    u = upd.select(F.col("fc_id").alias("id"), F.col("final_collections").alias("_coll"),
                   F.col("score_id").alias("_sid"))
    fin = state.final.join(u, "id").select(
        *[F.coalesce(F.col("_coll"), F.col("collection")).alias("collection") if c == "collection"
          else F.coalesce(F.col("_sid"), F.col("score_id")).alias("score_id") if c == "score_id"
          else F.col(c) for c in state.final.columns])
    new_rows = res.filter(F.col("new_final_id").isNotNull()).select(
        F.col("new_final_id").alias("id"), "bibcode", "scix_id", "score_id",
        F.col("final_collections").alias("collection"), F.lit(False).alias("validated"),
        F.lit(None).cast("timestamp").alias("validated_at"), now.alias("created"))
    final = fin.unionByName(new_rows.select(*state.final.columns))
    results = res.select(
        "input_index", "bibcode", "scix_id", "overrides_id", "final_collections", "score_id",
        F.col("new_score_id").isNotNull().alias("new_score"),
        F.col("fc_id").isNotNull().alias("final_updated"),
        F.coalesce(F.col("fc_id"), F.col("new_final_id")).alias("final_id"),
        F.lit(C.STATUS_INDEXED).alias("status"))
    return Changes(scores=score_rows.select(*state.scores.columns), final=final), results


def _counters(new_score: Column, final_updated: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("record_count"), F.count_if(new_score).alias("new_score_rows"),
            F.count_if(~new_score).alias("reused_score_rows"), F.count_if(~final_updated).alias("new_final_rows"),
            F.count_if(final_updated).alias("updated_final_rows")]


COUNTERS = "record_count long, new_score_rows long, reused_score_rows long, new_final_rows long, updated_final_rows long"


def index_counters(results: DataFrame, batch_col: str | None = None) -> DataFrame:
    """Record count, new / reused score rows, new / updated final rows."""
    g = results.groupBy(batch_col) if batch_col else results.groupBy()
    return g.agg(*_counters(F.col("new_score"), F.col("final_updated")))


def observed_counters(spark, observation: Observation) -> DataFrame:
    """E16 of one ``index_batch``, as seen by its own write: no further job
    reads the batch.  One row."""
    seen = observation.get
    names = [c.split()[0] for c in COUNTERS.split(", ")]
    return spark.createDataFrame([tuple(int(seen.get(n, 0)) for n in names)], COUNTERS)


def set_validation(df: DataFrame, flag: Column, now: Column) -> DataFrame:
    """validated_at = coalesce(validated_at, now) when validated, NULL when not."""
    return (df.withColumn("validated", flag)
              .withColumn("validated_at", F.when(flag, F.coalesce(F.col("validated_at"), now))))


def _either_match(reqs: DataFrame, table: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """All (request, table row) pairs matching by scix_id or bibcode, as a
    union of two equi joins, deduplicated on (request, row id)."""
    t = table.select(*[F.col(c).alias("_t_" + c) for c in cols])
    rk = reqs.select(key, nonblank(F.col("scix_id")).alias("_rs"), nonblank(F.col("bibcode")).alias("_rb"))
    a = rk.join(t, F.col("_rs") == F.col("_t_scix_id"))
    b = rk.join(t, F.col("_rb") == F.col("_t_bibcode"))
    return a.unionByName(b).drop("_rs", "_rb").dropDuplicates([key, "_t_id"])


def validate(state: State, reqs: DataFrame, now: Column, key: str = "input_index",
             override_id_base: Column | None = None) -> tuple[Changes, DataFrame]:
    """G3 + G4 + G5: curator validation.  ``reqs``: key, bibcode, scix_id,
    override array<string>.  Returns the changes and per-request
    ``outcome`` (true status) with ``status`` = 'record_validated' for every
    request (the forwarded status, Q5)."""
    reqs = cut_lineage(dedupe_batch(reqs, key))
    same = exists_by_either_id(reqs, state.overrides, [("override", "override")], key).withColumn(
        "_same", F.lit(True))
    fin = state.final.select("id", "bibcode", "scix_id", "created", "validated")
    newest_any = L.resolve_newest_either(reqs.select(key, "bibcode", "scix_id"), fin, ORDER, "_n_", key).select(
        key, F.col("_n_id").alias("_newest_id"))
    newest_unval = L.resolve_newest_either(reqs.select(key, "bibcode", "scix_id"), fin.filter(~F.col("validated")),
                                           ORDER, "_u_", key).select(key, F.col("_u_id").alias("_unval_id"))
    any_val = exists_by_either_id(reqs, fin.filter(F.col("validated")), [], key).withColumn("_has_val", F.lit(True))
    x = (reqs.join(same, key, "left").join(newest_any, key, "left").join(newest_unval, key, "left")
             .join(any_val, key, "left"))
    same_c = F.coalesce(F.col("_same"), F.lit(False))
    allowed = is_allowed("override")
    empty = is_single_empty("override")
    branch = (F.when(~same_c & allowed, F.lit("override")).when(~same_c & empty, F.lit("as_is"))
              .when(same_c, F.lit("identical")).otherwise(F.lit("disallowed")))
    x = x.withColumn("_branch", branch)
    outcome = (F.when(F.col("_branch") == "override", F.lit(C.STATUS_VALIDATED))
               .when((F.col("_branch") == "as_is") & F.coalesce(F.col("_has_val"), F.lit(False)),
                     F.lit(C.STATUS_PREVIOUSLY_VALIDATED))
               .when((F.col("_branch") == "as_is") & F.col("_unval_id").isNotNull(), F.lit(C.STATUS_VALIDATED))
               .when(F.col("_branch") == "identical", F.lit(C.STATUS_PREVIOUSLY_VALIDATED))
               .when(F.col("_branch") == "disallowed", F.lit(C.STATUS_OTHER_FAILURE)))
    x = cut_lineage(x.withColumn("outcome", outcome))
    # new override rows
    ins = x.filter(F.col("_branch") == "override").select(key, "bibcode", "scix_id", "override")
    ins = cut_lineage(L.with_surrogate_ids(
        ins, override_id_base if override_id_base is not None else L.max_id(state.overrides), [key], "new_override_id"))
    ov_rows = ins.select(F.col("new_override_id").alias("id"), "bibcode", "scix_id", "override",
                         now.alias("created"))
    # every score row of the record gets the new override id
    sm = _either_match(ins, state.scores, key, ["id", "bibcode", "scix_id"]).join(
        ins.select(key, "new_override_id"), key)
    sm = L.latest_per_key(sm, "_t_id", [key]).select(F.col("_t_id").alias("id"), F.col("new_override_id").alias("_nov"))
    changed_scores = state.scores.join(sm, "id").select(
        *[F.col("_nov").alias("overrides_id") if c == "overrides_id" else F.col(c) for c in state.scores.columns])
    # final rows: newest row gets the override + validation (G3); newest
    # unvalidated row gets validation
    set_coll = x.filter(F.col("_branch") == "override").select(F.col("_newest_id").alias("id"),
                                                                F.col("override").alias("_coll"), key)
    set_val = x.filter((F.col("_branch") == "as_is") & F.col("_unval_id").isNotNull()).select(
        F.col("_unval_id").alias("id"), F.lit(None).cast("array<string>").alias("_coll"), key)
    ch = L.latest_per_key(set_coll.unionByName(set_val).filter(F.col("id").isNotNull()), "id", [key]).drop(key)
    changed = state.final.join(ch, "id").select(*[
        F.coalesce(F.col("_coll"), F.col("collection")).alias("collection") if c == "collection"
        else F.lit(True).alias("validated") if c == "validated"
        else F.coalesce(F.col("validated_at"), now).alias("validated_at") if c == "validated_at"
        else F.col(c) for c in state.final.columns])
    res = x.select(key, "bibcode", "scix_id", "outcome", F.lit(C.STATUS_VALIDATED).alias("status"),
                   F.lit(True).alias("forward"))
    return Changes(ov_rows.select(*state.overrides.columns), changed_scores, changed), res


def run_results(final: DataFrame, scores: DataFrame, run_id) -> DataFrame:
    """Final rows whose score belongs to ``run_id`` (the filter is pushed
    to the scores scan), ids from the final row else the score row, newest
    first, deduplicated per result key (F3)."""
    s = scores.filter(F.col("run_id") == F.lit(run_id)).select(
        F.col("id").alias("_sid"), F.col("bibcode").alias("_sb"), F.col("scix_id").alias("_ss"))
    j = final.join(s, final["score_id"] == F.col("_sid"))
    j = j.select("id", "created", "collection",
                 F.coalesce(nonblank("bibcode"), F.col("_sb")).alias("bibcode"),
                 F.coalesce(nonblank("scix_id"), F.col("_ss")).alias("scix_id"))
    return L.dedupe_results(j, ["created", "id"])


def recently_validated(final: DataFrame, days: int, now: Column) -> DataFrame:
    """validated rows with validated_at in the last ``days`` days (exact
    86400-second days, independent of the session time zone), newest
    validation first, one per result key."""
    f = final.filter(F.col("validated") & F.col("validated_at").isNotNull()
                     & (F.col("validated_at") >= F.timestamp_seconds(F.unix_seconds(now) - F.lit(int(days) * 86400))))
    return L.dedupe_results(f, ["validated_at", "created", "id"])


def bulk_lookup(ids: DataFrame, catalog: DataFrame, id_col: str = "identifier") -> DataFrame:
    """Catalogue rows for a list of ids (bibcode or scix_id), as two
    semi joins."""
    a = catalog.join(ids.select(F.col(id_col).alias("bibcode")), "bibcode", "left_semi")
    b = catalog.join(ids.select(F.col(id_col).alias("scix_id")), "scix_id", "left_semi")
    return a.unionByName(b).dropDuplicates(["id"])


def lookup_missing(ids: DataFrame, catalog: DataFrame, id_col: str = "identifier") -> DataFrame:
    """Ids for which the catalogue has nothing (anti joins on both id kinds)."""
    a = ids.join(catalog.select(F.col("bibcode").alias(id_col)), id_col, "left_anti")
    return a.join(catalog.select(F.col("scix_id").alias(id_col)), id_col, "left_anti")


def lookup_by_id(final: DataFrame, ids: DataFrame, id_col: str = "identifier", by: str = "bibcode") -> DataFrame:
    """Newest final row for each requested bibcode (or scix_id); ids with
    no row are simply absent (Q13)."""
    f = final.join(ids.select(F.col(id_col).alias(by)).distinct(), by, "left_semi")
    return L.latest_per_key(f, by, ORDER)


def validate_run(state: State, run_id, now: Column, key: str = "input_index") -> tuple[Changes, DataFrame]:
    """Every record of a run: its newest unvalidated final row becomes
    validated.  Per-row ``success`` (Q7)."""
    recs = cut_lineage(run_results(state.final, state.scores, run_id).select(
        F.col("id").alias(key), "bibcode", "scix_id"))
    fin = state.final.select("id", "bibcode", "scix_id", "created", "validated")
    unval = L.resolve_newest_either(recs, fin.filter(~F.col("validated")), ORDER, "_u_", key).select(
        key, F.col("_u_id").alias("_fid")).filter(F.col("_fid").isNotNull())
    tgt = unval.select(F.col("_fid").alias("id")).distinct()
    changed = state.final.join(tgt, "id").select(*[
        F.lit(True).alias("validated") if c == "validated"
        else F.coalesce(F.col("validated_at"), now).alias("validated_at") if c == "validated_at"
        else F.col(c) for c in state.final.columns])
    res = recs.join(unval, key, "left").select(key, "bibcode", "scix_id",
                                               F.col("_fid").isNotNull().alias("success"))
    return Changes(final=changed), res


def route_index(df: DataFrame) -> Column:
    """Route of each row by its own step (Q23): 'index' for classify /
    classify_verify and identified pre-ingest rows, 'pass_through' for
    anonymous pre-ingest rows, 'validate' otherwise."""
    ident = nonblank("bibcode").isNotNull() | nonblank("scix_id").isNotNull()
    step = F.col("operation_step")
    return (F.when(step.isin("classify", "classify_verify"), F.lit("index"))
            .when((step == "pre_ingest") & ident, F.lit("index"))
            .when(step == "pre_ingest", F.lit("pass_through"))
            .otherwise(F.lit("validate")))


def output_actions(step: Column, status: Column) -> tuple[Column, Column]:
    """(write_tsv, forward) flags: classify -> both; classify_verify and
    pre_ingest -> TSV only; a validated record -> forward only."""
    write_tsv = step.isin("classify", "classify_verify", "pre_ingest")
    forward = (step == "classify") | ((step == "validate") & (status == C.STATUS_VALIDATED))
    return write_tsv, forward


def resend_select(reqs: DataFrame, final: DataFrame, scores: DataFrame, key: str = "request_id") -> DataFrame:
    """Per request the selector bibcode > scix_id > run_id picks current
    final rows; three filtered branches, unioned."""
    sel = F.when(nonblank("bibcode").isNotNull(), "bibcode").when(nonblank("scix_id").isNotNull(), "scix_id") \
        .when(F.col("run_id").isNotNull(), "run_id")
    r = reqs.withColumn("_sel", sel)
    # only the final rows that a request names are reduced
    by_b = final.filter(nonblank("bibcode").isNotNull()).join(r.filter(F.col("_sel") == "bibcode").select("bibcode"), "bibcode", "left_semi")
    by_s = final.filter(nonblank("scix_id").isNotNull()).join(r.filter(F.col("_sel") == "scix_id").select("scix_id"), "scix_id", "left_semi")
    fb, fs = L.latest_per_key(by_b, "bibcode", ORDER), L.latest_per_key(by_s, "scix_id", ORDER)
    a = r.filter(F.col("_sel") == "bibcode").select(key, "bibcode").join(
        fb.select("bibcode", F.col("id").alias("final_id"), "collection", "scix_id"), "bibcode")
    b = r.filter(F.col("_sel") == "scix_id").select(key, "scix_id").join(
        fs.select("scix_id", F.col("id").alias("final_id"), "collection", "bibcode"), "scix_id")
    runs = r.filter(F.col("_sel") == "run_id").select(key, "run_id")
    sc = scores.select(F.col("id").alias("_sid"), F.col("run_id"), F.col("bibcode").alias("_sb"),
                       F.col("scix_id").alias("_ss"))
    c = runs.join(sc, "run_id").join(final, final["score_id"] == F.col("_sid")).select(
        key, F.col("id").alias("final_id"), "collection", "created",
        F.coalesce(nonblank("bibcode"), F.col("_sb")).alias("bibcode"),
        F.coalesce(nonblank("scix_id"), F.col("_ss")).alias("scix_id"))
    c = c.withColumn("_kk", record_key_kind()).withColumn("_kv", record_key_value())
    c = L.latest_per_key(c, [key, "_kk", "_kv"], ["created", "final_id"]).drop("_kk", "_kv", "created")
    cols = [key, "bibcode", "scix_id", "final_id", "collection"]
    return a.select(*cols).unionByName(b.select(*cols)).unionByName(c.select(*cols))
