"""Registered queries: one Spark plan per operator of the inventory plus the
equivalent DuckDB SQL used as the correctness oracle.

Every query reads the given tables (directly or through a ``v_*`` view that
Spark derives from them) in full.  Array outputs are flattened to strings
and doubles rounded to 6 places so two engines can be compared.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labelweave import config as C
from labelweave.functions import ids as I
from labelweave.functions import scores as S
from labelweave.operators import scoring as SC
from labelweave.operators.output import model_metadata, output_row, score_payload
from labelweave.plans import oracle as O
from labelweave.plans.views import duck_cte, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


def _scorer(spark: SparkSession):
    return SC.HashedLinearScorer(SC.default_weights(spark))


def _requests_split(spark, d):
    return I.split_identifier(view(spark, d, "v_requests"), "identifier")


# --------------------------------------------------------------------- B ----
@register("b01_identifier_kind", duck_cte("v_requests") + """
select input_index, identifier,
 case when length(identifier) <> 19 then null
      when regexp_matches(identifier, '^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$') then 'scix_id'
      else 'bibcode' end as kind
from v_requests""")
def b01(spark, d):
    return view(spark, d, "v_requests").select("input_index", "identifier",
                                               I.identifier_kind("identifier").alias("kind"))


@register("b13_collections", duck_cte("v_scored") + f"""
select input_index, array_to_string({O.collections_sql('scores')}, ', ') as collections,
 array_to_string(list_transform({O.collection_scores_sql('scores')}, lambda x: cast(x as varchar)), ', ')
   as collection_scores,
 len({O.collections_sql('scores')}) as n_collections
from v_scored""")
def b13(spark, d):
    v = view(spark, d, "v_scored")
    col = S.collections("scores")
    return v.select("input_index", S.join_list(col).alias("collections"),
                    S.join_list(S.collection_scores("scores")).alias("collection_scores"),
                    F.size(col).alias("n_collections"))


@register("b16_summary_scores", duck_cte("v_scored") + f"select input_index, {O.summary_sql('scores')} from v_scored")
def b16(spark, d):
    return view(spark, d, "v_scored").select("input_index", *S.summary_columns("scores"))


# --------------------------------------------------------------------- C ----
def _c13_sql(cover_tail: bool) -> str:
    return duck_cte("v_requests") + """, req as (select input_index, coalesce(title,'None') || ' ' ||
 coalesce(abstract,'None') as text from v_requests),""" + O.scores_ctes("req", cover_tail=cover_tail) + f"""
select input_index, {", ".join(f"round(scores[{i + 1}], 6) as s{i}" for i in range(8))},
 array_to_string({O.collections_sql('scores')}, ', ') as collections
from o_scores"""


_C13_SQL = _c13_sql(cover_tail=True)


@register("c13b_classify_parity", _c13_sql(cover_tail=False))
def c13b(spark, d):
    """The source's own window rule."""
    out = SC.classify(view(spark, d, "v_requests"), _scorer(spark), C.PARITY)
    return out.select("input_index", *[r6(F.get(F.col("scores"), i)).alias(f"s{i}") for i in range(8)],
                      S.join_list("collections").alias("collections"))


@register("c13_classify", _C13_SQL)
def c13(spark, d):
    out = SC.classify(view(spark, d, "v_requests"), _scorer(spark))
    return out.select("input_index", *[r6(F.get(F.col("scores"), i)).alias(f"s{i}") for i in range(8)],
                      S.join_list("collections").alias("collections"))


# --------------------------------------------------------------------- E ----
_E19_SQL = duck_cte("v_requests") + """, req as (select input_index, coalesce(title,'None') || ' ' ||
 coalesce(abstract,'None') as text from v_requests),""" + O.scores_ctes("req") + f""",
g as (select input_index, scores, {O.summary_sql('scores')} from o_scores)
select 'gross' as level, gross_collection as name, count(*) as n_records from g group by gross_collection
union all
select 'collection' as level, c as name, count(*) as n_records
from (select unnest({O.collections_sql('scores')}) as c from o_scores) x group by c"""


def collection_counts(classified: DataFrame) -> DataFrame:
    """Records per gross collection and per assigned collection, in one
    pass: each record emits its gross label and its collections, then one
    aggregate (partial counts combine map-side)."""
    tags = F.concat(F.array(F.struct(F.lit("gross").alias("level"), S.gross_collection("scores").alias("name"))),
                    F.transform("collections", lambda c: F.struct(F.lit("collection").alias("level"),
                                                                  c.alias("name"))))
    x = classified.select(F.explode(tags).alias("t")).select("t.level", "t.name")
    return x.groupBy("level", "name").agg(F.count(F.lit(1)).alias("n_records"))


@register("e19_collection_counts", _E19_SQL)
def e19(spark, d):
    return collection_counts(SC.classify(view(spark, d, "v_requests"), _scorer(spark)))


# ------------------------------------------------------------ B (more) ----
from labelweave.operators import requests as RQ  # noqa: E402

_REQ_IDS = """case when length(identifier) = 19 and not regexp_matches(identifier,
 '^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$') then identifier end as bibcode,
 case when length(identifier) = 19 and regexp_matches(identifier,
 '^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$') then identifier end as scix_id"""


@register("b02_split_identifier", duck_cte("v_requests") + f"select input_index, {_REQ_IDS} from v_requests")
def b02(spark, d):
    return _requests_split(spark, d).select("input_index", "bibcode", "scix_id")


@register("b03_record_key", duck_cte("v_scored") + """
select input_index, case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end as key_kind,
 case when coalesce(scix_id,'') <> '' then scix_id else bibcode end as key_value from v_scored""")
def b03(spark, d):
    v = view(spark, d, "v_scored")
    return v.select("input_index", I.record_key_kind().alias("key_kind"), I.record_key_value().alias("key_value"))


@register("b04_normalize_request", duck_cte("v_requests") + f"""
select input_index, bibcode, scix_id, coalesce(title,'None') as title, coalesce(abstract,'None') as abstract,
 coalesce(title,'None') || ' ' || coalesce(abstract,'None') as text, 'classify_verify' as operation_step,
 'tsv' as output_format from (select *, {_REQ_IDS} from v_requests) r""")
def b04(spark, d):
    r = RQ.normalize_requests(_requests_split(spark, d))
    return r.select("input_index", "bibcode", "scix_id", "title", "abstract", "text", "operation_step",
                    "output_format")


_B05_SRC = """(select input_index, batch_id,
 case when input_index % 7 = 0 then 'pre_ingest' when input_index % 5 = 0 then 'classify' end as operation_step,
 case when input_index % 3 = 0 then input_index * 10 end as run_id from v_requests)"""


@register("b05_batch_defaults", duck_cte("v_requests") + f"""
select input_index, batch_id,
 coalesce(first_value(operation_step) over w, 'classify_verify') as operation_step,
 coalesce(first_value(run_id) over w, 1000000 + batch_id) as run_id
from {_B05_SRC} s window w as (partition by batch_id order by input_index)""")
def b05(spark, d):
    v = view(spark, d, "v_requests").select(
        "input_index", "batch_id",
        F.when(F.col("input_index") % 7 == 0, "pre_ingest").when(F.col("input_index") % 5 == 0, "classify")
        .alias("operation_step"),
        F.when(F.col("input_index") % 3 == 0, F.col("input_index") * 10).alias("run_id"))
    return RQ.apply_batch_defaults(v, new_run=F.lit(1000000) + F.col("batch_id")).select(
        "input_index", "batch_id", "operation_step", "run_id")


_B06_SRC = """(select input_index, batch_id * 7 as run_id,
 case when input_index % 4 = 0 then 'pre_ingest' else 'classify' end as operation_step,
 case input_index % 5 when 0 then null when 1 then '/data/in/part_' || cast(input_index as varchar)
  when 2 then 'rel/dir/name' || cast(input_index % 13 as varchar) when 3 then '' else '/abs/' end as output_path
 from v_requests)"""


@register("b06_output_path", duck_cte("v_requests") + f"""
select input_index, case when operation_step = 'pre_ingest' and coalesce(output_path,'') <> ''
  and starts_with(output_path, '/') then output_path
 else '/home/app/logs/' || coalesce(nullif(string_split(coalesce(output_path,''), '/')[-1], ''), 'pre-ingest')
  || '_' || cast(run_id as varchar) || '_classified.tsv' end as output_path
from {_B06_SRC} s""")
def b06(spark, d):
    v = view(spark, d, "v_requests")
    i = F.col("input_index")
    src = v.select(
        "input_index", (F.col("batch_id") * 7).alias("run_id"),
        F.when(i % 4 == 0, "pre_ingest").otherwise("classify").alias("operation_step"),
        F.when(i % 5 == 0, F.lit(None)).when(i % 5 == 1, F.concat(F.lit("/data/in/part_"), i.cast("string")))
        .when(i % 5 == 2, F.concat(F.lit("rel/dir/name"), (i % 13).cast("string")))
        .when(i % 5 == 3, F.lit("")).otherwise(F.lit("/abs/")).alias("output_path"))
    return src.select("input_index", RQ.output_path("/home/app").alias("output_path"))


@register("b07_filter_fields", duck_cte("v_scored") + """
select bibcode, scix_id, input_index as run_id, 'ok' as status, len(scores) as n_scores from v_scored""")
def b07(spark, d):
    v = view(spark, d, "v_scored").withColumn("run_id", F.col("input_index")).withColumn("status", F.lit("ok"))
    out = RQ.select_allowed(v)
    return out.withColumn("n_scores", F.size("scores")).drop("scores")


_OVR_SQL = duck_cte("v_overrides") + """, ov as (select *, string_split(override_csv, ',') as override from v_overrides)
"""


@register("b08_split_override", _OVR_SQL + """
select doc_id, v, array_to_string(override, '|') as override, len(override) as n_parts from ov""")
def b08(spark, d):
    o = view(spark, d, "v_overrides").withColumn("override", RQ.split_override("override_csv"))
    return o.select("doc_id", "v", F.array_join("override", "|").alias("override"), F.size("override").alias("n_parts"))


_ALLOWED_LOWER = "[" + ", ".join("'" + x.lower() + "'" for x in C.LABELS) + "]"


@register("b09_is_allowed_category", _OVR_SQL + f"""
select doc_id, v, len(list_filter(override, lambda x: not list_contains({_ALLOWED_LOWER}, lower(x)))) = 0
 as is_allowed from ov""")
def b09(spark, d):
    o = view(spark, d, "v_overrides").withColumn("override", RQ.split_override("override_csv"))
    return o.select("doc_id", "v", RQ.is_allowed("override").alias("is_allowed"))


@register("b10_is_single_empty", _OVR_SQL + """
select doc_id, v, coalesce(len(override) = 1 and override[1] = '', false) as is_single_empty from ov""")
def b10(spark, d):
    o = view(spark, d, "v_overrides").withColumn("override", RQ.split_override("override_csv"))
    return o.select("doc_id", "v", RQ.is_single_empty("override").alias("is_single_empty"))


_WS = I.WHITESPACE_RUN


def _norm_sql(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, '{_WS}', ' ', 'g')), '')"


@register("b11_fingerprint", duck_cte("v_requests") + f"""
select input_index, sha256(case
 when coalesce(scix_id,'') <> '' then concat_ws('|', {_norm_sql("run_txt")}, 'scix_id', {_norm_sql("scix_id")})
 when coalesce(bibcode,'') <> '' then concat_ws('|', {_norm_sql("run_txt")}, 'bibcode', {_norm_sql("bibcode")})
 else concat_ws('|', {_norm_sql("run_txt")}, 'text', {_norm_sql("title")}, {_norm_sql("abstract")}) end)
 as fingerprint
from (select *, {_REQ_IDS}, case when batch_id = 0 then '' else cast(batch_id as varchar) end as run_txt
      from v_requests) r""")
def b11(spark, d):
    r = _requests_split(spark, d).withColumn("run_id", F.col("batch_id"))
    return r.select("input_index", I.fingerprint(r).alias("fingerprint"))


@register("b12_safe_score", duck_cte("v_scored") + "select input_index, " + ", ".join(
    f"coalesce(round(scores[{i + 1}], 2), 0.0) as x{i}" for i in range(10)) + " from v_scored")
def b12(spark, d):
    v = view(spark, d, "v_scored")
    return v.select("input_index", *[S.safe_score("scores", i).alias(f"x{i}") for i in range(10)])


@register("b14_python_round", duck_cte("v_scored") + "select input_index, " + ", ".join(
    f"round(s{i} * 3, 2) as r{i}, cast(printf('%.2f', doc_id::double / 1000 + {i}) as double) as e{i}"
    for i in range(8)) + " from v_scored")
def b14(spark, d):
    v = view(spark, d, "v_scored")
    cols = []
    for i in range(8):
        cols += [S.py_round(F.col(f"s{i}") * 3, 2).alias(f"r{i}"),
                 S.py_round(F.col("doc_id").cast("double") / 1000 + float(i)).alias(f"e{i}")]
    return v.select("input_index", *cols)


_RELABEL = dict(relabel_active=True, relabel_from="general", relabel_to="earthscience", relabel_threshold=0.55)


@register("b15_relabel_rule", duck_cte("v_scored") + f"""
, m as (select input_index, scores, list_transform(range(0, 8), lambda i: scores[i+1] > {O.THRESH_SQL}[i+1]) as meet
 from v_scored),
m2 as (select input_index, scores, case when coalesce(meet[7], false) and scores[4] > 0.55
  then list_transform(range(0, 8), lambda i: case when i = 3 then true when i = 6 then false else meet[i+1] end)
  else meet end as meet from m)
select input_index, array_to_string(list_transform(list_filter(range(0, 8), lambda i: meet[i+1]),
  lambda i: {O.LABELS_SQL}[i+1]), ', ') as collections from m2""")
def b15(spark, d):
    v = view(spark, d, "v_scored")
    return v.select("input_index", S.join_list(S.collections("scores", **_RELABEL)).alias("collections"))


@register("b17_output_row", duck_cte("v_scored", "v_requests") + f"""
select coalesce(s.bibcode, '') as bibcode, coalesce(s.scix_id, '') as scix_id,
 case when r.batch_id = 0 then '' else cast(r.batch_id as varchar) end as run_id,
 coalesce(r.title, '') as title, coalesce(r.abstract, '') as abstract,
 array_to_string({O.collections_sql('s.scores')}, ', ') as collections,
 array_to_string(list_transform({O.collection_scores_sql('s.scores')}, lambda x: cast(x as varchar)), ', ')
   as collection_scores,
 {O.summary_sql('s.scores')}, '' as gross_collection_override, '' as override
from v_scored s join v_requests r on r.input_index = s.input_index""")
def b17(spark, d):
    s = view(spark, d, "v_scored").withColumn("collections", S.collections("scores")).withColumn(
        "collection_scores", S.collection_scores("scores"))
    r = view(spark, d, "v_requests").select("input_index", F.col("batch_id").alias("run_id"), "title", "abstract")
    return output_row(s.join(r, "input_index"))


@register("b18_score_payload", duck_cte("v_scored") + f"""
select input_index, false as adjustment, array_to_string({O.collections_sql('scores')}, ', ') as collections,
 {", ".join(f"round(scores[{i + 1}], 6) as s{i}" for i in range(8))} from v_scored""")
def b18(spark, d):
    """The JSON payload, read back field by field."""
    s = view(spark, d, "v_scored").withColumn("collections", S.collections("scores"))
    p = F.from_json(score_payload(), "collections array<string>, earth_science_adjustment boolean, scores map<string,double>")
    back = s.select("input_index", p.alias("p"))
    return back.select("input_index", F.col("p.earth_science_adjustment").alias("adjustment"),
                       S.join_list("p.collections").alias("collections"),
                       *[r6(F.element_at("p.scores", x)).alias(f"s{i}") for i, x in enumerate(C.LABELS)])


@register("b19_model_metadata", duck_cte("v_scores") + f"""
select distinct run_id, to_json({{'model': 'hashed-linear', 'revision': 'v1', 'tokenizer': 'ascii-words-md5'}}) as model,
 to_json({{'earth_science_adjustment': false, 'earth_science_threshold': 0.015, 'thresholds': {O.THRESH_SQL}}})
 as postprocessing from v_scores""")
def b19(spark, d):
    m, p = model_metadata()
    return view(spark, d, "v_scores").select("run_id").distinct().select("run_id", m.alias("model"),
                                                                          p.alias("postprocessing"))


@register("b20_constant_scorer", duck_cte("v_requests") + f"""
select input_index, array_to_string({O.collections_sql('[0.5,0.5,0.5,0.5,0.5,0.5,0.5,0.5]')}, ', ') as collections
from v_requests""")
def b20(spark, d):
    v = view(spark, d, "v_requests").withColumn("scores", SC.constant_scores())
    return v.select("input_index", S.join_list(S.collections("scores")).alias("collections"))


_B21_SQL = duck_cte("v_requests") + """, req as (select input_index, coalesce(title,'None') || ' ' ||
 coalesce(abstract,'None') as text from v_requests where input_index % 2 <> 0),""" + O.scores_ctes("req") + f""",
allr as (select input_index, scores, false as fake from o_scores
 union all select input_index, [0.5,0.5,0.5,0.5,0.5,0.5,0.5,0.5], true from v_requests where input_index % 2 = 0)
select input_index, fake, array_to_string({O.collections_sql('scores')}, ', ') as collections from allr"""


@register("b21_route_scorer", _B21_SQL)
def b21(spark, d):
    v = view(spark, d, "v_requests").withColumn("fake_data", F.col("input_index") % 2 == 0)
    out = SC.route_scoring(v, _scorer(spark))
    return out.select("input_index", "fake", S.join_list("collections").alias("collections"))


@register("b22_score_by_label", duck_cte("v_scored") + f"""
select input_index, array_to_string(list_transform({O.collections_sql('scores')},
 lambda c: cast(round(scores[list_position({O.LABELS_SQL}, c)], 6) as varchar)), ', ') as label_scores
from v_scored""")
def b22(spark, d):
    s = view(spark, d, "v_scored").withColumn("collections", S.collections("scores"))
    return s.select("input_index", S.join_list(F.transform(S.scores_by_label("collections", "scores"),
                                                          lambda x: F.round(x, 6))).alias("label_scores"))


@register("b23_min_collection_score", duck_cte("v_scored") + f"""
select input_index, list_min(list_transform({O.collections_sql('scores')},
 lambda c: scores[list_position({O.LABELS_SQL}, c)])) as min_score from v_scored""")
def b23(spark, d):
    s = view(spark, d, "v_scored").withColumn("collections", S.collections("scores"))
    return s.select("input_index", S.min_collection_score("collections", "scores").alias("min_score"))


@register("b24_has_identifier", duck_cte("v_requests") + f"""
select input_index, coalesce(bibcode,'') <> '' or coalesce(scix_id,'') <> '' as has_identifier
from (select *, {_REQ_IDS} from v_requests) r""")
def b24(spark, d):
    return _requests_split(spark, d).select("input_index", I.has_identifier().alias("has_identifier"))


@register("b25_rate_per_minute", duck_cte("v_perf_events") + """
, r as (select run_id, count(*) filter (where stage = 'index') as indexed, max(ts) - min(ts) as wall
 from v_perf_events group by run_id),
b as (select indexed / wall * 60 as base_rate from r where run_id = '0')
select run_id, case when wall > 0 then indexed / wall * 60 end as records_per_minute,
 case when b.base_rate <> 0 then ((indexed / wall * 60) - b.base_rate) / b.base_rate * 100 end as pct_vs_run0
from r cross join b""")
def b25(spark, d):
    e = view(spark, d, "v_perf_events")
    r = e.groupBy("run_id").agg(F.count_if(F.col("stage") == "index").alias("indexed"),
                                (F.max("ts") - F.min("ts")).alias("wall"))
    r = r.withColumn("records_per_minute", S.per_minute("indexed", "wall"))
    base = r.filter(F.col("run_id") == "0").select(F.max("records_per_minute")).scalar()
    return r.select("run_id", "records_per_minute", S.pct_delta(F.col("records_per_minute"), base).alias(
        "pct_vs_run0"))


# --------------------------------------------------------------------- F ----
@register("f04_batch_ids", duck_cte("v_requests") + """
select input_index, (row_number() over (order by input_index desc) - 1) // 16 as batch_id from v_requests""")
def f04(spark, d):
    v = view(spark, d, "v_requests").select("input_index", (-F.col("input_index")).alias("neg"))
    return RQ.assign_batches(RQ.dense_index(v, ["neg"]), 16, "row_index").select("input_index", "batch_id")


@register("f05_restore_order", _C13_SQL.replace("select input_index, round(scores[1], 6) as s0",
                                                "select input_index, round(scores[1], 6) as s0", 1))
def f05(spark, d):
    v = view(spark, d, "v_requests").repartition(5)
    out = RQ.restore_order(SC.classify(v, _scorer(spark)))
    return out.select("input_index", *[r6(F.get(F.col("scores"), i)).alias(f"s{i}") for i in range(8)],
                      S.join_list("collections").alias("collections"))


@register("f06_sort_by_min_score", duck_cte("v_scored") + f"""
select input_index, list_min(list_transform({O.collections_sql('scores')},
 lambda c: scores[list_position({O.LABELS_SQL}, c)])) as min_score,
 row_number() over (order by list_min(list_transform({O.collections_sql('scores')},
 lambda c: scores[list_position({O.LABELS_SQL}, c)])) asc nulls last, input_index) as rank
from v_scored""")
def f06(spark, d):
    s = view(spark, d, "v_scored").withColumn("collections", S.collections("scores"))
    s = s.select("input_index", S.min_collection_score("collections", "scores").alias("min_score"))
    ordered = s.orderBy(F.col("min_score").asc_nulls_last(), "input_index")
    return RQ.dense_index(ordered.select("input_index", "min_score"),
                          [F.col("min_score").asc_nulls_last(), "input_index"], "rank0").select(
        "input_index", "min_score", (F.col("rank0") + 1).alias("rank"))


@register("f08_union_results", duck_cte("v_requests") + f"""
select input_index, bibcode, scix_id, 'indexed' as branch from (select *, {_REQ_IDS} from v_requests) r
 where coalesce(bibcode,'') <> '' or coalesce(scix_id,'') <> ''
union all
select input_index, null, null, 'anonymous' from (select *, {_REQ_IDS} from v_requests) r
 where not (coalesce(bibcode,'') <> '' or coalesce(scix_id,'') <> '')""")
def f08(spark, d):
    r = _requests_split(spark, d)
    a = r.filter(I.has_identifier()).select("input_index", "bibcode", "scix_id", F.lit("indexed").alias("branch"))
    b = r.filter(~I.has_identifier()).select("input_index", F.lit("anonymous").alias("branch"))
    return RQ.union_results(a, b).select("input_index", "bibcode", "scix_id", "branch")


# ------------------------------------------------------------ C (more) ----
from labelweave.functions import text as T  # noqa: E402
from labelweave.operators import windows as W  # noqa: E402
from labelweave.operators.layout import splits, spread_records  # noqa: E402
from labelweave.session import read_table  # noqa: E402


def _docs(spark, d):
    return spread_records(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id")


def _doc_ids(spark, d):
    return _docs(spark, d).select("doc_id", (F.col("doc_id") / 100).cast("bigint").alias("batch_id"),
                                  T.token_ids("text").alias("ids"))


def _prepared(spark, d):
    """C4..C6 with the token rows materialised (needed by C7 / C8)."""
    p = W.prepare_records(_doc_ids(spark, d), "ids", C.SCORING_WINDOW, C.SCORING_STRIDE)
    return W.assign_micro_batch(W.length_group(p, "batch_id", "doc_id"), C.MODEL_INFERENCE_BATCH_SIZE)


def _prepared_stats(spark, d):
    """C4..C6 from token counts only (closed form, no token arrays)."""
    n = _docs(spark, d).select("doc_id", (F.col("doc_id") / 100).cast("bigint").alias("batch_id"),
                               F.size(T.tokens("text")).alias("n_tokens"))
    p = W.prepare_stats(n, "n_tokens", C.SCORING_WINDOW, C.SCORING_STRIDE)
    return W.assign_micro_batch(W.length_group(p, "batch_id", "doc_id"), C.MODEL_INFERENCE_BATCH_SIZE)


@register("c01_tokenize", "with o_ids as (select doc_id, " + O.token_ids_sql("text") + """ as ids from documents)
select doc_id, len(ids) as n_tokens, array_to_string(ids, ' ') as token_ids from o_ids""")
def c01(spark, d):
    t = _doc_ids(spark, d)
    return t.select("doc_id", F.size("ids").alias("n_tokens"), F.array_join("ids", " ").alias("token_ids"))


@register("c02_window_split", "with " + O.prepared_ctes(C.SPLITTER_WINDOW, C.SPLITTER_STRIDE)
          + """
select doc_id, chunk - 1 as chunk, len(w) as n_ids, w[1] as first_id, w[-1] as last_id
from (select doc_id, unnest(wins) as w, generate_subscripts(wins, 1) as chunk from o_rows) x""")
def c02(spark, d):
    t = _doc_ids(spark, d)
    x = t.select("doc_id", F.posexplode(W.window_split("ids", C.SPLITTER_WINDOW, C.SPLITTER_STRIDE)).alias(
        "chunk", "w"))
    return x.select("doc_id", "chunk", F.size("w").alias("n_ids"), F.get(F.col("w"), 0).alias("first_id"),
                    F.try_element_at("w", F.lit(-1)).alias("last_id"))  # a text without words has an empty window


@register("c03_special_tokens", "with " + O.prepared_ctes() + """
select doc_id, chunk - 1 as chunk, len(r) as width, r[1] as first_tok, r[2] as second_tok, r[-1] as last_tok,
 len(list_filter(r, lambda x: x = 0)) as n_pad
from (select doc_id, unnest(rows) as r, generate_subscripts(rows, 1) as chunk from o_prep) x""")
def c03(spark, d):
    p = W.prepare_records(_doc_ids(spark, d), "ids", C.SCORING_WINDOW, C.SCORING_STRIDE)
    x = p.select("doc_id", F.posexplode("rows").alias("chunk", "r"))
    return x.select("doc_id", "chunk", F.size("r").alias("width"), F.get(F.col("r"), 0).alias("first_tok"),
                    F.get(F.col("r"), 1).alias("second_tok"), F.element_at("r", -1).alias("last_tok"),
                    F.size(F.filter("r", lambda v: v == 0)).alias("n_pad"))


@register("c04_prepare_record_stats", "with " + O.prepared_ctes() + """
select doc_id, chunk_count, max_row_width, total_row_tokens from o_stats""")
def c04(spark, d):
    return _prepared_stats(spark, d).select("doc_id", "chunk_count", "max_row_width", "total_row_tokens")


@register("c05_length_group", "with " + O.prepared_ctes() + "select doc_id, batch_id, group_rank from o_rank")
def c05(spark, d):
    return _prepared_stats(spark, d).select("doc_id", "batch_id", "group_rank")


@register("c06_micro_batch", "with " + O.prepared_ctes() + "select doc_id, batch_id, micro_batch from o_mb")
def c06(spark, d):
    return _prepared_stats(spark, d).select("doc_id", "batch_id", "micro_batch")


@register("c07_pad_and_mask", "with " + O.prepared_ctes() + """
select doc_id, max(max_row_width) over (partition by batch_id, micro_batch) as mb_width,
 active_tokens as mask_ones, chunk_count * max(max_row_width) over (partition by batch_id, micro_batch) as padded_len
from o_mb""")
def c07(spark, d):
    p = W.pad_and_mask(_prepared(spark, d))
    ones = F.aggregate(F.transform("attention_mask", lambda m: F.aggregate(m, F.lit(0), lambda a, b: a + b)),
                       F.lit(0).cast("bigint"), lambda a, b: a + b)
    plen = F.aggregate(F.transform("padded_rows", lambda r: F.size(r)), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return p.select("doc_id", F.col("mb_width").cast("bigint").alias("mb_width"), ones.alias("mask_ones"),
                    plen.alias("padded_len"))


@register("c08_tensor_shape", "with " + O.prepared_ctes() + """
, m as (select batch_id, micro_batch, sum(chunk_count) as row_count, max(max_row_width) as col_count,
 sum(active_tokens) as active_token_count from o_mb group by all)
select batch_id, micro_batch, row_count, col_count, active_token_count,
 row_count * col_count - active_token_count as pad_token_count,
 case when row_count * col_count > 0 then (row_count * col_count - active_token_count) / (row_count * col_count)
  else 0.0 end as pad_ratio from m""")
def c08(spark, d):
    t = W.tensor_shape(W.pad_and_mask(_prepared(spark, d)))
    return t.select("batch_id", "micro_batch", "row_count", "col_count", "active_token_count", "pad_token_count",
                    r6(F.col("pad_ratio")).alias("pad_ratio"))


_C09_COLS = ", ".join(f"cast({m} as double) as {m}" for m in W.SHAPE_METRICS)


@register("c09_batch_shape_metrics", "with " + O.prepared_ctes() + f"""
, mb as (select batch_id, micro_batch, count(*) as mb_records, sum(chunk_count) as mb_rows,
  max(max_row_width) as mb_cols, max(max_row_width) - min(max_row_width) as mb_span,
  sum(total_row_tokens) as mb_tokens from o_mb group by all),
mb2 as (select *, mb_cols * mb_rows - mb_tokens as mb_pad,
  case when mb_cols * mb_rows > 0 then (mb_cols * mb_rows - mb_tokens) / (mb_cols * mb_rows) else 0.0 end as mb_ratio
  from mb),
a as (select batch_id, count(*) as micro_batch_count, max(mb_records) as max_micro_batch_records,
  avg(mb_records) as mean_micro_batch_records, max(mb_rows) as max_micro_batch_rows,
  avg(mb_rows) as mean_micro_batch_rows, avg(mb_cols) as mean_micro_batch_padded_cols,
  max(mb_cols) as max_micro_batch_padded_cols, avg(mb_span) as mean_micro_batch_width_span,
  max(mb_span) as max_micro_batch_width_span, avg(mb_tokens) as mean_micro_batch_token_count,
  max(mb_tokens) as max_micro_batch_token_count, avg(mb_pad) as mean_micro_batch_pad_tokens,
  max(mb_pad) as max_micro_batch_pad_tokens, avg(mb_ratio) as mean_micro_batch_pad_ratio,
  max(mb_ratio) as max_micro_batch_pad_ratio from mb2 group by batch_id),
r as (select batch_id, count(*) as configured_record_batch_size, 16 as model_inference_batch_size,
  sum(chunk_count) as effective_chunk_batch_size, sum(chunk_count) as total_chunks,
  avg(chunk_count) as mean_chunks_per_record, max(chunk_count) as max_chunks_per_record,
  max(len(ids)) as max_tokenized_length, max(chunk_count) as padded_tensor_rows,
  max(len(rows[1])) as padded_tensor_cols, 1 as grouping_applied,
  avg(max_row_width) as mean_grouped_record_width, max(max_row_width) as max_grouped_record_width,
  1 as attention_mask_applied from o_mb group by batch_id),
wide as (select r.batch_id, {_C09_COLS} from r join a using (batch_id))
select batch_id, name, round(value, 6) as value from (unpivot wide on {", ".join(W.SHAPE_METRICS)}
 into name name value value) u""")
def c09(spark, d):
    m = W.batch_shape_metrics(_prepared_stats(spark, d), "batch_id", C.MODEL_INFERENCE_BATCH_SIZE)
    return m.select("batch_id", "name", r6(F.col("value")).alias("value"))


_DOC_TEXT = "with req as (select doc_id as input_index, text from documents),"


@register("c10_score_chunks", _DOC_TEXT + O.scores_ctes("req") + """
select input_index as doc_id, chunk, """ + ", ".join(
    f"round(max(p) filter (where label = {i}), 6) as p{i}" for i in range(8)) + """
from o_probs group by all""")
def c10(spark, d):
    docs = read_table(spark, d, "documents").select(F.col("doc_id"), T.token_ids("text").alias("ids"))
    chunks = SC.explode_windows(docs, ["doc_id"], "ids")
    probs = _scorer(spark).score_windows(chunks, ["doc_id"])
    return probs.select("doc_id", "chunk", *[r6(F.get(F.col("probs"), i)).alias(f"p{i}") for i in range(8)])


def _doc_scores_sql(pooling: str = "max") -> str:
    return _DOC_TEXT + O.scores_ctes("req", pooling=pooling)


@register("c11_pool_scores", _doc_scores_sql("mean") + "select input_index as doc_id, " + ", ".join(
    f"round(scores[{i + 1}], 6) as s{i}" for i in range(8)) + " from o_scores")
def c11(spark, d):
    docs = read_table(spark, d, "documents").select(F.col("doc_id").alias("input_index"), "text")
    cfg = C.ClassifierConfig(pooling="mean")
    out = SC.score_records(docs, ["input_index"], _scorer(spark), "text", cfg)
    return out.select(F.col("input_index").alias("doc_id"),
                      *[r6(F.get(F.col("scores"), i)).alias(f"s{i}") for i in range(8)])


@register("c12_select_labels", _doc_scores_sql() + f"""
select input_index as doc_id, array_to_string(list_transform(list_filter(range(0, 8),
 lambda i: scores[i+1] >= 0.3), lambda i: {O.LABELS_SQL}[i+1]), ', ') as categories from o_scores""")
def c12(spark, d):
    docs = read_table(spark, d, "documents").select(F.col("doc_id").alias("input_index"), "text")
    out = SC.score_records(docs, ["input_index"], _scorer(spark), "text")
    return out.select(F.col("input_index").alias("doc_id"),
                      S.join_list(SC.select_labels("scores", C.LABELS, [0.3] * 8)).alias("categories"))


@register("c14_classify_batch_counts", duck_cte("v_requests") + """
select batch_id, count(*) as record_count, count(*) filter (where input_index % 3 <> 0) as real_count,
 count(*) filter (where input_index % 3 = 0) as fake_count, 'ok' as status from v_requests group by batch_id""")
def c14(spark, d):
    v = view(spark, d, "v_requests").withColumn("fake_data", F.col("input_index") % 3 == 0)
    routed = SC.route_scoring(v, _scorer(spark), carry=("batch_id",))
    return SC.classify_counts(routed, "batch_id")


def _blend(block):
    return 0.5 * block.mean(axis=0) + 0.5 * block.max(axis=0)


@register("i01_custom_combiner", _DOC_TEXT + O.scores_ctes("req") + """
, b as (select input_index, label, 0.5 * avg(p) + 0.5 * max(p) as s from o_probs group by all)
select input_index as doc_id, """ + ", ".join(
    f"round(max(s) filter (where label = {i}), 6) as s{i}" for i in range(8)) + " from b group by input_index")
def i01(spark, d):
    docs = read_table(spark, d, "documents").select(F.col("doc_id").alias("input_index"), "text")
    cfg = C.ClassifierConfig(pooling=_blend)
    out = SC.score_records(docs, ["input_index"], _scorer(spark), "text", cfg)
    return out.select(F.col("input_index").alias("doc_id"),
                      *[r6(F.get(F.col("scores"), i)).alias(f"s{i}") for i in range(8)])


def numpy_linear_model():
    """A plug-in model for I2: the hashed linear model evaluated with numpy
    (stands in for any transformer behind the same interface)."""
    import numpy as np

    b = np.arange(C.N_BUCKETS)[:, None]
    lab = np.arange(len(C.LABELS))[None, :]
    wts = (((b * (2 * lab + 3) + 7 * lab) % 199) - 99) / 99.0
    bias = np.array(C.MODEL_BIAS)

    def model(windows):
        out = []
        for w in windows:
            ids = np.asarray(w, dtype=np.int64) % C.N_BUCKETS
            mean = wts[ids].sum(axis=0) / max(len(ids), 1)
            out.append((1.0 / (1.0 + np.exp(-(bias + C.MODEL_SCALE * mean)))).tolist())
        return out
    return model


@register("i02_scorer_plugin", _C13_SQL)
def i02(spark, d):
    out = SC.classify(view(spark, d, "v_requests"), SC.PandasScorer(numpy_linear_model))
    return out.select("input_index", *[r6(F.get(F.col("scores"), i)).alias(f"s{i}") for i in range(8)],
                      S.join_list("collections").alias("collections"))


@register("i03_window_udtf", "with " + O.prepared_ctes(C.SPLITTER_WINDOW, C.SPLITTER_STRIDE) + """
select doc_id, chunk - 1 as chunk, len(w) as n_ids, list_sum(w) as id_sum
from (select doc_id, unnest(wins) as w, generate_subscripts(wins, 1) as chunk from o_rows) x""")
def i03(spark, d):
    from labelweave.plans.sql_functions import register_sql_functions
    register_sql_functions(spark)
    docs = read_table(spark, d, "documents")
    return spark.sql(f"""
        SELECT t.doc_id, w.chunk, size(w.window) AS n_ids,
               aggregate(w.window, 0L, (a, b) -> a + b) AS id_sum
        FROM (SELECT doc_id, lw_token_ids(text) AS ids FROM {{docs}}) t,
             LATERAL lw_windows(t.ids, {C.SPLITTER_WINDOW}, {C.SPLITTER_STRIDE}) w""", docs=docs)


# ----------------------------------------------------- D / F / G (state) ----
from labelweave.operators import latest as L  # noqa: E402
from labelweave.operators import state as ST  # noqa: E402
from labelweave.plans.views import NOW_S  # noqa: E402


def _ts(c):
    return F.timestamp_seconds(F.col(c))


def _epoch(c):
    return F.unix_seconds(F.col(c) if isinstance(c, str) else c)


def _coll_seed():
    return F.split(F.when(F.col("doc_id") % 3 == 0, "astrophysics").when(F.col("doc_id") % 3 == 1, "general,physics")
                   .otherwise(""), ",")


def fixture_state(spark, d) -> ST.State:
    """Score / override / final tables derived from the fixture views."""
    ov = view(spark, d, "v_overrides").select(
        (F.col("doc_id") * 2 + F.col("v")).cast("long").alias("id"), "bibcode", "scix_id",
        F.split("override_csv", ",", -1).alias("override"), _ts("created_s").alias("created"), "doc_id")
    sc = view(spark, d, "v_scores").select(
        F.col("id").cast("long").alias("id"), "bibcode", "scix_id", F.col("payload").alias("scores"),
        _ts("created_s").alias("created"), F.col("overrides_id").cast("long").alias("overrides_id"),
        F.col("run_id").cast("long").alias("run_id"))
    fc = view(spark, d, "v_final").select(
        F.col("id").cast("long").alias("id"), "bibcode", "scix_id", F.col("score_id").cast("long").alias("score_id"),
        _coll_seed().alias("collection"), "validated", _ts("validated_at_s").alias("validated_at"),
        _ts("created_s").alias("created"), "doc_id")
    return ST.State(ov.drop("doc_id"), sc, fc.drop("doc_id")), ov, fc


def fixture_records(spark, d):
    v = view(spark, d, "v_scored")
    return v.select("input_index", "bibcode", "scix_id", S.collections("scores").alias("collections"),
                    (F.col("input_index") % 3).cast("long").alias("run_id"),
                    F.concat(F.lit("p"), (F.col("doc_id") % 50).cast("string")).alias("payload"))


def _now():
    return F.timestamp_seconds(F.lit(NOW_S))

_ST_SQL = duck_cte("v_overrides", "v_scores", "v_final", "v_scored") + f""",
st_ov as (select doc_id*2+v as id, doc_id, bibcode, scix_id, string_split(override_csv, ',') as override,
  created_s as created from v_overrides),
st_sc as (select id, bibcode, scix_id, payload as scores, created_s as created, overrides_id, run_id from v_scores),
st_fc as (select id, doc_id, bibcode, scix_id, score_id, string_split(case doc_id % 3 when 0 then 'astrophysics'
  when 1 then 'general,physics' else '' end, ',') as collection, validated, validated_at_s as validated_at,
  created_s as created from v_final),
recs as (select input_index, bibcode, scix_id, {O.collections_sql('scores')} as collections,
  input_index % 3 as run_id, 'p' || cast(doc_id % 50 as varchar) as payload from v_scored),
ov_s as (select * from st_ov where coalesce(scix_id,'') <> ''
  qualify row_number() over (partition by scix_id order by created desc, id desc) = 1),
ov_b as (select * from st_ov where coalesce(bibcode,'') <> ''
  qualify row_number() over (partition by bibcode order by created desc, id desc) = 1),
d1 as (select r.*, coalesce(s.id, b.id) as overrides_id,
  case when s.id is not null then s.override when b.id is not null then b.override else r.collections end
  as final_collections
  from recs r left join ov_s s on s.scix_id = nullif(r.scix_id,'') left join ov_b b on b.bibcode = nullif(r.bibcode,'')),
sc_k as (select *, case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end as kk,
  case when coalesce(scix_id,'') <> '' then scix_id else bibcode end as kv from st_sc
  qualify row_number() over (partition by kk, kv, scores, overrides_id, run_id order by created desc, id desc) = 1),
d3 as (select d1.*, s.id as existing_score_id from d1 left join sc_k s
  on s.kk = case when coalesce(d1.scix_id,'') <> '' then 'scix_id' else 'bibcode' end
  and s.kv = case when coalesce(d1.scix_id,'') <> '' then d1.scix_id else d1.bibcode end
  and s.scores = d1.payload and s.overrides_id is not distinct from d1.overrides_id and s.run_id = d1.run_id),
fc_s as (select * from st_fc where coalesce(scix_id,'') <> ''
  qualify row_number() over (partition by scix_id order by created desc, id desc) = 1),
fc_b as (select * from st_fc where coalesce(bibcode,'') <> ''
  qualify row_number() over (partition by bibcode order by created desc, id desc) = 1),
d5 as (select r.input_index, coalesce(s.id, b.id) as fc_id from recs r
  left join fc_s s on s.scix_id = nullif(r.scix_id,'') left join fc_b b on b.bibcode = nullif(r.bibcode,''))
"""


@register("f01_latest_per_key", _ST_SQL + """
select doc_id, id, array_to_string(override, '|') as override from st_ov
qualify row_number() over (partition by doc_id order by created desc, id desc) = 1""")
def f01(spark, d):
    _, ov, _ = fixture_state(spark, d)
    return L.latest_per_key(ov, "doc_id", ST.ORDER).select("doc_id", "id", F.array_join("override", "|").alias(
        "override"))


@register("f02_recently_validated", _ST_SQL + f"""
select bibcode, scix_id, score_id, validated_at from st_fc
where validated and validated_at is not null and validated_at >= {NOW_S} - 7*86400
qualify row_number() over (partition by case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end,
  case when coalesce(scix_id,'') <> '' then scix_id else bibcode end order by validated_at desc, created desc,
  id desc) = 1""")
def f02(spark, d):
    st, _, _ = fixture_state(spark, d)
    r = ST.recently_validated(st.final, 7, _now())
    return r.select("bibcode", "scix_id", "score_id", _epoch("validated_at").alias("validated_at"))


@register("f03_dedupe_result_key", _ST_SQL + """
select case when coalesce(scix_id,'') <> '' then scix_id else bibcode end as result_key, id from st_fc
qualify row_number() over (partition by case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end,
  case when coalesce(scix_id,'') <> '' then scix_id else bibcode end order by created desc, id desc) = 1""")
def f03(spark, d):
    st, _, _ = fixture_state(spark, d)
    r = L.dedupe_results(st.final, ["created", "id"])
    return r.select(I.record_key_value().alias("result_key"), "id")


@register("f07_new_run_ids", duck_cte("v_scores", "v_requests") + """
select batch_id, (select max(run_id) from v_scores) + row_number() over (order by batch_id) as id
from (select distinct batch_id from v_requests) b""")
def f07(spark, d):
    runs = view(spark, d, "v_scores").select(F.col("run_id").cast("long").alias("id")).distinct()
    out = L.new_runs(spark, runs, view(spark, d, "v_requests"), "batch_id", _now())
    return out.select("batch_id", "id")


@register("f09_surrogate_ids", duck_cte("v_scores", "v_scored") + """
select input_index, (select max(id) from v_scores) + row_number() over (order by input_index) as id from v_scored""")
def f09(spark, d):
    base = L.max_id(view(spark, d, "v_scores"))
    return L.with_surrogate_ids(view(spark, d, "v_scored").select("input_index"), base, ["input_index"], "id")


@register("d01_resolve_override", _ST_SQL + """
select input_index, overrides_id, array_to_string(final_collections, '|') as final_collections from d1""")
def d01(spark, d):
    st, _, _ = fixture_state(spark, d)
    r = ST.resolve_override(fixture_records(spark, d), st.overrides, "batch")
    return r.select("input_index", "overrides_id", F.array_join("final_collections", "|").alias("final_collections"))


@register("d02_resolve_override_newest", _ST_SQL + """
, m as (select r.input_index, o.id, o.created, o.override from recs r join st_ov o on o.scix_id = nullif(r.scix_id,'')
  union select r.input_index, o.id, o.created, o.override from recs r join st_ov o on o.bibcode = nullif(r.bibcode,'')),
best as (select * from m qualify row_number() over (partition by input_index order by created desc, id desc) = 1)
select r.input_index, b.id as overrides_id,
 array_to_string(case when b.id is not null then b.override else r.collections end, '|') as final_collections
from recs r left join best b using (input_index)""")
def d02(spark, d):
    st, _, _ = fixture_state(spark, d)
    r = ST.resolve_override(fixture_records(spark, d), st.overrides, "newest")
    return r.select("input_index", "overrides_id", F.array_join("final_collections", "|").alias("final_collections"))


@register("d03_match_scores", _ST_SQL + """
select input_index, existing_score_id, existing_score_id is null as is_new from d3""")
def d03(spark, d):
    st, _, _ = fixture_state(spark, d)
    r = ST.match_scores(ST.resolve_override(fixture_records(spark, d), st.overrides), st.scores)
    return r.select("input_index", "existing_score_id", F.col("existing_score_id").isNull().alias("is_new"))


_D04_SQL = duck_cte("v_scores", "v_scored") + """,
models as (select distinct run_id + 1 as id, 'm' || cast(run_id as varchar) as model, 'p' as postprocessing,
  run_id as created from v_scores),
runs as (select distinct run_id as id, run_id as model_id from v_scores),
want as (select * from (values ('found', 'm1'), ('created', 'm9')) t(variant, model)),
mid as (select w.variant, coalesce((select max(id) from models m where m.model = w.model and m.postprocessing = 'p'),
  (select max(id) from models) + 1) as model_id from want w),
batch_runs as (select distinct input_index % 5 as run_id from v_scored)
select w.variant, r.id as run_id, case when r.id in (select run_id from batch_runs) then w.model_id
 else r.model_id end as model_id from runs r cross join mid w"""


@register("d04_get_or_create_model", _D04_SQL)
def d04(spark, d):
    sc = view(spark, d, "v_scores")
    models = sc.select((F.col("run_id") + 1).cast("long").alias("id"),
                       F.concat(F.lit("m"), F.col("run_id").cast("string")).alias("model"),
                       F.lit("p").alias("postprocessing"), F.col("run_id").cast("long").alias("created")).distinct()
    runs = sc.select(F.col("run_id").cast("long").alias("id"), F.col("run_id").cast("long").alias("model_id")).distinct()
    batch_runs = view(spark, d, "v_scored").select((F.col("input_index") % 5).alias("run_id"))
    outs = []
    for variant, name in (("found", "m1"), ("created", "m9")):
        _, runs2, _ = ST.get_or_create_model(models, runs, F.lit(name), F.lit("p"), batch_runs, F.lit(0).cast("long"))
        outs.append(runs2.select(F.lit(variant).alias("variant"), F.col("id").alias("run_id"), "model_id"))
    return outs[0].unionByName(outs[1])


@register("d05_match_final", _ST_SQL + """
select input_index, fc_id, case when fc_id is null then 'insert' else 'update' end as action from d5""")
def d05(spark, d):
    st, _, _ = fixture_state(spark, d)
    r = L.resolve_by_either_id(fixture_records(spark, d), st.final, ST.ORDER, "fc_")
    return r.select("input_index", "fc_id", F.when(F.col("fc_id").isNull(), "insert").otherwise("update").alias(
        "action"))


_D06_SQL = _ST_SQL + """
, j as (select f.id, f.created, f.collection, coalesce(nullif(f.bibcode,''), s.bibcode) as bibcode,
  coalesce(nullif(f.scix_id,''), s.scix_id) as scix_id from st_fc f join st_sc s on f.score_id = s.id where s.run_id = 1)
select bibcode, scix_id, id, array_to_string(collection, '|') as collection from j
qualify row_number() over (partition by case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end,
  case when coalesce(scix_id,'') <> '' then scix_id else bibcode end order by created desc, id desc) = 1"""


@register("d06_run_results", _D06_SQL)
def d06(spark, d):
    st, _, _ = fixture_state(spark, d)
    r = ST.run_results(st.final, st.scores, 1)
    return r.select("bibcode", "scix_id", "id", F.array_join("collection", "|").alias("collection"))


@register("d07_bulk_lookup", duck_cte("v_requests", "v_scores") + """
select distinct s.id from v_scores s where s.bibcode in (select identifier from v_requests)
 or s.scix_id in (select identifier from v_requests)""")
def d07(spark, d):
    cat = view(spark, d, "v_scores")
    return ST.bulk_lookup(view(spark, d, "v_requests"), cat).select("id")


@register("d08_lookup_missing", duck_cte("v_requests", "v_scores") + """
select identifier from v_requests where identifier not in (select bibcode from v_scores where bibcode is not null)
 and identifier not in (select scix_id from v_scores where scix_id is not null)""")
def d08(spark, d):
    cat = view(spark, d, "v_scores")
    return ST.lookup_missing(view(spark, d, "v_requests").select("identifier"), cat)


@register("d11_lookup_by_id", duck_cte("v_requests", "v_final") + """
, f as (select id, bibcode, scix_id, created_s as created from v_final)
select bibcode, id, scix_id from f where bibcode in (select identifier from v_requests)
qualify row_number() over (partition by bibcode order by created desc, id desc) = 1""")
def d11(spark, d):
    st, _, _ = fixture_state(spark, d)
    return ST.lookup_by_id(st.final, view(spark, d, "v_requests")).select("bibcode", "id", "scix_id")


_G_SQL = _ST_SQL + """,
newsc as (select input_index, (select max(id) from st_sc) + row_number() over (order by input_index) as new_score_id
  from d3 where existing_score_id is null),
g as (select d3.*, coalesce(existing_score_id, n.new_score_id) as score_id, n.new_score_id is not null as new_score
  from d3 left join newsc n using (input_index)),
newfc as (select input_index, (select max(id) from st_fc) + row_number() over (order by input_index) as new_final_id
  from d5 where fc_id is null),
gres as (select g.input_index, g.overrides_id, g.score_id, coalesce(d5.fc_id, nf.new_final_id) as final_id,
  g.new_score, d5.fc_id is not null as final_updated, array_to_string(g.final_collections, '|') as final_collections
  from g join d5 using (input_index) left join newfc nf using (input_index))
"""


def _g01_results(spark, d, mode="batch"):
    st, _, _ = fixture_state(spark, d)
    return ST.index_batch(st, fixture_records(spark, d), _now(), "payload", mode)[1]


@register("g01_index_batch", _G_SQL + "select * from gres")
def g01(spark, d):
    res = _g01_results(spark, d)
    return res.select("input_index", "overrides_id", "score_id", "final_id", "new_score", "final_updated",
                      F.array_join("final_collections", "|").alias("final_collections"))


@register("g01b_index_tables", _G_SQL + """
, upd as (select final_id as id, score_id, final_collections from gres where final_updated
  qualify row_number() over (partition by final_id order by input_index desc) = 1)
select 'final' as kind, f.id, coalesce(u.score_id, f.score_id) as ref,
 coalesce(u.final_collections, array_to_string(f.collection, '|')) as val from st_fc f left join upd u on u.id = f.id
union all select 'final', final_id, score_id, final_collections from gres where not final_updated
union all select 'score', id, run_id, scores from st_sc
union all select 'score', g.score_id, r.run_id, r.payload from gres g join recs r using (input_index) where g.new_score""")
def g01b(spark, d):
    st, _, _ = fixture_state(spark, d)
    changes, _ = ST.index_batch(st, fixture_records(spark, d), _now())
    st2 = st.apply(changes)
    return st2.final.select(F.lit("final").alias("kind"), "id", F.col("score_id").alias("ref"),
                            F.array_join("collection", "|").alias("val")).unionByName(
        st2.scores.select(F.lit("score").alias("kind"), "id", F.col("run_id").alias("ref"), F.col("scores").alias("val")))


_D2_CTE = """d1 as (select r.*, b.id as overrides_id,
  case when b.id is not null then b.override else r.collections end as final_collections from recs r left join
  (select * from (select r.input_index, o.id, o.created, o.override from recs r join st_ov o
     on o.scix_id = nullif(r.scix_id,'')
   union select r.input_index, o.id, o.created, o.override from recs r join st_ov o on o.bibcode = nullif(r.bibcode,''))
   qualify row_number() over (partition by input_index order by created desc, id desc) = 1) b using (input_index)),"""


_G2_LOOKUPS = """d3 as (select d1.*, m.id as existing_score_id from d1 left join (
  select d1.input_index, s.id from d1 join st_sc s on (s.scix_id = nullif(d1.scix_id,'') or s.bibcode = nullif(d1.bibcode,''))
   and s.scores = d1.payload and s.overrides_id is not distinct from d1.overrides_id and s.run_id = d1.run_id
  qualify row_number() over (partition by d1.input_index order by s.created desc, s.id desc) = 1) m using (input_index)),
d5 as (select r.input_index, m.id as fc_id from recs r left join (
  select r.input_index, f.id from recs r join st_fc f on f.scix_id = nullif(r.scix_id,'') or f.bibcode = nullif(r.bibcode,'')
  qualify row_number() over (partition by r.input_index order by f.created desc, f.id desc) = 1) m using (input_index)),
"""


def _single_record_rule(sql: str) -> str:
    """The batch SQL with every lookup replaced by 'newest of either id'."""
    return sql[:sql.index("d1 as (")] + _D2_CTE + _G2_LOOKUPS + sql[sql.index("newsc as ("):]


@register("g02_index_record_single", _single_record_rule(_G_SQL) + "select * from gres")
def g02(spark, d):
    res = _g01_results(spark, d, "newest")
    return res.select("input_index", "overrides_id", "score_id", "final_id", "new_score", "final_updated",
                      F.array_join("final_collections", "|").alias("final_collections"))


_E16_SQL = _G_SQL + """
select count(*) as record_count, count(*) filter (where new_score) as new_score_rows,
 count(*) filter (where not new_score) as reused_score_rows, count(*) filter (where not final_updated)
 as new_final_rows, count(*) filter (where final_updated) as updated_final_rows from gres"""


@register("e16_index_counters", _E16_SQL)
def e16(spark, d):
    return ST.index_counters(_g01_results(spark, d))


@register("e16b_observed_counters", _E16_SQL)
def e16b(spark, d):
    """The counters as the write of the indexed batch saw them."""
    st, _, _ = fixture_state(spark, d)
    counted = Observation("e16b")
    ST.index_batch(st, fixture_records(spark, d), _now(), observe=counted)
    return ST.observed_counters(spark, counted)


def fixture_validations(spark, d):
    v = view(spark, d, "v_scored")
    i = F.col("input_index") % 16
    ov = F.when(i == 0, "").when(i == 4, "Astrophysics,physics").when(i == 8, "Nope").otherwise("general")
    return v.select("input_index", "bibcode", "scix_id", F.split(ov, ",", -1).alias("override"))


_V_SQL = _ST_SQL + f""",
reqs as (select input_index, bibcode, scix_id, string_split(case input_index % 16 when 0 then '' when 4 then
  'Astrophysics,physics' when 8 then 'Nope' else 'general' end, ',') as override from v_scored),
ovm as (select r.input_index, o.id, o.override from reqs r join st_ov o on o.scix_id = nullif(r.scix_id,'')
  union select r.input_index, o.id, o.override from reqs r join st_ov o on o.bibcode = nullif(r.bibcode,'')),
same as (select distinct m.input_index from ovm m join reqs r using (input_index) where m.override = r.override),
fcm as (select r.input_index, f.id, f.created, f.validated from reqs r join st_fc f on f.scix_id = nullif(r.scix_id,'')
  union select r.input_index, f.id, f.created, f.validated from reqs r join st_fc f on f.bibcode = nullif(r.bibcode,'')),
newest as (select input_index, id as newest_id from fcm
  qualify row_number() over (partition by input_index order by created desc, id desc) = 1),
unval as (select input_index, id as unval_id from fcm where not validated
  qualify row_number() over (partition by input_index order by created desc, id desc) = 1),
hasval as (select distinct input_index from fcm where validated),
x as (select r.*, s.input_index is not null as same, n.newest_id, u.unval_id, h.input_index is not null as has_val,
  len(list_filter(r.override, lambda z: not list_contains({_ALLOWED_LOWER}, lower(z)))) = 0 as allowed,
  coalesce(len(r.override) = 1 and r.override[1] = '', false) as empty
  from reqs r left join same s using (input_index) left join newest n using (input_index)
  left join unval u using (input_index) left join hasval h using (input_index)),
b as (select *, case when not same and allowed then 'override' when not same and empty then 'as_is'
  when same then 'identical' else 'disallowed' end as branch from x),
newov as (select input_index, (select max(id) from st_ov) + row_number() over (order by input_index) as new_ov_id
  from b where branch = 'override'),
ch as (select newest_id as id, override as coll from b where branch = 'override' and newest_id is not null
  union all select unval_id, null from b where branch = 'as_is' and unval_id is not null and not has_val
  union all select unval_id, null from b where branch = 'as_is' and unval_id is not null and has_val)
"""


def _validated(spark, d):
    st, _, _ = fixture_state(spark, d)
    return ST.validate(st, fixture_validations(spark, d), _now())


@register("g03_validate_with_override", _V_SQL + """
, scm as (select s.id, n.new_ov_id from newov n join reqs r using (input_index) join st_sc s
  on s.scix_id = nullif(r.scix_id,'') union select s.id, n.new_ov_id from newov n join reqs r using (input_index)
  join st_sc s on s.bibcode = nullif(r.bibcode,''))
select 'score' as kind, s.id, coalesce(m.new_ov_id, s.overrides_id) as ref, null as val from st_sc s
 left join scm m on m.id = s.id
union all select 'override', n.new_ov_id, null, array_to_string(r.override, '|') from newov n join reqs r
 using (input_index)""")
def g03(spark, d):
    st, _, _ = fixture_state(spark, d)
    changes, _ = _validated(spark, d)
    st2 = st.apply(changes)
    sc = st2.scores.select(F.lit("score").alias("kind"), "id", F.col("overrides_id").alias("ref"),
                           F.lit(None).cast("string").alias("val"))
    new_ov = st2.overrides.join(st.overrides.select("id"), "id", "left_anti").select(
        F.lit("override").alias("kind"), "id", F.lit(None).cast("long").alias("ref"),
        F.array_join("override", "|").alias("val"))
    return sc.unionByName(new_ov)


@register("g04_validate_as_is", _V_SQL + f"""
select f.id, array_to_string(coalesce(ch.coll, f.collection), '|') as collection,
 case when ch.id is not null then true else f.validated end as validated,
 case when ch.id is not null then coalesce(f.validated_at, {NOW_S}) else f.validated_at end as validated_at
from st_fc f left join ch on ch.id = f.id""")
def g04(spark, d):
    st, _, _ = fixture_state(spark, d)
    st2 = st.apply(_validated(spark, d)[0])
    return st2.final.select("id", F.array_join("collection", "|").alias("collection"), "validated",
                            _epoch("validated_at").alias("validated_at"))


@register("g05_validation_outcome", _V_SQL + """
select input_index, case when branch = 'override' then 'record_validated'
 when branch = 'as_is' and has_val then 'record_previously_validated'
 when branch = 'as_is' and unval_id is not null then 'record_validated'
 when branch = 'identical' then 'record_previously_validated'
 when branch = 'disallowed' then 'other_failure' end as outcome, 'record_validated' as status from b""")
def g05(spark, d):
    _, res = _validated(spark, d)
    return res.select("input_index", "outcome", "status")


@register("g06_set_validation", _ST_SQL + f"""
select id, id % 3 = 0 as validated, case when id % 3 = 0 then coalesce(validated_at, {NOW_S}) end as validated_at
from st_fc""")
def g06(spark, d):
    st, _, _ = fixture_state(spark, d)
    out = ST.set_validation(st.final, F.col("id") % 3 == 0, _now())
    return out.select("id", "validated", _epoch("validated_at").alias("validated_at"))


_RUN1_ROWS = """
, j as (select f.id, f.created, f.collection, coalesce(nullif(f.bibcode,''), s.bibcode) as bibcode,
  coalesce(nullif(f.scix_id,''), s.scix_id) as scix_id from st_fc f join st_sc s on f.score_id = s.id where s.run_id = 1),
rr as (select bibcode, scix_id, id from j
  qualify row_number() over (partition by case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end,
  case when coalesce(scix_id,'') <> '' then scix_id else bibcode end order by created desc, id desc) = 1)
"""


@register("g07_validate_run", _ST_SQL + _RUN1_ROWS + """
, fcm as (select r.id as rid, f.id, f.created, f.validated from rr r join st_fc f on f.scix_id = nullif(r.scix_id,'')
  union select r.id, f.id, f.created, f.validated from rr r join st_fc f on f.bibcode = nullif(r.bibcode,'')),
unval as (select rid, id as fid from fcm where not validated
  qualify row_number() over (partition by rid order by created desc, id desc) = 1)
select r.id as input_index, r.bibcode, r.scix_id, u.fid is not null as success from rr r left join unval u
 on u.rid = r.id""")
def g07(spark, d):
    st, _, _ = fixture_state(spark, d)
    _, res = ST.validate_run(st, 1, _now())
    return res


@register("g07b_validate_run_table", _ST_SQL + _RUN1_ROWS + f"""
, fcm as (select r.id as rid, f.id, f.created, f.validated from rr r join st_fc f on f.scix_id = nullif(r.scix_id,'')
  union select r.id, f.id, f.created, f.validated from rr r join st_fc f on f.bibcode = nullif(r.bibcode,'')),
unval as (select rid, id as fid from fcm where not validated
  qualify row_number() over (partition by rid order by created desc, id desc) = 1)
select f.id, f.validated or u.fid is not null as validated,
 case when u.fid is not null then coalesce(f.validated_at, {NOW_S}) else f.validated_at end as validated_at
from st_fc f left join (select distinct fid from unval) u on u.fid = f.id""")
def g07b(spark, d):
    st, _, _ = fixture_state(spark, d)
    changes, _ = ST.validate_run(st, 1, _now())
    return st.apply(changes).final.select("id", "validated", _epoch("validated_at").alias("validated_at"))


_G8_SRC = """(select input_index, case input_index % 5 when 0 then 'classify' when 1 then 'classify_verify'
  when 2 then 'pre_ingest' when 3 then 'pre_ingest' else 'validate' end as operation_step, identifier,
  case when length(identifier) = 19 and not regexp_matches(identifier,
  '^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$') then identifier end as bibcode,
  case when length(identifier) = 19 and regexp_matches(identifier,
  '^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$') then identifier end as scix_id from v_requests)"""


def _g8_src(spark, d):
    r = _requests_split(spark, d)
    i = F.col("input_index") % 5
    step = (F.when(i == 0, "classify").when(i == 1, "classify_verify").when(i <= 3, "pre_ingest")
            .otherwise("validate"))
    return r.withColumn("operation_step", step)


@register("g08_route_index", duck_cte("v_requests") + f"""
select input_index, case when operation_step in ('classify', 'classify_verify') then 'index'
 when operation_step = 'pre_ingest' and (coalesce(bibcode,'') <> '' or coalesce(scix_id,'') <> '') then 'index'
 when operation_step = 'pre_ingest' then 'pass_through' else 'validate' end as route from {_G8_SRC} s""")
def g08(spark, d):
    return _g8_src(spark, d).select("input_index", ST.route_index(_g8_src(spark, d)).alias("route"))


@register("g09_output_actions", duck_cte("v_requests") + f"""
select input_index, operation_step in ('classify', 'classify_verify', 'pre_ingest') as write_tsv,
 operation_step = 'classify' or (operation_step = 'validate' and input_index % 3 = 0) as forward
from {_G8_SRC} s""")
def g09(spark, d):
    s = _g8_src(spark, d)
    status = F.when(F.col("input_index") % 3 == 0, C.STATUS_VALIDATED).otherwise(C.STATUS_OTHER_FAILURE)
    w, f = ST.output_actions(F.col("operation_step"), status)
    return s.select("input_index", w.alias("write_tsv"), f.alias("forward"))


def fixture_resend_requests(spark, d, every=False):
    """Requests by bibcode from even and by scix id from odd rows, or from
    ``every`` row with such an id, and one per run."""
    r = _requests_split(spark, d)
    even, odd = (F.lit(every) | (F.col("input_index") % 2 == n) for n in (0, 1))
    bib = r.filter(even & F.col("bibcode").isNotNull()).select(
        F.col("input_index").alias("request_id"), "bibcode", F.lit(None).cast("string").alias("scix_id"),
        F.lit(None).cast("long").alias("run_id"))
    scx = r.filter(odd & F.col("scix_id").isNotNull()).select(
        F.col("input_index").alias("request_id"), F.lit(None).cast("string").alias("bibcode"), "scix_id",
        F.lit(None).cast("long").alias("run_id"))
    runs = view(spark, d, "v_scores").select(F.col("run_id").cast("long")).distinct().select(
        (-1 - F.col("run_id")).alias("request_id"), F.lit(None).cast("string").alias("bibcode"),
        F.lit(None).cast("string").alias("scix_id"), "run_id")
    return bib.unionByName(scx).unionByName(runs)


_ST_BASE = duck_cte("v_overrides", "v_scores", "v_final", "v_scored")
_G10_SQL = duck_cte("v_overrides", "v_scores", "v_final", "v_scored", "v_requests") + _ST_SQL[len(_ST_BASE):] + f""",
rq as (select input_index, bibcode, scix_id from (select *, {_REQ_IDS} from v_requests) z),
reqs as (select input_index as request_id, bibcode, null::varchar as scix_id, null::bigint as run_id from rq
   where input_index % 2 = 0 and bibcode is not null
  union all select input_index, null, scix_id, null from rq where input_index % 2 = 1 and scix_id is not null
  union all select -1 - run_id, null, null, run_id from (select distinct run_id from st_sc) q),
fb as (select * from st_fc where coalesce(bibcode,'') <> ''
  qualify row_number() over (partition by bibcode order by created desc, id desc) = 1),
fs as (select * from st_fc where coalesce(scix_id,'') <> ''
  qualify row_number() over (partition by scix_id order by created desc, id desc) = 1),
rs as (select q.request_id, f.id as final_id, f.collection, f.created, coalesce(nullif(f.bibcode,''), s.bibcode)
  as bibcode, coalesce(nullif(f.scix_id,''), s.scix_id) as scix_id from reqs q join st_sc s on s.run_id = q.run_id
  join st_fc f on f.score_id = s.id where q.bibcode is null and q.scix_id is null),
rsd as (select * from rs qualify row_number() over (partition by request_id,
  case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end,
  case when coalesce(scix_id,'') <> '' then scix_id else bibcode end order by created desc, final_id desc) = 1),
allr as (select q.request_id, q.bibcode, f.scix_id, f.id as final_id, f.collection from reqs q join fb f
  on f.bibcode = q.bibcode where q.bibcode is not null
 union all select q.request_id, f.bibcode, q.scix_id, f.id, f.collection from reqs q join fs f on f.scix_id = q.scix_id
  where q.bibcode is null and q.scix_id is not null
 union all select request_id, bibcode, scix_id, final_id, collection from rsd)
"""


_G10_ALL_SQL = _G10_SQL.replace("input_index % 2 = 0 and ", "").replace("input_index % 2 = 1 and ", "")


@register("g10_resend_select", _G10_ALL_SQL + """
select request_id, bibcode, scix_id, final_id, array_to_string(collection, '|') as collection from allr""")
def g10(spark, d):
    st, _, _ = fixture_state(spark, d)
    out = ST.resend_select(fixture_resend_requests(spark, d, every=True), st.final, st.scores)
    return out.select("request_id", "bibcode", "scix_id", "final_id", F.array_join("collection", "|").alias(
        "collection"))


@register("g10b_resend_select_every_id", _G10_ALL_SQL + """
select request_id, bibcode, scix_id, final_id, array_to_string(collection, '|') as collection from allr""")
def g10b(spark, d):
    st, _, _ = fixture_state(spark, d)
    out = ST.resend_select(fixture_resend_requests(spark, d, every=True), st.final, st.scores)
    return out.select("request_id", "bibcode", "scix_id", "final_id", F.array_join("collection", "|").alias(
        "collection"))


@register("g11_resend_validated", _ST_SQL + f"""
select bibcode, scix_id, 'success' as status, array_to_string(collection, ', ') as collections from st_fc
where validated and validated_at is not null and validated_at >= {NOW_S} - 7*86400
qualify row_number() over (partition by case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end,
  case when coalesce(scix_id,'') <> '' then scix_id else bibcode end order by validated_at desc, created desc,
  id desc) = 1""")
def g11(spark, d):
    st, _, _ = fixture_state(spark, d)
    r = ST.recently_validated(st.final, 7, _now())
    return r.select("bibcode", "scix_id", F.lit("success").alias("status"),
                    S.join_list("collection").alias("collections"))


# ------------------------------------------------------------ E (metrics) ----
from labelweave.operators import metrics as M  # noqa: E402


def _stats_sql(v: str, p99: bool = True) -> str:
    s = (f"count({v}) as count, min({v}) as min, max({v}) as max, avg({v}) as mean, "
         f"quantile_cont({v}, 0.5) as p50, quantile_cont({v}, 0.95) as p95")
    return s + (f", quantile_cont({v}, 0.99) as p99" if p99 else "")


def _ev(spark, d):
    return view(spark, d, "v_perf_events")


def _r6_all(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[r6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


_STAT_COLS = ["mean", "p50", "p95", "p99", "min", "max"]
_EV = duck_cte("v_perf_events")
_NORM_SQL = """, nd as (select *, case when stage in ('classify', 'index_db') and coalesce(record_count, 0) > 0
  then duration_ms / record_count else duration_ms end as latency_ms from v_perf_events
  where duration_ms is not null and stage not in ('task_timing', 'app_timing', 'classifier_timing',
  'classifier_batch_shape'))"""


def _round_sql(cols: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in cols.split(","))


@register("e01_percentile", _EV + """
select stage, p, round(value, 6) as value from (
 select stage, 0.0::double as p, min(duration_ms) as value from v_perf_events group by stage
 union all select stage, 25.0, quantile_cont(duration_ms, 0.25) from v_perf_events group by stage
 union all select stage, 90.0, quantile_cont(duration_ms, 0.9) from v_perf_events group by stage
 union all select stage, 100.0, max(duration_ms) from v_perf_events group by stage) t""")
def e01(spark, d):
    out = M.order_stats(_ev(spark, d), ["stage"], "duration_ms", [0.0, 25.0, 90.0, 100.0])
    return out.select("stage", "p", r6(F.col("value")).alias("value"))


@register("e02_numeric_stats", _EV + f"""
select run_id, count, {_round_sql('min,max,mean,p50,p95,p99')} from (select run_id, {_stats_sql('duration_ms')}
 from v_perf_events group by run_id) t""")
def e02(spark, d):
    return _r6_all(M.numeric_stats(_ev(spark, d), ["run_id"], "duration_ms"), _STAT_COLS)


@register("e03_event_counts", _EV + """
select run_id, coalesce(sum(case when stage = 'ingest_enqueue' then coalesce(record_count, 1) end), 0)
 as records_submitted, count(*) filter (where stage = 'index') as records_indexed,
 count(*) filter (where stage in ('forward', 'forward_message')) as records_forwarded,
 count(*) filter (where coalesce(status, 'ok') <> 'ok') as failures from v_perf_events group by run_id""")
def e03(spark, d):
    return M.event_counts(_ev(spark, d))


@register("e04_stage_latency", _EV + _NORM_SQL + f"""
select run_id, stage, count, {_round_sql('min,max,mean,p50,p95,p99')} from (select run_id, stage,
 {_stats_sql('latency_ms')} from nd group by run_id, stage) t""")
def e04(spark, d):
    return _r6_all(M.stage_latency(_ev(spark, d)), _STAT_COLS)


_BATCH_SQL = """, b as (select * from v_perf_events where duration_ms is not null and stage in ('classify', 'index_db')
  and (coalesce(batch_mode, false) or coalesce(record_count, 0) > 1))"""


@register("e05_batch_latency_sizes", _EV + _BATCH_SQL + f"""
select 'latency' as kind, run_id, stage, count, {_round_sql('min,max,mean,p50,p95,p99')} from (select run_id, stage,
 {_stats_sql('duration_ms')} from b group by run_id, stage) t
union all
select 'size', run_id, stage, count, {_round_sql('min,max,mean,p50,p95,p99')} from (select run_id, stage,
 {_stats_sql('cast(record_count as double)')} from b where coalesce(record_count, 0) > 0 group by run_id, stage) t""")
def e05(spark, d):
    lat, sizes = M.batch_stats(_ev(spark, d))
    return _r6_all(lat.withColumn("kind", F.lit("latency")).unionByName(sizes.withColumn("kind", F.lit("size"))),
                   _STAT_COLS)


@register("e06_named_timings", _EV + f"""
select run_id, stage, name, count, {_round_sql('min,max,mean,p50,p95,p99')} from (select run_id, stage,
 coalesce(nullif(name, ''), 'unknown') as name, {_stats_sql('duration_ms')} from v_perf_events
 where duration_ms is not null and stage in ('task_timing', 'app_timing', 'classifier_timing', 'classifier_batch_shape')
 group by all) t""")
def e06(spark, d):
    return _r6_all(M.named_timings(_ev(spark, d)), _STAT_COLS)


@register("e07_errors_by_stage", _EV + """
select run_id, coalesce(nullif(stage, ''), 'unknown') as stage, count(*) as errors from v_perf_events where coalesce(status, 'ok') <> 'ok'
group by run_id, stage""")
def e07(spark, d):
    return M.errors_by_stage(_ev(spark, d))


_THR_SQL = """, thr as (select run_id, count(*) filter (where stage = 'index') as records_indexed,
  greatest(0.0, max(ts) - min(ts)) as wall_clock_s from v_perf_events group by run_id),
thr2 as (select *, case when wall_clock_s > 0 then records_indexed / wall_clock_s * 60 end
  as overall_records_per_minute from thr)"""


@register("e08_throughput", _EV + _THR_SQL + """
select run_id, records_indexed, round(wall_clock_s, 6) as wall_clock_s,
 round(overall_records_per_minute, 6) as overall_records_per_minute from thr2""")
def e08(spark, d):
    return _r6_all(M.throughput(_ev(spark, d)), ["wall_clock_s", "overall_records_per_minute"])


@register("e09_backlog_status", _EV + _THR_SQL + """
select run_id, records_indexed, greatest(0, 300 - records_indexed) as backlog,
 case when greatest(0, 300 - records_indexed) > 0 then 'incomplete' else 'complete' end as status from thr2""")
def e09(spark, d):
    t = M.throughput(_ev(spark, d))
    b, st = M.backlog(F.col("records_indexed"), F.lit(300))
    return t.select("run_id", "records_indexed", b.alias("backlog"), st.alias("status"))


_LAT_SQL = _NORM_SQL + """, lat as (select run_id, stage, quantile_cont(latency_ms, 0.95) as p95 from nd
  group by run_id, stage),
bn as (select run_id, stage as bottleneck_stage, p95 as bottleneck_p95 from lat where p95 is not null
  qualify row_number() over (partition by run_id order by p95 desc, stage) = 1)"""

_E10_SQL = _EV + _THR_SQL + _LAT_SQL + """,
cnt as (select run_id, coalesce(sum(case when stage = 'ingest_enqueue' then coalesce(record_count, 1) end), 0)
  as records_submitted, count(*) filter (where stage = 'index') as records_indexed,
  count(*) filter (where stage in ('forward', 'forward_message')) as records_forwarded,
  count(*) filter (where coalesce(status, 'ok') <> 'ok') as failures from v_perf_events group by run_id),
ns as (select run_id, count(*) as n_stages from lat group by run_id),
summ as (select c.*, round(t.wall_clock_s, 6) as wall_clock_s,
  round(t.overall_records_per_minute, 6) as overall_records_per_minute, n.n_stages, b.bottleneck_stage,
  round(b.bottleneck_p95, 6) as bottleneck_p95, greatest(0, 300 - c.records_indexed) as backlog,
  case when greatest(0, 300 - c.records_indexed) > 0 then 'incomplete' else 'complete' end as status
  from cnt c join thr2 t using (run_id) left join ns n using (run_id) left join bn b using (run_id))"""

_E10_COLS = ["run_id", "records_submitted", "records_indexed", "records_forwarded", "failures", "wall_clock_s",
             "overall_records_per_minute", "n_stages", "bottleneck_stage", "bottleneck_p95", "backlog", "status"]


@register("e10_event_summary", _E10_SQL + "select * from summ")
def e10(spark, d):
    s = M.summarize_events(_ev(spark, d), F.lit(300))
    return _r6_all(s.select(*_E10_COLS), ["wall_clock_s", "overall_records_per_minute", "bottleneck_p95"])


_REPORT_COLS = "min,max,mean,p50,p95,p99"


@register("e10b_event_report", _EV + _NORM_SQL + _BATCH_SQL + f""",
m as (select run_id, 'latency_ms' as section, stage as name, latency_ms as value from nd
 union all select run_id, 'batch_latency_ms', stage, duration_ms from b
 union all select run_id, 'batch_sizes', stage, record_count::double from b where coalesce(record_count, 0) > 0
 union all select run_id, stage, coalesce(nullif(name, ''), 'unknown'), duration_ms from v_perf_events
  where duration_ms is not null and stage in ('task_timing', 'app_timing', 'classifier_timing', 'classifier_batch_shape'))
select run_id, section, name, count, {_round_sql(_REPORT_COLS)} from (
 select run_id, section, name, {_stats_sql('value')} from m group by run_id, section, name) t
union all select run_id, 'errors', coalesce(nullif(stage, ''), 'unknown'), count(*), null, null, null, null, null, null
 from v_perf_events where coalesce(status, 'ok') <> 'ok' group by run_id, stage""")
def e10b(spark, d):
    return _r6_all(M.event_report(_ev(spark, d)), _STAT_COLS)


def _samples(spark, d):
    v = view(spark, d, "v_system_samples")
    return (v.withColumn("platform", F.when(F.col("event_id") % 40 == 0, "linux").otherwise("darwin"))
             .withColumn("cpu_count", (F.col("event_id") % 7 + 1).cast("long"))
             .withColumn("memory_probe", F.concat(F.lit("probe"), (F.col("event_id") % 3).cast("string"))))


_SYS_SQL = duck_cte("v_system_samples") + f""",
sl as (select run_id, ts, m.metric, m.v from v_system_samples, (select unnest([
  {{'metric': 'normalized_load_1m', 'v': normalized_load_1m}},
  {{'metric': 'normalized_load_5m', 'v': normalized_load_5m}},
  {{'metric': 'normalized_load_15m', 'v': normalized_load_15m}},
  {{'metric': 'memory_available_ratio', 'v': memory_available_ratio}}]) as m)),
sysm as (select run_id, metric, {_stats_sql('v', False)} from sl group by run_id, metric),
first as (select run_id, count(*) as sample_count, arg_min(case when event_id % 40 = 0 then 'linux' else 'darwin' end,
  ts) as platform, arg_min(event_id % 7 + 1, ts) as cpu_count, arg_min('probe' || (event_id % 3)::varchar, ts)
  as memory_probe from v_system_samples group by run_id)
"""


@register("e11_system_samples", _SYS_SQL + f"""
select s.run_id, s.metric, s.count, {_round_sql('s.min,s.max,s.mean,s.p50,s.p95').replace('as s.', 'as ').replace(', 6)', ', 5)')},
 f.sample_count, f.platform, f.cpu_count, f.memory_probe from sysm s join first f using (run_id)""")
def e11(spark, d):
    out = M.system_summary(_samples(spark, d))
    return out.select(*[F.round(c, 5).alias(c) if c in _STAT_COLS else F.col(c) for c in out.columns])



_SYS_BODY = _SYS_SQL[len(duck_cte("v_system_samples")):]
_BOTH = duck_cte("v_perf_events", "v_system_samples") + _THR_SQL + _SYS_BODY + """,
adj as (select t.run_id, t.records_indexed, t.wall_clock_s, t.overall_records_per_minute,
  case when m.mean is not null then greatest(1.0, m.mean) else 1.0 end as host_load_adjustment_factor,
  t.overall_records_per_minute * case when m.mean is not null then greatest(1.0, m.mean) else 1.0 end
  as load_adjusted_records_per_minute
  from thr2 t left join (select run_id, mean from sysm where metric = 'normalized_load_1m') m using (run_id)),
summary as (select a.*, l.mean as mean_load_1m, r.mean as mean_memory_ratio from adj a
  left join (select run_id, mean from sysm where metric = 'normalized_load_1m') l using (run_id)
  left join (select run_id, mean from sysm where metric = 'memory_available_ratio') r using (run_id))
"""


def _summary(spark, d):
    return M.run_summaries(_ev(spark, d), _samples(spark, d))


@register("e12_load_adjustment", _BOTH + """
select run_id, round(overall_records_per_minute, 6) as overall_records_per_minute,
 round(host_load_adjustment_factor, 6) as host_load_adjustment_factor,
 round(load_adjusted_records_per_minute, 6) as load_adjusted_records_per_minute from adj""")
def e12(spark, d):
    s = _summary(spark, d)
    return _r6_all(s.select("run_id", "overall_records_per_minute", "host_load_adjustment_factor",
                            "load_adjusted_records_per_minute"),
                   ["overall_records_per_minute", "host_load_adjustment_factor", "load_adjusted_records_per_minute"])


_GATE_SQL = _BOTH + _LAT_SQL + """,
cmp as (select c.stage, c.p95 as cand_p95, b.p95 as base_p95,
  case when b.p95 <> 0 and c.p95 is not null then (c.p95 - b.p95) / b.p95 * 100 end as p95_delta_pct
  from lat c join lat b on b.stage = c.stage and b.run_id = '0' where c.run_id = '1'),
reg as (select coalesce(max(p95_delta_pct > 10.0), false) as regressed, count(*) as common_stages from cmp),
g as (select case when b.overall_records_per_minute <> 0 and c.overall_records_per_minute is not null then
  (c.overall_records_per_minute - b.overall_records_per_minute) / b.overall_records_per_minute * 100 end as tdelta,
  case when b.load_adjusted_records_per_minute <> 0 and c.load_adjusted_records_per_minute is not null then
  (c.load_adjusted_records_per_minute - b.load_adjusted_records_per_minute) / b.load_adjusted_records_per_minute * 100
  end as adelta, b.mean_load_1m as bl, c.mean_load_1m as cl, b.mean_memory_ratio as bm, c.mean_memory_ratio as cm,
  r.regressed, r.common_stages
  from summary c, summary b, reg r where c.run_id = '1' and b.run_id = '0')
"""


@register("e13_gate", _GATE_SQL + """
select coalesce(tdelta >= 5.0, false) and not regressed as pass, round(tdelta, 6) as throughput_delta_pct,
 round(adelta, 6) as load_adjusted_throughput_delta_pct,
 array_to_string(list_filter([case when not coalesce(tdelta >= 5.0, false) then
  'throughput improvement below threshold' end, case when regressed then
  'p95 latency regression exceeded threshold' end], lambda x: x is not null), '; ') as reasons, common_stages,
 (select string_agg(stage || '=' || coalesce(round(p95_delta_pct, 2)::decimal(18, 2)::varchar, 'null'), ',' order by stage)
  from cmp) as p95_delta_pct_by_stage,
 round(bl, 6) as baseline_mean_normalized_load_1m, round(cl, 6) as candidate_mean_normalized_load_1m,
 round(bm, 6) as baseline_mean_memory_available_ratio, round(cm, 6) as candidate_mean_memory_available_ratio,
 5.0::double as min_throughput_improvement_pct, 10.0::double as p95_regression_limit_pct from g""")
def e13(spark, d):
    g = M.gate_for_runs(_ev(spark, d), _samples(spark, d), "1", "0")
    g = g.withColumn("reasons", F.array_join("reasons", "; "))
    shown = F.transform(F.map_entries("p95_delta_pct_by_stage"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(
        F.round(e["value"], 2).cast("decimal(18,2)").cast("string"), F.lit("null"))))
    g = g.withColumn("p95_delta_pct_by_stage", F.array_join(F.array_sort(shown), ","))
    return _r6_all(g, ["throughput_delta_pct", "load_adjusted_throughput_delta_pct",
                       "baseline_mean_normalized_load_1m", "candidate_mean_normalized_load_1m",
                       "baseline_mean_memory_available_ratio", "candidate_mean_memory_available_ratio"])


@register("e14_bottleneck", _EV + _LAT_SQL + """
select run_id, bottleneck_stage, round(bottleneck_p95, 6) as bottleneck_p95 from bn""")
def e14(spark, d):
    return _r6_all(M.bottleneck(M.stage_latency(_ev(spark, d))), ["bottleneck_p95"])


SWEEP_MODES = ["real", "fake"]
SWEEP_SIZES = [50, 100, 250, 500]


def sweep_table(spark, summary: DataFrame, modes=SWEEP_MODES, sizes=SWEEP_SIZES) -> DataFrame:
    """One row per (mode, batch size) case of the sweep; case i is run
    ``str(i)``; cases without a run are 'missing'."""
    grid = spark.createDataFrame([(m, b, str(i * len(sizes) + j)) for i, m in enumerate(modes)
                                  for j, b in enumerate(sizes)], "mode string, batch_size int, run_id string")
    j = grid.join(summary, "run_id", "left")
    return j.select("mode", "batch_size", F.when(F.col("overall_records_per_minute").isNotNull() |
                                                 F.col("wall_clock_s").isNotNull(), "ok").otherwise("missing")
                    .alias("status"), "overall_records_per_minute", "load_adjusted_records_per_minute",
                    "mean_load_1m", "mean_memory_ratio")


_GRID_SQL = "(values " + ", ".join(f"('{m}', {b}, '{i * 4 + j}')" for i, m in enumerate(SWEEP_MODES)
                                   for j, b in enumerate(SWEEP_SIZES)) + ") g(mode, batch_size, run_id)"


@register("e15_sweep_table", _BOTH + f"""
select g.mode, g.batch_size, case when s.overall_records_per_minute is not null or s.wall_clock_s is not null then 'ok'
 else 'missing' end as status, round(s.overall_records_per_minute, 6) as overall_records_per_minute,
 round(s.load_adjusted_records_per_minute, 6) as load_adjusted_records_per_minute,
 round(s.mean_load_1m, 6) as mean_load_1m, round(s.mean_memory_ratio, 6) as mean_memory_ratio
from {_GRID_SQL} left join summary s using (run_id)""")
def e15(spark, d):
    out = sweep_table(spark, _summary(spark, d))
    return _r6_all(out, ["overall_records_per_minute", "load_adjusted_records_per_minute", "mean_load_1m",
                         "mean_memory_ratio"])


def run_completion(final: DataFrame, scores: DataFrame, run_id, expected: int) -> DataFrame:
    """Distinct records of a run present in the tables vs expected."""
    rr = ST.run_results(final, scores, run_id)
    n = rr.agg(F.count(F.lit(1)).alias("indexed_records"))
    return n.select(F.lit(run_id).cast("long").alias("run_id"), "indexed_records",
                    (F.col("indexed_records") >= expected).alias("complete"), F.lit(expected).alias("expected"))


@register("e17_run_completion", _ST_SQL + _RUN1_ROWS + """
select 1 as run_id, count(*) as indexed_records, count(*) >= 300 as complete, 300 as expected from rr""")
def e17(spark, d):
    st, _, _ = fixture_state(spark, d)
    return run_completion(st.final, st.scores, 1, 300)


@register("e18_completion_override", _ST_SQL.replace(_ST_BASE, duck_cte(
    "v_overrides", "v_scores", "v_final", "v_scored", "v_perf_events"), 1) + _RUN1_ROWS + _THR_SQL + """
, comp as (select count(*) as n from rr)
select t.run_id, comp.n as records_indexed, round(t.wall_clock_s, 6) as wall_clock_s,
 round(case when t.wall_clock_s > 0 then comp.n / t.wall_clock_s * 60 end, 6) as overall_records_per_minute,
 comp.n < 300 as timed_out from thr2 t, comp where t.run_id = '1'""")
def e18(spark, d):
    st, _, _ = fixture_state(spark, d)
    comp = run_completion(st.final, st.scores, 1, 300)
    thr = M.throughput(_ev(spark, d)).filter(F.col("run_id") == "1").drop("records_indexed")
    n = comp.select(F.max("indexed_records")).scalar()
    done = comp.select(F.max("complete")).scalar()
    out = thr.select("run_id", n.alias("records_indexed"), "wall_clock_s",
                     S.per_minute(n, F.col("wall_clock_s")).alias("overall_records_per_minute"),
                     (~done).alias("timed_out"))
    return _r6_all(out, ["wall_clock_s", "overall_records_per_minute"])


@register("d09_stage_compare", _EV + _LAT_SQL + """
select c.stage, round(c.p95, 6) as cand_p95, round(b.p95, 6) as base_p95,
 round(case when b.p95 <> 0 and c.p95 is not null then (c.p95 - b.p95) / b.p95 * 100 end, 6) as p95_delta_pct
from lat c join lat b on b.stage = c.stage and b.run_id = '0' where c.run_id = '1'""")
def d09(spark, d):
    lat = M.stage_latency(_ev(spark, d))
    cmp = M.compare_stages(lat.filter(F.col("run_id") == "1"), lat.filter(F.col("run_id") == "0"))
    return _r6_all(cmp, ["cand_p95", "base_p95", "p95_delta_pct"])


def fixture_contexts(events: DataFrame) -> DataFrame:
    runs = events.select("run_id").distinct()
    run_level = runs.select("run_id", F.lit(None).cast("string").alias("context_id"),
                            (F.col("run_id") != "3").alias("enabled"),
                            F.concat(F.lit("ctx"), F.col("run_id")).alias("default_context_id"))
    spec = runs.filter(F.col("run_id") == "1").select("run_id", F.lit("c-off").alias("context_id"),
                                                      F.lit(False).alias("enabled"),
                                                      F.lit(None).cast("string").alias("default_context_id"))
    return run_level.unionByName(spec)


@register("d10_event_context", _EV + """
, ev as (select *, case event_id % 5 when 0 then 'c-off' when 1 then 'c-x' end as context_id from v_perf_events)
select e.event_id, coalesce(e.context_id, 'ctx' || e.run_id) as context_id from ev e
where coalesce(case when e.run_id = '1' and e.context_id = 'c-off' then false end, e.run_id <> '3', true)""")
def d10(spark, d):
    ev = _ev(spark, d).withColumn("context_id", F.when(F.col("event_id") % 5 == 0, "c-off")
                                  .when(F.col("event_id") % 5 == 1, "c-x"))
    out = M.resolve_event_context(ev, fixture_contexts(ev))
    return out.select("event_id", "context_id")


# ----------------------------------------------------------- A (files) ----
import os  # noqa: E402

from labelweave.session import cut_lineage, rename_parts, scratch_dir  # noqa: E402
from labelweave.sources import readers as RD  # noqa: E402
from labelweave.sources import writers as WR  # noqa: E402


def _csv_out(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """Files of about ``advisoryPartitionSizeInBytes`` however many rows there
    are: a file with quoted newlines is read by one task."""
    (df.hint("rebalance").write.mode("overwrite").option("sep", sep).option("header", header)
       .option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(path))


_A1_SQL = duck_cte("v_requests") + f"""
select bibcode, scix_id, coalesce(title, '') as title, coalesce(abstract, '') as abstract
from (select *, {_REQ_IDS} from v_requests) r"""


@register("a01_read_new_records", _A1_SQL)
def a01(spark, d):
    path = scratch_dir(spark, "a01")
    v = view(spark, d, "v_requests").select(F.col("identifier").alias("bibcode"), "title", "abstract")
    _csv_out(v, path)
    return RD.read_new_records(spark, path).select("bibcode", "scix_id", "title", "abstract")


@register("a02_read_pre_ingest", duck_cte("v_requests") + """
select bibcode, scix_id, coalesce(title, '') as title, coalesce(abstract, '') as abstract,
 'pre_ingest' as operation_step, case when bibcode is null and scix_id is null
 then 'three columns, but the first holds no record id: ' || identifier end as error
from (select *, """ + _REQ_IDS + """ from v_requests) r""")
def a02(spark, d):
    path = scratch_dir(spark, "a02")
    v = view(spark, d, "v_requests").select(F.col("identifier").alias("bibcode"), "title", "abstract")
    _csv_out(v, path, sep="\t")
    out = RD.read_pre_ingest(spark, path, delimiter="tab", strict=False)
    return out.select("bibcode", "scix_id", "title", "abstract", "operation_step", "error")


@register("a02b_resolve_delimiter", """select * from (values ('tabbed', chr(9)), ('comma', ',')) t(folder, delimiter)
where (select count(*) from documents) > 0""")
def a02b(spark, d):
    base = scratch_dir(spark, "a02b")
    v = view(spark, d, "v_requests").select("identifier", "input_index", "batch_id")
    _csv_out(v, os.path.join(base, "tabbed"), sep="\t")
    _csv_out(v, os.path.join(base, "comma"), sep=",")
    s = RD.delimiter_by_file(RD.sniff_delimiters(spark, [os.path.join(base, "tabbed"), os.path.join(base, "comma")]))
    return s.select(F.when(F.col("file").contains("/tabbed/"), "tabbed").otherwise("comma").alias("folder"),
                    "delimiter").distinct()


@register("a03_inline_text", "with req as (select doc_id as input_index, '' || ' ' || text as text from documents),"
          + O.scores_ctes("req") + f"""
select input_index as doc_id, 'pre_ingest' as operation_step,
 array_to_string({O.collections_sql('scores')}, ', ') as collections from o_scores""")
def a03(spark, d):
    docs = read_table(spark, d, "documents").select(F.col("doc_id").alias("input_index"), "text")
    req = RD.from_text(docs).drop("text")
    out = SC.classify(req, _scorer(spark), carry=("operation_step",))
    return out.select(F.col("input_index").alias("doc_id"), "operation_step",
                      S.join_list("collections").alias("collections"))


def _validation_rows(spark, d):
    s = view(spark, d, "v_scored").withColumn("collections", S.collections("scores")).withColumn(
        "collection_scores", S.collection_scores("scores"))
    r = view(spark, d, "v_requests").select("input_index", F.col("batch_id").alias("run_id"), "title", "abstract")
    rows = output_row(s.join(r, "input_index"))
    i = F.col("bibcode") != ""
    ov = F.when(F.length("title") % 3 == 0, "general").when(F.length("title") % 3 == 1, "Astrophysics,physics") \
        .otherwise("")
    return rows.withColumn("override", F.when(i | (F.col("scix_id") != ""), ov).otherwise(F.lit("")))


@register("a04_read_validation_tsv", duck_cte("v_scored", "v_requests") + """
, rows as (select coalesce(s.bibcode, '') as bibcode, coalesce(s.scix_id, '') as scix_id,
  case when r.batch_id = 0 then '' else cast(r.batch_id as varchar) end as run_id,
  coalesce(r.title, '') as title, coalesce(r.abstract, '') as abstract from v_scored s join v_requests r
  using (input_index))
select case when bibcode <> '' and length(bibcode) = 19 and not regexp_matches(bibcode,
  '^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$') then bibcode end as bibcode,
 case when not (bibcode <> '' and length(bibcode) = 19 and not regexp_matches(bibcode,
  '^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$')) and length(scix_id) = 19 and regexp_matches(scix_id,
  '^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$') then scix_id end as scix_id,
 run_id, title, abstract, 'validate' as operation_step,
 case when length(title) % 3 = 0 then 'general' when length(title) % 3 = 1 then 'Astrophysics|physics' else '' end
 as override from rows""")
def a04(spark, d):
    path = scratch_dir(spark, "a04")
    _csv_out(_validation_rows(spark, d), path, sep="\t")
    out = RD.read_validation_tsv(spark, path)
    return out.select("bibcode", "scix_id", "run_id", "title", "abstract", "operation_step",
                      F.array_join("override", "|").alias("override"))


@register("a05_read_benchmark_dataset", _A1_SQL + " where bibcode is not null or scix_id is not null")
def a05(spark, d):
    path = scratch_dir(spark, "a05")
    v = view(spark, d, "v_requests").select(F.col("identifier").alias("bibcode"), "title", "abstract")
    _csv_out(v, path)
    return RD.read_dataset(spark, path).select("bibcode", "scix_id", "title", "abstract")


def _events_jsonl(spark, d, path: str) -> None:
    e = view(spark, d, "v_perf_events")
    js = e.select(F.to_json(F.struct(
        "ts", "stage", "run_id", F.lit(None).cast("string").alias("context_id"),
        F.col("event_id").cast("string").alias("record_id"), "duration_ms", "status",
        F.struct("name", F.col("record_count").cast("long").alias("record_count"), "batch_mode").alias("extra"))
    ).alias("value"))
    junk = spark.range(2).select(F.when(F.col("id") == 0, F.lit("")).otherwise(F.lit('{"ts": 1, broken')).alias(
        "value"))
    js.unionByName(junk).repartition(4).write.mode("overwrite").text(path)


@register("a06_read_perf_events", _EV + """
select cast(event_id as varchar) as record_id, ts, stage, duration_ms, status, name,
 cast(record_count as bigint) as record_count, batch_mode from v_perf_events where run_id = '1'""")
def a06(spark, d):
    path = scratch_dir(spark, "a06")
    _events_jsonl(spark, d, path)
    ev = RD.flatten_events(RD.read_events(spark, path, run_id=1))
    return ev.select("record_id", "ts", "stage", "duration_ms", "status", "name", "record_count", "batch_mode")


@register("a07_concat_tsv", duck_cte("v_requests") + """
select identifier, coalesce(title, '') as title, coalesce(abstract, '') as abstract from v_requests""")
def a07(spark, d):
    base = scratch_dir(spark, "a07")
    v = view(spark, d, "v_requests").select("identifier", "title", "abstract")
    _csv_out(v.filter(F.col("input_index") % 2 == 0), base + "-w1", sep="\t")
    _csv_out(v.filter(F.col("input_index") % 2 == 1).toDF("id", "t", "a"), base + "-w2", sep="\t")
    _csv_out(v.filter(F.col("input_index") % 3 == 0), base + "-w3", sep="\t")  # not read: prefix q_
    rename_parts(spark, base + "-w1", base, "p_", ".tsv")
    rename_parts(spark, base + "-w2", base, "p_x", ".tsv")
    rename_parts(spark, base + "-w3", base, "q_", ".tsv")
    out = RD.concat_tsv(spark, base, "p_")
    return out.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c != "identifier" else F.col(c)
                        for c in ("identifier", "title", "abstract")])


def _responses(spark, d) -> DataFrame:
    """Search-response JSON texts derived from v_requests: 10 docs each with
    the title as a list, a string, an empty list or missing."""
    v = view(spark, d, "v_requests")
    t = F.coalesce(F.col("title"), F.lit(""))
    as_list = F.to_json(F.array(t))
    as_str = F.substring(as_list, 2, 1 << 30).substr(F.lit(1), F.length(as_list) - 2)
    k = F.col("input_index") % 4
    title_part = (F.when(k == 0, F.concat(F.lit(',"title":'), as_list))
                  .when(k == 1, F.concat(F.lit(',"title":'), as_str))
                  .when(k == 2, F.lit(',"title":[]')).otherwise(F.lit("")))
    ab = F.to_json(F.array(F.coalesce(F.col("abstract"), F.lit(""))))
    ab_str = F.substring(ab, 2, 1 << 30).substr(F.lit(1), F.length(ab) - 2)
    ab_part = F.when(F.col("input_index") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(',"abstract":'), ab_str))
    doc = F.concat(F.lit('{"bibcode":'), F.to_json(F.array("identifier")).substr(F.lit(2), F.length(
        F.to_json(F.array("identifier"))) - 2), title_part, ab_part, F.lit("}"))
    docs = v.select((F.col("input_index") / 10).cast("long").alias("resp"), "input_index", doc.alias("doc"))
    # a response holds 10 docs: a bounded group
    resp = docs.groupBy("resp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "input_index", "doc"))), lambda x: x["doc"]), ",").alias("docs"))
    js = resp.select(F.concat(F.lit('{"response":{"docs":['), F.col("docs"), F.lit("]}}")).alias("value"))
    return js.unionByName(spark.range(1).select(F.lit("{}").alias("value")))


@register("a08_parse_search_response", duck_cte("v_requests") + """
, p as (select identifier as bibcode, case when input_index % 4 in (0, 1) then coalesce(title, '') else '' end
  as title, case when input_index % 5 = 0 then '' else coalesce(abstract, '') end as abstract from v_requests)
select bibcode, title, abstract, title || ' ' || abstract as text from p""")
def a08(spark, d):
    return RD.parse_search_response(_responses(spark, d))


def _classified_rows(spark, d):
    cl = SC.classify(view(spark, d, "v_requests"), _scorer(spark), carry=("identifier", "title", "abstract",
                                                                           "batch_id"))
    cl = I.split_identifier(cl, "identifier").withColumnRenamed("batch_id", "run_id")
    return output_row(cl)


_TSV_SQL = duck_cte("v_requests") + """, req as (select input_index, coalesce(title,'None') || ' ' ||
 coalesce(abstract,'None') as text from v_requests),""" + O.scores_ctes("req") + f""",
rows as (select coalesce(r.bibcode, '') as bibcode, coalesce(r.scix_id, '') as scix_id, case when r.batch_id = 0 then '' else r.batch_id::varchar end as run_id,
 coalesce(r.title, '') as title, coalesce(r.abstract, '') as abstract,
 array_to_string({O.collections_sql('s.scores')}, ', ') as collections,
 array_to_string(list_transform({O.collection_scores_sql('s.scores')}, lambda x: cast(x as varchar)), ', ')
   as collection_scores,
 {O.summary_sql('s.scores')}, '' as gross_collection_override, '' as override
from o_scores s join (select *, {_REQ_IDS} from v_requests) r using (input_index)),
tsv as (select nullif(cast(columns(*) as varchar), '') from rows)
"""


@register("a09_write_classified_tsv", _TSV_SQL + "select * from tsv")
def a09(spark, d):
    path = scratch_dir(spark, "a09")
    WR.write_classified_tsv(_classified_rows(spark, d), path)
    return spark.read.option("sep", "\t").option("header", True).option("multiLine", True).option(
        "escape", '"').csv(path)


@register("a10_append_classified_tsv", _TSV_SQL + "select * from tsv union all select * from tsv")
def a10(spark, d):
    path = scratch_dir(spark, "a10")
    rows = cut_lineage(_classified_rows(spark, d))  # classified once for both appends
    WR.append_classified_tsv(rows, path)
    WR.append_classified_tsv(rows, path)
    return spark.read.option("sep", "\t").option("header", True).option("multiLine", True).option(
        "escape", '"').csv(path)


@register("a11_forward_response", _ST_SQL + f"""
select bibcode, scix_id, 'success' as status, array_to_string(collection, '|') as collections from st_fc
where validated and validated_at is not null and validated_at >= {NOW_S} - 30*86400
qualify row_number() over (partition by case when coalesce(scix_id,'') <> '' then 'scix_id' else 'bibcode' end,
  case when coalesce(scix_id,'') <> '' then scix_id else bibcode end order by validated_at desc, created desc,
  id desc) = 1""")
def a11(spark, d):
    """Written as JSON lines and read back field by field."""
    st, _, _ = fixture_state(spark, d)
    path = scratch_dir(spark, "a11")
    WR.forward(ST.recently_validated(st.final, 30, _now()).withColumn("status", F.lit("success")), path)
    back = spark.read.schema("bibcode string, scix_id string, status string, collections array<string>").json(path)
    return back.withColumn("collections", F.array_join("collections", "|"))


@register("a12_write_metrics_summary", _E10_SQL + "select * from summ")
def a12(spark, d):
    """Written as JSON and read back."""
    path = scratch_dir(spark, "a12")
    s = M.summarize_events(_ev(spark, d), F.lit(300))
    WR.write_summary(s, path)
    return _r6_all(spark.read.schema(s.schema).json(path).select(*_E10_COLS), [
        "wall_clock_s", "overall_records_per_minute", "bottleneck_p95"])


@register("a13_ids_csv_roundtrip", duck_cte("v_requests") + f""", ids as (
 select *, {_REQ_IDS} from v_requests), req as (select input_index, coalesce(title,'None') || ' ' ||
 coalesce(abstract,'None') as text from ids where bibcode is not null or scix_id is not null),""" + O.scores_ctes("req") + f""",
c as (select input_index, scores, {O.collections_sql('scores')} as collections from o_scores)
select i.identifier, coalesce(i.title, '') as title, coalesce(i.abstract, '') as abstract,
 array_to_string(c.collections, ', ') as collections, round(list_min(list_filter(c.scores,
  lambda s, n: list_contains(c.collections, {O.LABELS_SQL}[n]))), 6) as minimum_collection_score
from c join ids i using (input_index)""")
def a13(spark, d):
    from labelweave.operators.scoring import classify_ids
    base = scratch_dir(spark, "a13")
    v = _requests_split(spark, d)
    known = v.filter(F.col("bibcode").isNotNull() | F.col("scix_id").isNotNull())
    known.select(F.col("identifier").alias("bibcode")).write.mode("overwrite").option("header", True).csv(os.path.join(base, "ids"))
    out = classify_ids(spark, os.path.join(base, "ids"), v, os.path.join(base, "ids_classified.csv"), _scorer(spark))
    return out.select("identifier", F.coalesce("title", F.lit("")).alias("title"),
                      F.coalesce("abstract", F.lit("")).alias("abstract"), F.coalesce("collections", F.lit("")).alias("collections"),
                      r6(F.col("minimum_collection_score").cast("double")).alias("minimum_collection_score"))


# ------------------------------------------------------- H (streaming) ----
from labelweave.streaming import claims as CL  # noqa: E402
from labelweave.streaming import jobs as PL  # noqa: E402


def _write_request_files(spark, d, path: str, n_files: int = 4) -> int:
    """Request files in input order: ``n_files`` at least, more where the input
    has more than ``n_files`` splits.  Returns how many."""
    r = _requests_split(spark, d).select("input_index", "batch_id", "bibcode", "scix_id", "title", "abstract")
    n_files = max(n_files, splits(r))
    r.repartitionByRange(n_files, "input_index").write.mode("overwrite").json(path)
    return n_files


@register("h01_stream_classify", _C13_SQL)
def h01(spark, d):
    base = scratch_dir(spark, "h01")
    n_files = _write_request_files(spark, d, os.path.join(base, "in"))
    q = PL.start_classify_stream(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                                 os.path.join(base, "ckpt"), _scorer(spark), files_per_trigger=-(-n_files // 4))
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    return out.select("input_index", *[r6(F.get(F.col("scores"), i)).alias(f"s{i}") for i in range(8)],
                      S.join_list("collections").alias("collections"))


# arrivals of the index stream: requests, the same records without a title,
# validations, the same records without an abstract and as sent at first
_H01B_SRC = """(
 select 0 as arrival, input_index, input_index as text_index, identifier, title, abstract,
  case input_index % 3 when 0 then 'classify' when 1 then 'classify_verify' else 'pre_ingest' end as operation_step,
  cast(null as varchar(20)) as override_csv from v_requests where input_index < 1000000000
 union all select 1, input_index, input_index, identifier, title, abstract, 'classify', null from v_requests
  where input_index >= 1000000000 and input_index < 2000000000
 union all select 2, 3000000000 + input_index, input_index, identifier, title, abstract, 'validate',
  case input_index % 3 when 0 then 'general' when 1 then '' else 'nope' end from v_requests
  where input_index < 1000000000 and input_index % 7 = 0 and identifier not like 'bad%'
 union all select 3, input_index, input_index, identifier, title, abstract, 'classify', null from v_requests
  where input_index >= 2000000000
 union all select 3, 4000000000 + input_index, input_index, identifier, title, abstract, 'classify', null from v_requests
  where input_index < 1000000000 and input_index % 5 = 0)"""

_H01B_SQL = duck_cte("v_requests") + """, req as (select input_index, coalesce(title,'None') || ' ' ||
 coalesce(abstract,'None') as text from v_requests),""" + O.scores_ctes("req") + f""",
src as (select s.*, o.scores, {O.collections_sql('o.scores')} as colls, {_REQ_IDS}, text_index // 100 as run_id,
  case when text_index % 3 <> 0 then 'out/' || (text_index % 2)::varchar end as output_path
  from {_H01B_SRC} s join o_scores o on o.input_index = s.text_index),
named as (select * from src where identifier not like 'bad%'),
batch as (select * from named where operation_step <> 'validate'
  qualify row_number() over (partition by arrival, identifier order by input_index desc) = 1),
chk as (select identifier, override_csv, override_csv = 'general' as over from named where operation_step = 'validate'),
hist as (select b.*, coalesce(c.over, false) as over, c.override_csv in ('general', '') as valid,
  case when arrival = 3 and c.over then ['general'] else colls end as given
  from batch b left join chk c using (identifier)),
newest as (select *, max(arrival) over (partition by identifier) as last from hist
  qualify row_number() over (partition by identifier order by arrival desc) = 1),
sc as (select distinct on (identifier, text_index) * from hist)
select 'final' as kind, null::bigint as arrival, bibcode, scix_id, run_id, array_to_string(
  case when over then ['general'] else given end, '|') as collections,
  case when valid then 'validated' else 'open' end as status, null::double as s0, null as output_path from newest
union all select 'score', null, bibcode, scix_id, run_id, case when over then 'general' end, null,
  round(scores[1], 6), null from sc
union all select 'tsv', arrival, bibcode, scix_id, nullif(run_id, 0), nullif(array_to_string(colls, ', '), ''), null, null,
  output_path from src where operation_step <> 'validate'
union all select 'response', arrival, bibcode, scix_id, null, array_to_string(given, '|'), 'success', null, null from hist
  where operation_step = 'classify'
union all select 'response', arrival, bibcode, scix_id, null, override_csv, 'record_validated', null, null from named
  where operation_step = 'validate'"""


class _LostOnce(WR.SnapshotStore):
    """A store whose writer is lost once, between the writes of a batch."""

    def __init__(self, spark, root, batch_id):
        super().__init__(spark, root)
        self.lose = batch_id

    def write_changes(self, name, changes, batch_id):
        if name == "final_collection" and batch_id == self.lose:
            self.lose = None
            raise RuntimeError("writer lost")
        super().write_changes(name, changes, batch_id)


@register("h01b_stream_index", _H01B_SQL)
def h01b(spark, d):
    """The whole stream: requests arrive in four batches, are classified,
    indexed or validated, and leave as TSV rows and responses.  The writer of
    batch 1 is lost between two writes; the stream starts again from its
    checkpoint and replays that batch.  Read through the commit manifest."""
    from pyspark.errors import StreamingQueryException

    from labelweave import schemas
    base = scratch_dir(spark, "h01b")
    at = {k: os.path.join(base, k) for k in ("in", "out", "tsv", "fwd", "ckpt")}
    rows = spark.sql("select * from " + _H01B_SRC.replace("v_requests", "{v_requests}"), v_requests=view(spark, d, "v_requests"))
    path = F.when(F.col("text_index") % 3 != 0, F.concat(F.lit("out/"), (F.col("text_index") % 2).cast("string")))
    rows = I.split_identifier(rows, "identifier").select(
        "arrival", "input_index", "bibcode", "scix_id", "title", "abstract", "operation_step", path.alias("output_path"),
        F.floor(F.col("text_index") / 100).alias("run_id"), RQ.split_override("override_csv").alias("override"))
    store = _LostOnce(spark, os.path.join(base, "store"), 1)
    sink = PL.index_sink(store, at["tsv"], at["fwd"], now=_now())
    for n in range(4):
        rows.filter(F.col("arrival") == n).drop("arrival").write.mode("append").json(at["in"])
        run = lambda: PL.start_classify_stream(spark, at["in"], at["out"], at["ckpt"], _scorer(spark),
                                               files_per_trigger=1_000_000, on_batch=sink).awaitTermination()
        try:
            run()
        except StreamingQueryException as e:
            if "writer lost" not in str(e):
                raise
            run()
    final = store.current_committed("final_collection", schemas.FINAL_COLLECTION)
    scores = store.current_committed("scores", schemas.SCORES)
    overrides = store.read_committed("overrides", schemas.OVERRIDES).select(F.col("id").alias("overrides_id"), "override")
    tsv = store.committed_files(lambda p: spark.read.schema(
        ", ".join(f"{c} string" for c in C.OUTPUT_HEADER) + ", batch long, output_path string").option("sep", "\t").option(
        "header", True).option("multiLine", True).option("escape", '"').csv(p), at["tsv"])
    sent = store.committed_files(lambda p: spark.read.schema(
        "bibcode string, scix_id string, status string, collections array<string>, batch long").json(p), at["fwd"])
    none = F.lit(None)
    cols = ["bibcode", "scix_id"]
    parts = [
        final.join(scores.select(F.col("id").alias("score_id"), "run_id"), "score_id").select(
            F.lit("final").alias("kind"), none.cast("long").alias("arrival"), *cols, "run_id",
            F.array_join("collection", "|").alias("collections"),
            F.when(F.col("validated"), "validated").otherwise("open").alias("status"), none.cast("double").alias("s0"),
            none.cast("string").alias("output_path")),
        scores.join(overrides, "overrides_id", "left").select(
            F.lit("score"), none, *cols, "run_id", F.array_join("override", "|"), none,
            r6(F.element_at(F.from_json("scores", "scores map<string,double>")["scores"], C.LABELS[0])), none),
        tsv.select(F.lit("tsv"), "batch", *cols, F.col("run_id").cast("long"), "collections", none, none, "output_path"),
        sent.select(F.lit("response"), "batch", *cols, none, F.array_join("collections", "|"), "status", none, none)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _claims_events(spark, d):
    v = view(spark, d, "v_claims")
    return v.select("fp", "event_id", F.col("ts_s").cast("double").alias("ts"), "op")


_CLAIMS_SQL = duck_cte("v_claims").replace("with ", "with recursive ", 1) + """,
ev as (select fp, event_id, ts_s::double as ts, op, split_part(op, ':', 2) as target, op like 'mark:%' as mark,
  case split_part(op, ':', 2) when 'classify_inflight' then 300 else 120 end as lease,
  row_number() over (partition by fp order by ts_s, event_id) as n from v_claims),
st as (
 select fp, n, event_id, ts, op, true as granted, target as stage, case when not mark then ts + lease end as lease_until
 from ev where n = 1
 union all
 select fp, n, event_id, ts, op, granted, case when granted then target else stage end,
  case when mark then null when granted then ts + lease else lease_until end
 from (select e.*, s.stage, s.lease_until, case when e.mark then true
   when s.stage = 'classify_done' then e.target = 'index_inflight'
   when s.stage in ('classify_inflight', 'index_inflight') then e.target = s.stage and coalesce(s.lease_until, 0) <= e.ts
   else false end as granted
  from ev e join st s on s.fp = e.fp and e.n = s.n + 1) x)
"""


@register("h02_claim_stage", _CLAIMS_SQL + "select fp, event_id, op, granted, stage from st")
def h02(spark, d):
    return CL.claims_batch(_claims_events(spark, d)).select("fp", "event_id", "op", "granted", "stage")


_H02C_SRC = """(select *, case when event_id % 5 = 0 then null else 'out' || (event_id % 2)::varchar end as output_path,
 case when event_id % 7 = 0 then 'classify' else 'pre_ingest' end as operation_step from v_claims) src"""


@register("h02c_claim_pipeline", duck_cte("v_claims").replace("with ", "with recursive ", 1) + f""",
src as (select * from {_H02C_SRC}),
ev as (select output_path, fp, event_id, ts_s::double as ts, op, split_part(op, ':', 2) as target, op like 'mark:%' as mark,
  case split_part(op, ':', 2) when 'classify_inflight' then 300 else 120 end as lease,
  row_number() over (partition by output_path, fp order by ts_s, event_id) as n from src
  where operation_step = 'pre_ingest' and output_path is not null),
st as (
 select output_path, fp, n, event_id, op, true as granted, target as stage, case when not mark then ts + lease end as lease_until
 from ev where n = 1
 union all
 select output_path, fp, n, event_id, op, granted, case when granted then target else stage end,
  case when mark then null when granted then ts + lease else lease_until end
 from (select e.*, s.stage, s.lease_until, case when e.mark then true
   when s.stage = 'classify_done' then e.target = 'index_inflight'
   when s.stage in ('classify_inflight', 'index_inflight') then e.target = s.stage and coalesce(s.lease_until, 0) <= e.ts
   else false end as granted
  from ev e join st s on s.output_path = e.output_path and s.fp = e.fp and e.n = s.n + 1) x)
select output_path, fp, event_id, op, granted, stage, lease_until from st
union all select output_path, fp, event_id, op, true, null, null from src
where operation_step <> 'pre_ingest' or output_path is null""")
def h02c(spark, d):
    """Claims of both stages per output path; rows without one always pass."""
    v = view(spark, d, "v_claims")
    path = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("out"), (F.col("event_id") % 2).cast("string")))
    step = F.when(F.col("event_id") % 7 == 0, "classify").otherwise("pre_ingest")
    ev = v.select("fp", "event_id", F.col("ts_s").cast("double").alias("ts"), "op", path.alias("output_path"),
                  step.alias("operation_step"))
    return CL.claims_by_output(ev).select("output_path", "fp", "event_id", "op", "granted", "stage", "lease_until")


@register("h02b_claim_stage_stream", _CLAIMS_SQL + "select fp, event_id, op, granted, stage from st")
def h02b(spark, d):
    out = CL.claims_replay(_claims_events(spark, d), scratch_dir(spark, "h02"))
    return out.select("fp", "event_id", "op", "granted", "stage")


@register("h03_mark_stage", _CLAIMS_SQL + """select fp, stage, lease_until from st
qualify row_number() over (partition by fp order by n desc) = 1""")
def h03(spark, d):
    return CL.final_states(CL.claims_batch(_claims_events(spark, d)))


@register("h04_replay_dedupe", duck_cte("v_requests") + f"""
select distinct sha256(case
 when coalesce(scix_id,'') <> '' then concat_ws('|', {_norm_sql("run_txt")}, 'scix_id', {_norm_sql("scix_id")})
 when coalesce(bibcode,'') <> '' then concat_ws('|', {_norm_sql("run_txt")}, 'bibcode', {_norm_sql("bibcode")})
 else concat_ws('|', {_norm_sql("run_txt")}, 'text', {_norm_sql("title")}, {_norm_sql("abstract")}) end)
 as fingerprint
from (select *, {_REQ_IDS}, case when batch_id = 0 then '' else cast(batch_id as varchar) end as run_txt
      from v_requests) r""")
def h04(spark, d):
    r = _requests_split(spark, d).withColumn("run_id", F.col("batch_id"))
    doubled = r.unionByName(r)
    return PL.drop_replays(doubled).select("fingerprint")


@register("h05_stream_events", _EV + """
select run_id, stage, count(*) as count, round(quantile_cont(duration_ms, 0.5), 6) as p50,
 round(quantile_cont(duration_ms, 0.95), 6) as p95 from v_perf_events group by run_id, stage""")
def h05(spark, d):
    base = scratch_dir(spark, "h05")
    _events_jsonl(spark, d, os.path.join(base, "in"))
    q = PL.start_event_stream(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                              os.path.join(base, "ckpt"), RD.PERF_EVENT)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    return _r6_all(out, ["p50", "p95"])
