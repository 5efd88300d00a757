"""Derived inputs (``v_*``) built from the given tables.

Each view is one SQL text that Spark and DuckDB both accept.  Spark runs it
through ``spark.sql(text, documents=df, ...)`` (DataFrame parameters, no
global temp views), with the small row multipliers written as generators
(``SPARK_REWRITES``); the oracle inlines the original text as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelweave.session import read_table

_PAD12 = "lpad(cast(doc_id as varchar(20)),12,'0')"
BIBCODE_EXPR = "case when doc_id % 3 <> 0 then '2024Test.' || lpad(cast(doc_id as varchar(20)),10,'0') end"
SCIX_EXPR = (f"case when doc_id % 3 = 0 or doc_id % 4 = 1 then 'scix:' || substr({_PAD12},1,4) || '-' "
             f"|| substr({_PAD12},5,4) || '-' || substr({_PAD12},9,4) end")

VIEW_SQL = {
    # every text whole, then extra requests that lack a title or an abstract
    "v_requests": f"""
select input_index, cast(floor(input_index/100) as bigint) as batch_id,
 case when doc_id % 10 = 9 then 'bad' || {_PAD12}
  when doc_id % 3 = 0 then 'scix:' || substr({_PAD12},1,4) || '-' || substr({_PAD12},5,4) || '-' || substr({_PAD12},9,4)
  else '2024Test.' || lpad(cast(doc_id as varchar(20)),10,'0') end as identifier, title, abstract
from (select doc_id, doc_id as input_index, substr(text,1,40) as title, substr(text,41) as abstract from {{documents}}
 union all select doc_id, 1000000000 + doc_id, null, substr(text,41) from {{documents}} where doc_id % 17 = 0
 union all select doc_id, 2000000000 + doc_id, substr(text,1,40), null from {{documents}} where doc_id % 23 = 0) q""",
    "v_scored": "select doc_id as input_index, doc_id, "
                + ", ".join(f"cast((doc_id*{37 + k} + n_chars*{11 + 2 * k}) % 997 as double)/997e0 as s{k}"
                            for k in range(8))
                + f", {BIBCODE_EXPR} as bibcode, {SCIX_EXPR} as scix_id from {{documents}}",
    "v_overrides": f"""
select doc_id, v, 1704067200 + doc_id*60 + v as created_s,
 case when v = 1 then 'general' when toxic = 1 then 'Text Garbage'
  when quality = 1 and doc_id % 4 = 0 then 'Astrophysics,physics' when quality = 1 then '' else 'Nope' end as override_csv,
 {BIBCODE_EXPR} as bibcode, {SCIX_EXPR} as scix_id
from {{labels}} cross join (select 0 as v union all select 1 as v) t where v = 0 or doc_id % 5 = 0""",
    "v_final": f"""
select doc_id*2 + d as id, doc_id, d, doc_id*10 + doc_id % 3 as score_id, doc_id % 3 as run_id,
 1704067200 + doc_id*60 - d as created_s, (doc_id % 2 = 0) as validated,
 case when doc_id % 2 = 0 and doc_id % 11 <> 0 then 1717459200 - (doc_id % 30)*86400 end as validated_at_s,
 {BIBCODE_EXPR} as bibcode, {SCIX_EXPR} as scix_id
from {{documents}} cross join (select 0 as d union all select 1 as d) t where d = 0 or doc_id % 7 = 0""",
    "v_scores": f"""
select doc_id*10 + r as id, doc_id, r as run_id,
 {BIBCODE_EXPR} as bibcode, {SCIX_EXPR} as scix_id,
 'p' || cast(doc_id % 50 as varchar(20)) as payload,
 case when doc_id % 2 = 0 then doc_id * 2 end as overrides_id, 1704067200 + doc_id*60 + r as created_s
from {{documents}} cross join (select 0 as r union all select 1 as r union all select 2 as r) t where r <= doc_id % 3""",
    "v_perf_events": """
select event_id, 1704067200e0 + event_id as ts, cast(user_id % 4 as varchar(20)) as run_id, value as duration_ms,
 case event_id % 9 when 0 then 'ingest_enqueue' when 1 then 'classify' when 2 then 'index_db' when 3 then 'index'
  when 4 then 'forward' when 5 then 'task_timing' when 6 then 'app_timing' when 7 then 'classifier_timing'
  else 'classifier_batch_shape' end as stage,
 case when event_type = 'error' and event_id % 5 = 0 then 'error' else 'ok' end as status,
 event_id % 8 as record_count, (event_id % 2 = 0) as batch_mode, event_type as name
from {events}""",
    "v_system_samples": """
select event_id, 1704067200e0 + event_id as ts, cast(user_id % 4 as varchar(20)) as run_id, value/100e0 as normalized_load_1m,
 case when event_id % 300 = 0 then null else value/120e0 end as normalized_load_5m, value/150e0 as normalized_load_15m,
 cast(event_id % 97 as double)/97e0 as memory_available_ratio
from {events}""",
    "v_claims": """
select event_id, user_id % 50 as fp, event_id*20 as ts_s,
 case event_id % 4 when 0 then 'claim:classify_inflight' when 1 then 'mark:classify_done'
  when 2 then 'claim:index_inflight' else 'mark:indexed_done' end as op
from {events}""",
}

_SOURCES = {
    "v_requests": ["documents"], "v_scored": ["documents"], "v_overrides": ["labels"], "v_final": ["documents"],
    "v_scores": ["documents"], "v_perf_events": ["events"], "v_system_samples": ["events"], "v_claims": ["events"],
}

NOW_S = 1717459200  # fixed "now" of the look-back fixtures (2024-06-04 UTC)


# Spark spells the small row multipliers as a generator instead of a join
# with a literal table (same rows, no nested-loop join in the plan).
SPARK_REWRITES = [
    ("cross join (select 0 as v union all select 1 as v) t", "lateral view explode(array(0, 1)) t as v"),
    ("cross join (select 0 as d union all select 1 as d) t", "lateral view explode(array(0, 1)) t as d"),
    ("cross join (select 0 as r union all select 1 as r union all select 2 as r) t",
     "lateral view explode(array(0, 1, 2)) t as r"),
]


def spark_sql_text(name: str) -> str:
    text = VIEW_SQL[name]
    for old, new in SPARK_REWRITES:
        text = text.replace(old, new)
    return text


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {t: read_table(spark, sf_dir, t) for t in _SOURCES[name]}
    df = spark.sql(spark_sql_text(name), **tables)
    if name == "v_scored":
        df = df.withColumn("scores", F.array(*[F.col(f"s{k}") for k in range(8)]))
    return df


def duck_cte(*names: str) -> str:
    """``WITH`` clause defining the named views for the DuckDB oracle."""
    parts = []
    for n in names:
        body = VIEW_SQL[n].replace("{{", "{").replace("}}", "}")
        for t in _SOURCES[n]:
            body = body.replace("{" + t + "}", t)
        if n == "v_scored":
            body = f"select *, [s0,s1,s2,s3,s4,s5,s6,s7] as scores from ({body}) q"
        parts.append(f"{n} as ({body})")
    return "with " + ",\n".join(parts) + "\n"
