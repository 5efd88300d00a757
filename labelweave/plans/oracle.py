"""DuckDB SQL fragments shared by oracle statements (the oracle is a
second, independent formulation of each query used by the correctness gate)."""

from __future__ import annotations

from labelweave import config as C

LABELS_SQL = "[" + ", ".join("'" + x + "'" for x in C.LABELS) + "]"
THRESH_SQL = "[" + ", ".join(repr(float(x)) for x in C.THRESHOLDS) + "]"
BIAS_SQL = "[" + ", ".join(repr(float(x)) for x in C.MODEL_BIAS) + "]"


def tokens_sql(text: str) -> str:
    return ("list_filter(regexp_split_to_array(translate(" + text + ", '" + C.UPPER_ASCII + "', '"
            + C.LOWER_ASCII + "'), '" + C.TOKEN_SEPARATORS + "'), lambda t: t <> '')")


def token_ids_sql(text: str) -> str:
    return "list_transform(" + tokens_sql(text) + ", lambda t: ('0x' || substr(md5(t),1,8))::BIGINT)"


def scores_ctes(src: str, key: str = "input_index", text: str = "text", window: int = C.SCORING_WINDOW,
                stride: int = C.SCORING_STRIDE, pooling: str = "max", cover_tail: bool = True) -> str:
    """CTEs ending in ``o_scores(<key>, scores)`` for the hashed linear model;
    windows reach the last token, or are len // stride (the source rule)."""
    count = (f"1 + (greatest(0, len(ids) - {window}) + {stride} - 1) // {stride}" if cover_tail
             else f"greatest(1, len(ids) // {stride})")
    agg = "max" if pooling == "max" else "avg"
    return f"""
o_ids as (select {key}, {token_ids_sql(text)} as ids from {src}),
o_win as (select {key}, ids, unnest(range(0, {count})) as chunk from o_ids),
o_chunks as (select {key}, chunk, list_slice(ids, chunk*{stride}+1, chunk*{stride}+{window}) as w from o_win),
o_toks as (select {key}, chunk, unnest(w) as tok from o_chunks),
o_wts as (select b.range as bucket, l.range as label,
          ((b.range*(2*l.range+3) + 7*l.range) % 199 - 99)/99e0 as wt from range({C.N_BUCKETS}) b, range(8) l),
o_sw as (select t.{key}, t.chunk, w.label, sum(w.wt) as sw from o_toks t join o_wts w on w.bucket = t.tok % {C.N_BUCKETS}
         group by all),
o_nt as (select {key}, chunk, count(*) as n_tok from o_toks group by all),
o_agg as (select c.{key}, c.chunk, l.range as label, coalesce(s.sw, 0) as sw, coalesce(n.n_tok, 0) as n_tok
          from o_chunks c cross join range(8) l
          left join o_sw s on s.{key} = c.{key} and s.chunk = c.chunk and s.label = l.range
          left join o_nt n on n.{key} = c.{key} and n.chunk = c.chunk),
o_probs as (select {key}, chunk, label,
            1/(1+exp(-({BIAS_SQL}[label+1] + {C.MODEL_SCALE}*sw/greatest(n_tok,1)))) as p from o_agg),
o_pooled as (select {key}, label, {agg}(p) as p from o_probs group by all),
o_scores as (select {key}, list(p order by label) as scores from o_pooled group by {key})
"""


def collections_sql(scores: str) -> str:
    return (f"list_transform(list_filter(range(0, 8), lambda i: {scores}[i+1] > {THRESH_SQL}[i+1]), "
            f"lambda i: {LABELS_SQL}[i+1])")


def collection_scores_sql(scores: str) -> str:
    return (f"list_transform(list_filter(range(0, 8), lambda i: {scores}[i+1] > {THRESH_SQL}[i+1]), "
            f"lambda i: round({scores}[i+1], 2))")


def summary_sql(scores: str) -> str:
    r = [f"coalesce(round({scores}[{i + 1}], 2), 0.0)" for i in range(8)]
    astro = f"round(greatest({r[0]}, {r[1]}, {r[2]}), 2)"
    gen = f"round(greatest({r[3]}, {r[4]}, {r[6]}), 2)"
    phys = r[5]
    gross = (f"case when {astro} >= {phys} and {astro} >= {gen} then 'astronomy' "
             f"when {phys} >= {gen} then 'physics' else 'general' end")
    names = ["astrophysics_score", "heliophysics_score", "planetary_science_score", "earth_science_score",
             "biology_score", "physics_score", "other_score", "garbage_score"]
    cols = [f"{r[i]} as {names[i]}" for i in range(8)]
    return ", ".join(cols + [f"{astro} as astronomy_score", f"{gen} as general_score", f"{gross} as gross_collection"])


def prepared_ctes(window: int = 510, stride: int = 500, batch: int = 100, micro: int = 16) -> str:
    """documents -> ids, rows (C2+C3), record stats (C4), group rank (C5),
    micro batch (C6) as DuckDB CTEs ``o_ids .. o_mb``."""
    return f"""
o_ids as (select doc_id, doc_id // {batch} as batch_id, {token_ids_sql('text')} as ids from documents),
o_rows as (select *, list_transform(range(0, greatest(1, len(ids) // {stride})),
  lambda i: list_slice(ids, i*{stride}+1, i*{stride}+{window})) as wins from o_ids),
o_wr as (select *, list_transform(wins, lambda x: list_concat([101::BIGINT], x, [102::BIGINT])) as wr from o_rows),
o_prep as (select doc_id, batch_id, ids, wins, list_transform(range(0, len(wr)), lambda i: case when i = len(wr) - 1
  then list_resize(wr[i+1], greatest(len(wr[i+1]), len(wr[1])), 0::BIGINT) else wr[i+1] end) as rows from o_wr),
o_stats as (select *, len(rows) as chunk_count, list_max(list_transform(rows, lambda r: len(r))) as max_row_width,
  list_sum(list_transform(rows, lambda r: len(r))) as total_row_tokens,
  list_sum(list_transform(rows, lambda r: len(list_filter(r, lambda x: x <> 0)))) as active_tokens from o_prep),
o_rank as (select *, row_number() over (partition by batch_id order by max_row_width, chunk_count, doc_id)
  as group_rank from o_stats),
o_mb as (select *, (group_rank - 1) // {micro} as micro_batch from o_rank)
"""
