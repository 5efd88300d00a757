"""Registered queries of the operators in this subpackage (whole tables,
production parameters) and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelweave.llm import (exact_dedup, langid, merkle, mixing, packing, pieces, pii, prefix_trie, quality, sharding,
                            simhash, tokenfile, topk)
from labelweave.llm.common import utf8_size, with_row_identity
from labelweave.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_mixing", """
with recursive sizes as (
 select source, sum(coalesce(strlen(text), 0) + 1)::bigint as size from documents group by source),
total as (select sum(size)::double as t, count(*)::double as w from sizes),
rates as (
 select source, 1.0::double * t * (1.0::double / w) / size as rate,
  greatest(1, ceil(1.0::double * t * (1.0::double / w) / size / 16))::int as parts from sizes, total),
terms(source, mean, k, p, c) as (
 select source, rate / parts, 0, exp(-(rate / parts)), exp(-(rate / parts)) from rates
 union all
 select source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) from terms
 where k + 1 < ceil(mean + 12 * sqrt(mean) + 20)),
keyed as (
 select row_number() over () as rowid_, *, coalesce(doc_id::varchar, 'null') || '|' || coalesce(md5(text), 'null') || '|' || (
  row_number() over (partition by doc_id, source, text) - 1)::varchar as key from documents),
draws as (
 select d.rowid_ as r, j, r.source, (('0x' || substr(md5('42|' || d.key || '|' || j::varchar),
   1, 13))::bigint::double + 0.5) / 4503599627370496.0::double as u
 from keyed d join rates r on r.source is not distinct from d.source, unnest(range(1, r.parts + 1)) as x(j)),
counts as (
 select r, count(t.k)::int as copies from draws left join terms t
 on t.source is not distinct from draws.source and draws.u > t.c group by r),
picked as (
 select d.doc_id, d.source, r.rate, c.copies, d.text, d.key from keyed d join counts c on c.r = d.rowid_ join rates r on r.source is not distinct from d.source)
select doc_id, source, rate, copies, copy::int as copy,
 md5('order 42|' || key || '|' || copy::varchar) as shuffle_key,
 coalesce(strlen(text), 0)::bigint as size, md5(text) as text_md5
from picked, unnest(range(1, copies + 1)) as x(copy)""")
def op1(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, d, "documents"))
    return mixed.select("doc.doc_id", "doc.source", "rate", "copies", "copy", "shuffle_key",
                        utf8_size("doc.text").alias("size"), F.md5("doc.text").alias("text_md5"))


@register("op2_langid")
def op2(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc.doc_id", langid.held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score", "spans")


@register("op3_topk", """
with v as (
 select vec_id, [floor(256 * x::double)::bigint for x in embedding] as e from embeddings
 where vec_id is not null and embedding is not null
  and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
 select q.vec_id as query_id, c.vec_id,
  list_sum([q.e[i] * c.e[i] for i in range(1, least(len(q.e), len(c.e)) + 1)])::bigint as score
 from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
ranked as (
 select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
 from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5""")
def op3(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(read_table(spark, d, "embeddings"), F.col("id") % 50 == 0, k=5)


@register("op4_sharding")
def op4(spark: SparkSession, d: str) -> DataFrame:
    placed = sharding.shard_documents(read_table(spark, d, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register("op5_exact_dedup", """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
 doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))""")
def op5(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, d, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op7_quality")
def op7(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    labels = read_table(spark, d, "labels").filter(~quality.held_out(F.col("doc_id")))
    found = quality.score(docs, quality.fit(docs, labels))
    return found.select("doc.doc_id", quality.held_out(F.col("doc.doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op8_pii")
def op8(spark: SparkSession, d: str) -> DataFrame:
    return pii.pii_digest(pii.find_pii(read_table(spark, d, "documents").select("doc_id", "text")))


@register("op6_simhash")
def op6(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(with_row_identity(read_table(spark, d, "documents")), shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op9_tokenfile")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return tokenfile.token_digest(read_table(spark, d, "documents"))


@register("op10_sentencepiece")
def op10(spark: SparkSession, d: str) -> DataFrame:
    return pieces.encode_documents(read_table(spark, d, "documents"))


#: CRC-32 of a string of ASCII letters, bit by bit, in SQL.
_CRC32_SQL = """xor(4294967295, list_reduce(list_concat([4294967295], range(0, 8 * len(s))), lambda c, k: xor(
 xor(c, case when k % 8 = 0 then ascii(substr(s, (k // 8 + 1)::int, 1)) else 0 end) >> 1,
 case when xor(c, case when k % 8 = 0 then ascii(substr(s, (k // 8 + 1)::int, 1)) else 0 end) & 1 = 1
 then 3988292384 else 0 end)))"""


def _crc_sql(text: str) -> str:
    return _CRC32_SQL.replace("(s,", f"({text},").replace("len(s)", f"len({text})")


def _field_sql(c: str) -> str:
    return f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


@register("op11_merkle", f"""
with recursive leaves as (
 select doc_id, dense_rank() over (order by lang nulls first) - 1 as gid, {_leaf_sql("n_chars")} as leaf,
  case when {_crc_sql("doc_id::varchar")} % 7 = 0 then {_leaf_sql("(n_chars + 1)")} else {_leaf_sql("n_chars")} end as given
 from documents),
placed as (select *, row_number() over (partition by gid order by doc_id nulls first, leaf) - 1 as i,
  row_number() over () as r from leaves),
nodes as (
 select gid, 0 as lv, i, leaf as node from placed
 union all
 select gid, lv + 1, i // 2, sha256(string_agg(node, '' order by i))
 from (select *, count(*) over (partition by gid) as c from nodes) where c > 1 group by gid, lv, i // 2),
subroots as (select gid, lv, node from nodes qualify row_number() over (partition by gid order by lv desc) = 1),
tops as (
 select 0 as lv, gid as i, node from subroots
 union all
 select lv + 1, i // 2, sha256(string_agg(node, '' order by i))
 from (select *, count(*) over () as c from tops) where c > 1 group by lv, i // 2),
root as (select lv, node from tops order by lv desc limit 1),
steps as (
 select p.r, n.lv, n.i % 2 = 1 as is_right, coalesce(o.node, '') as other
 from placed p join subroots s using (gid) join nodes n on n.gid = p.gid and n.lv < s.lv and n.i = p.i >> n.lv
 left join nodes o on o.gid = n.gid and o.lv = n.lv and o.i = xor(n.i, 1)
 union all
 select p.r, s.lv + t.lv, t.i % 2 = 1, coalesce(o.node, '')
 from placed p join subroots s using (gid) join root on true join tops t on t.lv < root.lv and t.i = p.gid >> t.lv
 left join tops o on o.lv = t.lv and o.i = xor(t.i, 1)),
folds as (
 select r, 0 as lv, given as node from placed
 union all
 select f.r, f.lv + 1, sha256(case when s.is_right then s.other || f.node else f.node || s.other end)
 from folds f join steps s on s.r = f.r and s.lv = f.lv),
folded as (select r, arg_max(node, lv) as node from folds group by r),
proofs as (select r, string_agg(other, '' order by lv) as others from steps group by r)
select p.doc_id, p.leaf, s.node as subroot, root.node as root, sha256(coalesce(o.others, '')) as proof_sha256,
 f.node as folded_root, f.node = root.node as verified
from placed p join subroots s using (gid) join root on true join folded f using (r) left join proofs o using (r)""")
def op11(spark: SparkSession, d: str) -> DataFrame:
    chosen = F.crc32(F.col("doc.doc_id").cast("string").cast("binary")) % 7 == 0
    changed = merkle.leaf(*[F.col(f"doc.{c}") + 1 if c == "n_chars" else F.col(f"doc.{c}") for c in merkle.FIELDS])
    found = merkle.merkle_manifest(read_table(spark, d, "documents"), payload={"tampered": F.when(chosen, changed)})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("siblings"))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@register("op12_prefix_trie", f"""
with turns as (
 select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
  partition by conv_id order by turn nulls first, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
  ) - 1 as place from conversations where conv_id is not null),
convs as (select distinct conv_id, {_crc_sql("conv_id::varchar")} % 4 as h, conv_id - conv_id % 20 as base from turns),
rebuilt as (
 select c.conv_id, 0 as own, place, role, text from convs c join turns t on t.conv_id = c.base and t.place < c.h
 union all select c.conv_id, 1, place, role, text from convs c join turns t on t.conv_id = c.conv_id and t.place >= c.h),
lines as (
 select c.conv_id, coalesce(list(sha256(strlen(role) || ':' || role || text) order by own, place) filter (where place is not null),
  []) as ids, coalesce(list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) order by own, place) filter (
  where place is not null), []) as words from convs c left join rebuilt r using (conv_id) group by c.conv_id),
paths as (
 select conv_id, d as depth, len(ids) as n_turns, md5(array_to_string(ids[1:d], ',')) as key,
  case when d > 0 then md5(array_to_string(ids[1:d - 1], ',')) end as above, case when d > 0 then words[d] else 0 end as words
 from lines, unnest(range(0, len(ids) + 1)) as x(d)),
nodes as (
 select depth, key, any_value(above) as above, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(words) as saved,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n_turns = depth), '')) as ends_sha256
 from paths group by depth, key),
kids as (select depth - 1 as depth, above as key, count(*) as n from nodes where above is not null group by all),
pairs as (select distinct a.depth, a.key, b.depth as below_depth, b.key as below from paths a join paths b
 on b.conv_id = a.conv_id and b.depth >= a.depth),
sums as (
 select p.depth, p.key, count(*) filter (where k.n is null) as n_leaves, sum(n.saved)::bigint as saved_tokens
 from pairs p join nodes n on n.depth = p.below_depth and n.key = p.below
 left join kids k on k.depth = p.below_depth and k.key = p.below group by p.depth, p.key)
select n.conv_id, n.depth::bigint as depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0) as n_children, s.n_leaves,
 s.saved_tokens, n.ends_sha256
from nodes n join sums s on s.depth = n.depth and s.key = n.key left join kids k on k.depth = n.depth and k.key = n.key
left join nodes u on u.depth = n.depth - 1 and u.key = n.above""")
def op12(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.conversation_trie(read_table(spark, d, "conversations"))


@register("op13_packing")
def op13(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, d, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
