"""Exact deduplication by deterministic block naming.

Every text is cut into fixed-size blocks; distinct blocks are sorted into
integer names; adjacent names are paired and the distinct pairs named again,
until each document has a single name.  A document's identity is
``(level, name)``.  Names are given by sorting the contents themselves, not
by a digest, so two documents share an identity only if their texts are
equal.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelweave.llm.common import ROW, drop_stage, join_groups, keep_rows, with_row_identity, write_stage

BLOCK_CHARS = 4096
BUCKETS = 1 << 20


def sorted_names(keys_seen: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``keys_seen`` (one row per key) with ``name``: different keys get
    different integers.  Keys are sorted inside hash buckets; the name is
    ``rank * buckets + bucket``, a function of the data alone (a recomputed
    task gives the same names).  Columns ``hash`` and ``twins`` (keys with the
    same hash) tell where the hash alone stands for the key."""
    bucketed = keys_seen.withColumn("hash", F.xxhash64(*keys)).withColumn("_bucket", F.pmod("hash", F.lit(buckets)))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("hash", *keys)).cast("long") - 1
    twins = F.count(F.lit(1)).over(Window.partitionBy("_bucket", "hash"))
    return bucketed.withColumn("twins", twins).withColumn("name", rank * buckets + F.col("_bucket")).drop("_bucket")


def document_identities(rows: DataFrame, block_chars: int = BLOCK_CHARS, buckets: int = BUCKETS) -> DataFrame:
    """One row per document of ``rows`` (``with_row_identity``): ``row_file, row_index, doc_id, text_sha256,
    level, name``; ``(level, name)`` is equal exactly for equal texts.

    Null text counts as empty; a text shorter than a block is one block.
    Distinct blocks are named by their contents; a block then finds its name
    by its hash, or by its contents where two blocks share a hash."""
    spark = rows.sparkSession
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    cut = F.when(text == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % block_chars), F.lit(0)))
    pieces = rows.select(*ROW, F.col("doc.doc_id").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), cut.alias("blocks"))
    blocks = pieces.select(*ROW, "doc_id", "text_sha256", F.size("blocks").cast("long").alias("left"),
                           F.posexplode("blocks").alias("pos", "block"))
    entry = [*ROW, "doc_id", "text_sha256", "left", "pos"]
    # copies of a block meet after a partial aggregate, one row per task
    seen = sorted_names(blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n")), ["block"], buckets)
    names, names_path = write_stage(seen.withColumn("block", F.when(F.col("twins") > 1, F.col("block"))), "names")
    entries, entries_path = write_stage(blocks.select(*entry, F.xxhash64("block").alias("hash")), "entries")
    named = join_groups(entries, names.filter("twins = 1").select("hash", "name", "n"), ["hash"]).select(*entry, "name")
    if not names.filter("twins > 1").isEmpty():
        named = named.unionByName(blocks.join(names.filter("twins > 1").select("block", "name"), "block").select(*entry, "name"))
    named, path = write_stage(named, "named")
    drop_stage(spark, names_path, entries_path)
    paths, level, done = [path], 0, []
    while True:
        done.append(named.filter("left = 1").select(*ROW, "doc_id", "text_sha256", F.lit(level).alias("level"), "name"))
        rest = named.filter("left > 1")
        if (rest.agg(F.max("left")).first()[0] or 1) == 1:
            break
        half = F.expr("pos % 2 = 0")
        pairs, pairs_path = write_stage(
            rest.groupBy(*ROW, F.expr("cast(pos div 2 as int)").alias("pos"))
                .agg(F.max(F.when(half, F.col("name"))).alias("a"),
                     F.coalesce(F.max(F.when(~half, F.col("name"))), F.lit(-1)).alias("b"),
                     F.max("doc_id").alias("doc_id"), F.max("text_sha256").alias("text_sha256"),
                     F.max(F.expr("(left + 1) div 2")).alias("left")), "pairs")
        names, names_path = write_stage(sorted_names(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), ["a", "b"], buckets)
                                        .select("a", "b", "name", "n"), "names")
        named, path = write_stage(join_groups(pairs, names, ["a", "b"]).select(*entry, "name"), "named")
        drop_stage(spark, pairs_path, names_path)
        paths.append(path)
        level += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out, _ = write_stage(out, "identities")
    drop_stage(spark, *paths)
    return out


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document of ``docs`` (``doc_id``, ``text`` and any further
    columns): ``row_file, row_index, doc_id, keep_id, group_size, kept,
    text_sha256``.

    Of equal texts the row with the largest doc_id stays; of rows that repeat
    that doc_id, the last in (file, position); a null doc_id is smaller than
    any other.  Null and empty texts are equal; a text of any length is
    compared whole.  An empty table gives an empty result."""
    return dedup_rows(with_row_identity(docs), block_chars)


def dedup_rows(rows: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``exact_dedup`` of rows that carry their identity already."""
    ids = document_identities(rows, block_chars)
    me = F.struct("doc_id", *ROW)
    groups, _ = write_stage(ids.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(me).alias("keep")), "groups")
    out = join_groups(ids, groups, ["level", "name"], "group_size")
    return out.select(*ROW, "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                      (F.struct("doc_id", *ROW) == F.col("keep")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one row of each group of equal texts."""
    rows = with_row_identity(docs)
    dropped, _ = write_stage(dedup_rows(rows).filter(~F.col("kept")).select(*ROW), "dropped")
    return keep_rows(rows, dropped)
