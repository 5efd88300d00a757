"""Near duplicates by SimHash with pivot distance tables.

Fingerprints: 64 majority bits over the XXH64 hashes of a text's word
shingles.  Linking: the Hamming distances of every distinct fingerprint to a
fixed set of reference fingerprints ("pivots") are computed once, per 16-bit
segment and in total.  Two fingerprints within ``max_bits`` agree in at least
``4 - max_bits`` segments, and there their pivot distances are equal, so those
segments' rows of the table are the lookup key; of the pairs a key brings
together, those whose total distances differ by more than ``max_bits`` to any
pivot are discarded (triangle inequality), and the rest are verified bit by
bit.  Copies share one fingerprint, so pairs are between distinct fingerprints
only; components are found over the links.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelweave.llm.common import ROW, drop_stage, join_groups, keep_rows, with_row_identity, write_stage

SEGMENTS, SEGMENT_BITS, PIVOTS = 4, 16, 12
#: Above this many fingerprints under one key, single-bit variants of the
#: fingerprints are matched instead of pairs (same links, linear work).
BUCKET_LIMIT = 256
_STEP = 1 << 16


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: the first 8 bytes of MD5 of their number."""
    return [int.from_bytes(hashlib.md5(b"pivot %d" % i).digest()[:8], "big") for i in range(n)]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole text (unsigned).  A-Z are lower-cased, words
    are separated by ASCII white space; fewer words than a shingle count as
    one shingle; no word (null or empty text) gives 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _STEP):
        part = hashes[i:i + _STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_rows(rows: DataFrame, shingle: int = 3) -> DataFrame:
    """``row_file, row_index, doc_id, fp`` of ``rows`` (``with_row_identity``)."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([signed(fingerprint(t, shingle)) for t in texts], dtype="int64")
    return rows.select(*ROW, F.col("doc.doc_id").alias("doc_id"), fp(F.col("doc.text")).alias("fp"))


def _segment_mask(i: int) -> int:
    return signed(((1 << SEGMENT_BITS) - 1) << (SEGMENT_BITS * i))


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fp``, ``to`` (distance to each pivot) and ``seg`` (per segment, its
    distances to all pivots packed into a long, 5 bits each)."""
    refs = pivots()

    def packed(i):
        near = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(p))).bitwiseAND(F.lit(_segment_mask(i)))).cast("long")
                for p in refs]
        return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(c, 5 * k) for k, c in enumerate(near)])
    return fps.select("fp", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(p)))).cast("byte") for p in refs])
                      .alias("to"), F.array(*[packed(i) for i in range(SEGMENTS)]).alias("seg"))


def links(fps: DataFrame, max_bits: int = 2, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints (column ``fp``) that join all
    fingerprints at ``max_bits`` or fewer differing bits: every pair of a key
    within ``limit``; for larger keys, pairs from each fingerprint to the
    smallest one that shares a single-bit variant with it (for 1 bit: to the
    one that is the variant)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    same = list(combinations(range(SEGMENTS), SEGMENTS - 2))
    table = pivot_table(fps)
    keyed = table.select("fp", "to", F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), *[F.get("seg", F.lit(i)).alias(f"k{n}") for n, i in enumerate(pair)])
        for c, pair in enumerate(same)])).alias("key")).select("fp", "to", "key.*")
    keys = ["c", "k0", "k1"]
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared, path = write_stage(keyed.join(sizes, keys), "shared")
    few = shared.filter(F.col("n") <= limit)
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (few.select(*keys, F.col("fp").alias("a"), F.col("to").alias("ta"))
             .join(few.select(*keys, F.col("fp").alias("b"), F.col("to").alias("tb")), keys)
             .filter("a < b")
             .filter(F.forall(F.zip_with("ta", "tb", lambda x, y: F.abs(x - y) <= max_bits), lambda ok: ok))
             .filter(differ <= max_bits).select("a", "b"))
    free = [[s * SEGMENT_BITS + k for s in range(SEGMENTS) if s not in pair for k in range(SEGMENT_BITS)] for pair in same]
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << b)) for b in bits]) for bits in free])
    variants = shared.filter(F.col("n") > limit).select(
        *keys, "fp", F.explode(F.get(flips, F.col("c"))).alias("flip")).select(
        *keys, "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"))
    # a variant is shared by at most one fingerprint more than it has free bits
    shared_by = Window.partitionBy(*keys, "near")
    centre = F.min("fp").over(shared_by) if max_bits == 2 else F.max(F.when(F.col("fp") == F.col("near"), F.col("fp"))).over(shared_by)
    stars = (variants.select(centre.alias("x"), F.col("fp").alias("y")).filter("x <> y")
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter(differ <= max_bits))
    out, _ = write_stage(pairs.unionByName(stars).distinct(), "links")
    drop_stage(fps.sparkSession, path)
    return out


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of the undirected edges ``a, b``: comp is
    the smallest node reachable.  Each round takes the smallest label among a
    node's neighbours and then the label of that label; rounds are written
    tables, and end when nothing changes."""
    spark = edges.sparkSession
    both, both_path = write_stage(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))), "edges")
    labels, path = write_stage(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                               .select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("v"), "comp"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("m")))
        low, low_path = write_stage(labels.join(near, "node").select(
            "node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp")), "labels")
        root = low.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        new, new_path = write_stage(low.join(root, "comp").select(
            "node", F.col("root").alias("comp"), (F.col("root") != F.col("old")).alias("moved")), "labels")
        drop_stage(spark, path, low_path)
        labels, path = new.select("node", "comp"), new_path
        if new.filter("moved").isEmpty():
            drop_stage(spark, both_path)
            return labels


def near_duplicates(rows: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``rows`` (``with_row_identity`` of documents with
    ``doc_id``, ``text`` and any further columns): ``row_file, row_index,
    doc_id, fp, component_id, first``.

    ``component_id`` is the smallest doc_id of the rows linked directly or
    through others (null only if all of them are null); ``first`` marks the
    one row that stands for the component: smallest doc_id, then file and
    position, null ids last.  Texts without words share fingerprint 0; a text
    of any length is read whole; an empty table gives an empty result."""
    prints, _ = write_stage(fingerprint_rows(rows, shingle), "fingerprints")
    me = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW)
    fps, fps_path = write_stage(prints.groupBy("fp").agg(F.min(me).alias("lead"), F.count(F.lit(1)).alias("rows")), "distinct")
    found = links(fps.select("fp"), max_bits)
    comps = components(found)
    member = fps.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "comp", F.coalesce("comp", "fp"))
    member, member_path = write_stage(member, "member")
    leads, leads_path = write_stage(member.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("first")), "leads")
    classes, _ = write_stage(join_groups(member, leads, ["comp"]).select(
        "fp", F.col("first").alias("lead"), "rows"), "classes")
    drop_stage(rows.sparkSession, member_path, leads_path)
    drop_stage(rows.sparkSession, fps_path)
    return join_groups(prints, classes, ["fp"], "rows").select(
        *ROW, "doc_id", "fp", F.col("lead.doc_id").alias("component_id"), (me == F.col("lead")).alias("first"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` (all columns) with one row of each component."""
    rows = with_row_identity(docs)
    dropped, _ = write_stage(near_duplicates(rows, shingle, max_bits).filter(~F.col("first")).select(*ROW), "dropped")
    return keep_rows(rows, dropped)
