"""Prefix trie of conversations from padded turn-id matrices.

A turn's id is the 128-bit prefix of the SHA-256 of its role and text.
Conversations are range-sharded by their id sequences; a shard is a matrix
with a row per conversation, padded to its longest one.  numpy sorts the rows,
marks where a column changes, and OR-accumulates the marks from left to right,
so that a mark in column d starts a node of depth d; ``reduceat`` over these
starts gives every depth's aggregates.  Only nodes that hold a shard's first or
last row can go on in a neighbour: those partial nodes carry the digest of
their prefix and are recombined.

A matrix is ``BAND`` turns wide.  Conversations that still share a prefix at
the end of a band go on in a matrix of the next one, under their common node;
what one conversation alone goes on with is a plain path and needs no matrix.
So memory follows neither the length of a conversation nor the size of a group
of copies.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave.llm.common import ROW, drop_stage, with_row_identity, write_stage
from labelweave.operators.requests import ranked

#: Turns of a matrix, and conversations of a shard (on average).
BAND, SHARD_ROWS = 32, 1 << 16
STRIDE, SHARED_TURNS = 20, 4
NO_ENDS = hashlib.sha256(b"").hexdigest()
_WORD = r"[^\x20\x09-\x0D]+"


# ----------------------------------------------------------------- turns ----
def turn_rows(conversations: DataFrame) -> DataFrame:
    """Written ``conv_id, place, hi, lo, words``: every turn's place in its
    conversation (by turn, null first; equal turns by their ids, then file and
    position), its id as two longs and the words of its text."""
    role, text = (F.coalesce(F.col(f"doc.{c}").cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    half = [F.conv(F.substring("h", at, 16), 16, -10).cast("long") for at in (1, 17)]
    rows = (with_row_identity(conversations).filter(F.col("doc.conv_id").isNotNull())
            .select(*ROW, F.col("doc.conv_id").cast("long").alias("conv_id"), F.col("doc.turn").alias("turn"), whole.alias("h"),
                    F.size(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))).cast("long").alias("words"))
            .select(*ROW, "conv_id", "turn", half[0].alias("hi"), half[1].alias("lo"), "words"))
    rows, rows_path = write_stage(rows, "turns")
    sorted_rows = ranked(rows, ["conv_id", "turn", "hi", "lo", *ROW])
    # a conversation of many partitions: the turns of its earlier ones (at most one such conversation a border)
    parts = sorted_rows.groupBy("conv_id", "_pid").agg(F.count(F.lit(1)).alias("n"))
    of_conv = Window.partitionBy("conv_id")
    shift = parts.withColumn("parts", F.count(F.lit(1)).over(of_conv)).filter("parts > 1").select(
        "conv_id", "_pid", (F.sum("n").over(of_conv.orderBy("_pid")) - F.col("n")).alias("before"))
    here = F.row_number().over(Window.partitionBy("conv_id", "_pid").orderBy("_local")) - 1
    out, _ = write_stage(sorted_rows.withColumn("here", here).join(shift, ["conv_id", "_pid"], "left").select(
        "conv_id", (F.col("here") + F.coalesce("before", F.lit(0))).alias("place"), "hi", "lo", "words"), "placed")
    drop_stage(conversations.sparkSession, rows_path)
    return out


def rebuilt_turns(turns: DataFrame, stride: int = STRIDE, shared: int = SHARED_TURNS) -> DataFrame:
    """Written ``conv_id, pos, hi, lo, words``: conversation c is the first h
    turns of conversation ``c - c % stride`` and its own after its first h,
    h being the CRC-32 of c's decimal digits modulo ``shared``.  A row with
    pos -1 stands for the conversation itself."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    base = F.col("conv_id") - F.col("conv_id") % stride
    heads, heads_path = write_stage(turns.filter((F.col("conv_id") % stride == 0) & (F.col("place") < shared - 1)), "heads")
    lengths = heads.groupBy(F.col("conv_id").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    convs, convs_path = write_stage(turns.select("conv_id").distinct().select("conv_id", base.alias("base"), h.alias("h"))
                                    .join(lengths, F.col("base") == F.col("of"), "left")
                                    .select("conv_id", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("k")), "convs")
    lent = heads.withColumnRenamed("conv_id", "base").join(convs, "base").filter("place < h").select(
        "conv_id", F.col("place").alias("pos"), "hi", "lo", "words")
    short = convs.filter("k < h").select("conv_id", (F.col("h") - F.col("k")).alias("less"))
    own = turns.withColumn("h", h).filter("place >= h").join(short, "conv_id", "left").select(
        "conv_id", (F.col("place") - F.coalesce("less", F.lit(0))).alias("pos"), "hi", "lo", "words")
    none = F.lit(0).cast("long")
    marks = convs.select("conv_id", F.lit(-1).cast("long").alias("pos"), none.alias("hi"), none.alias("lo"), none.alias("words"))
    out, _ = write_stage(lent.select("conv_id", F.col("pos").cast("long").alias("pos"), "hi", "lo", "words").unionByName(
        own.select("conv_id", F.col("pos").cast("long").alias("pos"), "hi", "lo", "words")).unionByName(marks), "rebuilt")
    drop_stage(turns.sparkSession, heads_path, convs_path)
    return out


# ---------------------------------------------------------------- matrix ----
@dataclass
class Shard:
    """Sorted rows of one band: conversation, group (node at the band's start),
    turns in the band, whether more follow, ids and words by column, and what
    lies below the band's end."""
    conv: np.ndarray
    group: np.ndarray
    length: np.ndarray
    more: np.ndarray
    ids: np.ndarray
    pairs: np.ndarray
    words: np.ndarray
    below: np.ndarray

    @classmethod
    def of(cls, batches) -> "Shard | None":
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return None
        table = pa.Table.from_batches(batches).combine_chunks()
        n = table.num_rows
        conv, group, more = (table.column(c).to_numpy() for c in ("conv_id", "g", "more"))
        below = np.stack([table.column(c).to_numpy() for c in ("kids", "leaves", "saved")], axis=1)
        path, words = (table.column(c).chunk(0) for c in ("path", "words"))
        length = np.diff(words.offsets.to_numpy()).astype(np.int64)
        flat = path.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
        # ids keep their order as small numbers from 1; 0 pads
        order = np.lexsort((flat[:, 1], flat[:, 0]))
        new = np.ones(len(flat), bool)
        new[1:] = (flat[order][1:] != flat[order][:-1]).any(axis=1)
        small = np.empty(len(flat), np.int32)
        small[order] = np.cumsum(new)
        wide = int(length.max())
        ids, counts, pairs = np.zeros((n, wide), np.int32), np.zeros((n, wide), np.int64), np.zeros((n, wide, 2), np.int64)
        row = np.repeat(np.arange(n), length)
        col = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        ids[row, col], pairs[row, col] = small, flat
        counts[row, col] = words.flatten().to_numpy(zero_copy_only=False)
        at = np.lexsort((conv, *ids.T[::-1], group))
        ends = pairs[at[[0, -1]]]
        return cls(conv[at], group[at], length[at], more[at], ids[at], ends, counts[at], below[at])

    def starts(self) -> np.ndarray:
        """Column d marks the rows that begin a run of equal groups and equal
        first d turns."""
        n, wide = self.ids.shape
        mark = np.zeros((n, wide + 1), bool)
        mark[0] = True
        mark[1:, 0] = self.group[1:] != self.group[:-1]
        mark[1:, 1:] = self.ids[1:] != self.ids[:-1]
        return np.logical_or.accumulate(mark, axis=1, out=mark)

    def keys(self, depth0: int) -> tuple[list[bytes], list[bytes]]:
        """Digests of the first and the last row's prefixes, by depth."""
        out = []
        for row, pairs in ((0, self.pairs[0]), (-1, self.pairs[1])):
            h = hashlib.sha256(b"%d %d;" % (depth0, self.group[row]))
            keys = [h.digest()[:16]]
            for pair in pairs[:self.length[row]]:
                h.update(pair.astype("<i8").tobytes())
                keys.append(h.digest()[:16])
            out.append(keys)
        return out[0], out[1]


NODE = pa.schema([("depth", pa.int64()), ("conv_id", pa.int64()), ("parent", pa.int64()), ("parent_key", pa.binary()),
                  ("key", pa.binary()), ("lineage", pa.list_(pa.binary())), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                  ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("words", pa.int64()), ("ends", pa.string()),
                  ("shard", pa.int32())])
NODE_SQL = ("depth long, conv_id long, parent long, parent_key binary, key binary, lineage array<binary>, n_convs long, "
            "n_children long, n_leaves long, saved_tokens long, words long, ends string, shard int")


def shard_nodes(s: Shard, depth0: int, band: int, number: int):
    """Nodes of a shard, a batch per depth.  A node that holds the first or
    last row has a ``key``; its counts leave out such nodes below it and
    itself, and ``ends`` lists its ids in place of their hash."""
    n, wide = s.ids.shape
    mark, (first, last) = s.starts(), s.keys(depth0)
    leaves, saved = s.below[:, 1].copy(), s.below[:, 2].copy()
    kid = np.zeros(n, np.int64)
    kid[:] = np.where(s.length == band, s.below[:, 0], 0)
    levels = {}
    for d in range(wide, -1, -1):
        at = np.flatnonzero(mark[:, d])
        stop = np.append(at[1:], n)
        real = s.length[at] >= d
        edge = (at == 0) | (stop == n)
        size = stop - at
        # a node of depth d ends where its rows have d turns and no more
        over = (s.length == d) & ~s.more
        ended = np.add.reduceat(over.astype(np.int64), at)
        children = np.add.reduceat(kid, at)
        words = s.words[at, d - 1] if d else np.zeros(len(at), np.int64)
        own = real & ~edge & ((d > 0) | (depth0 == 0))
        leaves[at] += own & (children == 0)
        saved[at] += np.where(own, (size - 1) * words, 0)
        # below the root of a later band are its members that go on; its name is its group
        rep = s.group[at] if d == 0 and depth0 else np.minimum.reduceat(s.conv, at)
        levels[d] = (at, stop, real, edge, size, rep, children, np.add.reduceat(leaves, at),
                     np.add.reduceat(saved, at), words, over, ended)
        kid = np.zeros(n, np.int64)
        kid[at[real & ~edge]] = 1
    for d in range(wide + 1):
        at, stop, real, edge, size, rep, children, n_leaves, n_saved, words, over, ended = levels[d]
        key = [None] * len(at)
        lineage = [None] * len(at)
        for i in np.flatnonzero(edge & real):
            line = first if at[i] == 0 else last
            key[i], lineage[i] = line[d], line[:d + 1]
        parent, parent_key = [None] * len(at), [None] * len(at)
        if d:
            up_at, up_stop, _, up_edge, _, up_rep, *_ = levels[d - 1]
            up = np.searchsorted(up_at, at, side="right") - 1
            parent = up_rep[up].tolist()
            parent_key = [(first if a == 0 else last)[d - 1] if r and e else None
                          for r, e, a in zip(real.tolist(), up_edge[up].tolist(), up_at[up].tolist())]
        ids = list(map(str, s.conv[over].tolist()))
        begin = np.cumsum(ended) - ended
        ends = [",".join(ids[b:b + e]) if e else "" for b, e in zip(begin.tolist(), ended.tolist())]
        ends = [x if k is not None else hashlib.sha256(x.encode()).hexdigest() if x else NO_ENDS for x, k in zip(ends, key)]
        keep = np.flatnonzero(real)
        take = pa.array(keep)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(keep), depth0 + d)), pa.array(rep[keep]), pa.array(parent, pa.int64()).take(take),
            pa.array(parent_key, pa.binary()).take(take), pa.array(key, pa.binary()).take(take),
            pa.array(lineage, pa.list_(pa.binary())).take(take), pa.array(size[keep]), pa.array(children[keep]),
            pa.array(n_leaves[keep]), pa.array(n_saved[keep]), pa.array(words[keep]), pa.array(ends, pa.string()).take(take),
            pa.array(np.full(len(keep), number, np.int32))], schema=NODE)


CLASS_SQL = "conv_id long, g long, n long, key binary"


def shard_classes(s: Shard, depth0: int, band: int):
    """For every row that goes on: its node at the band's end (smallest member,
    members that go on, and the digest if the node may reach a neighbour); a
    row without a conversation for each node that may."""
    n, wide = s.ids.shape
    if wide < band:
        return
    (first, last), at = s.keys(depth0), np.flatnonzero(s.starts()[:, band])
    node = np.repeat(np.arange(len(at)), np.diff(np.append(at, n)))
    stop = np.append(at[1:], n)
    rep, going = np.minimum.reduceat(s.conv, at), np.add.reduceat(s.more.astype(np.int64), at)
    mine = node[s.more]
    edge = [i for i in {0, len(at) - 1} if s.length[at[i]] == band]
    held = mine.tolist() + edge
    key = [first[band] if at[i] == 0 else last[band] if stop[i] == n else None for i in held]
    yield pa.record_batch({"conv_id": pa.array(s.conv[s.more].tolist() + [None] * len(edge), pa.int64()),
                           "g": pa.array(rep[held]), "n": pa.array(going[held]), "key": pa.array(key, pa.binary())})


# ------------------------------------------------------------------ bands ----
def _band_rows(rebuilt: DataFrame, groups: DataFrame | None, start: int, band: int) -> DataFrame:
    """``conv_id, g, path, words, more`` of the turns from ``start`` on;
    without ``groups`` every conversation, below the root."""
    inside = rebuilt.filter(F.col("pos") <= start + band)  # one turn beyond tells whether more follow
    inside = inside if groups is None else inside.filter(F.col("pos") >= start).join(groups, "conv_id")
    held = inside.groupBy("conv_id", *([] if groups is None else ["g"])).agg(F.sort_array(F.collect_list(F.struct(
        "pos", "hi", "lo", "words"))).alias("t"))
    turns = F.filter("t", lambda x: (x["pos"] >= start) & (x["pos"] < start + band))
    group = F.lit(0).cast("long") if groups is None else F.col("g")
    return held.select("conv_id", group.alias("g"), F.flatten(F.transform(turns, lambda x: F.array(x["hi"], x["lo"]))).alias(
        "path"), F.transform(turns, lambda x: x["words"]).alias("words"), F.exists(
            "t", lambda x: x["pos"] == start + band).alias("more"))


def _sharded(rows: DataFrame, shard_rows: int, n: int) -> DataFrame:
    return rows.repartitionByRange(max(1, -(-n // shard_rows)), "g", "path", "conv_id")


def _edge_ends(edges: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of recombined nodes: their lists of ids, shard by
    shard, stream through the hash, so a group of copies of any size is never
    held."""
    def run(batches):
        key, h, empty = None, None, True
        for b in batches:
            keys, hashes = [], []
            for k, part in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        hashes.append(h.hexdigest())
                    key, h, empty = k, hashlib.sha256(), True
                h.update((part if empty else "," + part).encode())
                empty = False
            yield pa.record_batch({"key": pa.array(keys, pa.binary()), "ends_sha256": pa.array(hashes, pa.string())})
        if key is not None:
            yield pa.record_batch({"key": pa.array([key], pa.binary()), "ends_sha256": pa.array([h.hexdigest()])})
    return (edges.filter("ends <> ''").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
            .mapInArrow(run, "key binary, ends_sha256 string"))


def _recombine(found: DataFrame, depth0: int) -> DataFrame:
    """Whole nodes from a band's shards."""
    edges = found.filter(F.col("key").isNotNull())
    merged, merged_path = write_stage(edges.groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.first("parent_key").alias("parent_key"),
        F.first("lineage").alias("lineage"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("kids"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("words").alias("words")), "merged")
    more_kids = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("edge_kids"))
    counted, counted_path = write_stage(merged.join(more_kids, "key", "left").withColumn(
        "n_children", F.col("kids") + F.coalesce("edge_kids", F.lit(0))), "counted")
    own = counted if depth0 == 0 else counted.filter(F.col("depth") > depth0)
    up = own.select(F.explode("lineage").alias("key"), (F.col("n_children") == 0).cast("long").alias("l"), (
        (F.col("n_convs") - 1) * F.col("words")).alias("s")).groupBy("key").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    names, names_path = write_stage(counted.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent")), "names")
    whole = (counted.join(up, "key", "left").join(_edge_ends(edges), "key", "left").join(names, "parent_key", "left").select(
        "conv_id", "depth", "parent", "n_convs", "n_children", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))
    inner = (found.filter(F.col("key").isNull()).join(names.withColumnRenamed("parent", "whole_parent"), "parent_key", "left")
             .select("conv_id", "depth", F.coalesce("whole_parent", "parent").alias("parent"), "n_convs", "n_children",
                     "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")))
    out, _ = write_stage(inner.unionByName(whole), "nodes")
    drop_stage(found.sparkSession, merged_path, counted_path, names_path)
    return out


def _tails(rebuilt: DataFrame, alone: DataFrame, depth: int) -> DataFrame:
    """Nodes deeper than ``depth`` of conversations (``conv_id, g``) that share
    them with no other."""
    turns = rebuilt.filter(F.col("pos") >= depth).join(alone, "conv_id")
    length = turns.groupBy("conv_id").agg(F.max("pos").alias("top"))
    one, last = F.lit(1).cast("long"), F.col("pos") == F.col("top")
    return turns.join(length, "conv_id").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), F.when(F.col("pos") == depth, F.col("g")).otherwise(
            F.col("conv_id")).alias("parent"), one.alias("n_convs"), (~last).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
        .otherwise(NO_ENDS).alias("ends_sha256"))


def _band(rebuilt: DataFrame, groups: DataFrame | None, start: int, band: int, shard_rows: int) -> DataFrame:
    """All nodes deeper than ``start`` (from the root on, for the first band)
    and, at depth ``start``, what the groups have below them."""
    spark = rebuilt.sparkSession
    rows, rows_path = write_stage(_band_rows(rebuilt, groups, start, band), "band")
    n, going = rows.agg(F.count(F.lit(1)), F.count_if("more")).first()
    none = F.lit(0).cast("long")
    rows = rows.select("*", none.alias("kids"), none.alias("leaves"), none.alias("saved"))
    deeper = None
    if going:
        def classes(batches):
            s = Shard.of(batches)
            if s is not None:
                yield from shard_classes(s, start, band)
        local, local_path = write_stage(_sharded(rows, shard_rows, n).mapInArrow(classes, CLASS_SQL), "classes")
        whole = local.filter(F.col("key").isNotNull()).groupBy("key").agg(
            F.min("g").alias("whole_g"), F.count("conv_id").alias("whole_n"))
        members, _ = write_stage(local.filter(F.col("conv_id").isNotNull()).join(whole, "key", "left").select(
            "conv_id", F.coalesce("whole_g", "g").alias("g"), F.coalesce("whole_n", "n").alias("n")), "members")
        one = F.lit(1).cast("long")
        alone = members.filter("n = 1").select("conv_id", "g")
        below = alone.select("conv_id", one.alias("kids"), one.alias("leaves"), none.alias("saved"))
        deeper = _tails(rebuilt, alone, start + band)
        shared = members.filter("n > 1").select("conv_id", "g")
        if not shared.isEmpty():
            under = _band(rebuilt, shared, start + band, band, shard_rows)
            bearer = shared.groupBy("g").agg(F.min("conv_id").alias("bearer"))
            below = below.unionByName(under.filter(F.col("depth") == start + band).select(
                F.col("conv_id").alias("g"), "n_children", "n_leaves", "saved_tokens").join(bearer, "g").select(
                F.col("bearer").alias("conv_id"), F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"),
                F.col("saved_tokens").alias("saved")))
            deeper = deeper.unionByName(under.filter(F.col("depth") > start + band))
        rows = rows.drop("kids", "leaves", "saved").join(below, "conv_id", "left").fillna(0, ["kids", "leaves", "saved"])
        drop_stage(spark, local_path)

    def nodes(batches):
        s = Shard.of(batches)
        if s is not None:
            yield from shard_nodes(s, start, band, TaskContext.get().partitionId())
    found, found_path = write_stage(_sharded(rows, shard_rows, n).mapInArrow(nodes, NODE_SQL), "found")
    out = _recombine(found, start)
    drop_stage(spark, found_path, rows_path)
    return out if deeper is None else out.unionByName(deeper)


def prefix_trie(rebuilt: DataFrame, band: int = BAND, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256`` of every node of the
    trie of ``rebuilt`` conversations (``rebuilt_turns``), root included.  No
    conversations, no nodes."""
    return _band(rebuilt, None, 0, band, shard_rows).withColumnRenamed("parent", "parent_conv_id")


def conversation_trie(conversations: DataFrame, stride: int = STRIDE, shared: int = SHARED_TURNS, band: int = BAND,
                      shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``prefix_trie`` of the rebuilt ``conversations`` (``conv_id, turn,
    role, text``; further columns are not read).

    Rows without a conv_id take no part; null roles and texts are empty; a
    null turn is the first; rows that repeat are turns of their own; texts
    count whole, however long; an empty table has no nodes."""
    return prefix_trie(rebuilt_turns(turn_rows(conversations), stride, shared), band, shard_rows)
