"""Merkle manifest of a dataset, in SQL over concatenated-level strings.

Rows become leaves, leaves are ranked inside their group, and every aligned
block of ``arity ** BLOCK_LEVELS`` leaves keeps each of its tree levels as one
hex string: fixed-width substrings of a level are hashed to the next one, and
the substrings on both flanks of a node are its siblings.  Block roots are the
leaves of the next layer, so a group of any size is a few layers of small
blocks; the roots of the groups form one more tree of the same kind.  Text is
read once, to hash it, and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave.llm.common import ROW, drop_stage, with_row_identity, write_stage
from labelweave.operators.requests import dense_index, ranked

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY, BLOCK_LEVELS, WIDTH = 2, 10, 64
_SIBLINGS = "array<struct<left:string,right:string>>"


def digest(*parts) -> Column:
    """Lower-case hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else UTF-8 bytes, ``:``, value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def proof_digest(siblings: Column) -> Column:
    """Hash of a path's siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(start: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(siblings, start, lambda node, s: digest(s["left"], node, s["right"]))


def _parents(level: Column, arity: int) -> Column:
    """The level above: one hash for each run of ``arity`` nodes of ``level``."""
    run = arity * WIDTH
    last = F.ceil(F.length(level) / run).cast("int") - 1
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda j: F.sha2(
        F.substring(level, j * run + 1, F.lit(run)), 256)), "").cast("binary")


def _flanks(level: Column, at: Column, arity: int) -> Column:
    """The other nodes of the run that holds node ``at``."""
    begin = at - at % arity
    return F.struct(
        F.substring(level, begin * WIDTH + 1, (at - begin) * WIDTH).cast("string").alias("left"),
        F.substring(level, (at + 1) * WIDTH + 1, (begin + arity - 1 - at) * WIDTH).cast("string").alias("right"))


def _blocks(nodes: DataFrame, payload: list[str], arity: int, levels: int) -> tuple[DataFrame, str]:
    """Written blocks of ``gid, at, of, node`` and payload: ``gid, block, of,
    rows`` in order and ``levels``, from the nodes given up to the block's
    root (of a group of one block: its tree's root)."""
    size = arity ** levels
    rows = F.sort_array(F.collect_list(F.struct("at", "node", *payload)))
    packed = nodes.groupBy("gid", F.expr(f"at div {size}").alias("block")).agg(
        F.max("of").alias("of"), rows.alias("rows"))
    powers = F.array(*[F.lit(arity ** i).cast("long") for i in range(levels)])
    depth = F.size(F.filter(powers, lambda p: p < F.col("of")))
    bottom = F.array_join(F.transform("rows", lambda r: r["node"]), "").cast("binary")
    steps = F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>"))
    grown = F.aggregate(steps, F.array(bottom), lambda acc, _: F.concat(
        acc, F.array(_parents(F.element_at(acc, -1), arity))))
    return write_stage(packed.withColumn("levels", grown), "merkle")


def _layers(nodes: DataFrame, payload: list[str], arity: int, levels: int) -> tuple[list[DataFrame], list[str]]:
    """Blocks of the nodes, blocks of the roots of groups of several blocks,
    and so on until every group is one block."""
    size, out, paths = arity ** levels, [], []
    while True:
        blocks, path = _blocks(nodes, payload, arity, levels)
        out.append(blocks)
        paths.append(path)
        if blocks.filter(F.col("of") > size).isEmpty():
            return out, paths
        nodes = blocks.filter(F.col("of") > size).select(
            "gid", F.col("block").alias("at"), F.expr(f"(of + {size - 1}) div {size}").alias("of"),
            F.element_at("levels", -1).cast("string").alias("node"))
        payload = []


def _tops(layers: list[DataFrame], size: int) -> DataFrame:
    """``gid, top``: the root of each group's tree."""
    out = None
    for blocks in layers:
        tops = blocks.filter(F.col("of") <= size).select("gid", F.element_at("levels", -1).cast("string").alias("top"))
        out = tops if out is None else out.unionByName(tops)
    return out


def _paths(layers: list[DataFrame], above: DataFrame, payload: list[str], arity: int, levels: int) -> DataFrame:
    """``gid, at, node``, payload and ``siblings`` of every node of the lowest
    layer; ``above`` (``gid, siblings`` and what else a group's rows are to
    carry) continues a group's paths beyond its own root."""
    size = arity ** levels
    extra = [c for c in above.columns if c not in ("gid", "siblings")]
    known = above.select("gid", F.lit(0).cast("long").alias("block"), F.col("siblings").alias("beyond"), *extra)
    finished = known
    for k in range(len(layers) - 1, -1, -1):
        keep = payload if k == 0 else []
        joined = layers[k].join(known, ["gid", "block"])

        def siblings(held, place):
            own = F.transform(F.sequence(F.lit(0), F.size(held) - 1), lambda i: F.when(
                i < F.size(held) - 1, _flanks(F.get(held, i), F.floor(place / F.pow(F.lit(float(arity)), i)).cast("int"), arity)))
            return F.filter(own, lambda s: s.isNotNull())

        # levels copied once per block, then looked up per node
        held = F.array(F.transform("levels", lambda x: F.concat(x, F.lit(b""))))
        nodes = F.flatten(F.transform(held, lambda h: F.transform("rows", lambda r: F.struct(
            r["at"].alias("at"), r["node"].alias("node"), *[r[c].alias(c) for c in keep],
            F.concat(siblings(h, (r["at"] % size).cast("int")), F.col("beyond")).alias("siblings")))))
        rows = joined.select("gid", *extra, F.inline(nodes))
        if k:
            done = rows.select("gid", F.col("at").alias("block"), F.col("siblings").alias("beyond"), *extra)
            ends = finished.join(layers[k - 1].filter(F.col("of") <= size).select("gid"), "gid", "left_semi")
            known, _ = write_stage(done.unionByName(ends), "paths")
    return rows


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id",
                    payload: dict[str, Column] | None = None, arity: int = ARITY,
                    block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``row_file, row_index``, ``group``, ``order``, ``leaf``, ``siblings``
    (array of left and right flank, leaf level first, through ``subroot``),
    ``subroot``, ``root`` and the payload (columns over struct ``doc``) of
    every row of ``docs``.

    A leaf hashes ``fields``; the leaves of a group ascend by ``order`` (null
    first; equal ones by their leaf, then by file and position, so the roots
    do not depend on how equal rows are told apart), the groups by their name
    (null first, a group of its own; by UTF-8 bytes).  Null and empty texts
    differ (``-`` and ``0:``); a text of any length counts whole; further
    columns are not read; an empty table gives an empty result."""
    spark, size, more = docs.sparkSession, arity ** block_levels, payload or {}
    rows = with_row_identity(docs).select(
        *ROW, F.col(f"doc.{group}").alias("g"), F.col(f"doc.{order}").alias("o"),
        leaf(*[F.col(f"doc.{f}") for f in fields]).alias("node"), *[c.alias(f"p_{n}") for n, c in more.items()])
    rows, rows_path = write_stage(rows, "leaves")  # sampling for the ranges must not hash the texts again
    # a group of any share of the rows spans as many range partitions as it needs
    placed = ranked(rows, ["g", "o", "node", *ROW])
    segments, seg_path = write_stage(placed.groupBy("_pid", "g").agg(
        F.min("_local").alias("first"), F.count(F.lit(1)).alias("n")), "segments")
    numbers = dense_index(segments.select("g").distinct(), ["g"], "gid")
    of_group = Window.partitionBy("g")
    offsets, off_path = write_stage(segments.join(numbers.withColumnRenamed("g", "name"), F.col("g").eqNullSafe(F.col("name")))
                                    .select(F.col("_pid").alias("pid"), F.col("g").alias("name"), F.col("gid").cast("long"), (
                                        F.sum("n").over(of_group.orderBy("_pid")) - F.col("n") - F.col("first")).alias("shift"),
                                        F.sum("n").over(of_group).alias("of")), "offsets")
    keep = [*ROW, "g", "o", *[f"p_{n}" for n in more]]
    nodes = placed.join(offsets, (F.col("_pid") == F.col("pid")) & F.col("g").eqNullSafe(F.col("name"))).select(
        "gid", (F.col("_local") + F.col("shift")).alias("at"), "of", "node", *keep)
    layers, paths = _layers(nodes, keep, arity, block_levels)
    tops, top_path = write_stage(_tops(layers, size), "subroots")
    count = tops.count()
    group_layers, group_paths = _layers(tops.select(
        F.lit(0).cast("long").alias("gid"), F.col("gid").alias("at"), F.lit(count).cast("long").alias("of"),
        F.col("top").alias("node")), [], arity, block_levels)
    start = _tops(group_layers, size).select("gid", F.array().cast(_SIBLINGS).alias("siblings"), F.col("top").alias("root"))
    above, _ = write_stage(_paths(group_layers, start, [], arity, block_levels).select(
        F.col("at").alias("gid"), "siblings", F.col("node").alias("subroot"), "root"), "above")
    drop_stage(spark, rows_path, seg_path, off_path, top_path, *group_paths)
    return _paths(layers, above, keep, arity, block_levels).select(
        *ROW, F.col("g").alias(group), F.col("o").alias(order), F.col("node").alias("leaf"), "siblings", "subroot", "root",
        *[F.col(f"p_{n}").alias(n) for n in more])
