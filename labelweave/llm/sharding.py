"""Sharding by a k-d tree over document metadata.

What is placed are groups of equal texts, at the metadata of their first
document.  The tree splits recursively, along the dimension in which a node's
groups are spread widest, at the weighted median (the share of bytes its two
sides are to hold), until every leaf holds one shard's target bytes.  A large group that fits one shard is
given to one beforehand, and the tree splits what is left of the shards' bytes.
Medians
are found on the executors digit by digit: each round sums weights per node
and digit of the sort key, so what reaches the driver is bounded by the number
of shards, whatever the input.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave.llm.common import ROW, drop_stage, utf8_size, with_row_identity, write_stage

SHARDS, ROW_BYTES = 40, 16
#: Groups of equal texts over 1/4 of a shard are placed before the tree is cut;
#: those that exceed a shard, or fit none any more, in pieces of 1/16.
LARGE_PER_SHARD, PIECES_PER_SHARD = 4, 16
#: A median is close enough when what is left unsplit is below this share of a shard.
TOLERANCE = 0.001
#: Sort keys: 16 bits of the coordinate, then 32 bits of the group's hash.
COORD_BITS, TIE_BITS, DIGIT_BITS = 16, 32, 12
SLOT_BUCKETS = 256
DIMENSIONS = ["c_size", "c_source", "c_lang"]


def _name_coord(c: str) -> Column:
    """Position of a name on a line: high bits of its CRC-32 (null: 0)."""
    return F.coalesce(F.shiftright(F.crc32(F.col(c).cast("binary")), 32 - COORD_BITS), F.lit(0)).cast("long")


def _size_coord(c: str) -> Column:
    return F.least(F.floor(F.log2(F.col(c) + 1) / 40 * (1 << COORD_BITS)), F.lit((1 << COORD_BITS) - 1)).cast("long")


class Node:
    """A node of the tree: the bytes that each shard below it has room for,
    and its split."""

    def __init__(self, number: int, room: list[float]):
        self.number, self.room = number, room
        self.dim = self.cut = self.left = self.right = None

    def leaves(self) -> list["Node"]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()

    def left_share(self) -> float:
        """Share of the node's bytes that goes to its left half of shards."""
        left, all_ = sum(self.room[:len(self.room) // 2]), sum(self.room)
        return left / all_ if all_ > 0 else (len(self.room) // 2) / len(self.room)

    def place(self, value=lambda n: n.number) -> Column:
        """Column expression: the leaf a unit falls in."""
        if self.left is None:
            return F.lit(value(self))
        return F.when(F.col(self.dim) < F.lit(int(self.cut)), self.left.place(value)).otherwise(self.right.place(value))


def _by_node(values: dict[int, int]) -> Column:
    out = F.lit(None).cast("long")
    for n, v in values.items():
        out = F.when(F.col("node") == n, F.lit(int(v))).otherwise(out)
    return out


def _cuts(units: DataFrame, root: Node, nodes: list[Node], tolerance: float) -> None:
    """Choose dimension and cut of ``nodes`` (all of one level) together."""
    by = {n.number: n for n in nodes}
    here = units.withColumn("node", root.place()).filter(F.col("node").isin(list(by)))
    small = {d: F.shiftright(F.col(d), TIE_BITS + COORD_BITS - 10) for d in DIMENSIONS}
    sums = [F.sum(x).alias(f"s_{d}") for d, x in small.items()] + [F.sum(x * x).alias(f"q_{d}") for d, x in small.items()]
    total = {n: 0 for n in by}
    for r in here.groupBy("node").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), *sums).collect():
        spread = {d: r.n * r[f"q_{d}"] - r[f"s_{d}"] ** 2 for d in DIMENSIONS}
        by[r.node].dim, total[r.node] = max(DIMENSIONS, key=lambda d: spread[d]), r.w
    goal = {n: total[n] * by[n].left_share() for n in by}
    prefix, below, open_ = {n: 0 for n in by}, {n: 0 for n in by}, {n for n in by if total[n]}
    for n in by:
        by[n].dim, by[n].cut = by[n].dim or DIMENSIONS[0], 0
    key = F.coalesce(*[F.when(F.col("node").isin([n for n in by if by[n].dim == d] or [-1]), F.col(d)) for d in DIMENSIONS])
    keyed = here.select("node", "w", key.alias("key"))
    for shift in range(COORD_BITS + TIE_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        if not open_:
            return
        part = keyed.filter(F.shiftright("key", shift + DIGIT_BITS) == _by_node({n: prefix[n] for n in open_}))
        digits = part.groupBy("node", F.shiftright("key", shift).alias("digits")).agg(F.sum("w").alias("w")).toPandas()
        for n, rows in digits.groupby("node"):
            rows = rows.sort_values("digits")
            ends = below[n] + np.cumsum(rows["w"].to_numpy())
            at = min(int(np.searchsorted(ends, goal[n])), len(ends) - 1)
            digit, weight = int(rows["digits"].iloc[at]), int(rows["w"].iloc[at])
            low = int(ends[at]) - weight
            near_low = goal[n] - low <= low + weight - goal[n]
            by[n].cut = (digit if near_low else digit + 1) << shift
            prefix[n], below[n] = digit, low
            if weight <= tolerance:
                open_.discard(n)


def kd_tree(units: DataFrame, room: list[float], shard_bytes: float) -> Node:
    """The tree whose leaf ``i`` holds about ``room[i]`` bytes of the units."""
    root = Node(1, room)
    while level := [n for n in root.leaves() if len(n.room) > 1]:
        _cuts(units, root, level, TOLERANCE * shard_bytes)
        for n in level:
            half = len(n.room) // 2
            n.left, n.right = Node(2 * n.number, n.room[:half]), Node(2 * n.number + 1, n.room[half:])
    return root


def place_large(sizes: list[int], shards: int, shard_bytes: float) -> tuple[list[int | None], list[float]]:
    """A shard for each large group (given largest first): the fullest one it
    still fits, None if there is none; and the room left in every shard."""
    room, at = [shard_bytes] * shards, []
    for w in sizes:
        fits = [i for i in range(shards) if w <= room[i]]
        at.append(min(fits, key=lambda i: (room[i], i)) if fits else None)
        if fits:
            room[at[-1]] -= w
    return at, room


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``row_file, row_index, doc_id, size, text_crc32, shard, slot`` for
    every row of ``docs`` (``doc_id, text, source, lang`` and any further
    columns).  Shards run from 0, their sizes are near equal; slots run from 0
    without gaps in each.

    Size is the text's UTF-8 bytes (null: none) plus 16.  Equal texts (null
    and empty are equal) share a shard unless together they exceed one, or are
    over 1/4 of one and no shard has room for them beside larger such groups;
    then pieces of about 1/16 are placed side by side.  One text longer than a
    shard stays whole, in a shard larger than the others.  Repeated rows are
    rows of their own.
    Null metadata has coordinate 0.  With fewer rows than shards some shards
    stay empty; an empty table gives an empty result."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    rows, rows_path = write_stage(with_row_identity(docs).select(
        *ROW, F.col("doc.doc_id").alias("doc_id"), (utf8_size("doc.text") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("same"),
        F.col("doc.source").alias("source"), F.col("doc.lang").alias("lang")), "rows")
    shard_bytes = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    piece = max(1.0, shard_bytes / PIECES_PER_SHARD)
    # at most shards * LARGE_PER_SHARD groups are that large, so the driver can place them
    large = sorted(rows.groupBy("same").agg(F.sum("size").alias("all")).filter(F.col("all") > shard_bytes / LARGE_PER_SHARD)
                   .collect(), key=lambda r: (-r["all"], bytes(r["same"])))
    at, room = place_large([r["all"] for r in large], shards, shard_bytes)
    big = spark.createDataFrame([(r["same"], -int(-r["all"] // piece), i) for r, i in zip(large, at)],
                                "same binary, pieces long, given int")
    rows = rows.join(F.broadcast(big), "same", "left").withColumn("piece", F.coalesce(
        F.pmod(F.xxhash64(*ROW), F.col("pieces")), F.lit(0)).cast("long")).drop("pieces")
    lead = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *ROW, "size", "source", "lang"))
    tie = F.pmod(F.xxhash64("same", "piece"), F.lit(1 << TIE_BITS))
    units = rows.groupBy("same", "piece").agg(
        F.sum("size").alias("w"), lead.alias("lead"), F.max("given").alias("given")).select(
        "same", "piece", "w", "given", tie.alias("tie"), "lead.size", "lead.source", "lead.lang")
    units = units.select("same", "piece", "w", "given", *[(F.shiftleft(c, TIE_BITS) + F.col("tie")).alias(d) for d, c in zip(
        DIMENSIONS, (_size_coord("size"), _name_coord("source"), _name_coord("lang")))])
    units, units_path = write_stage(units, "units")
    root = kd_tree(units.filter(F.col("given").isNull()), room, shard_bytes)
    number = {n.number: i for i, n in enumerate(root.leaves())}
    shard = F.coalesce("given", root.place(lambda n: number[n.number]))
    placed = rows.drop("given").join(units.select("same", "piece", shard.alias("shard")), ["same", "piece"])
    placed, _ = write_stage(placed.select(
        *ROW, "doc_id", "size", "text_crc32", "shard",
        F.pmod(F.xxhash64(*ROW), F.lit(SLOT_BUCKETS)).alias("bucket")), "placed")
    drop_stage(spark, rows_path, units_path)
    # places in a shard: bucket by bucket, so no task has to number a whole shard
    ahead = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    before, _ = write_stage(placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "bucket", ahead.alias("before")), "slots")
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy(*ROW)) - 1
    return placed.withColumn("within", within).join(before, ["shard", "bucket"]).select(
        *ROW, "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).alias("slot"))
