"""Small shared helpers: stable row identity, written stages, joins of
rows to their groups that bear hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelweave.session import scratch_dir

ROW = ["row_file", "row_index"]


def write_stage(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    later branches scan the written table (nothing is derived twice, and a
    lost executor costs only the tasks it ran)."""
    path = scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stage(spark: SparkSession, *paths: str) -> None:
    """Delete written stages nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def with_row_identity(docs: DataFrame) -> DataFrame:
    """``docs`` as columns ``doc`` (struct of every input column, so no input
    name can clash), ``row_file`` and ``row_index``: the file and position a
    row was read from, the same in every later scan, also for repeated rows
    and null ids.  A frame that isn't a file scan is written first."""
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")
    try:
        meta = docs.metadataColumn("_metadata")
        return docs.select(row, meta["file_path"].alias("row_file"), meta["row_index"].alias("row_index"))
    except AnalysisException:
        return with_row_identity(write_stage(docs, "rows")[0])


def keep_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Input columns of ``rows`` (from ``with_row_identity``) without the rows
    listed in ``dropped``.  The list is the smaller side; the optimizer
    broadcasts it when its measured size allows and sorts both otherwise."""
    return rows.join(dropped.select(*ROW), ROW, "left_anti").select("doc.*")


#: A join's list of hot keys never holds more rows than this.
HOT_KEYS, HOT_ROWS = 10_000, 1 << 16


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """``rows`` (a written table) with the columns of ``groups`` (one row per
    key, written, ``n`` of them in ``rows``; null keys match).

    Keys with many rows (more than ``HOT_ROWS`` and one ``HOT_KEYS``-th of all,
    so there are at most ``HOT_KEYS`` of them) are joined by a broadcast: their
    rows stay where they are.  All other keys meet in a shuffle, where none is
    large."""
    total = groups.agg(F.sum(n)).first()[0] or 0
    limit = max(HOT_ROWS, total // HOT_KEYS)
    more = [c for c in groups.columns if c not in keys]

    def joined(left, right, how="inner"):
        named = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
        same = [left[k].eqNullSafe(named[f"_k{i}"]) for i, k in enumerate(keys)]
        out = left.join(named, reduce(lambda x, y: x & y, same), how)
        return out if how == "left_anti" else out.select(*rows.columns, *more)
    hot = groups.filter(F.col(n) > limit)
    if hot.isEmpty():
        return joined(rows, groups)
    others = joined(rows, F.broadcast(hot.select(*keys)), "left_anti")
    return joined(rows, F.broadcast(hot)).unionByName(joined(others, groups.filter(F.col(n) <= limit)))


def utf8_size(text) -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


class Recent(dict):
    """Values of recent keys, made on demand by ``make``; keys longer than
    ``longest``, or that hold a line break, are not kept.  When ``limit`` keys are held they become the
    old generation, and what is asked for again moves back, so frequent keys
    stay while memory is bounded by two generations."""

    def __init__(self, make, limit: int, longest: int):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest and "\n" not in key:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
