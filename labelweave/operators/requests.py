"""B4..B8, F4, F5, F8: request normalisation, batch defaults, output
paths, field allow-lists, batch ids, input order and result unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave import config as C
from labelweave.functions import text as T


def normalize_requests(df: DataFrame, operation_step: str | None = None, output_format: str = "tsv",
                       missing: str = C.DEFAULT.missing_text) -> DataFrame:
    """Missing title/abstract -> ``missing``; text = title + ' ' + abstract;
    override NULL; step/format added when absent."""
    out = df
    for c in ("bibcode", "scix_id", "title", "abstract"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    out = (out.withColumn("title", F.coalesce(F.col("title"), F.lit(missing)))
              .withColumn("abstract", F.coalesce(F.col("abstract"), F.lit(missing))))
    out = out.withColumn("text", T.request_text("title", "abstract", missing))
    if "operation_step" not in out.columns or operation_step is not None:
        out = out.withColumn("operation_step", F.lit(operation_step or C.DEFAULT_OPERATION_STEP))
    return (out.withColumn("output_format", F.lit(output_format))
               .withColumn("override", F.lit(None).cast("array<string>")))


def apply_batch_defaults(df: DataFrame, batch_col: str = "batch_id", order_col: str = "input_index",
                         new_run: Column | None = None, default_step: str = C.DEFAULT_OPERATION_STEP) -> DataFrame:
    """The first record of each batch decides step and run for all its
    records.  A window per batch (batches are bounded) -> one shuffle, no join."""
    w = Window.partitionBy(batch_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding,
                                                                      Window.unboundedFollowing)
    first_step = F.first("operation_step").over(w)
    first_run = F.first("run_id").over(w)
    return (df.withColumn("operation_step", F.coalesce(first_step, F.lit(default_step)))
              .withColumn("run_id", F.coalesce(first_run, new_run if new_run is not None else F.lit(None))))


def output_path(home: str, step="operation_step", path="output_path", run="run_id") -> Column:
    """``<home>/logs/<basename or 'pre-ingest'>_<run>_classified.tsv``; a
    pre-ingest request with an absolute path keeps it."""
    p = F.col(path)
    base = F.nullif(F.element_at(F.split(F.coalesce(p, F.lit("")), "/"), -1), F.lit(""))
    built = F.concat(F.lit(home.rstrip("/") + "/logs/"), F.coalesce(base, F.lit("pre-ingest")), F.lit("_"),
                     F.col(run).cast("string"), F.lit("_classified.tsv"))
    keep = (F.col(step) == "pre_ingest") & p.isNotNull() & (p != "") & p.startswith("/")
    return F.when(keep, p).otherwise(built)


def select_allowed(df: DataFrame, response: bool = False) -> DataFrame:
    """Keep only the allowed message fields that are present."""
    allowed = C.RESPONSE_FIELDS if response else C.REQUEST_FIELDS
    return df.select(*[c for c in df.columns if c in allowed])


def split_override(col) -> Column:
    """Comma string -> array, no trimming ('' -> [''])."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, ",", -1)


def is_allowed(col, allowed=C.LABELS) -> Column:
    """Every element is an allowed category, case-insensitive."""
    low = F.array(*[F.lit(a.lower()) for a in allowed])
    c = F.col(col) if isinstance(col, str) else col
    return F.forall(c, lambda x: F.array_contains(low, F.lower(x)))


def is_single_empty(col) -> Column:
    """Exactly ``['']``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce((F.size(c) == 1) & (F.get(c, 0) == F.lit("")), F.lit(False))


LOW33 = (1 << 33) - 1


def ranked(df: DataFrame, order: list[str], by_range: list[str] | None = None) -> DataFrame:
    """``df`` range-sorted on ``order`` and written once with each row's
    partition ``_pid`` and place in it ``_local`` (the documented layout of
    ``monotonically_increasing_id``).  Everything derived from these two
    columns reads that one written copy, so it never rests on two branches of
    a plan being partitioned alike."""
    from labelweave.session import cut_lineage
    s = df.repartitionByRange(*(by_range or order)).sortWithinPartitions(*order)
    return cut_lineage(s.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id().bitwiseAND(F.lit(LOW33))))


def dense_index(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Dense 0-based index in ``order`` without a single-partition window:
    the place in the range partition (``ranked``) plus the rows of the
    partitions before it (one small row per partition)."""
    s = ranked(df, order)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return s.join(F.broadcast(offs), "_pid").withColumn(name, F.col("_off") + F.col("_local")).drop(
        "_pid", "_local", "_off")


def assign_batches(df: DataFrame, n: int, index_col: str = "input_index", name: str = "batch_id") -> DataFrame:
    """consecutive fixed-size batches over a dense index column."""
    return df.withColumn(name, F.floor(F.col(index_col) / F.lit(n)).cast("bigint"))


def restore_order(df: DataFrame, index_col: str = "input_index") -> DataFrame:
    """input order, applied only at the sink."""
    return df.orderBy(index_col)


def union_results(a: DataFrame, b: DataFrame) -> DataFrame:
    """F8: UNION ALL by name, missing columns NULL."""
    return a.unionByName(b, allowMissingColumns=True)
