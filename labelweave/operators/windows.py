"""C2..C9: token windows, special tokens, length grouping, micro-batches,
padding/mask and batch-shape metrics.

Windows stay arrays inside one row per record (a narrow, shuffle-free map);
only the per-batch metrics group, and a batch is bounded (<= batch size
records), so no group can grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave import config as C


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def window_count(ids, window: int, stride: int, cover_tail: bool = False) -> Column:
    """max(1, len // stride) windows; with ``cover_tail`` enough windows that
    the last one reaches the final token."""
    return _k(F.size(_c(ids)), window, stride, cover_tail)


def window_split(ids, window: int = C.SPLITTER_WINDOW, stride: int = C.SPLITTER_STRIDE,
                 cover_tail: bool = False) -> Column:
    """``ids[i*stride : i*stride+window]`` for i < max(1, len // stride)."""
    arr = _c(ids)
    k = window_count(arr, window, stride, cover_tail)
    return F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.slice(arr, i * stride + 1, window))


def add_special_tokens(windows, cls: int = C.CLS_ID, sep: int = C.SEP_ID, pad: int = C.PAD_ID) -> Column:
    """Wrap every window in CLS/SEP; pad only the last one to the first one's width."""
    def wrapped(ws: Column) -> Column:
        # ws is bound once a record; spelled out, it would be built again for every window
        def wrap(x, i):
            short = F.when(i == F.size(ws) - 1, F.size(F.get(ws, 0)) - F.size(x))
            return F.concat(F.array(F.lit(cls).cast("bigint")), x, F.array(F.lit(sep).cast("bigint")),
                            F.array_repeat(F.lit(pad).cast("bigint"), F.greatest(F.lit(0), short)))
        return F.transform(ws, wrap)
    return F.get(F.transform(F.array(_c(windows)), wrapped), 0)


def record_stats(rows) -> list[Column]:
    """C4: chunk_count, max_row_width, total_row_tokens of one record's rows."""
    r = _c(rows)
    sizes = F.transform(r, lambda x: F.size(x))
    return [
        F.size(r).alias("chunk_count"),
        F.coalesce(F.array_max(sizes), F.lit(0)).alias("max_row_width"),
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total_row_tokens"),
    ]


def prepare_records(df: DataFrame, ids_col: str = "ids", window: int = C.SCORING_WINDOW,
                    stride: int = C.SCORING_STRIDE, cover_tail: bool = False) -> DataFrame:
    """C2 + C3 + C4 on a frame with a token-id array column."""
    rows = add_special_tokens(window_split(F.col(ids_col), window, stride, cover_tail))
    return df.withColumn("rows", rows).select(
        "*", *record_stats("rows"), F.size(ids_col).alias("n_tokens"),
        F.size(F.get(F.col("rows"), 0)).alias("first_row_width"))


def record_stats_from_count(n_tokens, window: int = C.SCORING_WINDOW, stride: int = C.SCORING_STRIDE,
                            cover_tail: bool = False) -> list[Column]:
    """C4 in closed form from the token count alone (no token arrays).

    Window i holds ``min(window, n - i*stride)`` ids plus CLS/SEP; the first
    window is the widest, the last one is padded to its width, so
    max_row_width = first width and total = sum of the first k-1 widths +
    the first width.  Equal to ``record_stats`` of the materialised rows."""
    n = _c(n_tokens)
    k = _k(n, window, stride, cover_tail)
    first = F.least(F.lit(window), n) + 2
    body = F.when(k > 1, F.aggregate(F.sequence(F.lit(0), k - 2),
                                     F.lit(0).cast("bigint"),
                                     lambda a, i: a + F.greatest(F.lit(0), F.least(F.lit(window), n - i * stride)) + 2)
                  ).otherwise(F.lit(0).cast("bigint"))
    return [k.alias("chunk_count"), first.alias("max_row_width"), (body + first).cast("bigint").alias("total_row_tokens"),
            n.alias("n_tokens"), first.alias("first_row_width")]


def _k(n: Column, window: int, stride: int, cover_tail: bool) -> Column:
    if cover_tail:
        return F.lit(1) + F.greatest(F.lit(0), F.ceil((n - window) / F.lit(stride)).cast("int"))
    return F.greatest(F.lit(1), (n / F.lit(stride)).cast("int"))


def prepare_stats(df: DataFrame, n_col: str = "n_tokens", window: int = C.SCORING_WINDOW,
                  stride: int = C.SCORING_STRIDE, cover_tail: bool = False) -> DataFrame:
    """C4 columns for C5 / C6 / C9 from a token-count column."""
    return df.select(*[c for c in df.columns if c != n_col],
                     *record_stats_from_count(F.col(n_col), window, stride, cover_tail))


def length_group(df: DataFrame, batch_col: str = "batch_id", index_col: str = "input_index") -> DataFrame:
    """Order records of a batch by (max_row_width, chunk_count, index)."""
    w = Window.partitionBy(batch_col).orderBy("max_row_width", "chunk_count", index_col)
    return df.withColumn("group_rank", F.row_number().over(w))


def assign_micro_batch(df: DataFrame, n=C.MODEL_INFERENCE_BATCH_SIZE, rank_col: str = "group_rank") -> DataFrame:
    """Consecutive groups of ``n`` in grouped order (invalid n -> 16)."""
    text = str(n).strip()
    n = int(text) if text.isdigit() and int(text) else C.MODEL_INFERENCE_BATCH_SIZE
    return df.withColumn("micro_batch", ((F.col(rank_col) - 1) / F.lit(n)).cast("int"))


def pad_and_mask(df: DataFrame, batch_col: str = "batch_id", pad: int = C.PAD_ID) -> DataFrame:
    """Pad every row of a micro-batch to the micro-batch's widest row;
    the mask is 0 wherever the token equals the pad id."""
    w = Window.partitionBy(batch_col, "micro_batch")
    width = F.max("max_row_width").over(w)
    padded = F.transform("rows", lambda r: F.concat(r, F.array_repeat(F.lit(pad).cast("bigint"),
                                                                        F.col("mb_width") - F.size(r))))
    mask = F.transform("padded_rows", lambda r: F.transform(r, lambda x: F.when(x == pad, 0).otherwise(1)))
    return (df.withColumn("mb_width", width).withColumn("padded_rows", padded)
              .withColumn("attention_mask", mask))


def tensor_shape(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Rows, cols, active and pad tokens and pad ratio per micro-batch."""
    active = F.aggregate(F.transform("attention_mask", lambda m: F.aggregate(m, F.lit(0), lambda a, b: a + b)),
                         F.lit(0).cast("bigint"), lambda a, b: a + b)
    per = (df.groupBy(batch_col, "micro_batch")
             .agg(F.sum("chunk_count").cast("bigint").alias("row_count"),
                  F.max("mb_width").cast("bigint").alias("col_count"),
                  F.sum(active).cast("bigint").alias("active_token_count")))
    total = F.col("row_count") * F.col("col_count")
    return (per.withColumn("pad_token_count", total - F.col("active_token_count"))
               .withColumn("pad_ratio", F.when(total > 0, (total - F.col("active_token_count")) / total)
                           .otherwise(F.lit(0.0))))


# Names of the batch-shape metrics.
SHAPE_METRICS = [
    "configured_record_batch_size", "model_inference_batch_size", "effective_chunk_batch_size", "total_chunks",
    "mean_chunks_per_record", "max_chunks_per_record", "max_tokenized_length", "padded_tensor_rows",
    "padded_tensor_cols", "micro_batch_count", "max_micro_batch_records", "mean_micro_batch_records",
    "max_micro_batch_rows", "mean_micro_batch_rows", "grouping_applied", "mean_grouped_record_width",
    "max_grouped_record_width", "mean_micro_batch_padded_cols", "max_micro_batch_padded_cols",
    "mean_micro_batch_width_span", "max_micro_batch_width_span", "mean_micro_batch_token_count",
    "max_micro_batch_token_count", "mean_micro_batch_pad_tokens", "max_micro_batch_pad_tokens",
    "mean_micro_batch_pad_ratio", "max_micro_batch_pad_ratio", "attention_mask_applied",
]


def batch_shape_metrics(df: DataFrame, batch_col: str = "batch_id", n: int = C.MODEL_INFERENCE_BATCH_SIZE,
                        configured_batch_size: int | None = None) -> DataFrame:
    """The 28 shape metrics of each scoring call (= batch), long form
    ``(batch, name, value)``.  Input: C4..C6 columns plus ``n_tokens`` and
    ``first_row_width`` (from ``prepare_records`` or ``prepare_stats``)."""
    mb = (df.groupBy(batch_col, "micro_batch")
            .agg(F.count(F.lit(1)).alias("mb_records"),
                 F.sum("chunk_count").alias("mb_rows"),
                 F.max("max_row_width").alias("mb_cols"),
                 (F.max("max_row_width") - F.min("max_row_width")).alias("mb_span"),
                 F.sum("total_row_tokens").alias("mb_tokens")))
    mb = mb.withColumn("mb_pad", F.col("mb_cols") * F.col("mb_rows") - F.col("mb_tokens"))
    mb = mb.withColumn("mb_ratio", F.when(F.col("mb_tokens") + F.col("mb_pad") > 0,
                                          F.col("mb_pad") / (F.col("mb_tokens") + F.col("mb_pad")))
                       .otherwise(F.lit(0.0)))
    mb_agg = mb.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("micro_batch_count"),
        F.max("mb_records").alias("max_micro_batch_records"), F.avg("mb_records").alias("mean_micro_batch_records"),
        F.max("mb_rows").alias("max_micro_batch_rows"), F.avg("mb_rows").alias("mean_micro_batch_rows"),
        F.avg("mb_cols").alias("mean_micro_batch_padded_cols"), F.max("mb_cols").alias("max_micro_batch_padded_cols"),
        F.avg("mb_span").alias("mean_micro_batch_width_span"), F.max("mb_span").alias("max_micro_batch_width_span"),
        F.avg("mb_tokens").alias("mean_micro_batch_token_count"),
        F.max("mb_tokens").alias("max_micro_batch_token_count"),
        F.avg("mb_pad").alias("mean_micro_batch_pad_tokens"), F.max("mb_pad").alias("max_micro_batch_pad_tokens"),
        F.avg("mb_ratio").alias("mean_micro_batch_pad_ratio"), F.max("mb_ratio").alias("max_micro_batch_pad_ratio"),
    )
    rec = df.groupBy(batch_col).agg(
        (F.lit(configured_batch_size) if configured_batch_size else F.count(F.lit(1))).alias(
            "configured_record_batch_size"),
        F.lit(n).alias("model_inference_batch_size"),
        F.sum("chunk_count").alias("effective_chunk_batch_size"),
        F.sum("chunk_count").alias("total_chunks"),
        F.avg("chunk_count").alias("mean_chunks_per_record"),
        F.max("chunk_count").alias("max_chunks_per_record"),
        F.max("n_tokens").alias("max_tokenized_length"),
        F.max("chunk_count").alias("padded_tensor_rows"),
        F.max("first_row_width").alias("padded_tensor_cols"),
        F.lit(1).alias("grouping_applied"),
        F.avg("max_row_width").alias("mean_grouped_record_width"),
        F.max("max_row_width").alias("max_grouped_record_width"),
        F.lit(1).alias("attention_mask_applied"),
    )
    wide = rec.join(mb_agg, batch_col)
    return wide.select(batch_col, *[F.col(m).cast("double").alias(m) for m in SHAPE_METRICS]).unpivot(
        [batch_col], SHAPE_METRICS, "name", "value")
