"""C10..C14, B20, B21, I1, I2: scoring windows, pooling, label selection,
the whole classify path and per-batch counts.

Default scorer: a hashed linear model.  token -> bucket (id mod n_buckets)
-> per-label weight; logit(window, label) = bias + scale * mean(weight);
sigmoid; pool over windows.  Plan: explode window tokens, broadcast-join the
weights table (its row count is checked before the broadcast hint, else a
shuffle join), partial+final aggregate per window, then per record.  Both
aggregates combine map-side, so the shuffles carry one row per window and
one per record, never tokens.

Real models plug in through ``PandasScorer`` (I2): ``mapInPandas`` over
Arrow batches of windows, model loaded once per Python worker.
"""

from __future__ import annotations

import uuid
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from labelweave import config as C
from labelweave.functions import scores as S
from labelweave.functions import text as T
from labelweave.operators import windows as W
from labelweave.operators.layout import spread_records
from labelweave.session import cut_lineage, ship_package


def default_weights(spark: SparkSession, n_buckets: int = C.N_BUCKETS, n_labels: int = len(C.LABELS)) -> DataFrame:
    """Deterministic weights table ``(bucket, w array<double>[n_labels])`` for
    tests and benches: w = ((b*(2l+3) + 7l) mod 199 - 99) / 99."""
    b = F.col("id")
    ws = [(((b * (2 * l + 3) + 7 * l) % 199) - 99) / F.lit(99.0) for l in range(n_labels)]
    return spark.range(n_buckets).select(b.alias("bucket"), F.array(*ws).alias("w"))


def weights_from_long(df: DataFrame, n_labels: int = len(C.LABELS)) -> DataFrame:
    """``(bucket, label_index, weight)`` -> ``(bucket, w array)`` (missing = 0)."""
    g = df.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("label_index", "weight"))).alias("m"))
    return g.select("bucket", F.array(*[F.coalesce(F.element_at("m", F.lit(l)), F.lit(0.0))
                                        for l in range(n_labels)]).alias("w"))


class HashedLinearScorer:
    """Spark-native scorer over window token ids."""

    def __init__(self, weights: DataFrame, n_buckets: int = C.N_BUCKETS, bias=C.MODEL_BIAS,
                 scale: float = C.MODEL_SCALE, max_broadcast_rows: int = C.MAX_BROADCAST_WEIGHT_ROWS):
        self.weights = weights
        self.n_buckets = n_buckets
        self.bias = list(bias)
        self.scale = scale
        self.max_broadcast_rows = max_broadcast_rows
        self._broadcastable: bool | None = None

    @property
    def n_labels(self) -> int:
        return len(self.bias)

    def _weights_side(self) -> DataFrame:
        if self._broadcastable is None:
            # the weights table is a model parameter; count it once
            self._broadcastable = self.weights.count() * self.n_labels <= self.max_broadcast_rows
        return F.broadcast(self.weights) if self._broadcastable else self.weights

    def score_windows(self, chunks: DataFrame, keys: list[str], window_col: str = "window") -> DataFrame:
        """``keys + [chunk, window]`` -> ``keys + [chunk, probs array<double>]``."""
        tok = chunks.select(*keys, "chunk", F.explode_outer(window_col).alias("tok"))
        tok = tok.withColumn("bucket", F.pmod(F.col("tok"), F.lit(self.n_buckets)))
        joined = tok.join(self._weights_side(), "bucket", "left")
        sums = joined.groupBy(*keys, "chunk").agg(
            F.count("tok").alias("n_tok"),
            *[F.sum(F.get(F.col("w"), l)).alias(f"ws{l}") for l in range(self.n_labels)])
        probs = []
        for l in range(self.n_labels):
            logit = F.lit(self.bias[l]) + F.lit(self.scale) * F.coalesce(F.col(f"ws{l}"), F.lit(0.0)) / F.greatest(
                F.col("n_tok"), F.lit(1))
            probs.append(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)))
        return sums.select(*keys, "chunk", F.array(*probs).alias("probs"))


class PandasScorer:
    """Plug-in scorer.  ``model_factory()`` is called once per Python
    worker and must return ``f(list[list[int]]) -> list[list[float]]`` of
    sigmoid scores per window.  Workers keep the model under ``name`` (give
    another model another name or version).  Windows of an Arrow batch reach
    the model by length in groups of ``micro_batch``, so little is padding."""

    def __init__(self, model_factory: Callable, n_labels: int = len(C.LABELS), name: str | None = None,
                 micro_batch: int = C.MODEL_INFERENCE_BATCH_SIZE):
        self.model_factory = model_factory
        self.n_labels = n_labels
        self.name = name or f"{model_factory.__module__}.{getattr(model_factory, '__qualname__', 'model')}-{uuid.uuid4().hex}"
        self.micro_batch = micro_batch

    def score_windows(self, chunks: DataFrame, keys: list[str], window_col: str = "window") -> DataFrame:
        ship_package(chunks.sparkSession)
        factory, name, step = self.model_factory, self.name, self.micro_batch
        schema = chunks.select(*keys, "chunk").schema.add("probs", ArrayType(DoubleType()))
        cols = list(keys) + ["chunk"]

        def run(it):
            model = _worker_model(name, factory)
            for pdf in it:
                out = pdf[cols].copy()
                windows = [list(w) for w in pdf[window_col]]
                by_length = sorted(range(len(windows)), key=lambda i: len(windows[i]))
                probs = [None] * len(windows)
                for a in range(0, len(windows), step):
                    at = by_length[a:a + step]
                    for i, p in zip(at, model([windows[i] for i in at])):
                        probs[i] = p
                out["probs"] = probs
                yield out
        return chunks.select(*cols, window_col).mapInPandas(run, schema)


_MODELS: dict = {}


def _worker_model(name, factory):
    if name not in _MODELS:
        _MODELS[name] = factory()
    return _MODELS[name]


def explode_windows(df: DataFrame, keys: list[str], ids_col: str = "ids", window: int = C.SCORING_WINDOW,
                    stride: int = C.SCORING_STRIDE, cover_tail: bool = True) -> DataFrame:
    """One row per (record, window) with the window's content token ids."""
    return df.select(*keys, F.posexplode(W.window_split(F.col(ids_col), window, stride, cover_tail)).alias(
        "chunk", "window"))


def pool_scores(chunk_probs: DataFrame, keys: list[str], how="max", n_labels: int = len(C.LABELS)) -> DataFrame:
    """Combine window scores per record.  ``how`` is 'max', 'mean'
    or a callable ``f(np.ndarray[windows, labels]) -> sequence[labels]``
    run per record in Python (a record's windows are bounded by its text
    length)."""
    if callable(how):
        return custom_pool(chunk_probs, keys, how, n_labels)
    agg = F.max if how == "max" else F.avg
    if how not in ("max", "mean"):
        raise ValueError(f"unknown pooling {how!r}")
    g = chunk_probs.groupBy(*keys).agg(*[agg(F.get(F.col("probs"), l)).alias(f"p{l}") for l in range(n_labels)])
    return g.select(*keys, F.array(*[F.col(f"p{l}") for l in range(n_labels)]).alias("scores"))


def custom_pool(chunk_probs: DataFrame, keys: list[str], fn: Callable, n_labels: int) -> DataFrame:
    """User combiner over one record's (windows x labels) block.  Blocks
    reach Python as arrays, many records in an Arrow batch; ``fn`` is called
    once a record."""
    ship_package(chunk_probs.sparkSession)

    @F.pandas_udf(ArrayType(DoubleType()))
    def combined(blocks: pd.Series) -> pd.Series:
        return pd.Series([list(map(float, fn(np.array(b, dtype=float).reshape(-1, n_labels)))) for b in blocks], dtype=object)
    windows = F.sort_array(F.collect_list(F.struct("chunk", "probs")))
    blocks = chunk_probs.groupBy(*keys).agg(F.flatten(F.transform(windows, lambda w: w["probs"])).alias("_block"))
    return blocks.select(*keys, combined("_block").alias("scores"))


def select_labels(scores, labels=C.LABELS, thresholds=None) -> Column:
    """Labels whose pooled score is >= threshold (default 0.0 -> all)."""
    thr = thresholds or [0.0] * len(labels)
    lab = F.array(*[F.lit(x) for x in labels])
    t = F.array(*[F.lit(float(x)) for x in thr])
    s = F.col(scores) if isinstance(scores, str) else scores
    idx = F.filter(F.sequence(F.lit(0), F.lit(len(labels) - 1)), lambda i: F.get(s, i) >= F.get(t, i))
    return F.transform(idx, lambda i: F.get(lab, i))


def score_records(df: DataFrame, keys: list[str], scorer, text_col: str = "text",
                  cfg: C.ClassifierConfig = C.DEFAULT) -> DataFrame:
    """C1 + C2 + C10 + C11: ``keys + text`` -> ``keys + scores``."""
    texts = df.select(*keys, text_col)
    df = spread_records(texts, keys[0])
    if df is texts:
        ship_package(df.sparkSession)
        ids = T.hashed_token_ids(text_col)
    else:  # an Arrow step hides the clustering on the key, which spares a small input two exchanges
        ids = T.token_ids(text_col)
    ids = df.select(*keys, ids.alias("ids"))
    chunks = explode_windows(ids, keys, "ids", cfg.window, cfg.stride, cfg.cover_tail)
    probs = scorer.score_windows(chunks, keys)
    return pool_scores(probs, keys, cfg.pooling, len(cfg.labels))


def classify(df: DataFrame, scorer, cfg: C.ClassifierConfig = C.DEFAULT,
             keys: tuple = ("input_index",), carry: tuple = ()) -> DataFrame:
    """Requests (``title``/``abstract`` or ``text``) -> scores,
    categories, collections, collection_scores.  ``keys`` name a record once;
    ``carry`` columns are joined back to the pooled scores, so they are never
    copied to window or token rows."""
    if "text" not in df.columns:
        df = df.withColumn("text", T.request_text(missing=cfg.missing_text))
    k = list(keys) + [c for c in carry if c not in keys]
    scored = score_records(df, list(keys), scorer, "text", cfg)
    if len(k) > len(keys):
        scored = scored.join(df.select(*k), list(keys))
    kw = dict(thresholds=cfg.thresholds, relabel_active=cfg.relabel_active, relabel_from=cfg.relabel_from,
              relabel_to=cfg.relabel_to, relabel_threshold=cfg.relabel_threshold)
    return scored.select(
        *k, "scores",
        select_labels("scores", cfg.labels, cfg.select_thresholds).alias("categories"),
        S.collections("scores", labels=list(cfg.labels), **kw).alias("collections"),
        S.collection_scores("scores", labels=list(cfg.labels), **kw).alias("collection_scores"))


def constant_scores(n_labels: int = len(C.LABELS), value: float = 0.5) -> Column:
    """Dry-run scorer, every label scores 0.5."""
    return F.array_repeat(F.lit(value), n_labels)


def route_scoring(df: DataFrame, scorer, default_fake: bool = False, cfg: C.ClassifierConfig = C.DEFAULT,
                  keys: tuple = ("input_index",), carry: tuple = ()) -> DataFrame:
    """Per record ``fake_data`` flag (else the default) picks the dry-run
    scorer or the model; both branches are unioned back by key."""
    flag = F.coalesce(F.col("fake_data").cast("boolean"), F.lit(default_fake)) if "fake_data" in df.columns \
        else F.lit(default_fake)
    df = df.withColumn("_fake", flag)
    k = list(keys) + [c for c in carry if c not in keys]
    real = classify(df.filter(~F.col("_fake")), scorer, cfg, keys, carry).withColumn("fake", F.lit(False))
    kw = dict(thresholds=cfg.thresholds, relabel_active=cfg.relabel_active, relabel_from=cfg.relabel_from,
              relabel_to=cfg.relabel_to, relabel_threshold=cfg.relabel_threshold)
    fake = (df.filter(F.col("_fake")).select(*k).withColumn("scores", constant_scores(len(cfg.labels)))
              .withColumn("categories", F.array(*[F.lit(x) for x in cfg.labels]))
              .withColumn("collections", S.collections("scores", labels=list(cfg.labels), **kw))
              .withColumn("collection_scores", S.collection_scores("scores", labels=list(cfg.labels), **kw))
              .withColumn("fake", F.lit(True)))
    return real.unionByName(fake)


def classify_counts(routed: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """C14: per scoring batch record / real / fake counts and status."""
    return routed.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(~F.col("fake")).alias("real_count"),
        F.count_if(F.col("fake")).alias("fake_count"),
    ).withColumn("status", F.lit("ok"))


def classify_ids(spark: SparkSession, ids_path: str, catalog: DataFrame, out_path: str, scorer, sort: bool = True) -> DataFrame:
    """Ids CSV -> catalogue lookup (D7) -> classify (C13) -> raw scores
    of the assigned collections and their minimum (B22, B23) -> optional
    ascending sort (F6) -> ``<name>_classified.csv``, read back."""
    from labelweave.sources.readers import read_ids_csv
    ids = read_ids_csv(spark, ids_path).withColumnRenamed("bibcode", "identifier")
    found = cut_lineage(catalog.join(ids, "identifier", "left_semi"))
    cl = classify(found, scorer, carry=("identifier", "title", "abstract"))
    cl = cl.withColumn("collection_scores", S.scores_by_label("collections", "scores")).withColumn(
        "minimum_collection_score", S.min_collection_score("collections", "scores"))
    lists = ("categories", "scores", "collections", "collection_scores")
    out = cl.select("identifier", "title", "abstract", *[S.join_list(F.col(c)).alias(c) for c in lists],
                    "minimum_collection_score")
    if sort:
        out = cut_lineage(out)  # a range sort reads its input twice, first for a sample of the keys
        out = out.orderBy(F.col("minimum_collection_score").asc_nulls_last(), "identifier")
    (out.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(out_path))
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out_path)
