"""Quality classifier on supervised subword embeddings.

A text is a bag of hashed features: its words, their shapes, character n-grams
of the words, and a mark for a word that repeats the one before.  Every
feature bucket has a learned vector; a document is the average of its
features' vectors; a softmax over it gives the label's probability.  Training
is stochastic gradient descent in numpy over a bounded, hash-chosen sample of
labelled rows, whose features are counted on the executors.

Because the average is linear, a word's contribution to the score can be
remembered: scoring a document is a lookup per word.
"""

from __future__ import annotations

import math
import operator
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelweave.llm.common import write_stage

BUCKETS, DIM, GRAMS = 1 << 15, 16, (3, 4)
FIT_ROWS, EPOCHS, RATE = 4000, 6, 0.5
MEMO_ENTRIES, MEMO_CHARS = 600_000, 64
REPEAT = BUCKETS
#: How a sampled document's features travel to the trainer.
_AT, _SHARE = np.dtype("<u2"), np.dtype("<f4")
_SHAPES = [(re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[a-zß-öø-ÿ]+"), "a"), (re.compile(r"[0-9]+"), "0")]


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def shape(word: str) -> str:
    for rx, to in _SHAPES:
        word = rx.sub(to, word)
    return word


def features(word: str) -> list[int]:
    """Buckets of one white-space separated word."""
    w = f"<{word}>"
    out = [bucket("w" + word), bucket("s" + shape(word))]
    for n in GRAMS:
        out += [bucket(w[i:i + n]) for i in range(len(w) - n + 1)]
    return out


def repeats(words: list[str]) -> int:
    return sum(map(operator.eq, words, words[1:]))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of a whole text and their shares (none if it has no word)."""
    words = (text or "").split()
    counts = np.zeros(BUCKETS + 1)
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    for w, n in seen.items():
        np.add.at(counts, features(w), n)
    counts[REPEAT] = repeats(words)
    at = np.flatnonzero(counts)
    return at, counts[at] / max(1.0, counts.sum())


class Model:
    """Feature vectors and output layer of two classes."""

    def __init__(self, vectors: np.ndarray, out: np.ndarray, bias: np.ndarray):
        #: What a feature adds to the log odds of class 1, before averaging.
        self.weight = vectors @ (out[1] - out[0])
        self.bias = float(bias[1] - bias[0])
        self.memo: dict[str, tuple[float, int]] = {}

    def __getstate__(self):
        return {"weight": self.weight, "bias": self.bias, "memo": {}}

    def word(self, w: str) -> tuple[float, int]:
        hit = self.memo.get(w)
        if hit is None:
            f = features(w)
            hit = float(self.weight[f].sum()), len(f)
            if len(w) <= MEMO_CHARS:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[w] = hit
        return hit

    def score(self, text: str | None) -> float:
        """Probability of class 1 of a whole text; a text without words has
        the bias alone."""
        words = (text or "").split()
        again = repeats(words)
        total, n = again * float(self.weight[REPEAT]), again
        get = self.memo.get
        hits = [get(w) or self.word(w) for w in words]
        if hits:
            sums, counts = zip(*hits)
            total, n = total + math.fsum(sums), n + sum(counts)
        z = self.bias + (total / n if n else 0.0)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 1) -> Model:
    """Softmax regression over averaged feature vectors, one document a step,
    the step size falling to zero."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / dim, 1.0 / dim, (BUCKETS + 1, dim))
    out, bias = np.zeros((2, dim)), np.zeros(2)
    steps, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            at, share = bags[i][0].astype(np.intp), bags[i][1].astype(np.float64)
            lr = rate * (1 - done / steps)
            done += 1
            rows = vectors[at]
            mean = share @ rows
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            if len(at):
                # steps scaled by the number of features keep short and long texts learning alike
                vectors[at] = rows - (lr * len(at) ** 0.5) * share[:, None] * (p @ out)
            out -= lr * np.outer(p, mean)
            bias -= 0.1 * lr * p
    return Model(vectors, out, bias)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn ``quality`` (0 or 1; other values don't count) of the rows of
    ``labels`` from the text of the document with the same doc_id (the least
    text of rows that repeat the id).  At most ``fit_rows`` labels are used,
    the first by a hash of doc_id; only they reach the driver.  Labels that
    repeat count once."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    order = [F.xxhash64(F.lit("fit"), "doc_id"), F.col("doc_id"), F.col("quality")]
    chosen, _ = write_stage(known.orderBy(*order).limit(fit_rows), "labels")

    @F.pandas_udf("at binary, share binary")
    def bags(texts: pd.Series) -> pd.DataFrame:
        found = [(a.astype(_AT).tobytes(), s.astype(_SHARE).tobytes()) for a, s in map(bag, texts)]
        return pd.DataFrame({"at": [a for a, _ in found], "share": [s for _, s in found]})
    # of rows that repeat an id the least text counts, so no more rows than labels reach the driver
    texts, _ = write_stage(docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id"), "texts")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = (one.join(chosen, "doc_id").select("doc_id", "quality", bags("text").alias("b"))
            .select("doc_id", "quality", "b.*")).limit(fit_rows).toPandas()
    rows = rows.sort_values(["doc_id", "quality"], kind="stable")
    return train([(np.frombuffer(a, _AT), np.frombuffer(s, _SHARE)) for a, s in zip(rows["at"], rows["share"])],
                 rows["quality"].astype(int).tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc`` (struct of the input columns) and ``score``, the probability of
    label 1 from the whole text alone, however long; null and empty texts have
    the score of no evidence; rows that repeat are scored alike; an empty table
    gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), run(docs["text"]).alias("score"))


def held_out(doc_id: Column) -> Column:
    """Every fourth document by CRC-32 of its id's text is not learned from;
    a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
