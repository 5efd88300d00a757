import math
import random

from pyspark.sql import functions as F

from labelweave.llm import topk


def brute(rows, is_query, k, scale=256.0):
    ok = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in dict(ok).items():
        if is_query(q):
            s = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in ok if c != q)[:k]
            out += [(q, n + 1, c, -x) for n, (x, c) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=5, kind="double"):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, score string")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 10 == 0, k).collect())


def vectors(seed, n, dim, spread):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) * (1 + (i % 17) * spread) for _ in range(dim)]) for i in range(n)]


def test_matches_brute_force_with_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    for spread in (0.0, 0.5):
        rows = vectors(1, 600, 24, spread)
        assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5)


def test_ties_nulls_repeats_and_lengths(spark):
    rows = vectors(2, 60, 8, 0.2) + [(100 + i, [1.0] * 8) for i in range(200)]
    rows += [(400, None), (410, [1.0, None] * 4), (420, [math.nan] * 8), (430, [math.inf] * 8), (None, [1.0] * 8),
             (440, []), (450, [2.0, 3.0]), (460, [0.0] * 8)]
    rows += rows[:30]  # a row that repeats is a candidate each time
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5)
    assert [r[2] for r in run(spark, [(0, [1.0]), (1, [.5]), (1, [.5]), (2, [.4])])] == [1, 1, 2]


def test_slices_of_queries_and_marks_on_lengths(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "SLICE_QUERIES", 7)
    monkeypatch.setattr(topk, "MARKS", 5)
    rows = vectors(5, 400, 12, 0.8)
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5)


def test_few_rows_and_empty_table(spark):
    assert run(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5])]) == [(0, 1, 1, 128 * 256 + 128 * 512)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_scores_beyond_double_precision_are_exact(spark):
    rows = [(0, [float(1 << 22), 3.0]), (1, [float((1 << 22) + 1), 5.0]), (2, [float(1 << 22), 4.0])]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5)
