"""Exact top-k inner products over norm-sorted vectors.

Vectors are sorted by descending length and cut into blocks; a query first
gets a threshold (its k-th best score in the block of longest vectors), then
meets the blocks whose longest vector can still reach it (Cauchy-Schwarz).
Inside a block, the leading components of an SVD rotation give a partial sum;
what the rest can add is bounded by the product of the residual lengths, and
only pairs whose bound reaches the threshold are scored exactly.

Queries stream past one block at a time, so a task holds one block and one
batch of queries whatever the number of either.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave.llm.common import drop_stage, write_stage

BLOCK_ROWS, LEADING = 4096, 16
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)
_QUERIES = 256
#: Queries that meet a block in one task, and marks on the blocks' lengths.
SLICE_QUERIES, MARKS = 1 << 15, 1024


def usable(col: str) -> Column:
    """Vector present, every component present and finite."""
    fine = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(col).isNotNull() & F.coalesce(fine, F.lit(False))


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """``id, v, norm``: usable vectors with components floor(scale * x) and
    their length; rows without an id take no part."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    out = vectors.filter(F.col(id_col).isNotNull() & usable(vec_col)).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v"))
    return out.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column, shorter vectors padded with zeros."""
    rows = [np.asarray(v, np.float64) for v in column]
    if all(len(r) == dim for r in rows):
        return np.stack(rows) if rows else np.zeros((0, dim))
    return np.stack([np.pad(r, (0, dim - len(r))) for r in rows])


def scores_exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products: doubles where they are exact, whole numbers of
    any size otherwise (clipped to a long)."""
    if not len(q) or not len(c):
        return np.zeros((len(q), len(c)), np.int64)
    if np.sqrt((q * q).sum(1).max() * (c * c).sum(1).max()) < EXACT:
        return (q @ c.T).astype(np.int64)
    big = np.vectorize(int, otypes=[object])
    return np.clip(big(q).dot(big(c).T), -(1 << 63), (1 << 63) - 1).astype(np.int64)


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first, from the Gram
    matrix (dim x dim cells, summed on the executors)."""
    def gram(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            x = matrix(b.column(0).to_numpy(zero_copy_only=False), dim)
            total += x.T @ x
        yield pa.record_batch({"cell": pa.array(np.arange(dim * dim)), "x": pa.array(total.ravel())})
    cells = rows.select("v").mapInArrow(gram, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()
    g = np.zeros(dim * dim)
    for r in cells:
        g[r.cell] = r.x
    return np.linalg.eigh(g.reshape(dim, dim))[1][:, ::-1].copy()


def best_of_block(qid, q, thr, cid, c, rot, k):
    """(query index, candidate index, score) of each query's k best in a
    block whose bound reaches its threshold, ties to smaller ids."""
    lead = rot[:, :LEADING]
    ql, cl = q @ lead, c @ lead
    q2, c2 = (q * q).sum(1), (c * c).sum(1)
    rest = np.outer(np.sqrt(np.maximum(q2 - (ql * ql).sum(1), 0)), np.sqrt(np.maximum(c2 - (cl * cl).sum(1), 0)))
    bound = ql @ cl.T + rest
    bound += 1e-9 * np.outer(np.sqrt(q2), np.sqrt(c2)) + 1e-6
    live = (bound >= thr[:, None]) & (qid[:, None] != cid[None, :])
    col = np.flatnonzero(live.any(0))
    s = scores_exact(q, c[col])
    live = live[:, col] & (s >= thr[:, None])
    out = []
    for i in np.flatnonzero(live.any(1)):
        at = np.flatnonzero(live[i])
        if len(at) > k:
            cut = np.partition(s[i, at], len(at) - k)[len(at) - k]
            at = at[s[i, at] >= cut]
        at = at[np.lexsort((cid[col[at]], -s[i, at]))][:k]
        out.extend((int(qid[i]), int(cid[col[j]]), int(s[i, j])) for j in at)
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` where
    ``is_query`` (over column ``id``), the k rows with the largest integer
    inner product (all, if fewer), ties to the smaller id.  Rows with a
    query's own id are no candidates for it.  Null vectors and vectors with
    null or non-finite components take no part; shorter vectors count as
    padded with zeros; a row that repeats is a candidate each time and one
    query; further columns are not read; an empty table gives an empty result."""
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score long"
    spread = quantized(vectors, id_col, vec_col, scale).repartitionByRange(F.desc("norm"), F.col("id"))
    place = F.monotonically_increasing_id()
    rows, path = write_stage(spread.sortWithinPartitions(F.desc("norm"), "id").withColumn(
        "block", F.shiftleft(F.shiftright(place, 33), 33) + F.floor(
            place.bitwiseAND(F.lit((1 << 33) - 1)) / BLOCK_ROWS)), "vectors")
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], empty)
    dim = max(1, dim)
    rot = rotation(rows, dim)
    blocks = rows.groupBy("block").agg(F.max("norm").alias("longest")).withColumn(
        "place", F.row_number().over(Window.orderBy(F.desc("longest"), "block")))
    blocks, blocks_path = write_stage(blocks, "blocks")
    first, count = blocks.agg(F.min_by("block", "place"), F.max("place")).first()
    lead = rows.filter(F.col("block") == first).select("id", "v").toPandas()
    lead_id, lead_v = lead["id"].to_numpy(np.int64), matrix(lead["v"], dim)

    @F.pandas_udf("double")
    def threshold(ids: pd.Series, vs: pd.Series) -> pd.Series:
        out = np.full(len(ids), -np.inf)
        for a in range(0, len(ids), _QUERIES):
            own = ids.to_numpy()[a:a + _QUERIES]
            s = scores_exact(matrix(vs.iloc[a:a + _QUERIES], dim), lead_v).astype(np.float64)
            s[own[:, None] == lead_id[None, :]] = -np.inf
            if s.shape[1] >= k:
                out[a:a + _QUERIES] = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        return pd.Series(out)

    queries = rows.filter(is_query).select("id", "v", "norm").distinct().select(
        "*", threshold("id", "v").alias("thr"), F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)).alias("h"))
    queries, queries_path = write_stage(queries, "queries")
    slices = max(1, -(-queries.count() // SLICE_QUERIES))
    queries = queries.withColumn("slice", F.col("h") % slices)
    # blocks are sorted by length: a query's last one lies before the first mark too short for it
    reach = F.col("norm") * F.col("longest") * (1 + 1e-9) + 1e-6 >= F.col("thr")
    every = max(1, -(-int(count) // MARKS))
    marks = blocks.filter(F.col("place") % every == 0).orderBy("place").limit(MARKS).collect()
    out_of_reach = F.filter(F.array(*[F.struct(F.lit(float(r.longest)).alias("longest"), F.lit(int(r.place)).alias("place"))
                                      for r in marks]), lambda m: ~(
        F.col("norm") * m["longest"] * (1 + 1e-9) + 1e-6 >= F.col("thr"))) if marks else F.array()
    last = F.when(F.size(out_of_reach) > 0, F.get(out_of_reach, 0)["place"]).otherwise(F.lit(int(count))) if marks else F.lit(
        int(count))
    # ids alone meet the blocks; vectors follow for the pairs that are left
    pairs, pairs_path = write_stage(queries.select("h", "id", "norm", "thr", "slice", last.alias("last")).select(
        "h", "id", "norm", "thr", "slice", F.explode(F.sequence(F.lit(1).cast("long"), F.col("last").cast("long"))).alias("place"))
        .join(blocks.withColumn("place", F.col("place").cast("long")), "place").filter(reach).select("block", "slice", "h", "id"),
        "pairs")
    asked = pairs.join(queries.select("h", "id", "v", "thr"), ["h", "id"]).distinct().select(
        "block", "slice", F.lit(1).alias("kind"), "id", "v", "thr")
    held = rows.join(pairs.select("block", "slice").distinct(), "block").select(
        "block", "slice", F.lit(0).alias("kind"), "id", "v", F.lit(0.0).alias("thr"))
    stream = held.unionByName(asked).repartition("block", "slice").sortWithinPartitions("block", "slice", "kind").drop("slice")

    def search(batches):
        at, ids, vs, ready = None, [], [], None
        for b in batches:
            if not b.num_rows:
                continue
            block, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            ident, thr = b.column(2).to_numpy(), b.column(4).to_numpy()
            edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            found = []
            for a, z in zip([0, *edges], [*edges, len(block)]):
                if block[a] != at:
                    at, ids, vs, ready = block[a], [], [], None
                part = matrix(b.column(3).slice(a, z - a).to_numpy(zero_copy_only=False), dim)
                if kind[a] == 0:
                    ids.append(ident[a:z])
                    vs.append(part)
                    continue
                if ready is None:
                    ready = np.concatenate(ids), np.concatenate(vs)
                for i in range(0, z - a, _QUERIES):
                    j = min(z - a, i + _QUERIES)
                    found += best_of_block(ident[a + i:a + j], part[i:j], thr[a + i:a + j], *ready, rot, k)
            q, v, s = zip(*found) if found else ((), (), ())
            yield pa.record_batch({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()),
                                   "score": pa.array(s, pa.int64())})

    found, _ = write_stage(stream.mapInArrow(search, "query_id long, vec_id long, score long"), "found")
    drop_stage(spark, path, blocks_path, queries_path, pairs_path)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
