"""F1, F3, F7, F9 and the either-id resolution used by D1, D2, D5.

"Newest row per key" is ``max_by(struct(row), struct(order))``: a partial +
final aggregate, so a key holding a third of all rows is combined map-side
instead of landing whole in one task.

A record may be found by scix_id OR bibcode.  An OR join condition plans as
a nested-loop join, so it is rewritten as two equi joins (one per id kind)
whose results are coalesced (scix_id first) or unioned (newest of either).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelweave.functions.ids import nonblank
from labelweave.operators.requests import dense_index


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def latest_per_key(df: DataFrame, key, order: list[str]) -> DataFrame:
    """newest row per key (largest ``order`` tuple, e.g. created then id)."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in df.columns]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), _order_struct(order)).alias("_best")
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(best).select("_best.*")


def dedupe_results(df: DataFrame, newest_first: list[str], bibcode="bibcode", scix_id="scix_id") -> DataFrame:
    """first row per result key (scix_id when non-empty, else bibcode)
    when rows are ordered by ``newest_first`` descending.  Written as the
    latest-per-key aggregate, so a hot key is combined map-side rather than
    sorted whole in one task."""
    k = (df.withColumn("_rk", F.when(nonblank(scix_id).isNotNull(), F.lit("scix_id")).otherwise(F.lit("bibcode")))
           .withColumn("_rv", F.coalesce(nonblank(scix_id), F.col(bibcode))))
    return latest_per_key(k, ["_rk", "_rv"], newest_first).drop("_rk", "_rv")


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


MAX_BROADCAST_IDS = 2_000_000  # ids of one batch we agree to broadcast for a prefetch


def _maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _join_by_ids(records: DataFrame, table: DataFrame, order: list[str], bibcode="bibcode",
                 scix_id="scix_id", ids_from: DataFrame | None = None, ids_small: bool = False) -> DataFrame:
    """Left-join each record to the newest ``table`` row per scix_id
    (``_s_*``) and per bibcode (``_b_*``).  The table side is reduced to one
    row per id before the join, so a hot id costs one row, not all of its."""
    # prefetch: only table rows whose id occurs in the batch (semi joins), so
    # the per-batch work follows the batch size, not the table size
    src = ids_from if ids_from is not None else records
    s_ids = src.select(nonblank(F.col(scix_id)).alias("scix_id")).filter(F.col("scix_id").isNotNull())
    b_ids = src.select(nonblank(F.col(bibcode)).alias("bibcode")).filter(F.col("bibcode").isNotNull())
    s_ids, b_ids = _maybe_broadcast(s_ids, ids_small), _maybe_broadcast(b_ids, ids_small)
    by_s = _prefixed(latest_per_key(table.join(s_ids, "scix_id", "left_semi"), "scix_id", order), "_s_")
    by_b = _prefixed(latest_per_key(table.join(b_ids, "bibcode", "left_semi"), "bibcode", order), "_b_")
    return (records.join(by_s, nonblank(F.col(scix_id)) == F.col("_s_scix_id"), "left")
                   .join(by_b, nonblank(F.col(bibcode)) == F.col("_b_bibcode"), "left"))


def resolve_by_either_id(records: DataFrame, table: DataFrame, order: list[str], prefix: str,
                         bibcode="bibcode", scix_id="scix_id", ids_from: DataFrame | None = None,
                         ids_small: bool = False) -> DataFrame:
    """D1 / D5 rule: newest ``table`` row with the record's scix_id; if there
    is none, newest with its bibcode.  Adds the chosen row's columns with
    ``prefix``.  ``ids_from``: a cheaper frame with the same ids to prefetch
    by (e.g. the materialised batch); ``ids_small``: its size was checked
    against ``MAX_BROADCAST_IDS`` and it may be broadcast."""
    j = _join_by_ids(records, table, order, bibcode, scix_id, ids_from, ids_small)
    use_s = F.col("_s_id").isNotNull()
    picked = [F.when(use_s, F.col("_s_" + c)).otherwise(F.col("_b_" + c)).alias(prefix + c) for c in table.columns]
    return j.select(*records.columns, *picked)


def resolve_newest_either(records: DataFrame, table: DataFrame, order: list[str], prefix: str,
                          key: str = "input_index", bibcode="bibcode", scix_id="scix_id",
                          ids_from: DataFrame | None = None, ids_small: bool = False) -> DataFrame:
    """D2 rule: newest ``table`` row matching EITHER id = the newer of the
    newest row by scix_id and the newest row by bibcode."""
    j = _join_by_ids(records, table, order, bibcode, scix_id, ids_from, ids_small)
    s_ord = F.struct(*[F.col("_s_" + c) for c in order])
    b_ord = F.struct(*[F.col("_b_" + c) for c in order])
    use_s = F.col("_s_id").isNotNull() & (F.col("_b_id").isNull() | (s_ord >= b_ord))
    picked = [F.when(use_s, F.col("_s_" + c)).otherwise(F.col("_b_" + c)).alias(prefix + c) for c in table.columns]
    return j.select(*records.columns, *picked)


def exists_by_either_id(records: DataFrame, table: DataFrame, extra: list[tuple[str, str]] = (),
                        key: str = "input_index", bibcode="bibcode", scix_id="scix_id") -> DataFrame:
    """Keys of the records that have at least one ``table`` row with the
    same scix_id or bibcode (and equal ``extra`` (record col, table col)
    pairs): two semi joins, never more rows than records."""
    def cond(rid, tid):
        c = nonblank(F.col(rid)) == F.col("_t_" + tid)
        for rc, tc in extra:
            c = c & (F.col(rc) == F.col("_t_" + tc))
        return c
    t = _prefixed(table, "_t_")
    a = records.join(t, cond(scix_id, "scix_id"), "left_semi").select(key)
    b = records.join(t, cond(bibcode, "bibcode"), "left_semi").select(key)
    return a.unionByName(b).distinct()


def with_surrogate_ids(df: DataFrame, base: Column | int, order: list[str], name: str = "id") -> DataFrame:
    """ids ``base + 1 + dense position in order`` for new rows."""
    b = base if isinstance(base, Column) else F.lit(base)
    return dense_index(df, order, "_pos").withColumn(name, b + 1 + F.col("_pos")).drop("_pos")


def max_id(table: DataFrame, col: str = "id") -> Column:
    """Scalar subquery ``(SELECT coalesce(max(id), 0) FROM table)``."""
    return table.select(F.coalesce(F.max(col), F.lit(0)).alias("m")).scalar()


def new_runs(spark, runs: DataFrame, requests: DataFrame, key: str = "batch_id", created=None) -> DataFrame:
    """one new run row per distinct ``key`` lacking a run; ids continue the
    run table's sequence."""
    need = requests.select(key).distinct()
    fresh = with_surrogate_ids(need, max_id(runs), [key], "id")
    return fresh.withColumn("created", created if created is not None else F.current_timestamp())
