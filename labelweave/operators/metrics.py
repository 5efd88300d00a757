"""E1..E18, D9, D10: pipeline event metrics.

Percentiles are exact with linear interpolation at ``(n-1)*p/100``.  The
default plan ("sort") never gathers a group in one task: rows are reduced to
(group, value, count), so a value that most events share is one row, and
range-partitioned on (group, value), so a hot group spans many partitions;
ranks come from per-(partition, group) sums (a small table); only the values
around each requested rank are kept and interpolated.
"agg" uses Spark's exact ``percentile`` aggregate (fine for bounded groups),
"approx" uses ``percentile_approx`` (bounded memory, approximate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave import config as C
from labelweave.functions.scores import pct_delta, per_minute
from labelweave.operators.requests import ranked
from labelweave.session import cut_lineage

def order_stats(df: DataFrame, groups: list[str], value: str, pcts: list[float],
                rows: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """Exact percentiles per group: ``groups + [p, value]`` (p in 0..100); with
    ``weight`` a row counts that many times.

    1. rows are reduced to (group, value, count), so a value held by any share
       of the rows is one row, then range-sorted on (group, value) and written
       once with their place (``ranked``; a hot group spans many partitions;
       ``rows`` passes such a copy in);
    2. per (partition, group) segment: the counts' sum (small table) -> each
       segment's global rank range;
    3. the ranks each percentile needs (2 per percentile per group) are mapped
       to segments on that small table, which is written so that the optimizer
       joins it by its known size;
    4. inside a segment a running sum of the counts gives each value its ranks;
       the values that hold a needed rank are picked and interpolated."""
    s = (rows if rows is not None else _ranked_values(df, groups, value, weight)).filter(F.col("_v").isNotNull())
    seg = s.groupBy("_pid", *groups).agg(F.sum("_c").alias("_n"))
    per = Window.partitionBy(*groups)
    seg = (seg.withColumn("_before", F.sum("_n").over(per.orderBy("_pid")) - F.col("_n"))
              .withColumn("_total", F.sum("_n").over(per)))
    share = F.explode(F.array(*[F.lit(min(max(float(p), 0.0), 100.0)) for p in pcts]))
    at = (F.col("_total") - 1) * F.col("p") / 100.0
    need = (seg.withColumn("p", share).withColumn("_lo", F.floor(at).cast("long"))
               .withColumn("_w", at - F.col("_lo"))
               .withColumn("_rank", F.explode(F.array_distinct(F.array(
                   "_lo", F.least(F.col("_lo") + 1, F.col("_total") - 1))))))
    inside = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    part = F.when(F.col("_total") - 1 == F.col("_lo"), F.lit(1.0)).when(
        F.col("_rank") == F.col("_lo"), 1.0 - F.col("_w")).otherwise(F.col("_w"))
    where = cut_lineage(need.filter(inside).select(
        F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        (F.col("_rank") - F.col("_before")).alias("_at"), "p", part.alias("_part")))
    upto = F.sum("_c").over(Window.partitionBy("_pid", *groups).orderBy("_local"))
    held = s.withColumn("_end", upto)
    same = held["_pid"] == where["_p"]
    for i, g in enumerate(groups):
        same = same & held[g].eqNullSafe(where[f"_g{i}"])
    picked = held.join(where, same & (F.col("_at") < F.col("_end")) & (F.col("_at") >= F.col("_end") - F.col("_c")))
    return picked.groupBy(*groups, "p").agg(F.sum(F.col("_v") * F.col("_part")).alias("value"))


def _ranked_values(df: DataFrame, groups: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Distinct values of each group with their counts, ranked."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counted = df.select(*groups, F.col(value).cast("double").alias("_v"), *([weight] if weight else [])).groupBy(
        *groups, "_v").agg(n.alias("_c"))
    return ranked(counted, [*groups, "_v"])


def _pname(p: float) -> str:
    return f"p{int(p)}" if float(p).is_integer() else "p" + str(p).replace(".", "_")


def numeric_stats(df: DataFrame, groups: list[str], value: str, include_p99: bool = True,
                  method: str = "sort", weight: str | None = None) -> DataFrame:
    """Count, min, max, mean, p50, p95 [, p99] of ``value`` per group
    (NULL values skipped; a group with none has count 0 and NULL stats).  With
    ``weight`` ("sort" only) a row counts that many times."""
    pcts = [50.0, 95.0] + ([99.0] if include_p99 else [])
    v = F.col(value).cast("double")
    if method == "sort":
        rows = _ranked_values(df, groups, value, weight)
        n = F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))), F.lit(0))
        base = rows.groupBy(*groups).agg(n.alias("count"), F.min("_v").alias("min"), F.max("_v").alias("max"),
                                         F.sum(F.col("_v") * F.col("_c")).alias("_sum")).select(
            *groups, "count", "min", "max", (F.col("_sum") / F.nullif("count", F.lit(0))).alias("mean"))
        long = order_stats(df, groups, value, pcts, rows)
        wide = long.groupBy(*groups).pivot("p", pcts).agg(F.first("value"))
        wide = wide.select(*groups, *[F.col(f"`{p}`").alias(_pname(p)) for p in pcts])
        return base.join(wide, groups, "left")
    base = df.groupBy(*groups).agg(F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"))
    if method == "agg":
        pc = [F.percentile(v, F.lit(p / 100.0)).alias(_pname(p)) for p in pcts]
    else:
        pc = [F.percentile_approx(v, F.lit(p / 100.0), 10000).cast("double").alias(_pname(p)) for p in pcts]
    extra = df.groupBy(*groups).agg(*pc)
    return base.join(extra, groups, "left")


def pctl(col, p: float, method: str = "agg") -> Column:
    """E1 as an aggregate expression (for bounded groups)."""
    q = min(max(p, 0.0), 100.0) / 100.0
    if method == "approx":
        return F.percentile_approx(F.col(col).cast("double"), F.lit(q), 10000).cast("double")
    return F.percentile(F.col(col).cast("double"), F.lit(q))


def event_counts(events: DataFrame, by: list[str] = ("run_id",)) -> DataFrame:
    """Submitted (sum of record_count, default 1, of ingest_enqueue),
    indexed (count of index), forwarded (forward / forward_message),
    failures (status != ok)."""
    st = F.col("stage")
    rc = F.coalesce(F.col("record_count").cast("long"), F.lit(1))
    return events.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(st == "ingest_enqueue", rc)), F.lit(0)).cast("long").alias("records_submitted"),
        F.count_if(st == "index").alias("records_indexed"),
        F.count_if(st.isin(*C.FORWARD_STAGES)).alias("records_forwarded"),
        F.count_if(F.coalesce(F.col("status"), F.lit("ok")) != "ok").alias("failures"))


def stage_name() -> Column:
    """The event's stage; a missing or empty one counts as ``unknown``."""
    return F.coalesce(F.nullif(F.col("stage"), F.lit("")), F.lit("unknown"))


def normalized_durations(events: DataFrame) -> DataFrame:
    """E4 input: durations of every stage but the four named categories;
    classify / index_db divided by record_count when it is > 0."""
    rc = F.coalesce(F.col("record_count").cast("long"), F.lit(0))
    e = events.withColumn("stage", stage_name()).filter(
        F.col("duration_ms").isNotNull() & ~F.col("stage").isin(*C.PERF_NAMED_STAGES))
    norm = F.when(F.col("stage").isin(*C.PER_RECORD_STAGES) & (rc > 0), F.col("duration_ms") / rc).otherwise(
        F.col("duration_ms"))
    return e.withColumn("latency_ms", norm.cast("double"))


def stage_latency(events: DataFrame, by: list[str] = ("run_id",), method: str = "sort") -> DataFrame:
    """Per stage latency stats (count, min, max, mean, p50, p95, p99)."""
    return numeric_stats(normalized_durations(events), [*by, "stage"], "latency_ms", True, method)


def batch_stats(events: DataFrame, by: list[str] = ("run_id",), method: str = "sort") -> tuple[DataFrame, DataFrame]:
    """E5: classify / index_db in batch mode (or record_count > 1): raw
    duration stats and record_count stats (record_count > 0)."""
    rc = F.coalesce(F.col("record_count").cast("long"), F.lit(0))
    b = events.filter(F.col("duration_ms").isNotNull() & F.col("stage").isin(*C.PER_RECORD_STAGES)
                      & (F.coalesce(F.col("batch_mode"), F.lit(False)) | (rc > 1)))
    lat = numeric_stats(b, [*by, "stage"], "duration_ms", True, method)
    sizes = numeric_stats(b.filter(rc > 0).withColumn("size", rc.cast("double")), [*by, "stage"], "size", True,
                          method)
    return lat, sizes


def named_timings(events: DataFrame, by: list[str] = ("run_id",), method: str = "sort") -> DataFrame:
    """Stats by (category, extra name) for the four named categories."""
    e = events.filter(F.col("duration_ms").isNotNull() & F.col("stage").isin(*C.PERF_NAMED_STAGES)).withColumn(
        "name", F.coalesce(F.nullif(F.col("name").cast("string"), F.lit("")), F.lit("unknown")))
    return numeric_stats(e, [*by, "stage", "name"], "duration_ms", True, method)


def errors_by_stage(events: DataFrame, by: list[str] = ("run_id",)) -> DataFrame:
    """Non-ok events per stage."""
    return (events.withColumn("stage", stage_name()).filter(F.coalesce(F.col("status"), F.lit("ok")) != "ok")
                  .groupBy(*by, "stage").agg(F.count(F.lit(1)).alias("errors")))


def throughput(events: DataFrame, by: list[str] = ("run_id",), started: Column | None = None,
               ended: Column | None = None) -> DataFrame:
    """wall = max(0, end - start) (given or min/max ts); records/min =
    indexed / wall * 60, NULL when the wall time is 0."""
    g = events.groupBy(*by).agg(F.min("ts").alias("_start"), F.max("ts").alias("_end"),
                                F.count_if(F.col("stage") == "index").alias("records_indexed"))
    start = started if started is not None else F.col("_start")
    end = ended if ended is not None else F.col("_end")
    wall = F.when(start.isNotNull() & end.isNotNull(), F.greatest(F.lit(0.0), (end - start).cast("double")))
    return (g.withColumn("wall_clock_s", wall)
             .withColumn("overall_records_per_minute", per_minute("records_indexed", "wall_clock_s"))
             .drop("_start", "_end"))


def backlog(indexed: Column, expected: Column) -> tuple[Column, Column]:
    """(backlog, status): backlog = max(0, expected - indexed), NULL
    without an expectation; status 'incomplete' when backlog > 0."""
    b = F.when(expected.isNotNull(), F.greatest(F.lit(0), expected - indexed))
    status = F.when(F.coalesce(b, F.lit(0)) > 0, F.lit("incomplete")).otherwise(F.lit("complete"))
    return b, status


def summarize_events(events: DataFrame, expected: Column | None = None, by: list[str] = ("run_id",),
                     method: str = "sort") -> DataFrame:
    """One flat row per run: counts, throughput, backlog/status, p95 of
    every stage as a map, and the bottleneck stage."""
    by = list(by)
    cnt = event_counts(events, by)
    thr = throughput(events, by).drop("records_indexed")
    lat = stage_latency(events, by, method)
    p95 = lat.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("stage", "p95"))).alias("p95_by_stage"),
                               F.count(F.lit(1)).alias("n_stages"))
    bn = bottleneck(lat, by)
    out = cnt.join(thr, by).join(p95, by, "left").join(bn, by, "left")
    exp = expected if expected is not None else F.lit(None).cast("long")
    b, status = backlog(F.col("records_indexed"), exp)
    return out.withColumn("backlog", b).withColumn("status", status)


def event_measures(events: DataFrame, by: list[str] = ("run_id",)) -> DataFrame:
    """Every duration and size that E10 summarises, one row each: ``section``
    (latency_ms, batch_latency_ms, batch_sizes or a named stage), ``name``
    (stage, or the event's name) and ``value``; one pass over the events."""
    rc = F.coalesce(F.col("record_count").cast("long"), F.lit(0))
    d, stage = F.col("duration_ms").cast("double"), stage_name()
    per_record, named = stage.isin(*C.PER_RECORD_STAGES), stage.isin(*C.PERF_NAMED_STAGES)
    batch = per_record & (F.coalesce(F.col("batch_mode"), F.lit(False)) | (rc > 1))
    label = F.coalesce(F.nullif(F.col("name").cast("string"), F.lit("")), F.lit("unknown"))

    def row(section, name, value, when):
        return F.when(when, F.struct(section.alias("section"), name.alias("name"), value.alias("value")))
    rows = F.array_compact(F.array(
        row(F.lit("latency_ms"), stage, F.when(per_record & (rc > 0), d / rc).otherwise(d), ~named),
        row(F.lit("batch_latency_ms"), stage, d, batch),
        row(F.lit("batch_sizes"), stage, rc.cast("double"), batch & (rc > 0)),
        row(stage, label, d, named)))
    return events.filter(d.isNotNull()).select(*by, F.explode(rows).alias("m")).select(*by, "m.*")


def event_report(events: DataFrame, by: list[str] = ("run_id",), method: str = "sort") -> DataFrame:
    """E10's statistics in full: per run, section and name the count, min,
    max, mean, p50, p95, p99; section ``errors`` counts non-ok events."""
    by = list(by)
    stats = numeric_stats(event_measures(events, by), [*by, "section", "name"], "value", True, method)
    errors = errors_by_stage(events, by).select(
        *by, F.lit("errors").alias("section"), F.col("stage").alias("name"), F.col("errors").alias("count"))
    return stats.unionByName(errors, allowMissingColumns=True)


def bottleneck(latency: DataFrame, by: list[str] = ("run_id",)) -> DataFrame:
    """Stage with the highest p95 (ties: alphabetically first)."""
    w = Window.partitionBy(*by).orderBy(F.col("p95").desc(), F.col("stage").asc())
    top = latency.filter(F.col("p95").isNotNull()).withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    return top.select(*by, F.col("stage").alias("bottleneck_stage"), F.col("p95").alias("bottleneck_p95"))


SAMPLE_METRICS = ["normalized_load_1m", "normalized_load_5m", "normalized_load_15m", "memory_available_ratio"]


def system_summary(samples: DataFrame, by: list[str] = ("run_id",), method: str = "sort") -> DataFrame:
    """Stats (no p99) of the normalized loads and memory ratio over the
    samples of each run (NULL samples skipped); platform, cpu_count and
    memory_probe from the first."""
    by = list(by)
    long = samples.select(*by, "ts", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in SAMPLE_METRICS])).alias("x"))
    long = long.select(*by, "x.metric", "x.v")
    stats = numeric_stats(long, [*by, "metric"], "v", False, method)
    first = samples.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sample_count"),
        *[F.min_by(c, "ts").alias(c) for c in ("platform", "cpu_count", "memory_probe") if c in samples.columns])
    return stats.join(first, by, "left")


def load_adjust(throughput_df: DataFrame, system: DataFrame, by: list[str] = ("run_id",)) -> DataFrame:
    """factor = max(1, mean 1-min load) (1 without samples); adjusted =
    raw records/min x factor."""
    by = list(by)
    m = system.filter(F.col("metric") == "normalized_load_1m").select(*by, F.col("mean").alias("_load"))
    j = throughput_df.join(m, by, "left")
    factor = F.when(F.col("_load").isNotNull(), F.greatest(F.lit(1.0), F.col("_load"))).otherwise(F.lit(1.0))
    return (j.withColumn("host_load_adjustment_factor", factor)
             .withColumn("load_adjusted_records_per_minute", F.col("overall_records_per_minute") * factor)
             .drop("_load"))


def run_summaries(events: DataFrame, samples: DataFrame, by: list[str] = ("run_id",)) -> DataFrame:
    """E8 + E11 + E12 per run: throughput, load factor and adjusted
    throughput, mean 1-min load and mean memory ratio."""
    by = list(by)
    means = samples.groupBy(*by).agg(F.avg(F.col("normalized_load_1m").cast("double")).alias("mean_load_1m"),
                                     F.avg(F.col("memory_available_ratio").cast("double")).alias("mean_memory_ratio"))
    load = means.select(*by, F.lit("normalized_load_1m").alias("metric"), F.col("mean_load_1m").alias("mean"))
    return load_adjust(throughput(events, by), load, by).join(means, by, "left")


def gate_for_runs(events: DataFrame, samples: DataFrame, candidate: str, baseline: str,
                  min_gain_pct: float = C.MIN_THROUGHPUT_GAIN_PCT,
                  p95_limit_pct: float = C.P95_REGRESSION_LIMIT_PCT, method: str = "sort") -> DataFrame:
    """E13 from event and sample tables: only the two runs' rows are read
    (the run filter is pushed to the scan), their per-run summary and
    per-stage latency tables (a few rows per run) are materialised once and
    compared, so neither is derived twice."""
    runs = [str(candidate), str(baseline)]
    ev = events.filter(F.col("run_id").cast("string").isin(*runs))
    smp = samples.filter(F.col("run_id").cast("string").isin(*runs))
    summ = cut_lineage(run_summaries(ev, smp))
    lat = cut_lineage(stage_latency(ev, method=method))
    cmp = compare_stages(lat.filter(F.col("run_id") == runs[0]), lat.filter(F.col("run_id") == runs[1]))
    return evaluate_gate(summ.filter(F.col("run_id") == runs[0]), summ.filter(F.col("run_id") == runs[1]), cmp,
                         min_gain_pct, p95_limit_pct)


def compare_stages(cand: DataFrame, base: DataFrame) -> DataFrame:
    """Candidate vs baseline p95 on stages present in both (inner join)."""
    c = cand.select("stage", F.col("p95").alias("cand_p95"))
    b = base.select("stage", F.col("p95").alias("base_p95"))
    return c.join(b, "stage").withColumn("p95_delta_pct", pct_delta("cand_p95", "base_p95"))


# Why a gate fails.
GATE_REASONS = {"throughput": "throughput improvement below threshold",
                "latency": "p95 latency regression exceeded threshold"}


def evaluate_gate(cand_summary: DataFrame, base_summary: DataFrame, stage_cmp: DataFrame,
                  min_gain_pct: float = C.MIN_THROUGHPUT_GAIN_PCT,
                  p95_limit_pct: float = C.P95_REGRESSION_LIMIT_PCT) -> DataFrame:
    """pass = throughput gain >= min AND no common stage's p95 grew by
    more than the limit.  Inputs are one-row summaries (E8+E11+E12 columns)."""
    # both summaries into one row with a single aggregate (no join)
    cols = [x for x in cand_summary.columns if x in base_summary.columns]
    both = (cand_summary.select(*cols, F.lit("c").alias("_role"))
            .unionByName(base_summary.select(*cols, F.lit("b").alias("_role"))))
    j = both.agg(*[F.max(F.when(F.col("_role") == r, F.col(x))).alias(f"{r}_{x}") for r in ("c", "b") for x in cols])
    regressed = stage_cmp.select(F.coalesce(F.max(F.col("p95_delta_pct") > p95_limit_pct), F.lit(False))).scalar()
    common = stage_cmp.select(F.count(F.lit(1))).scalar()
    deltas = stage_cmp.select(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", "p95_delta_pct"))))).scalar()
    j = (j.withColumn("_regressed", regressed).withColumn("common_stages", common)
          .withColumn("p95_delta_pct_by_stage", deltas))
    tdelta = pct_delta("c_overall_records_per_minute", "b_overall_records_per_minute")
    adelta = pct_delta("c_load_adjusted_records_per_minute", "b_load_adjusted_records_per_minute")
    tpass = F.coalesce(tdelta >= min_gain_pct, F.lit(False))
    ppass = ~F.col("_regressed")
    reasons = F.array_compact(F.array(
        F.when(~tpass, F.lit(GATE_REASONS["throughput"])), F.when(~ppass, F.lit(GATE_REASONS["latency"]))))
    return j.select(
        (tpass & ppass).alias("pass"), tdelta.alias("throughput_delta_pct"),
        adelta.alias("load_adjusted_throughput_delta_pct"), reasons.alias("reasons"), "common_stages",
        "p95_delta_pct_by_stage",
        F.col("b_mean_load_1m").alias("baseline_mean_normalized_load_1m"),
        F.col("c_mean_load_1m").alias("candidate_mean_normalized_load_1m"),
        F.col("b_mean_memory_ratio").alias("baseline_mean_memory_available_ratio"),
        F.col("c_mean_memory_ratio").alias("candidate_mean_memory_available_ratio"),
        F.lit(min_gain_pct).alias("min_throughput_improvement_pct"),
        F.lit(p95_limit_pct).alias("p95_regression_limit_pct"))


def resolve_event_context(events: DataFrame, contexts: DataFrame, default_enabled: bool = True) -> DataFrame:
    """Fill an event's context_id from its run's registered context and
    keep only events whose context is enabled.  A context-specific entry
    (run_id, context_id) wins over the run-level one (context_id NULL).
    ``contexts``: run_id, context_id, enabled.  Both joins are equi joins;
    the context table is one row per run (plus per-context rows)."""
    spec = contexts.filter(F.col("context_id").isNotNull()).select(
        "run_id", "context_id", F.col("enabled").alias("_en_spec"))
    run_level = contexts.filter(F.col("context_id").isNull()).select(
        "run_id", F.col("enabled").alias("_en_run"), F.col("default_context_id").alias("_ctx_run"))
    j = events.join(spec, ["run_id", "context_id"], "left").join(run_level, "run_id", "left")
    ctx = F.coalesce(F.col("context_id"), F.col("_ctx_run"))
    en = F.coalesce(F.col("_en_spec"), F.col("_en_run"), F.lit(default_enabled))
    return j.withColumn("context_id", ctx).withColumn("enabled", en).filter("enabled").drop(
        "_en_spec", "_en_run", "_ctx_run")

