import math

import duckdb
import pytest

import __spark_entry__ as E
from labelweave.plans import catalog
from labelweave.session import TABLES

ROWS_ONLY: set[str] = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) == {"level", "name", "n_records"}


def test_every_query_has_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.queries())
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == ROWS_ONLY


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    return con


FAST = ["b01_identifier_kind", "b11_fingerprint", "b16_summary_scores", "c09_batch_shape_metrics",
        "c13_classify", "d01_resolve_override", "d06_run_results", "e04_stage_latency", "e13_gate",
        "f02_recently_validated", "g01_index_batch", "g05_validation_outcome", "a01_read_new_records",
        "a08_parse_search_response", "h05_stream_events"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, sf_small, duck, name):
    sdf = E.queries()[name](spark, sf_small)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    exp = sorted((tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert got == exp


BAD_PLAN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_nested_loop_or_cartesian_join(spark, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(b in plan for b in BAD_PLAN_NODES), name
