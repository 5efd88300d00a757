from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from labelweave.llm import pieces, queries

from .conftest import edge_rows
from .test_dedup import brute_components, brute_print, key
from .test_mixing_sharding import brute_copies, brute_key


def brute_pipeline(rows):
    """All stages on (doc_id, text, lang, source) tuples, in Python."""
    rows = [r for r in rows if any("A" <= c <= "ɏ" and c.isalpha() for c in r[1] or "")]
    same = defaultdict(list)
    for r in rows:
        same[r[1]].append(r)
    rows = [max(g, key=lambda r: key(r[0])) for g in same.values()]
    label = brute_components([brute_print(r[1]) for r in rows])
    near = defaultdict(list)
    for i, r in enumerate(rows):
        near[label[i]].append(r)
    rows = [min(g, key=lambda r: (r[0] is None, r[0])) for g in near.values()]
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1].encode()) + 1
    m = pieces.PieceModel(pieces.default_model())
    out = Counter()
    for r in rows:
        rate = 1.0 * sum(size.values()) * (1.0 / len(size)) / size[r[3]]
        out[(r[0], tuple(m.encode(r[1]).tolist()))] += brute_copies(brute_key(r[0], r[1], 0), rate)
    return +out


def test_run_matches_brute_force(spark, edge, tmp_path):
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == brute_pipeline(edge_rows())


def test_stages_keep_the_columns(spark, edge, empty, tmp_path):
    for docs in (edge, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    assert [r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, empty, "").collect()] == []


def test_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{sf_small}/{t}.parquet'")
    rel = con.sql(queries.ORACLE[name])
    df = queries.QUERIES[name](spark, sf_small).select(*rel.columns)
    value = lambda x: round(x, 9) if isinstance(x, float) else x
    assert sorted((tuple(map(value, r)) for r in df.collect()), key=repr) == sorted(
        (tuple(map(value, r)) for r in rel.fetchall()), key=repr)


