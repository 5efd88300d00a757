import hashlib
import random
from collections import defaultdict

import pytest
import xxhash

from labelweave.llm import exact_dedup, simhash
from labelweave.llm.common import with_row_identity

from .conftest import edge_rows, with_clashes


def key(x):
    return (x is not None, x or 0)


def test_exact_dedup_matches_grouping(edge):
    got = exact_dedup.exact_dedup(edge, block_chars=64).collect()
    groups = defaultdict(list)
    for d, t, *_ in edge_rows():
        groups[t or ""].append(d)
    want = sorted(((d, max(groups[t or ""], key=key), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for d, t, *_ in edge_rows()), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_block_size_and_layout_do_not_change_the_groups(spark, edge):
    def groups(df, n):
        return sorted((r.doc_id or -1, r.keep_id or -1, r.group_size) for r in exact_dedup.exact_dedup(df, n).collect())
    assert groups(edge, 4096) == groups(edge, 7) == groups(edge.repartition(1).select("*"), 64)


def test_names_tell_apart_texts_that_share_blocks(spark):
    texts = ["abcd" * 3, "abcd" * 4, "abcdabcdabc", "abcdabcd", "abcd", "dcba" + "abcd" * 2, "abcd" * 2 + "dcba"]
    df = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")
    got = exact_dedup.exact_dedup(df, block_chars=4).collect()
    assert len({r.keep_id for r in got}) == len(texts) and all(r.group_size == 2 for r in got)


def test_drop_exact_copies_keeps_columns(edge, empty):
    out = exact_dedup.drop_exact_copies(edge)
    assert out.columns == edge.columns
    texts = [r.text or "" for r in out.select("text").collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in edge_rows()})
    assert exact_dedup.exact_dedup(empty).collect() == []
    assert exact_dedup.drop_exact_copies(empty).collect() == []


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    label = dict(enumerate(range(len(prints))))
    moved = True
    while moved:
        moved = False
        for a in range(len(prints)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 2 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    moved = True
    return label


def test_near_duplicates_match_brute_force(edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    prints = [brute_print(t) for _, t in rows]
    label = brute_components(prints)
    small = {}
    for i, (d, _) in enumerate(rows):
        small.setdefault(label[i], []).append(d)
    want = sorted((str(d), prints[i], str(min((x for x in small[label[i]] if x is not None), default=None)))
                  for i, (d, _) in enumerate(rows))
    got = simhash.near_duplicates(with_row_identity(edge)).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == want
    assert sum(r["first"] for r in got) == len(small)
    assert simhash.near_duplicates(with_row_identity(empty)).collect() == []
    out = simhash.drop_near_duplicates(edge)
    assert out.columns == edge.columns and out.count() == len(small)


@pytest.mark.parametrize("limit", [0, 3, 10_000])
def test_links_are_complete_in_small_and_large_buckets(spark, limit):
    base = 0x0123456789ABCDEF
    prints = {base, 0, 0xFFFFFFFFFFFFFFFF}
    for a in range(0, 64, 5):
        prints |= {base ^ (1 << a), base ^ (1 << a) ^ (1 << (a + 1) % 64), base ^ (7 << (a % 61)), 1 << a, base ^ (31 << (a % 59))}
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    found = simhash.components(simhash.links(df, 2, limit=limit)).collect()
    got = defaultdict(set)
    for r in found:
        got[r["comp"]].add(r.node % (1 << 64))
    label = brute_components(prints)
    want = defaultdict(set)
    for i, p in enumerate(prints):
        want[label[i]].add(p)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_component_of_a_long_chain(spark):
    chain = [(simhash.signed(sum(1 << b for b in range(i))),) for i in range(0, 64, 2)]
    got = simhash.components(simhash.links(spark.createDataFrame(chain, "fp long"))).collect()
    assert len(got) == len(chain) and len({r["comp"] for r in got}) == 1
    assert simhash.components(simhash.links(spark.createDataFrame([], "fp long"))).collect() == []


def test_not_a_file_scan(spark, edge):
    df = with_clashes(edge.select("doc_id", "text").limit(20))
    assert exact_dedup.drop_exact_copies(df).count() <= 20


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("limit", [0, 3, 256])
def test_links_join_the_same_fingerprints_at_every_limit(spark, max_bits, limit):
    rng = random.Random(max_bits)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(20), rng.randint(0, 3))) for b in base for _ in range(30)}
    df = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    found = {frozenset((r.a, r.b)) for r in simhash.links(df, max_bits, limit=limit).collect()}
    real = {frozenset((simhash.signed(x), simhash.signed(y))) for x in fps for y in fps
            if x < y and bin(x ^ y).count("1") <= max_bits}
    assert found <= real

    def classes(pairs):
        top = {}

        def root(x):
            while top.setdefault(x, x) != x:
                x = top[x]
            return x
        for a, b in map(tuple, pairs):
            top[root(a)] = root(b)
        out = defaultdict(set)
        for x in top:
            out[root(x)].add(x)
        return {frozenset(c) for c in out.values()}
    assert classes(found) == classes(real)


def test_a_group_with_most_rows_is_never_packed(spark, monkeypatch):
    from labelweave.llm import common
    monkeypatch.setattr(common, "HOT_ROWS", 50)
    monkeypatch.setattr(common, "HOT_KEYS", 100)
    rows = [(i, "copy " * 2000) for i in range(3000)] + [(None, None)] * 100 + [(10_000 + i, f"own {i % 700}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = exact_dedup.exact_dedup(df)
    assert "ObjectHashAggregate" not in out._jdf.queryExecution().toString()
    got = out.collect()
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == sorted((
        (d, max(groups[t or ""], key=key), len(groups[t or ""])) for d, t in rows), key=repr)
    assert sum(r.kept for r in got) == len(groups)
    near = simhash.near_duplicates(with_row_identity(df)).collect()
    assert sum(r.first for r in near) == len({r.component_id for r in near}) and len(near) == len(rows)


def test_blocks_that_share_a_hash_keep_their_names(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    texts = ["a", "b", "c", "a", "ab", "ba", None, "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = exact_dedup.exact_dedup(df, block_chars=1).collect()
    want = {t: max(i for i, x in enumerate(texts) if x == t) for t in texts}
    assert {r.doc_id: r.keep_id for r in got} == {i: want[t] for i, t in enumerate(texts)}
