import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from labelweave.llm import merkle

from .conftest import edge_rows


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_leaf(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, arity):
    """Root, and per node the siblings of each level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            k, run = at[i], at[i] // arity * arity
            p.append(("".join(nodes[run:k]), "".join(nodes[k + 1:run + arity])))
            at[i] = k // arity
        nodes = [h("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def brute(rows, arity):
    """Sorted (doc_id, leaf, siblings, subroot, root) of (doc_id, text, lang, source)."""
    groups = defaultdict(list)
    for d, t, lang, source in rows:
        groups[lang].append((d is not None, d or 0, brute_leaf(d, source, lang, len(t) if t is not None else None, t)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = [tree([leaf for *_, leaf in sorted(groups[x])], arity) for x in langs]
    root, above = tree([top for top, _ in trees], arity)
    return sorted(((d if has else None, leaf, p + up, top, root) for lang, (top, paths), up in zip(langs, trees, above)
                   for (has, d, leaf), p in zip(sorted(groups[lang]), paths)), key=repr)


def found(df, **kw):
    out = merkle.merkle_manifest(df.withColumn("n_chars", F.length("text")), **kw).collect()
    return sorted(((r.doc_id, r.leaf, [tuple(s) for s in r.siblings], r.subroot, r.root) for r in out), key=repr)


@pytest.mark.parametrize("arity,levels", [(2, 10), (2, 2), (3, 1)])
def test_manifest_matches_plain_trees(edge, arity, levels):
    assert found(edge, arity=arity, block_levels=levels) == brute(edge_rows(), arity)


def test_paths_fold_to_the_root_and_a_changed_leaf_does_not(edge):
    other = {"changed": merkle.leaf(F.lit("x"), F.col("doc.text"))}
    out = merkle.merkle_manifest(edge, fields=("doc_id", "text"), payload=other, block_levels=3).select(
        "*", merkle.fold(F.col("leaf"), F.col("siblings")).alias("same"),
        merkle.fold(F.col("changed"), F.col("siblings")).alias("other"), merkle.proof_digest(F.col("siblings")).alias("p"))
    for r in out.collect():
        assert r.same == r.root != r.other
        assert r.p == h("".join(a + b for a, b in r.siblings))


def test_groups_of_any_size_and_rows_that_repeat(spark):
    # a third of the rows in one group, half of them one repeated row
    rows = [(None, "x", "hot", "s")] * 150 + [(i, f"t{i}", "hot", "s") for i in range(150)] + [
        (i, f"u{i}", f"l{i % 7}", None) for i in range(600)] + [(1, "alone", None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(7)
    assert found(df, block_levels=4) == brute(rows, 2)


def test_empty_table_and_one_row(spark, empty):
    assert found(empty) == []
    one = spark.createDataFrame([(5, None, None, "s")], "doc_id long, text string, lang string, source string")
    assert found(one) == brute([(5, None, None, "s")], 2)
    (row,) = merkle.merkle_manifest(one.withColumn("n_chars", F.lit(3))).collect()
    assert row.leaf == row.subroot == row.root and row.siblings == []
