import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from labelweave.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string, row_file string"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def order(turn, role, text):
    half = turn_id(role, text)
    return (turn is not None, turn or 0, *(int.from_bytes(half[i:i + 8], "big", signed=True) for i in (0, 8)))


def brute(rows):
    """Sorted result rows for rows (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((order(t, role or "", text or ""), role or "", text or ""))
    convs = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = convs.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, held in members.items():
        value = (len(held) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += value
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(built[c]) == len(node))
        out.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), kids.get(node, 0), leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in P.conversation_trie(df, **kw).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


def conversations(seed, n, longest, say):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-n // 4, n), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t if rng.random() < .9 else None, rng.choice(["user", "assistant", None, ""]), rng.choice(say)))
    return rows


@pytest.mark.parametrize("band,shard_rows", [(32, 1 << 16), (4, 7), (2, 40)])
def test_trie_matches_brute_force(spark, band, shard_rows):
    say = ["a", "b c", None, "", "word " * 30, "é  è\tx\x0by"]
    rows = conversations(band, 90, 6, say) + [(None, 0, "user", "a"), (None, None, None, None)]
    # copies of one conversation, some of them longer than a band, and one that repeats rows
    rows += [(1000 + 20 * k, t, "user", f"t{t}") for k in range(30) for t in range(11)]
    rows += [(2000 + k, t, "user", f"t{t}") for k in range(30) for t in range(11 if k % 3 else 9)]
    rows += [(5000, 0, "user", "same")] * 12
    assert found(spark, rows, band=band, shard_rows=shard_rows) == brute(rows)


def test_a_conversation_with_a_third_of_all_rows(spark):
    rows = [(7, t, "user", f"x{t % 5}") for t in range(300)] + [(c, t, "user", "x0") for c in range(100, 220) for t in range(5)]
    assert found(spark, rows, band=8, shard_rows=20) == brute(rows)


def test_bases_that_are_absent_or_short(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in range(41, 60) for t in range(1 + c % 4)]
    rows += [(80, 0, "user", "base")] + [(c, t, "user", f"{c}") for c in range(81, 100) for t in range(4)]
    got = found(spark, rows)
    assert got == brute(rows) and any(r[1] == 0 and r[7] != P.NO_ENDS for r in got)


def test_empty_table(spark):
    assert found(spark, [(None, 0, "user", "no id")]) == []
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
