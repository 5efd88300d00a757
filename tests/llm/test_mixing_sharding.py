import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from labelweave.llm import mixing, sharding

from .conftest import edge_rows


def brute_key(doc_id, text, nth):
    return "|".join(["null" if doc_id is None else str(doc_id),
                     "null" if text is None else hashlib.md5(text.encode()).hexdigest(), str(nth)])


def brute_copies(key, rate):
    parts = max(1, math.ceil(rate / 16))
    mean, total = rate / parts, 0
    for j in range(1, parts + 1):
        h = hashlib.md5(f"42|{key}|{j}".encode()).hexdigest()[:13]
        u = (int(h, 16) + 0.5) / 2**52
        p = c = math.exp(-mean)
        k = 0
        while u > c and k < 400:
            k += 1
            p *= mean / k
            c += p
            total += 1
    return total


def test_copies_match_brute_force(edge):
    rows = edge_rows()
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len((t or "").encode()) + 1
    weights = {"s0": 3.0, "s1": 0.0, "s2": 30.0}
    w = {s: weights.get(s, 1.0) for s in size}
    rate = {s: 2.0 * sum(size.values()) * (w[s] / sum(w.values())) / size[s] for s in size}
    want, met = Counter(), Counter()
    for d, t, _, s in rows:
        key = brute_key(d, t, met[d, t, s])
        met[d, t, s] += 1
        for c in range(1, (brute_copies(key, rate[s]) if w[s] else 0) + 1):
            want[(d, t, s, c)] += 1
    got = mixing.mix(edge, weights, epochs=2.0)
    assert Counter((r.doc.doc_id, r.doc.text, r.doc.source, r.copy) for r in got.collect()) == want
    assert max(rate.values()) > 16  # means above one part are drawn as sums
    assert mixing.mix(edge, weights).select("doc.*").columns == edge.columns


def test_mixture_does_not_depend_on_the_layout_and_is_shuffled(spark, edge, empty):
    def run(df):
        return sorted((r.shuffle_key, str(r.doc.doc_id), r.copy) for r in mixing.mix(df).collect())
    assert run(edge) == run(edge.repartition(7))
    assert mixing.mix(empty).collect() == []
    df = spark.range(4000).selectExpr("id as doc_id", "'some text' as text", "'s' as source")
    order = [r.doc_id for r in mixing.mix(df).select("doc.doc_id").collect()]
    assert 3700 < len(order) < 4300 and order != sorted(order)
    assert sum(a < b for a, b in zip(order, order[1:])) < 0.6 * len(order)


def test_rows_that_share_an_id_draw_for_themselves(spark):
    rows = [(None, f"t{i}", "a") for i in range(1500)] + [(7, "same", "b")] * 1500 + [(i + 10, f"u{i}", "c") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t) + 1
    got = mixing.mix(df, {s: sizes[s] for s in sizes}).withColumn("_p", F.spark_partition_id()).collect()  # every mean is 1
    copies, parts = Counter(r.doc.source for r in got), Counter(r._p for r in got)
    assert all(abs(copies[s] - 1500) < 3 * 1500 ** 0.5 for s in "abc")
    assert len({r.shuffle_key for r in got}) == len(got)
    sizes = sorted(parts.values())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_poisson_inversion_has_the_right_distribution(spark):
    df = spark.range(20_000).select(mixing.poisson(F.lit(2.5), mixing.uniform(F.lit("t"), F.col("id"))).alias("n"))
    n = [r.n for r in df.collect()]
    mean = sum(n) / len(n)
    assert abs(mean - 2.5) < 0.05 and abs(sum((x - mean) ** 2 for x in n) / len(n) - 2.5) < 0.1


def test_shards_are_near_equal_and_gapless(spark):
    sizes = [(i, "w" * (1 + (i * 7919) % 400) + str(i), "s%d" % (i % 3 if i % 2 else 0), "en") for i in range(3000)]
    sizes += [(10_000 + i, "copy " * 20, "s1", "en") for i in range(1500)] + [(20_000 + i, f"pair {i // 2}", "s%d" % (i % 2), None) for i in range(400)]
    df = spark.createDataFrame(sizes, "doc_id long, text string, source string, lang string")
    got = sharding.shard_documents(df, shards=7).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, *_ in sizes)
    load, slots, where = Counter(), defaultdict(list), defaultdict(set)
    text = {d: t for d, t, *_ in sizes}
    for r in got:
        assert r.size == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[text[r.doc_id]].add(r.shard)
    assert set(load) == set(range(7)) and max(load.values()) < 1.06 * min(load.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for t, v in where.items() if t != "copy " * 20)


def test_sharding_edge_rows(edge, empty, spark):
    got = sharding.shard_documents(edge, shards=4).collect()
    assert len(got) == len(edge_rows()) and {r.shard for r in got} <= set(range(4))
    assert sorted(r.size for r in got) == sorted(len((t or "").encode()) + 16 for _, t, *_ in edge_rows())
    assert sharding.shard_documents(empty).collect() == []
    few = spark.createDataFrame([(1, "a", None, None), (1, "a", None, None), (None, None, "s", "x")],
                                "doc_id long, text string, source string, lang string")
    got = sharding.shard_documents(few, shards=5).collect()
    assert len(got) == 3 and len({(r.shard, r.slot) for r in got}) == 3


def _brute_kd(rows, shards):
    """The tree cut in plain Python, groups that fit a shard placed first (none here exceeds one)."""
    crc = lambda v: 0 if v is None else zlib.crc32(v.encode()) >> 16
    groups, lead = Counter(), {}
    for d, t, s, g in rows:
        same = hashlib.sha256(t.encode()).digest()
        unit = same, 0
        size = len(t.encode()) + 16
        groups[unit] += size
        lead[unit] = min(lead.get(unit, (d, size, s, g)), (d, size, s, g))
    total = Counter()
    for (same, _), w in groups.items():
        total[same] += w
    target = sum(total.values()) / shards
    room, given = [target] * shards, {}
    for same, w in sorted(total.items(), key=lambda x: (-x[1], x[0])):
        fits = sorted((r, i) for i, r in enumerate(room) if r >= w)
        if w > target / 4 and fits:
            given[same] = fits[0][1]
            room[fits[0][1]] -= w
    units = []
    for unit, w in groups.items():
        if unit[0] not in given:
            _, size, s, g = lead[unit]
            tie = xxhash.xxh64(unit[1].to_bytes(8, "little"), seed=xxhash.xxh64(unit[0], seed=42).intdigest()).intdigest() % 2 ** 32
            c = (min(math.floor(math.log2(size + 1) / 40 * 65536), 65535), crc(s), crc(g))
            units.append((unit, w, [x * 2 ** 32 + tie for x in c]))
    out = {u: given[u[0]] for u in groups if u[0] in given}

    def split(part, room, first):
        if len(room) == 1:
            out.update({u: first for u, _, _ in part})
            return
        half = len(room) // 2
        spread = [len(part) * sum((k[d] >> 38) ** 2 for *_, k in part) - sum(k[d] >> 38 for *_, k in part) ** 2 for d in range(3)]
        d = spread.index(max(spread))
        goal, low, cut = sum(w for _, w, _ in part) * (sum(room[:half]) / sum(room)), 0, 0
        for _, w, k in sorted(part, key=lambda u: u[2][d]):
            if low + w >= goal:
                cut = k[d] + (goal - low > low + w - goal)
                break
            low += w
        split([u for u in part if u[2][d] < cut], room[:half], first)
        split([u for u in part if u[2][d] >= cut], room[half:], first + half)
    split(units, room, 0)
    return out


def test_shards_are_those_of_a_plain_kd_tree(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TOLERANCE", 0)
    rng = np.random.default_rng(4)
    rows = [(i, "x" * int(2 ** rng.uniform(0, 9)) + str(i), f"s{int(rng.integers(6))}", [None, "en", "de"][int(rng.integers(3))])
            for i in range(440)]
    rows += [(1000 + i, "copied text " * 8, "s1", "en") for i in range(60)]  # fits a shard
    rows += [(2000 + i, "another " * 7, "s9", None) for i in range(70)]      # fits one, too
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r.shard for r in sharding.shard_documents(df, shards=5).collect()}
    text = {d: t for d, t, *_ in rows}
    assert len({got[d] for d in got if 1000 <= d < 2000}) == 1 and len({got[d] for d in got if d >= 2000}) == 1
    want = _brute_kd(rows, 5)
    assert got == {d: want[hashlib.sha256(t.encode()).digest(), 0] for d, t in text.items()}
    load = Counter()
    for d, n in got.items():
        load[n] += len(text[d]) + 16
    assert max(load.values()) < 1.06 * min(load.values())


def test_large_groups_take_the_fullest_shard_they_fit():
    assert sharding.place_large([9, 6, 5, 4, 3, 3], 3, 10.0) == ([0, 1, 2, 1, 2, None], [1.0, 0.0, 2.0])
    assert sharding.place_large([25], 2, 10.0) == ([None], [10.0, 10.0])
