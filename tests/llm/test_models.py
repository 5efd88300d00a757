import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelweave.llm import langid, quality

from .conftest import SYL, edge_rows, prose


@pytest.fixture(scope="module")
def model(edge):
    return langid.fit(edge.filter(~langid.held_out(F.col("doc_id"))))


def brute_viterbi(s, penalty):
    """Best total over all label sequences, by trying every one."""
    from itertools import product
    return max(sum(s[t][x] for t, x in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:]))
               for p in product(range(len(s[0])), repeat=len(s)))


def test_viterbi_finds_the_best_path_and_the_shortcut_agrees(model):
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 7):
        for _ in range(20):
            s = -rng.random((n, 3)) * rng.choice([1, 10])
            path = langid.viterbi(s, 2.0)
            total = sum(s[t][x] for t, x in enumerate(path)) - 2.0 * (np.diff(path) != 0).sum()
            assert total == pytest.approx(brute_viterbi(s, 2.0))
    for _ in range(200):
        s = (-rng.random((60, 3)) * 3).astype(np.float32)
        if rng.random() < 0.5:
            s[20:40, 1] = 0
            s[20:40, 0] = -2
        path, full = model.label(s), langid.viterbi(s, langid.SWITCH_PENALTY)
        value = lambda p: s[np.arange(60), p].sum(dtype=float) - langid.SWITCH_PENALTY * (np.diff(p) != 0).sum()
        assert value(path) == pytest.approx(value(full), abs=1e-4)


def test_mixed_text_gets_spans(model):
    rng = random.Random(9)
    a, b = prose(rng, "en", 40), prose(rng, "es", 60)
    lang, score, spans = model.predict(a + " " + b)
    assert lang == "es" and 0.4 < score < 0.9
    assert spans[0][0] == 0 and spans[-1][1] == len(a) + 1 + len(b)
    assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    cut = next(s for s, _, g in spans if g == "es")
    assert abs(cut - len(a)) < 30


def test_no_letter_and_unknown_scripts(model):
    for t in (None, "", " \t", "12 -- 3", "²³ ½"):
        assert model.predict(t) == ("und", 0.0, [])
    lang, score, _ = model.predict("日本語")
    assert lang in SYL and score == 0.0
    assert langid.Model([], ([], []), {}, {}, {}).predict("abc")[0] == "und"


def test_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    m = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    got = langid.predict(docs, m).filter(langid.held_out(F.col("doc.doc_id")))
    n, right = got.agg(F.count("*"), F.sum((F.col("lang_pred") == F.col("doc.lang")).cast("int"))).first()
    assert n > 30 and right >= 0.97 * n


def test_edge_rows(edge, empty, model):
    got = langid.predict(edge, model).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.doc.text or ""))
    out = langid.drop_undetermined(edge)
    assert out.columns == edge.columns
    gone = {r.doc_id for r in edge.select("doc_id").collect()} - {r.doc_id for r in out.collect()}
    assert gone == {200, 201, 202, 203, 204}
    assert langid.drop_undetermined(empty).collect() == []


def test_rare_language_in_its_own_script_is_kept(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, "en", 30), "en") for i in range(900)]
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(n))
    rows += [(1000 + i, "、".join(han(12) for _ in range(5)) + "。", "zh") for i in range(40)]
    rows += [(2000, "ภาษาไทยเขียนติดกัน", "th")]
    rows += [(3000, "Ελληνικά", "en"), (3001, "Україна", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = docs.filter(~langid.held_out(F.col("doc_id")) | (F.col("doc_id") == 2000))
    m = langid.fit(seen, fit_rows=30, max_words=20, max_grams=20)
    got = {r.doc.doc_id: r for r in langid.predict(docs, m).collect()}
    for i, _, lang in rows[900:-2]:
        assert got[i].lang_pred == lang and got[i].score > 0
    assert got[3000].score == 0 and got[3001].score == 0
    assert sum(c[m.langs.index("en")] > 0 for c in m.words.values()) >= 15
    kept = {r.doc_id for r in langid.drop_undetermined(docs).collect()}
    assert set(range(1000, 1040)) <= kept and not kept & {3000, 3001}


def test_script_words_are_the_words_of_predict():
    for t in ("", "a b2c d_e", "日本語のテキスト、かな 한글", "ภาษาไทย हिन्दी", "ẞ K ②x 𝒳y", "é😀ñ"):
        want = [langid.script(w.lower()) for w in langid._WORD.findall(t.lower())]
        got = dict(zip(langid.SCRIPT_NAMES, langid.script_words(t).tolist()))
        assert {k: n for k, n in got.items() if n} == {k: want.count(k) for k in want}


def test_sample_is_shared_between_languages():
    assert langid._quota([5, 100, 1000], 205) == 100 and langid._quota([5, 5], 20) == float("inf")
    assert langid._quota([10, 10, 10], 15) == 5


def test_quality_learns_shouting_tables_and_repetition(spark, edge, empty):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        t, q = prose(rng, "en", rng.randint(5, 80)), i % 4
        if q == 0:
            t = [t.upper().replace(" ", "!! "), t.replace(" ", " | "), " ".join([t.split()[0]] * 50)][i // 4 % 3]
        rows.append((i, t))
        labels.append((i, int(q != 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (6, 9), (9999, 1)], "doc_id long, quality int")
    m = quality.fit(docs, lab.filter(~quality.held_out(F.col("doc_id"))))
    got = {r.doc.doc_id: (r.score, r.held) for r in
           quality.score(docs, m).withColumn("held", quality.held_out(F.col("doc.doc_id"))).collect()}
    held = [i for i, (_, h) in got.items() if h]
    assert np.mean([(got[i][0] >= 0.7) == bool(labels[i][1]) for i in held]) > 0.95
    scores = quality.score(edge, m).collect()
    assert len(scores) == len(edge_rows()) and all(0 <= r.score <= 1 for r in scores)
    assert quality.score(empty, m).collect() == []
    untrained = quality.fit(docs, lab.limit(0))
    assert untrained.score("any") == 0.5 and untrained.score(None) == 0.5


def test_quality_score_is_the_average_of_feature_vectors():
    rng = np.random.default_rng(1)
    vectors, out, bias = rng.normal(size=(quality.BUCKETS + 1, 4)), rng.normal(size=(2, 4)), np.array([0.1, 0.3])
    m = quality.Model(vectors, out, bias)
    for t in ("one", "the the the cat", "x" * 500 + " y y"):
        at, share = quality.bag(t)
        z = out @ (share @ vectors[at]) + bias
        assert m.score(t) == pytest.approx(np.exp(z[1]) / np.exp(z).sum())


def test_quality_fit_is_bounded_where_an_id_repeats(spark, monkeypatch):
    rows = [(7, f"text {i}") for i in range(400)] + [(i + 100, f"own text {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (7, 1), (7, 0)] + [(i + 100, i % 2) for i in range(60)], "doc_id long, quality int")
    got = []
    monkeypatch.setattr(quality, "train", lambda bags, given: got.append((len(bags), len(given))))
    quality.fit(docs, labels)
    quality.fit(docs, labels, fit_rows=20)
    assert got == [(62, 62), (20, 20)]
