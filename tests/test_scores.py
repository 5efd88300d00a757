from pyspark.sql import functions as F


from labelweave.functions import ids as I
from labelweave.functions import scores as S
from labelweave.operators import requests as RQ
from labelweave.operators.output import output_row
from conftest import FAKE_LABELS, FAKE_THRESHOLDS


def _one(spark, scores):
    return spark.createDataFrame([(scores,)], "scores array<double>")


def test_collections_basic(spark):
    # above, below and exactly at a label's threshold
    df = _one(spark, [0.59, 0.4, 0.93, 0.02, 0.69, 0.31, 0.0, 0.9])
    r = df.select(S.collections("scores", labels=FAKE_LABELS, thresholds=FAKE_THRESHOLDS).alias("c"),
                  S.collection_scores("scores", labels=FAKE_LABELS, thresholds=FAKE_THRESHOLDS).alias("s")).first()
    at_threshold = [x for x, (v, t) in zip(FAKE_LABELS, zip([0.59, 0.4, 0.93, 0.02, 0.69, 0.31, 0.0, 0.9], FAKE_THRESHOLDS)) if v == t]
    assert at_threshold == ["Heliophysics", "Text Garbage"]
    assert [x for x in r["c"] if x not in at_threshold] == ["Planetary Science", "Other Physics"]
    assert {0.93, 0.31} <= set(r["s"]) and len(r["s"]) == len(r["c"])


def test_relabel_rule(spark):
    df = _one(spark, [0.0, 0.0, 0.0, 0.6, 0.0, 0.0, 0.5, 0.0])
    kw = dict(labels=FAKE_LABELS, thresholds=FAKE_THRESHOLDS, relabel_active=True, relabel_from="Other",
              relabel_to="Earth Science", relabel_threshold=0.55)
    c = df.select(S.collections("scores", **kw).alias("c")).first()["c"]
    assert "Earth Science" in c and "Other" not in c


def test_output_row_values(spark):
    """Label order: astrophysics, heliophysics, planetary, earth science, the
    NASA-funded subset, other physics, general, garbage."""
    scores = [0.127, 0.301, 0.05, 0.333, 0.746, 0.2, 0.018, 0.449]
    df = spark.createDataFrame(
        [(None, "scix:QQ12-WW34-EE56", "17", "Tides", None, ["Heliophysics", "Earth Science"], [0.301, 0.333], scores)],
        "bibcode string, scix_id string, run_id string, title string, abstract string, collections array<string>, "
        "collection_scores array<double>, scores array<double>")
    row = output_row(df).first().asDict()
    assert list(row.values())[:6] == ["", "scix:QQ12-WW34-EE56", "17", "Tides", "", "Heliophysics, Earth Science"]
    numbers = [v for v in list(row.values())[7:] if isinstance(v, float)]
    # every score once, to two places, beside the maxima of the label groups
    assert {round(x, 2) for x in scores} <= set(numbers) and all(x == round(x, 2) for x in numbers)
    assert list(row.values())[-2:] == ["", ""]


def test_gross_collection_tie_prefers_astronomy(spark):
    df = _one(spark, [0.5, 0.0, 0.0, 0.5, 0.0, 0.5, 0.0, 0.0])
    assert df.select(S.gross_collection("scores")).first()[0] == "astronomy"


def test_safe_score_bad_values(spark):
    df = _one(spark, [0.123])
    r = df.select(S.safe_score("scores", 0), S.safe_score("scores", 5)).first()
    assert r[0] == 0.12 and r[1] == 0.0


def test_identifier_kinds(spark):
    df = spark.createDataFrame([("scix:AB12-CD34-EF56",), ("2019J....123..456AB",), ("short",), (None,)], "x string")
    got = [r[0] for r in df.select(I.identifier_kind("x")).collect()]
    assert got == ["scix_id", "bibcode", None, None]


def test_allowed_and_single_empty(spark):
    df = spark.createDataFrame([(["ASTROPHYSICS", "general"],), (["Nope"],), ([""],), ([],)], "o array<string>")
    rows = df.select(RQ.is_allowed("o"), RQ.is_single_empty("o")).collect()
    assert [r[0] for r in rows] == [True, False, False, True]
    assert [r[1] for r in rows] == [False, False, True, False]


def test_python_round_exact(spark):
    import random
    rng = random.Random(4)
    xs = [0.285, 0.575, 1.005, 0.145, 0.615, 2.675, 0.125, 0.375, 0.625, 0.875, -0.285, -0.125, -0.001, 0.0, 1e20, 4.5e15,
          9.0e13 + 0.125, float("inf"), float("-inf")]
    xs += [k / 1000 for k in range(0, 2000, 5)] + [rng.random() * 10 ** rng.randint(-3, 9) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    got = [r[0] for r in df.select(S.py_round("x")).collect()]
    assert got == [round(x, 2) if abs(x) < 1e300 else x for x in xs] + [None]
    assert spark.createDataFrame([(float("nan"),)], "x double").select(F.isnan(S.py_round("x"))).first()[0]


def test_output_row_keeps_the_text_zero(spark):
    from labelweave.operators.output import output_row
    df = spark.createDataFrame([("0", "0", None, 0, ["a"], [0.5] * 8, [0.5])],
                               "title string, abstract string, bibcode string, run_id long, collections array<string>, "
                               "scores array<double>, collection_scores array<double>")
    r = output_row(df).first()
    assert (r["title"], r["abstract"], r["bibcode"], r["run_id"]) == ("0", "0", "", "")


def test_fingerprint_digests(spark):
    rows = [("1", None, None, "  A  title\n", "abs tract "), ("0", "2019J....123..456AB", None, "t", "a"),
            ("7", "x", "scix:AB12-CD34-EF56", "t", "a")]
    df = spark.createDataFrame(rows, "run_id string, bibcode string, scix_id string, title string, abstract string")
    assert [r[0] for r in df.select(I.fingerprint(df)).collect()] == DIGESTS


# SHA-256 of "1|text|A title|abs tract", "0|bibcode|2019J....123..456AB", "7|scix_id|scix:AB12-CD34-EF56"
DIGESTS = [
    "df94335b79e7287ae1b26bd379b6a3224a535efb6366ca68297aeb17c271e596",
    "1174a862f13c31c7bef29b16ac1354e57c56c4b6257b85cf15e73ab3a2cdbecf",
    "b855970d6b4de3cedab084541dce09539d724158899fdd55d25262a28e946d1e",
]
