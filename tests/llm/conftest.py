import random

import pytest
from pyspark.sql import types as T

SYL = {"en": ["the", "and", "ing", "tion", "er", "th", "on"], "es": ["que", "ción", "mente", "ado", "ll", "ñ", "os"],
       "de": ["ung", "keit", "sch", "ö", "lich", "ver", "pf"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYL[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


#: Names that operators also use, as extra columns of the input.
CLASHES = ["kept", "name", "level", "fp", "component_id", "shard", "slot", "size", "copies", "copy", "rate", "row_index",
           "row_file", "doc", "score", "spans", "ids", "start", "key", "part", "block", "lang_pred", "_rows", "_task"]


def edge_rows():
    """Null and repeated ids, null, empty, blank, very long, equal and nearly
    equal texts, null metadata, repeated rows."""
    rng = random.Random(5)
    out = []
    for i in range(60):
        lang = ["en", "es", "de"][i % 3]
        out.append((i, prose(rng, lang, rng.randint(1, 60)), lang, f"s{i % 4}"))
    near = prose(rng, "en", 400)
    out += [(100 + k, near, "en", "s0") for k in range(12)]
    out += [(120 + k, near + " " + w, "en", "s1") for k, w in enumerate(["alpha", "beta", "gamma"])]
    out += [(200, None, "en", "s0"), (201, "", None, None), (202, " \t\n", "de", "s1"), (203, "12 34 -- 5", "en", "s2"),
            (204, "日本語のテキスト", "en", "s3"), (205, prose(rng, "es", 30_000), "es", "s0"), (206, "x" * 50_000, None, "s1"),
            (None, "the thing and the thing", "en", None), (None, None, None, None),
            (300, "the thonder and the thing", "en", "s2"), (300, "the thonder and the thing", "en", "s2"),
            (300, "queción mente adoll", "es", "s2"), (301, "the thonder and the thing", "en", "s2")]
    return out


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


def with_clashes(df):
    return df.selectExpr("*", *[f"'x' as `{c}`" for c in CLASHES if c not in df.columns])


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """The edge rows as a Parquet table with clashing extra columns."""
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    with_clashes(spark.createDataFrame(edge_rows(), SCHEMA)).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
