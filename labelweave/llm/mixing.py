"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is what its target weight asks of it; each
document's repetition count inverts a Poisson distribution with that mean at
a point seeded by a hash of the document, so a rerun, a retried task or
another layout gives the same mixture.  Copies are exploded and shuffled
globally by a hash key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelweave.llm.common import ROW, drop_stage, join_groups, utf8_size, with_row_identity, write_stage
from labelweave.operators.requests import dense_index

SEED = 42
#: A mean above this is drawn as the sum of equal independent parts, so that
#: exp(-mean) never vanishes.
PART_MEAN = 16.0


def uniform(*parts) -> Column:
    """A point in (0, 1) from 52 bits of the MD5 of the parts."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")
    return (h.cast("double") + 0.5) / float(1 << 52)


def poisson(mean: Column, u: Column) -> Column:
    """Smallest n whose cumulative probability reaches ``u``.  Enough terms
    are summed that what lies beyond is below the resolution of ``u``."""
    p0 = F.exp(-mean)
    terms = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int"))

    def add(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"),
                        (acc["n"] + (u > acc["c"]).cast("int")).alias("n"))
    return F.aggregate(terms, F.struct(p0.alias("p"), p0.alias("c"), F.lit(0).alias("n")), add, lambda a: a["n"])


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """``source, weight, size, rate``, one written row per source (a null
    source is one of its own).  Size counts the UTF-8 bytes and an end mark of
    each document; ``epochs`` is the mixture's expected size against the
    input's.  Sources without a weight get 1."""
    given = F.lit(1.0)
    for name, w in (weights or {}).items():
        given = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(given)
    sizes, _ = write_stage(docs.groupBy("source").agg(F.sum(utf8_size("text") + 1).alias("size"))
                           .withColumn("weight", given), "sizes")
    total, share = sizes.agg(F.sum("size"), F.sum("weight")).first()
    if not total or not share:
        return sizes.withColumn("rate", F.lit(0.0))
    rate = F.lit(float(epochs)) * F.lit(float(total)) * (F.col("weight") / F.lit(float(share))) / F.col("size")
    return sizes.withColumn("rate", rate)


def repeated_rows(rows: DataFrame) -> DataFrame | None:
    """Of ``rows`` (``with_row_identity``): ``row_file, row_index, nth``: among rows that agree in doc_id, source
    and text, the number (from 0) of each row; None where no rows do.  Numbers
    come from a range sort, so rows that all agree still spread."""
    same = ["id", "source", "text"]
    spark = rows.sparkSession
    rows, path = write_stage(rows.select(*ROW, F.col("doc.doc_id").alias("id"), F.col("doc.source").alias("source"),
                                         F.md5("doc.text").alias("text")), "keys")
    groups, groups_path = write_stage(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated")
    out = None
    if not groups.isEmpty():
        found = dense_index(join_groups(rows, groups, same).select(*ROW, *same, "n"), [*same, *ROW], "at")
        found, _ = write_stage(found, "ranked")
        first, _ = write_stage(found.groupBy(*same).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "first")
        out, _ = write_stage(join_groups(found.drop("n"), first, same).select(
            *ROW, (F.col("at") - F.col("first")).alias("nth")), "nth")
    drop_stage(spark, path, groups_path)
    return out


def mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """``doc`` (struct of the input columns), ``rate``, ``copies``, ``copy``
    (from 1) and ``shuffle_key`` for every copy, globally shuffled: a copy's
    partition and its place there follow the hash key.

    Every row draws for itself, from its doc_id, its text and, among rows that
    agree in doc_id, source and text, its number there; so rows that share an
    id, or have none, are repeated or left out one by one, and spread over the
    partitions.  Null and empty texts take part (an end mark each); a text of
    any length counts whole.  A source of weight 0 is left out; an empty table
    stays empty."""
    rates = repetition_rates(docs, weights, epochs).select(F.col("source").alias("of"), "rate")
    placed = with_row_identity(docs)
    again = repeated_rows(placed)
    if again is None:
        rows = placed.select("doc", F.lit(0).cast("long").alias("nth"))
    else:
        rows = placed.join(again, ROW, "left").select("doc", F.coalesce("nth", F.lit(0)).alias("nth"))
    key = F.concat_ws("|", *[F.coalesce(c, F.lit("null")) for c in (F.col("doc.doc_id").cast("string"), F.md5("doc.text"))],
                      F.col("nth").cast("string"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN).cast("int"))

    def draw(k):
        # the text is hashed once a row, and a point once a part
        return F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda n, j: n + F.get(F.transform(
            F.array(uniform(F.lit(str(seed)), k, j.cast("string"))), lambda u: poisson(F.col("rate") / F.col("parts"), u)), 0))
    drawn = F.get(F.transform(F.array(key), lambda k: F.struct(k.alias("key"), draw(k).alias("copies"))), 0)
    out = (rows.join(rates, F.col("doc.source").eqNullSafe(F.col("of")))
           .select("doc", "nth", "rate", parts.alias("parts"))
           .select("doc", "rate", F.inline(F.array(drawn)))
           .filter("copies > 0 and rate > 0")
           .select("doc", "rate", "copies", "key", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")))
    out = out.select("doc", "rate", "copies", "copy", F.md5(F.concat_ws(
        "|", F.lit(f"order {seed}"), "key", F.col("copy").cast("string"))).alias("shuffle_key"))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
