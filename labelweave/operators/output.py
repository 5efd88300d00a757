"""Output rows, score payload JSON and model metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from labelweave import config as C
from labelweave.functions import scores as S


def output_row(df: DataFrame, carry: tuple = ()) -> DataFrame:
    """The 20 TSV columns (lists joined by ', '; NULL and the number 0
    -> '', the text "0" stays); ``carry`` columns of ``df`` follow as they are."""
    def blank(c):
        if c not in df.columns:
            return F.lit("")
        shown = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.when(F.col(c) == 0, F.lit("")).otherwise(shown) if isinstance(
            df.schema[c].dataType, NumericType) else shown
    by_name = S.summary("scores")
    return df.select(
        *[blank(c).alias(c) for c in ("bibcode", "scix_id", "run_id", "title", "abstract")],
        S.join_list("collections").alias("collections"), S.join_list("collection_scores").alias("collection_scores"),
        *[by_name[n].alias(n) for n in C.OUTPUT_HEADER[7:18]],
        blank("gross_collection_override").alias("gross_collection_override"), F.lit("").alias("override"), *carry)


def score_payload(scores="scores", collections_col="collections", labels=C.LABELS,
                  adjustment: bool = C.RELABEL_ACTIVE):
    """Canonical JSON (sorted keys) of label->score, the adjustment
    flag and the collections."""
    order = sorted(range(len(labels)), key=lambda i: labels[i])
    m = F.map_from_arrays(F.array(*[F.lit(labels[i]) for i in order]),
                          F.array(*[F.get(F.col(scores), i) for i in order]))
    return F.to_json(F.struct(F.col(collections_col).alias("collections"),
                              F.lit(adjustment).alias("earth_science_adjustment"), m.alias("scores")))


def model_metadata(model_name: str = "hashed-linear", revision: str = "v1", tokenizer: str = "ascii-words-md5",
                   cfg: C.ClassifierConfig = C.DEFAULT):
    """Canonical JSON (sorted keys) of the model's name, revision and
    tokenizer, and of the post-processing settings; together they key D4."""
    model = F.to_json(F.struct(F.lit(model_name).alias("model"), F.lit(revision).alias("revision"),
                               F.lit(tokenizer).alias("tokenizer")))
    post = F.to_json(F.struct(F.lit(cfg.relabel_active).alias("earth_science_adjustment"),
                              F.lit(cfg.relabel_threshold).alias("earth_science_threshold"),
                              F.lit([float(x) for x in cfg.thresholds]).alias("thresholds")))
    return model, post
