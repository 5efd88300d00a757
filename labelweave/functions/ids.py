"""Identifier expressions (kind, split, record key, replay fingerprint)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from labelweave import config as C

# Python's ``\s`` class plus vertical tab, spelled out so the JVM regex and
# RE2 agree on it.
WHITESPACE_RUN = r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def identifier_kind(col) -> Column:
    """B1: NULL unless 19 chars; 'scix_id' when it matches the scix_id pattern, else 'bibcode'."""
    c = _c(col).cast("string")
    return (F.when(c.isNull() | (F.length(c) != C.ID_LENGTH), F.lit(None).cast("string"))
            .when(c.rlike(C.SCIX_PATTERN), F.lit("scix_id"))
            .otherwise(F.lit("bibcode")))


def split_identifier(df: DataFrame, col: str = "identifier") -> DataFrame:
    """B2: put an identifier into exactly one of bibcode / scix_id."""
    kind = identifier_kind(col)
    return (df.withColumn("bibcode", F.when(kind == "bibcode", F.col(col)))
              .withColumn("scix_id", F.when(kind == "scix_id", F.col(col))))


def nonblank(col) -> Column:
    c = _c(col)
    return F.when(c.isNotNull() & (c != ""), c)


def record_key_kind(bibcode="bibcode", scix_id="scix_id") -> Column:
    """Which id keys a record: scix_id when non-empty, else bibcode."""
    return F.when(nonblank(scix_id).isNotNull(), F.lit("scix_id")).otherwise(F.lit("bibcode"))


def record_key_value(bibcode="bibcode", scix_id="scix_id") -> Column:
    return F.coalesce(nonblank(scix_id), _c(bibcode))


def has_identifier(bibcode="bibcode", scix_id="scix_id") -> Column:
    """Any of the two ids is non-empty."""
    return nonblank(bibcode).isNotNull() | nonblank(scix_id).isNotNull()


def normalize_ws(col) -> Column:
    """Collapse every whitespace run to one space and strip (Python ``\\s``)."""
    return F.trim(F.regexp_replace(_c(col).cast("string"), WHITESPACE_RUN, " "))


def _run_text(df: DataFrame, run_col: str) -> Column:
    c = F.col(run_col)
    if isinstance(df.schema[run_col].dataType, NumericType):
        # a zero run id is falsy in the reference's ``value or ''``
        return F.when(c.isNull() | (c == 0), F.lit("")).otherwise(c.cast("string"))
    return F.coalesce(c, F.lit(""))


def fingerprint(df: DataFrame, run_col: str = "run_id") -> Column:
    """sha256 of run | kind | value (scix_id > bibcode > title, abstract)."""
    def n(c):
        return F.coalesce(normalize_ws(F.col(c)), F.lit(""))
    run = normalize_ws(_run_text(df, run_col))
    canon = (F.when(nonblank("scix_id").isNotNull(), F.concat_ws("|", run, F.lit("scix_id"), n("scix_id")))
             .when(nonblank("bibcode").isNotNull(), F.concat_ws("|", run, F.lit("bibcode"), n("bibcode")))
             .otherwise(F.concat_ws("|", run, F.lit("text"), n("title"), n("abstract"))))
    return F.sha2(canon, 256)
