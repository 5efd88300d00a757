"""I3 and the SQL surface: the engine's expressions registered as Spark SQL
functions (``CREATE TEMPORARY FUNCTION ... RETURN <expr>``).  Catalyst
inlines their bodies, so SQL users get the same JVM-side plans as the
DataFrame API, with no Python in the query."""

from __future__ import annotations

from pyspark.sql import SparkSession

from labelweave import config as C
from labelweave.functions.ids import WHITESPACE_RUN

_LABELS = "array(" + ", ".join("'" + x + "'" for x in C.LABELS) + ")"
_LABELS_LOWER = "array(" + ", ".join("'" + x.lower() + "'" for x in C.LABELS) + ")"

FUNCTIONS = {
    "lw_identifier_kind": (
        "(x STRING) RETURNS STRING RETURN CASE WHEN x IS NULL OR length(x) <> " + str(C.ID_LENGTH)
        + " THEN NULL WHEN x RLIKE r'" + C.SCIX_PATTERN + "' THEN 'scix_id' ELSE 'bibcode' END"),
    "lw_normalize_ws": (
        "(x STRING) RETURNS STRING RETURN trim(regexp_replace(x, r'" + WHITESPACE_RUN + "', ' '))"),
    "lw_token_ids": (
        "(text STRING) RETURNS ARRAY<BIGINT> RETURN transform(filter(split(translate(text, '"
        + C.UPPER_ASCII + "', '" + C.LOWER_ASCII + "'), r'" + C.TOKEN_SEPARATORS
        + "'), t -> t <> ''), t -> CAST(conv(substr(md5(t), 1, 8), 16, 10) AS BIGINT))"),
    "lw_window_split": (
        "(ids ARRAY<BIGINT>, w INT, s INT) RETURNS ARRAY<ARRAY<BIGINT>> RETURN "
        "transform(sequence(0, greatest(1, size(ids) div s) - 1), i -> slice(ids, i * s + 1, w))"),
    "lw_windows": (
        "(ids ARRAY<BIGINT>, w INT, s INT) RETURNS TABLE(chunk INT, window ARRAY<BIGINT>) RETURN "
        "SELECT pos, col FROM (SELECT posexplode(transform(sequence(0, greatest(1, size(ids) div s) - 1), "
        "i -> slice(ids, i * s + 1, w))))"),
    "lw_is_allowed_category": (
        "(cats ARRAY<STRING>) RETURNS BOOLEAN RETURN forall(cats, x -> array_contains(" + _LABELS_LOWER
        + ", lower(x)))"),
    "lw_gross_collection": (
        "(s ARRAY<DOUBLE>) RETURNS STRING RETURN CASE "
        "WHEN round(greatest(round(s[0],2), round(s[1],2), round(s[2],2)),2) >= round(s[5],2) AND "
        "round(greatest(round(s[0],2), round(s[1],2), round(s[2],2)),2) >= "
        "round(greatest(round(s[3],2), round(s[4],2), round(s[6],2)),2) THEN 'astronomy' "
        "WHEN round(s[5],2) >= round(greatest(round(s[3],2), round(s[4],2), round(s[6],2)),2) THEN 'physics' "
        "ELSE 'general' END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(FUNCTIONS)
