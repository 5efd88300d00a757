"""Score post-processing expressions: thresholds, relabel rule, summary
scores, output row helpers.  All are JVM-side column expressions."""


from pyspark.sql import Column
from pyspark.sql import functions as F

from labelweave import config as C


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_round(col, digits: int = 2) -> Column:
    """The nearest multiple of 10**-digits to the exact binary value,
    exact ties to even (0.285 -> 0.28, 0.125 -> 0.12), where Spark's
    ``round`` goes by the decimal text.

    The product with 10**digits is held as ``p + e`` without error (``x`` is
    split so that both partial products are exact); ``p`` decides unless it
    sits on a half, where the sign of ``e`` does."""
    x = _c(col).cast("double")
    a, scale = F.abs(x), F.lit(float(10 ** digits))
    p = a * scale
    big = a * F.lit(float((1 << 27) + 1))
    high = big - (big - a)
    e = (high * scale - p) + (a - high) * scale
    low = F.floor(p).cast("double")
    half = (p - low) - F.lit(0.5)
    up = (half > 0) | ((half == 0) & ((e > 0) | ((e == 0) & (low % 2 == 1))))
    r = (low + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / scale
    # from 2**53 on (and for infinities and NaN) there is nothing to round
    return F.when(~(p < float(1 << 53)), x).when(x < 0, -r).otherwise(r)


def safe_score(arr, i: int) -> Column:
    """Element i as a float rounded to 2; missing or unparsable -> 0.0."""
    el = F.get(_c(arr), F.lit(i))
    return F.coalesce(py_round(el.try_cast("double")), F.lit(0.0))


def _lit_array(values, typ: str) -> Column:
    return F.array(*[F.lit(v).cast(typ) for v in values])


def meet_flags(scores, thresholds=C.THRESHOLDS, labels=C.LABELS, relabel_active: bool = C.RELABEL_ACTIVE,
               relabel_from: str = "general", relabel_to: str = "earthscience",
               relabel_threshold: float = C.RELABEL_THRESHOLD) -> Column:
    """B13 + B15: boolean per label, score strictly above its threshold, then
    the optional relabel rule (drop ``relabel_from``, add ``relabel_to``)."""
    s = _c(scores)
    thr = _lit_array(thresholds, "double")
    meet = F.transform(s, lambda x, i: x > F.get(thr, i))
    if not relabel_active:
        return meet
    fi, ti = list(labels).index(relabel_from), list(labels).index(relabel_to)
    fires = F.coalesce(F.get(meet, F.lit(fi)), F.lit(False)) & (F.get(s, F.lit(ti)) > F.lit(relabel_threshold))
    return F.when(fires, F.transform(meet, lambda m, i: F.when(i == ti, True).when(i == fi, False).otherwise(m))
                  ).otherwise(meet)


def collections(scores, labels=C.LABELS, **kw) -> Column:
    """Labels whose score passes (after the relabel rule)."""
    meet = meet_flags(scores, labels=labels, **kw)
    lab = _lit_array(labels, "string")
    idx = F.filter(F.sequence(F.lit(0), F.size(meet) - 1), lambda i: F.get(meet, i))
    return F.transform(idx, lambda i: F.get(lab, i))


def collection_scores(scores, labels=C.LABELS, **kw) -> Column:
    """Scores of the passing labels, rounded to 2."""
    s = _c(scores)
    meet = meet_flags(s, labels=labels, **kw)
    idx = F.filter(F.sequence(F.lit(0), F.size(meet) - 1), lambda i: F.get(meet, i))
    return F.transform(idx, lambda i: py_round(F.get(s, i)))


SUMMARY_NAMES = [
    "astrophysics_score", "heliophysics_score", "planetary_science_score", "earth_science_score",
    "biology_score", "physics_score", "other_score", "garbage_score",
]


def summary(scores) -> dict[str, Column]:
    """The eight rounded scores, astronomy / general maxima and the gross
    collection (ties resolved astronomy > physics > general), by name."""
    r = [safe_score(_c(scores), i) for i in range(8)]
    astronomy, general, physics = F.greatest(r[0], r[1], r[2]), F.greatest(r[3], r[4], r[6]), r[5]
    gross = (F.when((astronomy >= physics) & (astronomy >= general), F.lit("astronomy"))
             .when(physics >= general, F.lit("physics")).otherwise(F.lit("general")))
    return dict(zip(SUMMARY_NAMES, r)) | {"astronomy_score": astronomy, "general_score": general,
                                          "gross_collection": gross}


def summary_columns(scores) -> list[Column]:
    return [c.alias(n) for n, c in summary(scores).items()]


def gross_collection(scores) -> Column:
    return summary_columns(scores)[-1]


def join_list(col, sep: str = ", ") -> Column:
    """Python ``', '.join(map(str, xs))`` for string or double arrays; NULL -> ''."""
    c = _c(col)
    return F.coalesce(F.array_join(F.transform(c, lambda x: x.cast("string")), sep), F.lit(""))


def scores_by_label(collections_col, scores, labels=C.LABELS) -> Column:
    """Raw score of every assigned collection, looked up by label."""
    m = F.map_from_arrays(_lit_array(labels, "string"), _c(scores))
    return F.transform(_c(collections_col), lambda c: F.element_at(m, c))


def min_collection_score(collections_col, scores, labels=C.LABELS) -> Column:
    """Minimum raw score over the assigned collections (NULL when none)."""
    return F.array_min(scores_by_label(collections_col, scores, labels))


def score_map(scores, labels=C.LABELS) -> Column:
    return F.map_from_arrays(_lit_array(labels, "string"), _c(scores))


def per_minute(count, seconds) -> Column:
    """(count / seconds) * 60, NULL when seconds is NULL or not > 0."""
    s = _c(seconds)
    return F.when(s.isNotNull() & (s > 0), _c(count).cast("double") / s * 60.0)


def pct_delta(new, base) -> Column:
    """(new - base) / base * 100, NULL when base is NULL or 0 or new NULL."""
    b = _c(base)
    n = _c(new)
    return F.when(n.isNotNull() & b.isNotNull() & (b != 0), (n - b) / b * 100.0)
