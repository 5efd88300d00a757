"""Personal data in texts: regular expressions propose spans, checksum
validators (Luhn, mod 97) and range checks confirm them, context words
beside a span adjust its score.  Column expressions only; one pass over the
documents, no shuffle.

Base kinds (always kept once confirmed): ``email``, ``ip``, ``card``,
``phone``.  Added kinds (kept when their score reaches ``MIN_SCORE``):
``iban`` (mod 97), ``ssn`` (needs a context word).  Spans of one kind never
overlap; spans of different kinds may.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.7
CONTEXT_CHARS = 48
IBAN_HEAD = 4

#: Patterns are the plain ones, anchored so that a long run of word characters
#: or digits is tried once (at its start, or where the last match ended) and
#: consumed without backtracking: linear time on any text.  ``iban`` consumes
#: only its first four characters and looks at the longest run behind them
#: (at most 44 characters, group 1), so every place an IBAN can start is tried.
_WORD = r"[A-Za-z0-9._%+-]"
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE_KINDS = KINDS[:4]
PATTERNS = {
    "email": rf"(?:(?<!{_WORD})|\G){_WORD}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])))[A-Z]{2}[0-9]{2}",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
#: Context words, whole ones (a plural s may follow).
CONTEXT = {kind: rf"\b(?:{words})s?\b" for kind, words in {
    "email": "mail|e-?mail|mailto|contact|write to|correo|courriel",
    "ip": "ip|host|server|address|addresse|login",
    "card": "card|visa|master|mastercard|credit|payment|karte|kreditkarte|carte|tarjeta",
    "phone": "phone|telephone|telefon|call|tel|mobile|fax|handy|anruf",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security",
}.items()}
#: Score of a confirmed span, and what a context word beside it adds.
SCORES = {"email": (0.9, 0.1), "ip": (0.6, 0.3), "card": (0.8, 0.2), "phone": (0.6, 0.3), "iban": (0.8, 0.2),
          "ssn": (0.4, 0.5)}


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def mod97(c: Column) -> Column:
    """Remainder of the number an IBAN spells (first four characters moved
    last, letters as 10 to 35); 1 for a valid one."""
    bare = F.replace(c, F.lit(" "), F.lit(""))
    moved = F.split(F.concat(F.substring(bare, 5, 100), F.substring(bare, 1, 4)), "")
    def step(acc, ch):
        n = F.when(ch.rlike("[0-9]"), F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55)
        return F.when(ch == "", acc).when(n < 10, (acc * 10 + n) % 97).otherwise((acc * 100 + n) % 97)
    return F.aggregate(moved, F.lit(0), step)


def iban_in(run: Column) -> Column:
    """Longest valid IBAN that ``run`` starts with and that ends before a
    space or with the run (words behind an IBAN can look like groups of it);
    null if there is none."""
    parts = F.split(run, " ")
    ends = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), " "))
    return F.get(F.filter(ends, lambda c: (F.length(F.replace(c, F.lit(" "), F.lit(""))) >= 12) & (mod97(c) == 1)), 0)


def confirmed(kind: str, c: Column) -> Column:
    d = digits(c)
    if kind == "ip":
        return F.forall(F.split(c, r"\."), lambda p: F.coalesce(
            F.regexp_replace(p, "^0+", "").rlike(r"^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"), F.lit(False)))
    if kind == "card":
        return F.length(d).between(14, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(d).between(10, 15)
    return F.lit(True)


def _spans(kind: str, matches: Column, pieces: Column, ibans: Column | None = None) -> Column:
    """Confirmed spans of one kind.  ``pieces`` is what lies between the
    matches, so the running length of both gives every offset (code points).
    For ``iban`` a match is the run behind a start, of which only IBAN_HEAD
    characters lie between the pieces, and ``ibans`` its IBAN or null; one that
    starts inside the IBAN before it doesn't count."""
    base, bonus = SCORES[kind]
    rank = KINDS.index(kind)
    after = F.slice(pieces, F.lit(2), F.size(matches))
    walk = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(matches)).alias("before"), matches.alias("value"),
                        after.alias("after"), *([ibans.alias("iban")] if kind == "iban" else []))
    empty = F.struct(F.lit(0).alias("at"), F.expr(
        "cast(array() as array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>)").alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["before"])
        value, behind = x["value"], x["after"]
        if kind == "iban":
            value = x["iban"]
            behind = F.concat(F.substr(x["value"], F.length(value) + 1),
                              F.substr(x["after"], F.length(x["value"]) - IBAN_HEAD + 1))
        end = start + F.length(value)
        near = F.concat(F.substring(x["before"], -CONTEXT_CHARS, CONTEXT_CHARS), F.lit(" "),
                        F.substring(behind, 1, CONTEXT_CHARS))
        score = F.lit(float(base)) + F.when(F.lower(near).rlike(CONTEXT[kind]), F.lit(float(bonus))).otherwise(F.lit(0.0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
                        value.alias("value"), score.alias("score"))
        if kind == "iban":
            good = value.isNotNull() & (start >= F.coalesce(F.try_element_at(acc["out"], F.lit(-1))["end"], F.lit(0)))
        else:
            good = confirmed(kind, value)
        if kind not in BASE_KINDS:
            good = good & (score >= MIN_SCORE)
        at = start + IBAN_HEAD if kind == "iban" else end
        return F.struct(at.alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(walk, empty, step, lambda acc: acc["out"])


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` rows as ``doc`` (struct of the input columns) plus ``spans``:
    array of (start, rank, end, kind, value, score), offsets in code points,
    end exclusive, ordered by start and kind.  Null and empty texts have an
    empty array; repeated rows are treated each on its own, a text of any
    length in time that grows with it, and an empty table gives an empty
    result.  Input columns may have any names."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"),
                      F.coalesce(docs["text"], F.lit("")).alias("text"))
    out = out.select("doc", "text", *[F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(int(k == "iban"))).alias(f"m_{k}")
                                      for k in KINDS])
    out = out.select("doc", F.transform("m_iban", iban_in).alias("ibans"), *[f"m_{k}" for k in KINDS],
                     *[F.when(F.size(f"m_{k}") > 0, F.split(text, PATTERNS[k], -1)).alias(f"p_{k}") for k in KINDS])
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>)")
    spans = [F.when(F.size(f"m_{k}") > 0, _spans(k, F.col(f"m_{k}"), F.col(f"p_{k}"), F.col("ibans"))).otherwise(none) for k in KINDS]
    return out.select("doc", F.array_sort(F.concat(*spans)).alias("spans"))


def pii_digest(found: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, SHA-256 of the base spans, all
    spans as ``kind:start:end`` joined by commas, and the mean score."""
    label = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.concat_ws(",", F.transform(base, label)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", label)).alias("spans"),
        F.concat_ws(",", F.transform("spans", lambda s: F.format_number(s["score"], 2))).alias("scores"))


def redact(found: DataFrame) -> DataFrame:
    """Input columns with every span's text replaced by ``[KIND]``, longest
    first (a value that repeats is replaced everywhere)."""
    values = F.array_sort(F.col("spans"), lambda a, b: F.length(b["value"]) - F.length(a["value"]))
    text = F.aggregate(values, F.col("doc.text"), lambda t, s: F.replace(
        t, s["value"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
    return found.select("doc.*", text.alias("redacted"))
