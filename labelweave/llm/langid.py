"""Language identification with spans.

A word's script narrows the languages it can be in; each candidate scores the
word (word frequency if the word is known, character trigrams otherwise); a
Viterbi pass with a penalty for every switch labels the words, so a passage in
another language becomes a span of its own while single odd words do not.  The
document's language is the one that labels most letters.

Learned: the scripts of each language from all labelled rows; word and trigram
counts per language over a bounded, hash-chosen sample with rows of every
language, counted on the executors; each language's most frequent words and
trigrams are the model (about ``max_words`` and ``max_grams`` per language).
"""

from __future__ import annotations

import functools
import math
import re
import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelweave.llm.common import drop_stage, write_stage

UNDETERMINED = "und"
FIT_ROWS, MAX_WORDS, MAX_GRAMS = 20_000, 50_000, 50_000
SWITCH_PENALTY, WORD_CAP = 20.0, 8.0
MEMO_ENTRIES = 300_000
_WORD = re.compile(r"[^\W\d_]+")
#: First and last code points of scripts (fixed values, Unicode blocks).
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]


def script(word: str) -> str:
    c = ord(word[0])
    for name, lo, hi in SCRIPTS:
        if lo <= c <= hi:
            return name
    return "other"


SCRIPT_NAMES = [*dict.fromkeys(x[0] for x in SCRIPTS), "other"]


@functools.cache
def _script_table() -> np.ndarray:
    """Per code point 0 if words don't hold it, else 1 + place of its script
    in SCRIPT_NAMES."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for m in _WORD.finditer(" ".join(map(chr, range(sys.maxunicode + 1)))):
        out[ord(m.group())] = 1 + SCRIPT_NAMES.index(script(m.group()))
    return out


def script_words(text: str) -> np.ndarray:
    """Number of words of each script of SCRIPT_NAMES, as ``predict`` splits
    and names them."""
    of = _script_table()[np.frombuffer(f" {text.lower()}".encode("utf-32-le", "surrogatepass"), np.uint32)]
    return np.bincount(of[1:][(of[1:] > 0) & (of[:-1] == 0)], minlength=len(SCRIPT_NAMES) + 1)[1:]


def trigrams(word: str) -> list[str]:
    w = f" {word} "
    return [w[i:i + 3] for i in range(len(w) - 2)]


class Model:
    """Learned counts, word scoring and labelling; remembers the scores of
    recent words (bounded)."""

    def __init__(self, langs, totals, words, grams, scripts):
        self.langs, self.totals, self.words, self.scripts = langs, totals, words, scripts
        self.grams = {g: i for i, g in enumerate(grams)}
        counts = np.array(list(grams.values()), np.float64).reshape(len(grams), len(langs))
        self.gram_logs = np.log((counts + 0.5) / (np.array(totals[1], np.float64) + 1.0))
        self._reset()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "rows")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._reset()

    def _reset(self):
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((1024, max(1, len(self.langs))), np.float32)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Score of each word per language: 0 for the best candidate, down to
        -WORD_CAP for others, twice that where the script rules a language out;
        all 0 if no learned language uses the script."""
        raw = np.zeros((len(words), len(self.langs)))
        known, counts, owner, at = [], [], [], []
        for i, w in enumerate(words):
            c = self.words.get(w)
            if c:
                known.append(i)
                counts.append(c)
            else:
                found = [g for g in map(self.grams.get, trigrams(w)) if g is not None]
                at += found
                owner += [i] * len(found)
        if known:
            raw[known] = np.log((np.array(counts) + 0.2) / (np.array(self.totals[0]) + 1.0))
        if at:
            logs = self.gram_logs[at]
            for k in range(raw.shape[1]):
                raw[:, k] += np.bincount(owner, logs[:, k], len(words))
        none = [False] * len(self.langs)
        fits = np.array([self.scripts.get(script(w), none) for w in words], bool)
        top = np.where(fits, raw, -np.inf).max(axis=1, keepdims=True)
        out = np.where(fits, np.maximum(raw - top, -WORD_CAP), -2 * WORD_CAP)
        out[~fits.any(axis=1)] = 0.0
        return out

    def _remember(self, words: list[str]) -> None:
        """Rows of words the memo doesn't hold."""
        new = list(dict.fromkeys(words))
        first = len(self.memo)
        self.memo.update(zip(new, range(first, first + len(new))))
        while len(self.rows) < len(self.memo):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[first:first + len(new)] = self.word_scores(new)

    def scores(self, words: list[str]) -> np.ndarray:
        """Word scores of a whole text, in steps the memo can hold."""
        parts = []
        for i in range(0, len(words), 50_000):
            step = [w.lower() for w in words[i:i + 50_000]]
            if len(self.memo) + len(step) > MEMO_ENTRIES:
                self._reset()
            get = self.memo.get
            at = [get(w) for w in step]
            if None in at:
                self._remember([w for w, a in zip(step, at) if a is None])
                at = [get(w) if a is None else a for w, a in zip(step, at)]
            parts.append(self.rows[at])
        return np.concatenate(parts)

    def label(self, s: np.ndarray) -> np.ndarray:
        """Best language of every word.  Where no stretch gains more than one
        penalty over the best single language, that language is the Viterbi
        path (leaving it costs at least one penalty); else the path is run."""
        one = int(s.sum(axis=0, dtype=np.float64).argmax())
        if s.shape[1] == 1:
            return np.zeros(len(s), np.int64)
        gain = np.delete(s, one, axis=1).max(axis=1) - s[:, one]
        run = np.concatenate([[0.0], np.cumsum(gain, dtype=np.float64)])
        if (run - np.minimum.accumulate(run)).max() <= SWITCH_PENALTY:
            return np.full(len(s), one)
        return viterbi(s, SWITCH_PENALTY)

    def predict(self, text: str | None):
        """(language, score, spans): score is the share of letters the
        language labels; spans are (start, end, language), code points, and
        together cover the text.  ``und``, 0 and no span without a letter;
        score 0 where no word is in a script of a learned language."""
        words = _WORD.findall(text) if text else []
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return UNDETERMINED, 0.0, []
        s = self.scores(words)
        if not s.any():  # no evidence: the most frequent language
            usable = any(script(w) in self.scripts for w in words)
            return self.langs[0], 1.0 / len(self.langs) if usable else 0.0, [(0, len(text), self.langs[0])]
        path = self.label(s)
        if (path == path[0]).all():
            best = self.langs[int(path[0])]
            return best, 1.0, [(0, len(text), best)]
        letters = np.bincount(path, np.fromiter(map(len, words), np.float64, len(words)), len(self.langs))
        best = int(letters.argmax())
        cuts = np.flatnonzero(np.diff(path)) + 1
        places = [m.start() for m in _WORD.finditer(text)]
        starts = [0, *(places[c] for c in cuts)]
        names = [self.langs[int(path[c])] for c in (0, *cuts)]
        spans = list(zip(starts, [*starts[1:], len(text)], names))
        return self.langs[best], float(letters[best] / letters.sum()), spans


def viterbi(s: np.ndarray, penalty: float) -> np.ndarray:
    """Labels maximising the sum of scores less a penalty per switch; ties
    stay in the language, then go to the first."""
    n, k = s.shape
    back = np.zeros((n, k), np.int8 if k < 128 else np.int32)
    best = s[0].astype(np.float64)
    own = np.arange(k)
    for t in range(1, n):
        top = int(best.argmax())
        away = best[top] - penalty
        stay = best >= away
        back[t] = np.where(stay, own, top)
        best = np.where(stay, best, away) + s[t]
    path = np.empty(n, np.int64)
    path[-1] = int(best.argmax())
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def script_counts(rows: DataFrame) -> DataFrame:
    """One row per language and script of ``rows`` (``lang``, ``text``,
    ``bucket``): its words, the rows with such words and their lowest bucket;
    script ``any`` stands for words of all scripts."""
    def run(batches):
        for b in batches:
            found = np.array([script_words(t) for t in b["text"]]).reshape(len(b), len(SCRIPT_NAMES))
            found = np.column_stack([found, found.sum(axis=1)])
            at, name = np.nonzero(found)
            got = pd.DataFrame({"lang": b["lang"].to_numpy()[at], "script": np.array([*SCRIPT_NAMES, "any"])[name],
                                "words": found[at, name], "rows": 1, "low": b["bucket"].to_numpy()[at]})
            yield got.groupby(["lang", "script"], as_index=False).agg({"words": "sum", "rows": "sum", "low": "min"})
    return rows.select("lang", "text", "bucket").mapInPandas(
        run, "lang string, script string, words long, rows long, low long").groupBy("lang", "script").agg(
        F.sum("words").alias("words"), F.sum("rows").alias("rows"), F.min("low").alias("low"))


def _quota(sizes: list[int], total: int) -> float:
    """Largest bound such that sizes cut to it sum to at most ``total``."""
    left = sorted(sizes)
    for i, n in enumerate(left):
        bound = total / (len(left) - i)
        if n > bound:
            return bound
        total -= n
    return math.inf


def _most(counts: DataFrame, limit: int) -> DataFrame:
    """Counts of each language's ``limit`` most frequent words, in all
    languages.  How many words have each count tells where to cut; of the words
    that tie there about as many as still fit are chosen by hash."""
    sizes: dict[str, list[tuple[int, int]]] = {}
    for r in counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("words")).collect():
        sizes.setdefault(r.lang, []).append((r.n, r.words))
    cuts = []
    for lang, have in sizes.items():
        left, cut, share = limit, 0, 0
        for n, words in sorted(have, reverse=True):
            if words > left:
                cut, share = n, left * 1_000_000 // words
                break
            left -= words
        cuts.append((lang, cut, share))
    cut = F.broadcast(counts.sparkSession.createDataFrame(cuts, "lang string, cut long, share long"))
    top = counts.join(cut, "lang").filter((F.col("n") > F.col("cut")) | (F.col("n") == F.col("cut")) & (
        F.pmod(F.xxhash64("word"), F.lit(1_000_000)) < F.col("share"))).select("word").distinct()
    return counts.join(top, "word").select("word", "lang", "n")


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, max_words: int = MAX_WORDS,
        max_grams: int = MAX_GRAMS) -> Model:
    """Learn from ``text`` and ``lang`` of ``labelled`` (rows with a null in
    either don't count).  Languages and their scripts come from all rows: a
    script is a language's own if it has a thousandth of its words.  Words and
    trigrams are counted in about ``fit_rows`` rows, chosen by a hash of
    doc_id; the languages share them equally, those with fewer rows give all,
    and each gives one at least."""
    spark = labelled.sparkSession
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "text", F.col("lang").cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1_000_000)).alias("bucket"))
    seen = script_counts(rows).collect()
    whole = {r.lang: r for r in seen if r.script == "any"}
    if not whole:
        return Model([], ([], []), {}, {}, {})
    langs = sorted(whole, key=lambda x: (-whole[x].words, x))
    at = {x: i for i, x in enumerate(langs)}
    scripts: dict[str, list[bool]] = {}
    for r in seen:
        if r.script != "any" and r.words >= 0.001 * whole[r.lang].words:
            scripts.setdefault(r.script, [False] * len(langs))[at[r.lang]] = True
    quota = _quota([r.rows for r in whole.values()], fit_rows)
    below = [(x, max(math.ceil(min(1.0, quota / r.rows) * 1_000_000), r.low + 1)) for x, r in whole.items()]
    chosen = rows.join(F.broadcast(spark.createDataFrame(below, "lang string, below long")), "lang").filter("bucket < below")
    words = chosen.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    counts, path = write_stage(words.filter("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words")
    grams = counts.select("lang", "n", F.concat(F.lit(" "), F.col("word"), F.lit(" ")).alias("w")).select(
        "lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substring(F.col("w"), i, F.lit(3))))
        .alias("word")).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    grams, grams_path = write_stage(grams, "grams")
    totals = [{r.lang: r.n for r in f.groupBy("lang").agg(F.sum("n").alias("n")).collect()} for f in (counts, grams)]

    def table(rows_):
        out: dict[str, list[float]] = {}
        for r in rows_:
            out.setdefault(r.word, [0.0] * len(langs))[at[r.lang]] = float(r.n)
        return out
    known, tri = table(_most(counts, max_words).collect()), table(_most(grams, max_grams).collect())
    drop_stage(spark, path, grams_path)
    return Model(langs, tuple([t.get(x, 0) for x in langs] for t in totals), known, tri, scripts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc`` (struct of the input columns) and ``lang_pred, score, spans``
    from the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(t) for t in texts]
        return pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
                             "spans": [[{"start": a, "end": b, "lang": g} for a, b, g in f[2]] for f in found]})
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), run(docs["text"]).alias("p")).select(
        "doc", "p.lang_pred", "p.score", "p.spans")


def held_out(doc_id: Column) -> Column:
    """Every third document by CRC-32 of its id's text is not learned from; a
    null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def drop_undetermined(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) without texts in no learned language: null, no
    letter, or no word in a script that a learned language uses."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    kept = predict(docs, model).filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") > 0))
    return kept.select("doc.*")
