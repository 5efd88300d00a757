"""Fast whole-text encoders for tokenizer files of known settings.

A file's normalizer, pre-tokenizer and model settings are read from it.  Where
they are known, a text is cut where the library's own steps cannot reach
across, and the ids of recent stretches are remembered (bounded); a file with
any other setting, and a text that holds an added token's string, goes to the
library whole.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Remembered stretches, the longest of them, and the text that is cut at once.
MEMO_ENTRIES, MEMO_CHARS, COLUMN_BYTES = 500_000, 40, 8 << 20
#: Settings of the lower-casing word-end files that ``WordEncoder`` knows (fixed values).
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Settings of the byte-level files that ``ByteEncoder`` knows (fixed values).
BYTE_PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: White space by code point, and what Arrow and Python but not the library take for it.
_SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CONTROL = r"[\x1c-\x1f]"
_MARKS = frozenset(".,;:!?)")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def settings(path: str) -> dict:
    """The settings of a tokenizer file, without its vocabulary."""
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    model = {k: v for k, v in held["model"].items() if k not in ("vocab", "merges")}
    return {"normalizer": held.get("normalizer"), "pre_tokenizer": held.get("pre_tokenizer"), "model": model,
            "post_processor": held.get("post_processor"), "truncation": held.get("truncation"), "padding": held.get("padding"),
            "normalized": any(t.get("normalized") or t.get("single_word") or t.get("lstrip") or t.get("rstrip")
                              for t in held.get("added_tokens", []))}


def _plain_model(s: dict) -> bool:
    m = s["model"]
    return (m.get("type") == "BPE" and not any(m.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk",
                                                                  "byte_fallback", "ignore_merges"))
            and not s["normalized"] and not s["truncation"] and not s["padding"])


def is_word_end(path: str) -> bool:
    s = settings(path)
    return _plain_model(s) and s["normalizer"] == WORD_NORMALIZER and s["pre_tokenizer"] == WORD_PRE_TOKENIZER


def is_byte_level(path: str) -> bool:
    s = settings(path)
    return (_plain_model(s) and s["normalizer"] is None and s["pre_tokenizer"] == BYTE_PRE_TOKENIZER
            and not s["model"].get("end_of_word_suffix"))


class WholeEncoder:
    """The library on whole texts; ids as ``kind``, the fewest bytes that hold them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")

    def encode(self, text: str | None) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.kind).tobytes() if text else b""

    def encode_column(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none for a null one), one after another, and where
        each text's begin and end."""
        raw = [self.encode(t) for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, raw)]) // self.kind.itemsize
        return np.frombuffer(b"".join(raw), self.kind), ends


class StretchEncoder(WholeEncoder):
    """Texts are cut into stretches; the distinct stretches of a column are
    looked up once each, and their ids gathered by numpy."""

    def __init__(self, path: str):
        super().__init__(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.merge = self.whole.model.tokenize
        self.code = "H" if self.kind.itemsize == 2 else "I"
        #: Ids of recent stretches, in two generations.
        self.seen: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, spelled: str) -> bytes:
        return array(self.code, [t.id for t in self.merge(spelled)]).tobytes()

    def stretch(self, s: str) -> bytes:
        """Ids of one stretch."""
        raise NotImplementedError

    def known(self, word: str, make) -> bytes:
        """Ids of a word inside a stretch, remembered like a stretch."""
        ids = self.seen.get(word) or self.old.get(word)
        if ids is None:
            ids = make(word)
            if len(word) <= MEMO_CHARS:
                self.seen[word] = ids
        return ids

    def cut(self, texts: pa.StringArray) -> pa.ListArray:
        """Stretches of each text."""
        raise NotImplementedError

    def unfit(self, texts: pa.StringArray) -> pa.BooleanArray:
        """The texts that ``cut`` can't be used for; they are encoded one by one."""
        raise NotImplementedError

    def recall(self, stretches: list[str]) -> list[bytes]:
        """Ids of each of the stretches."""
        out = list(map(self.seen.get, stretches))
        for i, ids in enumerate(out):
            if ids is None:
                s = stretches[i]
                out[i] = ids = self.old.get(s) or self.stretch(s)
                if len(s) <= MEMO_CHARS:
                    self.seen[s] = ids
        if len(self.seen) > MEMO_ENTRIES:
            self.old, self.seen = self.seen, {}
        return out

    def encode_column(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        mask = self.unfit(texts)
        odd = np.flatnonzero(mask.to_numpy(zero_copy_only=False)).tolist()
        if odd:
            alone = {i: np.frombuffer(self.encode(texts[i].as_py()), self.kind) for i in odd}
            texts = pc.if_else(mask, "", texts)
        lists = self.cut(texts)
        offsets = lists.offsets.to_numpy()
        known = lists.flatten().dictionary_encode()
        raw = self.recall(known.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // self.kind.itemsize
        flat, begin = np.frombuffer(b"".join(raw), self.kind), np.cumsum(size) - size
        at = known.indices.to_numpy()
        n = size[at]
        stop = np.concatenate([[0], np.cumsum(n)])
        # a column's ids are counted in 32 bits
        from_start = np.repeat((begin[at] - stop[:-1]).astype(np.int32), n)
        from_start += np.arange(stop[-1], dtype=np.int32)
        ids = flat[from_start]
        ends = stop[np.concatenate([[0], offsets[1:] - offsets[0]])]
        if odd:
            parts = [alone.get(i, ids[a:z]) for i, (a, z) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist()))]
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return ids, ends


def batches_of(batch: pa.RecordBatch, column: int, limit: int = COLUMN_BYTES):
    """Slices of a batch whose texts take about ``limit`` bytes (one row at least)."""
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit)))
        yield batch.slice(at, stop - at)
        at = stop


class WordEncoder(StretchEncoder):
    """No step of such a file reaches across white space: a text is the words
    between it."""

    def __init__(self, path: str):
        super().__init__(path)
        # white space to Arrow alone (the library takes it for marks), and added tokens
        self.odd = "|".join([_CONTROL, *map(re.escape, self.added)])
        self.letters = dict(enumerate(byte_letters()))
        self.normal, self.parts = self.whole.normalizer.normalize_str, self.whole.pre_tokenizer.pre_tokenize_str
        self.latin = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch

    def unfit(self, texts: pa.StringArray) -> pa.BooleanArray:
        return pc.match_substring_regex(texts, self.odd)

    def cut(self, texts: pa.StringArray) -> pa.ListArray:
        return pc.utf8_split_whitespace(texts)

    def _word(self, word: str) -> bytes:
        """Ids of a lower-case Latin word."""
        return self.merged(word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))

    def stretch(self, s: str) -> bytes:
        if self.latin(s):
            return self._word(s.lower())
        if s[-1:] in _MARKS and self.latin(s[:-1]):
            return self.known(s[:-1], lambda w: self._word(w.lower())) + self.known(s[-1], self.merged)
        return b"".join([self.merged(part) for part, _ in self.parts(self.normal(s))])


class ByteEncoder(StretchEncoder):
    """Such a file splits a text into words before merging, and never across a
    space that a non-space follows, nor beside a lone line break; each stretch
    keeps the space before it."""

    def __init__(self, path: str):
        super().__init__(path)
        import public_tokenizers
        import regex
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.spaces = regex.compile(r"(?= \S)").split
        self.control = re.compile(_CONTROL).search
        # letters that every Unicode version knows; the library cuts other stretches itself
        self.latin = re.compile("[\x00-\u024f]*").fullmatch
        self.parts = self.whole.pre_tokenizer.pre_tokenize_str
        self.odd = "|".join([_SPACE + _SPACE, _CONTROL, *map(re.escape, self.added)])
        self.letters = dict(enumerate(byte_letters()))
        self.space = self.letters[32]

    def unfit(self, texts: pa.StringArray) -> pa.BooleanArray:
        return pc.match_substring_regex(texts, self.odd)

    def cut(self, texts: pa.StringArray) -> pa.ListArray:
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\x1f "), "\n", "\x1f\n\x1f")
        return pc.split_pattern(marked, "\x1f")

    def _word(self, word: str) -> bytes:
        # printable ASCII stands for itself, but for the space
        if word.isascii() and word.isprintable():
            return self.merged(word.replace(" ", self.space))
        return self.merged(word.encode().decode("latin-1").translate(self.letters))

    def stretch(self, s: str) -> bytes:
        if not (s.isascii() or self.latin(s)):
            return b"".join([self.merged(part) for part, _ in self.parts(s)])
        # letters alone are one word, and so is a mark behind them
        body = s[1:] if s[:1] == " " else s
        if body.isalpha():
            return self._word(s)
        if body[-1:] in _MARKS and body[:-1].isalpha():
            return self.known(s[:-1], self._word) + self.known(s[-1], self._word)
        return b"".join(map(self._word, self.split(s)))

    def encode(self, text: str | None) -> bytes:
        if not text or self.control(text) or any(a in text for a in self.added):
            return super().encode(text)
        return b"".join(self.recall(self.spaces(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> WholeEncoder:
    """The fastest encoder that knows the settings of a tokenizer file."""
    return (WordEncoder if is_word_end(path) else ByteEncoder if is_byte_level(path) else WholeEncoder)(path)
