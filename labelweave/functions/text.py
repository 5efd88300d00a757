"""Text expressions: request text assembly and the built-in tokenizer.

The built-in tokenizer is a JVM-side expression (no Python): ASCII letters
are lower-cased, runs of ASCII whitespace/punctuation split tokens, and a
token's id is the first 32 bits of its md5 digest.  Scoring takes the same ids
of a larger input from ``hashed_token_ids``, which hashes a word once a batch.
Other tokenizers plug in through ``operators.scoring.PandasScorer``
(``mapInPandas``).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from labelweave import config as C


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def request_text(title="title", abstract="abstract", missing: str = C.DEFAULT.missing_text) -> Column:
    """``title + ' ' + abstract`` where a missing part becomes ``missing``."""
    return F.concat(F.coalesce(_c(title), F.lit(missing)), F.lit(" "), F.coalesce(_c(abstract), F.lit(missing)))


def tokens(text) -> Column:
    """C1 (strings): split text into tokens, dropping empty pieces."""
    low = F.translate(_c(text), C.UPPER_ASCII, C.LOWER_ASCII)
    return F.filter(F.split(low, C.TOKEN_SEPARATORS), lambda t: t != "")


def token_id(tok) -> Column:
    """Stable 32-bit id of one token (first 8 hex digits of md5)."""
    return F.conv(F.substring(F.md5(_c(tok)), 1, 8), 16, 10).cast("bigint")


def token_ids(text) -> Column:
    """Text -> array<bigint> of token ids, no special tokens."""
    return F.transform(tokens(text), token_id)


_SEPARATORS = bytes(b for b in range(128) if re.fullmatch(C.TOKEN_SEPARATORS, chr(b)))
_FOLD = bytes.maketrans(C.UPPER_ASCII.encode() + _SEPARATORS, C.LOWER_ASCII.encode() + b" " * len(_SEPARATORS))


_STEP_BYTES = 8 << 20


def _id_lists(texts: pa.Array) -> pa.Array:
    """Token ids of a batch of texts, some ``_STEP_BYTES`` of text at a time,
    so that a batch of long texts is not held as words at once."""
    step = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64) // _STEP_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(texts)]
    return pa.concat_arrays([_step_ids(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])


def _step_ids(texts: pa.Array) -> pa.Array:
    """Token ids of texts in UTF-8, where an ASCII byte is never part of another
    character.  Words repeat, so each one is hashed once a step."""
    folded = pa.array([None if t is None else t.translate(_FOLD) for t in texts.to_pylist()], pa.large_binary())
    split = pc.split_pattern(folded, " ")
    words = split.flatten().dictionary_encode()
    ids = np.array([int.from_bytes(hashlib.md5(w).digest()[:4], "big") if w else -1 for w in words.dictionary.to_pylist()],
                   dtype=np.int64)[words.indices.to_numpy()]
    kept = ids >= 0  # a separator at either end, or two in a row, leave an empty piece
    ends = np.cumsum(pc.fill_null(split.value_lengths(), 0).to_numpy(), dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])]
    return pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(ids[kept]), mask=texts.is_null())


def hashed_token_ids(text) -> Column:
    """The ids of ``token_ids``, in Arrow batches."""
    return F.arrow_udf(_id_lists, ArrayType(LongType()))(_c(text).cast("binary"))
