"""SentencePiece encoding and decoding by streaming Viterbi.

A text is read left to right.  A score is needed for one longest piece only;
as soon as every surviving backpointer path runs through one boundary, the ids
before it are committed and their backpointers dropped (a run of one letter,
whose paths may never meet, keeps them to its end).  No piece reaches across a boundary between a non-space and a space,
or to either side of a line break (checked when the model is loaded), so all
paths meet there; the stretch between two such boundaries is the unit that is
committed, and its ids are remembered (bounded) for the next time it occurs.

The ids are those of the best path under the model file's piece scores (sum
of scores, byte fallback for characters without a piece, earlier start wins
ties).  The file given here holds merge ranks as scores; the library's own
merge loop for such files may choose other pieces.  Decoding gives back the
exact text.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelweave.llm.common import Recent

MARK = "▁"
#: Remembered stretches per Python worker, and the longest one remembered.
MEMO_ENTRIES, MEMO_CHARS = 250_000, 64
STEP_ROWS = 500
UNKNOWN_PENALTY = 10.0
_ID = np.dtype("=i4")
_NEVER = float("-inf")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces: dict[str, tuple[int, float]] = {}
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.surface.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.surface.append(b"")
            else:
                pieces[p] = (i, sp.get_score(i))
                self.surface.append(p.replace(MARK, " ").encode())
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        #: Every prefix of a piece; False where it is no piece itself.
        self.table: dict[str, tuple[int, float] | bool] = {p[:k]: False for p in pieces for k in range(1, len(p))}
        self.table.update(pieces)
        meets = not any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in pieces)
        self.stretches = re.compile(r" *[^ \n]+|\n| +" if meets else r"(?s).+")
        self.memo = Recent(self.unit_ids, MEMO_ENTRIES, MEMO_CHARS)
        self.window = 0

    def unit_ids(self, stretch: str) -> bytes:
        return array("i", self.stream(stretch)).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; none for a null or empty text."""
        if not text:
            return np.empty(0, _ID)
        return np.frombuffer(b"".join(map(self.memo.__getitem__, self.stretches.findall(" " + text))), _ID)

    def stream(self, stretch: str) -> list[int]:
        """Best path of one stretch, committed as paths meet.  ``best[j]`` and
        ``back[j]`` are for the boundary ``base + j``; both reach one longest
        piece ahead of the character being read."""
        s = (stretch.replace(MARK, "\0") if MARK in stretch else stretch).replace(" ", MARK)
        n, out, base, reach, ahead = len(s), [], 0, 0, self.longest
        best, back, table = [0.0] + [_NEVER] * ahead, [0] * (ahead + 1), self.table
        look = 4 * ahead  # paths that don't meet are looked at again when twice as long
        for i in range(n):
            here, known = best[i - base], False
            for k in range(i + 1, min(n, i + ahead) + 1):
                hit = table.get(s[i:k])
                if hit is None:
                    break
                if hit:
                    known = known or k == i + 1
                    score, j = here + hit[1], k - base
                    if score > best[j]:
                        best[j], back[j] = score, i
                        if k > reach:
                            reach = k
            if not known:
                score, j = here + self.unknown, i + 1 - base
                if score > best[j]:
                    best[j], back[j] = score, i
                    reach = max(reach, i + 1)
            best.append(_NEVER)
            back.append(0)
            if reach == i + 1:
                met = reach
            elif len(best) > look:
                met = self._meeting(best, back, i + 1 - base, base)
                look = max(4 * ahead, 2 * (len(best) - met + base))
            else:
                continue
            if met > base:
                self.window = max(self.window, len(best))
                out.extend(self._commit(s, stretch, back, base, met))
                low = best[met - base]
                best = [b - low for b in best[met - base:]]
                back, base = back[met - base:], met
        return out

    @staticmethod
    def _meeting(best, back, at, base) -> int:
        """The last boundary that the paths to all open positions share."""
        live = {base + j for j in range(at, len(best)) if best[j] > _NEVER}
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(back[top - base] if top > base else base)
        return max(base, live.pop())

    def _commit(self, s, stretch, back, base, met) -> list[int]:
        ids, j = [], met
        while j > base:
            i = back[j - base]
            hit = self.table.get(s[i:j])
            if hit:
                ids.append(hit[0])
            else:
                ids += [self.byte_ids[b] for b in reversed(stretch[i:j].encode("utf-8", "surrogatepass"))]
            j = i
        ids.reverse()
        return ids

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "surrogatepass")


@lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_ids(path: str | None = None):
    """Column function text -> ``struct<ids, n_ids, ids_crc32, round_trip>``:
    ids of the whole text, their number, CRC-32 of the little-endian 32-bit
    ids, and whether decoding them gives the text back.  A null text has no
    ids and counts as a round trip of nothing."""
    path = path or default_model()

    @F.pandas_udf("ids array<int>, n_ids long, ids_crc32 long, round_trip boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        m = model(path)
        ids = [m.encode(t) for t in texts]
        return pd.DataFrame({"ids": ids, "n_ids": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x) for x in ids],
                             "round_trip": [m.decode(x) == (t or "") for x, t in zip(ids, texts)]})
    return run


def decode_ids(path: str | None = None):
    """Column function ids -> text."""
    path = path or default_model()

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        m = model(path)
        return ids.map(lambda x: None if x is None else m.decode(np.asarray(x, _ID)))
    return run


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, round_trip, ids`` for every row of ``docs``
    (further columns are not read); repeated rows give repeated results.
    Results leave a task a few hundred documents at a time."""
    path = path or default_model()
    pairs = docs.select("doc_id", "text")

    def run(batches):
        m = model(path)
        for b in batches:
            for at in range(0, b.num_rows, STEP_ROWS):
                part = b.slice(at, STEP_ROWS)
                texts = part.column(1).to_pylist()
                ids = [m.encode(t) for t in texts]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array([m.decode(x) == (t or "") for x, t in zip(ids, texts)], pa.bool_()),
                    pa.ListArray.from_arrays(ends, np.concatenate(ids))],
                    names=["doc_id", "n_ids", "ids_crc32", "round_trip", "ids"])
    kind = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(run, f"doc_id {kind}, n_ids long, ids_crc32 long, round_trip boolean, ids array<int>")
