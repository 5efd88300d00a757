"""Hierarchical multi-length packing of documents into training sequences.

Context sizes form tiers (2048, 1024, 512, 256 tokens by default).  A document
gives whole windows of the longest tier; what is left of it is routed to the
shortest tier that holds it.  Tiers are packed from the longest: a piece opens
a window, the gap is filled with the longest whole pieces of shorter tiers that
fit, and the rest of the gap with the head of the next longer one, whose tail
goes back to its own tier.  So every window is full; only what a bucket has
left at its end becomes sequences of smaller powers of two.  A bucket's
sequences are dealt to step groups of equal tokens and near equal attention
cost (the sum of the squared piece lengths).

A task tokenizes the documents of its split and packs them bucket by bucket,
so nothing is shuffled and a task holds one bucket.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelweave.llm.encoders import batches_of, encoder

END_ID = 1
TIERS = (2048, 1024, 512, 256)
#: A bucket is closed at this many tokens or documents; tokens of a step.
BUCKET_TOKENS, BUCKET_DOCS, STEP_TOKENS = 1 << 20, 1 << 16, 1 << 17
OUT_ROWS = 4096
PIECE = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, context int, "
         "step_group long, ids binary")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Pool:
    """Pieces ``(doc, start, length)`` by length."""

    def __init__(self, longest: int):
        self.held = [[] for _ in range(longest + 1)]
        self.lengths = 0  # bit n: there is a piece of length n

    def put(self, doc: int, start: int, length: int) -> None:
        self.held[length].append((doc, start, length))
        self.lengths |= 1 << length

    def _take(self, length: int):
        stack = self.held[length]
        piece = stack.pop()
        if not stack:
            self.lengths ^= 1 << length
        return piece

    def longest(self, most: int, least: int = 1):
        """The longest piece of ``least`` to ``most`` tokens, taken out (None: there is none)."""
        fits = (self.lengths & ((1 << (most + 1)) - 1)) >> least
        return self._take(least + fits.bit_length() - 1) if fits else None

    def next_longer(self, than: int):
        """The shortest piece of more than ``than`` tokens, taken out."""
        fits = self.lengths >> (than + 1)
        return self._take(than + (fits & -fits).bit_length()) if fits else None


def _tail(pieces: list, total: int) -> list[tuple[int, list]]:
    """Sequences of powers of two, longest first, of all tokens of ``pieces``."""
    out, at = [], 0
    pieces = pieces[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        gap = total & 1 << bit
        if not gap:
            continue
        window = []
        while gap:
            doc, start, length = pieces.pop()
            take = min(gap, length)
            window.append((doc, start, take))
            if take < length:
                pieces.append((doc, start + take, length - take))
            gap -= take
        out.append((1 << bit, window))
    return out


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list]]:
    """``(context, [(doc, start, length), ...])`` of every sequence: each token
    of documents of these lengths lies in exactly one piece, and a sequence's
    pieces fill its context, a power of two."""
    top, out = tiers[0], []
    pool = Pool(top)
    for doc, n in enumerate(lengths):
        cut = n - n % top
        out += [(top, [(doc, at, top)]) for at in range(0, cut, top)]
        if n > cut:
            pool.put(doc, cut, n - cut)
    for tier, below in zip(tiers, (*tiers[1:], 0)):
        while piece := pool.longest(tier, below + 1):
            window, gap = [piece], tier - piece[2]
            while gap and (piece := pool.longest(gap)):
                window.append(piece)
                gap -= piece[2]
            if gap and (piece := pool.next_longer(gap)):
                doc, start, length = piece
                window.append((doc, start, gap))
                pool.put(doc, start + gap, length - gap)
                gap = 0
            out += [(tier, window)] if not gap else _tail(window, tier - gap)
    return out


def step_groups(sequences: list[tuple[int, list]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group (from 0) for every sequence: as many groups as whole steps
    (one at least), the longest and costliest sequence first to the group with
    the fewest tokens, then the least attention cost."""
    cost = [sum(n * n for _, _, n in pieces) for _, pieces in sequences]
    total = sum(context for context, _ in sequences)
    heap = [(0, 0, g) for g in range(max(1, round(total / step_tokens)))]
    out = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: (-sequences[i][0], -cost[i], i)):
        tokens, spent, g = heap[0]
        out[i] = g
        heapq.heapreplace(heap, (tokens + sequences[i][0], spent + cost[i], g))
    return out


def _with_ends(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids as 32 bits with ``end_id`` after each text, and each text's count."""
    n = len(ends) - 1
    out = np.empty(len(ids) + n, "<u4")
    last = ends[1:] + np.arange(n)
    body = np.ones(len(out), bool)
    body[last] = False
    out[body], out[last] = ids, end_id
    return out, np.diff(ends) + 1


class Bucket:
    def __init__(self):
        self.doc_ids, self.flat, self.lengths, self.tokens = [], [], [], 0

    def add(self, doc_ids: list, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.flat.append(flat)
        self.lengths += lengths.tolist()
        self.tokens += len(flat)

    def batches(self, number: int, first_sequence: int, first_group: int, tiers, step_tokens):
        """Arrow batches of the pieces, and the numbers of sequences and groups."""
        sequences = pack(self.lengths, tiers)
        groups = step_groups(sequences, step_tokens)
        begin = np.cumsum([0, *self.lengths]).tolist()
        raw = np.concatenate(self.flat).tobytes()
        rows, high = [], number << 32
        for k, ((context, pieces), group) in enumerate(zip(sequences, groups)):
            at = 0
            for doc, start, n in pieces:
                a = 4 * (begin[doc] + start)
                rows.append((self.doc_ids[doc], start, n, self.lengths[doc], high + first_sequence + k, at, context,
                             high + first_group + group, raw[a:a + 4 * n]))
                at += n
        kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in PIECE.split(", ")]
        out = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + OUT_ROWS]), kinds)], names=names)
               for i in range(0, len(rows), OUT_ROWS)]
        return out, len(sequences), max(groups, default=-1) + 1


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, tiers: tuple[int, ...] = TIERS,
                   bucket_tokens: int = BUCKET_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces of the sequences that hold the ids of every whole text of
    ``docs`` (``doc_id``, ``text``; further columns are not read) and
    ``end_id`` after each: ``doc_id, start, length, doc_tokens, sequence_id,
    offset, context, step_group, ids`` (little-endian unsigned 32-bit).

    ``tiers`` are powers of two, longest first.  A sequence's pieces fill its
    context: a tier, or a smaller power of two for the last tokens of a bucket
    (a task's documents up to ``bucket_tokens``).  A null or empty text is its
    end id alone; a text of any length counts whole; rows that repeat an id,
    or have none, are documents of their own; an empty table has no pieces."""
    if not tiers or list(tiers) != sorted(set(tiers), reverse=True) or any(t & t - 1 or t < 1 for t in tiers):
        raise ValueError("tiers must be powers of two, longest first")
    path = tokenizer or default_tokenizer()

    def run(batches):
        ids_of, number = encoder(path), TaskContext.get().partitionId()
        bucket, sequences, groups = Bucket(), 0, 0
        for batch in batches:
            for part in batches_of(batch, 1):
                ids, ends = ids_of.encode_column(part.column(1))
                bucket.add(part.column(0).to_pylist(), *_with_ends(ids, ends, end_id))
                if bucket.tokens >= bucket_tokens or len(bucket.lengths) >= BUCKET_DOCS:
                    out, n, g = bucket.batches(number, sequences, groups, tiers, step_tokens)
                    yield from out
                    bucket, sequences, groups = Bucket(), sequences + n, groups + g
        if bucket.lengths:
            yield from bucket.batches(number, sequences, groups, tiers, step_tokens)[0]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE)
