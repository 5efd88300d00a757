"""Token ids in entropy-coded files.

Ids are counted over all documents; one shared frequency table drives a range
asymmetric numeral system.  Documents are written in ascending doc_id order as
independent blocks.  A block deals its ids over interleaved lanes (so numpy
codes a row of lanes at a time), keeps the lanes' states every few rows as
checkpoints, from which decoding may start, and carries a CRC-32.  The folder
holds two Parquet tables: ``frequencies`` (id, freq) and ``blocks`` (one row
per block), so writing follows Spark's commit protocol and any block decodes
on its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelweave.llm.common import ROW, drop_stage, with_row_identity, write_stage
from labelweave.llm.encoders import ByteEncoder, batches_of, encoder
from labelweave.session import scratch_dir

END_ID = 2
SCALE_BITS = 18
BLOCK_TOKENS, LANES, CHECKPOINT_ROWS = 1 << 18, 4096, 32
LOW = np.uint64(1 << 31)
STEP_ROWS = 500
_ID = np.dtype("=u4")


# ---------------------------------------------------------------- tokens ----
def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder(ByteEncoder):
    """Whole-text ids of a byte-level tokenizer file, as little-endian 32-bit numbers."""

    def encode(self, text: str | None) -> bytes:
        return np.frombuffer(super().encode(text), self.kind).astype(_ID).tobytes()


# ---------------------------------------------------------------- coding ----
def frequencies(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Counts scaled to sum to 2**bits, at least 1 for every id that occurs."""
    total, room = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros_like(counts)
    if np.count_nonzero(counts) > room:
        raise ValueError("more distinct ids than the table has room for")
    freq = np.where(counts > 0, np.maximum(1, (counts.astype(np.float64) / total * room).astype(np.int64)), 0)
    over = int(freq.sum()) - room
    for i in np.argsort(-freq, kind="stable"):
        if over == 0:
            break
        give = min(int(freq[i]) - 1, over) if over > 0 else over
        freq[i] -= give
        over -= give
    return freq


class Coder:
    """Encoder and decoder of one frequency table."""

    def __init__(self, freq: np.ndarray, bits: int = SCALE_BITS):
        self.bits, self.shift = bits, np.uint64(bits)
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_ROWS):
        """(words, states, offsets): 32-bit words in reading order; the lanes'
        states before every ``every``-th row and the words read by then."""
        n = len(ids)
        lanes = max(1, min(lanes, n))
        x = np.full(lanes, LOW)
        chunks, states = [], []
        full = np.uint64(63 - self.bits)
        for r in range((n + lanes - 1) // lanes - 1, -1, -1):
            s = ids[r * lanes:(r + 1) * lanes]
            f, c, y = self.freq[s], self.start[s], x[:len(s)]
            out = y >= f << full
            chunks.append((y[out] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            y = np.where(out, y >> np.uint64(32), y)
            q = y // f
            x[:len(s)] = (q << self.shift) + (y - q * f) + c
            if r % every == 0:
                states.append(x.copy())
        sizes = np.array([len(c) for c in reversed(chunks)] or [0])
        offsets = (np.cumsum(sizes) - sizes)[::every]
        words = np.concatenate(chunks[::-1]) if chunks else np.empty(0, "<u4")
        return words, np.stack(states[::-1]) if states else np.empty((0, lanes), np.uint64), offsets

    def decode(self, n: int, words: np.ndarray, states: np.ndarray, offsets: np.ndarray,
               every: int = CHECKPOINT_ROWS, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids of the rows from checkpoint ``first`` up to checkpoint ``last``
        (the end by default); the whole block from checkpoint 0."""
        if not n:
            return np.empty(0, np.uint32)
        lanes = states.shape[1]
        rows = (n + lanes - 1) // lanes
        stop = rows if last is None else min(rows, last * every)
        x, at = states[first].copy(), int(offsets[first])
        out = np.empty((min(n, stop * lanes) - first * every * lanes), np.uint32)
        mask = np.uint64((1 << self.bits) - 1)
        words = words.astype(np.uint64)
        for r in range(first * every, stop):
            k = min(lanes, n - r * lanes)
            y = x[:k]
            slot = y & mask
            s = self.symbol[slot]
            out[(r - first * every) * lanes:(r - first * every) * lanes + k] = s
            y = self.freq[s] * (y >> self.shift) + slot - self.start[s]
            need = np.flatnonzero(y < LOW)
            y[need] = (y[need] << np.uint64(32)) | words[at:at + len(need)]
            at += len(need)
            x[:k] = y
        return out


BLOCK_SCHEMA = ("part int, block int, n long, doc_ids array<long>, lengths array<int>, lanes int, every int, words binary, "
                "states binary, offsets array<int>, crc32 long")


def pack_block(coder: Coder, part: int, block: int, docs: list, lanes: int, every: int) -> pa.RecordBatch:
    ids = np.concatenate([x for _, x in docs])
    words, states, offsets = coder.encode(ids, lanes, every)
    w, s = words.tobytes(), states.astype("<u8").tobytes()
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()),
        pa.array([[d for d, _ in docs]], pa.list_(pa.int64())), pa.array([[len(x) for _, x in docs]], pa.list_(pa.int32())),
        pa.array([states.shape[1]], pa.int32()), pa.array([every], pa.int32()), pa.array([w], pa.binary()),
        pa.array([s], pa.binary()), pa.array([offsets.astype(np.int32)], pa.list_(pa.int32())),
        pa.array([zlib.crc32(s, zlib.crc32(w))], pa.int64())],
        names=["part", "block", "n", "doc_ids", "lengths", "lanes", "every", "words", "states", "offsets", "crc32"])


# ----------------------------------------------------------------- files ----
def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID,
                      block_tokens: int = BLOCK_TOKENS, lanes: int = LANES, every: int = CHECKPOINT_ROWS) -> None:
    """Write the ids of every whole text (null: empty) of ``docs`` and
    ``end_id`` after each, in ascending doc_id order (null ids first, rows
    that repeat an id in reading order), to ``folder``.  A text of any length
    is coded whole; an empty table gives a table of frequencies and one of
    blocks without rows.  A tokenizer file of settings that ``encoders`` does
    not know is left to the library."""
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    # between tokenizing and coding, ids are held in the fewest bytes and packed
    kind = np.dtype("<u2" if max(end_id, encoder(path).whole.get_vocab_size()) < 1 << 16 else "<u4")

    def ids_of(packed: bytes) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)

    names = [*ROW, "doc_id", "ids", "seen"]

    def encode(batches):
        e, pack = encoder(path), zstandard.ZstdCompressor(level=1).compress
        total = np.zeros(max(end_id + 1, e.whole.get_vocab_size()), np.int64)
        for b in batches:
            for part in batches_of(b, 3):
                ids, ends = e.encode_column(part.column(3))
                total += np.bincount(ids, minlength=len(total))
                total[end_id] += part.num_rows
                raw, end, k = ids.astype(kind, copy=False).tobytes(), np.array([end_id], kind).tobytes(), kind.itemsize
                packed = [pack(raw[k * a:k * z] + end) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
                for at in range(0, part.num_rows, STEP_ROWS):
                    some = part.slice(at, STEP_ROWS)
                    yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array(packed[at:at + STEP_ROWS], pa.binary()),
                                                      pa.nulls(some.num_rows, pa.binary())], names=names)
        # a task's counts travel beside its rows
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(
            1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=names)
    written, tokens_path = write_stage(with_row_identity(docs).select(
        *ROW, F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").alias("text")).mapInArrow(
        encode, "row_file string, row_index long, doc_id long, ids binary, seen binary"), "tokens")
    tokens = written.filter(F.col("ids").isNotNull()).drop("seen")

    def count(batches):
        total = None
        for b in batches:
            for x in b.column(0):
                c = np.frombuffer(x.as_buffer(), "<i8")
                total = c if total is None else total + c
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.record_batch({"id": pa.array(at), "n": pa.array(total[at])})
    # at most one row per id of the vocabulary
    seen = written.filter(F.col("seen").isNotNull()).select("seen").mapInArrow(count, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(seen["id"].max()) + 1 if len(seen) else 1, np.int64)
    counts[seen["id"].to_numpy(np.int64)] = seen["n"].to_numpy(np.int64)
    freq = frequencies(counts)
    spark.createDataFrame(pd.DataFrame({"id": np.flatnonzero(freq), "freq": freq[freq > 0]}), "id long, freq long").coalesce(
        1).write.parquet(f"{folder}/frequencies")
    shared = spark.sparkContext.broadcast(freq)

    def pack(batches):
        coder, part = Coder(shared.value), TaskContext.get().partitionId()
        held, tokens_held, block = [], 0, 0
        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((d, ids_of(x)))
                tokens_held += len(held[-1][1])
                if tokens_held >= block_tokens:
                    yield pack_block(coder, part, block, held, lanes, every)
                    held, tokens_held, block = [], 0, block + 1
        if held:
            yield pack_block(coder, part, block, held, lanes, every)
    (tokens.repartitionByRange("doc_id", *ROW).sortWithinPartitions("doc_id", *ROW).select("doc_id", "ids")
     .mapInArrow(pack, BLOCK_SCHEMA).write.parquet(f"{folder}/blocks"))
    drop_stage(spark, tokens_path)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids`` (little-endian unsigned 32-bit ids, the end id
    included) of every document in the files; ``start`` counts the ids of all
    documents before it.  A block whose checksum differs raises."""
    table = spark.read.parquet(f"{folder}/frequencies").toPandas()
    freq = np.zeros(int(table["id"].max()) + 1 if len(table) else 1, np.int64)
    freq[table["id"].to_numpy(np.int64)] = table["freq"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(freq)
    blocks = spark.read.parquet(f"{folder}/blocks")
    heads, heads_path = write_stage(blocks.select("part", "block", "n"), "heads")
    # one row per written file, then one per block of a file
    files = heads.groupBy("part").agg(F.sum("n").alias("of_part")).select(
        "part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("part_start"))
    at = F.sum("n").over(Window.partitionBy("part").orderBy("block")) - F.col("n")
    starts, _ = write_stage(heads.withColumn("at", at).join(files, "part").select(
        "part", "block", (F.col("part_start") + F.col("at")).alias("start")), "starts")
    drop_stage(spark, heads_path)

    def unpack(batches):
        coder = None
        for b in batches:
            for r in b.to_pylist():
                coder = coder or Coder(shared.value)
                if zlib.crc32(r["states"], zlib.crc32(r["words"])) != r["crc32"]:
                    raise ValueError(f"block {r['part']}/{r['block']} is damaged")
                states = np.frombuffer(r["states"], "<u8").astype(np.uint64).reshape(-1, r["lanes"])
                ids = coder.decode(r["n"], np.frombuffer(r["words"], "<u4"), states, np.asarray(r["offsets"]),
                                   r["every"]).astype(_ID)
                ends = np.cumsum(r["lengths"])
                begins = ends - r["lengths"]
                raw = ids.tobytes()
                yield pa.record_batch({
                    "doc_id": pa.array(r["doc_ids"], pa.int64()), "start": pa.array(begins + r["start"], pa.int64()),
                    "ids": pa.array([raw[4 * a:4 * z] for a, z in zip(begins, ends)], pa.binary())})
    return (blocks.join(starts, ["part", "block"])
            .select("part", "block", "n", "doc_ids", "lengths", "lanes", "every", "words", "states", "offsets", "crc32", "start")
            .mapInArrow(unpack, "doc_id long, start long, ids binary"))


def token_digest(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to token files in the shared checkpoint folder, read
    them back and give ``doc_id, start, n_tokens, ids_crc32`` per document."""
    folder = scratch_dir(docs.sparkSession, "token-files")
    write_token_files(docs, folder)
    return read_token_files(docs.sparkSession, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
