import random
import zlib

import numpy as np
import pytest

from labelweave.llm import pieces, tokenfile
from labelweave.session import scratch_dir

from .conftest import edge_rows, prose

ODD = ["", " ", "   ", "a  b", "a   b \n c", " lead", "trail ", "trail   ", "\n\n x\t\ty", "don't we'll", "1234 5,678.9", "日本語 😀é",
       "a b 　c", "tab\t word", "x\r\n y", "<|endoftext|> in text", "-" * 300, "abc" * 200, "\x1c a", "▁under ▁ x"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    return ODD + [t for _, t, *_ in edge_rows() if t and len(t) < 60_000] + [
        "".join(rng.choice(" \n\tab'é.1") for _ in range(80)) for _ in range(300)]


def test_ids_are_the_library_s(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenfile.default_tokenizer())
    e = tokenfile.Encoder(tokenfile.default_tokenizer())
    for x in texts:
        want = t.encode(x, add_special_tokens=False).ids
        assert np.frombuffer(e.encode(x), "<u4").tolist() == want == np.frombuffer(e.encode(x), "<u4").tolist(), x


@pytest.mark.parametrize("n,lanes,every", [(0, 8, 4), (1, 8, 4), (7, 8, 2), (8, 8, 1), (1000, 16, 8), (4097, 64, 5)])
def test_coder_round_trip_and_checkpoints(n, lanes, every):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.3, n) % 700
    coder = tokenfile.Coder(tokenfile.frequencies(np.bincount(ids, minlength=701) if n else np.array([1])))
    words, states, offsets = coder.encode(ids, lanes, every)
    assert np.array_equal(coder.decode(n, words, states, offsets, every), ids)
    for c in range(len(states)):
        part = coder.decode(n, words, states, offsets, every, first=c, last=c + 1)
        k = states.shape[1] * every
        assert np.array_equal(part, ids[c * k:(c + 1) * k])


def test_frequencies_cover_every_id():
    counts = np.array([0, 1, 10**9, 3, 0, 5])
    f = tokenfile.frequencies(counts)
    assert f.sum() == 1 << tokenfile.SCALE_BITS and ((f > 0) == (counts > 0)).all()
    many = tokenfile.frequencies(np.ones(100_000, np.int64))
    assert many.sum() == 1 << tokenfile.SCALE_BITS and many.min() >= 1
    with pytest.raises(ValueError):
        tokenfile.frequencies(np.ones(10), bits=3)


def test_files_round_trip(spark, edge, empty):
    e = tokenfile.Encoder(tokenfile.default_tokenizer())
    folder = scratch_dir(spark, "test-tokens")
    tokenfile.write_token_files(edge, folder, block_tokens=500, lanes=32, every=4)
    got = [(r.doc_id, r.start, bytes(r.ids)) for r in tokenfile.read_token_files(spark, folder).collect()]
    got.sort(key=lambda r: r[1])
    end = np.array([tokenfile.END_ID], "<u4").tobytes()
    assert sorted((str(d), x) for d, _, x in got) == sorted((str(d), e.encode(t) + end) for d, t, *_ in edge_rows())
    keys = [(d is not None, d or 0) for d, _, _ in got]
    assert keys == sorted(keys)
    at = 0
    for _, start, x in got:
        assert start == at
        at += len(x) // 4
    assert tokenfile.token_digest(empty).collect() == []
    row = tokenfile.token_digest(edge).filter("doc_id = 201").first()
    assert row.n_tokens == 1 and row.ids_crc32 == zlib.crc32(end)


def test_damaged_block_raises(spark, edge):
    folder = scratch_dir(spark, "test-tokens")
    tokenfile.write_token_files(edge.limit(20), folder)
    blocks = spark.read.parquet(f"{folder}/blocks").withColumnRenamed("crc32", "old").selectExpr("*", "old + 1 as crc32").drop("old")
    bad = scratch_dir(spark, "test-tokens")
    blocks.write.parquet(f"{bad}/blocks")
    spark.read.parquet(f"{folder}/frequencies").write.parquet(f"{bad}/frequencies")
    with pytest.raises(Exception, match="damaged"):
        tokenfile.read_token_files(spark, bad).collect()


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.default_model())


def best_total(m, text):
    """Best sum of scores over the whole text at once, without windows."""
    s = " " + text
    s = s.replace(pieces.MARK, "\0").replace(" ", pieces.MARK)
    best = [0.0] + [float("-inf")] * len(s)
    for i in range(len(s)):
        single = False
        for k in range(i + 1, min(len(s), i + m.longest) + 1):
            hit = m.table.get(s[i:k])
            if hit:
                single |= k == i + 1
                best[k] = max(best[k], best[i] + hit[1])
        if not single:
            best[i + 1] = max(best[i + 1], best[i] + m.unknown)
    return best[-1]


def total(m, ids):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    out, raw = 0.0, b""
    for i in ids.tolist():
        if sp.is_byte(i):
            raw += m.surface[i]
            try:
                raw.decode()
                out, raw = out + m.unknown, b""
            except UnicodeDecodeError:
                pass
        else:
            out += sp.get_score(i)
    return out


def test_pieces_are_the_best_path_and_round_trip(model, texts):
    for t in texts:
        ids = model.encode(t)
        assert model.decode(ids) == t
        if t:
            assert total(model, ids) == pytest.approx(best_total(model, t))


def test_window_stays_bounded(model):
    fresh = pieces.PieceModel(pieces.default_model())
    for t in ("theththe" * 2_000, "=-" * 10_000, "qzx7" * 5_000):
        assert fresh.decode(fresh.encode(t)) == t
        assert total(fresh, fresh.encode(t)) == pytest.approx(best_total(fresh, t))
    assert fresh.window < 12 * fresh.longest
    t = "a" * 20_001  # paths of different remainders meet only at the end
    assert fresh.decode(fresh.encode(t)) == t


def test_encode_documents(spark, edge, empty, model):
    got = pieces.encode_documents(edge).collect()
    assert len(got) == len(edge_rows()) and all(r.round_trip for r in got)
    want = sorted((str(d), model.encode(t).tolist()) for d, t, *_ in edge_rows())
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == want
    assert all(r.n_ids == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<i4").tobytes()) for r in got)
    assert pieces.encode_documents(empty).collect() == []
    back = edge.select("text", pieces.decode_ids()(pieces.encode_ids()("text")["ids"]).alias("again")).collect()
    assert all(r.again == (r.text or "") for r in back)


def test_prose_is_remembered_by_stretch(model):
    t = prose(random.Random(1), "en", 500)
    first = model.encode(t)
    assert np.array_equal(first, model.encode(t)) and len(model.memo) <= pieces.MEMO_ENTRIES
