import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from labelweave.llm import encoders, packing
from labelweave.llm.queries import QUERIES

from .conftest import edge_rows

ODD = ["", " ", "a  b", " lead", "trail  ", "\n\n x\t\ty", "Don't WE'LL 's", "1234 5,678.9", "日本語 😀é", "a b 　c", "x\r\n y",
       "<|endoftext|> in text", "-" * 300, "Abc" * 200, "\x1c a\x1fb", "ΣΟΦΟΣ İstanbul straße ﬁ Å ẛ̣", "é ́x", "x\x85y\xa0z"]


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.default_tokenizer())


def by_column(e, texts):
    ids, ends = e.encode_column(pa.array(texts, pa.string()))
    return [ids[a:z].tolist() for a, z in zip(ends[:-1], ends[1:])]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_library_s(name, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer
    monkeypatch.setattr(encoders, "MEMO_ENTRIES", 50)  # generations turn over
    path, rng = public_tokenizers.path(name), random.Random(3)
    texts = ODD + [None] + [t for _, t, *_ in edge_rows() if t] + [
        "".join(rng.choice(" \n\tAb'é.1Σς\x1ćS😀²\x85") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    t = Tokenizer.from_file(path)
    want = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    e = (encoders.WordEncoder if name.startswith("word") else encoders.ByteEncoder)(path)
    assert type(encoders.encoder(path)) is type(e)
    assert by_column(e, texts) == want == by_column(e, texts)
    assert [np.frombuffer(e.encode(x), e.kind).tolist() for x in texts] == want


def test_files_of_other_settings_go_to_the_library_whole(tmp_path):
    import json
    with open(packing.default_tokenizer(), encoding="utf-8") as f:
        held = json.load(f)
    held["normalizer"] = {"type": "Sequence", "normalizers": held["normalizer"]["normalizers"][:2]}  # case stays
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(held, f)
    assert encoders.is_word_end(packing.default_tokenizer()) and not encoders.is_word_end(path)
    assert type(encoders.encoder(path)) is encoders.WholeEncoder
    want = encoders.encoder(path).whole.encode("Some Text", add_special_tokens=False).ids
    assert by_column(encoders.encoder(path), ["Some Text"]) == [want]


@pytest.mark.parametrize("seed", range(8))
def test_every_token_once_and_every_window_full(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, rng.randint(1, 300), rng.randint(1, 2500), rng.choice([256, 512, 1024, 2048, 2049, 9000])])
               for _ in range(rng.choice([0, 1, 3, 400]))]
    sequences = packing.pack(lengths)
    seen = defaultdict(list)
    for context, pieces in sequences:
        assert sum(n for _, _, n in pieces) == context <= 2048 and context & context - 1 == 0
        for doc, start, n in pieces:
            assert n > 0
            seen[doc] += range(start, start + n)
    assert all(sorted(seen[i]) == list(range(n)) for i, n in enumerate(lengths))
    # sequences shorter than the tiers: the binary digits of what is left at the end
    short = [c for c, _ in sequences if c < 256]
    assert len(short) == len(set(short))


def test_documents_stay_whole_where_they_fit():
    lengths = [1500, 548, 700, 324, 300, 212, 100, 156]
    assert {tuple(sorted(n for _, _, n in p)) for _, p in packing.pack(lengths)} == {(548, 1500), (324, 700), (212, 300), (100, 156)}


def test_step_groups_are_balanced():
    rng = random.Random(4)
    sequences = packing.pack([rng.randint(1, 4000) for _ in range(3000)])
    groups = packing.step_groups(sequences)
    tokens, cost = Counter(), Counter()
    for (context, pieces), g in zip(sequences, groups):
        tokens[g] += context
        cost[g] += sum(n * n for _, _, n in pieces)
    assert len(tokens) == round(sum(c for c, _ in sequences) / packing.STEP_TOKENS)
    assert max(tokens.values()) - min(tokens.values()) <= 2048
    assert max(cost.values()) <= 1.05 * min(cost.values())


@pytest.mark.parametrize("bucket", [1 << 21, 3000])
def test_pieces_hold_the_ids_of_every_row(edge, bucket):
    t = library()
    got = packing.pack_documents(edge, bucket_tokens=bucket).collect()
    want = Counter((d, tuple(t.encode(x or "", add_special_tokens=False).ids) + (1,)) for d, x, *_ in edge_rows())
    sequences, steps = defaultdict(list), defaultdict(set)
    for r in got:
        sequences[r.sequence_id].append(r)
        steps[r.sequence_id].add(r.step_group)
        assert len(r.ids) == 4 * r.length
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == rows[0].context <= 2048 and at & at - 1 == 0 and len({r.context for r in rows}) == 1
    assert all(len(s) == 1 for s in steps.values())
    # documents from their pieces (rows that repeat an id are told apart by what they hold)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append(r)
    found = Counter()
    for (d, n), rows in pieces.items():
        copies = sum(r.start == 0 for r in rows)
        ids = {}
        for r in rows:
            for i, x in enumerate(np.frombuffer(r.ids, "<u4").tolist()):
                assert ids.setdefault(r.start + i, x) == x or copies > 1
        assert sum(r.length for r in rows) == copies * n
        if copies == 1:
            found[d, tuple(ids[i] for i in range(n))] += 1
    assert all(want[k] == 1 for k in found) and len(found) >= len(want) - 3


def test_query_and_empty_table(spark, sf_small, empty):
    rows = QUERIES["op13_packing"](spark, sf_small).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    t = library()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows[:500]:
        ids = np.array(t.encode(docs[r.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert packing.pack_documents(empty).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(empty, tiers=(1000, 500))
