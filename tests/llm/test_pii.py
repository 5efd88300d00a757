import hashlib
import re

import pytest

from labelweave.llm import pii

from .conftest import edge_rows

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((x if i % 2 == 0 else 2 * x - 9 * (x > 4)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def good(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")),
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def brute(text):
    found = sorted((m.start(), n, m.end(), k) for n, (k, rx) in enumerate(BASE.items())
                   for m in re.finditer(rx, text or "") if good(k, m.group()))
    return [f"{k}:{a}:{z}" for a, _, z, k in found]


TEXTS = [
    None, "", "no data", "a@b.c_d@e.f x@y", "é😀 mail: joe.o'x+1@host-1.example.org, second@x.io.", "a@b.c.d@e.f.g",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.01 1.2.3 1..2.3.4 9.9.9.9", "card 4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111111111111111 5500005555555559 0000000000000000", "+1 (555) 010-9999 call +4915112345678901234 +12", "+1+15550109999",
    "😀 +1 555 010 9999 😀 1.1.1.1 a@b.co", "1" * 30_000, "a" * 30_000 + "@", ("x@y.zz " * 300), "._%+-@a.b", "a@b.c-._@d.e.f",
    "iban GB82 WEST 1234 5698 7654 32 ok, GB83 WEST 1234 5698 7654 32 not", "ssn 123-45-6789; number 123-45-6780 elsewhere" + "-" * 60,
]


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, spans string")
    return {r.doc_id: r for r in pii.pii_digest(pii.find_pii(df)).collect()}


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_base_spans_match_the_plain_patterns(found, i):
    want = brute(TEXTS[i])
    assert found[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
    all_spans = found[i].spans.split(",") if found[i].spans else []
    assert [s for s in all_spans if s.split(":")[0] in BASE] == want
    for k in BASE:
        assert found[i][f"n_{k}"] == sum(s.startswith(k + ":") for s in want)


def test_checksums_and_context_decide_added_kinds(found):
    assert found[17].spans.count("iban:") == 1 and "iban:5:32" in found[17].spans
    assert "ssn:4:15" in found[18].spans


def test_words_behind_an_iban_are_not_part_of_it(spark):
    at, es, de = "AT61 1904 3002 3457 3201", "ES9121000418450200051332", "DE89 3704 0044 0532 0130 00"
    texts = [(f"IBAN {at} EUR 50", [at]), (f"IBAN {at.replace(' ', '')} EUR", [at.replace(" ", "")]), (f"iban {es} BBVA", [es]),
             (f"IBAN {at.replace(' ', '')} 2024", [at.replace(" ", "")]), (f"😀 {at} 2024 ABCD X1", [at]),
             (f"{at} {de} {es} {at}", [at, de, es, at]), (f"REF AB12 CDEF GHIJ {at} EUR", [at]), (f"{de} EUR", [de]),
             (f"{at}5", []), ("IBAN AT62 1904 3002 3457 3201 EUR 50", [])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc.doc_id: [(s.start, s.end, s.value) for s in r.spans if s.kind == "iban"] for r in pii.find_pii(df).collect()}
    for i, (t, want) in enumerate(texts):
        assert [v for _, _, v in got[i]] == want, t
        assert all(t[a:z] == v for a, z, v in got[i])


def test_context_is_what_makes_an_ssn(spark):
    df = spark.createDataFrame([(1, "123-45-6789"), (2, "social security 123-45-6789")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.pii_digest(pii.find_pii(df)).collect()}
    assert got == {1: "", 2: "ssn:16:27"}


def test_edge_rows_and_redaction(edge, empty, spark):
    assert pii.pii_digest(pii.find_pii(edge)).count() == len(edge_rows())
    assert pii.find_pii(empty).collect() == []
    df = spark.createDataFrame([(1, "write to a@b.co or +1 555 010 9999"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.redacted for r in pii.redact(pii.find_pii(df)).collect()}
    assert got == {1: "write to [EMAIL] or [PHONE]", 2: None}


def test_context_words_are_whole_words(spark):
    texts = ["078-05-1120 antisocialite", "078-05-1120 socialites", "078-05-1120 insecurity", "social: 078-05-1120", "SSNs 078-05-1120",
             "hotel +49 30 1234567", "tel. +49 30 1234567", "ship 10.1.2.3", "hosts 10.1.2.3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc.doc_id: [(s.kind, round(s.score, 2)) for s in r.spans] for r in pii.find_pii(df).collect()}
    assert [got[i] for i in range(3)] == [[], [], []] and got[3] == got[4] == [("ssn", 0.9)]
    assert got[5] == [("phone", 0.6)] and got[6] == [("phone", 0.9)] and got[7] == [("ip", 0.6)] and got[8] == [("ip", 0.9)]
