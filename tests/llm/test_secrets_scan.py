import hashlib
import random

import zstandard

from llm.conftest import prose
from quarterwise.llm import queries, secrets_scan
from quarterwise.llm.secrets_scan import base_spans


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def test_base_spans_by_hand():
    assert joined(base_spans('x PassWord = "abc123" y')) == "assign:2:20"
    assert base_spans("password = abc") == [] and base_spans("paſſword=abcdef") == []
    assert joined(base_spans("API-KEY=abcdefg apikey: zzzzzz api_key:'q1w2e3'")) == "assign:16:30,assign:31:46"
    assert joined(base_spans("AKIA" + "A" * 16 + " AKIAXX")) == "access:0:20"
    assert joined(base_spans("é token:" + "a" * 24)) == "assign:2:32,hex:8:32"


def test_whole_texts_are_scanned(spark, small, docs_of, messy):
    draw = random.Random(2)
    hexes = "".join(draw.choice("0123456789abcdef") for _ in range(40))
    texts = [
        prose(30_000, 1) + f" secret: {hexes}", "ab" * 12, "ab" * 11, "f" * 23, "f" * 30, "", None, "AKIA" * 9, "akia" * 9,
        "é" * 50 + " token = 'zzzzzzz'", "tokentoken=======abcdefg", "a" * 12, "b" * 12,
    ]
    rows = {r.row.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in secrets_scan.spans(docs_of(texts)).collect()}
    for k, t in enumerate(texts):
        assert [s for s in rows[k] if s[2] != "novel"] == base_spans(t or "")
    found = secrets_scan.spans(messy)
    assert found.count() == messy.count() and found.select("row.spans").first()[0] == "kept"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.QUERIES["op4_secrets"](spark, small).collect():
        base = base_spans(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, _, k in base) for n in ("assign", "access", "hex"))


def test_random_strings_are_novel_and_names_are_not(docs_of):
    draw = random.Random(5)
    key = "".join(draw.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(32))
    names = "customer_account_id_2 " * 40
    texts = [names + f"auth header {key} end", names + "auth header customer_account_id_2 end", f"plain words and {key}", f"my private thing {key} and {key}"]
    rows = {r.row.doc_id: [(s.kind, s.secret) for s in r.spans] for r in secrets_scan.spans(docs_of(texts)).collect()}
    assert rows[0] == [("novel", key)] and rows[1] == [] and rows[2] == []


def test_marginal_bytes():
    packer = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(b"customer_account_id " * 3, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    draw = random.Random(1)
    noise = "".join(draw.choice("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(40))
    assert secrets_scan.novelty("customer_account_id", "key = ", ";", packer) < 0.4
    assert secrets_scan.novelty(noise, "key = ", ";", packer) > 0.7


def test_identifiers_count_all_texts(docs_of, no_docs):
    assert secrets_scan.identifiers(docs_of(["foo bar_1 foo " * 20, None, "foo 12 ab", "bar_1 q", "rare_one"])) == ["foo", "bar_1"]
    assert secrets_scan.spans(no_docs).count() == 0


def test_secrets_of_letters_only_are_measured(docs_of):
    """A repeated name and a word that the corpus uses are not novel."""
    word = "responsabilidades"
    texts = [
        "send it with bearer QxZkWvJpTrLmHsYd to the host", "the pwd is qxzkwvjptrlmhsydbgfc for now", "signature QXZKWVJPTRLMHSYD end",
        f"the private {word} of it", "AuthenticatorFactory " * 40 + "key AuthenticatorFactory", f"{word} " * 40,
    ]
    rows = {r.row.doc_id: [(s.kind, s.secret) for s in r.spans] for r in secrets_scan.spans(docs_of(texts)).collect()}
    assert [rows[k] for k in range(3)] == [[("novel", "QxZkWvJpTrLmHsYd")], [("novel", "qxzkwvjptrlmhsydbgfc")], [("novel", "QXZKWVJPTRLMHSYD")]]
    assert rows[3] == [] and rows[4] == []
