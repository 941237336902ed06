import hashlib
import re

import pytest

from llm.conftest import prose
from quarterwise.llm import pii, queries

# the base patterns as the contract writes them
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [(a, b, k) for a, _, b, k in sorted(found)]


CASES = [
    "mail a.b+c@x-y.example.com, or a@b.c..d@e.f and .x@y.z. q@r", "a@b.com_x@c.org", "a@b", "@b.c", "x@.a.b y@a..b", "é@a.b ñ1@q.de",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0255.9 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1111 4111  1111 1111 1111", "5500-0000-0000-0004-", "1 2 3 4 5 6 7 8 9 0 1 2 3",
    "+1 (212) 555-0100 +49.30.1234567 +12345678 ++1234567890 +1234567890123456 +1", "😀 +1 212 555 0100 😀 a@b.co 😀", "", None, " ", "0" * 12, "79927398713 000000000000000000",
]


def spans_of(df):
    return {r.row.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in df.collect()}


def test_base_spans_against_the_plain_patterns(docs_of):
    import random

    draw = random.Random(7)
    noise = ["".join(draw.choice("ab1 .@-+()_9\n") for _ in range(200)) for _ in range(60)]
    texts = [*CASES, *noise, prose(20_000, 1) + " end@of.text"]
    got = spans_of(pii.spans(docs_of(texts)))
    for k, t in enumerate(texts):
        assert [s for s in got[k] if not s[2].startswith(pii.FOUND)] == brute(t), t


def test_contexts_discover_unseen_identifiers(docs_of):
    rows = [f"{prose(20, k)} mailbox user{k}@host{k}.example.com {prose(10, k + 50)}" for k in range(20)]
    rows += [f"{prose(9, 100)} mailbox: user77 at host {prose(5, 101)}", f"{prose(9, 102)} other user78 at host", f"mailbox nothing {prose(5, 7)}"]
    got = spans_of(pii.spans(docs_of(rows)))
    a = rows[20].index("user77")
    assert got[20] == [(a, a + 6, "context_email")] and got[21] == [] and got[22] == []
    assert all(len(got[k]) == 1 for k in range(20))


def test_messy_rows(messy, no_docs):
    rows = pii.spans(messy).selectExpr("row.text", "row.spans as own", "spans").collect()
    assert len(rows) == messy.count() and {r.own for r in rows} == {"kept"}
    for r in rows:
        assert [(s.start, s.end, s.kind) for s in r.spans if not s.kind.startswith(pii.FOUND)] == brute(r.text)
    assert pii.spans(no_docs).count() == 0


def test_query_and_no_python(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    df = queries.QUERIES["op3_personal_data"](spark, small)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    for r in df.collect():
        base = brute(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x == k for _, _, x in base) for k in pii.KINDS]


@pytest.mark.parametrize("digits", ["79927398713", "0", "4111111111111111", "4111111111111112"])
def test_luhn(spark, digits):
    from pyspark.sql import functions as F

    assert spark.range(1).select(pii._luhn(F.lit(digits))).first()[0] == luhn(digits)
