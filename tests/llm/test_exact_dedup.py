import hashlib
from collections import defaultdict

import numpy as np
import pytest

from llm.conftest import prose
from quarterwise.llm import exact_dedup
from quarterwise.llm.text import LOWER


def normalised(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normalised(t)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("bits", [64, 3])
def test_copies_with_true_and_with_clashing_fingerprints(docs_of, bits):
    long_text = prose(5000, 3)
    texts = [prose(30, 1), prose(30, 1).upper(), long_text, long_text + " end", long_text, prose(3000, 4), prose(3000, 5), "É", "é", "", None, " "]
    docs = docs_of(texts)
    assert result(exact_dedup.copies(docs, bits=bits)) == brute(list(enumerate(texts)))
    kept = {r.doc_id for r in exact_dedup.without_copies(docs, bits=bits).collect()}
    assert kept == {i for i, _, _, k, _ in brute(list(enumerate(texts))) if k}


def test_messy_rows(messy):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    assert result(exact_dedup.copies(messy)) == brute(rows)
    kept = exact_dedup.without_copies(messy)
    assert kept.columns == messy.columns
    out = kept.select("doc_id", "text", "recipe").collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(["2", "None", "4", "5", "6", "7", "8", "9"])
    assert {r.recipe for r in out} == {"kept"}


def test_rows_written_twice_stay_once(docs_of):
    docs = docs_of([(5, "same"), (5, "same"), (4, "same"), (1, "other")])
    assert sorted(r.doc_id for r in exact_dedup.without_copies(docs).collect()) == [1, 5]
    assert [r.kept for r in exact_dedup.copies(docs).where("doc_id = 5").collect()] == [True, True]


def test_no_rows(no_docs):
    assert exact_dedup.copies(no_docs).count() == 0
    assert exact_dedup.without_copies(no_docs).count() == 0


def test_chunks_depend_on_content_only():
    a, b = prose(4000, 1).encode(), prose(7, 2).encode()
    data = np.frombuffer(a + b + a, np.uint8)
    ends, first = exact_dedup._cuts(LOWER[data], np.array([0, len(a), len(a) + len(b), len(data)]))
    one, three = ends[first[0] : first[1]], ends[first[2] : first[3]] - len(a) - len(b)
    assert one.tolist() == three.tolist() and one[-1] == len(a) and len(one) > 5
    assert np.diff(one).max() <= exact_dedup.MOST_BYTES


def test_dictionary_tells_contents_apart(docs_of):
    docs = docs_of([prose(3000, 1), prose(3000, 1), prose(3000, 2)])
    rows = exact_dedup.chunk_dictionary(docs, bits=2).collect()
    assert len({r.content for r in rows}) == len({(r.fingerprint, r.variant) for r in rows}) == len(rows)
    assert b"".join(r.content for r in exact_dedup.chunk_dictionary(docs).collect())
