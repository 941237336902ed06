import random

import numpy as np
import pytest

from llm.conftest import prose
from quarterwise.llm import decontamination as dc


def brute_tiles(item, text, least):
    """Longest free common run again and again, each found by looking everywhere."""
    free_i, free_t, lengths = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n] and free_i[i + n] and free_t[t + n]:
                    n += 1
                best = max(best, (n, -i, -t))
        if best[0] < least:
            return sorted(lengths)
        n, i, t = best[0], -best[1], -best[2]
        free_i[i : i + n] = free_t[t : t + n] = [False] * n
        lengths.append(n)


def test_tiling_is_greedy():
    for seed in range(40):
        draw = random.Random(seed)
        item = [draw.randrange(6) for _ in range(draw.randrange(1, 40))]
        text = [draw.randrange(6) for _ in range(draw.randrange(1, 60))]
        found = dc.tiles(np.array(item, np.uint64), np.array(text, np.uint64), 3)
        assert all(item[i : i + n] == text[t : t + n] for n, i, t in found)
        assert [n for n, _, _ in found] == sorted((n for n, _, _ in found), reverse=True)
        assert max((n for n, _, _ in found), default=0) == max(brute_tiles(item, text, 3), default=0)
        taken = [k for n, i, _ in found for k in range(i, i + n)]
        assert len(taken) == len(set(taken))


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(k, prose(24 + k, 900 + k)) for k in range(6)] + [(50, prose(24, 900)), (60, "too short an item"), (70, None), (None, prose(30, 990))]
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_whole_reordered_and_partial_passages(docs_of, benchmark):
    item = prose(25, 901).split()
    halves = " ".join(item[12:] + prose(9, 5).split() + item[:12])
    texts = {
        1: f"{prose(200, 1)} {' '.join(item)} {prose(100, 2)}",
        2: f"{prose(50, 3)} {halves}",
        3: f"{prose(50, 4)} {' '.join(item[:8])} {prose(40, 6)}",
        4: prose(300, 7),
        5: " ".join(w.upper() + "!," for w in item),
        6: "too short an item",
        7: "",
        8: None,
        9: prose(24, 900),
        10: prose(30, 990),
    }
    rows = {r.doc_id: r for r in dc.contaminated(docs_of(list(texts.items())), benchmark).collect()}
    assert {k for k, r in rows.items() if r.contaminated} == {1, 2, 5, 9, 10}
    assert rows[1].item_id == 1 and rows[1].coverage == rows[2].coverage == 1.0
    assert 0 < rows[3].coverage < 0.5
    assert rows[9].item_id == 0 and rows[10].item_id is None
    assert (rows[4].coverage, rows[4].item_id, rows[8].coverage) == (0.0, None, 0.0)
    kept = {r.doc_id for r in dc.without_contaminated(docs_of(list(texts.items())), benchmark).collect()}
    assert kept == {3, 4, 6, 7, 8}


def test_stretches_end_with_their_text(docs_of, spark):
    words = prose(20, 8).split()
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    docs = docs_of([" ".join(words[:10]), " ".join(words[10:]), " ".join(words)])
    got = {r.doc_id: r.coverage for r in dc.contaminated(docs, benchmark).collect()}
    assert got == {0: 0.5, 1: 0.5, 2: 1.0}


def test_messy_and_empty(messy, no_docs, benchmark, spark):
    assert dc.contaminated(messy, benchmark).count() == messy.count()
    kept = dc.without_contaminated(messy, benchmark)
    assert kept.columns == messy.columns and kept.count() == messy.count()
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert dc.without_contaminated(messy, nothing).count() == messy.count()
    assert dc.contaminated(no_docs, benchmark).count() == dc.without_contaminated(no_docs, nothing).count() == 0


def test_given_tables_against_plain_matching(spark, small):
    import re

    docs, items = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    plain = [" ".join(words(r.text)) for r in items.collect()]
    whole = {r.doc_id for r in docs.collect() if any(f" {p} " in f" {' '.join(words(r.text))} " for p in plain)}
    got = {r.doc_id for r in dc.contaminated(docs, items).where("coverage = 1").collect()}
    assert got == whole and whole
