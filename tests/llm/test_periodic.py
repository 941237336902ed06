from __future__ import annotations

import hashlib
import random
import time
import tracemalloc
import zlib

import numpy as np
import pytest

from quarterwise.llm import periodic, queries
from quarterwise.llm.periodic import fragments, periodic_runs, smallest_factors, tiles_of
from tests.llm.conftest import prose


def brute(words):
    """(start, period, length) of all maximal runs, from every period in turn."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted((s, q, n) for (s, n), q in found.items())


def without(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_words(seed, n):
    draw, out = random.Random(seed), []
    while len(out) < n:
        unit = [draw.choice("ab" if draw.random() < 0.5 else "abcdefg") for _ in range(draw.choice([1, 1, 2, 3, 5, 8, 13, 30]))]
        out += (unit * draw.randrange(1, 9))[: -draw.randrange(len(unit)) or None]
    return out[:n]


def found(docs, **options):
    got = periodic_runs(docs, **options).select("row.doc_id", "runs", "collapsed").collect()
    return {r.doc_id: ([(x.start, x.period, x.length) for x in r.runs], r.collapsed) for r in got}


@pytest.mark.parametrize("tile", [1 << 15, 64, 16])
def test_runs_equal_brute_force_in_whole_and_cut_texts(docs_of, tile):
    texts = [periodic_words(s, n) for s, n in enumerate([0, 1, 5, 6, 7, 8, 16, 17, 31, 64, 65, 100, 200, 300, 500, 500, 700])]
    texts += [["a"] * 400, ["a", "b"] * 150 + ["c"] + ["a", "b"] * 150, (["x"] * 5 + ["y"]) * 40, prose(300, 1).split() * 5, prose(900, 2).split()]
    docs = docs_of([(i, "  \t".join(t)) for i, t in enumerate(texts)])
    got = found(docs, tile_words=tile)
    for i, t in enumerate(texts):
        runs = brute(t)
        assert got[i] == (runs, without(t, runs)), i


def test_random_short_texts_over_two_letters(docs_of):
    draw = random.Random(5)
    texts = [[draw.choice("ab") for _ in range(draw.randrange(40))] for _ in range(400)]
    got = found(docs_of([(i, " ".join(t)) for i, t in enumerate(texts)]))
    assert all(got[i][0] == brute(t) for i, t in enumerate(texts))


def test_messy_rows_copies_and_an_empty_table(messy, no_docs):
    out = periodic_runs(messy)
    assert out.select("row.*").columns == messy.columns and out.count() == messy.count()
    for r in out.collect():
        words = (r.row.text or "").encode().split()
        if len(words) < 1000:
            assert [(x.start, x.period, x.length) for x in r.runs] == brute(words)
        elif r.row.doc_id == 8:
            assert [(x.start, x.period, x.length) for x in r.runs] == [(1, 1, 20_000)] and len(r.collapsed.split()) == len(words) - 19_999
    assert found(no_docs) == {}


def test_copies_of_a_text_are_one_row_before_the_shuffle(spark, docs_of):
    found = spark.range(10_000).selectExpr("id div 100000 + 1 as a", "id div 100000 + 2 as b", "id div 100000 + 3 as period", "id % 2 * 9 as start", "id % 2 * 9 + 20 as stop")
    runs = periodic.stitched(found)
    assert [tuple(r) for r in runs.collect()] == [(1, 2, 3, 0, 29)]
    plan = runs._jdf.queryExecution().executedPlan().toString()
    # distinct rows are combined in front of the exchange that the window follows
    assert plan.index("Window") < plan.rindex("HashAggregate(keys=[a")


def test_tiles_cover_and_overlap_by_half():
    for n in (6, 63, 64, 65, 1000, 5000):
        octaves = set()
        by_octave = {}
        for low, high, start, stop in tiles_of(n, 64):
            octaves |= set(range(low, high + 1))
            by_octave.setdefault(low, []).append((start, stop))
        assert octaves == set(range((n // 4).bit_length()))
        for low, tiles in by_octave.items():
            assert tiles[0][0] == 0 and tiles[-1][1] == n
            assert all(b[0] < a[1] and a[1] - b[0] == max(64, 16 << low) // 2 for a, b in zip(tiles, tiles[1:]))


def test_long_repetitive_texts_are_near_linear_and_bounded():
    times = []
    for n in (100_000, 400_000):
        codes = np.tile(np.arange(7, dtype=np.uint64), n // 7 + 1)[:n]
        codes[: n // 2] = 1
        bounds, octave = np.array([0, n]), np.array([(n // 4).bit_length() - 1])
        tracemalloc.start()
        start = time.perf_counter()
        _, q, begin, end = fragments(codes, bounds, np.array([0]), octave)
        times.append(time.perf_counter() - start)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert set(zip(q.tolist(), begin.tolist(), end.tolist())) >= {(1, 0, n // 2)} and 7 in q
        assert peak < 200 * n + (100 << 20)
    assert times[1] < 10 * times[0] + 1


def test_smallest_factors():
    assert smallest_factors(12).tolist() == [0, 1, 2, 3, 2, 5, 2, 7, 2, 3, 2, 11, 2]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    words = [w.decode() for w in words]
    runs = brute(words)
    top = max(((n, -s, -q) for s, q, n in runs), default=None)
    first = (None,) * 4 if top is None else (-top[1], top[0], -top[2], 1000 * top[0] // -top[2])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *first, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(without(words, runs)))


def test_the_query_equals_brute_force_on_a_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in queries.op12(spark, small).collect()}
    assert len(got) == len(rows)
    some = [r for r in rows if len((r.text or "").split()) <= 1500]
    assert len(some) > 150 and all(got[r.doc_id] == expected(r.doc_id, r.text) for r in some)
    assert sum(got[r.doc_id][1] > 0 for r in some) >= 8
