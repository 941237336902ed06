from collections import Counter

import pytest

from llm.conftest import prose
from quarterwise.llm import mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        target |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3 * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.fixture(scope="module")
def docs(docs_of):
    rows = [(k, prose(5 + 37 * k % 300, k), s) for k, s in enumerate(["big"] * 60 + ["mid"] * 9 + ["tiny"] + [None] * 4 + ["zz"] * 3)]
    return docs_of([*rows, (900, "", "void"), (901, None, "void"), (902, prose(40_000, 9), "big")])


def test_targets_are_met_to_the_word(docs):
    rows = mixing.mixed(docs, block=64).selectExpr("row.source", "row.text", "size", "source_size", "target", "taken").collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len((r.text or "").split()) and r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    expected = brute_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - expected[s]) <= 0.5 for s in sizes)
    again = mixing.mixed(docs.repartition(7), block=64).selectExpr("row.doc_id", "taken").collect()
    assert sorted(again) == sorted(mixing.mixed(docs, block=64).selectExpr("row.doc_id", "taken").collect())


def test_schedule_spreads_every_source_evenly(docs):
    sized = mixing._sized(docs, "doc_id", "text", "source")
    sources = mixing.targets(sized.select("source", "size"))
    slots = mixing.schedule(sources, 16).orderBy("slot").collect()
    total = Counter(r.number for r in slots)
    seen = Counter()
    for k, r in enumerate(slots, 1):
        seen[r.number] += 1
        assert all(abs(seen[s] - k * total[s] / len(slots)) < 6 for s in total)
    assert all(sorted(r["rank"] for r in slots if r.number == s) == list(range(n)) for s, n in total.items())


def test_pieces_are_the_taken_words(docs):
    pieces = Counter()
    for r in mixing.mixed_pieces(docs, block=64).collect():
        assert r["from"] >= 0 and r.words > 0
        pieces[r.doc_id] += r.words
    taken = {r.doc_id: r.taken for r in mixing.mixed(docs, block=64).selectExpr("row.doc_id", "taken").collect() if r.taken}
    assert pieces == taken


def test_messy_rows_and_no_rows(messy, no_docs):
    out = mixing.mixed_documents(messy)
    assert out.columns == [*messy.columns, "mix_size", "mix_target", "_mix_taken"]
    rows = out.collect()
    assert len(rows) == messy.count() and {r.mix_taken for r in rows} == {"kept"}
    assert all(r["_mix_taken"] == 0 for r in rows if not (r.text or "").strip())
    assert mixing.mixed_documents(no_docs).count() == 0


def test_all_sizes_zero(docs_of):
    rows = mixing.mixed(docs_of(["", None, " "])).collect()
    assert [(r.target, r.taken) for r in rows] == [(0.0, 0)] * 3


def test_texts_are_read_for_their_sizes_once_and_for_the_rows_once(spark, docs):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = mixing.mixed(docs.mapInArrow(counted, docs.schema), block=64).collect()
    assert read.value == 2 * len(rows)
