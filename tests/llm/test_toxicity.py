import random

import numpy as np
import pytest

from llm.conftest import prose
from quarterwise.llm import toxicity as tox

BAD = ["zorgle", "flimwit", "grubnak"]


@pytest.fixture(scope="module")
def labelled(docs_of, spark):
    draw = random.Random(4)
    rows, labels = [], []
    for k in range(400):
        words = prose(draw.randrange(40, 200), k).split()
        toxic = k % 4 == 0
        if toxic:
            for _ in range(max(3, len(words) // 30)):
                words.insert(draw.randrange(len(words)), draw.choice(BAD))
        elif k % 32 == 1:
            words.insert(5, "prefix grubnak beetle")  # a harmless phrase with a bad word
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_folding():
    assert tox.fold("1D10T, ｉｄｉｏｔ! іdіо​t") == " idiot  idiot  idiot "
    assert tox.fold("l1ne") == tox.fold("LINE") == " iine "
    assert tox.fold(None) == tox.fold("") == "  "


def test_hits_follow_the_entries_as_plain_search_finds_them():
    entries = {" idiot ": 5.0, " grub": 2.0}
    automaton = tox._automaton(entries, (" grub beetle ",))
    for text in ["idiot", "an idiot is here grubs", "grub beetle", "the grub beetle and a grub", "idiots", "xgrub", "idiot idiot"]:
        folded = tox.fold(text)
        plain = [(e, a, a + len(e)) for e in entries for a in range(len(folded)) if folded.startswith(e, a)]
        if " grub beetle " in folded:
            a = folded.index(" grub beetle ")
            plain = [h for h in plain if not (a <= h[1] and h[2] <= a + 13)]
        assert sorted(tox.hits(automaton, folded)) == sorted(plain)


def test_learned_lexicon_and_held_out_accuracy(labelled):
    docs, labels = labelled
    held = {r.doc_id for r in labels.where(tox.held_out(labels.doc_id)).collect()}
    model = tox._model(docs, tox.fold_of_labels(labels), "doc_id", "text", "toxic", ())
    assert {e.strip() for e in model.entries} <= {tox.fold(b).strip() for b in BAD}
    assert " prefix grubnak " in model.exceptions
    truth = dict(labels.collect())
    scored = {r.doc_id: r.score for r in tox.scores(docs, tox.fold_of_labels(labels)).selectExpr("row.doc_id", "score").collect()}
    wrong = [i for i in held if (scored[i] >= tox.REJECT) != truth[i]]
    assert len(held) > 80 and len(wrong) <= 0.03 * len(held)


def test_disguised_words_and_given_exceptions(labelled, docs_of, spark):
    docs, labels = labelled
    more = docs.unionByName(docs_of([(9000, "fl1mw1t ZORGLE zоrglе " * 3), (9001, "the flimwit museum " * 9)]))
    scored = {r.doc_id: r.score for r in tox.scores(more, labels, exceptions=["flimwit museum"]).selectExpr("row.doc_id", "score").where("doc_id >= 9000").collect()}
    assert scored[9000] >= tox.REJECT > scored[9001]


def test_messy_and_empty(messy, no_docs, labelled, spark):
    docs, labels = labelled
    odd = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (1, 0), (1, 1)], "doc_id bigint, toxic int"))
    out = tox.scores(messy, odd)
    rows = out.select("row.*", out["score"].alias("s")).collect()
    assert len(rows) == messy.count() and all(0 <= r.s <= 1 for r in rows) and {r.score for r in rows} == {"kept"}
    assert tox.scores(no_docs, labels).count() == 0
    none = tox.scores(docs, labels.limit(0)).selectExpr("max(score)").first()[0]
    only_clean = tox.scores(docs, labels.where("toxic = 0")).selectExpr("max(score)").first()[0]
    assert none < 0.01 and only_clean < 0.01


def test_curve_never_falls_with_weight():
    draw = np.random.default_rng(0)
    x = draw.uniform(0, 3, (500, 2))
    _, b, c = tox._fit(x, (x[:, 0] + draw.normal(0, 0.3, 500) < 1).astype(float))
    assert b >= 0 and c >= 0


def test_no_entry_or_exception_is_cut_by_rank(labelled, monkeypatch):
    """Whatever cap the module had before: with one of 1, only the most frequent would stay."""
    monkeypatch.setattr(tox, "MOST_ENTRIES", 1, raising=False)
    docs, labels = labelled
    model = tox._model(docs, labels, "doc_id", "text", "toxic", ())
    assert {e.strip() for e in model.entries} == {tox.fold(b).strip() for b in BAD}
    assert len(model.exceptions) > 1
