import random

import numpy as np
import pytest

from quarterwise.llm import language_id as lid

SOUNDS = {"aa": "ka lo mi tu re", "bb": "sch ung ver keit zu", "cc": "éau oui tré çon là", "дд": "про сти мо на лё"}


@pytest.fixture(scope="module")
def samples(spark):
    draw, rows = random.Random(1), []
    for k in range(200):
        lang = list(SOUNDS)[k % 4]
        text = " ".join("".join(draw.choices(SOUNDS[lang].split(), k=draw.randrange(1, 4))) for _ in range(draw.randrange(3, 60)))
        rows.append((k, text, lang))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def brute_grams(text):
    raw = b" " + text.lower().encode() + b" " if text else b""
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(len(raw) - 3)]


def test_grams_stay_inside_their_text():
    texts = ["", "ab", "A", "straße ö", "", "x"]
    raw = [t.lower().encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    grams, first = lid._grams(np.frombuffer(b"".join(raw), np.uint8), offsets)
    got = [grams[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got[1] == brute_grams("ab") and got[3] == brute_grams("straße ö") and got[0] == got[4] == []
    assert len(got[2]) <= 1 and len(got[5]) <= 1


def test_held_out_accuracy_and_filter_against_sets(samples):
    model = lid.learn(samples.where("doc_id % 5 <> 0").select("text", "lang"))
    rows = lid.identify(samples.where("doc_id % 5 = 0"), model).selectExpr("row.lang", "lang_pred", "score").collect()
    assert all(r.lang == r.lang_pred and 0 < r.score <= 1 for r in rows) and len(rows) == 40
    # every gram that is frequent in a language has its bit: a Bloom filter misses none
    for lang in SOUNDS:
        bit = np.uint64(model.langs.index(lang))
        texts = [r.text for r in samples.where(f"lang = '{lang}' and doc_id % 5 <> 0").collect()]
        counts = {}
        for t in texts:
            for g in brute_grams(t):
                counts[g] = counts.get(g, 0) + 1
        top = np.array(sorted(counts, key=counts.get)[-10:], np.uint64)
        for k in range(lid.HASHES):
            assert (model.slots[0][lid._slots(top, k)] >> bit & np.uint64(1)).all()


def test_more_than_64_languages(spark):
    names = [f"l{k:03d}" for k in range(70)]
    rows = spark.createDataFrame([(f"{n} {n}{n} q{n}" * 3, n) for n in names], "text string, lang string")
    model = lid.learn(rows)
    assert model.slots.shape[0] == 2
    got = lid.identify(rows, model).selectExpr("row.lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 68


def test_messy_and_empty(messy, no_docs, samples):
    model = lid.learn(samples.select("text", "lang"))
    out = lid.identify(messy, model)
    rows = {r.t: r for r in out.selectExpr("row.text as t", "row.lang_pred as own", "lang_pred", "score").collect()}
    assert rows[None].lang_pred == rows[""].lang_pred == rows[" \n\t "].lang_pred == "und"
    assert all(r.own == "kept" and (r.lang_pred == "und") == (r.score == 0 and not any(c.isalpha() for c in t or "")) for t, r in rows.items())
    assert lid.identify(no_docs, model).count() == 0
    nothing = lid.learn(samples.limit(0).select("text", "lang"))
    assert {r.lang_pred for r in lid.identify(samples, nothing).collect()} == {"und"}
    assert {r.lang_pred for r in lid.identify(samples, lid.learn(samples.selectExpr("text", "cast(null as string) as lang"))).collect()} == {"und"}
