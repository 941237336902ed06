import math
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import prose
from quarterwise.llm import language_model as lm
from quarterwise.llm import queries
from quarterwise.llm.shared import Shipped


def test_forward_is_the_sum_over_all_paths():
    draw = np.random.default_rng(3)
    m = lm.Hmm(draw.dirichlet([1] * 3), draw.dirichlet([1] * 3, 3), draw.dirichlet([1] * 5, 3).T)
    seqs = [[0, 4, 2, 2], [1], [3, 3, 0, 1, 2, 4], []]
    first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    flat = np.array([x for s in seqs for x in s], np.int64)
    logs, _, _ = lm._forward(m, m.start, flat, first, keep=False)
    for seq, got in zip(seqs, logs, strict=True):
        total = 0.0
        for path in product(range(3), repeat=len(seq)):
            p = 1.0
            for t, (s, x) in enumerate(zip(path, seq, strict=True)):
                p *= (m.start[s] if t == 0 else m.move[path[t - 1], s]) * m.emit[x, s]
            total += p
        assert got == pytest.approx(math.log(total))


def test_expected_counts_are_those_of_all_paths():
    draw = np.random.default_rng(5)
    m = lm.Hmm(draw.dirichlet([1] * 2), draw.dirichlet([1] * 2, 2), draw.dirichlet([1] * 4, 2).T)
    seqs = [[0, 3, 1], [2, 2], [1, 0, 0, 3]]
    first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    _, move, emit = lm._expected(m, m.start, np.array(sum(seqs, [])), first)
    moves, emits = np.zeros((2, 2)), np.zeros((4, 2))
    for seq in seqs:
        paths = {}
        for path in product(range(2), repeat=len(seq)):
            p = 1.0
            for t, (s, x) in enumerate(zip(path, seq, strict=True)):
                p *= (m.start[s] if t == 0 else m.move[path[t - 1], s]) * m.emit[x, s]
            paths[path] = p
        for path, p in paths.items():
            p /= sum(paths.values())
            for t, (s, x) in enumerate(zip(path, seq, strict=True)):
                emits[x, s] += p
                if t:
                    moves[path[t - 1], s] += p
    assert np.allclose(move, moves) and np.allclose(emit, emits)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")), "\0end"]


def brute_base(train, texts):
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, [(len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for t in texts]


@pytest.mark.parametrize("head", [lm.HEAD, 30])
def test_base_score_and_counts(docs_of, head):
    train = [prose(60, k) + f" rare{k % 3} Only{k}" for k in range(30)] + ["", None]
    texts = [*train[:4], "never seen words", "", None, "É é", " ", train[0].upper()]
    training = docs_of(train).select(F.xxhash64("doc_id").alias("place"), "text")
    rows = docs_of(texts).select(F.struct("doc_id").alias("row"), "text")
    got = {r.row.doc_id: r for r in lm.scores(rows, training, head, 20).collect()}
    n, expected = brute_base(train, texts)
    for k, (size, known, base) in enumerate(expected):
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (size, known, n)
        assert got[k].base_score == pytest.approx(base) and got[k].score < 0


def test_probabilities_of_one_word_texts_sum_to_one(docs_of):
    """All words and the end as the first token, and one unseen word for each class."""
    train = [prose(50, k) for k in range(10)]
    counts = lm.hash_counts(docs_of(train), 4)
    v = Shipped(counts.sparkSession, lm.vocabulary(counts, len(train), lm.HEAD, 10, 4))
    m = lm.train(docs_of(train).select(F.xxhash64("doc_id").alias("place"), "text"), v, rounds=1, warm_rounds=2)
    first = m.start @ m.emit.T
    assert first.sum() == pytest.approx(1)
    mass = {}
    for r in counts.collect():
        at = np.searchsorted(v.value.head, np.int64(r.word).view(np.uint64))
        symbol = int(v.value.symbol[at])
        mass[symbol] = mass.get(symbol, 0) + (1 if symbol <= 10 else (r.n + 0.5) / v.value.class_mass[symbol - 11])
    for symbol, p in mass.items():
        seen = p if symbol <= 10 else p + 0.5 / v.value.class_mass[symbol - 11]
        assert seen == pytest.approx(1)


def test_training_raises_likelihood(docs_of):
    train = docs_of([" ".join(["ka lo mi", "schu keit ver"][k % 2].split() * 20) for k in range(40)]).select(F.xxhash64("doc_id").alias("place"), "text")
    v = Shipped(train.sparkSession, lm.vocabulary(lm.hash_counts(train, lm.CLASSES), 40))
    m = lm.train(train, v, rounds=0, warm_rounds=0)
    logs = []
    for _ in range(6):
        log, m = lm._round(train, v, m)
        logs.append(log)
    assert logs[-1] > logs[0] + 100


def test_held_out_texts_gain_on_the_base(spark, small):
    rows = queries.QUERIES["op6_language_model"](spark, small).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert rows.s > rows.b


def test_messy_and_no_training(messy, no_docs):
    rows = messy.select(F.struct("doc_id", "size").alias("row"), "text")
    none = no_docs.select(F.xxhash64("doc_id").alias("place"), "text")
    out = lm.scores(rows, none).collect()
    assert len(out) == messy.count() and all(r.base_score == pytest.approx(0, abs=1e-6) and r.n_known == 0 and r.train_tokens == 0 and r.score < 1e-6 for r in out)
    out = lm.scores(rows, messy.select(F.xxhash64("doc_id").alias("place"), "text")).collect()
    assert len(out) == messy.count() and all(math.isfinite(r.score) and r.n_known == r.n_tokens for r in out)
    assert lm.scores(no_docs.select(F.struct("doc_id").alias("row"), "text"), none).count() == 0


def test_every_round_is_baum_welch_over_all_whole_texts(docs_of):
    """1,500 texts, a rare kind in 3 of them, one text long; against rounds by hand."""
    train = [prose(6, k) for k in range(1496)] + [prose(400, 1)] + ["zu zo zu zo"] * 3
    texts = docs_of(train).select(F.xxhash64("doc_id").alias("place"), "text")
    v = Shipped(texts.sparkSession, lm.vocabulary(lm.hash_counts(texts, 4), len(train), lm.HEAD, 20, 4))
    m = lm.train(texts, v, rounds=0, warm_rounds=0)
    seqs = []
    for t in train:
        raw = np.frombuffer(t.encode(), np.uint8)
        seqs.append(lm._symbols(v.value, raw, np.array([0, len(raw)]))[0])
    for _ in range(3):
        start, move, emit = np.ones(lm.STATES), np.ones((lm.STATES, lm.STATES)), np.zeros_like(m.emit)
        for x in seqs:
            a, b = np.zeros((len(x), lm.STATES)), np.ones((len(x), lm.STATES))
            for t in range(len(x)):
                a[t] = (m.start if t == 0 else a[t - 1] @ m.move) * m.emit[x[t]]
                a[t] /= a[t].sum()
            for t in range(len(x) - 2, -1, -1):
                b[t] = m.move @ (m.emit[x[t + 1]] * b[t + 1])
                b[t] /= b[t].sum()
            for t in range(len(x)):
                gamma = a[t] * b[t] / (a[t] @ b[t])
                emit[x[t]] += gamma
                start += gamma * (t == 0)
                if t:
                    both = np.outer(a[t - 1], m.emit[x[t]] * b[t]) * m.move
                    move += both / both.sum()
        m = lm.Hmm(start / start.sum(), move / move.sum(axis=1)[:, None], (emit + lm.PRIOR * v.value.unigram[:, None]) / (emit.sum(axis=0) + lm.PRIOR))
    got = lm.train(texts, v, rounds=1, warm_rounds=2)
    assert np.allclose(got.start, m.start) and np.allclose(got.move, m.move) and np.allclose(got.emit, m.emit)


def test_expected_counts_in_single_precision_and_steps_of_all_batches():
    import pyarrow as pa

    draw = np.random.default_rng(9)
    m = lm.Hmm(draw.dirichlet([1] * 8), draw.dirichlet([0.2] * 8, 8), draw.dirichlet([0.05] * 300, 8).T + 1e-14)
    single = lm.Hmm(*(x.astype(np.float32) for x in (m.start, m.move, m.emit)))
    first = np.concatenate([[0], np.cumsum(draw.integers(0, 3000, 40))])
    flat = draw.integers(0, 300, first[-1])
    want, got = lm._expected(m, m.start, flat, first), lm._expected(single, single.start, flat, first)
    assert got[1].dtype == got[2].dtype == np.float64 and got[0] == pytest.approx(want[0], rel=1e-4)
    assert np.allclose(got[1], want[1], rtol=1e-3, atol=1e-3) and np.allclose(got[2], want[2], rtol=1e-3, atol=1e-3)
    batches = [pa.record_batch({"symbols": pa.array([bytes([k]) * 10 * n for n in range(4)], pa.binary())}) for k in range(9)]
    merged = list(lm._together(iter(batches), 200))
    assert len(merged) < len(batches) and [x for b in merged for x in b.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]


def test_counts_and_scores_do_not_depend_on_what_is_worked_on_together(docs_of, monkeypatch):
    draw = np.random.default_rng(4)
    m = lm.Hmm(draw.dirichlet([1] * 8), draw.dirichlet([1] * 8, 8), draw.dirichlet([1] * 50, 8).T)
    first = np.concatenate([[0], np.cumsum([70, 0, 1, 900, 33])])
    flat = draw.integers(0, 50, first[-1])
    train = docs_of([prose(1 + 97 * k % 400, k) for k in range(40)] + ["", None])
    rows = train.select(F.struct("doc_id").alias("row"), "text").coalesce(1)
    monkeypatch.setattr(lm, "TEXT_BYTES", 1000)
    out = []
    for counted, scored in ((7, 1), (1 << 15, 1 << 20)):
        monkeypatch.setattr(lm, "COUNTED", counted)
        log, move, emit = lm._expected(m, m.start, flat, first)
        logs, states, _ = lm._forward(m, m.start, flat, first, keep=True)
        assert log == pytest.approx(logs.sum()) and np.allclose(lm._forward(m, m.start, flat, first, keep=False)[0], logs) and states.shape == (8, 1004)
        counts = lm.hash_counts(train, lm.CLASSES)
        v = Shipped(train.sparkSession, lm.vocabulary(counts, 42))
        hmm = lm.train(train.select("text"), v, rounds=0, warm_rounds=0)
        monkeypatch.setattr(lm, "SCORED", scored)
        got = {r.row.doc_id: tuple(r)[1:6] + (r.model_logs,) for r in lm._scored(rows, v, hmm).collect()}
        out.append((move, emit, got))
    assert np.allclose(out[0][0], out[1][0]) and np.allclose(out[0][1], out[1][1])
    assert len(out[0][2]) == 42 and all(a == pytest.approx(out[1][2][k]) for k, a in out[0][2].items())


def test_a_round_holds_a_tokens_states_once_and_little_more():
    """Each state of a token takes 4 bytes; further arrays as long as these were half of a round's time."""
    import tracemalloc

    draw = np.random.default_rng(8)
    m = lm.Hmm(*(x.astype(np.float32) for x in (draw.dirichlet([1] * 8), draw.dirichlet([1] * 8, 8), draw.dirichlet([1] * 300, 8).T)))
    first = np.concatenate([[0], np.cumsum(draw.integers(0, 600, 3000))])
    flat = draw.integers(0, 300, first[-1]).astype(np.uint16)
    tracemalloc.start()
    lm._expected(m, m.start, flat, first)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 48 * len(flat)


@pytest.mark.parametrize("part, most_steps", [(1, 1), (50, 3), (1 << 15, 64)])
def test_sums_far_from_one_are_scaled_in_every_step(monkeypatch, part, most_steps):
    """Two states that seldom change, each with words of its own, and texts of both kinds by turns: eight steps are beyond single precision."""
    move = np.array([[1 - 1e-7, 1e-7], [1e-7, 1 - 1e-7]])
    emit = np.array([[0.5, 1e-7], [0.5 - 1e-7, 1e-7], [1e-7, 0.5], [1e-7, 0.5 - 1e-7]])
    seqs = [[0, 2] * 40, [1, 1, 0], [], [3], [2, 0, 3, 1] * 5, [0, 1] * 30]
    first, flat = np.concatenate([[0], np.cumsum([len(s) for s in seqs])]), np.array(sum(seqs, []))
    m = lm.Hmm(np.array([0.5, 0.5]), move, emit)
    single = lm.Hmm(*(x.astype(np.float32) for x in (m.start, m.move, m.emit)))
    monkeypatch.setattr(lm, "PART", part)
    monkeypatch.setattr(lm, "MOST_STEPS", most_steps)
    got = lm._expected(single, single.start, flat, first)
    monkeypatch.setattr(lm, "SCALED", 1)
    want = lm._expected(m, m.start, flat, first)
    assert want[0] == pytest.approx(lm._forward(m, m.start, flat, first, keep=False)[0].sum())
    assert want[2].sum() == pytest.approx(len(flat)) and want[1].sum() == pytest.approx(len(flat) - 5)
    assert got[0] == pytest.approx(want[0], rel=1e-5) and np.allclose(got[1], want[1], rtol=1e-4, atol=1e-4) and np.allclose(got[2], want[2], rtol=1e-4, atol=1e-4)


def test_places_by_first_bits_are_those_of_a_search():
    draw = np.random.default_rng(2)
    for n in (1, 2, 3, 4, 1000, 70_000):
        head = np.sort(draw.integers(0, 2**64, n, dtype=np.uint64))
        head[: n // 2] >>= np.uint64(9)  # many that share their first bits
        head.sort()
        ask = np.concatenate([draw.integers(0, 2**64, 5000, dtype=np.uint64), head, head + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        assert (lm._places(head, lm._leading(head), ask) == np.searchsorted(head, ask)).all()
