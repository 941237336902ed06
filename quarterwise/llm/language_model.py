"""A hidden Markov language model, trained by Baum-Welch on the whole training corpus.

The model's symbols are the `WORDS` most frequent words, the end of a text, and `CLASSES` classes of
all other words by their last two bytes. States emit symbols; a word of a class then has its share of the
class by count, with half a count for words that were never seen. So every word of any text has a
probability, and counts of all training words enter it, however many there are.

Training runs `WARM_ROUNDS` and `ROUNDS` rounds, each over all training texts, whatever their number. Their symbols
are kept between rounds. A round's expected counts are those of whole texts; they are added up in each task, then
across partitions; the driver gets sums whose number is fixed by the model's size. Scoring runs the scaled
forward recursion over every whole text.

Defined results: A-Z are lower-cased; a null or empty text is the end token alone. Without training
texts every word has the probability of an unseen one. Rows that repeat are scored and counted as often as they are there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.counts import hash_counts, word_marks
from quarterwise.llm.shared import Shipped, cut, frequent, parallelism
from quarterwise.llm.text import LOWER, slices, word_hashes, words

STATES, WORDS, CLASSES = 8, 4096, 256
#: Words whose counts go to every task (16 bytes each); the others are looked up by a join.
HEAD = 200_000
WARM_ROUNDS, ROUNDS = 14, 3
#: Tokens' worth of the overall distribution in each state's emissions.
PRIOR = 50.0
END = np.uint64(0x656E64)
TEXT_BYTES = 2 << 20
#: Bytes of symbols that a round works on at once: steps cost less with more texts in each.
ROUND_BYTES = 4 << 20
#: Tokens whose emissions are added up at once: they and the sums stay in the processor's cache.
COUNTED = 1 << 15
#: A round's tokens that are worked on together, which stay in the processor's cache, and the most steps that these may be.
PART, MOST_STEPS = 1 << 15, 64
#: Steps after which a round scales its sums to 1, or each one where a sum has come below FAR or above 1 / FAR.
SCALED, FAR = 8, 1e-9
#: Tokens of texts that are scored together, unless a slice has more.
SCORED = 1 << 20


@dataclass
class Vocabulary:
    """Sorted hashes of head words with counts and symbols, where their first bits lead, and each class's mass in half-count-smoothed words."""

    head: np.ndarray
    leading: np.ndarray
    count: np.ndarray
    symbol: np.ndarray
    class_mass: np.ndarray
    tokens: int
    distinct: int
    words: int
    unigram: np.ndarray


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states


def vocabulary(counts: DataFrame, texts: int, head_words: int = HEAD, words: int = WORDS, class_number: int = CLASSES) -> Vocabulary:
    """From the word counts of the training texts and the number of these, each of which has an end."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = int(total[0]) + texts, int(total[1]) + (texts > 0)
    head = frequent(counts, head_words).toPandas()
    hashes = np.append(head["word"].to_numpy(np.int64).view(np.uint64), END)
    n = np.append(head["n"].to_numpy(np.int64), texts)
    mark = np.append(head["mark"].to_numpy(np.int64), 0)
    own = np.lexsort((hashes[:-1], -n[:-1]))[:words]
    symbol = mark + words + 1
    symbol[own] = np.arange(len(own)) + 1
    symbol[-1] = 0
    classes = np.full(class_number, 0.5)
    for row in counts.groupBy("mark").agg((F.sum("n") + 0.5 * F.count(F.lit(1))).alias("mass")).collect():
        classes[row.mark] += row.mass
    np.subtract.at(classes, mark[own], n[own] + 0.5)
    classes = np.maximum(classes, 0.5)
    unigram = np.zeros(1 + words + class_number)
    unigram[0] = texts + 0.5
    unigram[symbol[own]] = n[own] + 0.5
    unigram[words + 1 :] = classes
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], _leading(hashes[order]), n[order], symbol[order].astype(np.int32), classes, tokens, distinct, words, unigram / unigram.sum())


def _leading(head: np.ndarray) -> np.ndarray:
    """Where the hashes of each value of their first bits begin in sorted ones, twice to four times as many values as hashes."""
    bits = len(head).bit_length() + 1
    return np.searchsorted(head, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)


def _places(head: np.ndarray, leading: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """As np.searchsorted(head, hashes): few hashes share their first bits, so few steps lead from these to the place."""
    place = leading[hashes >> np.uint64(65 - len(leading).bit_length())]
    head = np.append(head, np.uint64(2**64 - 1))
    later = np.flatnonzero(head[place] < hashes)
    while len(later):
        place[later] += 1
        later = later[head[place[later]] < hashes[later]]
    return place


def _symbols(v: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all texts, each with its end: symbols, hashes, counts (-1: not a head word) and where each text begins."""
    data = LOWER[data]
    w = words(data, offsets)
    hashes = word_hashes(data, w)
    ends = w.first[1:]
    place = _places(v.head, v.leading, hashes)
    place[place == len(v.head)] = 0
    known = v.head[place] == hashes
    symbol = np.where(known, v.symbol[place], word_marks(data, w.start, w.end, len(v.class_mass)) + v.words + 1).astype(np.int32)
    count = np.where(known, v.count[place], -1)
    end_count = v.count[np.searchsorted(v.head, END)]
    return np.insert(symbol, ends, 0), np.insert(hashes, ends, END), np.insert(count, ends, end_count), w.first + np.arange(len(w.first))


def _by_time(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens step after step, sequences from long to short in each: their positions, their ranks among the sequences, where steps begin, and the sequences' order."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), "left")
    begin = np.concatenate([[0], np.cumsum(active)])
    step = np.repeat(np.arange(len(active)), active)
    rank = np.arange(begin[-1]) - begin[step]
    return first[:-1][order][rank] + step, rank, begin, order


@dataclass
class _Steps:
    """The forward recursion, step after step: symbols of all tokens, their emissions and scaled states (states x tokens), factors, and where steps begin."""

    symbols: np.ndarray
    emitted: np.ndarray
    states: np.ndarray
    factors: np.ndarray
    begin: list[int]
    rank: np.ndarray
    order: np.ndarray


def _recursion(m: Hmm, start: np.ndarray, symbols: np.ndarray, first: np.ndarray, keep: bool = True) -> _Steps:
    """The scaled forward recursion over all sequences; without `keep`, only the last step's states are held.

    What does not depend on the step before is done for all steps at once, so a step is few operations, however few sequences are as long.
    """
    place, rank, begin, order = _by_time(first)
    s = _Steps(symbols[place].astype(np.intp), np.zeros(0), np.zeros(0), np.empty(len(place), m.emit.dtype), begin.tolist(), rank, order)
    s.emitted = np.take(np.ascontiguousarray(m.emit.T), s.symbols, axis=1, mode="clip")
    s.states = np.empty_like(s.emitted if keep else s.emitted[:, : len(order)])
    back, ones, before = np.ascontiguousarray(m.move.T), np.ones(len(m.move), m.emit.dtype), 0
    for a, b in zip(s.begin[:-1], s.begin[1:], strict=True):
        now = s.emitted[:, a:b] * (back @ s.states[:, before : before + b - a] if a else start[:, None])
        factor = np.matmul(ones, now, out=s.factors[a:b])
        to = a if keep else 0
        np.divide(now, factor, out=s.states[:, to : to + b - a])
        before = to
    return s


def _forward(m: Hmm, start: np.ndarray, symbols: np.ndarray, first: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Log likelihoods; with `keep`, all scaled states and factors as well."""
    s = _recursion(m, start, symbols, first, keep)
    logs = np.zeros(len(s.order))
    logs[s.order] = np.bincount(s.rank, np.log(s.factors, dtype=np.float64), len(logs))
    return (logs, s.states, s.factors) if keep else (logs, None, None)


def _parts(size: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Steps that are worked on together, for sequences from long to short: the first one, how many, and how many sequences reach the first and the last."""
    out, at = [], 0
    while at < size.max(initial=0):
        n = int(np.searchsorted(-size, -at))
        steps = min(max(PART // n, SCALED), MOST_STEPS, int(size[0]) - at)
        out.append((at, steps, n, int(np.searchsorted(-size, -(at + steps), "right"))))
        at += steps
    return out


def _scaled_steps(states: np.ndarray, emitted: np.ndarray, before: np.ndarray | None, start: np.ndarray, move: np.ndarray, often: int) -> dict[int, np.ndarray]:
    """Fills states (steps x sequences x states), their sums made 1 every `often` steps and in the last one; these steps' factors."""
    factors, ones = {}, np.ones(len(move), move.dtype)
    for t, (now, shares) in enumerate(zip(states, emitted, strict=True)):
        if before is None:
            np.multiply(shares, start, now)
        else:
            np.dot(before[: len(now)], move, now)
            np.multiply(now, shares, now)
        if (t + 1) % often == 0 or t + 1 == len(states):
            factors[t] = np.dot(now, ones)
            np.divide(now, factors[t][:, None], now)
        before = now
    return factors


def _expected(m: Hmm, start: np.ndarray, symbols: np.ndarray, first: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood and expected numbers of moves and emissions, in the precision of the model; their sums are doubles.

    Sequences go on to the end of the steps they end in with a symbol that every state emits for certain and that is not counted. Emissions are
    relative to their symbol's mean over the states, so sums stay near 1 and need not be made 1 in every step; where they do not, they are.
    """
    z, s = m.emit.shape
    kind = m.emit.dtype
    mean = m.emit.mean(axis=1, dtype=np.float64)
    mean[mean == 0] = 1
    relative = np.ones((z + 1, s), kind)
    relative[:z] = m.emit / mean[:, None]
    symbols = symbols.astype(np.min_scalar_type(z), copy=False)
    log = float(np.bincount(symbols, minlength=z) @ np.log(mean))
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    size, begin = size[order], first[:-1][order]
    parts = _parts(size)
    ends = np.cumsum([steps * n for _, steps, n, _ in parts], dtype=np.int64).tolist()
    most = max((steps * n for _, steps, n, _ in parts), default=0)
    there, states = np.empty(sum(ends[-1:]), symbols.dtype), np.empty((sum(ends[-1:]), s), kind)
    emitted, after = np.empty((most, s), kind), np.empty((most, s), kind)
    forth, back = np.ascontiguousarray(m.move), np.ascontiguousarray(m.move.T)

    def of(part: int, whole: np.ndarray) -> np.ndarray:
        _, steps, n, _ = parts[part]
        return whole[ends[part] - steps * n : ends[part]].reshape(steps, n, *whole.shape[1:])

    def shares(part: int) -> np.ndarray:
        at = of(part, there).astype(np.intp)
        return np.take(relative, at, axis=0, out=emitted[: at.size].reshape(*at.shape, s), mode="clip")

    factors: list[dict[int, np.ndarray]] = []
    before = None
    for part, (at, steps, n, full) in enumerate(parts):
        step = np.arange(at, at + steps)[:, None]
        np.take(symbols, begin[:n] + step, out=of(part, there), mode="clip")
        of(part, there)[:, full:][step >= size[full:n]] = z
        now, x = of(part, states), shares(part)
        for often in (SCALED, 1):
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                found = _scaled_steps(now, x, before, start, forth, often)
            every = np.concatenate(list(found.values()))
            if every.min() > FAR and every.max() < 1 / FAR:
                break
        log += float(np.log(every, dtype=np.float64).sum())
        factors.append(found)
        before = now[-1]
    move, emit = np.zeros((s, s)), np.zeros((z + 1, s))
    beta, open_to = np.ones((len(size), s), kind), len(there)
    for part in range(len(parts) - 1, -1, -1):
        _, steps, n, full = parts[part]
        now, weighed, b = of(part, states), shares(part), after[: steps * n].reshape(steps, n, s)
        b[-1] = beta[:n]
        for t in range(steps - 1, -1, -1):
            np.multiply(weighed[t], b[t], weighed[t])
            if t in factors[part]:
                np.divide(weighed[t], factors[part][t][:, None], weighed[t])
            np.dot(weighed[t], back, b[t - 1] if t else beta[:n])
        weighed[:, full:][of(part, there)[:, full:] == z] = 0
        move += now[:-1].reshape(-1, s).T @ weighed[1:].reshape(-1, s)
        if part:
            move += of(part - 1, states)[-1, :n].T @ weighed[0]
        np.multiply(now, b, now)  # now the states' shares
        done = ends[part] - steps * n
        if open_to - done >= COUNTED or not part:
            for at in range(done, open_to, COUNTED):
                to = min(at + COUNTED, open_to)
                _count(emit, there[at:to], states[at:to])
            open_to = done
    return log, move * m.move, emit[:z]


def _count(emit: np.ndarray, symbols: np.ndarray, shares: np.ndarray) -> None:
    """Adds the shares (tokens x states) to their symbols' rows, two states at a time as one complex number."""
    pairs = shares.view(np.result_type(shares, np.complex64)) if shares.shape[1] % 2 == 0 else shares
    sums = np.zeros((pairs.shape[1], len(emit)), pairs.dtype)
    at = symbols.astype(np.intp)
    for own, pair in zip(sums, pairs.T, strict=True):
        np.add.at(own, at, pair)
    emit += np.ascontiguousarray(sums.T).view(shares.dtype)


def _coded(texts: DataFrame, v) -> DataFrame:
    """(symbols), two bytes each (four with a model of more), of rows (text); in each partition from short to long, so that texts of a slice end together."""
    kind = _symbol_kind(v.value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in slices(batches, "text", TEXT_BYTES):
            symbols, _, _, first = _symbols(v.value, data, offsets)
            bounds = pa.py_buffer((first * kind.itemsize).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, bounds, pa.py_buffer(symbols.astype(kind))])], names=["symbols"])

    return texts.select("text").mapInArrow(run, "symbols binary").sortWithinPartitions(F.length("symbols"))


def _together(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `most` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _symbol_kind(v: Vocabulary) -> np.dtype:
    return np.dtype(np.uint16 if len(v.unigram) <= 1 << 16 else np.int32)


def _round(texts: DataFrame, v, m: Hmm) -> tuple[float, Hmm]:
    """One Baum-Welch round over (text)."""
    return _coded_round(_coded(texts, v), v, m)


def _coded_round(coded: DataFrame, v, m: Hmm) -> tuple[float, Hmm]:
    """One Baum-Welch round over (symbols)."""
    shipped = Shipped(coded.sparkSession, m)
    s, z = len(m.move), len(m.emit)
    kind = _symbol_kind(v.value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a token's shares in single precision, half the memory to read and write; the factors keep them in its range
        single = Hmm(*(x.astype(np.float32) for x in (shipped.value.start, shipped.value.move, shipped.value.emit)))
        sums = np.zeros(1 + s + s * s + z * s)
        for _, data, offsets in slices(_together(batches, ROUND_BYTES), "symbols", ROUND_BYTES):
            logs, move, emit = _expected(single, single.start, np.frombuffer(data.tobytes(), kind), offsets // kind.itemsize)
            sums[0] += logs
            sums[1 : 1 + s] += emit.sum(axis=0) - move.sum(axis=0)  # states that no move leads to: those that texts begin in
            sums[1 + s : 1 + s + s * s] += move.ravel()
            sums[1 + s + s * s :] += emit.ravel()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "value"])

    rows = coded.mapInArrow(run, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    sums = np.zeros(1 + s + s * s + z * s)
    sums[rows["at"].to_numpy(np.int64)] = rows["value"].to_numpy()
    start, move, emit = sums[1 : 1 + s] + 1, sums[1 + s : 1 + s + s * s].reshape(s, s) + 1, sums[1 + s + s * s :].reshape(z, s)
    prior = v.value.unigram[:, None]
    return float(sums[0]), Hmm(start / start.sum(), move / move.sum(axis=1)[:, None], (emit + PRIOR * prior) / (emit.sum(axis=0) + PRIOR))


def train(texts: DataFrame, v, rounds: int = ROUNDS, warm_rounds: int = WARM_ROUNDS, seed: int = 11) -> Hmm:
    """From rows (text), by warm_rounds + rounds rounds over all of them. `v`: the vocabulary, shipped."""
    draw = np.random.default_rng(seed)
    z = len(v.value.unigram)
    emit = v.value.unigram[:, None] * draw.uniform(0.2, 1.8, (z, STATES))
    move = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
    m = Hmm(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))
    if not v.value.tokens:
        return m
    coded = cut(_coded(texts, v))
    for _ in range(warm_rounds + rounds):
        _, m = _coded_round(coded, v, m)
    return m


def _scored(rows: DataFrame, v, m: Hmm) -> DataFrame:
    """(row, n_tokens, head_known, head_logs, inner_logs, model_logs, rare) of rows (row, text); logs to base 10, rare: words that are not in the head."""
    shipped = Shipped(rows.sparkSession, m)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_tokens bigint, head_known bigint, head_logs double, inner_logs double, model_logs double, rare array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, voc = shipped.value, v.value
        held: list[tuple[np.ndarray, np.ndarray, list[pa.Array]]] = []

        def together() -> Iterator[pa.RecordBatch]:
            # steps cost less with more texts in each
            sizes = np.concatenate([n for _, n, _ in held])
            logs, _, _ = _forward(own, own.start, np.concatenate([x for x, _, _ in held]), np.concatenate([[0], np.cumsum(sizes)]), keep=False)
            at = 0
            for _, n, columns in held:
                model = pa.array(logs[at : at + len(n)] / math.log(10))
                at += len(n)
                yield pa.RecordBatch.from_arrays([*columns[:5], model, columns[5]], names=["row", "n_tokens", "head_known", "head_logs", "inner_logs", "model_logs", "rare"])
            held.clear()

        for part, data, offsets in slices(batches, "text", TEXT_BYTES):
            symbols, hashes, count, first = _symbols(voc, data, offsets)
            known = np.log10(np.maximum(count, 0) + 0.5)
            rare = count < 0
            inner = np.where(symbols > voc.words, np.where(rare, 0, known) - np.log10(voc.class_mass)[np.maximum(symbols - voc.words - 1, 0)], 0.0)
            add = lambda x: np.add.reduceat(x, first[:-1])
            bounds = np.concatenate([[0], np.cumsum(add(rare.astype(np.int64)))]).astype(np.int32)
            columns = [
                part.column(part.schema.get_field_index("row")),
                pa.array(np.diff(first)),
                pa.array(add((count > 0).astype(np.int64))),
                pa.array(add(np.where(rare, 0, known))),
                pa.array(add(inner)),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes[rare].view(np.int64))),
            ]
            held.append((symbols, np.diff(first), columns))
            if sum(len(x) for x, _, _ in held) >= SCORED:
                yield from together()
        if held:
            yield from together()

    return rows.mapInArrow(run, schema)


def scores(rows: DataFrame, training: DataFrame, head_words: int = HEAD, words: int = WORDS) -> DataFrame:
    """Column `row`, and n_tokens, n_known, train_tokens, base_score and score, of rows (row, text); training: rows (text)."""
    spark = rows.sparkSession
    counts = cut(hash_counts(training, CLASSES))
    v = Shipped(spark, vocabulary(counts, training.count(), head_words, words))
    m = train(training, v)
    scored = cut(_scored(rows, v, m).withColumn("at", F.monotonically_increasing_id()))
    rare = scored.select("at", F.explode("rare").alias("word")).groupBy("at", "word").agg(F.count(F.lit(1)).alias("times"))
    found = rare.join(counts.select("word", "n"), "word", "left")
    log = F.log10(F.coalesce("n", F.lit(0)) + 0.5)
    sums = found.groupBy("at").agg(F.sum(F.col("times") * log).alias("rare_logs"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    all_in = scored.drop("rare").join(sums, "at", "left")
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    whole = math.log10(v.value.tokens + 0.5 * (v.value.distinct + 1))
    return all_in.select(
        "row",
        "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(v.value.tokens).cast("bigint").alias("train_tokens"),
        (F.col("head_logs") + rare_logs - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("model_logs") + F.col("inner_logs") + rare_logs).alias("score"),
    )
