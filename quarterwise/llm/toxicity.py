"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits that stand for letters to
Latin letters, and turns ASCII punctuation into spaces, so that `1d10t` meets `idiot`. Lexicon and
text are folded alike.

The lexicon is learned from labelled texts, each distinct text counting once: its entries are whole
words and beginnings of words (as long as they lose little) with their log odds as weights. A rare
entry stays only if enough toxic texts have no stronger one, so the words of a toxic text that
was copied with changes do not become entries. Phrases of an entry with the word before or after it
that occur in clean texts and hardly in toxic ones are exceptions: a hit inside one does not count,
nor does one inside a phrase that the caller gives. The weights of a text's hits are summed, and a
logistic curve over the sum and, above all, the sum per 1,000 characters gives the score.

Defined results: null and empty texts get the score of a text without hits. Without toxic or
without clean labels, the lexicon is empty and the score is the share of toxic labels (0 without labels).
Null labels are none; labels of an id that differ count as toxic if any is.
"""

from __future__ import annotations

import hashlib
import math
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed
from quarterwise.llm.shared import bit_filter, cut, for_now, in_filter
from quarterwise.llm.text import release

REJECT = 0.7
#: An entry needs so many toxic texts, and this share of toxic texts.
LEAST_TEXTS, LEAST_SHARE = 4, 0.75
#: With so many toxic texts, it need not be the strongest in LEAST_TEXTS of them.
SURE_TEXTS = 20
#: A longer entry that keeps this share of the toxic texts replaces a shorter one.
LITTLE = 0.75
#: Letters of the beginnings that may be entries.
BEGINNINGS = range(3, 13)
#: A phrase is an exception with so many clean texts and this share of clean ones.
EXCEPTION_TEXTS, EXCEPTION_SHARE = 5, 0.95
#: Values of a hash, a share of which draws the rows that the curve is fitted on.
DRAWS = 1 << 40
#: About so many labelled rows are those that the curve is fitted on. Entries and exceptions have no such bound: all that meet the thresholds count.
FIT_ROWS = 50_000

# Letters of other scripts that look like Latin ones, and digits read as letters.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "и": "u", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ɑ": "a", "ı": "i",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
    "l": "i",
}


def _fold_table() -> dict[int, str]:
    table = {b: " " for b in range(128) if not chr(b).isalnum()}
    table |= {ord(k): v for k, v in LOOK_ALIKE.items()}
    wide = {c: unicodedata.normalize("NFKC", chr(c)).lower() for c in range(0xFF10, 0xFF5B)}
    return table | {c: LOOK_ALIKE.get(x, x) for c, x in wide.items() if x.isalnum()}


_FOLD = _fold_table()


def fold(text: str | None) -> str:
    """Folded text with a space before and after. Zero-width characters and soft hyphens vanish."""
    text = (text or "").lower()
    if not text.isascii():
        for c in "​‌‍⁠­﻿":
            text = text.replace(c, "")
    return f" {text.translate(_FOLD)} "


@dataclass
class Model:
    entries: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float]


def _automaton(entries: dict[str, float], exceptions: Sequence[str]) -> ahocorasick.Automaton | None:
    """Values: (length, entry or None). Entries begin with a space; a trailing one makes them whole words."""
    out = ahocorasick.Automaton()
    for e in entries:
        out.add_word(e, (len(e), e))
    for e in exceptions:
        kind = out.get(e, (0, None))[1]
        out.add_word(e, (len(e), kind if kind else None))
    if not len(out):
        return None
    out.make_automaton()
    return out


def hits(automaton: ahocorasick.Automaton | None, folded: str) -> list[tuple[str, int, int]]:
    """(entry, begin, end) of hits that no exception phrase covers."""
    if automaton is None:
        return []
    found, excused = [], []
    for end, (length, entry) in automaton.iter(folded):
        (excused if entry is None else found).append((entry, end + 1 - length, end + 1))
    if excused:
        found = [h for h in found if not any(a <= h[1] and h[2] <= b for _, a, b in excused)]
    return found


def _phrases(folded: str, begin: int) -> list[str]:
    """The word that begins after the space at `begin`, with the one before and with the one after it."""
    end = folded.find(" ", begin + 1)
    word = folded[begin + 1 : end]
    before = folded[max(0, begin - 60) : begin].split()
    after = folded[end : end + 60].split()
    return ([f" {before[-1]} {word} "] if before else []) + ([f" {word} {after[0]} "] if after else [])


def _emitted(texts: DataFrame, ids: Broadcast, emit, kind: str) -> DataFrame:
    """(id, made) of the texts (id, text) whose id may be in the filter `ids`: `emit` makes the value, of SQL type `kind`, from the folded text."""
    made = pa.binary() if kind == "binary" else pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = in_filter(ids.value, np.asarray(batch.column(0).fill_null(0)).astype(np.int64))
            batch = batch.filter(pa.array(known))
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([emit(fold(t)) for t in rows.column(1).to_pylist()], made)], names=["id", "made"])
        release()

    return texts.where("id is not null").mapInArrow(run, f"id bigint, made {kind}")


def _stamp(folded: str) -> bytes:
    return hashlib.blake2b(folded.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def distinct_labelled(texts: DataFrame, labels: DataFrame, known: Broadcast) -> DataFrame:
    """(id, toxic): one id for each distinct labelled text, toxic if any of its labels is. `known`: a filter of the labels' ids."""
    stamps = _emitted(texts, known, _stamp, "binary").join(labels, "id")
    return stamps.groupBy("made").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic")).select("id", "toxic")


def _words(folded: str) -> list[str]:
    return sorted(set(folded.split()))


def _beginnings(word: str, least: int, below: str) -> str:
    """SQL for the beginnings of a word, with a space before, whose lengths are in BEGINNINGS and under `below`."""
    lengths = f"filter(sequence({BEGINNINGS.start}, {BEGINNINGS.stop - 1}), k -> k < {below})"
    return f"transform({lengths}, k -> concat(' ', substring({word}, {least}, k)))"


def learn_entries(texts: DataFrame, labelled: DataFrame, toxic: int, clean: int, ship: Callable[[object], Broadcast]) -> dict[str, float]:
    """Entries and weights from texts (id, text) and distinct labelled texts (id, toxic), of which `toxic` and `clean` are the numbers."""
    words = _emitted(texts, ship(bit_filter(labelled, F.col("id"))), _words, "array<string>").join(labelled, "id")
    counts = cut(words.select("toxic", F.explode("made").alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")))
    whole = F.array(F.concat(F.lit(" "), "word", F.lit(" ")))
    entries = F.explode(F.concat(F.expr(_beginnings("word", 1, "length(word)")), whole)).alias("entry")
    told = counts.select("t", "n", entries).groupBy("entry").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    told = cut(told.where((F.col("t") >= LEAST_TEXTS) & (F.col("t") / (F.col("n") + 1) >= LEAST_SHARE)))
    # of telling beginnings of one another: the longest that loses little, the shortest that gains much
    shorter = F.expr(_beginnings("entry", 2, "length(rtrim(entry)) - if(endswith(entry, ' '), 0, 1)"))
    parts = told.select("entry", "t", F.explode(shorter).alias("part")).join(told.select(F.col("entry").alias("part"), F.col("t").alias("part_t")), "part")
    gained = parts.where(F.col("t") < LITTLE * F.col("part_t")).select("entry")
    lost = parts.where(F.col("t") >= LITTLE * F.col("part_t")).select(F.col("part").alias("entry"))
    chosen = cut(told.join(gained.union(lost).distinct(), "entry", "left_anti"))
    entry_of = counts.where("t > 0").select("word", entries).join(chosen, "entry").select("word", "entry", "t")
    own = _emitted(texts, ship(bit_filter(labelled.where("toxic = 1"), F.col("id"))), _words, "array<string>").select("id", F.explode("made").alias("word"))
    strongest = own.join(entry_of, "word").groupBy("id").agg(F.max_by("entry", F.struct("t", "entry")).alias("entry"))
    counted = chosen.join(strongest.groupBy("entry").count(), "entry", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    kept = counted.where((F.col("count") >= LEAST_TEXTS) | (F.col("t") >= SURE_TEXTS))
    rows = sorted(kept.select("entry", "t", "n").collect(), key=lambda r: (-r.t, r.entry))
    return {r.entry: math.log((r.t + 0.5) / (toxic + 1)) - math.log((r.n - r.t + 0.5) / (clean + 1)) for r in rows}


def learn_exceptions(texts: DataFrame, labelled: DataFrame, entries: dict[str, float], ship: Callable[[object], Broadcast]) -> list[str]:
    """Phrases around hits in the distinct labelled texts that are nearly always clean."""
    shipped = ship(tuple(entries.items()))
    made: list[ahocorasick.Automaton | None] = []

    def around(folded: str) -> list[str]:
        if not made:
            made.append(_automaton(dict(shipped.value), ()))
        return sorted({p for _, a, _ in hits(made[0], folded) for p in _phrases(folded, a)})

    phrases = _emitted(texts, ship(bit_filter(labelled, F.col("id"))), around, "array<string>").where(F.size("made") > 0).join(labelled, "id").select("toxic", F.explode("made").alias("phrase"))
    counts = phrases.groupBy("phrase").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    clean = counts.where((F.col("n") - F.col("t") >= EXCEPTION_TEXTS) & (1 - F.col("t") / F.col("n") >= EXCEPTION_SHARE))
    return [r.phrase for r in sorted(clean.select("phrase", "n").collect(), key=lambda r: (-r.n, r.phrase))]


def _sums(rows: DataFrame, entries: dict[str, float], exceptions: Sequence[str], text: str) -> DataFrame:
    """Adds weight (of all hits), hits and length of the field `text` to rows (row), and leaves that field in its place."""
    shipped = rows.sparkSession.sparkContext.broadcast((tuple(entries.items()), tuple(exceptions)))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, weight double, hits bigint, length bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = dict(shipped.value[0])
        automaton = _automaton(weights, shipped.value[1])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                row = batch.column(0).slice(at, 256)
                weight, number, length = [], [], []
                for body in pc.struct_field(row, text).cast(pa.string()).to_pylist():
                    found = hits(automaton, fold(body)) if automaton else []
                    weight.append(math.fsum(weights[e] for e, _, _ in found))
                    number.append(len(found))
                    length.append(len(body or ""))
                yield pa.RecordBatch.from_arrays([row, pa.array(weight, pa.float64()), pa.array(number, pa.int64()), pa.array(length, pa.int64())], names=["row", "weight", "hits", "length"])
        release()

    return rows.mapInArrow(run, schema).select("row", "weight", "hits", "length")


def _terms() -> tuple[Column, Column]:
    return F.log1p("weight"), F.log1p(1000 * F.col("weight") / (F.col("length") + 200))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression with intercept by Newton steps; slopes below 0 are 0."""
    if not len(y):
        return (-20.0, 0.0, 0.0)
    share = min(max(y.mean(), 1e-9), 1 - 1e-9)
    if y.min() == y.max():
        return (math.log(share / (1 - share)), 0.0, 0.0)
    use = [k for k in range(x.shape[1]) if np.ptp(x[:, k]) > 0]
    while True:
        a = np.column_stack([np.ones(len(y)), x[:, use]])
        w = np.zeros(a.shape[1])
        w[0] = math.log(share / (1 - share))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            penal = np.full(a.shape[1], ridge)
            penal[0] = 1e-6
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penal + 1e-9), a.T @ (y - p) - penal * w)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-9:
                break
        if (w[1:] >= 0).all():
            out = [0.0] * 3
            out[0] = float(w[0])
            for k, v in zip(use, w[1:], strict=True):
                out[k + 1] = float(v)
            return tuple(out)
        use = [k for k, v in zip(use, w[1:], strict=True) if v >= 0]


def learn(texts: DataFrame, labels: DataFrame, exceptions: Sequence[str] = ()) -> Model:
    """A model from texts (id, text) and labels (id, toxic); only labelled texts are used."""
    with for_now(texts.sparkSession) as ship:
        return _learned(texts, labels, exceptions, ship)


def _learned(texts: DataFrame, labels: DataFrame, exceptions: Sequence[str], ship: Callable[[object], Broadcast]) -> Model:
    labels = cut(labels.where("id is not null and toxic is not null").groupBy("id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")))
    known = ship(bit_filter(labels, F.col("id")))
    labelled = cut(distinct_labelled(texts, labels, known))
    total = labelled.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    toxic, clean = int(total[0]), int(total[1] - total[0])
    entries = learn_entries(texts, labelled, toxic, clean, ship) if toxic and clean else {}
    excused = tuple(dict.fromkeys([*(f" {' '.join(fold(e).split())} " for e in exceptions), *(learn_exceptions(texts, labelled, entries, ship) if entries else [])]))

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(known.value, np.asarray(batch.column(0).fill_null(0)).astype(np.int64))))

    own = packed(texts.where("id is not null").mapInArrow(mine, texts.schema))
    scored = _sums(own, entries, excused, "text").withColumn("id", F.col("row.id")).drop("row").join(labels, "id")
    scored = scored.select("toxic", *[t.cast("double").alias(n) for t, n in zip(_terms(), ("x", "y"), strict=True)], F.xxhash64("id").alias("place"))
    number = labels.count()
    drawn = F.pmod("place", F.lit(DRAWS)) < math.ceil(DRAWS * min(1.0, FIT_ROWS / max(1, number)))
    sample = scored.where(drawn).select("toxic", "x", "y", "place").toPandas().sort_values(["place", "x", "y", "toxic"])
    return Model(entries, excused, _fit(sample[["x", "y"]].to_numpy(float), sample["toxic"].to_numpy(float)))


def _score(model: Model) -> Column:
    a, b, c = model.curve
    x, y = _terms()
    return 1 / (1 + F.exp(-(F.lit(a) + b * x + c * y)))


def _model(docs: DataFrame, labels: DataFrame, ident: str, text: str, label: str, exceptions: Sequence[str]) -> Model:
    texts = docs.select(F.col(f"`{ident}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return learn(texts, labels.select(F.col(f"`{ident}`").cast("bigint").alias("id"), F.col(f"`{label}`").alias("toxic")), exceptions)


def scores(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "toxic", exceptions: Sequence[str] = (), keep: list[str] | None = None) -> DataFrame:
    """Column `row` with the document (`keep`: these columns and the text), and score, hits and weight, by a model learned from all of `labels`."""
    model = _model(docs, labels, ident, text, label, exceptions)
    rows = packed(docs, keep and [*keep, text])
    return _sums(rows, model.entries, model.exceptions, text).select("row", _score(model).alias("score"), "hits", "weight")


def fold_of_labels(labels: DataFrame, ident: str = "doc_id") -> DataFrame:
    """The labels to learn from; the rest is held out."""
    return labels.where(~held_out(F.col(f"`{ident}`")))


def held_out(ident: Column, parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % parts == part, F.lit(False))
