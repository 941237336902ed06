"""Language identification with a bit-sliced Bloom filter of n-grams.

A slot of the filter holds one bit per language, so the AND of a gram's slots names all languages
that contain it at once. A language contains the four-byte grams of lower-cased text that are not
far rarer in it than in the language where they are most frequent. For a text, the bits are counted per language over
all its grams, corrected for the share of slots that the language fills (its false positives), and the
language with most grams is predicted; its share of all corrected counts is the score.

Defined results: `und` with score 0 for a null text, a text without letters, or when nothing was
learned. A text without a known gram gets the most frequent language of the learned ones with
score 0. Ties go to the first language by code point. Rows without a language are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed
from quarterwise.llm.shared import Shipped, cut
from quarterwise.llm.text import slices

GRAM_BYTES = 4
SLOT_BITS, HASHES = 20, 3
#: A language contains a gram whose rate in it is at least this part of its highest rate.
LEAST_RATE = 0.1
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])


def _lowered(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.set_column(at, "text", pc.utf8_lower(batch.column(at).cast(pa.large_string())))


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all texts and where each text's begin; text boundaries count as spaces, so every text with a byte has grams."""
    n = len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    width = np.diff(offsets) + 2
    first = np.zeros(n + 1, np.int64)
    np.cumsum(width, out=first[1:])
    padded = np.full(int(first[-1]) + GRAM_BYTES, 32, np.uint8)
    padded[np.arange(len(data)) + 1 + 2 * np.repeat(np.arange(n), np.diff(offsets))] = data
    whole = np.ndarray((int(first[-1]),), "<u4", padded.data, strides=(1,)).astype(np.uint64)
    own = np.arange(int(first[-1])) - np.repeat(first[:-1], width) + GRAM_BYTES <= np.maximum(np.repeat(width, width), GRAM_BYTES)
    counts = np.add.reduceat(own, first[:-1])
    counts[np.diff(offsets) == 0] = 0
    own[np.repeat(np.diff(offsets) == 0, width)] = False
    return whole[own], np.concatenate([[0], np.cumsum(counts)])


def _slots(grams: np.ndarray, k: int) -> np.ndarray:
    return ((grams + np.uint64(1)) * _FACTORS[k] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) of (text, lang), each partition's counts already added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for rows, data, offsets in slices(_lowered(batches, 0), "text"):
            grams, first = _grams(data, offsets)
            langs = np.array(rows.column(1).to_pylist(), object)
            per = np.repeat(langs, np.diff(first))
            for lang in dict.fromkeys(langs):
                new, n = np.unique(grams[per == lang], return_counts=True)
                if lang in known:
                    new, place = np.unique(np.concatenate([known[lang][0], new]), return_inverse=True)
                    n = np.bincount(place, np.concatenate([known[lang][1], n])).astype(np.int64)
                known[lang] = (new, n)
        for lang, (grams, n) in known.items():
            for at in range(0, len(grams), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n[part]), pa.string()), pa.array(grams[part].astype(np.int64)), pa.array(n[part])], names=["lang", "gram", "n"])

    found = texts.where("lang is not null and text is not null").mapInArrow(run, "lang string, gram bigint, n bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filter:
    """Languages, the filter's slots (one array of 64-bit masks for each 64 languages) and the share of slots that each language fills."""

    def __init__(self, langs: list[str], slots: np.ndarray, likely: int):
        self.langs, self.slots, self.likely = langs, slots, likely
        bits = [np.count_nonzero(slots[k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(langs))]
        self.false = (np.array(bits, float) / slots.shape[1]) ** HASHES


def learn(texts: DataFrame) -> Filter:
    """From rows (text, lang). The driver gets one row per language and per slot, of which there are 2**SLOT_BITS at most."""
    counts = cut(_gram_counts(texts))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rows = totals.orderBy("lang").collect()
    langs = [r.lang for r in rows]
    slots = np.zeros((max(1, -(-len(langs) // 64)), 1 << SLOT_BITS), np.uint64)
    if langs:
        number = F.create_map(*[x for k, lang in enumerate(langs) for x in (F.lit(lang), F.lit(k))])[F.col("lang")]
        rates = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total")).withColumn("number", number)
        best = rates.groupBy("gram").agg(F.max("rate").alias("best"))
        held = rates.join(best, "gram").where(F.col("rate") >= LEAST_RATE * F.col("best")).groupBy("gram", (F.floor(F.col("number") / 64)).alias("part")).agg(F.expr("bit_or(shiftleft(1L, number % 64))").alias("mask"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                grams = np.asarray(batch.column(0)).astype(np.uint64)
                for k in range(HASHES):
                    yield pa.RecordBatch.from_arrays([pa.array(_slots(grams, k)), batch.column(1), batch.column(2)], names=["slot", "part", "mask"])

        filled = held.select("gram", "part", "mask").mapInArrow(run, "slot bigint, part bigint, mask bigint").groupBy("slot", "part").agg(F.expr("bit_or(mask)").alias("mask")).toPandas()
        slots[filled["part"].to_numpy(np.int64), filled["slot"].to_numpy(np.int64)] = filled["mask"].to_numpy(np.int64).view(np.uint64)
    likely = max(range(len(langs)), key=lambda k: (rows[k].total, -k), default=0)
    return Filter(langs, slots, likely)


def _decide(model: Filter, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the predicted language of each text, and its share."""
    grams, first = _grams(data, offsets)
    n, langs = np.diff(first), len(model.langs)
    counts = np.zeros((len(n), langs))
    some = np.flatnonzero(n)
    at = [_slots(grams, k) for k in range(HASHES)]
    for part in range(model.slots.shape[0]):
        mask = model.slots[part][at[0]]
        for spot in at[1:]:
            mask &= model.slots[part][spot]
        for k in range(64 * part, min(langs, 64 * part + 64)):
            if len(some):
                counts[some, k] = np.add.reduceat(mask >> np.uint64(k % 64) & np.uint64(1), first[:-1][some])
    right = np.maximum(0, counts - n[:, None] * model.false) / np.maximum(1e-12, 1 - model.false)
    total = right.sum(axis=1)
    best = np.where(total > 0, right.argmax(axis=1), model.likely)
    share = right[np.arange(len(n)), best] / np.where(total > 0, total, 1)
    return best, share


def identify(docs: DataFrame, model: Filter, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Column `row` with the document's columns (`keep`: only these), and lang_pred and score."""
    rows = packed(docs, keep, text=F.col(f"`{text}`").cast("string"))
    shipped = Shipped(docs.sparkSession, model)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for part, data, offsets in slices(_lowered(batches, 1), "text"):
            letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
            has = letters[offsets[1:]] > letters[offsets[:-1]]
            for k in np.flatnonzero(~has & (np.diff(offsets) > 0)):
                has[k] = any(c.isalpha() for c in data[offsets[k] : offsets[k + 1]].tobytes().decode())
            if own.langs:
                best, share = _decide(own, data, offsets)
            else:
                best, share = np.zeros(len(has), int), np.zeros(len(has))
            known = has & bool(own.langs)
            names = [own.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0))], names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
