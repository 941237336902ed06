"""Counts of words over a whole corpus, added up inside each task before they are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.text import LOWER, longs, slices, word_hashes, words

#: Entries of slices' counts that a task holds before it gives them out.
HELD = 1 << 20


def _merged(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(place, np.concatenate(values), len(every)).astype(np.int64)


def hash_counts(texts: DataFrame, marks: int) -> DataFrame:
    """(word, mark, n) of the lower-cased words of (text): 64-bit hash, a hash below `marks` of its last two bytes, and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {"w": [], "n": []}
        tails: dict[str, list[np.ndarray]] = {"w": [], "m": []}

        def flush() -> Iterator[pa.RecordBatch]:
            if held["w"]:
                every, n = _merged(held["w"], held["n"])
                w, at = np.unique(np.concatenate(tails["w"]), return_index=True)
                mark = np.concatenate(tails["m"])[at]
                for a in range(0, len(every), 1 << 16):
                    part = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(longs(every[part])), pa.array(mark[part], pa.int32()), pa.array(n[part])], names=["word", "mark", "n"])
            held["w"], held["n"], tails["w"], tails["m"] = [], [], [], []

        size = 0
        for _, data, offsets in slices(batches, "text"):
            data = LOWER[data]
            w = words(data, offsets)
            hashes = word_hashes(data, w)
            every, at, n = np.unique(hashes, return_index=True, return_counts=True)
            held["w"].append(every)
            held["n"].append(n)
            tails["w"].append(every)
            tails["m"].append(word_marks(data, w.start[at], w.end[at], marks))
            size += len(every)
            if size > HELD:
                yield from flush()
                size = 0
        yield from flush()

    found = texts.select("text").mapInArrow(run, "word bigint, mark int, n bigint")
    return found.groupBy("word", "mark").agg(F.sum("n").alias("n"))


def word_marks(data: np.ndarray, start: np.ndarray, end: np.ndarray, marks: int) -> np.ndarray:
    last = data[end - 1].astype(np.int64)
    before = np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0).astype(np.int64)
    return ((last * 257 + before) * 40503 >> 4) % marks
