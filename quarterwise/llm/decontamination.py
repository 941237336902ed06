"""Benchmark decontamination by greedy string tiling.

A text and a benchmark item that share a run of `SEED` words are a candidate pair. For each pair,
running Karp-Rabin finds the longest matches of words that no tile has yet, marks them as tiles,
and starts again until no match of `SEED` words is left. The share of the item's words under tiles,
wherever they stand in the text, is its coverage: reordered passages count in full. A text is
contaminated if some item is covered by `LEAST_COVERAGE` or more.

Only stretches of a text made of shared seeds are looked at and moved, as word hashes; a filter of
fixed size (built from the items' seeds) finds them in one pass over the texts, and a join with the
seeds themselves pairs them with items.

Words are runs of letters and digits, lower-cased. Defined results: null and empty texts are clean.
Items that are null or of fewer than `SEED` words match nothing. Equal items are one, named by the
smallest id (null if they have none). Coverage depends on the text alone, so repeated rows, and rows without an id, are
treated alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed, unpacked
from quarterwise.llm.shared import bit_filter, cut, for_now, in_filter
from quarterwise.llm.text import longs, slices, windows, word_hashes, words

SEED = 5
LEAST_COVERAGE = 0.5
#: Search length of the first round.
FIRST_LENGTH = 20
IS_GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _lowered(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.set_column(at, "lowered", pc.utf8_lower(batch.column(at).cast(pa.large_string())))


def _stretches(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _items(benchmark: DataFrame, seed: int) -> DataFrame:
    """(item, words, seeds): one row per distinct item long enough to match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(_lowered(batches, 1), "lowered"):
            w = words(data, offsets, IS_GAP)
            hashes = word_hashes(data, w)
            values, texts, _ = windows(hashes, w, seed, short=False)
            first = np.searchsorted(texts, np.arange(len(offsets)))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.ListArray.from_arrays(pa.array(w.first, pa.int32()), pa.array(longs(hashes))),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(longs(values))),
                ],
                names=["item", "words", "seeds"],
            )

    found = benchmark.mapInArrow(run, "item bigint, words array<bigint>, seeds array<bigint>")
    return found.where(F.size("words") >= seed).groupBy("words").agg(F.min("item").alias("item"), F.first("seeds").alias("seeds"))


def _runs(texts: DataFrame, seeds: Broadcast, seed: int) -> DataFrame:
    """(id, stamp, runs) of every text: md5 of the text, and its stretches (at, words) of possible seeds."""
    kind = pa.struct([("at", pa.int64()), ("words", pa.list_(pa.int64()))])

    def stamped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stamps = [None if t is None else hashlib.md5(t.encode()).hexdigest() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(stamps, pa.string())], names=["id", "text", "stamp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(_lowered(stamped(batches), 1), "lowered"):
            w = words(data, offsets, IS_GAP)
            hashes = word_hashes(data, w)
            values, _, at = windows(hashes, w, seed, short=False)
            inside = np.zeros(len(hashes) + 1, np.int64)
            hits = at[in_filter(seeds.value, values)]
            np.add.at(inside, hits, 1)
            np.add.at(inside, hits + seed, -1)
            mark = np.cumsum(inside[:-1]) > 0
            starts, stops = _stretches(mark)
            # stretches never run into the next text: no window does, but two may touch
            cuts = np.setdiff1d(w.first[1:-1], starts)
            inner = cuts[mark[cuts - 1] & mark[np.minimum(cuts, len(mark) - 1)] & (cuts < len(mark)) & (cuts > 0)] if len(mark) else cuts[:0]
            starts, stops = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([stops, inner]))
            out = [[] for _ in range(rows.num_rows)]
            for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                k = int(w.text[a])
                out[k].append({"at": a - int(w.first[k]), "words": longs(hashes[a:b])})
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(out, pa.list_(kind))], names=["id", "stamp", "runs"])

    return texts.mapInArrow(run, "id bigint, stamp string, runs array<struct<at: bigint, words: array<bigint>>>")


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _rolling(x: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of `size` values, rolled as differences of prefix sums."""
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * _powers(_STEP, len(x)), out=sums[1:])
    last = len(x) - size
    return (sums[size:] - sums[: last + 1]) * _powers(_STEP_BACK, last + 1)


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    taken = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(taken[size:] == taken[:-size])


def _matches(item: np.ndarray, text: np.ndarray, item_marked: np.ndarray, text_marked: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches (length, item position, text position) of `size` values or more."""
    if len(item) < size or len(text) < size:
        return []
    p, t = _free(item_marked, size), _free(text_marked, size)
    hp, ht = _rolling(item, size)[p], _rolling(text, size)[t]
    order = np.argsort(hp, kind="stable")
    hp, p = hp[order], p[order]
    low, high = np.searchsorted(hp, ht, "left"), np.searchsorted(hp, ht, "right")
    many = high - low
    t = np.repeat(t, many)
    p = p[np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())]
    same = np.ones(len(t), bool)
    for k in range(size):
        same &= item[p + k] == text[t + k]
    p, t = p[same], t[same]
    if not len(p):
        return []
    order = np.lexsort((t, p - t))
    p, t = p[order], t[order]
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(p - t) != 0) | (np.diff(t) != 1)
    at = np.flatnonzero(new)
    lengths = np.diff(np.append(at, len(p))) + size - 1
    return list(zip(lengths.tolist(), p[at].tolist(), t[at].tolist(), strict=True))


def tiles(item: np.ndarray, text: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiling of two sequences: (length, item position, text position), longest first, none overlapping."""
    item_marked, text_marked = np.zeros(len(item), bool), np.zeros(len(text), bool)
    found: list[tuple[int, int, int]] = []
    size = max(least, min(FIRST_LENGTH, len(item)))
    while True:
        matches = _matches(item, text, item_marked, text_marked, size)
        longest = max(matches, default=(0, 0, 0))[0]
        for length, p, t in sorted(m for m in matches if m[0] == longest):
            if not item_marked[p : p + length].any() and not text_marked[t : t + length].any():
                item_marked[p : p + length] = text_marked[t : t + length] = True
                found.append((length, p, t))
        if not matches:
            if size == least:
                return found
            size = size // 2 if size > 2 * least else least


def _tiled(pairs: DataFrame, seed: int) -> DataFrame:
    """(stamp, item, item_words, tiled, tiles) of rows (stamp, item, words, runs)."""
    kind = pa.list_(pa.struct([("item_at", pa.int64()), ("text_at", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                parts, places = [], []
                for k, r in enumerate(sorted(runs, key=lambda r: r["at"])):
                    parts += [np.array(r["words"], np.int64).view(np.uint64), np.array([k], np.uint64)]  # a hash this small is no word
                    places += [*range(r["at"], r["at"] + len(r["words"])), -1]
                got = tiles(np.array(item, np.int64).view(np.uint64), np.concatenate(parts), seed)
                out.append([{"item_at": p, "text_at": places[t], "words": n} for n, p, t in got])
            sizes = [len(x) for x in batch.column(2).to_pylist()]
            tiled = [sum(t["words"] for t in x) for x in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(tiled, pa.int64()), pa.array(out, kind)],
                names=["stamp", "item", "item_words", "tiled", "tiles"],
            )

    schema = "stamp string, item bigint, item_words bigint, tiled bigint, tiles array<struct<item_at: bigint, text_at: bigint, words: bigint>>"
    return pairs.select("stamp", "item", "words", "runs").mapInArrow(run, schema)


def tiled_pairs(texts: DataFrame, benchmark: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(id, stamp) of all texts (id, text), and the tiles of every pair (stamp, item) that shares a seed."""
    items = cut(_items(benchmark, seed).withColumn("key", F.monotonically_increasing_id()))
    with for_now(texts.sparkSession) as ship:
        found = cut(_runs(texts, ship(bit_filter(items.select(F.explode("seeds").alias("seed")), F.col("seed"))), seed))
    runs = found.where(F.size("runs") > 0).select("stamp", F.explode("runs").alias("run")).distinct().select("stamp", F.col("run.at").alias("at"), F.col("run.words").alias("run"))
    stretches = runs.withColumn("n", F.size("run"))
    # which items a stretch may belong to: its words' runs of SEED, joined as lists
    grams = stretches.select("stamp", "at", F.explode(F.expr(f"transform(sequence(1, n - {seed} + 1), i -> slice(run, i, {seed}))")).alias("gram"))
    item_grams = items.select("key", F.explode(F.expr(f"transform(sequence(1, size(words) - {seed} + 1), i -> slice(words, i, {seed}))")).alias("gram")).distinct()
    hits = grams.join(item_grams, "gram").select("stamp", "at", "key").distinct()
    pairs = hits.join(stretches, ["stamp", "at"]).groupBy("stamp", "key").agg(F.collect_list(F.struct("at", F.col("run").alias("words"))).alias("runs"))
    return found.select("id", "stamp"), _tiled(pairs.join(items.select("key", "item", "words"), "key"), seed)


def contamination(texts: DataFrame, benchmark: DataFrame, seed: int = SEED, least: float = LEAST_COVERAGE) -> tuple[DataFrame, DataFrame]:
    """(id, stamp) of all texts, and per stamp: coverage of its most covered item, that item, and the items covered enough."""
    stamps, pairs = tiled_pairs(texts, benchmark, seed)
    share = pairs.withColumn("coverage", F.col("tiled") / F.col("item_words"))
    best = share.groupBy("stamp").agg(
        F.max("coverage").alias("coverage"),
        F.max_by("item", F.struct("coverage", -F.coalesce("item", F.lit((1 << 63) - 1)))).alias("item_id"),
        F.sum((F.col("coverage") >= least).cast("long")).alias("n_items"),
    )
    return stamps, best


def _inputs(docs: DataFrame, benchmark: DataFrame, ident: str, text: str, item: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    texts = docs.select(F.col(f"`{ident}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return texts, benchmark.select(F.col(f"`{item}`").cast("bigint").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))


def contaminated(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", least: float = LEAST_COVERAGE) -> DataFrame:
    """One row per document: its id, contaminated, coverage, item_id (most covered, smallest id of equals) and n_items."""
    stamps, best = contamination(*_inputs(docs, benchmark, ident, text, item, item_text), least=least)
    return stamps.join(best, "stamp", "left").select(
        F.col("id").alias(ident),
        F.coalesce(F.col("coverage") >= least, F.lit(False)).alias("contaminated"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        "item_id",
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", least: float = LEAST_COVERAGE) -> DataFrame:
    """The clean documents, with all their columns."""
    _, best = contamination(*_inputs(docs, benchmark, ident, text, item, item_text), least=least)
    rows = packed(docs).withColumn("stamp", F.md5(F.col(f"row.`{text}`").cast("string").cast("binary")))
    return unpacked(rows.join(best.where(F.col("coverage") >= least).select("stamp"), "stamp", "left_anti"))
