"""Periodic runs of words: the maximal stretches that repeat with a smallest period, and texts without the repeats.

Periods are searched by octaves p <= q < 2p. A text is exploded into tiles, for each octave into tiles
of at least 16p words that overlap by half; octaves with small p share tiles. Tiles of long texts are
dealt over all tasks; a text that fits in one tile is solved where it is read. Inside a tile every p-th
word is a boundary. A run of period q and at least 4q words holds a boundary c from which at least p
words are equal to those q words on, so the Z-function of the boundary, the length of the common prefix
of the words from c and those from c + q, is at least p there. Equal p-words windows find these (c, q), neighbouring
boundaries with one q are joined, and the Z-values of the last one forward and the first one backward
give the ends. A period that is a multiple of a smaller one of the same words is left out at once.

A fragment is a run's part in one tile. Fragments are shuffled by text and period and stitched where they share q words, which makes
them parts of one run; tiles overlap by more than 3q, so a run's neighbouring fragments always do.

Words are compared by 64-bit hashes, and texts are told apart by 128-bit ones: equal texts are one text
until the end, so copies of a text cost one row a task. At the end only texts whose hash passes a filter
of fixed size, built from those that have runs, move to meet their runs.

Defined results: a null or empty text has no words and no runs. Words are separated by ASCII white space.
Runs are listed by start, then period; two runs may overlap. Rows that repeat, also rows without ids,
get the same result. A text of any length is worked on whole; memory per task is that of its largest
tile, 16p words for the longest period. An empty table gives an empty result; further columns stay in
`row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed
from quarterwise.llm.shared import Shipped, bit_filter, in_filter, parallelism, small_batches, stored
from quarterwise.llm.text import longs, mixed, slices, word_hashes, words

#: A run has at least this many words, and at least so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Words of the smallest tiles.
TILE_WORDS = 1 << 15
#: Entries of a comparison that a task works on at once.
_BLOCK = 1 << 20

RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"
_FRAGMENTS = "a bigint, b bigint, period bigint, start bigint, stop bigint"
#: A fragment, or a tile if it has codes.
_EITHER = pa.schema(
    [(k, pa.int64()) for k in ("a", "b", "period", "start", "stop", "total")] + [(k, pa.int32()) for k in ("low", "high")] + [("codes", pa.binary())]
)
_EITHER_SQL = "a bigint, b bigint, period bigint, start bigint, stop bigint, total bigint, low int, high int, codes binary"


def tiles_of(n: int, least: int) -> Iterator[tuple[int, int, int, int]]:
    """(lowest octave, highest octave, first word, end) of the tiles of a text of n words."""
    top = (n // LEAST_PERIODS).bit_length() - 1
    octave = 0
    while octave <= top:
        size = max(least, 16 << octave)
        if n <= size:
            yield octave, top, 0, n
            return
        high = min(top, max(octave, (size // 16).bit_length() - 1))
        for start in range(0, n - size // 2, size // 2):
            yield octave, high, start, min(n, start + size)
        octave = high + 1


def _exploded(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The tiles of a slice of texts, and which of them hold their whole text."""
    w = words(data, offsets)
    codes = word_hashes(data, w)
    counts = np.diff(w.first)
    found = [(i, t) for i in np.flatnonzero(counts >= LEAST_WORDS) for t in tiles_of(int(counts[i]), least)]
    text = np.array([i for i, _ in found], np.int64)
    low, high, start, stop = np.array([t for _, t in found], np.int64).reshape(-1, 4).T
    ends = np.concatenate([[0], np.cumsum(stop - start) * 8]).astype(np.int64)
    first = w.first[text]
    held = np.concatenate([codes[:0], *[codes[a:b] for a, b in zip(first + start, first + stop)]])
    column = pa.Array.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer(ends), pa.py_buffer(held)])
    marks = [rows.column(rows.schema.get_field_index(k)).take(pa.array(text)) for k in ("a", "b")]
    numbers = [pa.array(x.astype(np.int32)) for x in (low, high)] + [pa.array(x.astype(np.int64)) for x in (start, counts[text])]
    tiles = pa.RecordBatch.from_arrays([*marks, *numbers, column.cast(pa.binary())], names=["a", "b", "low", "high", "start", "total", "codes"])
    return tiles, stop - start == counts[text]


def _explode(least: int):
    """Tiles that hold a whole text are solved at once and leave as fragments, the others as tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "body"):
            tiles, whole = _exploded(rows, data, offsets, least)
            for part in [*_solve([tiles.filter(pa.array(whole))]), tiles.filter(pa.array(~whole))]:
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) if f.name in part.schema.names else pa.nulls(part.num_rows, f.type) for f in _EITHER], schema=_EITHER
                )

    return run


def smallest_factors(n: int) -> np.ndarray:
    """The smallest prime factor of each number up to n."""
    out = np.arange(n + 1)
    for k in range(2, int(n**0.5) + 1):
        if out[k] == k:
            part = out[k * k :: k]
            part[part == np.arange(k * k, n + 1, k)] = k
    return out


def _repeats_within(at: np.ndarray, q: np.ndarray, p: int, window: np.ndarray, half: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Whether the q words at each place repeat with a period that divides q; `window` and `half` name windows of p and p / 2 words."""
    out, rest = np.zeros(len(q), bool), q.copy()
    open_ = np.flatnonzero(rest > 1)
    while len(open_):
        prime = factors[rest[open_]]
        rest[open_] //= prime
        c, d = at[open_], q[open_] // prime
        size = q[open_] - d
        wide = size >= p
        last = size - np.where(wide, p, p // 2)
        equal = np.where(wide, window[c] == window[c + d], half[c] == half[c + d])
        c = c + last
        equal &= np.where(wide, window[c] == window[c + d], half[c] == half[c + d])
        out[open_[equal]] = True
        open_ = open_[(rest[open_] > 1) & ~equal]
    return out


def _extension(codes: np.ndarray, at: np.ndarray, q: np.ndarray, room: np.ndarray, p: int, step: int) -> np.ndarray:
    """How many words from each place on (step 1) or back (step -1) equal those q words later, within `room` and fewer than p."""
    out = np.zeros(len(at), np.int64)
    rows = max(1, _BLOCK // p)
    for a in range(0, len(at), rows):
        part = slice(a, a + rows)
        k = np.arange(p)[None, :]
        inside = k < room[part, None]
        x = np.where(inside, at[part, None] + step * k, 0)
        same = inside & (codes[x] == codes[np.where(inside, x + q[part, None], 0)])
        out[part] = np.where(same.all(1), p, same.argmin(1))
    return out


def fragments(codes: np.ndarray, bounds: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tile, period, first word, end) of the stretches of at least 3 periods in each tile, places counted over all tiles."""
    out: list[tuple[np.ndarray, ...]] = []
    factors = smallest_factors(2 << int(high.max(initial=0)))
    window = half = codes
    for octave in range(int(high.max(initial=-1)) + 1):
        p = 1 << octave
        if octave:
            half, next_ = window, window.copy()
            next_[: max(0, len(codes) - p // 2)] = mixed(window[: len(codes) - p // 2] * np.uint64(0x9E3779B97F4A7C15) + window[p // 2 :])
            window = next_
        place = np.arange(0, len(codes), p)
        tile = np.searchsorted(bounds, place, "right") - 1
        keep = (low[tile] <= octave) & (octave <= high[tile]) & (bounds[tile + 1] - place >= 2 * p)
        place, tile = place[keep], tile[keep]
        hits: list[tuple[np.ndarray, ...]] = []
        for a in range(0, len(place), max(1, _BLOCK // p)):
            c, t = place[a : a + max(1, _BLOCK // p)], tile[a : a + max(1, _BLOCK // p)]
            q = np.arange(p, 2 * p)[None, :]
            inside = c[:, None] + q + p <= bounds[t + 1][:, None]
            at, period = np.nonzero(inside & (window[np.where(inside, c[:, None] + q, 0)] == window[c][:, None]))
            at, tiles, period = c[at], t[at], period + p
            whole = ~_repeats_within(at, period, p, window, half, factors)
            hits.append((period[whole], at[whole], tiles[whole]))
        if not hits:
            continue
        q, c, t = (np.concatenate(x) for x in zip(*hits))
        if not len(q):
            continue
        order = np.lexsort((c, q))
        q, c, t = q[order], c[order], t[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1] + p) | (t[1:] != t[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(q)) - 1
        q, t, begin, end = q[first], t[first], c[first], c[last] + p
        begin = begin - _extension(codes, begin - 1, q, begin - bounds[t], p, -1)
        end = end + _extension(codes, end, q, bounds[t + 1] - q - end, p, 1) + q
        long = end - begin >= 3 * q
        out.append((t[long], q[long], begin[long], end[long]))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches, "codes"):
        low, high, start, total = (rows.column(rows.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in ("low", "high", "start", "total"))
        bounds = offsets // 8
        tile, period, begin, end = fragments(np.frombuffer(data.tobytes(), np.uint64), bounds, low, high)
        length = end - begin
        cut = ((begin == bounds[tile]) & (start[tile] > 0)) | ((end == bounds[tile + 1]) & (start[tile] + end - bounds[tile] < total[tile]))
        keep = cut | (length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period))
        tile, period, length = tile[keep], period[keep], length[keep]
        begin = begin[keep] - bounds[tile] + start[tile]
        a, b = (rows.column(rows.schema.get_field_index(k)).take(pa.array(tile)) for k in ("a", "b"))
        columns = [a, b, *[pa.array(x.astype(np.int64)) for x in (period, begin, begin + length)]]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "period", "start", "stop"])


def stitched(found: DataFrame) -> DataFrame:
    """Whole runs (a, b, period, start, stop) from fragments, in any number of copies, of any tiles."""
    order = Window.partitionBy("a", "b", "period").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") > before - F.col("period"), F.lit(True)).cast("int")
    numbered = found.distinct().withColumn("apart", apart).withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("a", "b", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")
    return runs.where(F.col("stop") - F.col("start") >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period")))


def _collapse(body: pa.Array, runs: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(body.cast(pa.binary()).to_pylist(), runs.to_pylist()):
        kept = text.split()
        if own:
            depth = np.zeros(len(kept) + 1, np.int64)
            np.add.at(depth, [r["start"] + r["period"] for r in own], 1)
            np.add.at(depth, [r["start"] + r["length"] for r in own], -1)
            kept = [kept[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]
        out.append(b" ".join(kept))
    return pa.array(out, pa.binary()).cast(pa.string())


def collapsed(body: str, runs: str) -> Column:
    """The words of a text, joined by one space, without those that repeat earlier ones of a run."""
    return F.arrow_udf(_collapse, "string")(body, runs)


def _marks(body: Column) -> list[Column]:
    return [F.xxhash64(body).alias("a"), F.xxhash64(F.lit("second"), body).alias("b")]


def periodic_runs(docs: DataFrame, text: str | Column = "text", keep: list[str] | None = None, tile_words: int = TILE_WORDS) -> DataFrame:
    """(row, runs, collapsed) of every document: its runs, and its words without the repeats of any run."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col(f"`{text}`") if isinstance(text, str) else text
    body = F.coalesce(text.cast("string"), F.lit(""))
    # a generator: no condition on the text is moved below it and computes the text once more
    rows = packed(docs, keep, made=body).select("row", F.inline(F.array(F.struct(F.col("made").alias("body"), *_marks(F.col("made"))))))

    found = stored(rows.select("a", "b", "body").mapInArrow(_explode(tile_words), _EITHER_SQL))
    tiles = found.where("codes is not null").select("a", "b", "low", "high", "start", "total", "codes")
    solved = tiles.repartition(parallelism(spark)).mapInArrow(_solve, _FRAGMENTS)
    solved = solved.unionByName(found.where("codes is null").select("a", "b", "period", "start", "stop"))
    listed = F.struct("start", "period", (F.col("stop") - F.col("start")).alias("length"))
    runs = stored(stitched(solved).groupBy("a", "b").agg(F.sort_array(F.collect_list(listed)).alias("runs")))

    # most texts have no run and stay where they are
    bits = Shipped(spark, bit_filter(runs, F.col("a")))
    some = F.arrow_udf(lambda a: pa.array(in_filter(bits.value, a.to_numpy(zero_copy_only=False))), "boolean")("a")
    marked = rows.withColumn("some", some)
    without = marked.where(~F.col("some")).withColumn("runs", F.array().cast(RUNS))
    moved = marked.where("some").join(runs.hint("merge"), ["a", "b"], "left").withColumn("runs", F.coalesce("runs", F.array().cast(RUNS)))
    return without.unionByName(moved).select("row", "runs", collapsed("body", "runs").alias("collapsed"))
