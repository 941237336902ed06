"""Exact duplicates by recipes of content-defined chunks.

A text, with A-Z lower-cased, is cut where a hash of eight bytes says so; equal texts get equal
cuts. A chunk's identifier is a 64-bit fingerprint that is verified: fingerprints which occur more
than once have their contents compared, and only those contents move. Documents are then compared
by their ordered lists of identifiers, a few bytes per kilobyte of text.

Should two contents share a fingerprint, recipes that hold it carry those contents as well, so that
equal recipes always mean equal texts.

Defined results: a null text is the empty text, and all empty texts are equal. Of equal texts the
largest id stays; null ids are smaller than any other. Rows with the same id and equal texts are
one document written twice: all of them count as kept in `copies`, and one of them stays in
`without_copies` (of texts that differ in case, that with the larger md5).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed, unpacked
from quarterwise.llm.shared import bit_filter, cut, for_now, in_filter
from quarterwise.llm.text import LOWER, mixed, slices

#: A cut needs `CUT_BITS` zero bits, so chunks are about 2**CUT_BITS bytes, within these bounds.
CUT_BITS, LEAST_BYTES, MOST_BYTES = 10, 256, 8192
FINGERPRINT_BITS = 64


def _cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all chunks, and for each text the number of its first one."""
    n = len(data)
    if n >= 8:
        eight = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(data).data, strides=(1,))
        natural = np.flatnonzero(mixed(eight) >> np.uint64(64 - CUT_BITS) == 0) + 8
    else:
        natural = np.zeros(0, np.int64)
    ends: list[int] = []
    first = [0]
    at = np.searchsorted(natural, offsets[:-1] + 8).tolist()
    marks = natural.tolist()
    for k, start, end in zip(at, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        while end - start > LEAST_BYTES:
            while k < len(marks) and marks[k] < start + LEAST_BYTES:
                k += 1
            stop = min(marks[k] if k < len(marks) else end, start + MOST_BYTES, end)
            ends.append(stop)
            start = stop
        if end > start:
            ends.append(end)
        first.append(len(ends))
    return np.array(ends, np.int64), np.array(first, np.int64)


def _chunks(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[bytes, list[int], list[int], np.ndarray, np.ndarray]:
    raw = data.tobytes()
    ends, first = _cuts(data, offsets)
    starts = np.zeros(len(ends), np.int64)
    starts[1:] = ends[:-1]
    filled = first[:-1] < first[1:]
    starts[first[:-1][filled]] = offsets[:-1][filled]
    begin, end = starts.tolist(), ends.tolist()
    digest = xxhash.xxh3_64_intdigest
    prints = np.fromiter((digest(raw[a:b]) for a, b in zip(begin, end, strict=True)), np.uint64, len(end)) >> np.uint64(64 - bits)
    return raw, begin, end, prints, first


def _recipes(docs: DataFrame, bits: int, doubtful: Broadcast | None) -> DataFrame:
    """Size, text_sha256, md5 of the text as it is, recipe and, where a fingerprint is doubtful, the contents under it, of rows (id, text)."""
    schema = f"id {docs.schema['id'].dataType.simpleString()}, size bigint, text_sha256 string, raw string, recipe array<bigint>, contents binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            bounds = offsets.tolist()
            given = data.tobytes()
            stamps = [hashlib.md5(given[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            raw, begin, end, prints, first = _chunks(LOWER[data], offsets, bits)
            shas = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            contents = [None] * len(shas)
            if doubtful is not None:
                hit = in_filter(doubtful.value, prints)
                for k in np.flatnonzero(np.add.reduceat(np.append(hit, False), first[:-1]) * (first[:-1] < first[1:])):
                    parts = [raw[begin[j] : end[j]] for j in range(first[k], first[k + 1]) if hit[j]]
                    contents[k] = b"".join(len(p).to_bytes(4, "big") + p for p in parts)
            recipe = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(prints.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(offsets)), pa.array(shas, pa.string()), pa.array(stamps, pa.string()), recipe, pa.array(contents, pa.binary())],
                names=["id", "size", "text_sha256", "raw", "recipe", "contents"],
            )

    return docs.mapInArrow(run, schema)


def _contents(docs: DataFrame, bits: int, repeated: Broadcast) -> DataFrame:
    """(fingerprint, content) of chunks whose fingerprint occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in slices(batches, "text"):
            raw, begin, end, prints, _ = _chunks(LOWER[data], offsets, bits)
            hit = np.flatnonzero(in_filter(repeated.value, prints)).tolist()
            found = {(int(prints[k]), raw[begin[k] : end[k]]) for k in hit}
            keys = np.array([k for k, _ in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([c for _, c in found], pa.binary())], names=["fingerprint", "content"])

    return docs.mapInArrow(run, "fingerprint bigint, content binary")


def chunk_dictionary(docs: DataFrame, text: str = "text", bits: int = FINGERPRINT_BITS) -> DataFrame:
    """(fingerprint, variant, content) of every chunk that occurs more than once; variant counts contents under one fingerprint from 1."""
    from pyspark.sql import Window

    texts = docs.select(F.lit(0).alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    repeated = docs.sparkSession.sparkContext.broadcast(_repeated(_recipes(texts, bits, None)))
    distinct = _contents(texts, bits, repeated).distinct()
    return distinct.withColumn("variant", F.row_number().over(Window.partitionBy("fingerprint").orderBy("content")))


def _repeated(recipes: DataFrame) -> np.ndarray:
    prints = recipes.select(F.explode("recipe").alias("fingerprint"))
    return bit_filter(prints.groupBy("fingerprint").count().where("count > 1"), F.col("fingerprint"))


def _verified(texts: DataFrame, bits: int) -> DataFrame:
    """Recipes in which equal lists (and contents, where there are any) mean equal texts."""
    recipes = cut(_recipes(texts, bits, None))
    with for_now(texts.sparkSession) as ship:
        distinct = _contents(texts, bits, ship(_repeated(recipes))).distinct()
        doubtful = bit_filter(distinct.groupBy("fingerprint").count().where("count > 1"), F.col("fingerprint"))
        return cut(_recipes(texts, bits, ship(doubtful))) if doubtful.any() else recipes


def _grouped(docs: DataFrame, ident: str, text: str, bits: int) -> DataFrame:
    """Recipes of all rows with their group: keep_id and keep_raw of the row that stays, group_size, and keep_rows, its repetitions.

    Two partial aggregates and a join. Its second key, the byte size, has both sides dealt out anew, so that a hot text can be split.
    """
    texts = docs.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    recipes = _verified(texts, bits)
    place = F.struct("id", "raw")
    groups = (
        recipes.groupBy("recipe", "contents", "size", "id", "raw")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(F.col("recipe").alias("group_recipe"), F.col("contents").alias("group_contents"))
        .agg(F.max(place).alias("keep"), F.sum("rows").alias("group_size"), F.max("size").alias("group_bytes"), F.max_by("rows", place).alias("keep_rows"))
    )
    same = F.col("recipe").eqNullSafe(F.col("group_recipe")) & F.col("contents").eqNullSafe(F.col("group_contents")) & (F.col("size") == F.col("group_bytes"))
    return recipes.join(groups, same).select("id", "raw", "text_sha256", F.col("keep.id").alias("keep_id"), F.col("keep.raw").alias("keep_raw"), "group_size", "keep_rows")


def copies(docs: DataFrame, ident: str = "doc_id", text: str = "text", bits: int = FINGERPRINT_BITS) -> DataFrame:
    """One row per document: its id (as `ident`), keep_id, group_size, kept and text_sha256."""
    rows = _grouped(docs, ident, text, bits)
    return rows.select(F.col("id").alias(ident), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text", bits: int = FINGERPRINT_BITS) -> DataFrame:
    """The documents that stay, with all their columns. Texts move once, in the join with the rows to drop."""
    rows = _grouped(docs, ident, text, bits)
    stays = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("raw") == F.col("keep_raw"))
    marked = cut(rows.where(~stays | (F.col("keep_rows") > 1)).select("id", "raw", stays.alias("stays")).distinct())
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    given = packed(docs, own_id=F.col(f"`{ident}`"), own_raw=F.md5(body.cast("binary")))

    def key(side: DataFrame) -> Column:
        return given["own_id"].eqNullSafe(side["id"]) & (given["own_raw"] == side["raw"])

    once = unpacked(given.join(marked, key(marked), "left_anti"))
    twice = marked.where("stays")
    if twice.isEmpty():
        return once
    again = given.join(twice, key(twice), "left_semi").groupBy("own_id", "own_raw").agg(F.first("row").alias("row"))
    return once.unionByName(unpacked(again))
