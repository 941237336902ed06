"""Near duplicates by MinHash with tensored banding, and verification on full shingle sets.

A document's set of shingles gets two small collections, each of `KEYS` keys that combine `ROWS`
minhashes. The tables are all pairs of a key of the first and a key of the second collection:
KEYS**2 tables of 2 * ROWS minhashes for 2 * KEYS * ROWS minhash computations instead of
2 * KEYS**2 * ROWS. Two sets of similarity 0.8 share a bucket of some table with probability
(1 - (1 - 0.8**ROWS)**KEYS)**2 > 0.9996. Keys of the second collection are read only for documents
that share a key of the first with another one.

One bit of every minhash makes a sketch. Nodes of a bucket whose sketches differ in more bits than six
standard deviations above a link's mean (a chance of about one in a billion) are not compared.

Equal sets are one node. In every bucket one node of each component is compared on its full set with
one of another, the bucket's pivot. This runs twice: over the tables of the first FEW keys of both
collections, where each node is a component, then over all tables, where only keys and buckets count
that still join several components. So a family of near copies is contracted by few tables and is a
row or two of a bucket afterwards, however large. Where a bucket then still joins several
components, the nodes that share the bucket's key of the first collection are compared block by block:
a row a node and key, not a row a node and bucket. So pairs are not emitted inside what
is already linked, and no link is given up.

Defined results: A-Z are lower-cased. A null or empty text, or one of white space only, has no
shingle and is alone. A text of fewer words than a shingle has one shingle of all its words. The
component is named by the smallest id in it; null ids are never the smallest, and a component of
null ids only is named null. Rows with one id are one document; if their texts differ, they count
as linked. One document of a component is kept: that with the smallest id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed, unpacked
from quarterwise.llm.components import roots
from quarterwise.llm.shared import bit_filter, cut, for_now, in_filter, let_go
from quarterwise.llm.text import LOWER, distinct_per_text, longs, mixed, slices, windows, word_hashes, words

#: Keys of a collection and minhashes of a key.
KEYS, ROWS = 22, 5
#: Keys of a collection whose tables contract families first.
FEW = 3
#: Orders of nodes by which buckets choose their pivots, so that a large group has several.
ORDERS = 2
#: Nodes of a block where components are compared.
BLOCK = 128
#: Links need intersection >= PERCENT / 100 of the union.
PERCENT = 80
_FACTORS = np.random.default_rng(8).integers(1, 1 << 63, 2 * KEYS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, and where each text's begin."""
    data = LOWER[data]
    w = words(data, offsets)
    values, texts, _ = windows(word_hashes(data, w), w, shingle, short=True)
    values, texts = distinct_per_text(values, texts)
    return values, np.searchsorted(texts, np.arange(len(offsets)))


def _set_id(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _keys(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """2 * KEYS keys for each text that has shingles, and four 64-bit words of bits."""
    starts = first[:-1][first[1:] > first[:-1]]
    out = np.zeros((len(starts), 2 * KEYS), np.uint64)
    bits = np.zeros((len(starts), 256), bool)
    for k, factor in enumerate(_FACTORS):
        least = mixed(np.minimum.reduceat(values * factor, starts)) if len(starts) else np.zeros(0, np.uint64)
        out[:, k // ROWS] = mixed(out[:, k // ROWS] + least + np.uint64(k))
        bits[:, k] = least >> np.uint64(63) > 0
    return out, np.packbits(bits, axis=1).view(np.int64)


def _alike(x: str, y: str, percent: int) -> Column:
    """Whether the sketches of two nodes allow a link."""
    n, differ = 2 * KEYS * ROWS, (1 - percent / 100) / 2
    most = math.floor(n * differ + 6.3 * math.sqrt(n * differ * (1 - differ)))
    apart = " + ".join(f"bit_count({x}[{k}] ^ {y}[{k}])" for k in range(4))
    return F.expr(f"{apart} <= {most}")


def signatures(texts: DataFrame, shingle: int) -> DataFrame:
    """(id, stamp, n_shingles, set_id, first, second, sketch) of (id, text, stamp); set_id is null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            values, first = _sets(data, offsets, shingle)
            counts = np.diff(first)
            filled = np.flatnonzero(counts)
            keys, bits = _keys(values, first)
            place = np.full(len(counts), -1)
            place[filled] = np.arange(len(filled))
            lists = [[], []]
            for half in (0, 1):
                part = keys[:, half * KEYS : (half + 1) * KEYS]
                flat = longs(part.ravel()) if half == 0 else (part.ravel() & np.uint64(0x7FFFFFFF)).astype(np.int32)
                bounds = np.zeros(len(counts) + 1, np.int32)
                np.cumsum((counts > 0) * KEYS, out=bounds[1:])
                lists[half] = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
            ids = [_set_id(values[a:b]) if b > a else None for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            sketch = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((counts > 0) * 4)]), pa.int32()), pa.array(bits.ravel()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(rows.schema.get_field_index("stamp")), pa.array(counts), pa.array(ids, pa.binary()), lists[0], lists[1], sketch],
                names=["id", "stamp", "n_shingles", "set_id", "first", "second", "sketch"],
            )

    return texts.mapInArrow(run, "id bigint, stamp bigint, n_shingles bigint, set_id binary, first array<bigint>, second array<int>, sketch array<bigint>")


def _node() -> Column:
    """A set's node: the smallest id of its documents; sets of null ids only are numbered by their hash."""
    return F.coalesce(F.min("id"), F.xxhash64("set_id").bitwiseOR(F.lit(-(1 << 63))))


def tables(nodes: DataFrame, keys: int = KEYS) -> DataFrame:
    """(bucket, half, node, component, size) in the tables of the first `keys` keys of both collections; half: the bucket's key of the first.

    Keys of the first collection whose nodes are all in one component are left out before their tables are made.
    """
    firsts = nodes.select("node", "component", F.posexplode(F.slice("first", 1, keys)).alias("k", "key"))
    shared = firsts.groupBy("k", "key").agg((F.min("component") < F.max("component")).alias("several")).where("several").select("k", "key")
    hits = firsts.join(shared, ["k", "key"]).select("node", "k", "key")
    second = nodes.select("node", "component", "size", F.slice("second", 1, keys).alias("second"))
    pairs = hits.join(second, "node").select("node", "component", "size", "k", "key", F.posexplode("second").alias("j", "other"))
    return pairs.select("node", "component", "size", F.xxhash64("k", "key").alias("half"), F.xxhash64("k", "key", "j", "other").alias("bucket"))


def buckets(nodes: DataFrame, keys: int = KEYS) -> DataFrame:
    """(bucket, half, component, node, size, pivot): one node of each component in every bucket that holds several, and the bucket's pivot among them. Buckets of the same nodes are one."""
    stamp = F.xxhash64("node")
    first = F.min_by(F.struct("node", "size"), F.xxhash64("node", F.col("bucket") % ORDERS)).alias("first")
    same = (F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(node))").alias("x"), F.sum(stamp.bitwiseAND(F.lit((1 << 32) - 1))).alias("s"))
    held = tables(nodes, keys).groupBy("bucket", "component").agg(first, F.min("half").alias("half"), *same)
    pivot = F.min_by(F.struct("first.node", "component", "first.size"), F.xxhash64("first.node", F.col("bucket") % ORDERS)).alias("pivot")
    kinds = held.groupBy("bucket").agg(F.sum("n").alias("n"), F.expr("bit_xor(x)").alias("x"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("parts"), pivot)
    once = kinds.where("parts > 1").groupBy("n", "x", "s").agg(F.min_by(F.struct("bucket", "pivot"), "bucket").alias("one")).select("one.*")
    return held.join(once, "bucket").select("bucket", "half", "component", "first.node", "first.size", "pivot")


def _packed_texts(texts: DataFrame, wanted: Broadcast, shingle: int) -> DataFrame:
    """(set_id, body): compressed normalised texts of the documents that `wanted` lets through, null ids always."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress

        def chosen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0)
                known = np.asarray(ids.fill_null(0)).astype(np.int64)
                take = in_filter(wanted.value, known) | np.asarray(ids.is_null().to_numpy(zero_copy_only=False))
                yield batch.filter(pa.array(take))

        for rows, data, offsets in slices(chosen(), "text"):
            values, first = _sets(data, offsets, shingle)
            raw, bounds = LOWER[data].tobytes(), offsets.tolist()
            keys = [_set_id(values[a:b]) if b > a else None for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            bodies = [pack(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(keys, pa.binary()), pa.array(bodies, pa.binary())], names=["id", "set_id", "body"])

    return texts.mapInArrow(run, "id bigint, set_id binary, body binary").where("set_id is not null")


def _compared(pairs: DataFrame, bodies: DataFrame, shingle: int) -> DataFrame:
    """(a, b, common, together) of pairs (a, b) of nodes: sizes of intersection and union of the full sets."""
    left = bodies.select(F.col("node").alias("a"), F.col("body").alias("x"))
    right = bodies.select(F.col("node").alias("b"), F.col("body").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = batch.slice(at, 128)
                packs = rows.column(2).to_pylist() + rows.column(3).to_pylist()
                place = {p: k for k, p in enumerate(dict.fromkeys(packs))}
                raw = [unpack(p) for p in place]
                offsets = np.zeros(len(raw) + 1, np.int64)
                np.cumsum([len(r) for r in raw], out=offsets[1:])
                values, first = _sets(np.frombuffer(b"".join(raw), np.uint8), offsets, shingle)
                sets = [values[i:j] for i, j in zip(first[:-1], first[1:], strict=True)]
                n = rows.num_rows
                common = np.zeros(n, np.int64)
                together = np.zeros(n, np.int64)
                for k in range(n):
                    p, q = sets[place[packs[k]]], sets[place[packs[n + k]]]
                    spot = np.searchsorted(q, p)
                    spot[spot == len(q)] = 0
                    common[k] = np.count_nonzero(q[spot] == p)
                    together[k] = len(p) + len(q) - common[k]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(common), pa.array(together)], names=["a", "b", "common", "together"])

    return both.mapInArrow(run, "a bigint, b bigint, common bigint, together bigint")


def _linked(percent: int) -> Column:
    return 100 * F.col("common") >= percent * F.col("together")


def links(texts: DataFrame, nodes: DataFrame, shingle: int, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that connect all nodes which linked pairs of the tables' buckets connect, and no others."""
    named = nodes.withColumn("component", F.col("node"))
    found = compared = None
    for keys in (FEW, KEYS):
        spots = cut(buckets(named, keys))
        let_go(texts.sparkSession)
        first = _compared_stars(spots, compared, texts, nodes, shingle, percent)
        let_go(texts.sparkSession)
        linked = first.where(_linked(percent)).select("a", "b")
        compared = first.select("a", "b")
        named = cut(nodes.join(roots(linked if found is None else found.unionByName(linked)), "node", "left").withColumn("component", F.coalesce("component", "node")))
        # one link of each node stands for all that made its component
        found = named.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        let_go(texts.sparkSession)

    members = cut(open_members(spots, named))
    let_go(texts.sparkSession)
    if members.isEmpty():
        return found
    return found.unionByName(_block_links(members, _bodies(texts, members, nodes, shingle), shingle, percent))


def open_members(spots: DataFrame, named: DataFrame) -> DataFrame:
    """(main, node, component) of the nodes that the stars leave open, `spots` naming components as they were before them.

    They are those that have a key of the first collection in whose buckets several components are left; main is the
    one that is there most. A node is a row a key and not a row a bucket.
    """
    now = named.select(F.col("node").alias("component"), F.col("component").alias("main"))  # an old component is named by one of its nodes
    parts = cut(spots.select("half", "component").join(now, "component").groupBy("half", "main").agg(F.count(F.lit(1)).alias("n")))
    still = parts.groupBy("half").agg(F.max_by("main", F.struct("n", "main")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    # components that meet another there, so that no others come in by the key alone
    meet = parts.select("half", F.col("main").alias("component")).join(still.select("half", "main"), "half")
    firsts = named.select("node", "component", F.posexplode("first").alias("k", "key")).select("node", "component", F.xxhash64("k", "key").alias("half"))
    return firsts.join(meet, ["half", "component"]).select("main", "node", "component").distinct()


def _compared_stars(spots: DataFrame, done: DataFrame | None, texts: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b, common, together) of the pivots and the other components' nodes in their buckets, but for the pairs that are done."""
    around = spots.where(F.col("component") != F.col("pivot.component")).where(100 * F.least("size", "pivot.size") >= percent * F.greatest("size", "pivot.size"))
    stars = around.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct()
    sketches = nodes.select("node", "sketch")
    stars = stars.join(sketches.toDF("a", "sketch_a"), "a").join(sketches.toDF("b", "sketch_b"), "b").where(_alike("sketch_a", "sketch_b", percent)).select("a", "b")
    stars = cut(stars if done is None else stars.join(done, ["a", "b"], "left_anti"))
    let_go(texts.sparkSession)
    ends = stars.select(F.explode(F.array("a", "b")).alias("node"))
    return cut(_compared(stars, _bodies(texts, ends, nodes, shingle), shingle))


def _bodies(texts: DataFrame, wanted: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, body) of the wanted nodes: one compressed text of each."""
    with for_now(texts.sparkSession) as ship:
        bits = ship(bit_filter(wanted, F.col("node")))
        bodies = _packed_texts(texts, bits, shingle).join(nodes.select("set_id", "node"), "set_id")
        return cut(bodies.groupBy("node").agg(F.min("body").alias("body")))


def _block_links(members: DataFrame, bodies: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes of different components, of members (main, node, component).

    Around each main component, its own nodes and all others that meet it in a bucket form blocks of
    about BLOCK nodes. Every block of others is compared with every other block; a row is a pair of blocks, never a pair of nodes,
    and one link for each pair of components comes out of it.
    """
    other = (F.col("component") != F.col("main")).alias("other")
    sides = members.select("main", "node", "component", other)
    sizes = sides.groupBy("main", "other").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = sides.join(sizes, ["main", "other"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")))
    rows = dealt.join(bodies, "node").groupBy("main", "other", "block", "blocks").agg(F.collect_list(F.struct("node", "component", "body")).alias("nodes"))
    rows = cut(rows)
    left = rows.where("other").select("main", F.col("block").alias("i"), F.col("nodes").alias("x"))
    right = rows.select("main", "other", F.col("block").alias("j"), F.col("nodes").alias("y"))
    pairs = left.join(right, "main").where("not other or i <= j").select("x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            found: list[tuple[int, int]] = []
            for k in range(batch.num_rows):
                x, y = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                raw = [unpack(n["body"]) for n in x + y]
                offsets = np.zeros(len(raw) + 1, np.int64)
                np.cumsum([len(r) for r in raw], out=offsets[1:])
                values, first = _sets(np.frombuffer(b"".join(raw), np.uint8), offsets, shingle)
                common = _intersections(values, first, len(x))
                size = np.diff(first)
                together = size[: len(x), None] + size[None, len(x) :] - common
                cx, cy = np.array([n["component"] for n in x]), np.array([n["component"] for n in y])
                hit = (100 * common >= percent * together) & (cx[:, None] != cy[None, :])
                linked = {(cx[i], cy[j]): (x[i]["node"], y[j]["node"]) for i, j in np.argwhere(hit)}
                found += linked.values()
            ends = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _intersections(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Sizes of the intersections of the first `n` sets with the rest."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    names, place = np.unique(values, return_inverse=True)
    low, high = np.zeros(len(names), bool), np.zeros(len(names), bool)
    low[place[owner < n]] = True
    high[place[owner >= n]] = True
    shared = low & high
    number = np.cumsum(shared) - 1
    keep = shared[place]
    owner, column = owner[keep], number[place[keep]]
    out = np.zeros((n, len(first) - 1 - n), np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        hits = np.zeros((len(first) - 1, 4096), np.float32)
        hits[owner[a:b], column[a:b] - start] = 1
        out += (hits[:n] @ hits[n:].T).astype(np.int64)
    return out


def _classes(texts: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Signatures of all documents, and (set_id, component_id, component_rows) of every set."""
    signed = cut(signatures(texts, shingle))
    filled = signed.where("set_id is not null")
    nodes = filled.groupBy("set_id").agg(_node().alias("node"), F.min("id").alias("least_id"), F.max("n_shingles").alias("size"), F.first("first").alias("first"), F.first("second").alias("second"), F.first("sketch").alias("sketch"))
    nodes = cut(nodes)
    same_id = filled.where("id is not null").groupBy("id").agg((F.min("set_id") < F.max("set_id")).alias("several")).where("several").select("id")
    twice = filled.join(same_id, "id").select("id", "set_id").distinct().join(nodes.select("set_id", "node"), "set_id").select(F.col("id").alias("a"), F.col("node").alias("b"))
    named = roots(links(texts, nodes, shingle, percent).unionByName(twice))
    placed = nodes.join(named, "node", "left").select("set_id", "least_id", "size", F.coalesce("component", "node").alias("component"))
    let_go(texts.sparkSession)
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return signed, placed.join(least, "component").select(F.col("set_id").alias("set"), "component", "component_id", F.col("size").alias("set_size"))


def _texts(docs: DataFrame, ident: str, text: str) -> DataFrame:
    body = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{ident}`").cast("bigint").alias("id"), body.alias("text"), F.xxhash64(body).alias("stamp"))


def near_copies(docs: DataFrame, shingle: int = 5, ident: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: its id (as `ident`), n_shingles, component_id and kept."""
    signed, classes = _classes(_texts(docs, ident, text), shingle, percent)
    # the size is a second key, so both sides are dealt out anew and a hot set can be split
    rows = signed.select("id", "n_shingles", "set_id").join(classes, (F.col("set_id") == F.col("set")) & (F.col("n_shingles") == F.col("set_size")), "left")
    component = F.when(F.col("set_id").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select(F.col("id").alias(ident), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def without_near_copies(docs: DataFrame, shingle: int = 5, ident: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns: the smallest id, then the smallest hash of the text, ids before none.

    Documents without words stay. Rows with one id and one text are one document and stay or go together.
    """
    signed, classes = _classes(_texts(docs, ident, text), shingle, percent)
    named = signed.join(classes, (F.col("set_id") == F.col("set")) & (F.col("n_shingles") == F.col("set_size"))).select("id", "stamp", "component")
    place = F.struct(F.col("id").isNull(), "id", "stamp")
    stays = named.groupBy("component").agg(F.min(place).alias("stays"))
    drop = named.join(stays, "component").where(~place.eqNullSafe(F.col("stays")))
    drop = drop.select(F.col("id").alias("drop_id"), F.col("stamp").alias("drop_stamp")).distinct()
    rows = packed(docs).withColumns({"id": F.col(f"row.`{ident}`").cast("bigint"), "stamp": F.xxhash64(F.col(f"row.`{text}`").cast("string"))})
    return unpacked(rows.join(drop, F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("stamp") == F.col("drop_stamp")), "left_anti"))
