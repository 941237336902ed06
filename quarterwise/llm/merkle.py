"""A Merkle manifest of a dataset, and proofs by descent through its content-addressed records.

Every row is a leaf: the digest of its fields. The leaves of a group, in order, are hashed sixteen at a
time until one node is left, the group's subroot; the subroots, in order of their groups, likewise give
the root. What is stored is one record a node, digest to children, level by level; equal nodes are one
record. Nothing in a record tells where its node stands.

A request names a leaf by group and rank. Requests of one block of sixteen leaves travel together, and
what has to be expanded on a level is the set of their blocks' prefixes, so the descent starts with one
row, the root, and no row meets more than sixteen children: a step joins the digests with the records of
that level, follows the wanted digits of the ranks and collects the unselected children as a path
segment. Reversed, the segments are the proof from leaf to root.

Ranks come from a range partitioning by group, order and leaf: rows count inside their partition, and
the driver sees one count a partition. So a group that holds a third of all rows, or most of them, is
ordered by all tasks.

Defined results: null in a field is hashed as `-`, anything else as its UTF-8 byte count, a colon and the
value, so null, empty and joined fields differ. A null group is the first one, a null order value the
first in its group; rows with one order value come in order of their leaves, and rows that repeat get
ranks in any order, which no result shows. A lone leaf is its group's subroot, a lone subroot the root. An
empty table has no root and no proofs. A very long text is hashed whole, in its own row. Further columns
are not hashed unless named, and their names do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed
from quarterwise.llm.shared import parallelism, stored

#: Children of a node; its hexadecimal digit is a child's place.
FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGIT_BITS = 4
_PLACE_BITS = 33


@dataclass(frozen=True)
class Manifest:
    """Leaves (row, tree, height, at, leaf), groups (tree, height, subroot), and the records (digest, children).

    `records[k]` are those of nodes k + 1 levels above the leaves, `top[k]` those k + 1 levels above the subroots.
    `root` has one row (root), or none.
    """

    leaves: DataFrame
    groups: DataFrame
    records: list[DataFrame]
    top: list[DataFrame]
    root: DataFrame


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """`-` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """The rows of a stored frame with their place `at` in the whole order, counted from 0. Ties are dealt over tasks."""
    tasks = parallelism(rows.sparkSession)
    dealt = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    dealt = dealt.repartitionByRange(tasks, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    dealt = stored(dealt.withColumns({"_part": F.spark_partition_id(), "_place": place}))
    sizes = {r["_part"]: r["count"] for r in dealt.groupBy("_part").count().collect()}
    before, starts = 0, []
    for part in range(max(sizes, default=0) + 1):
        starts.append(str(before))
        before += sizes.get(part, 0)
    start = F.get(F.split(F.lit(",".join(starts)), ",").cast("array<bigint>"), F.col("_part"))
    return dealt.withColumn("at", start + F.col("_place")).drop("_part", "_place")


def _height(nodes: Column) -> Column:
    """Levels above so many leaves: the hexadecimal digits of the last one's rank."""
    return F.when(nodes > 1, F.length(F.hex(nodes - 1))).otherwise(F.lit(0))


def _grown(nodes: DataFrame, highest: int) -> tuple[list[DataFrame], DataFrame]:
    """Records of each level above the nodes (tree, height, at, digest), and the node that is left of each tree."""
    records, left = [], nodes.where("height = 0")
    for level in range(1, highest + 1):
        block = F.shiftright("at", _DIGIT_BITS).alias("at")
        run = F.sort_array(F.collect_list(F.struct("at", "digest")))
        grouped = nodes.where(F.col("height") >= level).groupBy("tree", "height", block).agg(run.getField("digest").alias("children"))
        nodes = stored(grouped.withColumn("digest", digest(F.array_join("children", ""))))
        records.append(stored(nodes.groupBy("digest").agg(F.any_value("children").alias("children"))))
        left = left.unionByName(nodes.where(F.col("height") == level).drop("children"))
    return records, left.select("tree", "height", "digest")


def manifest(leaves: DataFrame) -> Manifest:
    """The manifest of rows (row, grp, ord, leaf): `leaf` is a digest, `ord` orders the leaves of a group. More columns stay."""
    placed = ranked(stored(leaves), "grp", "ord", "leaf")
    groups = stored(placed.groupBy("grp").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")))
    groups = ranked(groups, "grp").select("grp", "first", F.col("at").alias("tree"), _height(F.col("rows")).alias("height"))
    highest, trees = groups.agg(F.coalesce(F.max("height"), F.lit(0)), F.count(F.lit(1))).first()
    own = groups.withColumnRenamed("grp", "_grp")
    placed = placed.join(own, F.col("grp").eqNullSafe(F.col("_grp"))).withColumn("at", F.col("at") - F.col("first")).drop("_grp", "grp", "ord", "first")

    records, subroots = _grown(placed.select("tree", "height", "at", F.col("leaf").alias("digest")), highest)
    subroots = stored(subroots)
    above = 0 if trees < 2 else len(f"{trees - 1:x}")
    tops = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.lit(above).alias("height"), F.col("tree").alias("at"), "digest")
    top, root = _grown(tops, above)
    return Manifest(placed, subroots.withColumnRenamed("digest", "subroot"), records, top, root.select(F.col("digest").alias("root")))


def _descended(frontier: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """One level down: the wanted children of the frontier (tree, at, digest, path, ...), with the others on their paths."""
    chosen = frontier.join(records, "digest").select("*", F.posexplode("children").alias("digit", "child"))
    step = {
        "at": F.shiftleft("at", _DIGIT_BITS) + F.col("digit"),
        "path": F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))),
        "digest": F.col("child"),
    }
    return chosen.withColumns(step).drop("children", "digit", "child").join(wanted, ["tree", "at"], "left_semi")


def _segment(children: Column, digit: Column) -> Column:
    """The siblings left and right of a child."""
    return F.struct(
        F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
        F.array_join(F.slice(children, digit + 2, F.lit(FAN)), "").alias("right"),
    )


def _prefixes(blocks: DataFrame, levels: int) -> list[DataFrame]:
    """The distinct (tree, at) of the blocks and of 1 to `levels` digits less."""
    out = [blocks.select("tree", "at").distinct()]
    for _ in range(levels):
        out.append(out[-1].select("tree", F.shiftright("at", _DIGIT_BITS).alias("at")).distinct())
    return out


def proofs(made: Manifest, requests: DataFrame) -> DataFrame:
    """Proofs of the requested leaves: (request, leaf, subroot, root, path).

    A request is (request, tree, at): a payload, the number of its group and the leaf's rank in it, from 0. `path`
    holds (left, right), the joined digests of the siblings on either side, from the leaf's level up to the root's.
    """
    asked = F.struct(F.col("at").bitwiseAND(F.lit(FAN - 1)).alias("digit"), "request")
    blocks = stored(requests.groupBy("tree", F.shiftright("at", _DIGIT_BITS).alias("at")).agg(F.collect_list(asked).alias("asked")))

    trees = blocks.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"))
    wanted = _prefixes(trees, len(made.top))
    empty = F.array().cast("array<struct<left:string,right:string>>")
    frontier = made.root.select(F.lit(0).cast("bigint").alias("tree"), F.lit(0).cast("bigint").alias("at"), F.col("root").alias("digest"), "root", empty.alias("path"))
    for level in range(len(made.top), 0, -1):
        frontier = _descended(frontier, made.top[level - 1], wanted[level - 1])

    # each tree joins the descent on the level of its subroot
    heights = made.groups.select("tree", "height")
    found = frontier.select(F.col("at").alias("tree"), F.lit(0).cast("bigint").alias("at"), "digest", F.col("digest").alias("subroot"), "root", "path")
    found = stored(found.join(heights, "tree"))
    wanted = _prefixes(blocks, max(0, len(made.records) - 1))
    frontier = found.where(F.lit(False))
    for level in range(len(made.records), 0, -1):
        frontier = frontier.unionByName(found.where(F.col("height") == level))
        if level > 1:
            frontier = _descended(frontier, made.records[level - 1], wanted[level - 2])

    many = frontier.join(blocks, ["tree", "at"])
    if made.records:
        many = many.join(made.records[0], "digest")
    else:
        many = many.withColumn("children", F.array("digest"))
    many = many.select("subroot", "root", "path", "children", F.inline("asked"))
    many = many.select(
        "request",
        F.get("children", "digit").alias("leaf"),
        "subroot",
        "root",
        F.reverse(F.concat("path", F.array(_segment(F.col("children"), F.col("digit"))))).alias("path"),
    )
    lone = found.where("height = 0").join(blocks, ["tree", "at"]).select(F.inline("asked"), "digest", "subroot", "root", "path")
    return many.unionByName(lone.select("request", F.col("digest").alias("leaf"), "subroot", "root", F.reverse("path").alias("path")))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf up, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def document_leaves(docs: DataFrame, keep: list[str], fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id", **more: Column) -> DataFrame:
    """Rows for `manifest`: each document's kept columns, group, order and leaf; `more` are columns of `docs` to keep beside."""
    named = {f: F.col(f"`{f}`") for f in fields}
    return packed(docs, keep, grp=F.col(f"`{group}`"), ord=F.col(f"`{order}`"), leaf=leaf_digest(list(named.values())), **more)
