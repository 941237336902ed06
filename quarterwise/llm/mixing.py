"""Mixing sources to target weights along a low-discrepancy schedule.

The words of a source, documents in a hashed order, form a stream that is cut into blocks of equal
size. Slot k of the mix has the golden-ratio point frac(k / phi), which falls into one source's
share of the cumulated slots; the source's r-th slot takes the r-th block of its stream, from the
start again when the stream ends. Ranks come from counts of runs of slots, so no source, however
large, is ordered in one task.

Defined results: a null text has size 0 and is never taken; null is a source of its own, the last
one. Sources weigh 1, 2, 3, repeating, by code point. Rows that repeat are documents of their own.
An empty table gives an empty mix; if all sizes are 0, all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterwise.llm.columns import free_names, packed
from quarterwise.llm.shared import cut, let_go

#: Words of a block.
BLOCK_WORDS = 256
#: No source is taken more often than this.
MOST_PASSES = 3
#: 2**32 / golden ratio, rounded to an odd number: k * GOLDEN mod 2**32 are the points.
GOLDEN = 2654435769
#: Slots ranked together.
RUN_BITS = 16
WORD = r"[^\x20\x09-\x0D]+"


def _sized(docs: DataFrame, ident: str, text: str, source: str) -> DataFrame:
    body = F.col(f"row.`{text}`").cast("string")
    named = F.col(f"row.`{ident}`").cast("string")
    return packed(docs).select(
        "row",
        F.col(f"row.`{source}`").alias("source"),
        F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(named, F.concat(F.lit("-"), F.coalesce(body, F.lit("")))).cast("binary")).alias("place"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, number, target) from rows (source, size). The only ordered step sees one row per source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    return (
        by_source.withColumn("number", F.row_number().over(order))
        .withColumn("weight", (F.col("number") - 1) % 3 + 1)
        .withColumn("cap", MOST_PASSES * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("full", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", F.max((F.col("total") - F.col("full")) / F.col("open")).over(Window.partitionBy()))
        .select("source", "source_size", "number", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))
    )


def _known(sized: DataFrame, sources: DataFrame) -> DataFrame:
    return sized.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).withColumn("part", F.substring("place", 1, 4))


def _parts(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """(number, part, part_start): the first word of every part of a source's stream."""
    parts = _known(sized, sources).groupBy("number", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("number", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("part_start"))


def _placed(sized: DataFrame, sources: DataFrame, parts: DataFrame) -> DataFrame:
    """Adds the source's columns and `start`, the document's first word in its source's stream."""
    within = Window.partitionBy("number", "part").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    return _known(sized, sources).withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(parts, ["number", "part"]).withColumn("start", F.col("part_start") + F.col("within"))


def _slots(sources: DataFrame, block: int) -> DataFrame:
    """Adds the words to take and the numbers of blocks and slots to each source."""
    size, words = F.col("source_size"), F.round("target").cast("long")
    blocks = F.ceil(size / block).cast("long")
    rest = words % F.greatest(size, F.lit(1))
    slots = F.when(size == 0, F.lit(0)).otherwise(F.floor(words / F.greatest(size, F.lit(1))) * blocks + F.ceil(rest / block)).cast("long")
    return sources.withColumn("words", words).withColumn("blocks", blocks).withColumn("slots", slots)


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, number, rank, block, at, take): slot after slot, the source, its rank in it, and the words [at, at + take) of the stream."""
    spark = sources.sparkSession
    whole = Window.partitionBy()
    shares = (
        _slots(sources, block)
        .withColumn("all", F.sum("slots").over(whole))
        .withColumn("upto", F.sum("slots").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("low", F.floor((F.col("upto") - F.col("slots")) / F.col("all") * (1 << 32)).cast("long"))
        .withColumn("high", F.floor(F.col("upto") / F.col("all") * (1 << 32)).cast("long"))
        .where("slots > 0")
    )
    count = shares.agg(F.coalesce(F.max("all"), F.lit(0))).first()[0]
    low16, mask = F.expr("id & 65535"), F.lit((1 << 32) - 1)
    high16 = F.expr("shiftright(id, 16) & 65535")
    point = ((high16 * GOLDEN).bitwiseAND(mask) * 65536 + low16 * GOLDEN).bitwiseAND(mask)
    points = spark.range(count).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.shiftright("point", 16))
    cells = shares.select("number", "low", "high", F.explode(F.expr("sequence(shiftright(low, 16), shiftright(high, 16))")).alias("cell"))
    dealt = points.join(cells, "cell").where("point >= low and point < high").select("slot", "number", F.shiftright("slot", RUN_BITS).alias("run"))
    runs = dealt.groupBy("number", "run").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranked = (
        dealt.withColumn("in_run", F.row_number().over(Window.partitionBy("number", "run").orderBy("slot")) - 1)
        .join(runs.select("number", "run", "base"), ["number", "run"])
        .select("slot", "number", (F.col("base") + F.col("in_run")).alias("rank"))
    )
    got = runs.groupBy("number").agg(F.sum("n").alias("got"))
    short = shares.join(got, "number", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < slots")
    late = short.select("number", F.explode(F.expr("sequence(got, slots - 1)")).alias("rank")).select((F.lit(count) + F.col("rank")).alias("slot"), "number", "rank")
    turn, place = F.floor(F.col("rank") / F.col("blocks")).cast("long"), F.col("rank") % F.col("blocks")
    size = F.col("source_size")
    take = F.least(F.lit(block), size - place * block, F.col("words") - turn * size - place * block)
    return (
        ranked.unionByName(late)
        .join(shares.drop("source"), "number")
        .where("rank < slots")
        .select("slot", "number", "rank", place.alias("block"), (place * block).alias("at"), take.alias("take"))
        .where("take > 0")
    )


def _pieces(placed: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """A row for each stretch of a document that a slot takes: slot, number, start (of the document), from and words."""
    parts = placed.where("size > 0").select("number", "start", "size", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block"))
    begin, end = F.greatest("start", "at"), F.least(F.col("start") + F.col("size"), F.col("at") + F.col("take"))
    return parts.join(slots, ["number", "block"]).where(end > begin).select("slot", "number", "start", (begin - F.col("start")).alias("from"), (end - begin).alias("words"))


def mixed_pieces(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: (slot, doc id, from, words), words `from` to `from + words` of the document, in the order of slot and from."""
    sized = _sized(docs, ident, text, source).withColumn("id", F.col(f"row.`{ident}`")).drop("row")
    sources = cut(targets(sized.select("source", "size")))
    placed = _placed(sized, sources, _parts(sized, sources))
    pieces = _pieces(placed, schedule(sources, block), block)
    return pieces.join(placed.where("size > 0").select("number", "start", "id"), ["number", "start"]).select("slot", F.col("id").alias(ident), "from", "words")


def mixed(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK_WORDS) -> DataFrame:
    """Column `row` with the document, and size, source_size, target and taken, its words in the mix with repeats."""
    sized = _sized(docs, ident, text, source)
    # texts are read for their sizes once, and once more for the rows of the result
    narrow = cut(sized.drop("row"))
    sources = cut(targets(narrow.select("source", "size")))
    parts = cut(_parts(narrow, sources))
    light = cut(_placed(narrow, sources, parts).select("number", "start", "size"))
    taken = cut(_pieces(light, schedule(sources, block), block).groupBy("number", "start").agg(F.sum("words").alias("taken")))
    let_go(docs.sparkSession)
    placed = _placed(sized, sources, parts)
    # documents without words share a start with the next one, and none of them is taken
    joined = placed.join(taken.withColumn("some", F.lit(True)), (placed["number"] == taken["number"]) & (placed["start"] == taken["start"]) & (placed["size"] > 0), "left")
    return joined.select("row", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK_WORDS) -> DataFrame:
    """The documents with columns mix_size, mix_target and mix_taken (with underscores before, where a column has the name)."""
    names = free_names(docs, "mix_size", "mix_target", "mix_taken")
    plan = mixed(docs, ident, text, source, block)
    return plan.select("row.*", *[F.col(c).alias(n) for c, n in zip(("size", "target", "taken"), names, strict=True)])
