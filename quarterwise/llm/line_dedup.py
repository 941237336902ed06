"""Line dedup over levelled sorted runs of line hashes, in DataFrame operations only.

`LineRuns` holds one row per line key ever seen: its 128-bit hash, the documents that held it when it
was first met, and the largest id of them. Rows lie in runs, bucketed and sorted by hash. A batch of
documents is reduced to its distinct keys (combined before the shuffle) and merge-joined with the live
runs, whose buckets need no shuffle: keys that no run knows (the anti-join) become the batch's own run,
the others are logged as repeats. So runs never share a key. When a level holds `fan` runs they are
merged, bucket by bucket, into one run of the next level. A key joins a run once per level, however
many batches come.

The documents of a key are those of its run and its repeats, again without a shuffle. Keys found often
enough then meet the line hashes of the documents, which were kept in order while the batches were
made; only positions of dropped lines come out of that join, and they move to the texts.

Defined results: a null or empty text is one empty line. Every row is a document, also a repeated one;
rows with one id hold or lose a line together, since a line stays wherever the id is the largest one
that holds it. Null is less than any id: a line that only rows without ids hold stays in all of them.
A key that a document holds several times counts once and loses or keeps all its lines there. Lines of
fewer than `least_chars` code points always stay. A very long text is one row with one hash a line. An
empty table gives an empty result; further columns stay in `row`, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed
from quarterwise.llm.shared import parallelism, shared_folder, stored

LEAST_CHARS = 20
LEAST_DOCS = 3
#: Batches that one call deals its documents into, and runs of a level before they are merged.
BATCHES = 6
FAN = 3

SPACES = "\t\n\x0b\x0c\r "
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class LineRuns:
    """The keys seen so far, in a table of the shared folder. Batches are frames (a, b, docs, top), one row per key."""

    def __init__(self, spark: SparkSession, fan: int = FAN):
        name = uuid.uuid4().hex
        self.spark, self.fan, self.buckets = spark, fan, parallelism(spark)
        self.table, self.path = f"line_runs_{name}", f"{shared_folder(spark)}/line-runs-{name}"
        self.levels: list[list[int]] = []
        self.runs = 0

    def live(self) -> list[int]:
        return [run for level in self.levels for run in level]

    def _rows(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.table).where(F.col("run").isin(runs) & ~F.col("known"))

    def _append(self, rows: DataFrame, level: int) -> None:
        """Write a run; it is live only when all of it is there."""
        rows = rows.select("a", "b", "docs", "top", F.lit(self.runs).alias("run"), "known")
        writer = rows.write.mode("append").partitionBy("run", "known").bucketBy(self.buckets, "a", "b").sortBy("a", "b")
        writer.option("path", self.path).saveAsTable(self.table)
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(self.runs)
        self.runs += 1

    def add(self, keys: DataFrame) -> None:
        """The batch's unknown keys as a run of the first level, the known ones as repeats; full levels are merged."""
        if self.live():
            seen = self._rows(self.live()).select("a", "b", F.lit(True).alias("seen"))
            keys = keys.join(seen, ["a", "b"], "left").withColumn("known", F.coalesce("seen", F.lit(False)))
        else:
            keys = keys.repartition(self.buckets, "a", "b").withColumn("known", F.lit(False))
        self._append(keys, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fan:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        """All runs of a level as one run of the next."""
        old = self.levels[level]
        self._append(_summed(self._rows(old)).withColumn("known", F.lit(False)), level + 1)
        self.levels[level] = []
        files = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for run in old:
            gone = files.Path(f"{self.path}/run={run}/known=false")
            gone.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(gone, True)
        self.spark.catalog.refreshTable(self.table)

    def totals(self) -> DataFrame:
        """(a, b, docs, top) of every key, over its run and its repeats."""
        return _summed(self.spark.table(self.table).where(F.col("known") | F.col("run").isin(self.live())))

    def close(self) -> None:
        """Forget the table; its files stay in the shared folder as checkpoints do."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))


def _hash(value: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds."""
    return [F.xxhash64(value).alias("a"), F.xxhash64(F.lit("second"), value).alias("b")]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(text: Column, least_chars: int = LEAST_CHARS) -> Column:
    """Hashes (a, b) of the keys of all lines in order, null for lines that are too short."""
    bare = F.transform(_lines(text), lambda line: F.translate(F.btrim(line, F.lit(SPACES)), _UPPER, _LOWER))
    return F.transform(bare, lambda key: F.when(F.length(key) >= least_chars, F.struct(*_hash(key))))


def keys(hashed: DataFrame) -> DataFrame:
    """A batch for `LineRuns` from rows (id, hashes): (a, b, docs, top), one row per key."""
    held = hashed.select("id", F.explode(F.array_distinct("hashes")).alias("key")).where("key is not null")
    return held.groupBy(F.col("key.a").alias("a"), F.col("key.b").alias("b")).agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("top"))


def without_repeated_lines(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    keep: list[str] | None = None,
    batches: int = BATCHES,
    fan: int = FAN,
) -> DataFrame:
    """(row, n_lines, n_dropped, kept) of every document: `kept` is the text without the lines that it loses."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = packed(docs, keep, id=F.col(f"`{ident}`"), body=body).select("*", *_hash(F.col("body")))
    marked = rows.select("id", "a", "b", line_hashes(F.col("body"), least_chars).alias("hashes"))
    staged = stored(marked.withColumn("batch", F.pmod("a", F.lit(batches))))

    runs = LineRuns(docs.sparkSession, fan)
    try:
        for batch in range(batches):
            runs.add(keys(staged.where(F.col("batch") == batch)))
        often = stored(runs.totals().where(F.col("docs") >= least_docs))
    finally:
        runs.close()

    # the hashes of a text tell rows without ids apart; equal rows lose the same lines
    line = staged.select("id", F.col("a").alias("text_a"), F.col("b").alias("text_b"), F.posexplode("hashes").alias("at", "key"))
    line = line.where("key is not null").select("*", "key.a", "key.b").drop("key")
    lost = line.join(often, ["a", "b"]).where(~F.col("id").eqNullSafe(F.col("top")))
    lost = stored(lost.groupBy(F.col("text_a").alias("a"), F.col("text_b").alias("b"), "id").agg(F.collect_set("at").alias("dropped")))

    same = (rows.a == lost.a) & (rows.b == lost.b) & rows.id.eqNullSafe(lost.id)
    found = rows.join(lost, same, "left").select("row", "body", "dropped", _lines(F.col("body")).alias("lines"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.array_join(F.transform(stays, lambda at: F.get("lines", at)), "\n")
    return found.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("body")).otherwise(kept).alias("kept"),
    )
