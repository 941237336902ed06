"""Where intermediate tables go, and bounded helpers for shipping fixed-size tables to tasks."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a filter that tasks get: 8 MB, whatever the data.
FILTER_BITS = 1 << 26
_MAP_BITS = 32768


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that the cluster names; only a local session without one gets a scratch folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="llm-checkpoints-")
    sc.setCheckpointDir(named if "://" in named or not named.startswith(os.sep) else f"file://{named}")


def shared_folder(spark: SparkSession) -> str:
    """The folder under which this session's checkpoints lie; all executors reach it."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


#: Rows of a batch that goes to Python at once: documents are long, and both sides hold whole batches.
BATCH_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows; a smaller setting stays."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder: no lost executor costs more than its tasks, nothing is computed twice."""
    ensure_checkpoint_dir(df.sparkSession)
    small_batches(df.sparkSession)
    return df.checkpoint(eager=True)


def let_go(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nothing refers to any more, as rounds leave them behind `cut`.

    Spark's cleaner learns of them when both collectors have run, by itself every half hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def for_now(spark: SparkSession) -> Iterator[Callable[[object], Broadcast]]:
    """Makes broadcasts that go at the end, with the driver's file of each, which else stays as long as the session.

    What reads them has to be materialised by then.
    """
    made: list[Broadcast] = []

    def ship(value: object) -> Broadcast:
        made.append(spark.sparkContext.broadcast(value))
        return made[-1]

    try:
        yield ship
    finally:
        for held in made:
            held.destroy()


def stored(df: DataFrame) -> DataFrame:
    """As `cut`, but as a Parquet table, whose size the planner knows: a join broadcasts it only under the session's threshold."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_filter(df: DataFrame, value: Column) -> np.ndarray:
    """Bits of FILTER_BITS set at the low bits of a 64-bit column. At most 2,048 bitmaps of 4 KB come back, for any number of rows."""
    small_batches(df.sparkSession)
    at = F.expr(f"value & {FILTER_BITS - 1}L")
    maps = (
        df.select(value.alias("value"))
        .where("value is not null")
        .select((F.shiftright(at, 15)).alias("part"), (at.bitwiseAND(F.lit(_MAP_BITS - 1))).alias("bit"))
        .groupBy("part")
        .agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in maps:
        out[row.part * (_MAP_BITS // 8) :][: len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return out


def in_filter(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which 64-bit values may be in the filter."""
    at = value.astype(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


class Shipped:
    """A value of this package's own types for all tasks, as a broadcast that does not need the package there."""

    def __init__(self, spark: SparkSession, value: object):
        self._held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self) -> dict:
        return {"_held": self._held}

    @property
    def value(self):
        if "_read" not in self.__dict__:
            self._read = cloudpickle.loads(self._held.value)
        return self._read


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows with the largest n, as many steps of 2**(1/16) down as keep them at `most` or fewer.

    The driver sees one row per step, about a thousand at any size; no partition sends its own best rows.
    """
    step = F.floor(16 * F.log2("n"))
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()
    least, taken = None, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        taken += row["rows"]
        if taken > most:
            break
        least = row["step"]
    return counts.limit(0) if least is None else counts.where(step >= least)
