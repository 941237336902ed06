"""A training corpus from `documents`, stage after stage; each stage's rows are written and read again.

Defined results, beside those of the operators: null and empty texts pass every stage but the last, which
keeps only documents that the mix takes words of. Rows without an id are documents of their own; of copies, one
stays, with or without an id. Ties go to the largest id among exact and to the smallest among near copies. Very
long texts are read whole. Further columns stay, also those with names that the operators use. An empty
table gives an empty corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterwise.llm import decontamination, exact_dedup, mixing, near_dedup, toxicity
from quarterwise.llm.shared import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the score, learned from the labels of two thirds, does not reject."""
    labels = toxicity.fold_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scores(docs, labels).where(F.col("score") < toxicity.REJECT).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the words that it takes of each; those that it takes nothing of go."""
    mixed = mixing.mixed_documents(docs)
    return mixed.where(F.col(mixed.columns[-1]) > 0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Near duplicates and mixing have SQL, the toxicity score and string tiling have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all of `documents`."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
