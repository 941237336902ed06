"""A third of all order lines on one part, one order and one supplier."""

import shutil
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarterwise.sources import retail

SF = Path(entry.SMOKE_DIR)
TABLES = ("region", "nation", "supplier", "part", "orders")
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.files.openCostInBytes": "1000",
    "spark.sql.files.maxPartitionBytes": "20000",
}

pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture
def skewed(spark, tmp_path):
    for t in TABLES:
        shutil.copy(SF / f"{t}.parquet", tmp_path / f"{t}.parquet")
    hot = F.col("l_linenumber") % 3 == 0
    lines = spark.read.parquet(str(SF / "lineitem.parquet"))
    first = lines.agg(*[F.min(c).alias(c) for c in ("l_partkey", "l_orderkey", "l_suppkey")]).first().asDict()
    lines.withColumns({c: F.when(hot, F.lit(v)).otherwise(F.col(c)) for c, v in first.items()}).repartition(8).write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, value in SETTINGS.items():
        spark.conf.set(k, value)
    yield tmp_path
    for k, value in before.items():
        spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_hot_keys_are_split_and_results_whole(spark, skewed):
    df = retail.financial_records(spark, str(skewed))
    rows = sorted(tuple(r) for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in plan
    assert "partial_sum" in plan

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{skewed}/{t}.parquet'")
    con.execute(f"create view lineitem as select * from '{skewed}/lineitem.parquet/*.parquet'")
    expected = con.execute(entry.oracle_sql()["s7_financial_records"]).fetchall()
    assert rows == sorted(expected)
