"""Company financials derived from an order-line schema.

A supplier is a company, its region the sector, its nation the country; the lines it
shipped in a quarter are its record of that quarter. Money is counted in whole units of
0.0001 (BIGINT), so sums are exact, do not depend on the order of partial aggregates, and
stay in primitive arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A scan dealt out by a key of its rows, if its files give fewer splits than the session has cores.

    A file of few row groups would leave all work on its lines to a few tasks. A table of many files stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores, *keys)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return (
        _table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("company_id"),
            F.col("s_name").alias("company_name"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("country"),
        )
    )


UNITS = 10_000
_LOW_BITS = 20


def _hundredths(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their money measures in units, one row per line.

    No broadcast hint: the part and order sides grow with the data, so Spark picks the
    join from their measured size and splits a hot key's partition at run time.
    """
    revenue = _hundredths("l_extendedprice") * (100 - _hundredths("l_discount"))
    cost = F.col("l_quantity").cast("bigint") * _hundredths("p_retailprice")
    total = _hundredths("o_totalprice") * 100
    return (
        spread(_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_suppkey").alias("company_id"),
            F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("date"),
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
            "l_linestatus",
            revenue.alias("revenue"),
            (cost * 100).alias("expenses"),
            (revenue - cost * 100).alias("profit"),
            (cost * (50 + _hundredths("l_tax"))).alias("operating_cost"),
            total.alias("assets"),
            F.when(F.col("o_orderstatus") != "F", total).otherwise(F.lit(0)).alias("liabilities"),
        )
    )


def financial_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per company and quarter; pre-aggregated before its only wide shuffle."""

    def total(name: str) -> Column:
        # two 64-bit sums, put together once a group: a single one would overflow at some billion lines
        high, low = (F.sum(F.expr(f"{name} {part} {1 << _LOW_BITS}L")).cast("decimal(19,0)") for part in ("div", "%"))
        return ((high * F.lit(1 << _LOW_BITS) + low).cast("double") / UNITS).alias(name)

    measures = ["revenue", "expenses", "profit", "operating_cost", "assets", "liabilities"]
    return lines(spark, sf_dir).groupBy("company_id", "date").agg(*[total(m) for m in measures])
