from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quarterwise import schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def quarter(k: int, year: int = 2019) -> dt.date:
    """Start of the k-th quarter from the first of ``year``."""
    return dt.date(year + k // 4, 3 * (k % 4) + 1, 1)


def row(company, date, revenue=100.0, expenses=60.0, profit=40.0, operating_cost=30.0, assets=500.0, liabilities=200.0):
    return (None, company, date, revenue, expenses, profit, operating_cost, assets, liabilities)


@pytest.fixture
def records(spark):
    def make(rows):
        return spark.createDataFrame(rows, schema.FINANCIAL_RECORDS)

    return make


@pytest.fixture
def series(records):
    """Records of companies given as {company: revenue values}; profit is 40 % of revenue."""

    def make(values):
        return records(
            [
                row(c, quarter(k), revenue=v, expenses=0.6 * v, profit=0.4 * v, operating_cost=0.3 * v)
                for c, vs in values.items()
                for k, v in enumerate(map(float, vs))
            ]
        )

    return make


@pytest.fixture
def companies(spark):
    rows = [(0, "Zero Ltd", "Retail", "UK"), (1, "Alpha Corp", "Banking", "UK"), (2, "Beta Group", "Energy", "US")]
    return spark.createDataFrame(rows, schema.COMPANIES)
