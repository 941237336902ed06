"""Every registered query against its DuckDB text on the smallest data folder."""

import math
from datetime import date
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks.registry import ORACLES, QUERIES

SF = Path(entry.SMOKE_DIR)
TABLES = "region nation customer supplier part orders lineitem".split()
ROWS_ONLY = {
    "f4_random_forest", "f5_gradient_boosting", "f6_kernel_regression", "f13_all_forecasts", "s9_default_forecasts_read",
    "f17_default_feed", "f17_default_comparison", "r5_default_forecast_sheet", "c9_next_quarter_all_models",
    "c11_default_forecast_table", "c12_default_forecast_preview",
}

pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def test_only_the_learned_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert as_rows(df.columns, df.collect()) == as_rows(columns, result.fetchall())


def test_differences_have_a_row_for_every_record(spark, monkeypatch):
    """Also companies of fewer records than a forecast needs, records without a revenue and those without a record before them."""
    from checks import scalars_and_windows

    values = {1: [5.0, 3.0, None, 4.0, 9.5], 2: [7.0], 3: [float(k * k) for k in range(10)]}
    records = spark.createDataFrame([(c, date(2020 + k, 1, 1), v) for c, vs in values.items() for k, v in enumerate(vs)], "company_id bigint, date date, revenue double")
    monkeypatch.setattr(scalars_and_windows.i, "records", lambda s, d: records)
    got = {(r.company_id, r.date.year - 2020): r.change for r in QUERIES["w10_difference"](spark, "").collect()}
    want = {(c, k): None if not k or None in (v, vs[k - 1]) else v - vs[k - 1] for c, vs in values.items() for k, v in enumerate(vs)}
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_free_sql_reads_no_files(spark):
    from quarterwise.plans.named_queries import run_select

    spark.range(1).createOrReplaceTempView("one_row")
    path = f"parquet.`{SF}/region.parquet`"
    for text in (
        f"select * from {path}",
        f"with w as (select * from {path}) select * from w",
        f"select 1 where exists (select * from {path})",
        f"select (select max(r_name) from {path}) as r",
        f"select * from one_row where id in (select r_regionkey from {path})",
    ):
        with pytest.raises(ValueError, match="Only views"):
            run_select(spark, text)
    assert run_select(spark, "select 1 as one").first()["one"] == 1
    assert run_select(spark, "with w as (select id from one_row) select * from w where exists (select 1 from one_row)").count() == 1


def test_named_queries_join_by_company_only(spark):
    from quarterwise.plans.named_queries import NAMED_QUERIES, run_named_query

    spark.sql("select 1L as company_id, 'A' as company_name, 's' as sector, 'UK' as country, 'soon' as date, 0D as revenue, 'x' as y").createOrReplaceTempView("companies")
    spark.sql("select 1L as company_id, date'2020-01-01' as date, 10D as revenue, 5D as profit, 4D as expenses").createOrReplaceTempView("financial_records")
    assert {name: run_named_query(spark, name).count() for name in NAMED_QUERIES} == dict.fromkeys(NAMED_QUERIES, 1)


