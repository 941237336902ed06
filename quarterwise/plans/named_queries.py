"""Named SQL over the five table views, and free SELECTs."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterwise.operators.reshape import with_company


def _quarterly(spark: SparkSession) -> DataFrame:
    """Rounded figures of every quarter under the company's name."""
    rounded = [F.round(c).alias(c) for c in ("revenue", "profit")]
    figures = spark.table("financial_records").select("company_id", "date", *rounded)
    named = with_company(figures, spark.table("companies"), "company_name").orderBy("company_id", "date")
    return named.select("company_name", "date", "revenue", "profit")


#: SQL text, or a function of the session. Stored tables may have more columns: joins name theirs.
NAMED_QUERIES: dict[str, str | Callable[[SparkSession], DataFrame]] = {
    # figures per company first, so the join sees one row of each
    "top_revenue_companies": """
        with totals as (
          select company_id, sum(revenue) as income, mean(try_divide(profit, revenue)) as margin
          from financial_records group by company_id)
        select company_name, sector, round(income) as total_revenue, round(100 * margin, 2) as avg_profit_margin_pct
        from totals join companies using (company_id)
        order by income desc""",
    "quarterly_revenue_trend": _quarterly,
    "expense_ratio_by_quarter": """
        with yearly as (
          select company_id, year(date) as y, mean(try_divide(expenses, revenue)) as share
          from financial_records group by all)
        select company_name, cast(yearly.y as string) as year, round(100 * share, 2) as avg_expense_ratio_pct
        from yearly join companies using (company_id)
        order by company_id, yearly.y""",
    # the last rows by a window: one scan and no second aggregate to join with
    "profit_ranking_latest": """
        with dated as (
          select company_id, date, revenue, profit, rank() over (partition by company_id order by date desc) as age
          from financial_records)
        select company_name, sector, dated.date, round(dated.profit) as latest_profit,
          round(100 * try_divide(dated.profit, dated.revenue), 2) as profit_margin_pct
        from dated join companies using (company_id)
        where dated.age = 1
        order by dated.profit desc""",
    "yoy_growth_window": """
        with yearly as (
          select company_id, year(date) as y, sum(revenue) as income
          from financial_records group by all)
        select company_name, cast(yearly.y as string) as year, round(income) as annual_revenue
        from yearly join companies using (company_id)
        order by company_id, yearly.y""",
}


def run_named_query(spark: SparkSession, name: str) -> DataFrame:
    if name not in NAMED_QUERIES:
        raise ValueError(f"Unknown query '{name}'. Available: {list(NAMED_QUERIES)}")
    named = NAMED_QUERIES[name]
    return named(spark) if callable(named) else spark.sql(named)


def relations(spark: SparkSession, query: str) -> list[str]:
    """Names in place of tables in a query, those of subqueries too, as the parser reads them."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query).toString()
    return re.findall(r"UnresolvedRelation \[(.*?)\], \[", plan)


def run_select(spark: SparkSession, query: str) -> DataFrame:
    """Free SQL over the registered views.

    As a derived table the text must be a query: Spark rejects INSERT, DROP and the like. Names of
    several parts are rejected before anything is read, since ``parquet.`path` `` would be a file.
    """
    text = f"select * from (\n{query.strip().rstrip(';')}\n)"
    for name in relations(spark, text):
        if ", " in name:
            raise ValueError(f"Only views can be read, not [{name}].")
    return spark.sql(text)
