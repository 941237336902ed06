"""Reads, validation and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as i
from checks.registry import check
from checks.sql import pct, query
from quarterwise.operators import validation as v
from quarterwise.operators.features import run_preprocessing
from quarterwise.operators.kpi import kpi_results
from quarterwise.plans.reports import kpi_report
from quarterwise.sources import tables
from quarterwise.sources.retail import lines

check("s5_kpi_results", lambda s, d: kpi_results(i.kpis(s, d)), query(
    "select company_id, date, profit_margin, operating_ratio, revenue_growth, expense_ratio, return_on_assets from kpis", "kpis"))
check("s6_companies_by_id", lambda s, d: tables.companies_by_id(i.companies(s, d)),
      query("select * from companies order by company_id", "companies"))
check("s7_financial_records", lambda s, d: tables.by_company(i.records(s, d)),
      query("select * from records order by company_id, date", "records"))
check("s8_kpi_results_read", lambda s, d: tables.by_company(kpi_results(i.kpis(s, d))), query(
    "select company_id, date, profit_margin, operating_ratio, revenue_growth, expense_ratio, return_on_assets from kpis order by 1, 2", "kpis"))
check("s9_forecast_results_read", lambda s, d: tables.by_company(i.forecasts(s, d), date_column="forecast_date"),
      query("select * from forecasts order by company_id, forecast_date", "forecasts"))
check("s10_anomaly_flags_read", lambda s, d: tables.by_company(i.flags(s, d)),
      query("select * from flags order by company_id, date", "flags"))
check("s11_kpi_report", lambda s, d: kpi_report(i.kpis(s, d), i.companies(s, d)),
      query("select k.*, company_name, sector, country from kpis k join companies using (company_id)", "kpis", "companies"))

_TEXT = ["revenue", "expenses", "profit", "operating_cost", "assets", "liabilities"]
_FIRST = f"""select company_id, date, record_id, {', '.join(_TEXT)} from (
  select *, row_number() over (partition by company_id, date order by record_id nulls first, {', '.join(f'{c} nulls first' for c in _TEXT)}) as pick
  from (select cast(record_id as bigint) as record_id, cast(company_id as bigint) as company_id, cast(date as date) as date,
    {', '.join(_TEXT)} from filings)) where pick = 1"""


def _typed(s, d):
    return v._typed_keys(i.filings(s, d), True)


def _num(c: str) -> str:
    return f"coalesce(try_cast({c} as double), 0) as {c}"


check("v2_first_of_duplicates", lambda s, d: v.drop_duplicate_records(_typed(s, d)), query(_FIRST, "filings"))
check("v3_drop_incomplete", lambda s, d: v.drop_incomplete_records(i.filings(s, d)),
      query("select * from filings where company_id is not null and date is not null and revenue is not null", "filings"))
check("v4_numeric_coercion", lambda s, d: v.coerce_measures(i.filings(s, d)),
      query(f"select record_id, company_id, date, {', '.join(_num(c) for c in _TEXT)} from filings", "filings"))
check("v5_parse_date", lambda s, d: v.parse_date(i.filings(s, d)).select("record_id", "company_id", "date"),
      query("select record_id, company_id, cast(date as date) as date from filings", "filings"))
check("v6_validation_report", lambda s, d: v.validation_report(i.filings(s, d)), query(
    f"""select cast((select count(*) from filings) as bigint) as rows_read, kept as rows_kept,
    cast((select count(*) from filings) - kept as bigint) as rows_dropped
    from (select count(*) as kept from ({_FIRST}) where revenue is not null)""", "filings"))
check("v7_validate_companies",
      lambda s, d: v.validate_companies(
          lines(s, d).join(i.companies(s, d).select("company_id", "company_name"), "company_id").select(
              "company_id", "company_name", F.col("l_returnflag").alias("sector"), F.col("l_linestatus").alias("country"))),
      query("""select company_id, company_name, sector, country from (
        select company_id, company_name, l_returnflag as sector, l_linestatus as country,
          row_number() over (partition by company_id order by company_name, l_returnflag, l_linestatus) as pick
        from lines join companies using (company_id)) where pick = 1""", "lines", "companies"))

_W = "partition by company_id order by date rows between"


def _filled(c: str) -> str:
    return (f"coalesce(last_value({c} ignore nulls) over ({_W} unbounded preceding and current row), "
            f"first_value({c} ignore nulls) over ({_W} current row and unbounded following), 0)")


_FILLED = f"select company_id, date, {', '.join(f'{_filled(c)} as {c}' for c in _TEXT)} from gaps"
_CLAMPED = f"""select company_id, date, revenue, expenses, profit, operating_cost, greatest(assets, 0) as assets,
  greatest(liabilities, 0) as liabilities from ({_FILLED})"""
check("v8_fill_missing", lambda s, d: v.fill_missing_measures(i.gaps(s, d)), query(_FILLED, "gaps"))
check("v9_clamp_balances", lambda s, d: v.clamp_balances(i.gaps(s, d)), query(
    """select company_id, date, revenue, expenses, profit, operating_cost,
    case when assets is null then 0 else greatest(assets, 0) end as assets, greatest(liabilities, 0) as liabilities from gaps""", "gaps"))
check("v10_clean_records", lambda s, d: v.clean_financial_records(i.gaps(s, d)), query(_CLAMPED, "gaps"))
check("v11_validate_records", lambda s, d: v.validate_financial_records(i.filings(s, d)), query(
    f"select company_id, date, record_id, {', '.join(_num(c) for c in _TEXT)} from ({_FIRST}) where revenue is not null", "filings"))
check("a10_row_count", lambda s, d: tables.row_count(i.records(s, d)), query("select count(*) as n from records", "records"))
