"""Text blocks for the DuckDB side of the checks."""

from __future__ import annotations

COMPANIES = """companies as (
  select s_suppkey as company_id, s_name as company_name, r_name as sector, n_name as country
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

LINES = """lines as (
  select l_suppkey as company_id, cast(date_trunc('quarter', l_shipdate) as date) as date,
    l_orderkey, l_linenumber, l_returnflag, l_linestatus,
    cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as revenue,
    cast(l_quantity as decimal(6,0)) * cast(p_retailprice as decimal(10,2)) as expenses,
    cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
      - cast(l_quantity as decimal(6,0)) * cast(p_retailprice as decimal(10,2)) as profit,
    cast(l_quantity as decimal(6,0)) * cast(p_retailprice as decimal(10,2))
      * (0.50 + cast(l_tax as decimal(4,2))) as operating_cost,
    cast(o_totalprice as decimal(12,2)) as assets,
    case when o_orderstatus <> 'F' then cast(o_totalprice as decimal(12,2)) else 0 end as liabilities
  from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey)"""

RECORDS = """records as (
  select company_id, date, cast(sum(revenue) as double) as revenue, cast(sum(expenses) as double) as expenses,
    cast(sum(profit) as double) as profit, cast(sum(operating_cost) as double) as operating_cost,
    cast(sum(assets) as double) as assets, cast(sum(liabilities) as double) as liabilities
  from lines group by company_id, date)"""


def rnd(x: str, digits: int) -> str:
    """Half-up rounding of the decimal text of a double, as Spark's round does it."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,15)), {digits}) as double)"


def pct(x: str) -> str:
    return rnd(f"({x}) * 100", 2)


def ratio(a: str, b: str) -> str:
    return rnd(f"{a} / nullif({b}, 0)", 4)


def growth(c: str) -> str:
    return rnd(f"{c} / nullif(lag({c}) over (partition by company_id order by date), 0) - 1", 4)


KPIS = f"""kpis as (
  select *, {ratio('profit', 'revenue')} as profit_margin, {ratio('operating_cost', 'revenue')} as operating_ratio,
    {ratio('expenses', 'revenue')} as expense_ratio, {ratio('profit', 'assets')} as return_on_assets,
    {growth('revenue')} as revenue_growth
  from records)"""


def mean4(c: str) -> str:
    return f"cast(sum(cast({c} as decimal(28,4))) as double) / nullif(count({c}), 0)"


SUMMARY = f"""summary as (
  select company_id, total_revenue, avg_profit_margin, avg_expense_ratio, avg_roa, avg_revenue_growth,
    latest_profit, quarters, company_name, sector, country
  from (select company_id, {rnd('sum(revenue)', 0)} as total_revenue, {pct(mean4('profit_margin'))} as avg_profit_margin,
      {pct(mean4('expense_ratio'))} as avg_expense_ratio, {pct(mean4('return_on_assets'))} as avg_roa,
      {pct(mean4('revenue_growth'))} as avg_revenue_growth,
      {rnd('arg_max(profit, date) filter (where profit is not null)', 0)} as latest_profit,
      count(date) as quarters
    from kpis group by company_id) left join companies using (company_id))"""

SECTORS = f"""sectors as (
  select sector, {pct(mean4('profit_margin'))} as avg_profit_margin, {pct(mean4('expense_ratio'))} as avg_expense_ratio,
    {pct(mean4('return_on_assets'))} as avg_roa, sum(revenue) as total_revenue, count(distinct company_id) as companies
  from kpis left join companies using (company_id) where sector is not null group by sector)"""

_LAST = [
    "date", "revenue", "expenses", "profit", "operating_cost", "assets", "liabilities",
    "profit_margin", "operating_ratio", "expense_ratio", "return_on_assets", "revenue_growth",
]
_SHOWN = _LAST[7:]

SNAPSHOT = f"""snapshot as (
  select company_id, {', '.join(c if c not in _SHOWN else f'{pct(c)} as {c}' for c in _LAST)}, company_name, sector
  from (select company_id, {', '.join(f'arg_max({c}, date) filter (where {c} is not null) as {c}' for c in _LAST)}
    from kpis group by company_id) join companies using (company_id))"""

_STAGES = {
    "companies": (COMPANIES, ()),
    "lines": (LINES, ()),
    "records": (RECORDS, ("lines",)),
    "kpis": (KPIS, ("records",)),
    "summary": (SUMMARY, ("kpis", "companies")),
    "sectors": (SECTORS, ("kpis", "companies")),
    "snapshot": (SNAPSHOT, ("kpis", "companies")),
}


def stage(name: str, text: str, *needs: str) -> None:
    _STAGES[name] = (f"{name} as (\n{text})", needs)


def query(body: str, *needs: str) -> str:
    """A statement with the named stages, and what they need, as CTEs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in _STAGES[name][1]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(_STAGES[n][0] for n in ordered)
    return f"with recursive {ctes}\n{body}" if ctes else body
