"""Projections, windows and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as i
from checks import sql
from checks.registry import check
from checks.sql import growth, pct, query, ratio, rnd
from quarterwise.functions import scalars as x
from quarterwise.functions import series as w
from quarterwise.functions.quantiles import group_quantiles
from quarterwise.operators import kpi, reshape
from quarterwise.operators.features import add_rolling_metrics, engineer_features, run_preprocessing
from quarterwise.operators.forecast.learners import standardised_folds, training_rows
from quarterwise.operators.forecast.series import changes, training_series, with_folds


def keyed(df, **columns):
    return df.select("company_id", "date", *[c.alias(n) for n, c in columns.items()])


def rows(body: str, source: str = "records") -> str:
    return query(f"select company_id, date, {body} from {source}", source)


check("p1_ratios", lambda s, d: keyed(i.records(s, d), profit_margin=x.ratio("profit", "revenue"),
      operating_ratio=x.ratio("operating_cost", "revenue"), expense_ratio=x.ratio("expenses", "revenue")),
      rows(f"{ratio('profit', 'revenue')} as profit_margin, {ratio('operating_cost', 'revenue')} as operating_ratio, {ratio('expenses', 'revenue')} as expense_ratio"))
check("p2_return_on_assets", lambda s, d: keyed(i.records(s, d), return_on_assets=x.ratio("profit", "assets")),
      rows(f"{ratio('profit', 'assets')} as return_on_assets"))
check("p3_debt_to_assets", lambda s, d: keyed(i.records(s, d), debt_to_assets=x.ratio("liabilities", "assets")),
      rows(f"{ratio('liabilities', 'assets')} as debt_to_assets"))
check("p4_equity", lambda s, d: keyed(i.records(s, d), equity=F.round(F.col("assets") - F.col("liabilities"), 2)),
      rows(f"{rnd('assets - liabilities', 2)} as equity"))
check("p5_finite", lambda s, d: keyed(i.records(s, d), leverage=x.finite(
          F.when(F.col("liabilities") > 0.7 * F.col("assets"), float("inf")).otherwise(F.col("liabilities") / F.col("assets")))),
      rows("case when liabilities > 0.7::double * assets then null else liabilities / assets end as leverage"))
check("p6_percent", lambda s, d: keyed(i.kpis(s, d), margin_pct=x.percent("profit_margin")), rows(f"{pct('profit_margin')} as margin_pct", "kpis"))
check("p7_year_quarter", lambda s, d: keyed(i.records(s, d), year=x.year_of("date"), quarter=x.quarter_of("date")),
      rows("year(date) as year, quarter(date) as quarter"))
check("p8_year_text", lambda s, d: keyed(i.records(s, d), year=x.year_text("date")), rows("strftime(date, '%Y') as year"))
check("p9_quarter_label", lambda s, d: keyed(i.records(s, d), dashed=x.quarter_label("date"), spaced=x.quarter_label("date", " ")),
      rows("year(date) || '-Q' || quarter(date) as dashed, year(date) || ' Q' || quarter(date) as spaced"))
check("p10_iso_date", lambda s, d: keyed(i.records(s, d), iso=x.iso_date("date")), rows("strftime(date, '%Y-%m-%d') as iso"))
check("p11_severity", lambda s, d: keyed(i.records(s, d), severity=x.severity(F.col("liabilities") / F.col("assets"), 0.8)),
      rows("case when liabilities / assets > 0.8::double then 'SEVERE' else 'WARNING' end as severity"))
check("p12_company_filter", lambda s, d: reshape.of_company(i.records(s, d), 0, 3),
      query("select * from records where company_id in (0, 3)", "records"))
check("p13_display_names", lambda s, d: reshape.renamed(i.companies(s, d), {"company_name": "Company", "sector": "Sector", "country": "Country"}),
      query('select company_name as "Company", sector as "Sector", country as "Country" from companies', "companies"))
check("p14_first_word", lambda s, d: i.companies(s, d).select("company_id", x.first_word("company_name").alias("short")),
      query("select company_id, split_part(company_name, ' ', 1) as short from companies", "companies"))


def _fixed(v: str, digits: int) -> str:
    return f"cast(round(cast(cast({v} as varchar) as decimal(38,15)), {digits}) as decimal(38,{digits}))"


check("p15_amount_label", lambda s, d: keyed(i.records(s, d), revenue=x.amount_label("revenue"), small=x.amount_label(F.col("profit") / 1000)),
      rows(", ".join(f"""case when abs({v}) >= 1e6 then '£' || {_fixed(f'{v} / 1e6', 1)} || 'M'
      when abs({v}) >= 1e3 then '£' || {_fixed(f'{v} / 1e3', 0)} || 'k' else '£' || {_fixed(v, 0)} end as {n}"""
                     for v, n in (("revenue", "revenue"), ("(profit / 1000)", "small")))))
check("p16_captions", lambda s, d: i.companies(s, d).select(
          "company_id", x.company_caption("company_name", "sector").alias("short"),
          x.company_caption("company_name", "sector", "country").alias("long")),
      query("select company_id, company_name || ' (' || sector || ')' as short, company_name || ' (' || sector || ', ' || country || ')' as long from companies", "companies"))
check("p17_long_metrics", lambda s, d: reshape.long_metrics(i.records(s, d), ["company_id", "date"], ["revenue", "expenses", "profit"]),
      query(" union all ".join(f"select company_id, date, '{m}' as metric, {m} as value from records" for m in ("revenue", "expenses", "profit")), "records"))
check("p18_math", lambda s, d: keyed(
          i.records(s, d), magnitude=F.abs("profit"), root=F.round(F.sqrt("revenue"), 6), square=F.round(F.pow(F.col("profit") / 1000, 2), 4),
          wave=F.round(F.sin(F.quarter("date") * F.lit(1.5)), 9), other=F.round(F.cos(F.quarter("date") * F.lit(1.5)), 9),
          larger=F.greatest("expenses", "profit")),
      rows(f"""abs(profit) as magnitude, {rnd('sqrt(revenue)', 6)} as root, {rnd('pow(profit / 1000, 2)', 4)} as square,
      {rnd('sin(quarter(date) * 1.5::double)', 9)} as wave, {rnd('cos(quarter(date) * 1.5::double)', 9)} as other, greatest(expenses, profit) as larger"""))

_BY = "partition by company_id order by date"
check("w1_revenue_growth", lambda s, d: keyed(i.records(s, d), growth=w.growth("revenue")), rows(f"{growth('revenue')} as growth"))
check("w2_profit_growth", lambda s, d: keyed(i.records(s, d), growth=w.growth("profit")), rows(f"{growth('profit')} as growth"))


def _trailing(c: str) -> str:
    return rnd(f"avg({c}) over ({_BY} rows between 3 preceding and current row)", 2)


_FRAME = f"over ({_BY} rows between 3 preceding and current row)"
_MARGIN = rnd(f"cast(sum(cast(profit_margin as decimal(28,4))) {_FRAME} as double) / nullif(count(profit_margin) {_FRAME}, 0)", 2)
_FEATURES = f"""select company_id, date, revenue, expenses, profit, operating_cost, assets, liabilities,
  {ratio('profit', 'revenue')} as profit_margin, {ratio('operating_cost', 'revenue')} as operating_ratio,
  {ratio('expenses', 'revenue')} as expense_ratio, {ratio('liabilities', 'assets')} as debt_to_assets,
  {ratio('profit', 'assets')} as return_on_assets, {rnd('assets - liabilities', 2)} as equity,
  {growth('revenue')} as revenue_growth, {growth('profit')} as profit_growth from {{source}}"""
_ROLLING = f"""select *, {_trailing('revenue')} as revenue_rolling_4q, {_trailing('profit')} as profit_rolling_4q,
  {_MARGIN} as profit_margin_rolling_4q from ({_FEATURES})"""
check("w3_rolling_metrics", lambda s, d: add_rolling_metrics(engineer_features(i.records(s, d))),
      query(_ROLLING.format(source="records"), "records"))
check("a5_engineer_features", lambda s, d: engineer_features(i.records(s, d)), query(_FEATURES.format(source="records"), "records"))


def _cleaned() -> str:
    from checks.tables_and_cleaning import _CLAMPED

    return f"({_CLAMPED})"


check("a6_preprocessing", lambda s, d: run_preprocessing(i.gaps(s, d)), query(_ROLLING.format(source=_cleaned()), "gaps"))
check("w4_latest_known", lambda s, d: kpi.latest_per_company(i.gaps(s, d)), query(
    "select company_id, " + ", ".join(f"arg_max({c}, date) filter (where {c} is not null) as {c}" for c in
    ("date", "revenue", "expenses", "profit", "operating_cost", "assets", "liabilities")) + " from gaps group by company_id", "gaps"))
check("w5_quarter_card", lambda s, d: kpi.quarter_card(i.kpis(s, d)), query(
    f"""select company_id, date, revenue, {rnd('(revenue - pr) / nullif(pr, 0) * 100', 1)} as revenue_change_pct, profit,
    {rnd('(profit - pp) / greatest(abs(pp), 1) * 100', 1)} as profit_change_pct, {rnd('profit_margin * 100', 1)} as profit_margin_pct,
    {rnd('expense_ratio * 100', 1)} as expense_ratio_pct
    from (select *, coalesce(lag(revenue) over ({_BY}), revenue) as pr, coalesce(lag(profit) over ({_BY}), profit) as pp,
      row_number() over (partition by company_id order by date desc) as age from kpis) where age = 1""", "kpis"))
check("w6_annual_growth", lambda s, d: kpi.annual_growth(i.records(s, d)), query(
    f"""select company_id, year, annual_revenue, {rnd('(annual_revenue - before) / nullif(before, 0)', 4)} as growth
    from (select *, lag(annual_revenue) over (partition by company_id order by year) as before
      from (select company_id, year(date) as year, {rnd('sum(revenue)', 0)} as annual_revenue from records group by all))""", "records"))
check("w7_zscore", lambda s, d: keyed(i.records(s, d), z=F.round(w.standardised("profit"), 3)), rows(
    rnd("(profit - avg(profit) over (partition by company_id)) / nullif(stddev_pop(profit) over (partition by company_id), 0)", 3) + " as z"))
check("w8_quartiles", lambda s, d: i.records(s, d).groupBy("company_id").agg(
          F.percentile("profit", F.lit(0.25)).alias("q1"), F.percentile("profit", F.lit(0.75)).alias("q3"))
      .select("company_id", F.round("q1", 3).alias("q1"), F.round("q3", 3).alias("q3")),
      query(f"select company_id, {rnd('quantile_cont(profit, 0.25)', 3)} as q1, {rnd('quantile_cont(profit, 0.75)', 3)} as q3 from records group by company_id", "records"))
check("w8_group_quantiles", lambda s, d: group_quantiles(i.records(s, d), ["company_id"], "profit", [0.25, 0.75]).select(
          "company_id", F.round(F.col("quantiles")[0], 3).alias("q1"), F.round(F.col("quantiles")[1], 3).alias("q3")),
      query(f"select company_id, {rnd('quantile_cont(profit, 0.25)', 3)} as q1, {rnd('quantile_cont(profit, 0.75)', 3)} as q3 from records group by company_id", "records"))


def _changes(s, d):
    """The change of every record, by the forecasts' own function; a company's first record has none."""
    points = i.records(s, d).groupBy("company_id").agg(F.sort_array(F.collect_list(F.struct("date", "revenue"))).alias("points"))
    own = F.concat(F.array(F.lit(None).cast("double")), changes(F.col("points")["revenue"]))
    return points.select("company_id", F.inline(F.arrays_zip(F.col("points")["date"].alias("date"), own.alias("change"))))


check("w10_difference", _changes, rows(f"revenue - lag(revenue) over ({_BY}) as change"))


def _folds(s, d):
    return with_folds(training_series(i.records(s, d))).where("target = 'revenue' and fold = 'full'")


_T = f"(row_number() over ({_BY}) - 1)"
sql.stage("numbered", f"""  select *, {_T} as t, count(*) over (partition by company_id) as n, avg(revenue) over (partition by company_id) as center,
    stddev_pop(revenue) over (partition by company_id) as scale from records qualify n >= 8""", "records")
sql.stage("standard", "  select *, (revenue - center) / scale as z from numbered", "numbered")
_INPUTS = {**{f"lag{k}": 9 for k in range(1, 5)}, "trail_mean": 9, "trail_std": 9, "season_sin": 9, "season_cos": 9, "time_index": 9, "label": 9}
check("w11_lag_features", lambda s, d: training_rows(standardised_folds(_folds(s, d))).select(
          "company_id", F.col("t").cast("bigint").alias("t"), *[F.round(c, digits).alias(c) for c, digits in _INPUTS.items()]),
      query(f"""select company_id, t, {', '.join(f'{rnd(c, digits)} as {c}' for c, digits in _INPUTS.items())}
      from (select company_id, t, z as label, t / n as time_index, {', '.join(f'lag(z, {k}) over w as lag{k}' for k in range(1, 5))},
        avg(z) over (w rows between 4 preceding and 1 preceding) as trail_mean, stddev_pop(z) over (w rows between 4 preceding and 1 preceding) + 1e-9 / scale as trail_std,
        sin(2 * pi() * (t % 4) / 4) as season_sin, cos(2 * pi() * (t % 4) / 4) as season_cos from standard window w as (partition by company_id order by date))
      where t >= 4""", "standard"))
check("w12_running_sum", lambda s, d: keyed(i.records(s, d), total=F.round(w.running_sum("profit"), 5)),
      rows(rnd(f"sum(profit) over ({_BY} rows unbounded preceding)", 5) + " as total"))
check("w13_standardise", lambda s, d: standardised_folds(_folds(s, d)).select("company_id", "center", "scale", F.posexplode("zs").alias("t", "z")).select(
          "company_id", F.col("t").cast("bigint").alias("t"), F.round("z", 4).alias("z"), F.round(F.col("z") * F.col("scale") + F.col("center"), 5).alias("restored")),
      query(f"select company_id, t, {rnd('z', 4)} as z, {rnd('revenue', 5)} as restored from standard", "standard"))

check("j1_inner_records_companies", lambda s, d: reshape.with_company(i.records(s, d), i.companies(s, d), "company_name", "sector", "country"),
      query("select r.*, company_name, sector, country from records r join companies using (company_id)", "records", "companies"))
check("j2_left_records_companies", lambda s, d: i.with_stranger(i.records(s, d)).join(i.companies(s, d), "company_id", "left"),
      query("select r.*, company_name, sector, country from records_with_stranger r left join companies using (company_id)", "records_with_stranger", "companies"))
check("j3_flags_companies", lambda s, d: reshape.with_company(i.flags(s, d), i.companies(s, d), "company_name"),
      query("select f.*, company_name from flags f join companies using (company_id)", "flags", "companies"))
check("j4_yoy_growth", lambda s, d: kpi.yoy_growth(i.records(s, d)), query(
    f"""select c.company_id, c.date, year(c.date) as year, quarter(c.date) as quarter, c.revenue, p.revenue as prev_revenue,
    {rnd('(c.revenue - p.revenue) / nullif(p.revenue, 0)', 4)} as yoy_growth
    from records c left join records p on p.company_id = c.company_id and year(p.date) + 1 = year(c.date) and quarter(p.date) = quarter(c.date)""", "records"))
check("j5_compare_profit", lambda s, d: kpi.compare_profit(i.records(s, d), 0, 1), query(
    """select coalesce(a.date, b.date) as date, a.profit as profit_co0, b.profit as profit_co1
    from (select * from records where company_id = 0) a full join (select * from records where company_id = 1) b on a.date = b.date""", "records"))
check("j7_flag_points", lambda s, d: reshape.flag_points(i.with_stranger(i.flags(s, d)), i.records(s, d)), query(
    """select f.company_id, f.date, f.metric, severity, case f.metric when 'revenue' then revenue else expenses end as recorded
    from flags_with_stranger f left join records r on r.company_id = f.company_id and r.date = f.date
    where f.metric in ('revenue', 'expenses')""", "flags_with_stranger"))
check("j8_name_or_id", lambda s, d: reshape.with_label(
          i.with_stranger(i.records(s, d)).select("company_id", "date"), i.companies(s, d)),
      query("""select company_id, date, coalesce(company_name, 'Co ' || company_id) as company
      from records_with_stranger left join companies using (company_id)""", "records_with_stranger", "companies"))
