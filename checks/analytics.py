"""Summaries, sorts, named SQL, detectors, forecasts and report datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import anomaly_sql, forecast_sql  # noqa: F401  (register their stages)
from checks import inputs as i
from checks.registry import check
from checks.sql import pct, query, rnd
from quarterwise.functions.series import standardised
from quarterwise.operators import anomaly, kpi, reshape
from quarterwise.operators.features import compute_kpis
from quarterwise.operators.forecast import engine, selection
from quarterwise.operators.forecast.accuracy import error_metrics
from quarterwise.operators.forecast.series import future_quarters, training_series, with_folds
from quarterwise.operators.isolation import dominant_metric, isolation_forest_anomalies, isolation_scores
from quarterwise.plans import named_queries, reports
from quarterwise.sources import tables

# Aggregations


def summary(s: SparkSession, d: str) -> DataFrame:
    return kpi.company_summary(i.records(s, d), i.companies(s, d))


def sectors(s: SparkSession, d: str) -> DataFrame:
    return kpi.sector_comparison(i.records(s, d), i.companies(s, d))


def snapshot(s: SparkSession, d: str) -> DataFrame:
    return kpi.latest_kpi_snapshot(i.records(s, d), i.companies(s, d))


def rounded_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("total_revenue", F.round("total_revenue", 2))


_SECTORS = f"select sector, avg_profit_margin, avg_expense_ratio, avg_roa, {rnd('total_revenue', 2)} as total_revenue, companies from sectors"

check("a1_compute_kpis", i.kpis, query("select * from kpis", "kpis"))
check("a2_company_summary", summary, query("select * from summary order by avg_profit_margin desc, company_id", "summary"))
check("a3_sector_comparison", lambda s, d: rounded_revenue(sectors(s, d)), query(_SECTORS, "sectors"))
check("a4_latest_snapshot", snapshot, query("select * from snapshot", "snapshot"))
_ANOMALY_SUMMARY = """select company_id, count(*) as total_flags, count(*) filter (where severity = 'SEVERE') as severe_flags,
  string_agg(distinct metric, ', ' order by metric) as metrics_affected, company_name
  from flags join companies using (company_id) group by company_id, company_name"""
_TOTALS = """select count(*) as total_flags, count(*) filter (where severity = 'SEVERE') as severe_flags,
  count(*) filter (where severity = 'WARNING') as warning_flags from flags"""
_SEVERE = "select company_id, date, metric, value, z_score from flags where severity = 'SEVERE'"
check("a7_anomaly_summary", lambda s, d: anomaly.anomaly_summary(i.flags(s, d), i.companies(s, d)), query(_ANOMALY_SUMMARY, "flags", "companies"))
check("a8_severity_totals", lambda s, d: anomaly.severity_totals(i.flags(s, d)), query(_TOTALS, "flags"))
check("a8_severe_flags", lambda s, d: anomaly.severe_flags(i.flags(s, d)), query(_SEVERE, "flags"))
check("a9_debt_statistics", lambda s, d: anomaly.debt_statistics(i.records(s, d)).select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")),
      query(f"select {rnd('avg(debt)', 6)} as mean, {rnd('stddev_samp(debt)', 6)} as std from debts", "debts"))
_YOY = f"""select c.company_id, c.date, year(c.date) as year, quarter(c.date) as quarter, c.revenue, p.revenue as prev_revenue,
  {rnd('(c.revenue - p.revenue) / nullif(p.revenue, 0)', 4)} as yoy_growth
  from records c left join records p on p.company_id = c.company_id and year(p.date) + 1 = year(c.date) and quarter(p.date) = quarter(c.date)"""
check("a11_kpi_data", lambda s, d: i.analytics(s, d)["kpi_data"], query("select * from kpis", "kpis"))
check("a11_company_summary", lambda s, d: i.analytics(s, d)["company_summary"], query("select * from summary", "summary"))
check("a11_sector_comparison", lambda s, d: rounded_revenue(i.analytics(s, d)["sector_comparison"]), query(_SECTORS, "sectors"))
check("a11_yoy_growth", lambda s, d: i.analytics(s, d)["yoy_growth"], query(_YOY, "records"))
check("a11_latest_snapshot", lambda s, d: i.analytics(s, d)["latest_snapshot"], query("select * from snapshot", "snapshot"))
check("a11_analytics_yoy_coverage", lambda s, d: i.analytics(s, d)["yoy_growth"]
      .groupBy("year").agg(F.count("prev_revenue").alias("compared"), F.count(F.lit(1)).alias("quarters")),
      query("""select year(c.date) as year, count(p.revenue) as compared, count(*) as quarters from records c left join records p
      on p.company_id = c.company_id and year(p.date) + 1 = year(c.date) and quarter(p.date) = quarter(c.date) group by all""", "records"))

# Sorts, top rows, unions

check("o1_sorted_kpis", lambda s, d: i.kpis(s, d).orderBy("company_id", "date"), query("select * from kpis order by company_id, date", "kpis"))
check("o2_sectors_by_revenue", lambda s, d: rounded_revenue(sectors(s, d)).orderBy(F.desc("total_revenue")),
      query(_SECTORS + " order by total_revenue desc", "sectors"))
check("o3_top_margin", lambda s, d: reshape.top_row(summary(s, d), "avg_profit_margin"),
      query("select * from summary order by avg_profit_margin desc, company_id limit 1", "summary"))
check("o3_top_revenue", lambda s, d: reshape.top_row(summary(s, d), "total_revenue"),
      query("select * from summary order by total_revenue desc, company_id limit 1", "summary"))
check("o4_preview", lambda s, d: i.records(s, d).orderBy("company_id", "date").limit(20),
      query("select * from records order by company_id, date limit 20", "records"))
check("o5_union_of_flags", lambda s, d: anomaly.rule_flags(i.records(s, d)).unionByName(isolation_forest_anomalies(i.records(s, d))),
      query("select * from all_flags", "all_flags"))
check("o7_distinct_metrics", lambda s, d: i.flags(s, d).select("metric").distinct(), query("select distinct metric from flags", "flags"))

# Named and free SQL

_JOINED = "from records join companies using (company_id)"
_NAMED_SQL = {
    "top_revenue_companies": query(
        f"""select company_name, sector, {rnd('sum(revenue)', 0)} as total_revenue,
        {rnd('avg(profit / nullif(revenue, 0)) * 100', 2)} as avg_profit_margin_pct {_JOINED} group by company_id, company_name, sector""",
        "records", "companies"),
    "quarterly_revenue_trend": query(
        f"select company_name, date, {rnd('revenue', 0)} as revenue, {rnd('profit', 0)} as profit {_JOINED}", "records", "companies"),
    "expense_ratio_by_quarter": query(
        f"""select company_name, strftime(date, '%Y') as year, {rnd('avg(expenses / nullif(revenue, 0)) * 100', 2)} as avg_expense_ratio_pct
        {_JOINED} group by company_id, company_name, strftime(date, '%Y')""", "records", "companies"),
    "profit_ranking_latest": query(
        f"""select company_name, sector, date, {rnd('profit', 0)} as latest_profit, {rnd('profit / nullif(revenue, 0) * 100', 2)} as profit_margin_pct
        from records r join companies using (company_id) where date = (select max(date) from records l where l.company_id = r.company_id)""",
        "records", "companies"),
    "yoy_growth_window": query(
        f"""select company_name, strftime(date, '%Y') as year, {rnd('sum(revenue)', 0)} as annual_revenue
        {_JOINED} group by company_id, company_name, strftime(date, '%Y')""", "records", "companies"),
}


def _views(s: SparkSession, d: str) -> None:
    i.records(s, d).createOrReplaceTempView("financial_records")
    i.companies(s, d).createOrReplaceTempView("companies")


def _named(name: str):
    def run(s: SparkSession, d: str) -> DataFrame:
        _views(s, d)
        return named_queries.run_named_query(s, name)

    return run


for _n, (_name, _sql) in enumerate(_NAMED_SQL.items(), 1):
    check(f"q{_n}_{_name}", _named(_name), _sql)


def _free(s: SparkSession, d: str) -> DataFrame:
    _views(s, d)
    return named_queries.run_select(
        s, """with m as (select company_id, max(revenue) as peak from financial_records group by company_id)
        select c.country, count(*) as companies, max(m.peak) as peak from m join companies c using (company_id) group by c.country;""")


check("q7_free_select", _free, query(
    """select country, count(*) as companies, max(peak) as peak from (select company_id, max(revenue) as peak from records group by company_id)
    join companies using (company_id) group by country""", "records", "companies"))

# Detectors

check("d1_zscore", lambda s, d: anomaly.zscore_anomalies(i.records(s, d)), query("select * from z_flags", "z_flags"))
check("d2_iqr", lambda s, d: anomaly.iqr_anomalies(i.records(s, d)), query("select * from iqr_flags", "iqr_flags"))
check("d3_isolation_forest", lambda s, d: isolation_forest_anomalies(i.records(s, d)), query("select * from iso_flags", "iso_flags"))
check("d3_flags_per_company", lambda s, d: isolation_forest_anomalies(i.records(s, d)).groupBy("company_id").agg(F.count(F.lit(1)).alias("flags")),
      query("select company_id, count(*) as flags from iso_flags group by company_id", "iso_flags"))
check("d3_path_lengths", lambda s, d: isolation_scores(i.records(s, d)).select("company_id", "date", "path", F.round("score", 9).alias("score")), query(
    f"""select company_id, date, path, {rnd(f"pow(2::double, -(path / ({anomaly_sql.TREES} * {anomaly_sql.usual_depth(f'least(n, {anomaly_sql.SAMPLE})')})::double))", 9)} as score
    from iso_paths""", "iso_paths"))


def _dominant(s: SparkSession, d: str) -> DataFrame:
    metrics = ["revenue", "expenses", "profit", "operating_cost"]
    scored = i.records(s, d).withColumns({f"{m}_z": F.round(F.abs(standardised(m)), 9) for m in metrics})
    top = dominant_metric({m: F.col(f"{m}_z") for m in metrics})
    return scored.select("company_id", "date", top["metric"].alias("metric"), top["value"].alias("value"))


_Z = {m: rnd(f"abs(({m} - avg({m}) over g) / nullif(stddev_pop({m}) over g, 0))", 9) for m in anomaly_sql.Z_METRICS}
check("d4_dominant_metric", _dominant, query(
    f"""select company_id, date, ['revenue', 'expenses', 'profit', 'operating_cost'][k] as metric, [revenue, expenses, profit, operating_cost][k] as value
    from (select *, list_position(zs, list_max(zs)) as k from (select *, [{', '.join(_Z.values())}] as zs
      from records window g as (partition by company_id)))""", "records"))
check("d5_debt_risk", lambda s, d: anomaly.debt_risk_flags(i.records(s, d)), query("select * from debt_flags", "debt_flags"))
check("d6_stored_flags", i.flags, query("select * from flags", "flags"))
check("d6_all_detectors", lambda s, d: anomaly.run_anomaly_detection(i.records(s, d)), query("select * from flags", "flags"))
check("d6_rule_flags", lambda s, d: anomaly.run_anomaly_detection(i.records(s, d), isolation=False), query("select * from kept_rule_flags", "kept_rule_flags"))
check("w9_most_severe", lambda s, d: anomaly.keep_most_severe(
    anomaly.rule_flags(i.records(s, d)).unionByName(isolation_forest_anomalies(i.records(s, d)))), query("select * from flags", "flags"))

# Forecasts, closed form


def _table(s: SparkSession, d: str, *models: str) -> DataFrame:
    return engine.series_models(i.records(s, d), models=models or i.CLOSED, learners=i.LEARNERS)


def _long(models: DataFrame) -> DataFrame:
    """One row per step, rounded for comparison."""
    steps = F.arrays_zip("forecast", "lower", "upper")
    return models.select("company_id", "target", "fold", "model", "label", "mae", "rmse", "mape", F.posexplode(steps).alias("k", "p")).select(
        "company_id", "target", "fold", "model", "label", "mae", "rmse", "mape", (F.col("k") + 1).cast("bigint").alias("step"),
        *[F.round(f"p.{c}", 2).alias(c) for c in ("forecast", "lower", "upper")])


def _model_sql(model: str) -> str:
    return query(
        f"""select company_id, target, fold, model, label, mae, rmse, mape, cast(step as bigint) as step,
        {', '.join(f'{rnd(c, 2)} as {c}' for c in ('forecast', 'lower', 'upper'))} from {model}_model""", f"{model}_model")


check("f2_arima", lambda s, d: _long(_table(s, d, "arima")), _model_sql("arima"))
check("f14_seasonal", lambda s, d: _long(_table(s, d, "seasonal")), _model_sql("seasonal"))
check("f15_polynomial", lambda s, d: _long(_table(s, d, "polynomial")), _model_sql("polynomial"))
check("f16_holt", lambda s, d: _long(_table(s, d, "holt")), _model_sql("holt"))
check("f1_error_metrics", lambda s, d: error_metrics(
          i.records(s, d).withColumn("naive", F.lag("revenue").over(kpi.ordered())).dropna(subset=["naive"]), "revenue", "naive", "company_id"),
      query(f"""select company_id, {rnd('avg(abs(y - f))', 2)} as mae, {rnd('sqrt(avg((y - f) * (y - f)))', 2)} as rmse,
      {rnd('avg(abs((y - f) / nullif(y, 0))) * 100', 2)} as mape
      from (select company_id, revenue as y, lag(revenue) over (partition by company_id order by date) as f from records) where f is not null group by company_id""", "records"))
check("f8_confidence_band", lambda s, d: _long(_table(s, d, "holt")).where("fold = 'full'").select(
          "company_id", "target", "step", F.round(F.col("upper") - F.col("lower"), 1).alias("width")),
      query(f"""select company_id, target, cast(step as bigint) as step, {rnd(f"{rnd('upper', 2)} - {rnd('lower', 2)}", 1)} as width
      from holt_model where fold = 'full'""", "holt_model"))


def _ensembles(s: SparkSession, d: str) -> DataFrame:
    e = selection.with_ensemble(selection.per_series(_table(s, d))).select("company_id", "target", "ensemble.*")
    steps = F.arrays_zip("forecast", "lower", "upper")
    return e.select("company_id", "target", "label", F.round("mape", 4).alias("mape"), F.posexplode(steps).alias("k", "p")).select(
        "company_id", "target", "label", "mape", (F.col("k") + 1).cast("bigint").alias("step"),
        *[F.round(f"p.{c}", 2).alias(c) for c in ("forecast", "lower", "upper")])


check("f9_ensemble", _ensembles, query(
    f"""select company_id, target, label, {rnd('mape', 4)} as mape, cast(step as bigint) as step,
    {', '.join(f'{rnd(c, 2)} as {c}' for c in ('forecast', 'lower', 'upper'))} from ensembles""", "ensembles"))
check("f10_walk_forward", lambda s, d: selection.with_held_out_error(_table(s, d)).where("fold = 'held_out'").select(
          "company_id", "target", "model", F.round("wf_mape", 4).alias("wf_mape")),
      query(f"select company_id, target, model, {rnd('wf_mape', 4)} as wf_mape from held_errors", "held_errors"))
check("f11_winner", lambda s, d: selection.best_forecasts(_table(s, d)).select(
          "company_id", "target", "model_name", "label", F.round("wf_mape", 4).alias("wf_mape")),
      query(f"select company_id, target, model_name, label, {rnd('wf_mape', 4)} as wf_mape from winners where step = 1", "winners"))
check("f11_fair_winner", lambda s, d: selection.best_forecasts(_table(s, d), fair=True).select(
          "company_id", "target", "model_name", F.round("wf_mape", 4).alias("wf_mape")),
      query(f"""select company_id, target, {rnd('s.wf_mape', 4)} as wf_mape,
      case when coalesce(e.wf_mape < case when s.wf_mape = 0 then 9999 else s.wf_mape end * 0.95::double, false) then 'ensemble' else s.model end as model_name
      from singles s left join ensemble_errors e using (company_id, target)""", "singles", "ensemble_errors"))
check("f12_future_quarters", lambda s, d: i.records(s, d).groupBy("company_id").agg(F.max("date").alias("last_date")).select(
          "company_id", F.explode(future_quarters("last_date")).alias("forecast_date")),
      query("""select company_id, cast(date_trunc('quarter', max(date)) + to_months(cast(3 * step as integer)) as date) as forecast_date
      from records, steps group by company_id, step""", "records", "steps"))
check("f13_closed_form_forecasts", i.forecasts, query("select * from forecasts", "forecasts"))

# Forecasts, pooled learners: rows only


def _learner(model: str):
    return lambda s, d: _long(_table(s, d, model))


def _held_out(s: SparkSession, d: str) -> DataFrame:
    """Mean held-out error of each learner and target, beside that of repeating the last value."""
    folds = with_folds(training_series(i.records(s, d))).where("fold = 'held_out'")
    naive = folds.select("company_id", "target", F.expr("transform(actual, a -> element_at(ys, -1))").alias("forecast"), "actual")
    last = selection.with_held_out_error(naive).groupBy("target").agg(F.avg("wf_mape").alias("last_value"))
    compared = i.default_results(s, d)["comparison"].where(F.col("model").isin(*i.LEARNERS))
    return compared.groupBy("target", "model").agg(F.avg("wf_mape").alias("error"), F.count("wf_mape").alias("series")).join(last, "target")


check("f4_random_forest", _learner("random_forest"))
check("f5_gradient_boosting", _learner("gradient_boosting"))
check("f6_kernel_regression", _learner("svr"))
check("f8_learners_held_out", lambda s, d: _held_out(s, d).select("target", "model", "series", (F.col("error") < F.col("last_value")).alias("beats_last_value")),
      query("""select target, model, (select count(*) from (select company_id from records group by company_id having count(*) >= 12)) as series, true as beats_last_value
      from (select unnest(['revenue', 'profit']) as target), (select unnest(['random_forest', 'gradient_boosting', 'svr']) as model)""", "records"))
check("f13_all_forecasts", lambda s, d: engine.run_all_forecasts(i.records(s, d), learners=i.LEARNERS))
check("f13_forecast_shape", lambda s, d: i.default_forecasts(s, d).groupBy("company_id").agg(
          F.count(F.lit(1)).alias("steps"), F.min("forecast_date").alias("first"), F.max("forecast_date").alias("last"),
          F.bool_and(F.expr("lower_bound <= predicted_revenue and predicted_revenue <= upper_bound and predicted_profit is not null and mape >= 0")).alias("sound")),
      query("""select company_id, cast(4 as bigint) as steps, cast(date_trunc('quarter', max(date)) + to_months(3) as date) as first,
      cast(date_trunc('quarter', max(date)) + to_months(12) as date) as last, true as sound from records group by company_id having count(*) >= 8""", "records"))
check("s9_default_forecasts_read", lambda s, d: tables.by_company(i.default_forecasts(s, d), date_column="forecast_date"))
check("f17_default_feed", lambda s, d: i.default_results(s, d)["feed"])
check("f17_default_comparison", lambda s, d: i.default_results(s, d)["comparison"])
check("r5_default_forecast_sheet", lambda s, d: reports.forecast_sheet(i.default_forecasts(s, d), i.companies(s, d)))
check("c9_next_quarter_all_models", lambda s, d: reports.next_quarter_card(i.default_forecasts(s, d)))
check("c11_default_forecast_table", lambda s, d: reports.forecast_table(i.default_forecasts(s, d)))
check("c12_default_forecast_preview", lambda s, d: reports.forecast_preview(i.default_forecasts(s, d), i.companies(s, d)))
check("f17_fitted_and_forecast", lambda s, d: engine.fitted_and_forecast(i.records(s, d), models=i.CLOSED).select(
          "company_id", "model_name", "model", "mae", F.round("mape", 4).alias("mape"), "kind", "date",
          *[F.round(c, 2).alias(c) for c in ("value", "lower", "upper")]),
      query(f"""select company_id, model_name, label as model, mae, {rnd('mape', 4)} as mape, kind, date,
        {', '.join(f'{rnd(c, 2)} as {c}' for c in ('value', 'lower', 'upper'))}
      from feed join (select company_id, model_name, label, mae, mape from winners where target = 'revenue' and step = 1) using (company_id)
      where value is not null""", "feed", "winners"))
check("f17_model_comparison", lambda s, d: engine.model_comparison(_table(s, d)).select(
          "company_id", "target", "model", F.round("mape", 4).alias("mape"), F.round("wf_mape", 4).alias("wf_mape")),
      query(f"""select company_id, target, model, {rnd('m.mape', 4)} as mape, {rnd('wf_mape', 4)} as wf_mape
      from (select * from models where fold = 'full' and step = 1) m join held_errors using (company_id, target, model)
      union all select company_id, target, 'ensemble', {rnd('e.mape', 4)}, {rnd('h.wf_mape', 4)}
      from (select * from ensembles where step = 1) e join ensemble_errors h using (company_id, target)""", "models", "held_errors", "ensembles", "ensemble_errors"))

# Report sheets


def _sheet(mapping: dict[str, str], **changed: str) -> str:
    return ", ".join(f'{changed.get(c, c)} as "{shown}"' for c, shown in mapping.items())


_ISO = "strftime({}, '%Y-%m-%d')"
_PCT = {c: pct(c) for c in reports.RATIOS}


def _summary_fixed(digits: int, x: str) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,15)), {digits}) as decimal(38,{digits}))"


_TOP = f"""select * from (select 'Top Performer by Profit Margin' as card, company_name || ' (' || sector || ')' as company,
  'Profit Margin: ' || {_summary_fixed(1, 'avg_profit_margin')} || '%' as detail from summary order by avg_profit_margin desc, company_id limit 1)
union all select * from (select 'Highest Revenue', company_name, '£' || {_summary_fixed(1, '(total_revenue / 1000)')} || 'M total'
  from summary order by total_revenue desc, company_id limit 1)"""
check("r1_companies_covered", lambda s, d: reports.companies_covered(i.companies(s, d)),
      query("select company_id, company_name || ' (' || sector || ', ' || country || ')' as company from companies", "companies"))
check("r2_top_performers", lambda s, d: reports.top_performers(summary(s, d)), query(_TOP, "summary"))
check("r2_summary_table", lambda s, d: reports.executive_summary(i.records(s, d), i.companies(s, d))["summary_table"],
      query(f"select {_sheet(reports.SUMMARY_SHEET)} from summary", "summary"))
check("r3_kpi_sheet", lambda s, d: reports.kpi_sheet(i.kpis(s, d), i.companies(s, d)),
      query(f"select {_sheet(reports.KPI_SHEET, date=_ISO.format('date'), **_PCT)} from kpis join companies using (company_id)", "kpis", "companies"))
check("r4_sector_sheet", lambda s, d: reports.sector_sheet(i.records(s, d), i.companies(s, d)),
      query(f"select {_sheet(reports.SECTOR_SHEET, total_revenue=rnd('total_revenue', 0))} from sectors", "sectors"))
check("r5_forecast_sheet", lambda s, d: reports.forecast_sheet(i.forecasts(s, d), i.companies(s, d)),
      query(f"select {_sheet(reports.FORECAST_SHEET, forecast_date=_ISO.format('forecast_date'))} from forecasts join companies using (company_id)", "forecasts", "companies"))
check("r6_flag_sheet", lambda s, d: reports.flag_sheet(i.flags(s, d), i.companies(s, d)),
      query(f"select {_sheet(reports.FLAG_SHEET, date=_ISO.format('date'))} from flags join companies using (company_id)", "flags", "companies"))
check("r7_raw_data_sheet", lambda s, d: reports.raw_data_sheet(i.records(s, d), i.companies(s, d)),
      query(f"select {_sheet(reports.RAW_SHEET, date=_ISO.format('date'))} from records join companies using (company_id)", "records", "companies"))

# Chart feeds, cards, tables

check("c1_revenue_trend", lambda s, d: reports.revenue_trend(i.records(s, d), i.companies(s, d)),
      query("select company_id, date, revenue, coalesce(company_name, 'Co ' || company_id) as company from records left join companies using (company_id)", "records", "companies"))
check("c2_margin_trend", lambda s, d: reports.margin_trend(i.kpis(s, d), i.companies(s, d)),
      query("select company_id, date, profit_margin * 100 as profit_margin_pct, coalesce(company_name, 'Co ' || company_id) as company from kpis left join companies using (company_id)", "kpis", "companies"))
check("c3_forecast_band", lambda s, d: engine.fitted_and_forecast(i.records(s, d), models=i.CLOSED).where("kind = 'forecast'").select(
          "company_id", "date", F.round("value", 2).alias("value"), F.round("lower", 2).alias("lower"), F.round("upper", 2).alias("upper"), "model", "mae", "mape"),
      query("select company_id, forecast_date as date, predicted_revenue as value, lower_bound as lower, upper_bound as upper, model_used as model, mae, mape from forecasts", "forecasts"))
check("c4_latest_breakdown", lambda s, d: reports.latest_breakdown(i.records(s, d)), query(
    f"""select company_id, year(date) || ' Q' || quarter(date) as quarter, slice, amount, {rnd('amount / (cost + other + net) * 100', 1)} as share_pct
    from (select *, unnest(['Operating Cost', 'Other Expenses', 'Net Profit']) as slice, unnest([cost, other, net]) as amount
      from (select company_id, date, greatest(operating_cost, 0) as cost, greatest(expenses - greatest(operating_cost, 0), 0) as other,
          greatest(profit, 0) as net, row_number() over (partition by company_id order by date desc) as age from records) where age = 1)
    where amount > 0""", "records"))
check("c5_sector_bars", lambda s, d: reports.sector_bars(sectors(s, d)), query(
    "select sector, unnest(['avg_profit_margin', 'avg_expense_ratio']) as metric, unnest([avg_profit_margin, avg_expense_ratio]) as value from sectors", "sectors"))
check("c6_anomaly_timeline", lambda s, d: reports.anomaly_timeline(i.records(s, d), i.flags(s, d)), query(
    """select l.company_id, l.date, l.metric, l.value, f.severity is not null as flagged, f.severity
    from (select company_id, date, 'revenue' as metric, revenue as value from records
      union all select company_id, date, 'expenses', expenses from records
      where company_id in (select company_id from flags where metric = 'expenses')) l
    left join flags f on f.company_id = l.company_id and f.date = l.date and f.metric = l.metric""", "records", "flags"))
check("c7_kpi_heatmap", lambda s, d: reports.kpi_heatmap(snapshot(s, d)), query(
    """select company_id, split_part(company_name, ' ', 1) as company, unnest(['Profit Margin %', 'Operating Ratio %', 'Expense Ratio %', 'ROA %']) as metric,
    unnest([profit_margin, operating_ratio, expense_ratio, return_on_assets]) as value from snapshot""", "snapshot"))
check("c8_overview_cards", lambda s, d: reports.overview_cards(snapshot(s, d)), query(
    f"""select company_id, split_part(company_name, ' ', 1) as company, {rnd('profit_margin', 1)} as margin_pct, {rnd('revenue_growth', 1)} as growth_pct from snapshot""", "snapshot"))
check("c9_next_quarter_card", lambda s, d: reports.next_quarter_card(i.forecasts(s, d)), query(
    """select company_id, forecast_date, predicted_revenue, mae, mape from forecasts
    qualify row_number() over (partition by company_id order by forecast_date) = 1""", "forecasts"))
check("c10_kpi_history", lambda s, d: reports.kpi_history(i.kpis(s, d)), query(
    f"""select {_sheet(reports.HISTORY_TABLE, date="year(date) || '-Q' || quarter(date)", **_PCT)} from kpis""", "kpis"))
check("c11_overview_table", lambda s, d: reports.overview_table(summary(s, d)), query(f"select {_sheet(reports.OVERVIEW_TABLE)} from summary", "summary"))
check("c11_all_companies_table", lambda s, d: reports.all_companies_table(summary(s, d)), query("select * exclude (company_id, quarters) from summary", "summary"))
check("c11_forecast_table", lambda s, d: reports.forecast_table(i.forecasts(s, d)),
      query(f"select {_sheet(reports.FORECAST_TABLE, forecast_date=_ISO.format('forecast_date'))} from forecasts", "forecasts"))
check("c11_flag_table", lambda s, d: reports.flag_table(i.flags(s, d), i.companies(s, d)),
      query(f"select {_sheet(reports.FLAG_TABLE)} from flags join companies using (company_id)", "flags", "companies"))
check("c12_summary_preview", lambda s, d: reports.summary_preview(summary(s, d)),
      query("select company_name, sector, avg_profit_margin, avg_revenue_growth from summary", "summary"))
check("c12_forecast_preview", lambda s, d: reports.forecast_preview(i.forecasts(s, d), i.companies(s, d)),
      query("select company_name, forecast_date, predicted_revenue, mape from forecasts join companies using (company_id)", "forecasts", "companies"))
check("c12_severe_preview", lambda s, d: reports.anomaly_preview(i.flags(s, d), i.companies(s, d))["severe"], query(_SEVERE, "flags"))
