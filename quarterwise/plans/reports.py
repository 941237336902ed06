"""Report sheets, chart feeds and dashboard cards as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarterwise.functions.scalars import company_caption, first_word, iso_date, percent, quarter_label
from quarterwise.operators.anomaly import anomaly_summary, severe_flags, severity_totals
from quarterwise.operators.features import compute_kpis
from quarterwise.operators.kpi import company_summary, sector_comparison
from quarterwise.operators.reshape import (
    long_metrics,
    renamed,
    with_company,
    with_label,
)
from quarterwise.sources.csv import write_csv

RATIOS = ["profit_margin", "operating_ratio", "expense_ratio", "return_on_assets", "revenue_growth"]

# Column headings of the report sheets and dashboard tables.
SUMMARY_SHEET = {
    "company_name": "Company",
    "sector": "Sector",
    "avg_profit_margin": "Avg Profit Margin %",
    "avg_expense_ratio": "Avg Expense Ratio %",
    "avg_roa": "Avg ROA %",
    "avg_revenue_growth": "Avg Revenue Growth %",
    "total_revenue": "Total Revenue (£k)",
}
KPI_SHEET = {
    "company_name": "Company",
    "date": "Date",
    "revenue": "Revenue (£k)",
    "profit": "Profit (£k)",
    "profit_margin": "Profit Margin %",
    "operating_ratio": "Operating Ratio %",
    "expense_ratio": "Expense Ratio %",
    "return_on_assets": "ROA %",
    "revenue_growth": "Revenue Growth %",
}
SECTOR_SHEET = {
    "sector": "Sector",
    "avg_profit_margin": "Avg Profit Margin %",
    "avg_expense_ratio": "Avg Expense Ratio %",
    "avg_roa": "Avg ROA %",
    "total_revenue": "Total Revenue (£k)",
    "companies": "# Companies",
}
FORECAST_SHEET = {
    "company_name": "Company",
    "forecast_date": "Forecast Date",
    "predicted_revenue": "Predicted Revenue",
    "predicted_profit": "Predicted Profit",
    "lower_bound": "Lower Bound",
    "upper_bound": "Upper Bound",
    "model_used": "Model",
    "mae": "MAE",
    "mape": "MAPE %",
}
FLAG_SHEET = {
    "company_name": "Company",
    "date": "Date",
    "metric": "Metric",
    "value": "Value",
    "z_score": "Z-Score",
    "severity": "Severity",
}
RAW_SHEET = {
    "company_name": "Company",
    "sector": "Sector",
    "date": "Date",
    "revenue": "Revenue",
    "expenses": "Expenses",
    "profit": "Profit",
    "operating_cost": "Operating Cost",
    "assets": "Assets",
    "liabilities": "Liabilities",
}
OVERVIEW_TABLE = {
    "company_name": "Company",
    "sector": "Sector",
    "avg_profit_margin": "Profit Margin %",
    "avg_revenue_growth": "Rev Growth %",
    "total_revenue": "Total Revenue (£k)",
}
HISTORY_TABLE = {
    "company_id": "company_id",
    "date": "date",
    "revenue": "revenue",
    "expenses": "expenses",
    "profit": "profit",
    "profit_margin": "Profit Margin %",
    "operating_ratio": "Op Ratio %",
    "expense_ratio": "Exp Ratio %",
    "return_on_assets": "ROA %",
    "revenue_growth": "Rev Growth %",
}
FORECAST_TABLE = {
    "company_id": "company_id",
    "forecast_date": "Date",
    "predicted_revenue": "Predicted Revenue (£k)",
    "predicted_profit": "Predicted Profit (£k)",
    "lower_bound": "Lower 95% CI",
    "upper_bound": "Upper 95% CI",
    "model_used": "Model",
    "mae": "mae",
    "mape": "mape",
}
FLAG_TABLE = {
    "company_name": "Company",
    "date": "date",
    "metric": "metric",
    "value": "value",
    "z_score": "Z-Score",
    "severity": "Severity",
}
HEATMAP = {
    "profit_margin": "Profit Margin %",
    "operating_ratio": "Operating Ratio %",
    "expense_ratio": "Expense Ratio %",
    "return_on_assets": "ROA %",
}


def _in_percent(kpis: DataFrame) -> DataFrame:
    return kpis.withColumns({c: percent(c) for c in RATIOS})


# Report sheets


def companies_covered(companies: DataFrame) -> DataFrame:
    return companies.select("company_id", company_caption("company_name", "sector", "country").alias("company"))


def top_performers(summary: DataFrame) -> DataFrame:
    """Two cards: best average margin and highest total revenue, from one aggregate. Of equals, the lowest company_id."""

    def best(metric: str) -> Column:
        place = F.struct(F.col(metric).isNotNull(), metric, -F.col("company_id"))
        return F.max_by(F.struct("company_name", "sector", metric), place).alias(metric)

    def card(title: str, company: Column, detail: Column) -> Column:
        return F.struct(F.lit(title).alias("card"), company.alias("company"), detail.alias("detail"))

    top = summary.agg(best("avg_profit_margin"), best("total_revenue"))
    margin, revenue = F.col("avg_profit_margin"), F.col("total_revenue")
    cards = F.array(
        card(
            "Top Performer by Profit Margin",
            company_caption(margin["company_name"], margin["sector"]),
            F.format_string("Profit Margin: %.1f%%", margin["avg_profit_margin"]),
        ),
        card("Highest Revenue", revenue["company_name"], F.format_string("£%.1fM total", revenue["total_revenue"] / 1000)),
    )
    return top.where(margin.isNotNull()).select(F.inline(cards))


def executive_summary(records: DataFrame, companies: DataFrame, kpis: DataFrame | None = None) -> dict[str, DataFrame]:
    summary = company_summary(records, companies, kpis)
    return {"top_performers": top_performers(summary), "summary_table": renamed(summary, SUMMARY_SHEET)}


def kpi_sheet(kpis: DataFrame, companies: DataFrame) -> DataFrame:
    shown = with_company(_in_percent(kpis), companies, "company_name").withColumn("date", iso_date("date"))
    return renamed(shown, KPI_SHEET)


def sector_sheet(records: DataFrame, companies: DataFrame, kpis: DataFrame | None = None) -> DataFrame:
    sectors = sector_comparison(records, companies, kpis)
    return renamed(sectors.withColumn("total_revenue", F.round("total_revenue", 0)), SECTOR_SHEET)


def forecast_sheet(forecasts: DataFrame, companies: DataFrame) -> DataFrame:
    shown = with_company(forecasts, companies, "company_name")
    return renamed(shown.withColumn("forecast_date", iso_date("forecast_date")), FORECAST_SHEET)


def flag_sheet(flags: DataFrame, companies: DataFrame) -> DataFrame:
    shown = with_company(flags, companies, "company_name").withColumn("date", iso_date("date"))
    return renamed(shown, FLAG_SHEET)


def raw_data_sheet(records: DataFrame, companies: DataFrame) -> DataFrame:
    shown = with_company(records, companies, "company_name", "sector").withColumn("date", iso_date("date"))
    return renamed(shown, RAW_SHEET)


def kpi_report(kpis: DataFrame, companies: DataFrame) -> DataFrame:
    """Flat export: every record and KPI column, then name, sector and country."""
    return with_company(kpis, companies, "company_name", "sector", "country").select(
        *kpis.columns, "company_name", "sector", "country"
    )


def report_datasets(
    records: DataFrame, companies: DataFrame, forecasts: DataFrame, flags: DataFrame, kpis: DataFrame | None = None
) -> dict[str, DataFrame]:
    kpis = compute_kpis(records) if kpis is None else kpis
    return {
        "companies_covered": companies_covered(companies),
        **executive_summary(records, companies, kpis),
        "company_kpis": kpi_sheet(kpis, companies),
        "sector_analysis": sector_sheet(records, companies, kpis),
        "forecasts": forecast_sheet(forecasts, companies),
        "anomaly_flags": flag_sheet(flags, companies),
        "raw_financial_data": raw_data_sheet(records, companies),
        "kpi_report": kpi_report(kpis, companies),
    }


def report_order(df: DataFrame) -> list[str]:
    """Company and date columns of a sheet, under whichever of their names it has; rankings bring their own order."""
    names = [c for c in ("company_id", "Company", "company_name") if c in df.columns][:1]
    dates = [c for c in ("date", "Date", "forecast_date", "Forecast Date") if c in df.columns][:1]
    return [*names, *dates] if dates else []


def write_reports(datasets: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One CSV directory per dataset, rows of dated sheets by company and date; its path by name."""
    return {name: write_csv(df, f"{root.rstrip('/')}/{name}", report_order(df)) for name, df in datasets.items()}


# Export of stored datasets


def export_choices(
    records: DataFrame, companies: DataFrame, forecasts: DataFrame, flags: DataFrame
) -> dict[str, DataFrame]:
    return {
        "Financial Records": records,
        "Companies": companies,
        "KPI Results": compute_kpis(records),
        "Forecasts": forecasts,
        "Anomaly Flags": flags,
    }


def export_dataset(choices: dict[str, DataFrame], choice: str, root: str, preview: int = 20) -> tuple[str, DataFrame]:
    """Write the whole dataset as CSV; return its path and the first rows by its key columns."""
    if choice not in choices:
        raise ValueError(f"Unknown dataset '{choice}'. Available: {list(choices)}")
    df = choices[choice]
    path = write_csv(df, f"{root.rstrip('/')}/{choice.lower().replace(' ', '_')}")
    keys = [c for c in ("company_id", "date", "forecast_date", "metric") if c in df.columns]
    return path, df.orderBy(*keys).limit(preview)


# Chart feeds


def revenue_trend(records: DataFrame, companies: DataFrame) -> DataFrame:
    return with_label(records.select("company_id", "date", "revenue"), companies)


def margin_trend(kpis: DataFrame, companies: DataFrame) -> DataFrame:
    points = kpis.select("company_id", "date", (F.col("profit_margin") * 100).alias("profit_margin_pct"))
    return with_label(points, companies)


def latest_breakdown(records: DataFrame) -> DataFrame:
    """Where the latest quarter's money went; empty slices are left out."""
    newest = records.groupBy("company_id").agg(
        F.max("date").alias("date"),
        *[F.max_by(c, "date").alias(c) for c in ("operating_cost", "expenses", "profit")],
    )
    cost = F.greatest("operating_cost", F.lit(0.0))
    slices = {
        "Operating Cost": cost,
        "Other Expenses": F.greatest(F.col("expenses") - cost, F.lit(0.0)),
        "Net Profit": F.greatest("profit", F.lit(0.0)),
    }
    staged = newest.select(
        "company_id", quarter_label("date", " ").alias("quarter"), *[c.alias(name) for name, c in slices.items()]
    ).withColumn("total", sum((F.col(f"`{s}`") for s in slices), start=F.lit(0.0)))
    return (
        long_metrics(staged, ["company_id", "quarter", "total"], list(slices))
        .where(F.col("value") > 0)
        .select(
            "company_id",
            "quarter",
            F.col("metric").alias("slice"),
            F.col("value").alias("amount"),
            F.round(F.col("value") / F.col("total") * 100, 1).alias("share_pct"),
        )
    )


def sector_bars(sectors: DataFrame) -> DataFrame:
    return long_metrics(sectors, ["sector"], ["avg_profit_margin", "avg_expense_ratio"])


def anomaly_timeline(records: DataFrame, flags: DataFrame) -> DataFrame:
    """Revenue of every company, expenses of those with an expense flag, flags marked."""
    lines = long_metrics(records, ["company_id", "date"], ["revenue", "expenses"])
    marks = flags.where(F.col("metric").isin("revenue", "expenses")).select("company_id", "date", "metric", "severity")
    with_expenses = marks.where(F.col("metric") == "expenses").select("company_id", F.lit(True).alias("wanted")).distinct()
    return (
        lines.join(with_expenses, "company_id", "left")
        .where((F.col("metric") == "revenue") | F.col("wanted"))
        .join(marks, ["company_id", "date", "metric"], "left")
        .select("company_id", "date", "metric", "value", F.col("severity").isNotNull().alias("flagged"), "severity")
    )


def kpi_heatmap(snapshot: DataFrame) -> DataFrame:
    cells = snapshot.select(
        "company_id", first_word("company_name").alias("company"), *[F.col(c).alias(n) for c, n in HEATMAP.items()]
    )
    return long_metrics(cells, ["company_id", "company"], list(HEATMAP.values()))


# Dashboard cards and tables


def overview_cards(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "company_id",
        first_word("company_name").alias("company"),
        F.round("profit_margin", 1).alias("margin_pct"),
        F.round("revenue_growth", 1).alias("growth_pct"),
    )


def overview_table(summary: DataFrame) -> DataFrame:
    return renamed(summary, OVERVIEW_TABLE)


def all_companies_table(summary: DataFrame) -> DataFrame:
    return summary.drop("company_id", "quarters")


def next_quarter_card(forecasts: DataFrame) -> DataFrame:
    """First forecast row of each company."""
    w = W.partitionBy("company_id").orderBy("forecast_date")
    return (
        forecasts.withColumn("step", F.row_number().over(w))
        .where(F.col("step") == 1)
        .select("company_id", "forecast_date", "predicted_revenue", "mae", "mape")
    )


def kpi_history(kpis: DataFrame) -> DataFrame:
    return renamed(_in_percent(kpis).withColumn("date", quarter_label("date")), HISTORY_TABLE)


def forecast_table(forecasts: DataFrame) -> DataFrame:
    return renamed(forecasts.withColumn("forecast_date", iso_date("forecast_date")), FORECAST_TABLE)


def flag_table(flags: DataFrame, companies: DataFrame) -> DataFrame:
    return renamed(with_company(flags, companies, "company_name"), FLAG_TABLE)


# Console previews


def summary_preview(summary: DataFrame) -> DataFrame:
    return summary.select("company_name", "sector", "avg_profit_margin", "avg_revenue_growth")


def forecast_preview(forecasts: DataFrame, companies: DataFrame) -> DataFrame:
    shown = with_company(forecasts, companies, "company_name")
    return shown.select("company_name", "forecast_date", "predicted_revenue", "mape")


def anomaly_preview(flags: DataFrame, companies: DataFrame) -> dict[str, DataFrame]:
    return {
        "summary": anomaly_summary(flags, companies),
        "totals": severity_totals(flags),
        "severe": severe_flags(flags),
    }
