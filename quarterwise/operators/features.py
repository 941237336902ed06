"""Ratios, growth and rolling metrics per company and quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.functions.scalars import ratio
from quarterwise.functions.series import growth, trailing_mean, trailing_mean_of_rounded
from quarterwise.operators.validation import clean_financial_records


def compute_kpis(records: DataFrame) -> DataFrame:
    """Four ratios and quarter-on-quarter revenue growth, as fractions to 4 places."""
    return records.withColumns(
        {
            "profit_margin": ratio("profit", "revenue"),
            "operating_ratio": ratio("operating_cost", "revenue"),
            "expense_ratio": ratio("expenses", "revenue"),
            "return_on_assets": ratio("profit", "assets"),
            "revenue_growth": growth("revenue"),
        }
    )


def engineer_features(records: DataFrame) -> DataFrame:
    """The KPI ratios plus leverage, equity and profit growth."""
    return records.withColumns(
        {
            "profit_margin": ratio("profit", "revenue"),
            "operating_ratio": ratio("operating_cost", "revenue"),
            "expense_ratio": ratio("expenses", "revenue"),
            "debt_to_assets": ratio("liabilities", "assets"),
            "return_on_assets": ratio("profit", "assets"),
            "equity": F.round(F.col("assets") - F.col("liabilities"), 2),
            "revenue_growth": growth("revenue"),
            "profit_growth": growth("profit"),
        }
    )


def add_rolling_metrics(features: DataFrame, window: int = 4) -> DataFrame:
    """Trailing means over up to ``window`` rows, from the first row on."""
    means = {m: trailing_mean(m, window) for m in ("revenue", "profit")}
    means["profit_margin"] = trailing_mean_of_rounded("profit_margin", window)
    return features.withColumns({f"{m}_rolling_{window}q": mean for m, mean in means.items()})


def run_preprocessing(records: DataFrame) -> DataFrame:
    """Clean, then features, then rolling metrics; one exchange by company for all windows."""
    return (
        records.transform(clean_financial_records)
        .transform(engineer_features)
        .transform(add_rolling_metrics)
    )
