"""Fixed table layouts. Column names and order are the public contract of the five tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MEASURES = ["revenue", "expenses", "profit", "operating_cost", "assets", "liabilities"]
RECORD_REQUIRED = ["company_id", "date", *MEASURES]
COMPANY_REQUIRED = ["company_id", "company_name", "sector", "country"]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_LONG, _TEXT, _REAL, _DATE = T.LongType(), T.StringType(), T.DoubleType(), T.DateType()

COMPANIES = _struct(company_id=_LONG, company_name=_TEXT, sector=_TEXT, country=_TEXT)
FINANCIAL_RECORDS = _struct(
    record_id=_LONG, company_id=_LONG, date=_DATE, **{m: _REAL for m in MEASURES}
)
KPI_RESULTS = _struct(
    company_id=_LONG,
    date=_DATE,
    profit_margin=_REAL,
    operating_ratio=_REAL,
    revenue_growth=_REAL,
    expense_ratio=_REAL,
    return_on_assets=_REAL,
)
FORECAST_RESULTS = _struct(
    company_id=_LONG,
    forecast_date=_DATE,
    predicted_revenue=_REAL,
    predicted_profit=_REAL,
    lower_bound=_REAL,
    upper_bound=_REAL,
    model_used=_TEXT,
    mae=_REAL,
    mape=_REAL,
)
ANOMALY_FLAGS = _struct(
    company_id=_LONG, date=_DATE, metric=_TEXT, value=_REAL, z_score=_REAL, severity=_TEXT
)

TABLES: dict[str, T.StructType] = {
    "companies": COMPANIES,
    "financial_records": FINANCIAL_RECORDS,
    "kpi_results": KPI_RESULTS,
    "forecast_results": FORECAST_RESULTS,
    "anomaly_flags": ANOMALY_FLAGS,
}


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Raise on absent columns; a metadata check, no job runs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df
