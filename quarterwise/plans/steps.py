"""From CSV files to stored tables and reports, in five steps over one table store.

The intermediate result between two steps is a stored table, so each step can run alone
and a lost executor costs at most the step it was in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from quarterwise.operators.anomaly import anomaly_summary, run_anomaly_detection
from quarterwise.operators.features import compute_kpis
from quarterwise.operators.forecast.engine import DEFAULT_MODELS, run_all_forecasts
from quarterwise.operators.forecast.learners import BoostedLearner, Learner
from quarterwise.operators.forecast.series import HORIZON
from quarterwise.operators.kpi import full_analytics, kpi_results
from quarterwise.operators.validation import validate_companies, validate_financial_records
from quarterwise.plans.reports import report_datasets, write_reports
from quarterwise.sources.csv import read_companies, read_records
from quarterwise.sources.tables import TableStore

STEPS = ("ingest", "analytics", "forecast", "anomaly", "report")


def load_csv_data(store: TableStore, companies_path: str, records_path: str) -> dict[str, int]:
    """Validate both files, replace their tables and return the row counts."""
    companies = validate_companies(read_companies(store.spark, companies_path))
    records = validate_financial_records(read_records(store.spark, records_path))
    return {
        "companies": store.write(companies, "companies"),
        "records": store.write(records, "financial_records"),
    }


def run_analytics(store: TableStore) -> dict[str, DataFrame]:
    """Save the KPI table and return the KPI frame with all summaries, from one pass over the records."""
    results = full_analytics(store.read("financial_records"), store.read("companies"))
    store.write(kpi_results(results["kpi_data"]), "kpi_results")
    return results


def save_forecasts(
    store: TableStore,
    horizon: int = HORIZON,
    models: Sequence[str] = DEFAULT_MODELS,
    learners: dict[str, Learner | BoostedLearner] | None = None,
) -> int:
    forecasts = run_all_forecasts(store.read("financial_records"), horizon, models, learners)
    return store.write(forecasts, "forecast_results")


def save_anomaly_flags(store: TableStore) -> DataFrame:
    """Save the flags and return their summary by company."""
    store.write(run_anomaly_detection(store.read("financial_records")), "anomaly_flags")
    return anomaly_summary(store.read("anomaly_flags"), store.read("companies"))


def save_reports(store: TableStore, reports_root: str) -> dict[str, str]:
    records = store.read("financial_records")
    kpis = compute_kpis(records).persist()
    try:
        datasets = report_datasets(
            records, store.read("companies"), store.read("forecast_results"), store.read("anomaly_flags"), kpis
        )
        return write_reports(datasets, reports_root)
    finally:
        kpis.unpersist()


def run_steps(
    store: TableStore,
    companies_path: str,
    records_path: str,
    reports_root: str,
    steps: Sequence[str] = STEPS,
    **forecast_options,
) -> dict[str, object]:
    """Run the chosen steps in their order; the first failure stops the run."""
    unknown = [s for s in steps if s not in STEPS]
    if unknown:
        raise ValueError(f"Unknown steps: {unknown}. Available: {list(STEPS)}")
    actions: dict[str, Callable[[], object]] = {
        "ingest": lambda: load_csv_data(store, companies_path, records_path),
        "analytics": lambda: run_analytics(store),
        "forecast": lambda: save_forecasts(store, **forecast_options),
        "anomaly": lambda: save_anomaly_flags(store),
        "report": lambda: save_reports(store, reports_root),
    }
    return {step: actions[step]() for step in STEPS if step in steps}
