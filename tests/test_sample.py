"""Published results of the five-company sample; needs QUARTERWISE_SAMPLE, the folder it is in."""

import os
from pathlib import Path

import pytest

from quarterwise.operators import anomaly, features, kpi
from quarterwise.operators.validation import validate_companies, validate_financial_records
from quarterwise.plans.reports import kpi_report
from quarterwise.sources.csv import read_companies, read_records

ROOT = os.environ.get("QUARTERWISE_SAMPLE")
pytestmark = pytest.mark.skipif(not ROOT, reason="QUARTERWISE_SAMPLE is not set")


@pytest.fixture(scope="module")
def sample(spark):
    def find(pattern):
        return str(next(Path(ROOT).rglob(pattern)))

    records = validate_financial_records(read_records(spark, find("financial_records.csv"))).persist()
    companies = validate_companies(read_companies(spark, find("companies.csv")))
    report = spark.read.option("header", True).option("inferSchema", True).csv(find("kpi_report_*.csv"))
    return records, companies, report


def test_kpi_report_is_reproduced(sample):
    records, companies, report = sample
    ours = kpi_report(features.compute_kpis(records), companies)
    assert set(ours.columns) == set(report.columns) and report.count() == 120
    assert ours.select(*report.columns).exceptAll(report).count() == 0


def test_margins(sample):
    records, companies, _ = sample
    summary = kpi.company_summary(records, companies).collect()
    assert [(r["company_id"], r["avg_profit_margin"]) for r in summary] == [(2, 51.91), (4, 50.08), (1, 45.07), (5, 34.9), (3, 26.51)]


def test_flags(sample):
    records, _, _ = sample
    z = anomaly.zscore_anomalies(records)
    assert z.count() == 26 and anomaly.iqr_anomalies(records).count() == 42 and anomaly.debt_risk_flags(records).count() == 0
    severe = z.where("severity = 'SEVERE'").collect()
    assert [(r["company_id"], str(r["date"]), r["metric"], r["value"], r["z_score"]) for r in severe] == [(3, "2022-04-01", "profit", -86.31, -3.99)]
    assert anomaly.run_anomaly_detection(records, isolation=False).count() == 49
    totals = anomaly.severity_totals(anomaly.run_anomaly_detection(records)).first()
    assert 49 <= totals["total_flags"] <= 59 and totals["severe_flags"] == 1
