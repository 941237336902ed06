import csv
import datetime as dt
from pathlib import Path

import pytest

from quarterwise.plans import reports, steps
from quarterwise.plans.named_queries import run_select
from quarterwise.sources.csv import write_csv
from quarterwise.sources.tables import TableStore, row_count
from tests.conftest import quarter

HEADER = "record_id,company_id,date,revenue,expenses,profit,operating_cost,assets,liabilities"


@pytest.fixture
def inputs(tmp_path):
    lines = [HEADER]
    for c in (0, 1, 2):
        for k in range(12):
            v = 100 + 10 * c + k + (300 if (c, k) == (1, 6) else 0)
            lines.append(f"{len(lines)},{c},{quarter(k)},{v},{0.6 * v:.2f},{0.4 * v:.2f},{0.3 * v:.2f},1000,{400 + 200 * c}")
    lines.append(lines[1])
    lines.append("999,2,2030-01-01,n/a,1,1,1,1,1")
    (tmp_path / "records.csv").write_text("\n".join(lines))
    (tmp_path / "companies.csv").write_text("company_id,company_name,sector,country\n0,Zero Ltd,Retail,UK\n1,Alpha Corp,Banking,UK\n2,Beta Group,Energy,US\n2,Beta Group,Energy,US\n")
    return tmp_path


def read_csv_dir(path):
    rows = []
    for part in sorted(Path(path).glob("part-*.csv")):
        with part.open(encoding="utf-8") as f:
            rows += list(csv.DictReader(f))
    return rows


def test_all_steps(spark, inputs):
    store = TableStore(spark, str(inputs / "tables"))
    done = steps.run_steps(
        store, str(inputs / "companies.csv"), str(inputs / "records.csv"), str(inputs / "reports"), models=["arima", "seasonal", "holt"]
    )
    assert list(done) == list(steps.STEPS)
    assert done["ingest"] == {"companies": 3, "records": 36}
    assert done["forecast"] == 12
    assert store.kpi_results().count() == 36 and store.kpi_results(0).count() == 12
    assert [r["forecast_date"] for r in store.forecast_results(1).collect()] == [quarter(k) for k in range(12, 16)]
    assert store.anomaly_flags(1).where("metric = 'revenue'").first()["date"] == quarter(6)
    assert [r["company_id"] for r in store.companies().collect()] == [0, 1, 2]
    report = read_csv_dir(done["report"]["kpi_report"])
    assert len(report) == 36 and report[0]["date"] == "2019-01-01" and list(report[0])[-3:] == ["company_name", "sector", "country"]
    assert "Total Revenue (£k)" in read_csv_dir(done["report"]["summary_table"])[0]
    store.register_views()
    assert run_select(spark, "select count(*) n from anomaly_flags join companies using (company_id)").first()["n"] > 0

    plan = store.financial_records(1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(company_id), EqualTo(company_id,1)]" in plan


def test_default_models_detectors_and_ordered_reports(spark, inputs):
    store = TableStore(spark, str(inputs / "tables"))
    done = steps.run_steps(store, str(inputs / "companies.csv"), str(inputs / "records.csv"), str(inputs / "reports"))
    assert done["forecast"] == 12
    for c in (0, 1, 2):
        rows = store.forecast_results(c).collect()
        assert [r["forecast_date"] for r in rows] == [quarter(k) for k in range(12, 16)]
        assert all(r["lower_bound"] <= r["predicted_revenue"] <= r["upper_bound"] and 50 < r["predicted_revenue"] < 500 for r in rows)
    # the forest flags the spike too, under the same metric
    assert store.anomaly_flags(1).where("metric = 'revenue' and severity = 'SEVERE'").count() == 1
    for name, keys in (("kpi_report", ("company_id", "date")), ("forecasts", ("Company", "Forecast Date"))):
        rows = read_csv_dir(done["report"][name])
        shown = [tuple(int(r[k]) if k == "company_id" else r[k] for k in keys if k in r) for r in rows]
        assert shown == sorted(shown) and len(shown) > 3, name


def test_steps_stop_on_failure_and_names_are_checked(spark, inputs):
    store = TableStore(spark, str(inputs / "none"))
    with pytest.raises(ValueError, match="charts"):
        steps.run_steps(store, "", "", "", ["charts"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        steps.run_steps(store, "", "", str(inputs / "r"), ["analytics", "report"])
    assert not (inputs / "r").exists()
    with pytest.raises(ValueError, match="Unknown table"):
        store.read("users")


def test_missing_tables_are_empty_views(spark, inputs):
    store = TableStore(spark, str(inputs / "empty"))
    assert store.register_views() == ["companies", "financial_records", "kpi_results", "forecast_results", "anomaly_flags"]
    assert run_select(spark, "select * from kpi_results").columns[:2] == ["company_id", "date"]
    assert row_count(spark.table("companies")).first()["n"] == 0


def test_replace_write(spark, inputs, companies):
    store = TableStore(spark, str(inputs / "t"))
    assert store.write(companies, "companies") == 3
    assert store.write(companies.where("company_id = 0"), "companies") == 1
    assert store.companies().first()["company_name"] == "Zero Ltd"


def test_a_failed_write_leaves_the_old_table(spark, inputs, companies):
    store = TableStore(spark, str(inputs / "t"))
    store.write(companies, "companies")
    broken = companies.selectExpr("company_id", "if(company_id = 2, raise_error('lost'), company_name) as company_name", "sector", "country")
    reader = store.companies()
    with pytest.raises(Exception, match="lost"):
        store.write(broken, "companies")
    assert store.companies().count() == 3
    assert store.write(companies.where("company_id = 0"), "companies") == 1
    # who had opened the replaced version still reads it, and the failed one is gone
    assert reader.count() == 3 and store.companies().count() == 1
    assert len(list((inputs / "t" / "companies").glob("version-*"))) == 2


def test_a_table_that_was_never_whole_is_not_there(spark, inputs, companies):
    store = TableStore(spark, str(inputs / "t"))
    with pytest.raises(Exception, match="lost"):
        store.write(companies.selectExpr("company_id", "raise_error('lost') as company_name"), "companies")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("companies")


def test_export_with_preview(spark, inputs, series, companies):
    df = series({1: range(1, 31)})
    choices = reports.export_choices(df, companies, df, df)
    path, preview = reports.export_dataset(choices, "KPI Results", str(inputs / "out"))
    assert path.endswith("/kpi_results") and preview.count() == 20
    assert len(read_csv_dir(path)) == 30
    with pytest.raises(ValueError, match="Companies"):
        reports.export_dataset(choices, "Users", str(inputs / "out"))


def test_csv_order_and_dates(spark, inputs):
    df = spark.createDataFrame([(2, dt.date(2020, 1, 1)), (1, None)], "k long, d date")
    rows = read_csv_dir(write_csv(df, str(inputs / "csv"), ["k"]))
    assert rows == [{"k": "1", "d": ""}, {"k": "2", "d": "2020-01-01"}]
