import pytest

from quarterwise.functions import scalars
from quarterwise.operators import features, kpi
from quarterwise.plans import named_queries
from quarterwise.sources.tables import by_company
from tests.conftest import quarter, row

Q = [quarter(k) for k in range(9)]


def by_date(df):
    return {r["date"]: r for r in df.collect()}


def test_ratios_and_growth(records):
    rows = [
        row(1, Q[0], revenue=200.0, profit=-50.0, assets=0.0),
        row(1, Q[1], revenue=0.0, profit=10.0),
        row(1, Q[3], revenue=50.0, profit=20.0),
        row(2, Q[3], revenue=75.0),
    ]
    out = features.engineer_features(records(rows)).where("company_id = 1")
    first, zero, after = (by_date(out)[Q[k]] for k in (0, 1, 3))
    assert (first["profit_margin"], first["return_on_assets"], first["debt_to_assets"]) == (-0.25, None, None)
    assert first["revenue_growth"] is None and first["equity"] == -200.0
    assert zero["profit_margin"] is None and zero["revenue_growth"] == -1.0 and zero["profit_growth"] == -1.2
    assert after["revenue_growth"] is None and after["profit_growth"] == 1.0


def test_rolling_means_start_at_the_first_row(series):
    out = features.run_preprocessing(series({1: [10, 20, 60, 30, 50]}))
    got = [r["revenue_rolling_4q"] for r in out.orderBy("date").collect()]
    assert got == [10.0, 15.0, 30.0, 30.0, 40.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the dedupe key, then the company


def test_year_on_year_compares_the_same_quarter(records):
    rows = [row(1, Q[0], revenue=100.0), row(1, Q[4], revenue=150.0), row(1, Q[5], revenue=1.0)]
    out = by_date(kpi.yoy_growth(records(rows)))
    assert (out[Q[4]]["prev_revenue"], out[Q[4]]["yoy_growth"]) == (100.0, 0.5)
    assert out[Q[0]]["yoy_growth"] is None and out[Q[5]]["yoy_growth"] is None


def test_last_known_value_per_column(records):
    rows = [row(1, Q[0], revenue=5.0, profit=1.0), row(1, Q[1], revenue=None, profit=2.0)]
    latest = kpi.latest_per_company(records(rows)).first()
    assert (latest["date"], latest["revenue"], latest["profit"]) == (Q[1], 5.0, 2.0)


def test_quarter_card(records):
    rows = [
        row(1, Q[0], revenue=100.0, profit=-0.5),
        row(1, Q[1], revenue=150.0, profit=0.5),
        row(2, Q[0], revenue=9.0, profit=3.0),
    ]
    cards = {r["company_id"]: r for r in kpi.quarter_card(features.compute_kpis(records(rows))).collect()}
    assert (cards[1]["revenue_change_pct"], cards[1]["profit_change_pct"]) == (50.0, 100.0)
    assert (cards[2]["revenue_change_pct"], cards[2]["profit_change_pct"]) == (0.0, 0.0)


def test_compare_profit_keeps_dates_of_either_company(records):
    rows = [row(0, Q[0], profit=1.0), row(0, Q[1], profit=2.0), row(1, Q[1], profit=3.0), row(1, Q[2], profit=None)]
    got = [tuple(r) for r in kpi.compare_profit(records(rows), 0, 1).collect()]
    assert got == [(Q[0], 1.0, None), (Q[1], 2.0, 3.0), (Q[2], None, None)]
    with pytest.raises(ValueError):
        kpi.compare_profit(records(rows), 1, 1)


def test_sector_comparison_counts_companies_once_and_skips_unknown(records, companies):
    rows = [row(c, Q[k]) for c in (0, 1, 9) for k in range(3)]
    out = {r["sector"]: r for r in kpi.sector_comparison(records(rows), companies).collect()}
    assert set(out) == {"Retail", "Banking"}
    assert out["Retail"]["companies"] == 1 and out["Retail"]["total_revenue"] == 300.0


def test_key_zero_is_a_company(records):
    df = records([row(0, Q[0]), row(1, Q[0])])
    assert [r["company_id"] for r in by_company(df, 0).collect()] == [0]
    assert by_company(df).count() == 2


def test_scalars(spark):
    df = spark.createDataFrame([(1.25e6,), (12_345.0,), (7.0,), (-2500.0,)], "v double")
    assert [r[0] for r in df.select(scalars.amount_label("v")).collect()] == ["£1.3M", "£12k", "£7", "£-3k"]
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in df.select(scalars.finite("v")).collect()] == [None, None, 1.0]


def test_named_and_free_queries(spark, records, companies):
    records([row(1, Q[0]), row(1, Q[1], profit=90.0)]).createOrReplaceTempView("financial_records")
    companies.createOrReplaceTempView("companies")
    for name in named_queries.NAMED_QUERIES:
        assert named_queries.run_named_query(spark, name).count() > 0
    latest = named_queries.run_named_query(spark, "profit_ranking_latest").first()
    assert (latest["date"], latest["latest_profit"]) == (Q[1], 90.0)
    with pytest.raises(ValueError, match="top_revenue_companies"):
        named_queries.run_named_query(spark, "nope")
    assert named_queries.run_select(spark, "select count(*) as n from companies; ").first()["n"] == 3
    for bad in ("drop view companies", "insert into companies values (1, 'a', 'b', 'c')"):
        with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
            named_queries.run_select(spark, bad)


def test_latest_snapshot_is_in_percent(records, companies):
    snap = kpi.latest_kpi_snapshot(records([row(1, Q[0]), row(1, Q[1], revenue=200.0)]), companies).first()
    assert (snap["profit_margin"], snap["revenue_growth"], snap["company_name"]) == (20.0, 100.0, "Alpha Corp")


def test_summary_of_a_single_quarter(records, companies):
    out = kpi.company_summary(records([row(9, Q[0])]), companies).first()
    assert out["company_name"] is None and out["avg_revenue_growth"] is None and out["quarters"] == 1
    assert out["avg_profit_margin"] == 40.0


def test_five_analytics_frames_read_the_records_once(spark, series, companies, tmp_path):
    series({0: range(1, 13), 1: range(20, 32)}).write.parquet(str(tmp_path / "records"))
    stored = spark.read.parquet(str(tmp_path / "records"))
    results = kpi.full_analytics(stored, companies)
    assert list(results) == ["kpi_data", "company_summary", "sector_comparison", "yoy_growth", "latest_snapshot"]
    for name, df in results.items():
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString(), name
    kpis = features.compute_kpis(stored)
    alone = {
        "kpi_data": kpis, "company_summary": kpi.company_summary(stored, companies), "sector_comparison": kpi.sector_comparison(stored, companies),
        "yoy_growth": kpi.yoy_growth(stored), "latest_snapshot": kpi.latest_kpi_snapshot(stored, companies),
    }
    for name, df in results.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, alone[name].collect())), name
