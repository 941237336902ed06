import datetime as dt

import pytest

from quarterwise import schema
from quarterwise.operators import validation as v
from tests.conftest import quarter, row

COLUMNS = ["record_id", "company_id", "date", *schema.MEASURES]
Q1, Q2, Q3 = quarter(0), quarter(1), quarter(2)


def raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))


def text_row(rid, company, date, revenue="10", assets="50"):
    return (rid, company, date, revenue, "6", "4", "3", assets, "20")


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="liabilities"):
        v.validate_financial_records(raw(spark, []).drop("liabilities"))
    with pytest.raises(ValueError, match="sector"):
        v.validate_companies(spark.createDataFrame([], "company_id long, company_name string, country string"))


def test_first_record_wins_and_unusable_rows_go(spark):
    df = raw(
        spark,
        [
            text_row("2", "1", "2020-01-01", revenue="99"),
            text_row("1", "1", "2020-01-01", revenue="10"),
            text_row("3", "1", "2020-04-01", revenue=None),
            text_row("4", "1", "2020-04-01", revenue="7"),
            text_row("5", "1", "2020-07-01", revenue="abc", assets="n/a"),
            text_row("6", None, "2020-07-01"),
            text_row("7", "1", None),
        ],
    )
    kept = {r["date"].isoformat(): r for r in v.validate_financial_records(df).collect()}
    assert set(kept) == {"2020-01-01", "2020-07-01"}
    assert kept["2020-01-01"]["revenue"] == 10.0
    assert (kept["2020-07-01"]["revenue"], kept["2020-07-01"]["assets"]) == (0.0, 0.0)
    assert v.validation_report(df).first().asDict() == {"rows_read": 7, "rows_kept": 2, "rows_dropped": 5}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_that_dominate_the_input_combine_before_the_shuffle(spark):
    df = spark.range(20_000).selectExpr(
        "cast(id as string) record_id", "'1' company_id", "'2020-01-01' date", "cast(id as string) revenue",
        "'1' expenses", "'1' profit", "'1' operating_cost", "'1' assets", "'1' liabilities",
    )
    out = v.validate_financial_records(df)
    assert [r["record_id"] for r in out.collect()] == [0]
    assert "partial_min_by" in plan_of(out) and "Window" not in plan_of(out)


def test_rows_with_ids_are_never_sorted(spark, records):
    text = raw(spark, [text_row("1", "1", "2020-01-01")])
    for df in (v.validate_financial_records(text), v.validation_report(text), v.drop_duplicate_records(records([row(1, Q1)]))):
        assert "HashAggregate" in plan_of(df) and "SortAggregate" not in plan_of(df)
    # text cannot be held by a hash aggregate
    assert "SortAggregate" in plan_of(v.drop_duplicate_records(text.selectExpr("cast(company_id as long) company_id", "date", "cast(record_id as long) record_id", "revenue")))


def test_first_of_ids_at_the_ends_of_their_range(spark):
    top = 2**63 - 1
    rows = [(1, Q1, i, float(k)) for k, i in enumerate([top, 0, -top - 1, 5])] + [(2, Q1, i, float(k)) for k, i in enumerate([-top - 1, None])] + [(3, Q1, None, None), (4, Q1, top, -0.5)]
    df = spark.createDataFrame(rows, "company_id long, date date, record_id long, revenue double")
    got = {r["company_id"]: (r["record_id"], r["revenue"]) for r in v.drop_duplicate_records(df).collect()}
    assert got == {1: (-top - 1, 2.0), 2: (None, 1.0), 3: (None, None), 4: (top, -0.5)}


def test_rows_that_share_the_lowest_id_give_one_whole_row_whatever_the_partitions(spark):
    rows = [(1, Q1, 7, float(k), float(-k)) for k in range(50)] + [(1, Q1, 8, 1e9, 1e9)]
    df = spark.createDataFrame(rows, "company_id long, date date, record_id long, revenue double, profit double")
    got = {tuple(v.drop_duplicate_records(df.repartition(n)).first()) for n in (1, 3, 8)}
    assert len(got) == 1 and (kept := got.pop())[2] == 7 and kept[3] == -kept[4]


def test_the_report_counts_what_validation_keeps(spark):
    rows = [text_row(None if k % 5 == 0 else str(k % 7), str(k % 3), f"2020-0{1 + k % 4}-01", revenue=None if k % 2 else str(k)) for k in range(60)]
    for df in (raw(spark, rows), raw(spark, rows).drop("record_id")):
        assert v.validation_report(df).first()["rows_kept"] == v.validate_financial_records(df).count()


def test_dates(spark):
    df = raw(spark, [text_row("1", "1", "2020-01-01"), text_row("2", "1", "soon")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        v.validate_financial_records(df).collect()
    assert v.validate_financial_records(df, strict_dates=False).count() == 1
    assert [r["record_id"] for r in v.rejected_dates(df).collect()] == ["2"]


def test_companies_are_deduplicated(spark):
    rows = [(1, "B", "s", "c"), (1, "A", "s", "c"), (0, "Z", "s", "c")]
    out = v.validate_companies(spark.createDataFrame(rows, schema.COMPANIES))
    assert sorted((r[0], r[1]) for r in out.collect()) == [(0, "Z"), (1, "A")]


def test_fill_forward_then_back_then_zero(records):
    rows = [
        row(1, Q1, revenue=None, profit=None, assets=-5.0),
        row(1, Q2, revenue=20.0, profit=None),
        row(1, Q3, revenue=None, profit=None),
        row(2, Q1, revenue=7.0, profit=1.0),
    ]
    out = {(r["company_id"], r["date"]): r for r in v.clean_financial_records(records(rows)).collect()}
    assert [out[1, q]["revenue"] for q in (Q1, Q2, Q3)] == [20.0, 20.0, 20.0]
    assert [out[1, q]["profit"] for q in (Q1, Q2, Q3)] == [0.0, 0.0, 0.0]
    assert out[1, Q1]["assets"] == 0.0 and out[2, Q1]["revenue"] == 7.0


def test_date_column_may_be_typed(records):
    out = v.validate_financial_records(records([row(0, dt.date(2020, 1, 1))]))
    assert out.first()["company_id"] == 0


def test_only_plain_decimal_numbers_are_read(spark):
    texts = ["12", " -1.5e3 ", ".5", "7.", "12d", "12F", "0x1p3", "NaN", "Infinity", "1e", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "x string").select(v.to_number("x").alias("x")).collect()
    assert [r.x for r in got] == [12.0, -1500.0, 0.5, 7.0] + [0.0] * 8
    assert [r.x for r in spark.createDataFrame([(1e20,), (None,), (-0.25,)], "x double").select(v.to_number("x").alias("x")).collect()] == [1e20, 0.0, -0.25]
