"""Filter context rules and invariants of the measures, on a small mart with skew and gaps."""

import datetime as dt
import glob
import os
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.catalog import roles as R
from salesmart.operators.grouping import drill
from salesmart.plans import dimensions as B
from salesmart.plans import measures as M
from salesmart.plans import reports as V
from salesmart.plans.facts import MONTH, with_month
from salesmart.sources import generators as G
from salesmart.sources import tables as T
from salesmart.workspace import run_dir

SALES = [
    # date, product, pharmacy, qty, amount
    ("2020-02-29", 1, 1, 1, "10.00"),
    ("2020-03-10", 1, 2, 2, "20.00"),
    ("2020-12-31", 2, 1, 1, "5.00"),
    ("2021-02-28", 1, 1, 3, "33.00"),
    ("2021-03-10", 2, 2, 4, "44.00"),
    ("2021-06-01", 99, 1, 1, "7.00"),
    ("2022-03-15", 1, 1, 1, "50.00"),
    ("2023-06-02", 1, 1, 1, "1000.00"),
]


@pytest.fixture(scope="module")
def mart(spark):
    facts = spark.createDataFrame(SALES, "d string, FK_Product long, FK_Pharmacy long, Qty int, a string").select(
        F.date_format(F.col("d").cast("date"), "yyyyMMdd").cast("int").alias("FK_Date"), "FK_Product", "FK_Pharmacy", "Qty",
        F.col("a").cast("decimal(18,2)").alias("Amount"), F.col("d").cast("timestamp_ntz").alias("SourceSaleDateTime"),
    )
    date = B.build_date(G.fixed_bounds(spark, dt.date(2020, 1, 1), dt.date(2023, 6, 2)))
    product = spark.createDataFrame([(1, "A", "x", "Generic"), (2, "B", "y", "Branded")], "SK_Product long, ProductName string, Brand string, GenericLabel string")
    pharmacy = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "SK_Pharmacy long, PharmacyName string")
    segments = spark.createDataFrame([(1, "High"), (2, "Low")], "PharmacyID long, SegmentLabel string")
    return M.Mart(facts, {"DimDate": date, "DateSlicer": B.build_slicer(date), "DimProduct": product, "DimPharmacy": pharmacy, "PharmacySegmentation": segments})


def rows(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


CTX = M.FilterContext(after=dt.date(2020, 12, 31), without=(dt.date(2023, 6, 2),)).within(dt.date(2021, 1, 1), dt.date(2023, 6, 1))


def test_calendar(mart):
    date = mart["DimDate"]
    assert date.count() == 1249
    # Three whole years, and the five holidays of 2023 up to 2 June.
    assert date.filter("IsHoliday").count() == 13 * 3 + 5
    assert not date.filter("FullDate = '2022-06-03'").first().YTDFlag and date.filter("FullDate = '2022-06-02'").first().YTDFlag


def test_blank_when_no_rows(mart):
    empty = M.sales(mart, CTX.within(dt.date(2022, 1, 1), dt.date(2022, 1, 2))).first()
    assert empty[M.AMOUNT] is None and empty[M.QTY] is None


def test_report_filter_applies(mart):
    assert M.sales(mart, CTX).first()[M.AMOUNT] == Decimal("134.00")


def test_prior_reaches_before_the_slicer(mart):
    got = rows(M.sales_with_prior(mart, CTX, (("DimDate", "Year"), ("DimDate", "Month"))), "Year", "Month")
    # 29 February counts towards 28 February of the next year.
    assert (got[2021, 2][M.AMOUNT], got[2021, 2][M.PRIOR_AMOUNT]) == (Decimal("33.00"), Decimal("10.00"))
    assert (got[2021, 3][M.AMOUNT], got[2021, 3][M.PRIOR_AMOUNT]) == (Decimal("44.00"), Decimal("20.00"))
    # No current sales, but some a year before.
    assert (got[2021, 12][M.AMOUNT], got[2021, 12][M.PRIOR_AMOUNT]) == (None, Decimal("5.00"))
    assert (got[2022, 2][M.AMOUNT], got[2022, 2][M.PRIOR_AMOUNT]) == (None, Decimal("33.00"))


def test_growth_is_current_less_prior(mart):
    for r in M.with_growth(M.sales_with_prior(mart, CTX, (("DimDate", "Month"),))).collect():
        assert r.SalesGrowthAbsolute == (r[M.AMOUNT] or 0) - (r[M.PRIOR_AMOUNT] or 0)
    card = V.growth_card(mart, CTX).first()
    # Everything sold a year before one of the visible dates: all but the last sale.
    assert card.SalesGrowthAbsolute == Decimal("134.00") - Decimal("169.00")


def test_share_ignores_all_but_the_slicer_range(mart):
    whole = M.denominator(mart, CTX.selecting("DimProduct", "GenericLabel", "Generic")).first()
    assert whole.AllAmount == Decimal("134.00")
    by_product = M.with_shares(M.sales(mart, CTX, (("DimProduct", "ProductName"),)), M.denominator(mart, CTX))
    assert sum(r.SalesAmountShare for r in by_product.collect()) == pytest.approx(1)
    chosen = CTX.selecting("DimProduct", "GenericLabel", "Generic")
    assert M.share_card(mart, chosen).first().SalesAmountShare == pytest.approx(83 / 134)
    assert M.share_card(mart, CTX).first().SalesAmountShare == pytest.approx(1)
    # Without the report filter the numerator grows, the slicer range alone sets the denominator.
    wide = M.FilterContext(after=dt.date(2021, 2, 28)).within(dt.date(2021, 1, 1), dt.date(2023, 6, 1))
    assert M.share_card(mart, wide).first().SalesAmountShare == pytest.approx(101 / 134)


def test_missing_dimension_row_is_blank_member(mart):
    got = rows(M.sales(mart, CTX, (("DimProduct", "ProductName"),)), "ProductName")
    assert got[None][M.AMOUNT] == Decimal("7.00")


def test_selections_and_exclusions(mart):
    assert M.sales(mart, CTX.selecting("DimPharmacy", "PharmacyName", "two")).first()[M.AMOUNT] == Decimal("44.00")
    labels = V.by_generic_label(mart, CTX)
    assert {r.GenericLabel for r in labels.collect()} == {"Generic", "Branded"}


def test_segment_filters_both_ways(mart):
    high = CTX.selecting("PharmacySegmentation", "SegmentLabel", "High")
    assert M.sales(mart, high).first()[M.AMOUNT] == Decimal("90.00")
    assert M.pharmacy_count(mart, high).first().PharmacyCount == 1
    assert M.pharmacy_count(mart, CTX).first().PharmacyCount == 3


def test_rollup_leaves_add_up(mart):
    leaves = M.sales(mart, CTX, (("DimProduct", "Brand"), ("DimProduct", "ProductName")))
    got = drill(leaves, ["Brand", "ProductName"], [F.sum(M.AMOUNT).alias(M.AMOUNT)]).collect()
    assert sum(r[M.AMOUNT] for r in got if r.Level == 2) == next(r[M.AMOUNT] for r in got if r.Level == 0)


def test_title_and_latest_year(mart):
    assert M.period_title(mart, CTX).first()[0] == "Total Sales Amount (01/2021 - 05/2023)"
    latest = V.latest_year(V.yearly_kpi(mart, CTX)).first()
    assert latest.Year == 2023 and latest[M.PRIOR_AMOUNT] == Decimal("50.00") and latest.SalesYoYPct == pytest.approx(-1)


def test_date_bounds_reach_the_scan(spark, sf):
    from salesmart.catalog import roles as R

    query = M.sales(R.mart(spark, sf), R.REPORT)
    plan = spark._jvm.PythonSQLUtils.explainString(query._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in plan and "LessThan(l_shipdate,2001-07-01T00:00)" in plan


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    """The star over the test tables, with its facts in a folder that plans can name."""
    whole = R.mart(spark, sf, "DimTime", "DimProduct", "DimPharmacy", "DimLocation", "DimOperator", "DimPOS")
    path = str(tmp_path_factory.mktemp("stored") / "factsales")
    whole.facts.write.parquet(path)
    return M.Mart(spark.read.parquet(path), whole.tables)


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("/factsales]")


def test_facts_are_scanned_once(stored):
    ctx, district = R.REPORT, R.REPORT.selecting("DimLocation", "District", "ASIA")
    views = [
        V.kpi_cards(stored, ctx), V.kpi_cards(stored, district), V.generic_share(stored, ctx), V.quarter_view(stored, ctx, R.QUARTER),
        V.district_view(stored, ctx, ("DimLocation", "District", "AFRICA")), M.sales(stored, ctx, (("DimPharmacy", "PharmacyName"),)),
    ]
    assert [scans(v) for v in views] == [1] * len(views)
    assert scans(M.shares(stored, ctx, (("DimPharmacy", "PharmacyName"),))) == 0  # they are read when the totals are written


def test_several_large_keys_are_not_added_up_first(stored):
    by = (("DimProduct", "Manufacturer"), ("DimPharmacy", "PharmacyName"), ("DimTime", "DayPeriod"))
    plan = M.sales(stored, M.FilterContext(), by)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
    one = M.sales(stored, M.FilterContext(), by[1:])._jdf.queryExecution().optimizedPlan().toString()
    assert one.count("Aggregate [") == 2


def test_minutes_select_and_label(stored):
    by = (("DimTime", "DayPeriod"),)
    whole = {r.DayPeriod: r.TotalSalesAmount for r in M.sales(stored, M.FilterContext(), by).collect()}
    assert len(whole) > 1
    for period, amount in whole.items():
        ctx = M.FilterContext().selecting("DimTime", "DayPeriod", period)
        assert M.sales(stored, ctx).first().TotalSalesAmount == amount
        assert M.share_card(stored, ctx).first().SalesAmountShare == pytest.approx(float(amount) / float(sum(whole.values())))
        assert M.sales_with_prior(stored, ctx, by).first().TotalSalesAmount == amount


def test_a_year_on_the_calendar_prunes_the_scan(spark, mart):
    """Months outside the selection are never read: their files are no Parquet any more."""
    path = run_dir(spark, "facts")
    T.replace(with_month(mart.facts), path, [MONTH])
    where = T.current(spark, path).removeprefix("file:")
    stored = replace(mart, facts=T.scan(spark, path))
    ctx, by = M.FilterContext().selecting("DimDate", "Year", 2021), (("DimDate", "Month"), ("DimPharmacy", "PharmacyName"))
    want = [sorted(map(str, f(mart, ctx, by).collect())) for f in (M.sales, M.sales_with_prior)]
    for f in (M.sales, M.sales_with_prior):
        assert "dynamicpruning" in f(stored, ctx, by)._jdf.queryExecution().toString()
    for month in ("202203", "202306"):
        for name in glob.glob(f"{where}/{MONTH}={month}/*.parquet"):
            os.chmod(name, 0o644)
            with open(name, "wb") as f:
                f.write(b"none")
            for crc in glob.glob(f"{where}/{MONTH}={month}/.*.crc"):
                os.remove(crc)
    stored = replace(mart, facts=T.scan(spark, path, stored.facts.schema))
    assert [sorted(map(str, f(stored, ctx, by).collect())) for f in (M.sales, M.sales_with_prior)] == want
    assert want[0] and want[1]
