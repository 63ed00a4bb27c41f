"""Measures (K) and report queries (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.catalog import roles as R
from salesmart.catalog.registry import query
from salesmart.plans import measures as M
from salesmart.plans import reports as V
from salesmart.plans.facts import MONTH, with_month
from salesmart.sources import tables as T
from salesmart.workspace import run_dir

# Facts under the report's filters; ``both`` also lays each fact out a year later.
R.CTE["visible"] = f"SELECT * FROM ddate WHERE {R.REPORT_SQL}"
R.CTE["now"] = "SELECT fact.* EXCLUDE (FullDate), visible.* FROM fact JOIN visible ON FK_Date = SK_Date"
R.CTE["both"] = """
SELECT visible.*, FK_Pharmacy, FK_Product, Amount AS a, Qty AS q, NULL AS pa, NULL AS pq FROM fact JOIN visible ON FK_Date = SK_Date
UNION ALL SELECT visible.*, FK_Pharmacy, FK_Product, NULL, NULL, Amount, Qty FROM fact JOIN visible ON CAST(fact.FullDate + INTERVAL 1 YEAR AS DATE) = visible.FullDate
"""
R.CTE["quarter_visible"] = f"SELECT * FROM ddate WHERE {R.QUARTER_SQL}"
R.CTE["quarter_both"] = R.CTE["both"].replace("visible", "quarter_visible")
# Every sale between the slicer's first and last day, whatever else is filtered.
R.CTE["whole"] = """
SELECT sum(Amount) AS wa, sum(Qty) AS wq FROM fact JOIN ddate ON FK_Date = SK_Date
WHERE ddate.FullDate BETWEEN (SELECT min(FullDate) FROM ddate WHERE FullDate >= DATE '1996-01-01' AND FullDate < DATE '2001-07-01')
  AND (SELECT max(FullDate) FROM ddate WHERE FullDate >= DATE '1996-01-01' AND FullDate < DATE '2001-07-01')
"""
R.NEEDS.update(
    {"visible": ("ddate",), "now": ("fact", "visible"), "both": ("fact", "visible"), "quarter_visible": ("ddate",),
     "quarter_both": ("fact", "quarter_visible"), "whole": ("fact", "ddate")}
)

_A = "CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount"
_Q = "CAST(sum(Qty) AS BIGINT) AS TotalQuantity"
_CA = "CAST(sum(a) AS DOUBLE) AS TotalSalesAmount"
_PA = "CAST(sum(pa) AS DOUBLE) AS SalesPriorPeriod"
_PQ = "CAST(sum(pq) AS BIGINT) AS QuantityPriorPeriod"
_GA = "CASE WHEN sum(a) IS NOT NULL OR sum(pa) IS NOT NULL THEN CAST(coalesce(sum(a), 0) - coalesce(sum(pa), 0) AS DOUBLE) END AS SalesGrowthAbsolute"
_GQ = "CASE WHEN sum(q) IS NOT NULL OR sum(pq) IS NOT NULL THEN CAST(coalesce(sum(q), 0) - coalesce(sum(pq), 0) AS BIGINT) END AS QuantityGrowthAbsolute"
_SHARE_A = "CAST(sum(Amount) AS DOUBLE) / (SELECT CAST(wa AS DOUBLE) FROM whole) AS SalesAmountShare"
_SHARE_Q = "CAST(sum(Qty) AS DOUBLE) / (SELECT CAST(wq AS DOUBLE) FROM whole) AS QuantityShare"
_MONTH = '"Year", "Month", MonthName'
BY_PHARMACY = (("DimPharmacy", "PharmacyName"),)
_PHARMACY_JOIN = "JOIN dpharmacy ON FK_Pharmacy = SK_Pharmacy"


@query("k01_total_sales_amount", R.sql(f"SELECT PharmacyName, {_A} FROM now {_PHARMACY_JOIN} GROUP BY 1", "now", "dpharmacy"))
def total_sales_amount(spark, sf):
    return M.sales(R.mart(spark, sf, "DimPharmacy"), R.REPORT, BY_PHARMACY).drop(M.QTY)


@query("k02_total_quantity", R.sql(f"SELECT PharmacyName, {_Q} FROM now {_PHARMACY_JOIN} GROUP BY 1", "now", "dpharmacy"))
def total_quantity(spark, sf):
    return M.sales(R.mart(spark, sf, "DimPharmacy"), R.REPORT, BY_PHARMACY).drop(M.AMOUNT)


@query("k03_sales_prior_period", R.sql(f'SELECT PharmacyName, {_PA} FROM "both" {_PHARMACY_JOIN} GROUP BY 1', "both", "dpharmacy"))
def sales_prior_period(spark, sf):
    rows = M.sales_with_prior(R.mart(spark, sf, "DimPharmacy"), R.REPORT, BY_PHARMACY)
    return rows.select("PharmacyName", M.PRIOR_AMOUNT)


@query("k03_prior_of_selected_year", """
SELECT CAST(month(l_shipdate) AS SMALLINT) AS "Month", CAST(sum(a) FILTER (y = 1997) AS DOUBLE) AS TotalSalesAmount,
  CAST(sum(q) FILTER (y = 1997) AS BIGINT) AS TotalQuantity, CAST(sum(a) FILTER (y = 1996) AS DOUBLE) AS SalesPriorPeriod,
  CAST(sum(q) FILTER (y = 1996) AS BIGINT) AS QuantityPriorPeriod
FROM (SELECT l_shipdate, year(l_shipdate) AS y, CAST(l_extendedprice AS DECIMAL(18,2)) AS a, CAST(l_quantity AS INTEGER) AS q FROM lineitem)
WHERE y IN (1996, 1997) GROUP BY 1""")
def prior_of_selected_year(spark, sf):
    """A year chosen on the calendar, over facts stored by month: only that year's and the last one's files are read."""
    path, full = run_dir(spark, "facts"), R.mart(spark, sf)
    T.replace(with_month(full.facts), path, [MONTH])
    stored = M.Mart(T.scan(spark, path), full.tables)
    return M.sales_with_prior(stored, M.FilterContext().selecting("DimDate", "Year", 1997), (("DimDate", "Month"),))


@query("k04_quantity_prior_period", R.sql(f'SELECT "Year", {_PQ} FROM "both" GROUP BY 1', "both"))
def quantity_prior_period(spark, sf):
    return M.sales_with_prior(R.mart(spark, sf), R.REPORT, (("DimDate", "Year"),)).select("Year", M.PRIOR_QTY)


@query("k05_sales_growth", R.sql(f'SELECT FullDate, {_GA} FROM "both" GROUP BY 1', "both"))
def sales_growth(spark, sf):
    rows = M.with_growth(M.sales_with_prior(R.mart(spark, sf), R.REPORT, (("DimDate", "FullDate"),)))
    return rows.select("FullDate", "SalesGrowthAbsolute")


@query("k06_quantity_growth", R.sql(f'SELECT FK_Product AS CNP, {_GQ} FROM "both" GROUP BY 1', "both"))
def quantity_growth(spark, sf):
    rows = M.with_growth(M.sales_with_prior(R.mart(spark, sf, "DimProduct"), R.REPORT, (("DimProduct", "CNP"),)))
    return rows.select("CNP", "QuantityGrowthAbsolute")


@query("k07_sales_share", R.sql(f"SELECT PharmacyName, {_SHARE_A} FROM now {_PHARMACY_JOIN} GROUP BY 1", "now", "whole", "dpharmacy"))
def sales_share(spark, sf):
    mart = R.mart(spark, sf, "DimPharmacy")
    rows = M.shares(mart, R.REPORT, BY_PHARMACY)
    return rows.select("PharmacyName", "SalesAmountShare")


@query("k08_quantity_share", R.sql(f'SELECT "Year", {_SHARE_Q} FROM now GROUP BY 1', "now", "whole"))
def quantity_share(spark, sf):
    mart = R.mart(spark, sf)
    rows = M.shares(mart, R.REPORT, (("DimDate", "Year"),))
    return rows.select("Year", "QuantityShare")


@query("k09_pharmacy_count", "SELECT count(DISTINCT s_suppkey) AS PharmacyCount FROM supplier")
def pharmacy_count(spark, sf):
    return M.pharmacy_count(R.mart(spark, sf, "DimPharmacy"), R.REPORT)


@query("k10_date_title", R.sql("""
SELECT 'Total Sales Amount (' || strftime(min(FullDate), '%m/%Y') || ' - ' || strftime(max(FullDate), '%m/%Y') || ')' AS DynamicDateTitle FROM visible""", "visible"))
def date_title(spark, sf):
    return M.period_title(R.mart(spark, sf), R.REPORT)


@query("k11_year_over_year", R.sql("""
SELECT "Year", CAST(coalesce(sum(a), 0) - coalesce(sum(pa), 0) AS DOUBLE) / CAST(sum(pa) AS DOUBLE) AS SalesYoYPct FROM "both" GROUP BY 1""", "both"))
def year_over_year(spark, sf):
    rows = M.with_year_over_year(M.sales_with_prior(R.mart(spark, sf), R.REPORT, (("DimDate", "Year"),)))
    return rows.select("Year", "SalesYoYPct")


# ---- report queries ----------------------------------------------------------------------


@query("l01_kpi_cards", R.sql(f"SELECT {_A}, {_Q}, {_SHARE_A}, {_SHARE_Q} FROM now", "now", "whole"))
def kpi_cards(spark, sf):
    return V.kpi_cards(R.mart(spark, sf), R.REPORT)


@query("l01_kpi_cards_of_district", R.sql(f"""
SELECT {_A}, {_Q}, {_SHARE_A}, {_SHARE_Q} FROM now JOIN dlocation ON FK_Location = SK_Location WHERE District = 'ASIA'""", "now", "whole", "dlocation"))
def kpi_cards_of_district(spark, sf):
    return V.kpi_cards(R.mart(spark, sf, "DimLocation"), R.REPORT.selecting("DimLocation", "District", "ASIA"))


@query("l02_growth_card", R.sql(f'SELECT {_GA}, {_GQ} FROM "both"', "both"))
def growth_card(spark, sf):
    return V.growth_card(R.mart(spark, sf), R.REPORT)


@query("l03_sales_by_month", R.sql(f'SELECT {_MONTH}, {_A} FROM now GROUP BY ALL ORDER BY "Year", "Month"', "now"))
def sales_by_month(spark, sf):
    return V.sales_by_month(R.mart(spark, sf), R.REPORT)


@query("l04_sales_and_prior_by_month", R.sql(f'SELECT {_MONTH}, {_CA}, {_PA} FROM "both" GROUP BY {_MONTH} ORDER BY 1, 2', "both"))
def sales_and_prior_by_month(spark, sf):
    return V.sales_and_prior_by_month(R.mart(spark, sf), R.REPORT)


@query("l05_yearly_kpi", R.sql(f"""
SELECT * FROM (SELECT "Year", {_CA}, {_PA},
  CAST(coalesce(sum(a), 0) - coalesce(sum(pa), 0) AS DOUBLE) / CAST(sum(pa) AS DOUBLE) AS SalesYoYPct FROM "both" GROUP BY 1)
ORDER BY "Year" DESC LIMIT 1""", "both"))
def yearly_kpi(spark, sf):
    """The indicator shows the latest year of the trend."""
    return V.latest_year(V.yearly_kpi(R.mart(spark, sf), R.REPORT))


@query("l06_by_generic_label", R.sql(f"""
SELECT GenericLabel, {_Q}, {_A} FROM now JOIN dproduct ON FK_Product = SK_Product WHERE GenericLabel <> 'Unknown' GROUP BY 1""", "now", "dproduct"))
def by_generic_label(spark, sf):
    return V.by_generic_label(R.mart(spark, sf, "DimProduct"), R.REPORT)


@query("l07_generic_share", R.sql(f"""
SELECT GenericLabel, {_A}, CAST(sum(Amount) AS DOUBLE) / CAST(sum(sum(Amount)) OVER () AS DOUBLE) AS ShareOfTotal
FROM now JOIN dproduct ON FK_Product = SK_Product WHERE GenericLabel <> 'Unknown' GROUP BY 1""", "now", "dproduct"))
def generic_share(spark, sf):
    return V.generic_share(R.mart(spark, sf, "DimProduct"), R.REPORT)


@query("l08_product_drill", R.sql("""
, leaves AS (SELECT Manufacturer, Brand, ProductName, sum(Amount) AS a FROM now JOIN dproduct ON FK_Product = SK_Product GROUP BY 1, 2, 3),
levels AS (
  SELECT 1 AS lv, Manufacturer, NULL AS Brand, NULL AS ProductName, sum(a) AS a FROM leaves GROUP BY 2
  UNION ALL SELECT 2, Manufacturer, Brand, NULL, sum(a) FROM leaves GROUP BY 2, 3
  UNION ALL SELECT 3, Manufacturer, Brand, ProductName, a FROM leaves)
SELECT CAST(lv AS INTEGER) AS "Level", Manufacturer, Brand, ProductName, CAST(a AS DOUBLE) AS TotalSalesAmount, CAST(r AS INTEGER) AS "Rank"
FROM (SELECT *, row_number() OVER (PARTITION BY lv, CASE WHEN lv > 1 THEN Manufacturer END, CASE WHEN lv > 2 THEN Brand END
  ORDER BY a DESC, Manufacturer, Brand, ProductName) AS r FROM levels) WHERE r <= 8""", "now", "dproduct"))
def product_drill(spark, sf):
    return V.product_drill(R.mart(spark, sf, "DimProduct"), R.REPORT)


@query("l09_by_place", R.sql("""
SELECT District, Municipality, CAST((1 - grouping(District)) + (1 - grouping(Municipality)) AS INTEGER) AS "Level", CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount
FROM now JOIN dlocation ON FK_Location = SK_Location GROUP BY ROLLUP (District, Municipality)""", "now", "dlocation"))
def by_place(spark, sf):
    return V.by_place(R.mart(spark, sf, "DimLocation"), R.REPORT)


@query("l10_by_municipality", R.sql(f"SELECT Municipality, {_A} FROM now JOIN dlocation ON FK_Location = SK_Location GROUP BY 1", "now", "dlocation"))
def by_municipality(spark, sf):
    return V.by_municipality(R.mart(spark, sf, "DimLocation"), R.REPORT)


@query("l11_by_pos", R.sql(f"SELECT POSName, {_A} FROM now JOIN dpos ON FK_POS = SK_POS GROUP BY 1", "now", "dpos"))
def by_pos(spark, sf):
    return V.by_pos(R.mart(spark, sf, "DimPOS"), R.REPORT)


@query("l12_by_pharmacy", R.sql(f"SELECT PharmacyName, {_A}, {_Q} FROM now {_PHARMACY_JOIN} GROUP BY 1", "now", "dpharmacy"))
def by_pharmacy(spark, sf):
    return V.by_pharmacy(R.mart(spark, sf, "DimPharmacy"), R.REPORT)


@query("l13_district_tooltip", R.sql(f"""
SELECT GenericLabel, {_A}, 'EUROPE' AS Title FROM now JOIN dproduct ON FK_Product = SK_Product JOIN dlocation ON FK_Location = SK_Location
WHERE District = 'EUROPE' GROUP BY 1""", "now", "dproduct", "dlocation"))
def district_tooltip(spark, sf):
    return V.district_tooltip(R.mart(spark, sf, "DimProduct", "DimLocation"), R.REPORT, "EUROPE")


@query("l15_pharmacy_card", "SELECT count(DISTINCT s_suppkey) AS PharmacyCount FROM supplier")
def pharmacy_card(spark, sf):
    return V.pharmacy_card(R.mart(spark, sf, "DimPharmacy"), R.REPORT)


def _segment_mart(spark, sf):
    return R.mart(spark, sf, "DimPharmacy", "PharmacySegmentation")


@query("l16_branded_share_card", R.sql("SELECT round(avg(BrandedSalesShare), 6) AS AvgBrandedSalesShare FROM segments", "segments"))
def branded_share_card(spark, sf):
    return V.branded_share_card(_segment_mart(spark, sf), R.REPORT).select(F.round("AvgBrandedSalesShare", 6).alias("AvgBrandedSalesShare"))


@query("l17_segment_behaviour", R.sql("""
SELECT SegmentLabel, round(avg(MonthlySalesIntensity), 4) AS AvgMonthlySalesIntensity, round(avg(AvgTransactionAmount), 4) AS AvgTransactionAmount
FROM segments GROUP BY 1""", "segments"))
def segment_behaviour(spark, sf):
    rows = V.segment_behaviour(_segment_mart(spark, sf), R.REPORT)
    return rows.select("SegmentLabel", *(F.round(c, 4).alias(c) for c in ("AvgMonthlySalesIntensity", "AvgTransactionAmount")))


@query("l18_segment_table", R.sql(f"""
SELECT PharmacyName, SegmentLabel, {_Q}, {_A} FROM now JOIN segments ON FK_Pharmacy = PharmacyID GROUP BY 1, 2""", "now", "segments"))
def segment_table(spark, sf):
    return V.segment_table(_segment_mart(spark, sf), R.REPORT)


@query("l20_quarter_view", R.sql(f"""
SELECT CASE WHEN grouping("Year") = 1 THEN 'Growth card' WHEN grouping("Month") = 1 THEN 'Yearly indicator' ELSE 'Month' END AS Visual,
  {_MONTH}, {_CA}, CAST(sum(q) AS BIGINT) AS TotalQuantity, {_PA}, {_PQ}, {_GA}, {_GQ},
  CAST(coalesce(sum(a), 0) - coalesce(sum(pa), 0) AS DOUBLE) / CAST(sum(pa) AS DOUBLE) AS SalesYoYPct
FROM quarter_both GROUP BY GROUPING SETS (({_MONTH}), ("Year"), ())""", "quarter_both"))
def quarter_view(spark, sf):
    return V.quarter_view(R.mart(spark, sf), R.REPORT, R.QUARTER)


def _visual(name: str, label: str, join: str) -> str:
    return (
        f"SELECT '{name}' AS Visual, {label} AS Label, {_A} FROM now JOIN dlocation l ON now.FK_Location = l.SK_Location "
        f"{join} WHERE District = 'AFRICA' GROUP BY {label}"
    )


@query("l21_district_view", R.sql(
    _visual("Municipality", "Municipality", "") + " UNION ALL " + _visual("Point of sale", "POSName", "JOIN dpos ON FK_POS = SK_POS")
    + " UNION ALL " + _visual("Pharmacy", "PharmacyName", _PHARMACY_JOIN), "now", "dlocation", "dpos", "dpharmacy"))
def district_view(spark, sf):
    mart = R.mart(spark, sf, "DimLocation", "DimPOS", "DimPharmacy")
    return V.district_view(mart, R.REPORT, ("DimLocation", "District", "AFRICA"))


@query("l22_segment_view", R.sql(f"""
SELECT PharmacyName, SegmentLabel, {_Q}, {_A},
  (SELECT round(avg(BrandedSalesShare), 6) FROM segments WHERE SegmentLabel = 'High-value pharmacies') AS AvgBrandedSalesShare,
  (SELECT round(avg(MonthlySalesIntensity), 4) FROM segments WHERE SegmentLabel = 'High-value pharmacies') AS AvgMonthlySalesIntensity,
  (SELECT round(avg(AvgTransactionAmount), 4) FROM segments WHERE SegmentLabel = 'High-value pharmacies') AS AvgTransactionAmount
FROM now JOIN segments ON FK_Pharmacy = PharmacyID WHERE SegmentLabel = 'High-value pharmacies' GROUP BY 1, 2""", "now", "segments"))
def segment_view(spark, sf):
    rows = V.segment_view(_segment_mart(spark, sf), R.REPORT)
    digits = {"AvgBrandedSalesShare": 6, "AvgMonthlySalesIntensity": 4, "AvgTransactionAmount": 4}
    return rows.withColumns({c: F.round(c, n) for c, n in digits.items()})
