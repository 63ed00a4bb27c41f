"""The report's queries, one function per visual: (mart, context) -> DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numbers import safe_divide
from salesmart.operators.grouping import drill
from salesmart.operators.ordering import top_children
from salesmart.operators.scalar import beside
from salesmart.plans import measures as M

# The report-wide filter, the slicer and the saved views.
REPORT = M.FilterContext(after=dt.date(2020, 12, 31), without=(dt.date(2023, 6, 2),)).within(
    dt.date(2021, 1, 1), dt.date(2023, 6, 1)
)
QUARTER_VIEW = (dt.date(2022, 1, 1), dt.date(2022, 4, 1))
DISTRICT_VIEW = ("DimLocation", "District", "Braga")
SEGMENT_VIEW = ("PharmacySegmentation", "SegmentLabel", "High-value pharmacies")
CHILDREN_SHOWN = 8

MONTHS = (("DimDate", "Year"), ("DimDate", "Month"), ("DimDate", "MonthName"))


def kpi_cards(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return M.share_card(mart, ctx)


def growth_card(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return M.with_growth(M.sales_with_prior(mart, ctx)).select("SalesGrowthAbsolute", "QuantityGrowthAbsolute")


def sales_by_month(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return M.sales(mart, ctx, MONTHS).drop(M.QTY).orderBy("Year", "Month")


def sales_and_prior_by_month(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return (
        M.sales_with_prior(mart, ctx, MONTHS)
        .select("Year", "Month", "MonthName", M.AMOUNT, M.PRIOR_AMOUNT)
        .orderBy("Year", "Month")
    )


def yearly_kpi(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    """Sales against last year's, per year; the latest year is the one on show."""
    yearly = M.with_year_over_year(M.sales_with_prior(mart, ctx, (("DimDate", "Year"),)))
    return yearly.select("Year", M.AMOUNT, M.PRIOR_AMOUNT, "SalesYoYPct").orderBy("Year")


def latest_year(yearly: DataFrame) -> DataFrame:
    row = F.max_by(F.struct(*yearly.columns), "Year").alias("r")
    return yearly.agg(row).select("r.*")


def by_generic_label(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    known = ctx.excluding("DimProduct", "GenericLabel", "Unknown")
    return M.sales(mart, known, (("DimProduct", "GenericLabel"),)).orderBy(F.desc(M.QTY))


def generic_share(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    """Shares of the handful of labels in their own sum."""
    rows = by_generic_label(mart, ctx).select("GenericLabel", M.AMOUNT)
    whole = F.sum(M.AMOUNT).over(Window.partitionBy())
    return rows.withColumn("ShareOfTotal", safe_divide(F.col(M.AMOUNT).cast("double"), whole.cast("double")))


PRODUCT_LEVELS = ["Manufacturer", "Brand", "ProductName"]


def product_drill(mart: M.Mart, ctx: M.FilterContext, shown: int = CHILDREN_SHOWN) -> DataFrame:
    """Manufacturer, brand, product: the largest children under every parent."""
    by = tuple(("DimProduct", c) for c in PRODUCT_LEVELS)
    leaves = M.sales(mart, ctx, by)
    levels = drill(leaves, PRODUCT_LEVELS, [F.sum(M.AMOUNT).alias(M.AMOUNT)]).filter(F.col("Level") > 0)
    parent = levels.withColumns(
        {
            "_p1": F.when(F.col("Level") > 1, F.col("Manufacturer")),
            "_p2": F.when(F.col("Level") > 2, F.col("Brand")),
        }
    )
    ranked = top_children(parent, ["Level", "_p1", "_p2"], M.AMOUNT, shown, PRODUCT_LEVELS)
    return ranked.select("Level", *PRODUCT_LEVELS, M.AMOUNT, "Rank")


def by_place(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    by = (("DimLocation", "District"), ("DimLocation", "Municipality"))
    return drill(M.sales(mart, ctx, by), [c for _, c in by], [F.sum(M.AMOUNT).alias(M.AMOUNT)])


def by_municipality(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    rows = M.sales(mart, ctx, (("DimLocation", "Municipality"),))
    return rows.select("Municipality", M.AMOUNT).orderBy(F.desc(M.AMOUNT))


def by_pos(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    rows = M.sales(mart, ctx, (("DimPOS", "POSName"),)).select("POSName", M.AMOUNT)
    return rows.filter(F.col(M.AMOUNT).isNotNull()).orderBy(F.desc(M.AMOUNT))


def by_pharmacy(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return M.sales(mart, ctx, (("DimPharmacy", "PharmacyName"),)).orderBy("PharmacyName")


def district_tooltip(mart: M.Mart, ctx: M.FilterContext, district: str) -> DataFrame:
    hovered = ctx.selecting("DimLocation", "District", district)
    rows = M.sales(mart, hovered, (("DimProduct", "GenericLabel"),)).select("GenericLabel", M.AMOUNT)
    title = mart["DimLocation"].filter(hovered.on("DimLocation")).agg(F.min("District").alias("Title"))
    return beside(rows, title)


def pharmacy_card(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return M.pharmacy_count(mart, ctx)


def _segments(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return mart["PharmacySegmentation"].filter(ctx.on("PharmacySegmentation"))


def branded_share_card(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return _segments(mart, ctx).agg(F.avg("BrandedSalesShare").alias("AvgBrandedSalesShare"))


def segment_behaviour(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    rows = _segments(mart, ctx).groupBy("SegmentLabel").agg(
        F.avg("MonthlySalesIntensity").alias("AvgMonthlySalesIntensity"),
        F.avg("AvgTransactionAmount").alias("AvgTransactionAmount"),
    )
    return rows.orderBy(F.desc("AvgMonthlySalesIntensity"))


def segment_table(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    by = (("PharmacySegmentation", "PharmacyName"), ("PharmacySegmentation", "SegmentLabel"))
    return M.sales(mart, ctx, by).select("PharmacyName", "SegmentLabel", M.QTY, M.AMOUNT)


def segment_scatter(mart: M.Mart, ctx: M.FilterContext) -> DataFrame:
    return _segments(mart, ctx).select("SegmentLabel", "PCA1", "PCA2")


def quarter_view(mart: M.Mart, ctx: M.FilterContext, quarter: tuple[dt.date, dt.date] = QUARTER_VIEW) -> DataFrame:
    """Saved view on one quarter: the table by month, the growth card and the yearly indicator, from one scan."""
    months = [c for _, c in MONTHS]
    sums = [F.sum(c).alias(c) for c in (M.AMOUNT, M.QTY, M.PRIOR_AMOUNT, M.PRIOR_QTY)]
    monthly = M.sales_with_prior(mart, ctx.within(*quarter), MONTHS)
    levels = monthly.groupingSets([[*map(F.col, months)], [F.col("Year")], []], *map(F.col, months)).agg(
        *sums, F.grouping("Month").alias("_month"), F.grouping("Year").alias("_year")
    )
    visual = F.when(F.col("_year") == 1, "Growth card").when(F.col("_month") == 1, "Yearly indicator").otherwise("Month")
    rows = M.with_year_over_year(M.with_growth(levels.withColumn("Visual", visual)))
    return rows.drop("_month", "_year").orderBy("Visual", "Year", "Month")


def district_view(mart: M.Mart, ctx: M.FilterContext, selection: tuple[str, str, str] = DISTRICT_VIEW) -> DataFrame:
    """Saved view on one district: municipality, point of sale and pharmacy totals side by side, from one scan."""
    # The names of the visuals.
    visuals = {"Municipality": "Municipality", "POSName": "Point of sale", "PharmacyName": "Pharmacy"}
    by = (("DimLocation", "Municipality"), ("DimPOS", "POSName"), ("DimPharmacy", "PharmacyName"))
    rows = M.sales(mart, ctx.selecting(*selection), by)
    sets = rows.groupingSets([[F.col(c)] for c in visuals], *map(F.col, visuals)).agg(
        F.sum(M.AMOUNT).alias(M.AMOUNT), *(F.grouping(c).alias(f"_{c}") for c in visuals)
    )

    def of(value) -> Column:
        return F.coalesce(*(F.when(F.col(f"_{c}") == 0, value(c)) for c in visuals))

    shown = sets.select(of(lambda c: F.lit(visuals[c])).alias("Visual"), of(F.col).alias("Label"), M.AMOUNT, "_POSName")
    # A point of sale without sales is not shown.
    return shown.filter((F.col("_POSName") == 1) | F.col(M.AMOUNT).isNotNull()).drop("_POSName")


def segment_view(mart: M.Mart, ctx: M.FilterContext, selection: tuple[str, str, str] = SEGMENT_VIEW) -> DataFrame:
    """Saved view on one segment: its pharmacies with their facts, its mean branded share and its behaviour."""
    chosen = ctx.selecting(*selection)
    means = _segments(mart, chosen).agg(
        *(F.avg(c).alias(out) for c, out in (
            ("BrandedSalesShare", "AvgBrandedSalesShare"), ("MonthlySalesIntensity", "AvgMonthlySalesIntensity"),
            ("AvgTransactionAmount", "AvgTransactionAmount"),
        ))
    )
    return beside(segment_table(mart, chosen), means)
