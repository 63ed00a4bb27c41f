"""Aggregations (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.catalog import roles as R
from salesmart.catalog.registry import query
from salesmart.operators import grouping as A
from salesmart.operators import lookups as J
from salesmart.operators import ordering as O
from salesmart.operators import quality as Q
from salesmart.plans import dimensions as B
from salesmart.plans import measures as M
from salesmart.plans import reports as V
from salesmart.plans import segmentation as P
from salesmart.workspace import settle


@query("f01_first_known_value", R.sql("SELECT CNP, ProductName, Manufacturer, Brand, ProductPresentation FROM built_product", "built_product"))
def first_known_value(spark, sf):
    """A later file has every product again under a name that sorts first; it only fills what was not known."""
    feed = R.product_feed(spark, sf)
    later = R.conflicting(feed, "CNP", "ProductName").withColumns({"Source": F.lit(2), "Manufacturer": F.lit("AAA"), "Brand": F.lit(None).cast("string")})
    return B.grouped_products(B.clean_products(feed.unionByName(later))).drop("GenericLabel")


@query("f02_single_label_or_unknown", R.sql("SELECT CNP, GenericLabel FROM built_product", "built_product"))
def single_label_or_unknown(spark, sf):
    return B.grouped_products(B.clean_products(R.product_feed(spark, sf))).select("CNP", "GenericLabel")


@query("f03_single_value_or_null", """
SELECT o_custkey AS Customer, CASE WHEN count(DISTINCT o_orderpriority) = 1 AND count(*) FILTER (o_orderstatus = 'P') = 0
  THEN min(o_orderpriority) END AS OnlyPriority
FROM orders GROUP BY 1""")
def single_value_or_null(spark, sf):
    """Open orders have no priority, which counts as one more value."""
    rows = R.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("Customer"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("p")
    )
    return rows.groupBy("Customer").agg(A.single_value(F.col("p")).alias("OnlyPriority"))


@query("f04_unique_keys", """
SELECT lower(p_name) || ' ' || p_partkey % 1000 AS ProductName, min(p_type) AS Manufacturer FROM part
GROUP BY 1 HAVING count(DISTINCT p_type) = 1""")
def unique_keys(spark, sf):
    """Names with the end of their code: some are unique and some are not at every size."""
    name = F.concat_ws(" ", F.upper("p_name"), (F.col("p_partkey") % 1000).cast("string"))
    names = R.table(spark, sf, "part").select(name.alias("ProductName"), F.col("p_type").alias("Manufacturer"))
    return J.unique_map(names, "ProductName", "Manufacturer", fold=True)


@query("f05_store_features", R.sql("""
SELECT PharmacyID, PharmacyName, CAST(FK_Location AS VARCHAR) AS LocationCode, Municipality AS LocationName, District, Country,
  TotalSalesAmount, TotalQuantity, NumberOfTransactions, ProductVariety, ManufacturerVariety, BrandVariety,
  BrandedSalesAmount, GenericSalesAmount, ActiveMonths, FirstSaleDate, LastSaleDate
FROM features LEFT JOIN dpharmacy ON PharmacyID = SK_Pharmacy LEFT JOIN dlocation ON FK_Location = SK_Location""",
                                  "features", "dpharmacy", "dlocation"))
def store_features(spark, sf):
    rows = R.features(spark, sf)
    ratios = ("AvgTransactionAmount", "MonthlySalesIntensity", "BrandedSalesShare", "GenericSalesShare", "RecencyDays")
    return rows.drop(*ratios).withColumns({c: F.col(c).cast("date") for c in ("FirstSaleDate", "LastSaleDate")})


@query("f06_conditional_sums", R.sql("""
SELECT FK_Pharmacy, CAST(sum(CASE WHEN IsGeneric THEN 0 ELSE Amount END) AS DOUBLE) AS BrandedAmount,
  CAST(sum(CASE WHEN IsGeneric THEN Amount ELSE 0 END) AS DOUBLE) AS GenericAmount
FROM fact JOIN dproduct ON FK_Product = SK_Product GROUP BY 1""", "fact", "dproduct"))
def conditional_sums(spark, sf):
    kinds = R.dim_product(spark, sf).select("SK_Product", "IsGeneric")
    sold = R.facts(spark, sf).groupBy("FK_Pharmacy", "FK_Product").agg(F.sum("Amount").alias("Amount"))
    return sold.join(kinds, F.col("FK_Product") == F.col("SK_Product")).groupBy("FK_Pharmacy").agg(
        A.sum_if(~F.col("IsGeneric"), F.col("Amount")).alias("BrandedAmount"),
        A.sum_if(F.col("IsGeneric"), F.col("Amount")).alias("GenericAmount"),
    )


@query("f07_ratio_metrics", R.sql("""
SELECT PharmacyID, AvgTransactionAmount, MonthlySalesIntensity, BrandedSalesShare, GenericSalesShare FROM features""", "features"))
def ratio_metrics(spark, sf):
    return R.features(spark, sf).select(
        "PharmacyID", "AvgTransactionAmount", "MonthlySalesIntensity", "BrandedSalesShare", "GenericSalesShare"
    )


@query("f08_recency_days", R.sql("SELECT PharmacyID, RecencyDays FROM features", "features"))
def recency_days(spark, sf):
    return R.features(spark, sf).select("PharmacyID", "RecencyDays")


_PROFILE = ", ".join(f"round({c}, 4) AS {c}" for c in P.PROFILE)


@query("f09_cluster_profile", R.sql(f"SELECT ClusterID, NumberOfPharmacies, {_PROFILE} FROM profile", "profile"))
def cluster_profile(spark, sf):
    profile = P.cluster_profile(R.clustered(spark, sf))
    return profile.select("ClusterID", "NumberOfPharmacies", *(F.round(c, 4).alias(c) for c in P.PROFILE))


_SUMMARY = ", ".join(f"round(avg({c}), 4) AS {out}" for out, c in P.SUMMARY.items())


@query("f10_segment_summary", R.sql(
    f"SELECT SegmentLabel, count(DISTINCT PharmacyID) AS NumberOfPharmacies, {_SUMMARY} FROM segments GROUP BY 1", "segments"))
def segment_summary(spark, sf):
    rows = P.segment_summary(R.segments(spark, sf))
    return rows.select("SegmentLabel", "NumberOfPharmacies", *(F.round(c, 4).alias(c) for c in P.SUMMARY))


@query("f11_count_per_label", "SELECT o_orderpriority AS Label, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC")
def count_per_label(spark, sf):
    return Q.distribution(R.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("Label")), "Label", "n")


@query("f12_control_totals", R.sql("""
SELECT count(*) AS FactSalesRows, CAST(sum(Qty) AS BIGINT) AS TotalQuantity, CAST(sum(Amount) AS DOUBLE) AS TotalAmount,
  min(SourceSaleDateTime) AS FirstSaleDateTime, max(SourceSaleDateTime) AS LastSaleDateTime FROM fact""", "fact"))
def control_totals(spark, sf):
    return Q.control_totals(R.facts(spark, sf))


_COUNTED = {"FactSales": "lineitem", "DimProduct": "part", "DimLocation": "nation", "DimPharmacy": "supplier", "DimOperator": "customer"}


@query("f13_row_counts_wide", "SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS {n}Rows" for n, t in _COUNTED.items()))
def row_counts_wide(spark, sf):
    return A.row_counts({n: R.table(spark, sf, t) for n, t in _COUNTED.items()})


@query("f14_additive_measures", R.sql("""
SELECT FK_Pharmacy, CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount, CAST(sum(Qty) AS BIGINT) AS TotalQuantity FROM fact GROUP BY 1""", "fact"))
def additive_measures(spark, sf):
    return R.facts(spark, sf).groupBy("FK_Pharmacy").agg(
        F.sum("Amount").alias(M.AMOUNT), F.sum(F.col("Qty").cast("bigint")).alias(M.QTY)
    )


@query("f15_distinct_dimension_keys", "SELECT count(DISTINCT s_suppkey) AS PharmacyCount FROM supplier")
def distinct_dimension_keys(spark, sf):
    return R.dim_pharmacy(spark, sf).agg(F.count_distinct("SK_Pharmacy").alias("PharmacyCount"))


@query("f16_implicit_aggregates", """
SELECT c_mktsegment AS "Role", round(sum(c_acctbal), 2) AS SumOf, round(avg(c_acctbal), 6) AS AverageOf, min(c_name) AS FirstOf FROM customer GROUP BY 1""")
def implicit_aggregates(spark, sf):
    return R.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("Role")).agg(
        F.round(F.sum("c_acctbal"), 2).alias("SumOf"), F.round(F.avg("c_acctbal"), 6).alias("AverageOf"), F.min("c_name").alias("FirstOf")
    )


def _describe_sql(relation: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS Feature, count({c}) AS \"Count\", round(avg({c}), 4) AS Mean, round(stddev_samp({c}), 4) AS Std, "
        f"CAST(round(min({c}), 4) AS DOUBLE) AS \"Min\", round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS P25, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS P50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS P75, "
        f"CAST(round(max({c}), 4) AS DOUBLE) AS \"Max\" FROM {relation}"
        for c in columns
    )


def _rounded(df):
    return df.select("Feature", "Count", *(F.round(c, 4).alias(c) for c in ("Mean", "Std", "Min", "P25", "P50", "P75", "Max")))


@query("f17_describe_features", R.sql(_describe_sql("features", P.FEATURES), "features"))
def describe_features(spark, sf):
    return _rounded(O.describe(settle(R.features(spark, sf), "features"), P.FEATURES))


@query("f17_describe_sales", _describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def describe_sales(spark, sf):
    """The same statistics over the whole sales table, where a few values hold most rows."""
    return _rounded(O.describe(R.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


_VALID = "l_tax <> 0.08 AND l_discount <> 0.1"


@query("f18_quality_summary", f"""
SELECT unnest(['Initial sales rows', 'Valid rows after analytical preprocessing', 'Removed rows',
    'Distinct pharmacies in sales', 'Distinct products in sales']) AS Metric,
  unnest([count(*), count(*) FILTER ({_VALID}), count(*) FILTER (NOT ({_VALID})),
    count(DISTINCT l_suppkey) FILTER ({_VALID}), count(DISTINCT l_partkey) FILTER ({_VALID})]) AS "Value"
FROM lineitem""")
def quality_summary(spark, sf):
    feed = R.sales_feed(spark, sf).withColumnsRenamed({"Sale ID": "SaleID", "Pharmacy": "PharmacyID"})
    return P.quality_summary(P.prepare_sales(feed))


@query("f19_join_coverage", R.sql("""
SELECT unnest(['Sales rows after enrichment', 'Rows without product match', 'Rows without pharmacy match', 'Rows with unknown district']) AS Metric,
  unnest([count(*), count(*) FILTER (p_partkey IS NULL), count(*) FILTER (s_suppkey IS NULL), count(*) FILTER (s_suppkey IS NULL)]) AS "Value"
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_brand <> 'Brand#7'
  LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal >= 0"""))
def join_coverage(spark, sf):
    products = R.dim_product(spark, sf).filter("Brand <> 'Brand#7'").withColumn("ProductType", F.col("GenericLabel"))
    good = R.table(spark, sf, "supplier").filter("s_acctbal >= 0").select("s_suppkey")
    stores = R.stores(spark, sf).join(good, F.col("PharmacyID") == F.col("s_suppkey"), "left_semi")
    return P.coverage_summary(R.valid_sales(spark, sf), products, stores)


@query("f20_correction_sources", R.sql("""
SELECT unnest(['Locations in source', 'Locations corrected from municipality mapping', 'Locations corrected from parish mapping',
    'Locations corrected from final parish mapping', 'Locations corrected from manual override', 'Locations using original district',
    'Locations still unknown']) AS Metric,
  unnest([count(*), count(*) FILTER (DistrictCorrectionSource = 'municipality_mapping'), count(*) FILTER (DistrictCorrectionSource = 'parish_mapping'),
    count(*) FILTER (DistrictCorrectionSource = 'final_parish_mapping'), count(*) FILTER (DistrictCorrectionSource = 'manual_override'),
    count(*) FILTER (DistrictCorrectionSource = 'original_locations'), count(*) FILTER (District = 'Unknown')]) AS "Value"
FROM corrected_location""", "corrected_location"))
def correction_sources(spark, sf):
    return B.correction_summary(B.corrected_locations(R.location_feed(spark, sf), R.map_feed(spark, sf), R.MANUAL_KEYS))


def _levels_sql(relation: str, levels: list[str]) -> str:
    cols = ", ".join(f'"{c}"' for c in levels)
    level = " + ".join(f'(1 - grouping("{c}"))' for c in levels)
    return (
        f"SELECT {cols}, CAST({level} AS INTEGER) AS \"Level\", CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount "
        f"FROM {relation} GROUP BY ROLLUP ({cols})"
    )


@query("f21_date_hierarchy", R.sql(_levels_sql("fact JOIN ddate ON FK_Date = SK_Date", ["Year", "QuarterName", "MonthName"]), "fact", "ddate"))
def date_hierarchy(spark, sf):
    levels = ["Year", "QuarterName", "MonthName"]
    rows = M.sales(R.mart(spark, sf), M.FilterContext(), tuple(("DimDate", c) for c in levels))
    return A.drill(rows, levels, [F.sum(M.AMOUNT).alias(M.AMOUNT)])


@query("f21_product_hierarchy", R.sql(_levels_sql("fact JOIN dproduct ON FK_Product = SK_Product", V.PRODUCT_LEVELS), "fact", "dproduct"))
def product_hierarchy(spark, sf):
    rows = M.sales(R.mart(spark, sf, "DimProduct"), M.FilterContext(), tuple(("DimProduct", c) for c in V.PRODUCT_LEVELS))
    return A.drill(rows, V.PRODUCT_LEVELS, [F.sum(M.AMOUNT).alias(M.AMOUNT)])


@query("f21_location_hierarchy", R.sql(_levels_sql(
    "fact JOIN dlocation ON FK_Location = SK_Location", ["Country", "District", "Municipality"]), "fact", "dlocation"))
def location_hierarchy(spark, sf):
    levels = ["Country", "District", "Municipality"]
    rows = M.sales(R.mart(spark, sf, "DimLocation"), M.FilterContext(), tuple(("DimLocation", c) for c in levels))
    return A.drill(rows, levels, [F.sum(M.AMOUNT).alias(M.AMOUNT)])


@query("f22_distinct", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS FullDate FROM lineitem")
def distinct(spark, sf):
    return R.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("FullDate")).distinct()
