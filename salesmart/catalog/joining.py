"""Joins (E), ranking (G), ordering (H) and set operations (I)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.catalog import roles as R
from salesmart.catalog.registry import query
from salesmart.functions import labels as L
from salesmart.functions import text as X
from salesmart.functions.dates import a_year_later
from salesmart.operators import grouping as A
from salesmart.operators import lookups as J
from salesmart.operators import ordering as O
from salesmart.operators import quality as Q
from salesmart.operators.scalar import beside
from salesmart.plans import dimensions as B
from salesmart.plans import incremental as I
from salesmart.plans import measures as M
from salesmart.plans import reports as V
from salesmart.plans import segmentation as P
from salesmart.sources import generators as G


@query("e01_district_lookup", """
SELECT c_custkey AS SK_Operator, CASE WHEN n_regionkey NOT IN (0, 1, 2) THEN r_name END AS DistrictFromMap
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def district_lookup(spark, sf):
    people = R.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("SK_Operator"), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Municipality")
    )
    found = people.join(B.district_map(R.map_feed(spark, sf)), F.col("Municipality") == F.col("Concelho"), "left")
    return found.select("SK_Operator", "DistrictFromMap")


@query("e02_surrogate_or_unknown", """
SELECT CASE WHEN p_brand IS NULL OR p_brand = 'Brand#7' THEN -1 ELSE l_partkey END AS FK_Product, count(*) AS n,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Amount
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def surrogate_or_unknown(spark, sf):
    """One brand is missing from the master data; its sales go to the unknown member."""
    dim = R.dim_product(spark, sf).filter("Brand <> 'Brand#7'").unionByName(G.unknown_product(spark))
    sales = R.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("CNP"), F.col("l_extendedprice").cast("decimal(18,2)").alias("Amount")
    )
    keyed = J.surrogate(sales, "CNP", dim, "CNP", "SK_Product", "FK_Product")
    return keyed.groupBy("FK_Product").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("Amount"))


@query("e03_anti_join_new_rows", """
SELECT o_orderkey AS SaleID, o_custkey AS FK_Operator, o_orderdate AS SourceSaleDateTime FROM orders
WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND NOT o_orderdate < TIMESTAMP '2000-01-01'""")
def anti_join_new_rows(spark, sf):
    """Loaded up to 2000, the batch reaches back to 1999: the overlap must not come twice."""
    orders = R.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("SaleID"), F.col("o_custkey").alias("FK_Operator"), F.col("o_orderdate").alias("SourceSaleDateTime")
    )
    when = F.col("SourceSaleDateTime")
    loaded = orders.filter(when < "2000-01-01").select(F.col("SaleID").alias("PK_SaleID"))
    return J.new_rows(orders.filter(when >= "1999-01-01"), loaded, "SaleID", "PK_SaleID")


@query("e04_orphan_count", """
SELECT count(*) AS OrphanRows FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_type <> 'PROMO' WHERE p_partkey IS NULL""")
def orphan_count(spark, sf):
    dim = R.dim_product(spark, sf).filter("Manufacturer <> 'PROMO'")
    sold = R.facts(spark, sf).groupBy("FK_Product").agg(F.count(F.lit(1)).alias("n"))
    return J.orphans(sold, "FK_Product", dim, "SK_Product").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("OrphanRows"))


@query("e05_two_step_enrichment", R.sql("""
SELECT coalesce(GenericLabel, 'none') AS GenericLabel, PharmacyName, District, count(*) AS n,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS Qty
FROM lineitem LEFT JOIN dproduct ON l_partkey = CNP LEFT JOIN dpharmacy ON l_suppkey = SK_Pharmacy
  LEFT JOIN dlocation ON FK_Location = SK_Location GROUP BY 1, 2, 3""", "dproduct", "dpharmacy", "dlocation"))
def two_step_enrichment(spark, sf):
    products = R.dim_product(spark, sf).select("CNP", "GenericLabel", "IsGeneric", F.col("GenericLabel").alias("ProductType"))
    rows = P.enrich_sales(R.valid_sales(spark, sf), products, R.stores(spark, sf))
    return rows.groupBy(F.coalesce("GenericLabel", F.lit("none")).alias("GenericLabel"), "PharmacyName", "District").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("Qty").cast("bigint")).alias("Qty")
    )


@query("e06_store_place", R.sql("""
SELECT SK_Pharmacy AS PharmacyID, PharmacyName, CAST(FK_Location AS VARCHAR) AS LocationCode, Municipality AS LocationName,
  District, Country FROM dpharmacy LEFT JOIN dlocation ON FK_Location = SK_Location""", "dpharmacy", "dlocation"))
def store_place(spark, sf):
    return R.stores(spark, sf)


@query("e07_map_lookup", """
SELECT c_custkey AS SK_Operator, r_name AS District
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey NOT IN (0, 1, 2)
  LEFT JOIN region ON n_regionkey = r_regionkey""")
def map_lookup(spark, sf):
    """Names match whatever their case, accents and blanks."""
    people = R.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("SK_Operator"),
        X.match_key(F.concat(F.lit("  Nátion_"), F.col("c_nationkey").cast("string"), F.lit(" "))).alias("Concelho"),
    )
    lookup = J.unique_map(R.map_feed(spark, sf), "Concelho", "Distrito", fold=True)
    return people.join(lookup, "Concelho", "left").select("SK_Operator", F.col("Distrito").alias("District"))


@query("e08_profile_to_members", R.sql("""
SELECT PharmacyID, CAST(ClusterID AS BIGINT) AS ClusterID, SegmentRank, SegmentLabel, SegmentDescription FROM segments""", "segments"))
def profile_to_members(spark, sf):
    return R.segments(spark, sf).select("PharmacyID", "ClusterID", "SegmentRank", "SegmentLabel", "SegmentDescription")


@query("e09_star_join", R.sql("""
SELECT "Year", DayPeriod, Manufacturer, PharmacyName, District, "Role", POSName,
  CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount, CAST(sum(Qty) AS BIGINT) AS TotalQuantity
FROM fact LEFT JOIN ddate ON FK_Date = SK_Date LEFT JOIN dtime ON FK_Time = SK_Time LEFT JOIN dproduct ON FK_Product = SK_Product
  LEFT JOIN dpharmacy ON FK_Pharmacy = SK_Pharmacy LEFT JOIN dlocation ON fact.FK_Location = SK_Location
  LEFT JOIN doperator ON FK_Operator = SK_Operator LEFT JOIN dpos ON FK_POS = SK_POS
GROUP BY 1, 2, 3, 4, 5, 6, 7""", "fact", "ddate", "dtime", "dproduct", "dpharmacy", "dlocation", "doperator", "dpos"))
def star_join(spark, sf):
    """All seven dimensions at once."""
    mart = R.mart(spark, sf, "DimTime", "DimProduct", "DimPharmacy", "DimLocation", "DimOperator", "DimPOS")
    by = (
        ("DimDate", "Year"), ("DimTime", "DayPeriod"), ("DimProduct", "Manufacturer"), ("DimPharmacy", "PharmacyName"),
        ("DimLocation", "District"), ("DimOperator", "Role"), ("DimPOS", "POSName"),
    )
    return M.sales(mart, M.FilterContext(), by)


@query("e09_star_join_of_segments", R.sql("""
SELECT "Year", SegmentLabel, dpharmacy.PharmacyName, CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount, CAST(sum(Qty) AS BIGINT) AS TotalQuantity
FROM fact JOIN ddate ON FK_Date = SK_Date LEFT JOIN dpharmacy ON FK_Pharmacy = SK_Pharmacy
  LEFT JOIN (SELECT PharmacyID, SegmentLabel FROM segments) ON FK_Pharmacy = PharmacyID
WHERE ddate.FullDate >= DATE '1993-01-01' AND ddate.FullDate < DATE '1999-01-01'
GROUP BY 1, 2, 3""", "fact", "ddate", "dpharmacy", "segments"))
def star_join_of_segments(spark, sf):
    """The other two links: segments by pharmacy, and the slicer by date."""
    mart = R.mart(spark, sf, "DimPharmacy", "PharmacySegmentation")
    by = (("DimDate", "Year"), ("PharmacySegmentation", "SegmentLabel"), ("DimPharmacy", "PharmacyName"))
    return M.sales(mart, M.FilterContext().within(dt.date(1993, 1, 1), dt.date(1999, 1, 1)), by)


@query("e09_star_join_of_all", R.sql("""
SELECT "Year", DayPeriod, Manufacturer, dpharmacy.PharmacyName, District, "Role", POSName, SegmentLabel,
  CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount, CAST(sum(Qty) AS BIGINT) AS TotalQuantity
FROM fact JOIN ddate ON FK_Date = SK_Date LEFT JOIN dtime ON FK_Time = SK_Time LEFT JOIN dproduct ON FK_Product = SK_Product
  LEFT JOIN dpharmacy ON FK_Pharmacy = SK_Pharmacy LEFT JOIN dlocation ON fact.FK_Location = SK_Location
  LEFT JOIN doperator ON FK_Operator = SK_Operator LEFT JOIN dpos ON FK_POS = SK_POS
  LEFT JOIN (SELECT PharmacyID, SegmentLabel FROM segments) ON FK_Pharmacy = PharmacyID
WHERE ddate.FullDate >= DATE '1993-01-01' AND ddate.FullDate < DATE '2100-01-01'
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""", "fact", "ddate", "dtime", "dproduct", "dpharmacy", "dlocation", "doperator", "dpos", "segments"))
def star_join_of_all(spark, sf):
    """All nine links at once: seven dimensions, the segments and the slicer."""
    mart = R.mart(spark, sf, "DimTime", "DimProduct", "DimPharmacy", "DimLocation", "DimOperator", "DimPOS", "PharmacySegmentation")
    by = (
        ("DimDate", "Year"), ("DimTime", "DayPeriod"), ("DimProduct", "Manufacturer"), ("DimPharmacy", "PharmacyName"),
        ("DimLocation", "District"), ("DimOperator", "Role"), ("DimPOS", "POSName"), ("PharmacySegmentation", "SegmentLabel"),
    )
    return M.sales(mart, M.FilterContext().within(dt.date(1993, 1, 1), dt.date(2100, 1, 1)), by)


@query("e10_two_way_filter", R.sql("""
SELECT CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount, CAST(sum(Qty) AS BIGINT) AS TotalQuantity, count(DISTINCT FK_Pharmacy) AS Pharmacies
FROM fact WHERE FK_Pharmacy IN (SELECT PharmacyID FROM segments WHERE SegmentLabel = 'High-value pharmacies')""", "fact", "segments"))
def two_way_filter(spark, sf):
    mart = R.mart(spark, sf, "DimPharmacy", "PharmacySegmentation")
    ctx = M.FilterContext().selecting("PharmacySegmentation", "SegmentLabel", "High-value pharmacies")
    return beside(M.sales(mart, ctx), M.pharmacy_count(mart, ctx).select(F.col("PharmacyCount").alias("Pharmacies")))


@query("e11_scalar_beside_rows", """
SELECT o_orderstatus AS Status, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders) AS Share FROM orders GROUP BY 1""")
def scalar_beside_rows(spark, sf):
    orders = R.table(spark, sf, "orders")
    whole = orders.agg(F.count(F.lit(1)).alias("all"))
    counts = orders.groupBy(F.col("o_orderstatus").alias("Status")).agg(F.count(F.lit(1)).alias("n"))
    return beside(counts, whole).select("Status", "n", (F.col("n") / F.col("all")).alias("Share"))


@query("e12_self_join_year_shift", R.sql("""
SELECT FullDate, CAST(Amount AS DOUBLE) AS Amount, CAST(Prior AS DOUBLE) AS Prior
FROM (SELECT FullDate, sum(Amount) AS Amount FROM fact GROUP BY 1)
  JOIN (SELECT CAST(FullDate + INTERVAL 1 YEAR AS DATE) AS d, sum(Amount) AS Prior FROM fact GROUP BY 1) ON FullDate = d""", "fact"))
def self_join_year_shift(spark, sf):
    daily = R.facts(spark, sf).groupBy(F.col("SourceSaleDateTime").cast("date").alias("FullDate")).agg(F.sum("Amount").alias("Amount"))
    shifted = daily.groupBy(a_year_later(F.col("FullDate")).alias("FullDate")).agg(F.sum("Amount").alias("Prior"))
    return daily.join(shifted, "FullDate")


# ---- ranking -----------------------------------------------------------------------------


@query("g01_sequential_key", """
SELECT row_number() OVER (ORDER BY p_partkey) AS SK_Product, p_partkey AS CNP, p_name AS ProductName FROM part""")
def sequential_key(spark, sf):
    rows = R.table(spark, sf, "part").select(F.col("p_partkey").alias("CNP"), F.col("p_name").alias("ProductName"))
    return O.sequential_key(rows, "CNP", "SK_Product")


@query("g02_cluster_rank", R.sql("SELECT CAST(ClusterID AS BIGINT) AS ClusterID, SegmentRank FROM ranked", "ranked"))
def cluster_rank(spark, sf):
    scored = P.scored_profile(P.cluster_profile(R.clustered(spark, sf)))
    return P.ranked_profile(scored).select("ClusterID", "SegmentRank")


@query("g03_first_row_per_key", """
SELECT l_orderkey AS SaleID, l_linenumber AS POS, l_partkey AS CNP, l_suppkey AS PharmacyID, l_quantity AS Qty
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem)
WHERE rn = 1""")
def first_row_per_key(spark, sf):
    rows = R.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SaleID"), F.col("l_linenumber").alias("POS"), F.col("l_partkey").alias("CNP"),
        F.col("l_suppkey").alias("PharmacyID"), F.col("l_quantity").alias("Qty"),
    )
    return A.first_row(rows, ["SaleID"], ["POS", "CNP", "PharmacyID", "Qty"])


@query("g04_rank_labels", R.sql("""
SELECT DISTINCT CAST(ClusterID AS BIGINT) AS ClusterID, SegmentLabel, SegmentDescription FROM ranked""", "ranked"))
def rank_labels(spark, sf):
    ranked = P.ranked_profile(P.scored_profile(P.cluster_profile(R.clustered(spark, sf))))
    return ranked.select("ClusterID", L.segment_label(F.col("SegmentRank")).alias("SegmentLabel"),
                         L.segment_description(F.col("SegmentRank")).alias("SegmentDescription"))


@query("g05_commercial_score", R.sql("""
SELECT CAST(ClusterID AS BIGINT) AS ClusterID, round(CommercialScore, 6) AS CommercialScore FROM scored""", "scored"))
def commercial_score(spark, sf):
    scored = P.scored_profile(P.cluster_profile(R.clustered(spark, sf)))
    return scored.select("ClusterID", F.round("CommercialScore", 6).alias("CommercialScore"))


# ---- ordering ----------------------------------------------------------------------------


@query("h01_sort_descending", "SELECT n_nationkey AS SK_Location, n_name AS Municipality, count(s_suppkey) AS Pharmacies "
       "FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY 1, 2 ORDER BY 1 DESC")
def sort_descending(spark, sf):
    stores = R.table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("Pharmacies"))
    rows = R.table(spark, sf, "nation").join(stores, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return rows.select(
        F.col("n_nationkey").alias("SK_Location"), F.col("n_name").alias("Municipality"), F.coalesce("Pharmacies", F.lit(0)).alias("Pharmacies")
    ).orderBy(F.desc("SK_Location"))


@query("h02_latest_row", "SELECT l_shipdate AS LastSourceSaleDateTime, l_orderkey AS LastSaleID FROM lineitem ORDER BY 1 DESC, 2 DESC LIMIT 1")
def latest_row(spark, sf):
    return I.next_mark(R.facts(spark, sf)).select("LastSourceSaleDateTime", "LastSaleID")


@query("h03_two_key_sort", R.sql("""
SELECT SegmentRank, round(TotalSalesAmount, 2) AS TotalSalesAmount, PharmacyID FROM segments ORDER BY 1, 2 DESC""", "segments"))
def two_key_sort(spark, sf):
    return R.segments(spark, sf).select("SegmentRank", "TotalSalesAmount", "PharmacyID").orderBy("SegmentRank", F.desc("TotalSalesAmount"))


@query("h04_sort_by_measure", R.sql("""
SELECT Brand, CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount FROM fact LEFT JOIN dproduct ON FK_Product = SK_Product
GROUP BY 1 ORDER BY 2 DESC""", "fact", "dproduct"))
def sort_by_measure(spark, sf):
    rows = M.sales(R.mart(spark, sf, "DimProduct"), M.FilterContext(), (("DimProduct", "Brand"),))
    return rows.drop(M.QTY).orderBy(F.desc(M.AMOUNT))


@query("h05_sort_label_by_number", R.sql("""
SELECT MonthName, QuarterName, CAST(sum(Qty) AS BIGINT) AS TotalQuantity FROM fact JOIN ddate ON FK_Date = SK_Date
GROUP BY "Quarter", "Month", MonthName, QuarterName ORDER BY "Quarter", "Month\"""", "fact", "ddate"))
def sort_label_by_number(spark, sf):
    by = tuple(("DimDate", c) for c in ("Quarter", "Month", "MonthName", "QuarterName"))
    rows = M.sales(R.mart(spark, sf), M.FilterContext(), by)
    return rows.orderBy("Quarter", "Month").select("MonthName", "QuarterName", M.QTY)


@query("h06_top_children", R.sql("""
SELECT Manufacturer, Brand, CAST(a AS DOUBLE) AS TotalSalesAmount, CAST(r AS INTEGER) AS "Rank"
FROM (SELECT *, row_number() OVER (PARTITION BY Manufacturer ORDER BY a DESC, Brand) AS r
      FROM (SELECT Manufacturer, Brand, sum(Amount) AS a FROM fact JOIN dproduct ON FK_Product = SK_Product GROUP BY 1, 2))
WHERE r <= 8""", "fact", "dproduct"))
def top_children(spark, sf):
    by = (("DimProduct", "Manufacturer"), ("DimProduct", "Brand"))
    rows = M.sales(R.mart(spark, sf, "DimProduct"), M.FilterContext(), by).drop(M.QTY)
    return O.top_children(rows, ["Manufacturer"], M.AMOUNT, V.CHILDREN_SHOWN, ["Brand"])


# ---- sets --------------------------------------------------------------------------------


@query("i01_union_by_name", """
SELECT CAST(s_suppkey AS VARCHAR) AS "Pharmacy ID", '  ' || s_name AS "Nome da farmácia", CAST(s_nationkey AS VARCHAR) AS "Localização"
FROM supplier""")
def union_by_name(spark, sf):
    a, b = R.pharmacy_feeds(spark, sf)
    return a.unionByName(b)


@query("i02_union_of_counts", """
SELECT 'Row Count' AS ValidationType, t AS TableName, n AS ResultValue, 'Should be > 0' AS ExpectedResult FROM (
  SELECT 'lineitem' AS t, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier)""")
def union_of_counts(spark, sf):
    return Q.row_count_report({t: R.table(spark, sf, t) for t in ("lineitem", "orders", "part", "supplier")})


@query("i03_distinct_on_columns", """
SELECT l_suppkey AS PharmacyID, l_linenumber AS POS, min(l_orderkey) AS SaleID FROM lineitem GROUP BY 1, 2""")
def distinct_on_columns(spark, sf):
    rows = R.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("PharmacyID"), F.col("l_linenumber").alias("POS"), F.col("l_orderkey").alias("SaleID")
    )
    return A.first_row(rows, ["PharmacyID", "POS"], ["SaleID"])


@query("i04_difference_by_key", "SELECT c_custkey AS SK_Operator FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def difference_by_key(spark, sf):
    people = R.table(spark, sf, "customer").select(F.col("c_custkey").alias("SK_Operator"))
    return J.new_rows(people, R.table(spark, sf, "events"), "SK_Operator", "user_id")
