"""The parts the test tables play, once as DataFrames and once as SQL.

``lineitem`` is the sales feed, ``part`` the products, ``supplier`` the
pharmacies, ``nation``/``region`` the places, ``customer`` the operators.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.contracts import conform
from salesmart.functions import dates as D
from salesmart.functions import labels as L
from salesmart.operators.scalar import beside
from salesmart.plans import dimensions as B
from salesmart.plans import segmentation as P
from salesmart.plans.measures import FilterContext, Mart
from salesmart.sources import generators as G
from salesmart.workspace import settle

REPORT = FilterContext(after=dt.date(1995, 12, 31), without=(dt.date(2001, 11, 4),)).within(
    dt.date(1996, 1, 1), dt.date(2001, 7, 1)
)
REPORT_SQL = (
    "FullDate > DATE '1995-12-31' AND FullDate <> DATE '2001-11-04' "
    "AND FullDate >= DATE '1996-01-01' AND FullDate < DATE '2001-07-01'"
)
QUARTER = (dt.date(1998, 1, 1), dt.date(1998, 4, 1))
QUARTER_SQL = (
    "FullDate > DATE '1995-12-31' AND FullDate <> DATE '2001-11-04' "
    "AND FullDate >= DATE '1998-01-01' AND FullDate < DATE '1998-04-01'"
)
MANUAL = {"NATION_0": "Aveiro"}
MANUAL_KEYS = {"nation_0": "Aveiro"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hash the same type."""
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema
        )
    )


# ---- facts -------------------------------------------------------------------------------

CTE: dict[str, str] = {}

CTE["fact"] = """
SELECT l_orderkey AS PK_SaleID,
  CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS FK_Date,
  CAST(((l_orderkey % 1440) // 60) * 100 + l_orderkey % 60 AS INTEGER) AS FK_Time,
  l_partkey AS FK_Product, l_suppkey AS FK_Pharmacy, CAST(s_nationkey AS BIGINT) AS FK_Location,
  o_custkey AS FK_Operator, CAST(l_linenumber AS BIGINT) AS FK_POS,
  CAST(l_quantity AS INTEGER) AS Qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS Amount,
  l_shipdate AS SourceSaleDateTime, CAST(l_shipdate AS DATE) AS FullDate
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
"""


def facts(spark: SparkSession, sf: str, place: bool = False, operator: bool = False) -> DataFrame:
    """Sales facts; the keys that need a join are only there when asked for."""
    rows = table(spark, sf, "lineitem")
    extra: list[Column] = []
    if place:
        rows = rows.join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        extra.append(F.col("s_nationkey").cast("bigint").alias("FK_Location"))
    if operator:
        rows = rows.join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        extra.append(F.col("o_custkey").alias("FK_Operator"))
    return rows.select(
        F.col("l_orderkey").alias("PK_SaleID"), D.date_key(F.col("l_shipdate")).alias("FK_Date"),
        D.minute_key(F.col("l_orderkey") % 1440).alias("FK_Time"), F.col("l_partkey").alias("FK_Product"),
        F.col("l_suppkey").alias("FK_Pharmacy"), *extra, F.col("l_linenumber").cast("bigint").alias("FK_POS"),
        F.col("l_quantity").cast("int").alias("Qty"), F.col("l_extendedprice").cast("decimal(18,2)").alias("Amount"),
        F.col("l_shipdate").alias("SourceSaleDateTime"),
    )


# ---- dimensions --------------------------------------------------------------------------

CTE["ddate"] = """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS SK_Date, d AS FullDate,
  CAST(day(d) AS SMALLINT) AS "Day", dayname(d) AS DayName,
  CAST((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 AS SMALLINT) AS WeekNumber,
  CAST(month(d) AS SMALLINT) AS "Month", monthname(d) AS MonthName,
  CAST(quarter(d) AS SMALLINT) AS "Quarter", 'Q' || quarter(d) AS QuarterName, CAST(year(d) AS SMALLINT) AS "Year",
  isodow(d) >= 6 AS IsWeekend, dayofyear(d) <= dayofyear(hi) AS YTDFlag
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d, hi
      FROM (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem))
"""


def bounds(spark: SparkSession, sf: str) -> DataFrame:
    return G.date_bounds(table(spark, sf, "lineitem"), F.col("l_shipdate"))


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return B.build_date(bounds(spark, sf))


CTE["dproduct"] = """
SELECT p_partkey AS SK_Product, p_partkey AS CNP, p_name AS ProductName, p_type AS Manufacturer, p_brand AS Brand,
  CAST(p_size AS VARCHAR) AS ProductPresentation, p_partkey % 4 IN (0, 1) AS IsGeneric,
  CASE p_partkey % 4 WHEN 0 THEN 'Generic' WHEN 1 THEN 'Generic' WHEN 2 THEN 'Branded' ELSE 'Unknown' END AS GenericLabel
FROM part
"""


def raw_generic(key: Column) -> Column:
    kind = key % 4
    return F.when(kind == 0, "Y").when(kind == 1, "s").when(kind == 2, "N")


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    label = L.generic_label(raw_generic(F.col("p_partkey")))
    return conform(
        table(spark, sf, "part").select(
            F.col("p_partkey").alias("SK_Product"), F.col("p_partkey").alias("CNP"), F.col("p_name").alias("ProductName"),
            F.col("p_type").alias("Manufacturer"), F.col("p_brand").alias("Brand"),
            F.col("p_size").alias("ProductPresentation"), (label == "Generic").alias("IsGeneric"),
            label.alias("GenericLabel"),
        ),
        "DimProduct",
    )


CTE["dpharmacy"] = """
SELECT s_suppkey AS SK_Pharmacy, s_name AS PharmacyName, CAST(s_nationkey AS BIGINT) AS FK_Location FROM supplier
"""


def dim_pharmacy(spark: SparkSession, sf: str) -> DataFrame:
    return conform(
        table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("SK_Pharmacy"), F.col("s_name").alias("PharmacyName"),
            F.col("s_nationkey").alias("FK_Location"),
        ),
        "DimPharmacy",
    )


CTE["dlocation"] = """
SELECT CAST(n_nationkey AS BIGINT) AS SK_Location, n_name AS Municipality, r_name AS District, 'Portugal' AS Country
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""


def places(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )


def dim_location(spark: SparkSession, sf: str) -> DataFrame:
    return conform(
        places(spark, sf).select(
            F.col("n_nationkey").alias("SK_Location"), F.col("n_name").alias("Municipality"),
            F.col("r_name").alias("District"), F.lit("Portugal").alias("Country"),
        ),
        "DimLocation",
    )


CTE["doperator"] = """
SELECT c_custkey AS SK_Operator, split_part(c_name, '#', 1) AS FirstName, split_part(c_name, '#', 2) AS LastName,
  split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS FullName, CAST(NULL AS VARCHAR) AS Email,
  CAST(NULL AS VARCHAR) AS Gender, c_mktsegment AS "Role", c_nationkey AS Team
FROM customer
"""
CTE["dpos"] = """
SELECT CAST(k AS BIGINT) AS SK_POS, 'POS ' || k AS POSName, CAST(NULL AS VARCHAR) AS POSEmail
FROM (SELECT DISTINCT l_linenumber AS k FROM lineitem)
"""
CTE["dtime"] = """
SELECT CAST((m // 60) * 100 + m % 60 AS INTEGER) AS SK_Time, CAST(m // 60 AS SMALLINT) AS "Hour",
  CAST(m % 60 AS SMALLINT) AS "Minute", lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') AS TimeLabel,
  CASE WHEN m < 360 THEN 'Night' WHEN m < 720 THEN 'Morning' WHEN m < 1080 THEN 'Afternoon' ELSE 'Evening' END AS DayPeriod
FROM (SELECT unnest(range(1440)) AS m)
"""


def dim_operator(spark: SparkSession, sf: str) -> DataFrame:
    return B.build_operator(operator_feed(spark, sf))


def dim_pos(spark: SparkSession, sf: str) -> DataFrame:
    return B.build_pos(pos_feed(spark, sf))


# ---- raw feeds, all text -----------------------------------------------------------------


def operator_feed(spark: SparkSession, sf: str) -> DataFrame:
    pieces = F.split("c_name", "#")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("Operator id"), pieces[0].alias("first_name"), pieces[1].alias("last_name"),
        F.lit(None).cast("string").alias("email"), F.lit(None).cast("string").alias("gender"),
        F.col("c_mktsegment").alias("role"), F.col("c_nationkey").cast("string").alias("team"),
    )


def pos_feed(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("l_linenumber").cast("string")
    return table(spark, sf, "lineitem").select("l_linenumber").distinct().select(
        key.alias("POS id"), F.concat(F.lit("POS "), key).alias("name"), F.lit(None).cast("string").alias("email")
    )


def code_text(key: Column) -> Column:
    """Product codes as they come: every seventh carries ``.0``."""
    return F.concat(key.cast("string"), F.when(key % 7 == 0, ".0").otherwise(""))


def product_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Products, the large ones listed a second time in another spelling and always as branded."""
    parts = table(spark, sf, "part")
    common = (F.col("p_name").alias("ProductName"), F.col("p_type").alias("Manufacturer"))
    size = F.col("p_size").cast("string").alias("ProductPresentation")
    first = parts.select(
        F.lit(0).alias("Source"), F.lit(1).alias("Row"), code_text(F.col("p_partkey")).alias("CNP"), *common,
        F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("Brand"), size,
        raw_generic(F.col("p_partkey")).alias("GenericRaw"),
    )
    again = parts.filter(F.col("p_size") > 40).select(
        F.lit(1).alias("Source"), F.lit(2).alias("Row"), F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(".0 ")).alias("CNP"),
        *common, F.col("p_brand").alias("Brand"), size, F.lit("N").alias("GenericRaw"),
    )
    return first.unionByName(again)


CTE["built_product"] = """
SELECT row_number() OVER (ORDER BY p_partkey) AS SK_Product, p_partkey AS CNP, p_name AS ProductName,
  p_type AS Manufacturer, CASE WHEN p_size % 5 <> 0 OR p_size > 40 THEN p_brand END AS Brand,
  CAST(p_size AS VARCHAR) AS ProductPresentation,
  p_partkey % 4 IN (0, 1) AND p_size <= 40 AS IsGeneric,
  CASE WHEN p_partkey % 4 IN (0, 1) AND p_size <= 40 THEN 'Generic' WHEN p_partkey % 4 = 2 THEN 'Branded'
       ELSE 'Unknown' END AS GenericLabel
FROM part
"""


def sales_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Sales as text; some lines lack their quantity, some their product."""
    rows = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    minute = F.col("l_orderkey") % 1440
    clock = F.concat_ws(":", F.floor(minute / 60).cast("string"), (minute % 60).cast("string"))
    return rows.select(
        F.col("l_orderkey").cast("string").alias("Sale ID"),
        F.concat_ws(" ", F.date_format("l_shipdate", "d/M/yyyy"), clock).alias("Datetime"),
        F.when(F.col("l_discount") != 0.1, code_text(F.col("l_partkey"))).alias("CNP"),
        F.col("l_suppkey").cast("string").alias("Pharmacy"), F.col("l_linenumber").cast("string").alias("POS"),
        F.col("s_nationkey").cast("string").alias("Localização"), F.lit("EUR").alias("Currency"),
        F.when(F.col("l_tax") != 0.08, F.col("l_quantity").cast("int").cast("string")).alias("Qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("Amount"),
        F.col("o_custkey").cast("string").alias("operator_id"),
    )


# What the fact builder should make of sales_feed() and product_feed().
CTE["built_fact"] = """
SELECT l_orderkey AS PK_SaleID,
  CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS FK_Date,
  CAST(((l_orderkey % 1440) // 60) * 100 + l_orderkey % 60 AS INTEGER) AS FK_Time,
  CASE WHEN l_discount <> 0.1 THEN coalesce(SK_Product, -1) ELSE -1 END AS FK_Product,
  l_suppkey AS FK_Pharmacy, CAST(s_nationkey AS BIGINT) AS FK_Location, o_custkey AS FK_Operator,
  CAST(l_linenumber AS BIGINT) AS FK_POS, CAST(l_quantity AS INTEGER) AS Qty,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS Amount, 'EUR' AS CurrencyCode,
  l_shipdate + to_minutes(l_orderkey % 1440) AS SourceSaleDateTime
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN built_product ON l_partkey = CNP
WHERE l_tax <> 0.08
"""


def pharmacy_feeds(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two files: stores in debt and all others; the second has its columns in another order."""
    stores = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("Pharmacy ID"), F.concat(F.lit("  "), "s_name").alias("Nome da farmácia"),
        F.col("s_nationkey").cast("string").alias("Localização"), (F.col("s_acctbal") < 0).alias("debt"),
    )
    columns = ["Pharmacy ID", "Nome da farmácia", "Localização"]
    return stores.filter("debt").select(*columns), stores.filter("not debt").select(*reversed(columns))


def conflicting(feed: DataFrame, key: str, name: str) -> DataFrame:
    """The same rows as a later file has them: under a name that sorts first."""
    return feed.withColumn(name, F.concat(F.lit("AAA "), F.col(f"`{key}`")))


def location_feed(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("n_nationkey")
    return places(spark, sf).select(
        key.cast("string").alias("LocationID"), F.concat(F.lit(" "), "n_name", F.lit("\t")).alias("Municipality"),
        F.when(key % 3 == 0, " ").otherwise(F.col("r_name")).alias("District"), F.lit("Portugal ").alias("Country"),
    )


def map_feed(spark: SparkSession, sf: str) -> DataFrame:
    """District map: places of region 1 are listed as parishes, of region 2 as merged parishes,
    and those of region 0 have a second, conflicting district."""
    nations = places(spark, sf)
    region, key = F.col("n_regionkey"), F.col("n_nationkey").cast("string")
    main = nations.select(
        F.col("r_name").alias("Distrito"), F.when(~region.isin(1, 2), F.col("n_name")).alias("Concelho"),
        F.when(region == 1, F.concat(F.lit("NÁTION_"), key)).alias("Freguesia"),
        F.when(region == 2, F.concat(F.lit(" Natíon_"), key)).alias("Freguesia Final (Pós RATF)"),
    )
    none = F.lit(None).cast("string")
    doubt = nations.filter(region == 0).select(
        F.lit("EUROPA").alias("Distrito"), F.col("n_name").alias("Concelho"), none.alias("Freguesia"),
        none.alias("Freguesia Final (Pós RATF)"),
    )
    return main.unionByName(doubt)


CTE["built_location"] = """
SELECT CAST(n_nationkey AS BIGINT) AS SK_Location, n_name AS Municipality,
  CASE WHEN n_nationkey % 3 <> 0 THEN r_name WHEN n_regionkey NOT IN (0, 1, 2) THEN r_name
       WHEN n_name = 'NATION_0' THEN 'Aveiro' ELSE 'Unknown' END AS District,
  'Portugal' AS Country
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""
CTE["corrected_location"] = """
SELECT CAST(n_nationkey AS VARCHAR) AS LocationCode, n_name AS LocationName,
  CASE WHEN n_regionkey <> 0 THEN r_name WHEN n_name = 'NATION_0' THEN 'Aveiro'
       WHEN n_nationkey % 3 <> 0 THEN r_name ELSE 'Unknown' END AS District,
  'Portugal' AS Country,
  CASE WHEN n_regionkey = 1 THEN 'parish_mapping' WHEN n_regionkey = 2 THEN 'final_parish_mapping'
       WHEN n_regionkey <> 0 THEN 'municipality_mapping' WHEN n_name = 'NATION_0' THEN 'manual_override'
       WHEN n_nationkey % 3 <> 0 THEN 'original_locations' ELSE 'unknown' END AS DistrictCorrectionSource
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""


# ---- store features and a rule-based segmentation ----------------------------------------

CTE["features"] = """
SELECT t.*, date_diff('day', LastSaleDate, max(LastSaleDate) OVER ()) AS RecencyDays,
  TotalSalesAmount / NumberOfTransactions AS AvgTransactionAmount,
  TotalSalesAmount / ActiveMonths AS MonthlySalesIntensity,
  BrandedSalesAmount / TotalSalesAmount AS BrandedSalesShare,
  GenericSalesAmount / TotalSalesAmount AS GenericSalesShare
FROM (
  SELECT l_suppkey AS PharmacyID, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS TotalSalesAmount,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS TotalQuantity, count(DISTINCT l_orderkey) AS NumberOfTransactions,
    count(DISTINCT l_partkey) AS ProductVariety, count(DISTINCT Manufacturer) AS ManufacturerVariety,
    count(DISTINCT Brand) AS BrandVariety,
    CAST(sum(CASE WHEN coalesce(IsGeneric, false) THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS BrandedSalesAmount,
    CAST(sum(CASE WHEN coalesce(IsGeneric, false) THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS GenericSalesAmount,
    count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS ActiveMonths,
    min(CAST(l_shipdate AS DATE)) AS FirstSaleDate, max(CAST(l_shipdate AS DATE)) AS LastSaleDate
  FROM lineitem LEFT JOIN dproduct ON l_partkey = CNP
  GROUP BY l_suppkey
) t
"""


def valid_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Typed sales in the segmentation's own column names."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SaleID"), F.col("l_suppkey").alias("PharmacyID"), F.col("l_partkey").alias("CNP"),
        F.col("l_shipdate").alias("Datetime"), F.col("l_quantity").cast("int").alias("Qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Amount"),
    )


def stores(spark: SparkSession, sf: str) -> DataFrame:
    place = dim_location(spark, sf)
    return dim_pharmacy(spark, sf).join(place, F.col("FK_Location") == F.col("SK_Location"), "left").select(
        F.col("SK_Pharmacy").alias("PharmacyID"), "PharmacyName", F.col("FK_Location").cast("string").alias("LocationCode"),
        F.col("Municipality").alias("LocationName"), "District", "Country",
    )


def features(spark: SparkSession, sf: str) -> DataFrame:
    return P.store_features(valid_sales(spark, sf), dim_product(spark, sf), stores(spark, sf))


# Clusters by a plain rule on sales, so that SQL can state what the model would only learn.
CTE["clustered"] = """
SELECT f.*, PharmacyName, CASE WHEN TotalSalesAmount > 1.05 * m THEN 2 WHEN TotalSalesAmount < 0.95 * m THEN 0 ELSE 1 END AS ClusterID
FROM features f CROSS JOIN (SELECT avg(TotalSalesAmount) AS m FROM features) LEFT JOIN dpharmacy ON PharmacyID = SK_Pharmacy
"""
CTE["profile"] = """
SELECT CAST(ClusterID AS BIGINT) AS ClusterID, count(PharmacyID) AS NumberOfPharmacies,
  avg(TotalSalesAmount) AS AvgTotalSalesAmount, avg(TotalQuantity) AS AvgTotalQuantity,
  avg(NumberOfTransactions) AS AvgNumberOfTransactions, avg(AvgTransactionAmount) AS AvgTransactionAmount,
  avg(MonthlySalesIntensity) AS AvgMonthlySalesIntensity, avg(ProductVariety) AS AvgProductVariety,
  avg(BrandedSalesShare) AS AvgBrandedSalesShare, avg(GenericSalesShare) AS AvgGenericSalesShare,
  avg(RecencyDays) AS AvgRecencyDays
FROM clustered GROUP BY ClusterID
"""
_Z = " + ".join(
    f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0)"
    for c in ("AvgTotalSalesAmount", "AvgNumberOfTransactions", "AvgMonthlySalesIntensity", "AvgProductVariety")
)
CTE["scored"] = f"SELECT *, ({_Z}) / 4 AS CommercialScore FROM profile"
CTE["ranked"] = """
SELECT *, CASE SegmentRank WHEN 1 THEN 'High-value pharmacies' WHEN 2 THEN 'Standard pharmacies'
    WHEN 3 THEN 'Low-value pharmacies' ELSE 'Additional segment ' || SegmentRank END AS SegmentLabel,
  CASE SegmentRank
    WHEN 1 THEN 'Pharmacies with the strongest sales volume, transaction activity and commercial intensity.'
    WHEN 2 THEN 'Pharmacies with intermediate commercial behaviour and stable sales activity.'
    WHEN 3 THEN 'Pharmacies with lower sales intensity or lower transaction activity.'
    ELSE 'Additional behavioural pharmacy segment.' END AS SegmentDescription
FROM (SELECT *, row_number() OVER (ORDER BY CommercialScore DESC, ClusterID) AS SegmentRank FROM scored)
"""
CTE["segments"] = """
SELECT c.*, SegmentRank, SegmentLabel, SegmentDescription FROM clustered c LEFT JOIN ranked r ON c.ClusterID = r.ClusterID
"""
NEEDS = {
    "built_fact": ("built_product",),
    "features": ("dproduct",),
    "clustered": ("features", "dpharmacy"),
    "profile": ("clustered",),
    "scored": ("profile",),
    "ranked": ("scored",),
    "segments": ("clustered", "ranked"),
}


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Features with a cluster each; they are written once, as their mean is needed beside them."""
    rows = settle(features(spark, sf), "features")
    mean = rows.agg(F.avg("TotalSalesAmount").alias("_m"))
    total = F.col("TotalSalesAmount")
    group = F.when(total > 1.05 * F.col("_m"), 2).when(total < 0.95 * F.col("_m"), 0).otherwise(1)
    return beside(rows, mean).withColumn("ClusterID", group.cast("bigint")).drop("_m")


def segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = clustered(spark, sf)
    return P.labelled(rows, P.ranked_profile(P.scored_profile(P.cluster_profile(rows))))


# ---- the star ----------------------------------------------------------------------------

_DIMS = {
    "DimDate": dim_date, "DimProduct": dim_product, "DimPharmacy": dim_pharmacy, "DimLocation": dim_location,
    "DimOperator": dim_operator, "DimPOS": dim_pos, "PharmacySegmentation": segments,
}


def mart(spark: SparkSession, sf: str, *tables: str) -> Mart:
    """The star with the tables a query asks for; the calendar is always there."""
    names = dict.fromkeys(("DimDate", *tables))
    built = {n: _DIMS[n](spark, sf) for n in names if n != "DimTime"}
    if "DimTime" in names:
        built["DimTime"] = B.build_time(spark)
    built["DateSlicer"] = B.build_slicer(built["DimDate"])
    return Mart(facts(spark, sf, "DimLocation" in names, "DimOperator" in names), built)


def sql(body: str, *ctes: str) -> str:
    """A statement with the named common tables, and those they build on, in front."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, ()):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in ctes:
        need(name)
    head = ",\n".join(f'"{n}" AS ({CTE[n].strip()})' for n in ordered)
    return (f"WITH {head}\n" if head else "") + body.strip()
