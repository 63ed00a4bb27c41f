"""Projections (C) and filters (D)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.catalog import roles as R
from salesmart.catalog.registry import query
from salesmart.functions import dates as D
from salesmart.functions import numbers as N
from salesmart.functions import text as X
from salesmart.operators import filters as K
from salesmart.operators import lookups as J
from salesmart.operators.scalar import beside
from salesmart.plans import facts as S
from salesmart.plans import incremental as I
from salesmart.plans import segmentation as P
from salesmart.plans import dimensions as B
from salesmart.sources import delimited as C


@query("c01_rename", "SELECT CAST(c_custkey AS VARCHAR) AS SK_Operator, c_mktsegment AS \"Role\" FROM customer")
def rename(spark, sf):
    return R.operator_feed(spark, sf).withColumnsRenamed(B.OPERATOR_COLUMNS).select("SK_Operator", "Role")


@query("c02_select", "SELECT s_suppkey, s_nationkey FROM supplier")
def select(spark, sf):
    return R.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")


@query("c03_drop", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop(spark, sf):
    return R.table(spark, sf, "customer").drop("c_acctbal", "c_mktsegment")


@query("c04_reorder", "SELECT p_size, p_brand, p_type, p_name, p_partkey FROM part")
def reorder(spark, sf):
    return R.table(spark, sf, "part").select("p_size", "p_brand", "p_type", "p_name", "p_partkey")


@query("c05_duplicate_key", "SELECT s_suppkey AS PharmacyID, s_suppkey AS SK_Pharmacy, s_name AS PharmacyName FROM supplier")
def duplicate_key(spark, sf):
    named = R.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("PharmacyID"), F.col("s_name").alias("PharmacyName"))
    return named.withColumn("SK_Pharmacy", F.col("PharmacyID"))


@query("c06_change_type", """
SELECT o_orderkey AS SaleID, TRY_CAST(o_orderpriority AS BIGINT) AS Bad,
  CAST(regexp_extract(o_orderpriority, '^[0-9]+') AS INTEGER) AS Level FROM orders""")
def change_type(spark, sf):
    text = R.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("k"), "o_orderpriority")
    return text.select(
        F.col("k").try_cast("bigint").alias("SaleID"), F.col("o_orderpriority").try_cast("bigint").alias("Bad"),
        X.before(F.col("o_orderpriority"), "-").try_cast("int").alias("Level"),
    )


@query("c07_computed_column", """
SELECT l_linenumber AS POS, CAST(sum(CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS BIGINT)) AS BIGINT) AS KeySum
FROM lineitem GROUP BY 1""")
def computed_column(spark, sf):
    keyed = R.table(spark, sf, "lineitem").withColumn("FK_Date", D.date_key(F.col("l_shipdate")))
    return keyed.groupBy(F.col("l_linenumber").alias("POS")).agg(F.sum("FK_Date").alias("KeySum"))


@query("c08_null_to_unknown_key", """
SELECT CASE WHEN l_discount <> 0.1 THEN l_partkey ELSE -1 END AS FK_Product, count(*) AS n FROM lineitem GROUP BY 1""")
def null_to_unknown_key(spark, sf):
    rows = R.table(spark, sf, "lineitem").select(F.when(F.col("l_discount") != 0.1, F.col("l_partkey")).alias("FK_Product"))
    return rows.withColumn("FK_Product", F.coalesce("FK_Product", F.lit(-1))).groupBy("FK_Product").agg(F.count(F.lit(1)).alias("n"))


@query("c09_fill_labels", """
SELECT o_orderstatus AS Status, coalesce(p, 'Unknown pharmacy') AS PharmacyName, coalesce(r, 'Unknown') AS District, count(*) AS n
FROM orders LEFT JOIN (SELECT s_suppkey, s_name AS p, r_name AS r FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey) ON o_custkey = s_suppkey GROUP BY 1, 2, 3""")
def fill_labels(spark, sf):
    """Orders matched to stores by number; most find none and take the defaults."""
    keys = R.table(spark, sf, "orders").select(F.col("o_custkey").alias("PharmacyID"), F.col("o_orderstatus").alias("Status"))
    side = R.stores(spark, sf).select("PharmacyID", "PharmacyName", "District")
    filled = J.enrich(keys, side, "PharmacyID", {"PharmacyName": "Unknown pharmacy", "District": "Unknown"})
    return filled.groupBy("Status", "PharmacyName", "District").agg(F.count(F.lit(1)).alias("n"))


@query("c10_division_to_zero", """
SELECT o_custkey AS Customer, coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
  / nullif(count(CASE WHEN o_orderstatus = 'F' THEN 1 END), 0), 0) AS PerFinished
FROM orders GROUP BY 1""")
def division_to_zero(spark, sf):
    sums = R.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("Customer")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t"), F.count_if(F.col("o_orderstatus") == "F").alias("n")
    )
    return sums.select("Customer", N.ratio_or_zero(F.col("t"), F.col("n")).alias("PerFinished"))


@query("c11_leading_columns", "SELECT c_custkey AS Code, c_name AS Name, c_nationkey AS Place FROM customer")
def leading_columns(spark, sf):
    return C.first_columns(R.table(spark, sf, "customer"), ["Code", "Name", "Place"])


@query("c12_required_columns", "SELECT c_mktsegment AS Distrito, c_name AS Concelho FROM customer")
def required_columns(spark, sf):
    feed = R.table(spark, sf, "customer").select(F.col("c_mktsegment").alias(" Distrito "), F.col("c_name").alias("Concelho "))
    return C.require_columns(C.trimmed_headers(feed), {"Distrito", "Concelho"})


# ---- filters -----------------------------------------------------------------------------


@query("d01_key_and_name_present", """
SELECT p_partkey AS k, p_name AS n FROM part WHERE p_size % 5 <> 0 AND p_brand <> 'Brand#1'""")
def key_and_name_present(spark, sf):
    """Rows lose their key or their name by attribute; only whole ones pass."""
    rows = R.table(spark, sf, "part").select(
        F.when(F.col("p_size") % 5 != 0, F.col("p_partkey")).alias("k"),
        F.when(F.col("p_brand") != "Brand#1", F.col("p_name")).otherwise(" \t").alias("n"),
    )
    return K.keyed_and_named(rows, "k", "n")


@query("d02_valid_code", "SELECT p_partkey AS CNP, p_name AS ProductName FROM part WHERE p_type <> 'PROMO'")
def valid_code(spark, sf):
    text = F.when(F.col("p_type") == "PROMO", F.concat(F.lit("x"), F.col("p_partkey").cast("string"))).otherwise(
        R.code_text(F.col("p_partkey"))
    )
    rows = R.table(spark, sf, "part").select(N.product_code(text).alias("CNP"), F.col("p_name").alias("ProductName"))
    return rows.filter(F.col("CNP").isNotNull())


@query("d03_complete_sales", """
SELECT l_linenumber AS FK_POS, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS Qty FROM lineitem
WHERE l_tax <> 0.08 GROUP BY 1""")
def complete_sales(spark, sf):
    typed = K.complete_computed(S.typed_sales(R.sales_feed(spark, sf)))
    return typed.groupBy(F.col("FK_POS").cast("int").alias("FK_POS")).agg(F.count(F.lit(1)).alias("n"), F.sum("Qty").alias("Qty"))


@query("d04_analytical_sales", """
SELECT l_suppkey AS PharmacyID, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Amount
FROM lineitem WHERE l_quantity > 10 AND l_returnflag <> 'R' AND l_extendedprice >= 20000 GROUP BY 1""")
def analytical_sales(spark, sf):
    """Quantities and amounts are shifted down so that some fall to zero and below; returns lose their product."""
    lines = R.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SaleID"), F.col("l_suppkey").alias("PharmacyID"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("CNP"), F.col("l_shipdate").alias("Datetime"),
        (F.col("l_quantity") - 10).alias("Qty"), (F.col("l_extendedprice").cast("decimal(18,2)") - 20000).alias("Amount"),
    )
    return P.valid_sales(lines).groupBy("PharmacyID").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("Amount") + 20000).cast("decimal(18,2)")).alias("Amount")
    )


@query("d05_above_mark", """
SELECT o_orderkey AS SaleID, o_custkey AS Customer FROM orders
WHERE o_orderkey > (SELECT (max(o_orderkey) * 7) // 10 FROM orders)""")
def above_mark(spark, sf):
    orders = R.table(spark, sf, "orders")
    last = orders.agg(F.max("o_orderkey").alias("m")).first().m * 7 // 10
    return orders.filter(K.above_mark(F.col("o_orderkey"), last)).select(
        F.col("o_orderkey").alias("SaleID"), F.col("o_custkey").alias("Customer")
    )


@query("d06_above_pair", """
SELECT o_orderkey AS SaleID FROM orders
  CROSS JOIN (SELECT o_orderdate AS t, o_orderkey AS i FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey ASC LIMIT 1)
WHERE o_orderdate > t OR (o_orderdate = t AND o_orderkey > i)""")
def above_pair(spark, sf):
    orders = R.table(spark, sf, "orders")
    mark = orders.filter("o_orderstatus = 'F'").agg(
        F.max(F.struct(F.col("o_orderdate").alias("t"), (-F.col("o_orderkey")).alias("i"))).alias("m")
    ).select(F.col("m.t").alias("t"), (-F.col("m.i")).alias("i"))
    later = K.above_pair(F.col("o_orderdate"), F.col("o_orderkey"), F.col("t"), F.col("i"))
    return beside(orders, mark).filter(later).select(F.col("o_orderkey").alias("SaleID"))


@query("d07_exclude_label", R.sql("SELECT * FROM dproduct WHERE GenericLabel <> 'Unknown'", "dproduct"))
def exclude_label(spark, sf):
    return R.dim_product(spark, sf).filter(K.not_in(F.col("GenericLabel"), "Unknown"))


@query("d08_half_open_dates", """
SELECT CAST(l_shipdate AS DATE) AS FullDate, count(*) AS n FROM lineitem
WHERE CAST(l_shipdate AS DATE) >= DATE '1996-01-01' AND CAST(l_shipdate AS DATE) < DATE '2001-07-01' GROUP BY 1""")
def half_open_dates(spark, sf):
    days = R.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("FullDate"))
    kept = days.filter(K.half_open(F.col("FullDate"), dt.date(1996, 1, 1), dt.date(2001, 7, 1)))
    return kept.groupBy("FullDate").agg(F.count(F.lit(1)).alias("n"))


@query("d09_report_filter", R.sql("""
SELECT "Year", count(*) AS n FROM fact JOIN ddate ON FK_Date = SK_Date
WHERE ddate.FullDate > DATE '1995-12-31' AND ddate.FullDate <> DATE '2001-11-04' GROUP BY 1""", "fact", "ddate"))
def report_filter(spark, sf):
    days = R.dim_date(spark, sf).filter(K.after_except(F.col("FullDate"), dt.date(1995, 12, 31), dt.date(2001, 11, 4)))
    facts = R.facts(spark, sf).join(F.broadcast(days.select("SK_Date", "Year")), F.col("FK_Date") == F.col("SK_Date"))
    return facts.groupBy("Year").agg(F.count(F.lit(1)).alias("n"))


@query("d10_exclude_dates", """
SELECT CAST(l_shipdate AS DATE) AS FullDate, count(*) AS n FROM lineitem
WHERE CAST(l_shipdate AS DATE) NOT IN (DATE '2001-11-03', DATE '2001-11-04', DATE '1998-02-28') GROUP BY 1""")
def exclude_dates(spark, sf):
    d = F.col("FullDate")
    days = R.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("FullDate"))
    out = (dt.date(2001, 11, 3), dt.date(2001, 11, 4), dt.date(1998, 2, 28))
    return days.filter(K.not_in(d, *out)).groupBy("FullDate").agg(F.count(F.lit(1)).alias("n"))


@query("d11_having_measure", """
SELECT o_orderkey AS PK_SaleID, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Amount
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1 HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) IS NOT NULL""")
def having_measure(spark, sf):
    """Of all orders those with a total; some have no line at all."""
    totals = R.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("Amount"))
    rows = R.table(spark, sf, "orders").join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    by_order = rows.groupBy(F.col("o_orderkey").alias("PK_SaleID")).agg(F.sum("Amount").alias("Amount"))
    return by_order.filter(F.col("Amount").isNotNull())


@query("d12_cross_filter", R.sql("""
SELECT Municipality, count(*) AS n FROM fact JOIN dlocation ON FK_Location = SK_Location WHERE District = 'ASIA' GROUP BY 1""",
                                "fact", "dlocation"))
def cross_filter(spark, sf):
    place = R.dim_location(spark, sf).filter(F.col("District") == "ASIA").select("SK_Location", "Municipality")
    facts = R.facts(spark, sf, place=True).groupBy("FK_Location").agg(F.count(F.lit(1)).alias("n"))
    return facts.join(place, F.col("FK_Location") == F.col("SK_Location")).groupBy("Municipality").agg(F.sum("n").alias("n"))


@query("d13_between_shares", R.sql("""
SELECT PharmacyID, BrandedSalesShare BETWEEN 0 AND 1 AND GenericSalesShare BETWEEN 0 AND 1 AS Ok FROM features""", "features"))
def between_shares(spark, sf):
    ok = F.col("BrandedSalesShare").between(0, 1) & F.col("GenericSalesShare").between(0, 1)
    return R.features(spark, sf).select("PharmacyID", ok.alias("Ok"))


@query("d14_set_membership", """
SELECT c_custkey AS SK_Operator FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey IN (SELECT user_id FROM events)""")
def set_membership(spark, sf):
    people = R.table(spark, sf, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    keys = R.table(spark, sf, "events").select("user_id")
    return people.join(keys, F.col("c_custkey") == F.col("user_id"), "left_semi").select(F.col("c_custkey").alias("SK_Operator"))


@query("d15_control_lookup", """
SELECT event_type AS ProcessName, max(ts) AS LastSourceSaleDateTime, max(event_id) AS LastSaleID
FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def control_lookup(spark, sf):
    """One control row per kind of event; the purchases' row is read back."""
    control = R.table(spark, sf, "events").groupBy(F.col("event_type").alias("ProcessName")).agg(
        F.max("ts").alias("LastSourceSaleDateTime"), F.max("event_id").alias("LastSaleID")
    )
    return I.mark_row(control, "purchase").select(F.lit("purchase").alias("ProcessName"), "*")
