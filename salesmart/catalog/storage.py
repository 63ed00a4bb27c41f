"""Sources (A) and sinks (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.catalog import roles as R
from salesmart.catalog.registry import query
from salesmart.contracts import CONTRACTS, conform, differences, guarded
from salesmart.plans import dimensions as B
from salesmart.plans import incremental as I
from salesmart.sources import delimited as C
from salesmart.sources import generators as G
from salesmart.sources import tables as T
from salesmart.workspace import run_dir


@query("a01_headered_csv", """
SELECT CAST(c_custkey AS VARCHAR) AS "Operator id", split_part(c_name, '#', 1) AS first_name,
  split_part(c_name, '#', 2) AS last_name, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS gender,
  '"' || c_mktsegment AS "role", CAST(c_nationkey AS VARCHAR) AS team
FROM customer""")
def headered_csv(spark, sf):
    feed = R.operator_feed(spark, sf).withColumn("role", F.concat(F.lit('"'), "role")).withColumn("extra", F.lit("x"))
    path = C.write_delimited(feed, run_dir(spark, "operators"))
    return C.read_headered(spark, path, width=7)


@query("a02_headerless_cp1252", """
SELECT CAST(p_partkey AS VARCHAR) AS CNP, p_name || ' ação “€”' AS ProductName, p_type AS Manufacturer,
  p_brand AS Brand, CAST(p_size AS VARCHAR) AS ProductPresentation, CAST(p_partkey % 4 AS VARCHAR) AS GenericRaw
FROM part""")
def headerless_cp1252(spark, sf):
    feed = R.table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit(" ação “€”")).alias("n"), "p_type", "p_brand", "p_size",
        (F.col("p_partkey") % 4).alias("g"),
    )
    path = C.write_delimited(feed, run_dir(spark, "products"), header=False, encoding=C.CP1252)
    return C.read_headerless(spark, path, B.PRODUCT_COLUMNS)


@query("a03_quoted_csv_subset", """
SELECT c_mktsegment AS Distrito, c_name || ', "' || c_nationkey || '"' AS Concelho FROM customer""")
def quoted_csv_subset(spark, sf):
    feed = R.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Codigo"), F.col("c_mktsegment").alias("Distrito"),
        F.concat("c_name", F.lit(', "'), F.col("c_nationkey").cast("string"), F.lit('"')).alias("Concelho"),
    )
    path = C.write_delimited(feed, run_dir(spark, "map"), quoted=True)
    return C.read_headered(spark, path, quoted=True).select("Distrito", "Concelho")


@query("a04_encoding_by_trial", """
SELECT e AS Encoding, c_name || ' São João' AS PharmacyName
FROM customer CROSS JOIN (SELECT unnest(['UTF-8', 'windows-1252']) AS e)""")
def encoding_by_trial(spark, sf):
    feed = R.table(spark, sf, "customer").select(F.concat("c_name", F.lit(" São João")).alias("PharmacyName"))
    out = []
    for encoding in (C.UTF8, C.CP1252):
        path = C.write_delimited(feed, run_dir(spark, "trial"), encoding=encoding)
        found = F.lit(C.detect_encoding(spark, path)).alias("Encoding")
        out.append(C.read_any_encoding(spark, path).select(found, "PharmacyName"))
    return out[0].unionByName(out[1])


@query("a05_files_as_one", """
SELECT CAST(s_suppkey AS VARCHAR) AS "Pharmacy ID", '  ' || s_name AS "Nome da farmácia",
  CAST(s_nationkey AS VARCHAR) AS "Localização" FROM supplier""")
def files_as_one(spark, sf):
    paths = [
        C.write_delimited(feed, run_dir(spark, "pharmacies")) for feed in R.pharmacy_feeds(spark, sf)
    ]
    return C.read_parts(spark, paths, width=3, encoding=C.UTF8)


@query("a06_recursive_parquet", """
SELECT l_linenumber AS l_linenumber, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem GROUP BY 1""")
def recursive_parquet(spark, sf):
    path = run_dir(spark, "tree")
    R.table(spark, sf, "lineitem").write.partitionBy("l_returnflag").parquet(path)
    rows = T.scan_tree(spark, path)
    assert "l_returnflag" not in rows.columns
    return rows.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount")
    )


@query("a07_table_scan", R.sql("SELECT * FROM dpharmacy", "dpharmacy"))
def table_scan(spark, sf):
    path = run_dir(spark, "dim_pharmacy")
    R.dim_pharmacy(spark, sf).write.parquet(path)
    return T.scan(spark, path, CONTRACTS["DimPharmacy"])


@query("a08_literal_rows", R.sql("""
SELECT * FROM dproduct UNION ALL
SELECT -1, -1, 'Unknown Product', 'Unknown', 'Unknown', 'Unknown', false, 'Unknown'""", "dproduct"))
def literal_rows(spark, sf):
    return G.unknown_product(spark).unionByName(R.dim_product(spark, sf))


@query("a09_every_day", """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS FullDate
FROM (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem)""")
def every_day(spark, sf):
    return G.every_day(R.bounds(spark, sf)).select("FullDate")


@query("a10_every_minute", """
SELECT CAST(m AS INTEGER) AS minute_of_day, count(l_orderkey) AS Lines, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)), 0) AS BIGINT) AS Qty
FROM (SELECT unnest(range(1440)) AS m) LEFT JOIN lineitem ON l_orderkey % 1440 = m GROUP BY 1""")
def every_minute(spark, sf):
    sold = R.table(spark, sf, "lineitem").groupBy((F.col("l_orderkey") % 1440).cast("int").alias("minute_of_day")).agg(
        F.count(F.lit(1)).alias("Lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("Qty")
    )
    return G.every_minute(spark).join(sold, "minute_of_day", "left").fillna(0)


_HOLIDAYS_SQL = ", ".join(f"DATE '{d}'" for d in G.HOLIDAYS)


@query("a11_holiday_list", f"""
SELECT d AS FullDate, count(*) AS Lines FROM (SELECT CAST(l_shipdate + INTERVAL 24 YEAR AS DATE) AS d FROM lineitem)
WHERE d IN ({_HOLIDAYS_SQL}) GROUP BY 1""")
def holiday_list(spark, sf):
    """Sales on holidays, the test calendar moved 24 years on to meet the list."""
    days = R.table(spark, sf, "lineitem").select(F.add_months("l_shipdate", 24 * 12).alias("FullDate"))
    return days.filter(G.is_holiday(F.col("FullDate"))).groupBy("FullDate").agg(F.count(F.lit(1)).alias("Lines"))


@query("a12_query_parameter", """
SELECT o_orderkey AS PK_SaleID, o_orderstatus AS Status FROM orders
WHERE o_orderkey > (SELECT (max(o_orderkey) * 4) // 5 FROM orders)""")
def query_parameter(spark, sf):
    orders = R.table(spark, sf, "orders")
    last_id = orders.agg(F.max("o_orderkey").alias("m")).first().m * 4 // 5
    return orders.filter(F.col("o_orderkey") > F.lit(last_id)).select(
        F.col("o_orderkey").alias("PK_SaleID"), F.col("o_orderstatus").alias("Status")
    )


@query("a13_slicer_dates", R.sql("SELECT DISTINCT FullDate FROM ddate", "ddate"))
def slicer_dates(spark, sf):
    return B.build_slicer(R.dim_date(spark, sf))


# ---- sinks -------------------------------------------------------------------------------

_BY_STATUS = """
SELECT o_orderstatus AS Status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders {where} GROUP BY 1"""


def _by_status(df):
    return df.groupBy(F.col("o_orderstatus").alias("Status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )


@query("b01_replace_load", _BY_STATUS.format(where="WHERE o_orderstatus <> 'P'"))
def replace_load(spark, sf):
    path = run_dir(spark, "orders")
    T.replace(R.table(spark, sf, "orders"), path)
    return _by_status(T.replace(T.scan(spark, path).filter("o_orderstatus <> 'P'"), path))


@query("b02_append_load", _BY_STATUS.format(where=""))
def append_load(spark, sf):
    path, orders = run_dir(spark, "orders"), R.table(spark, sf, "orders")
    T.append(orders.filter("o_orderstatus = 'P'"), path)
    return _by_status(T.append(orders.filter("o_orderstatus <> 'P'"), path))


@query("b03_column_mapping", R.sql("SELECT * FROM dpos", "dpos"))
def column_mapping(spark, sf):
    feed = R.pos_feed(spark, sf)
    return T.mapped(feed, {"POS id": "SK_POS", "name": "POSName", "email": "POSEmail"}, "DimPOS")


@query("b04_truncating_copy", """
SELECT event_id AS RunID, CAST(ts AS DATE) AS ModelRunDate FROM events""")
def truncating_copy(spark, sf):
    rows = T.mapped(R.table(spark, sf, "events"), {"event_id": "RunID", "ts": "ModelRunTimestamp"})
    return rows.select("RunID", F.col("ModelRunTimestamp").cast("date").alias("ModelRunDate"))


@query("b05_export_with_defaults", """
SELECT p_partkey AS CNP, coalesce(CASE WHEN p_size % 5 <> 0 THEN p_brand END, 'Unknown') AS Brand,
  coalesce(CASE WHEN p_size <> 7 THEN p_retailprice END, 0) AS Price FROM part""")
def export_with_defaults(spark, sf):
    gaps = R.table(spark, sf, "part").select(
        F.col("p_partkey").alias("CNP"), F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("Brand"),
        F.when(F.col("p_size") != 7, F.col("p_retailprice")).alias("Price"),
    )
    path = run_dir(spark, "export")
    T.with_defaults(gaps).write.parquet(path)
    return T.scan(spark, path)


@query("b06_stamped_insert", """
SELECT l_suppkey AS FK_Pharmacy, count(*) AS n, true AS Stamped FROM lineitem GROUP BY 1""")
def stamped_insert(spark, sf):
    path = run_dir(spark, "facts")
    rows = R.facts(spark, sf, True, True).withColumn("CurrencyCode", F.lit("EUR"))
    stamped = conform(rows.withColumn("LoadDateTime", F.localtimestamp()), "FactSales")
    return T.append(stamped, path).groupBy("FK_Pharmacy").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("LoadDateTime").isNotNull()).alias("Stamped")
    )


@query("b08_clear_table", "SELECT count(*) AS RowsBefore, CAST(0 AS BIGINT) AS RowsAfter, 6 AS ColumnsAfter FROM orders")
def clear_table(spark, sf):
    path = run_dir(spark, "orders")
    before = T.replace(R.table(spark, sf, "orders"), path).count()
    after = T.clear(spark, path)
    return after.agg(F.count(F.lit(1)).alias("RowsAfter")).select(
        F.lit(before).cast("bigint").alias("RowsBefore"), "RowsAfter", F.lit(len(after.columns)).alias("ColumnsAfter")
    )


@query("b09_delete_by_key", _BY_STATUS.format(
    where="WHERE o_orderkey <> (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1)"))
def delete_by_key(spark, sf):
    path, orders = run_dir(spark, "orders"), R.table(spark, sf, "orders")
    worst = orders.agg(F.max(F.struct("o_totalprice", "o_orderkey")).alias("w")).first().w.o_orderkey
    T.replace(orders, path)
    return _by_status(T.delete_where(spark, path, F.col("o_orderkey") == worst))


@query("b10_update_control_row", """
SELECT p AS ProcessName, CASE WHEN p = 'Load_FactSales' THEN ts ELSE TIMESTAMP '1900-01-01' END AS LastSourceSaleDateTime,
  CASE WHEN p = 'Load_FactSales' THEN event_id ELSE 0 END AS LastSaleID
FROM (SELECT unnest(['Load_FactSales', 'Load_Other']) AS p)
  CROSS JOIN (SELECT ts, event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)""")
def update_control_row(spark, sf):
    control = G.first_watermark(spark, I.PROCESS).unionByName(G.first_watermark(spark, "Load_Other"))
    loaded = R.table(spark, sf, "events").select(F.col("ts").alias("SourceSaleDateTime"), F.col("event_id").alias("PK_SaleID"))
    path = run_dir(spark, "watermark")
    T.replace(control, path)
    moved = T.update_control(T.scan(spark, path), I.PROCESS, I.next_mark(loaded))
    return T.replace(moved, path).select("ProcessName", "LastSourceSaleDateTime", "LastSaleID")


@query("b11_table_contract", """
SELECT c_nationkey AS Team, count(*) AS Operators, CAST(0 AS BIGINT) AS Differences FROM customer GROUP BY 1""")
def table_contract(spark, sf):
    path = run_dir(spark, "dim_operator")
    T.create(spark, "DimOperator", path)
    T.replace(guarded(R.dim_operator(spark, sf), "DimOperator"), path)
    kept = T.scan(spark, path)
    return kept.groupBy("Team").agg(
        F.count(F.lit(1)).alias("Operators"),
        F.lit(len(differences(kept, "DimOperator"))).cast("bigint").alias("Differences"),
    )
