"""Scalar functions (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.catalog import roles as R
from salesmart.catalog.registry import query
from salesmart.functions import dates as D
from salesmart.functions import labels as L
from salesmart.functions import numbers as N
from salesmart.functions import text as X
from salesmart.operators.grouping import single_value
from salesmart.operators.scalar import beside
from salesmart.plans import dimensions as B
from salesmart.sources import generators as G


def _text(c):
    return c.cast("string")


def _days(spark, sf):
    """Every sales date once."""
    return R.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")).distinct()


_DAYS = "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"


@query("j01_clean_text", "SELECT c_custkey AS k, c_name AS t FROM customer")
def clean_text(spark, sf):
    padded = F.concat(F.lit("\t  "), "c_name", F.lit(" \r\n"))
    return R.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), X.clean_text(padded).alias("t"))


@query("j02_upper_lower", "SELECT p_partkey AS k, upper(p_name) AS u, lower(p_brand) AS l FROM part")
def upper_lower(spark, sf):
    return R.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.upper("p_name").alias("u"), F.lower("p_brand").alias("l"))


@query("j03_text_before", "SELECT o_orderkey AS k, split_part(o_orderpriority, '-', 1) AS level FROM orders")
def text_before(spark, sf):
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), X.before(F.col("o_orderpriority"), "-").alias("level"))


@query("j04_contains", "SELECT p_partkey AS k, contains(p_name, 'ring') AS hit FROM part")
def contains(spark, sf):
    return R.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.contains("p_name", F.lit("ring")).alias("hit"))


@query("j05_split_and_index", """
SELECT p_partkey AS k, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second, string_split(p_name, ' ')[3] AS third FROM part""")
def split_and_index(spark, sf):
    name = F.col("p_name")
    return R.table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), X.part(name, " ", 0).alias("first"), X.part(name, " ", 1).alias("second"), X.part(name, " ", 2).alias("third")
    )


@query("j06_full_name", "SELECT c_custkey AS k, c_mktsegment || ' ' || CASE WHEN c_acctbal >= 0 THEN c_name END AS FullName FROM customer")
def full_name(spark, sf):
    last = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    return R.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), X.full_name(F.col("c_mktsegment"), last).alias("FullName"))


@query("j07_pad_left", "SELECT p_partkey AS k, lpad(CAST(p_size AS VARCHAR), 2, '0') AS t FROM part")
def pad_left(spark, sf):
    return R.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), X.zero_padded(F.col("p_size"), 2).alias("t"))


@query("j08_match_key", """
SELECT p_partkey AS k, regexp_replace(trim(strip_accents(lower('  São  João ' || p_name || ' Çà  Ëñ '))), '\\s+', ' ', 'g') AS key FROM part""")
def match_key(spark, sf):
    text = F.concat(F.lit("  São  João "), "p_name", F.lit(" Çà  Ëñ "))
    return R.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), X.match_key(text).alias("key"))


@query("j09_comma_decimal", "SELECT o_orderkey AS k, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v FROM orders")
def comma_decimal(spark, sf):
    good = F.replace(_text(F.col("o_totalprice").cast("decimal(18,2)")), F.lit("."), F.lit(","))
    text = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" "), good)).otherwise("1,234.5")
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), N.comma_decimal(text).alias("v"))


@query("j10_to_int64", """
SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN o_orderkey * 1000 WHEN 'P' THEN 2 END AS v FROM orders""")
def to_int64(spark, sf):
    grouped = F.format_number(F.col("o_orderkey") * 1000, 0)
    text = F.when(F.col("o_orderstatus") == "F", grouped).when(F.col("o_orderstatus") == "P", " 2.5 ").otherwise("x")
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), N.to_int64(text).alias("v"))


@query("j11_to_decimal", "SELECT o_orderkey AS k, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v FROM orders")
def to_decimal(spark, sf):
    text = F.when(F.col("o_orderstatus") != "P", F.format_number("o_totalprice", 2)).otherwise("n/a")
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), N.to_decimal(text).alias("v"))


@query("j12_product_code", "SELECT p_partkey AS k, CASE WHEN p_type <> 'PROMO' THEN p_partkey END AS CNP FROM part")
def product_code(spark, sf):
    text = F.when(F.col("p_type") != "PROMO", F.concat(F.lit(" "), R.code_text(F.col("p_partkey")))).otherwise("abc")
    return R.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), N.product_code(text).alias("CNP"))


@query("j13_product_code_text", """
SELECT p_partkey AS k, CASE p_type WHEN 'PROMO' THEN 'abc' WHEN 'LARGE' THEN p_partkey || '.5' ELSE CAST(p_partkey AS VARCHAR) END AS CNP FROM part""")
def product_code_text(spark, sf):
    key = _text(F.col("p_partkey"))
    text = F.when(F.col("p_type") == "PROMO", "abc").when(F.col("p_type") == "LARGE", F.concat(key, F.lit(".5"))).otherwise(R.code_text(F.col("p_partkey")))
    return R.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), N.product_code_text(text).alias("CNP"))


@query("j14_id_text", """
SELECT p_partkey AS k, CASE WHEN p_type NOT IN ('PROMO', 'LARGE') THEN CAST(p_partkey AS VARCHAR) END AS id FROM part""")
def id_text(spark, sf):
    key = _text(F.col("p_partkey"))
    text = F.when(F.col("p_type") == "PROMO", "abc").when(F.col("p_type") == "LARGE", F.concat(key, F.lit(".5"))).otherwise(key)
    return R.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), N.id_text(text).alias("id"))


@query("j15_half_up", "SELECT o_orderkey AS k, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) / 1, 1) AS DOUBLE) AS v FROM orders")
def half_up(spark, sf):
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), N.half_up(F.col("o_totalprice").cast("decimal(18,2)"), 1).alias("v"))


@query("j16_parse_sale_stamp", """
SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN o_orderdate + to_minutes(o_orderkey % 1440) WHEN 'O' THEN o_orderdate END AS ts FROM orders""")
def parse_sale_stamp(spark, sf):
    """With a time, with a date alone, and with a day that does not exist."""
    minute = F.col("o_orderkey") % 1440
    clock = F.concat_ws(":", _text(F.floor(minute / 60)), _text(minute % 60), F.lit("30"))
    day = F.date_format("o_orderdate", "d/M/yyyy")
    text = F.when(F.col("o_orderstatus") == "F", F.concat_ws(" ", day, clock)).when(F.col("o_orderstatus") == "O", day).otherwise("31/2/2021 1:00")
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), D.parse_sale_stamp(text).alias("ts"))


@query("j17_parse_day_first", "SELECT event_id AS k, date_trunc('second', ts) AS ts FROM events")
def parse_day_first(spark, sf):
    """Three spellings of the same instant, by kind of event."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "view", F.date_format("ts", "d-M-yyyy H:m:s"))
        .otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
    )
    return R.table(spark, sf, "events").select(F.col("event_id").alias("k"), D.parse_day_first(text).alias("ts"))


@query("j18_date_parts", f"""
SELECT d, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dd, CAST(quarter(d) AS INTEGER) AS q FROM {_DAYS}""")
def date_parts(spark, sf):
    return _days(spark, sf).select("d", F.year("d").alias("y"), F.month("d").alias("m"), F.dayofmonth("d").alias("dd"), F.quarter("d").alias("q"))


@query("j19_date_key", f"SELECT d, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS k, d AS back FROM {_DAYS}")
def date_key(spark, sf):
    key = D.date_key(F.col("d"))
    return _days(spark, sf).select("d", key.alias("k"), D.key_date(key).alias("back"))


@query("j20_time_key", "SELECT event_id AS k, CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS FK_Time FROM events")
def time_key(spark, sf):
    return R.table(spark, sf, "events").select(F.col("event_id").alias("k"), D.time_key(F.col("ts")).alias("FK_Time"))


@query("j21_names", f"SELECT d, dayname(d) AS DayName, monthname(d) AS MonthName FROM {_DAYS}")
def names(spark, sf):
    return _days(spark, sf).select("d", D.day_name(F.col("d")).alias("DayName"), D.month_name(F.col("d")).alias("MonthName"))


@query("j22_week_number", f"SELECT d, CAST((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 AS INTEGER) AS w FROM {_DAYS}")
def week_number(spark, sf):
    return _days(spark, sf).select("d", D.week_number(F.col("d")).alias("w"))


@query("j23_weekend", f"SELECT d, dayofweek(d) IN (0, 6) AS IsWeekend FROM {_DAYS}")
def weekend(spark, sf):
    return _days(spark, sf).select("d", D.is_weekend(F.col("d")).alias("IsWeekend"))


_HOLIDAYS = ", ".join(f"DATE '{d}'" for d in G.HOLIDAYS)


@query("j24_holiday_flag", f"SELECT d, CAST(d + INTERVAL 24 YEAR AS DATE) IN ({_HOLIDAYS}) AS IsHoliday FROM {_DAYS}")
def holiday_flag(spark, sf):
    """The test dates moved 24 years on, to where the list lies."""
    return _days(spark, sf).select("d", G.is_holiday(F.add_months("d", 24 * 12)).alias("IsHoliday"))


@query("j25_year_to_date", f"SELECT d, dayofyear(d) <= (SELECT dayofyear(max(l_shipdate)) FROM lineitem) AS YTDFlag FROM {_DAYS}")
def year_to_date(spark, sf):
    last = R.bounds(spark, sf).select("last_day")
    return beside(_days(spark, sf), last).select("d", D.is_year_to_date(F.col("d"), F.col("last_day")).alias("YTDFlag"))


@query("j26_day_of_year", f"SELECT d, CAST(date_trunc('year', d) AS DATE) AS y0, CAST(dayofyear(d) AS INTEGER) AS n FROM {_DAYS}")
def day_of_year(spark, sf):
    return _days(spark, sf).select("d", F.trunc("d", "year").alias("y0"), D.day_of_year(F.col("d")).alias("n"))


@query("j27_year_month", "SELECT strftime(ts, '%Y-%m') AS ym, count(*) AS n FROM events GROUP BY 1")
def year_month(spark, sf):
    return R.table(spark, sf, "events").groupBy(D.year_month(F.col("ts")).alias("ym")).agg(F.count(F.lit(1)).alias("n"))


@query("j28_truncate", "SELECT event_id AS k, CAST(ts AS DATE) AS d, date_trunc('second', ts) AS s FROM events")
def truncate(spark, sf):
    return R.table(spark, sf, "events").select(F.col("event_id").alias("k"), F.to_date("ts").alias("d"), D.to_second(F.col("ts")).alias("s"))


@query("j29_day_period", """
SELECT event_id AS k, CASE WHEN hour(ts) < 6 THEN 'Night' WHEN hour(ts) < 12 THEN 'Morning' WHEN hour(ts) < 18 THEN 'Afternoon' ELSE 'Evening' END AS DayPeriod FROM events""")
def day_period(spark, sf):
    return R.table(spark, sf, "events").select(F.col("event_id").alias("k"), D.day_period(F.hour("ts")).alias("DayPeriod"))


@query("j30_quarter_name", f"SELECT d, 'Q' || quarter(d) AS QuarterName FROM {_DAYS}")
def quarter_name(spark, sf):
    return _days(spark, sf).select("d", D.quarter_name(F.col("d")).alias("QuarterName"))


@query("j31_time_label", "SELECT event_id AS k, strftime(ts, '%H:%M') AS TimeLabel FROM events")
def time_label(spark, sf):
    return R.table(spark, sf, "events").select(F.col("event_id").alias("k"), D.time_label(F.hour("ts"), F.minute("ts")).alias("TimeLabel"))


@query("j32_generic_label", R.sql("SELECT CNP, GenericLabel FROM dproduct", "dproduct"))
def generic_label(spark, sf):
    key = F.col("p_partkey")
    return R.table(spark, sf, "part").select(key.alias("CNP"), L.generic_label(R.raw_generic(key)).alias("GenericLabel"))


@query("j33_product_type", "SELECT p_partkey AS CNP, p_partkey % 4 = 0 AS IsGeneric, CASE WHEN p_partkey % 4 = 0 THEN 'Generic' ELSE 'Branded' END AS ProductType FROM part")
def product_type(spark, sf):
    """Here ``s`` does not count as generic, and a missing code is branded."""
    raw = R.raw_generic(F.col("p_partkey"))
    return R.table(spark, sf, "part").select(
        F.col("p_partkey").alias("CNP"), L.is_generic_word(raw).alias("IsGeneric"), L.product_type(raw).alias("ProductType")
    )


@query("j34_settled_district", """
SELECT c_custkey AS SK_Operator, CASE WHEN c_acctbal < 0 THEN 'Given' WHEN n_regionkey NOT IN (0, 1, 2) THEN r_name
  WHEN n_name = 'NATION_0' THEN 'Aveiro' ELSE 'Unknown' END AS District
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def settled_district(spark, sf):
    place = F.concat(F.lit("NATION_"), _text(F.col("c_nationkey")))
    people = R.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("SK_Operator"), place.alias("Municipality"), F.when(F.col("c_acctbal") < 0, "Given").otherwise("  ").alias("Original")
    )
    found = people.join(B.district_map(R.map_feed(spark, sf)), F.col("Municipality") == F.col("Concelho"), "left")
    district = L.settled_district(F.col("Original"), F.col("DistrictFromMap"), F.col("Municipality"), R.MANUAL)
    return found.select("SK_Operator", district.alias("District"))


@query("j35_priority_fill", R.sql("SELECT * FROM corrected_location", "corrected_location"))
def priority_fill(spark, sf):
    return B.corrected_locations(R.location_feed(spark, sf), R.map_feed(spark, sf), R.MANUAL_KEYS).drop("place_key")


@query("j36_safe_divide", """
SELECT l_suppkey AS FK_Pharmacy, CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE)
  / nullif(sum(CASE WHEN l_discount = 0 AND l_linenumber = 7 AND l_returnflag = 'R' THEN l_quantity ELSE 0 END), 0) AS r
FROM lineitem GROUP BY 1""")
def safe_divide(spark, sf):
    rare = (F.col("l_discount") == 0) & (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    sums = R.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("FK_Pharmacy")).agg(
        F.sum(F.col("l_tax").cast("decimal(18,2)")).cast("double").alias("a"), F.sum(F.when(rare, F.col("l_quantity")).otherwise(0.0)).alias("b")
    )
    return sums.select("FK_Pharmacy", N.safe_divide(F.col("a"), F.col("b")).alias("r"))


@query("j37_date_title", """
SELECT l_suppkey AS FK_Pharmacy, 'Total Sales Amount (' || strftime(min(l_shipdate), '%m/%Y') || ' - ' || strftime(max(l_shipdate), '%m/%Y') || ')' AS Title
FROM lineitem GROUP BY 1""")
def date_title(spark, sf):
    return R.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("FK_Pharmacy")).agg(
        D.date_title(F.min("l_shipdate"), F.max("l_shipdate")).alias("Title")
    )


@query("j39_current_timestamp", "SELECT o_orderkey AS k, true AS IsStamped FROM orders")
def current_timestamp(spark, sf):
    stamped = R.table(spark, sf, "orders").withColumn("LoadDateTime", F.localtimestamp())
    return stamped.select(F.col("o_orderkey").alias("k"), (F.col("LoadDateTime") > F.col("o_orderdate")).alias("IsStamped"))


@query("j40_boolean_from_label", R.sql("SELECT CNP, IsGeneric FROM dproduct", "dproduct"))
def boolean_from_label(spark, sf):
    return R.dim_product(spark, sf).select("CNP", (F.col("GenericLabel") == "Generic").alias("IsGeneric"))


@query("j41_number_to_text_join", "SELECT s_suppkey AS PharmacyID, s_name AS PharmacyName FROM supplier")
def number_to_text_join(spark, sf):
    """Keys kept as text are typed before the join, so both sides compare numbers."""
    left = R.table(spark, sf, "supplier").select(_text(F.col("s_suppkey")).alias("t"))
    typed = left.select(F.col("t").try_cast("bigint").alias("PharmacyID"))
    dim = R.dim_pharmacy(spark, sf)
    return typed.join(dim, F.col("PharmacyID") == F.col("SK_Pharmacy")).select("PharmacyID", "PharmacyName")


@query("j42_list_functions", """
SELECT p_name AS ProductName, count(DISTINCT p_type) AS n, CASE WHEN count(DISTINCT p_type) = 1 THEN min(p_type) END AS Only FROM part GROUP BY 1""")
def list_functions(spark, sf):
    """Count of a group's distinct values, and the value when there is one; no list is ever gathered."""
    groups = R.table(spark, sf, "part").groupBy(F.col("p_name").alias("ProductName"))
    return groups.agg(F.count_distinct("p_type").alias("n"), single_value(F.col("p_type")).alias("Only"))


@query("j43_to_text_and_number", "SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS t, CAST(o_custkey AS DOUBLE) AS n FROM orders")
def to_text_and_number(spark, sf):
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), _text(F.col("o_custkey")).alias("t"), _text(F.col("o_custkey")).try_cast("double").alias("n"))


@query("j44_try_or_null", "SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS v FROM orders")
def try_or_null(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", _text(F.col("o_custkey"))).otherwise(F.col("o_orderpriority"))
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), text.try_cast("bigint").alias("v"))


@query("j45_coalesce_mark", """
SELECT c_custkey AS SK_Operator, coalesce(max(o_orderkey), 0) AS LastSaleID FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' GROUP BY 1""")
def coalesce_mark(spark, sf):
    last = R.table(spark, sf, "orders").filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.max("o_orderkey").alias("m"))
    people = R.table(spark, sf, "customer").join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    return people.select(F.col("c_custkey").alias("SK_Operator"), F.coalesce("m", F.lit(0)).alias("LastSaleID"))
