"""Load jobs end to end: contents, marks, logs, and that a second run adds nothing."""

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from salesmart import workspace
from salesmart.catalog import roles as R
from salesmart.catalog.checking import feeds
from salesmart.contracts import CONTRACTS, conform, differences, guarded
from salesmart.operators import quality as Q
from salesmart.plans import dimensions as B
from salesmart.plans import incremental as I
from salesmart.plans import jobs as W
from salesmart.sources import delimited as C
from salesmart.sources import generators as G
from salesmart.sources import tables as T
from salesmart.workspace import run_dir


@pytest.fixture(scope="module")
def house(spark, sf):
    return W.full_refresh(spark, feeds(spark, sf), run_dir(spark, "mart"))


def test_tables_follow_their_contracts(house):
    for name in W.SCHEMAS:
        if name != "FactSales_IncrementalBatch":
            assert differences(house.read(name).drop("SaleMonth"), name) == []


def test_checks_pass_and_log_is_written(house):
    report = W.final_report(house)
    assert all(r.ResultValue > 0 for r in report["rows"].collect())
    assert all(r.ResultValue == 0 for r in report["nulls"].collect())
    log = {r.TargetTable: r for r in house.read("LoadLog").collect()}
    assert log["FactSales"].RowsInserted == house.read("FactSales").count()
    assert all(r.Status == "Succeeded" for r in log.values())


def test_mark_points_to_the_last_sale(house):
    last = house.read("FactSales").orderBy(F.desc("SourceSaleDateTime"), F.desc("PK_SaleID")).first()
    mark = I.mark_row(house.read("Watermark")).first()
    assert (mark.LastSourceSaleDateTime, mark.LastSaleID) == (last.SourceSaleDateTime, last.PK_SaleID)


def test_reload_adds_nothing(spark, sf, house):
    before = house.read("FactSales").count()
    assert W.incremental_load(spark, feeds(spark, sf), house.root) == 0
    assert W.incremental_load(spark, feeds(spark, sf), house.root, refresh=False) == 0
    assert house.read("FactSales").count() == before


def test_full_refresh_twice_gives_the_same(spark, sf, house):
    def content(h, table):
        stamps = ("LoadDateTime", "ModelRunDate")
        df = h.read(table)
        return sorted(map(str, df.drop(*stamps).collect()))

    again = W.full_refresh(spark, feeds(spark, sf), house.root, segmented=None)
    other = W.full_refresh(spark, feeds(spark, sf), run_dir(spark, "mart"), segmented=None)
    for table in ("DimProduct", "DimLocation", "DimDate", "FactSales"):
        assert content(again, table) == content(other, table)


def test_a_failed_step_beside_others_is_logged_and_raised(spark, sf, house):
    """All dimensions are written side by side; one that fails stops the load, and the old mart stays."""
    before = house.read("FactSales").count()
    broken = replace(feeds(spark, sf), pos=feeds(spark, sf).pos.drop("name"))
    with pytest.raises(Exception, match="name|POSName"):
        W.full_refresh(spark, broken, house.root, segmented=None)
    assert house.read("FactSales").count() == before
    assert house.read("DimPOS").count() > 0


def test_pruning_by_month(house):
    facts = house.read("FactSales").filter("SaleMonth = 199801").select("Amount")
    assert "PartitionFilters: [isnotnull(SaleMonth" in facts._jdf.queryExecution().toString()


def test_contract_rejects_nulls_and_missing_columns(spark):
    bad = spark.createDataFrame([(None, "x", None)], "SK_POS long, POSName string, POSEmail string")
    with pytest.raises(Exception, match="must not be null"):
        guarded(bad, "DimPOS").collect()
    with pytest.raises(ValueError, match="missing columns"):
        conform(bad.drop("POSName"), "DimPOS")


def test_checks_fail_loudly(spark):
    counts = spark.createDataFrame([(0, 5)], "DimARows long, DimBRows long")
    with pytest.raises(Q.CheckFailed):
        Q.require_loaded(counts)
    with pytest.raises(Q.CheckFailed):
        Q.require_empty(counts)
    with pytest.raises(Q.CheckFailed):
        Q.require_known_districts(spark.createDataFrame([("Unknown",)], "District string"))


def test_failed_write_is_logged(spark):
    house = W.Warehouse(spark, run_dir(spark, "mart"))
    bad = spark.createDataFrame([(None, "x", None)], "SK_POS long, POSName string, POSEmail string")
    with pytest.raises(Exception, match="must not be null"):
        house.write("DimPOS", bad, "load")
    row = house.read("LoadLog").first()
    assert row.Status == "Failed" and "must not be null" in row.ErrorMessage and not house.exists("DimPOS")


def test_replace_may_read_its_own_table(spark):
    path = run_dir(spark, "t")
    T.replace(spark.range(10), path)
    for _ in range(3):
        T.replace(T.scan(spark, path).withColumn("id", F.col("id") + 1), path)
    assert T.scan(spark, path).agg(F.min("id"), F.max("id")).first() == (3, 12)
    T.delete_where(spark, path, F.col("id") == 3)
    assert T.scan(spark, path).count() == 9
    assert T.clear(spark, path).count() == 0 and T.scan(spark, path).columns == ["id"]


def test_encodings(spark):
    names = spark.createDataFrame([("João €",), ("plain",)], "n string")
    for encoding in (C.UTF8, C.CP1252):
        path = C.write_delimited(names, run_dir(spark, "enc"), encoding=encoding)
        assert C.detect_encoding(spark, path) == encoding
        assert {r.n for r in C.read_any_encoding(spark, path).collect()} == {"João €", "plain"}


def test_extra_fields_and_quotes_are_kept_as_text(spark):
    path = run_dir(spark, "raw")
    spark.createDataFrame([("a,b",), ('1,"x',), ("2,y,z",)], "value string").coalesce(1).write.text(path)
    assert [tuple(r) for r in C.read_headered(spark, path).collect()] == [("1", '"x'), ("2", "y")]


def test_contract_sizes():
    sizes = {n: len(s) for n, s in CONTRACTS.items()}
    assert (sizes["DimDate"], sizes["FactSales"], sizes["PharmacySegmentation"], sizes["LoadLog"]) == (13, 13, 24, 10)


def test_delete_rewrites_only_touched_partitions(spark):
    path = run_dir(spark, "parts")
    rows = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("m"))
    T.replace(rows, path, ["m"])

    def files():
        untouched = T.scan(spark, path).filter("m in (0, 3)")
        return {r[0] for r in untouched.select(F.input_file_name()).distinct().collect()}

    before = files()
    assert T.delete_where(spark, path, F.col("id") == 5, "m").count() == 99
    assert T.delete_where(spark, path, F.col("m") == 2, "m").count() == 74
    assert {r.m for r in T.scan(spark, path).select("m").distinct().collect()} == {0, 1, 3}
    assert files() == before


def test_byte_order_mark_and_quoted_line_breaks(spark, tmp_path):
    marked = tmp_path / "marked.csv"
    marked.write_bytes("\ufeffn,m\nJoão,1\n".encode())
    assert C.detect_encoding(spark, str(marked)) == C.UTF8
    assert [tuple(r) for r in C.read_any_encoding(spark, str(marked)).select("n", "m").collect()] == [("João", "1")]
    broken = tmp_path / "broken.csv"
    broken.write_text('a,b\n"x\ny",1\n')
    rows = C.read_headered(spark, str(broken), quoted=True, line_breaks=True).collect()
    assert [tuple(r) for r in rows] == [("x\ny", "1")]


def test_undefined_bytes_mean_latin1(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes(b"n\nJo\xe3o \x81\n")
    assert C.detect_encoding(spark, str(path)) == C.LATIN1


def sums(house):
    """Facts by product code and date, as the dimensions show them."""
    facts, products = house.read("FactSales"), house.read("DimProduct")
    rows = facts.join(products, F.col("FK_Product") == F.col("SK_Product")).groupBy("CNP", "FK_Date").agg(F.count("*"), F.sum("Amount"))
    return {tuple(r) for r in rows.collect()}


def test_an_increment_keeps_what_stored_facts_point_to(spark, sf):
    """New products with lower codes and later dates: old facts keep their code and their date."""
    all_ = feeds(spark, sf)
    code, early = F.regexp_extract("CNP", r"(\d+)", 1).cast("bigint"), F.col("Datetime").rlike("/199[0-6] ")
    first = replace(all_, sales=all_.sales.filter(early), products=all_.products.filter(code % 2 == 1))
    house = W.full_refresh(spark, first, run_dir(spark, "mart"), segmented=None)
    before, keys, days = sums(house), house.read("DimProduct").select("CNP", "SK_Product").collect(), house.read("DimDate").count()
    last = house.read("FactSales").agg(F.max("PK_SaleID")).first()[0]
    later = all_.sales.filter(~early).withColumn("Sale ID", (F.col("Sale ID").cast("bigint") + last).cast("string"))
    assert W.incremental_load(spark, replace(all_, sales=later), house.root) > 0
    after = dict((r.CNP, r.SK_Product) for r in house.read("DimProduct").collect())
    assert all(after[r.CNP] == r.SK_Product for r in keys) and len(after) == len(set(after.values())) > len(keys)
    assert before <= sums(house)
    dates = house.read("DimDate")
    assert dates.count() > days and house.read("FactSales").join(dates, F.col("FK_Date") == F.col("SK_Date"), "left_anti").count() == 0
    # A batch of a few days does not make the calendar shorter.
    few = all_.sales.filter(F.col("Datetime").rlike("/2000 ")).limit(3).withColumn("Sale ID", F.lit("99999999"))
    W.incremental_load(spark, replace(all_, sales=few), house.root)
    assert house.read("DimDate").count() == dates.count()


def test_a_failed_refresh_leaves_the_old_mart(spark, sf, house):
    before, log = house.read("FactSales").count(), house.read("LoadLog").count()
    with pytest.raises(Q.CheckFailed):
        W.full_refresh(spark, replace(feeds(spark, sf), sales=R.sales_feed(spark, sf).limit(0)), house.root, R.bounds(spark, sf))
    assert house.read("FactSales").count() == before > 0 and house.mart()["DimProduct"].count() > 1
    failed = house.read("LoadLog").filter("Status = 'Failed'").collect()
    assert [r.ActivityName for r in failed] == ["check facts"] and house.read("LoadLog").count() > log + 1


def test_jobs_leave_no_intermediate_tables(spark, sf):
    made = []
    original = workspace.run_dir

    def noted(spark, purpose):
        made.append(original(spark, purpose))
        return made[-1]

    root = run_dir(spark, "mart")
    workspace.run_dir = noted
    try:
        W.full_refresh(spark, feeds(spark, sf), root, segmented=None)
        W.incremental_load(spark, feeds(spark, sf), root)
    finally:
        workspace.run_dir = original
    assert made and not any(T.exists(spark, p) for p in made)


def test_a_refresh_reads_the_sales_feed_once(spark, sf, tmp_path):
    path = str(tmp_path / "sales")
    R.sales_feed(spark, sf).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    feed = spark.read.parquet(path)
    W.full_refresh(spark, replace(feeds(spark, sf), sales=feed.mapInArrow(counted, feed.schema)), run_dir(spark, "mart"))
    assert reads.value == feed.count()


def test_the_mark_does_not_read_the_facts(spark):
    house = W.Warehouse(spark, run_dir(spark, "mart"))
    T.replace(conform(G.first_watermark(spark, I.PROCESS), "Watermark"), house.path("Watermark"))
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2020-01-02 00:00:00' AS SourceSaleDateTime, 5L AS PK_SaleID")
    house.advance_mark(rows)  # there is no fact table at all
    house.advance_mark(rows.withColumn("SourceSaleDateTime", F.expr("TIMESTAMP_NTZ '2019-01-01 00:00:00'")))
    assert I.mark_row(house.read("Watermark")).first().LastSaleID == 5


def test_of_two_writers_one_fails(spark, monkeypatch):
    """Both have read the same number and come to the claim together."""
    path = run_dir(spark, "writers")
    T.replace(spark.range(3), path)
    together, create = threading.Barrier(2, timeout=60), T._created

    def created(spark, name):
        if "." not in name.rsplit("/", 1)[1]:
            together.wait()
        return create(spark, name)

    monkeypatch.setattr(T, "_created", created)

    def write(n):
        try:
            return T.replace(spark.range(n), path).count()
        except T.Conflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(write, (10, 20)))
    assert done.count(None) == 1 and T.scan(spark, path).count() in done
    monkeypatch.undo()
    assert T.replace(spark.range(7), path).count() == T.scan(spark, path).count() == 7


def test_a_late_writer_fails(spark):
    """It read before another one published; what it would have overwritten stays."""
    path = run_dir(spark, "writers")
    T.replace(spark.range(3), path)
    seen = T.latest_number(spark, path)
    T.replace(spark.range(5), path)
    with pytest.raises(T.Conflict):
        T.replace(spark.range(9), path, expected=seen)
    assert T.scan(spark, path).count() == 5
    # A claim without a version, as a dead writer leaves it, stops nobody.
    assert T._created(spark, f"{path}/{T.VERSIONS}/{T.latest_number(spark, path) + 1:012d}")
    assert T.scan(spark, path).count() == 5
    T.replace(spark.range(6), path)
    assert T.scan(spark, path).count() == 6


def test_versions(spark):
    path = run_dir(spark, "v")
    for n in (1, 2, 3, 4):
        T.replace(spark.range(n), path)
    assert T.scan(spark, path).count() == 4 and len(T.versions(spark, path)) == 2
    old = T.scan(spark, path)
    T.replace(spark.range(9), path)
    assert old.count() == 4 and T.scan(spark, path).count() == 9
    T.publish(spark, path, T.versions(spark, path)[1])
    assert T.scan(spark, path).count() == 4


def test_a_calendar_is_not_made_of_a_mistyped_year(spark):
    with pytest.raises(Exception, match="too long"):
        B.build_date(G.fixed_bounds(spark, dt.date(1998, 1, 1), dt.date(9998, 1, 1))).count()


def test_files_of_a_folder_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\nthree,four\n")
    with pytest.raises(Exception):
        C.read_headered(spark, str(tmp_path)).collect()
    parts = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    rows = C.read_parts(spark, parts, encoding=C.UTF8, origin=True).orderBy("Source", "Row")
    assert [(r.x, r.y, r.Source) for r in rows.collect()] == [("1", "2", 0), ("four", "three", 1)]


def test_first_file_wins(spark, tmp_path):
    head = "Pharmacy ID,Nome da farmácia,Localização\n"
    (tmp_path / "a.csv").write_text(head + "1,Zeta,1\n1,Eta,1\n2,Beta,1\n")
    (tmp_path / "b.csv").write_text(head + "1,Alpha,1\n2,Aa,1\n3,Gamma,1\n")
    feed = C.read_parts(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], encoding=C.UTF8, origin=True)
    assert {r.SK_Pharmacy: r.PharmacyName for r in B.build_pharmacy(feed).collect()} == {1: "Zeta", 2: "Beta", 3: "Gamma"}
