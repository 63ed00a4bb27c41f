"""Store features: distinct counts by bits of numbered words, equal to plain counting, with no copy of a row per distinct count."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from salesmart.operators import grouping as A
from salesmart.operators.grouping import bit_of, word_of
from salesmart.plans import segmentation as S

SALES = "SaleID long, PharmacyID long, CNP long, Datetime timestamp_ntz, Qty int, Amount double"
PRODUCTS = "CNP long, Manufacturer string, Brand string, IsGeneric boolean"
STORES = "PharmacyID long, PharmacyName string, LocationCode string, LocationName string, District string, Country string"


def tables(n=3000):
    """More than two words of brands, years across words of months; nulls, unknown products and a code listed twice."""
    dice = random.Random(3)
    products = [(k, f"m{k % 70}" if k % 11 else None, f"b{k}" if k % 13 else None, (True, False, None)[k % 3]) for k in range(200)]
    products += [(5, "m5", "other", False), (None, "none", "none", True)]
    sales = [
        (
            dice.randrange(900), dice.choice((1, 2, 3, None)), dice.choice((*range(230), None)),
            dice.choice((None, dt.datetime(dice.randrange(1985, 2024), dice.randrange(1, 13), 7, 5))),
            dice.choice((None, 1, 2)), dice.choice((None, 0.25, 3.5)),
        )
        for _ in range(n)
    ]
    return sales, products


def by_hand(sales, products, store):
    known = {}
    for code, *rest in products:
        known.setdefault(code, []).append(rest)
    mine = [s for s in sales if s[1] == store]
    rows = [(s, p) for s in mine for p in (known.get(s[2]) if s[2] is not None and s[2] in known else [(None, None, None)])]
    stamps = [s[3] for s in mine if s[3]]

    def some(values):
        return len({v for v in values if v is not None})

    return {
        "TotalSalesAmount": sum(s[5] or 0 for s, _ in rows), "TotalQuantity": sum(s[4] or 0 for s, _ in rows),
        "ProductVariety": some(s[2] for s in mine), "ManufacturerVariety": some(p[0] for _, p in rows), "BrandVariety": some(p[1] for _, p in rows),
        "BrandedSalesAmount": sum(s[5] or 0 for s, p in rows if not p[2]), "GenericSalesAmount": sum(s[5] or 0 for s, p in rows if p[2]),
        "ActiveMonths": len({(t.year, t.month) for t in stamps}), "FirstSaleDate": min(stamps), "LastSaleDate": max(stamps),
    }


@pytest.fixture
def made(spark):
    sales, products = tables()
    stores = spark.createDataFrame([(k, "s", "1", "l", "d", "p") for k in (1, 2)], STORES)
    return S.store_features(spark.createDataFrame(sales, SALES), spark.createDataFrame(products, PRODUCTS), stores)


def test_features_are_those_counted_by_hand(made):
    sales, products = tables()
    found = {r.PharmacyID: r.asDict() for r in made.collect()}
    assert set(found) == {1, 2, 3, None}
    for store, row in found.items():
        expected = by_hand(sales, products, store)
        assert {c: row[c] for c in expected} == expected
        sold = len({s[0] for s in sales if s[1] == store}) if store else None
        assert row["NumberOfTransactions"] == sold


def test_a_row_is_not_copied_for_each_distinct_count(made, capsys):
    made.explain()
    assert "Expand" not in capsys.readouterr().out


def test_months_and_no_product_at_all(spark):
    sales = spark.createDataFrame([(1, 1, 7, dt.datetime(2020, 1, 1), 1, 1.0)], SALES)
    stores = spark.createDataFrame([], STORES)
    row = S.store_features(sales, spark.createDataFrame([], PRODUCTS), stores).first()
    assert (row.ProductVariety, row.ManufacturerVariety, row.BrandVariety, row.ActiveMonths, row.RecencyDays) == (1, 0, 0, 1, 0)
    assert S.store_features(sales.limit(0), spark.createDataFrame([], PRODUCTS), stores).count() == 0


def test_bits_count_every_number_once(spark):
    numbers = [*range(-130, 200, 3), 63, 64, 2**40, 2**40 + 1, -(2**40)]
    rows = spark.createDataFrame([(n,) for n in numbers * 2], "n long")
    words = rows.groupBy(word_of(F.col("n"))).agg(F.bit_or(bit_of(F.col("n"))).alias("b"))
    assert words.agg(F.sum(F.bit_count("b"))).first()[0] == len(set(numbers))


def test_pairs_that_hardly_repeat_are_grouped_in_tasks_of_bounded_rows(spark, monkeypatch):
    """No task keeps all pairs of its part of the input: they are dealt first, and more rows mean more tasks."""
    monkeypatch.setattr(A, "DEALT", 100)
    sales, products = tables(1000)
    stores = spark.createDataFrame([], STORES)
    rows = spark.createDataFrame(sales, SALES)
    made = S.store_features(rows, spark.createDataFrame(products, PRODUCTS), stores)
    plan = made._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    for pair in (r"PharmacyID#\d+L, CNP#\d+L", r"PharmacyID#\d+L, SaleID#\d+L"):
        assert any(re.search(rf"hashpartitioning\({pair}, 11\)", line) for line in dealt)
        assert not re.search(rf"hashpartitioning\({pair}, \d+\), ENSURE", plan)
    found = {r.PharmacyID: r.asDict() for r in made.collect()}
    for store in (1, 2, 3):
        want = by_hand(sales, products, store)
        assert {c: float(found[store][c]) if isinstance(v, float) else found[store][c] for c, v in want.items()} == want
        assert found[store]["NumberOfTransactions"] == len({s[0] for s in sales if s[1] == store})


def test_products_join_in_tasks_of_bounded_rows_without_a_sort(spark, monkeypatch):
    """The totals by store and product pass by hashed products, in more tasks where there are more rows."""
    monkeypatch.setattr(A, "DEALT", 100)
    sales, products = tables(1000)
    made = S.store_features(spark.createDataFrame(sales, SALES), spark.createDataFrame(products, PRODUCTS), spark.createDataFrame([], STORES))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ShuffledHashJoin \[CNP#\d+L\], \[CNP#\d+L\], LeftOuter, BuildRight", plan)
    assert not re.search(r"(SortMerge|BroadcastHash)Join \[CNP#", plan)
    assert re.search(r"hashpartitioning\(CNP#\d+L, 11\), REPARTITION_BY_NUM", plan)
    found = {r.PharmacyID: r.asDict() for r in made.collect()}
    for store in (1, 2, 3, None):
        want = by_hand(sales, products, store)
        assert {c: found[store][c] for c in want} == want


def test_stores_are_put_together_in_tasks_of_bounded_rows_without_a_sort(spark, monkeypatch):
    """Words and sums of a store are dealt by store, in more tasks where there are more stores; no join sorts the stores."""
    monkeypatch.setattr(A, "DEALT", 100)
    sales, products = tables(1000)
    stores = spark.createDataFrame([(k, "s", "1", "l", "d", "p") for k in (1, 2)], STORES)
    made = S.store_features(spark.createDataFrame(sales, SALES), spark.createDataFrame(products, PRODUCTS), stores)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(PharmacyID#\d+L, 2\), REPARTITION_BY_NUM", plan)
    assert not re.search(r"hashpartitioning\(PharmacyID#\d+L, kind#", plan)
    assert not re.search(r"(SortMerge|BroadcastHash)Join \[PharmacyID#", plan)
    found = {r.PharmacyID: r.asDict() for r in made.collect()}
    assert {k: r["PharmacyName"] for k, r in found.items()} == {1: "s", 2: "s", 3: "Unknown pharmacy", None: "Unknown pharmacy"}
    for store, row in found.items():
        want = by_hand(sales, products, store)
        assert {c: row[c] for c in want} == want
        assert row["NumberOfTransactions"] == (len({s[0] for s in sales if s[1] == store}) if store else None)
