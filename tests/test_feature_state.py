"""The per-month state of store features: equal to all facts from scratch, and only changed months are read."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesmart.catalog.checking import feeds
from salesmart.contracts import CONTRACTS
from salesmart.plans import feature_state as Y
from salesmart.plans import jobs as W
from salesmart.plans import segmentation as S
from salesmart.plans.facts import MONTH, with_month
from salesmart.sources import tables as T
from salesmart.workspace import run_dir


def fact(sale, day, product=1, store=1, qty=1, amount=1.0):
    stamp = dt.datetime.combine(day, dt.time(9))
    return (sale, day.year * 10000 + day.month * 100 + day.day, 900, product, store, 0, 0, 0, qty, amount, "EUR", stamp, stamp)


def frame(spark, rows):
    types = ", ".join(f"{f.name} {'double' if f.name == 'Amount' else f.dataType.simpleString()}" for f in CONTRACTS["FactSales"])
    made = spark.createDataFrame(rows, types)
    return with_month(made.withColumn("Amount", F.col("Amount").cast("decimal(18,2)")))


@pytest.fixture
def dims(spark):
    products = spark.createDataFrame([(1, "m", "b", True), (2, "m", "c", False)], "CNP long, Manufacturer string, Brand string, IsGeneric boolean")
    stores = spark.createDataFrame(
        [(1, "s", "1", "l", "d", "p")], "PharmacyID long, PharmacyName string, LocationCode string, LocationName string, District string, Country string"
    )
    return products, stores


JAN, FEB, MAR = dt.date(2021, 1, 5), dt.date(2021, 2, 5), dt.date(2021, 3, 5)


class Store:
    def __init__(self, spark, rows):
        self.spark, self.path, self.root = spark, run_dir(spark, "facts"), run_dir(spark, "state")
        T.replace(frame(spark, rows), self.path, [MONTH])
        self.state = Y.FeatureState(spark, self.root)

    def facts(self):
        return T.scan(self.spark, self.path, frame(self.spark, []).schema)

    def folder(self):
        return T.current(self.spark, self.path)

    def refresh(self):
        return self.state.refresh(self.folder(), self.facts())

    def check(self, dims):
        mine = self.state.features(self.facts(), *dims)
        whole = S.store_features(Y.sales_of(self.facts()), *dims)
        assert mine.columns == whole.columns
        found = sorted(map(str, mine.collect()))
        assert found == sorted(map(str, whole.collect()))
        return mine.collect()


def test_months_come_and_go(spark, dims):
    # Sale 2 spans two months; the unknown product, a quantity of 0 and an unknown store.
    held = Store(spark, [fact(1, JAN), fact(2, JAN, 2), fact(2, FEB, 1), fact(3, FEB, -1), fact(4, FEB, qty=0), fact(5, FEB, 2, 9)])
    assert held.refresh() == [202101, 202102]
    rows = {r.PharmacyID: r for r in held.check(dims)}
    assert rows[1].NumberOfTransactions == 2 and rows[1].ActiveMonths == 2 and rows[9].PharmacyName == "Unknown pharmacy"
    assert held.refresh() == []
    T.append(frame(spark, [fact(6, FEB, 2), fact(7, MAR, 2, amount=2.5), fact(7, MAR, 2, amount=2.5)]), held.path, [MONTH])
    assert held.refresh() == [202102, 202103]
    held.check(dims)
    T.delete_where(spark, held.path, F.col("PK_SaleID") == 7, MONTH)  # March is empty then
    assert held.refresh() == []
    assert sorted(held.state.months()) == [202101, 202102]
    held.check(dims)


def test_nothing_and_nothing_that_counts(spark, dims):
    held = Store(spark, [])
    assert held.refresh() == [] and held.check(dims) == []
    T.append(frame(spark, [fact(1, JAN, -1)]), held.path, [MONTH])
    assert held.refresh() == [202101] and held.check(dims) == [] and held.refresh() == []


def test_unchanged_months_are_not_opened(spark, dims):
    held = Store(spark, [fact(1, JAN), fact(2, FEB)])
    held.refresh()
    T.append(frame(spark, [fact(3, MAR, 2)]), held.path, [MONTH])
    folder = Path(held.folder().removeprefix("file:"))
    spoilt = [f for m in (202101, 202102) for f in (folder / f"{MONTH}={m}").glob("*.parquet")]
    whole = {f: f.read_bytes() for f in spoilt}
    for f in spoilt:  # the same length, but whoever opens it fails
        f.write_bytes(b"x" * len(whole[f]))
    assert held.refresh() == [202103]
    total = held.state.features(held.facts(), *dims).first()
    assert (total.NumberOfTransactions, total.ActiveMonths) == (3, 3)
    # Spoilt files go on having the old length, so the listing alone calls them unchanged.
    assert held.refresh() == []


def test_two_refreshes_at_once(spark, dims, monkeypatch):
    held = Store(spark, [fact(1, JAN)])
    plain = Y.months_on_disk

    def overtaken(session, path):
        monkeypatch.setattr(Y, "months_on_disk", plain)
        held.refresh()
        return plain(session, path)

    monkeypatch.setattr(Y, "months_on_disk", overtaken)
    with pytest.raises(T.Conflict):
        held.refresh()
    held.check(dims)


def test_segments_after_an_increment(spark, sf):
    all_, root = feeds(spark, sf), run_dir(spark, "mart")
    house = W.full_refresh(spark, all_, root, segmented=None)
    months = W.refresh_segments(spark, all_, root)
    assert len(months) == house.read("FactSales").select(MONTH).distinct().count()
    first = house.read("PharmacySegmentation")
    assert first.count() > 0 and first.filter("District is null or SegmentLabel is null").count() == 0
    assert W.refresh_segments(spark, all_, root) == []
