"""Distributed operators against brute force, on skewed data, and the plans they make."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.catalog import load
from salesmart.operators import grouping as A
from salesmart.operators import lookups as J
from salesmart.operators import ordering as O


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key and one value."""
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    value = F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(((F.col("id") * 7919) % 10007) / 3)
    return spark.range(n).select("id", key.alias("k"), value.alias("v"))


@pytest.fixture
def many_ranges(spark):
    """Keep small data in as many sort ranges as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sequential_key(spark, many_ranges):
    codes = spark.range(5000).select(((F.col("id") * 7919) % 1_000_003).alias("code"))
    got = O.sequential_key(codes.repartition(7), "code", "n").orderBy("code").collect()
    assert [r.n for r in got] == list(range(1, 5001))


def test_sequential_key_of_nothing(spark):
    assert O.sequential_key(spark.range(0), "id", "n").count() == 0


def test_exact_quantiles(skewed, many_ranges):
    frame = skewed.withColumn("w", F.when(F.col("id") % 5 != 0, -F.col("v")))
    pdf = frame.toPandas()
    got = {r.Feature: r for r in O.describe(frame, ["v", "w"]).collect()}
    for c in ("v", "w"):
        x = pdf[c].dropna().to_numpy()
        assert [got[c].P25, got[c].P50, got[c].P75] == pytest.approx(list(np.quantile(x, [0.25, 0.5, 0.75])))
        assert got[c].Count == len(x) and got[c].Std == pytest.approx(x.std(ddof=1)) and got[c].Mean == pytest.approx(x.mean())


def test_first_row(skewed):
    shuffled = skewed.repartition(11, "v")
    got = {r.k: r.id for r in A.first_row(shuffled, ["k"], ["id"]).collect()}
    assert got == skewed.toPandas().groupby("k").id.min().to_dict()


def test_new_rows(spark):
    batch, loaded = spark.range(50, 150).toDF("SaleID"), spark.range(0, 100).toDF("PK_SaleID")
    got = sorted(r.SaleID for r in J.new_rows(batch, loaded, "SaleID", "PK_SaleID").collect())
    assert got == list(range(100, 150))
    plan = J.new_rows(batch, loaded, "SaleID", "PK_SaleID")._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan


def test_orphan_report(spark):
    facts = spark.createDataFrame([(1, 1), (1, 2), (3, 2), (None, 2)], "a long, b long")
    dim = spark.createDataFrame([(1,)], "k long")
    got = {r.ForeignKey: (r.OrphanRows, r.OrphanKeys) for r in J.orphan_report(facts, {"a": (dim, "k"), "b": (dim, "k")}).collect()}
    assert got == {"a": (2, 2), "b": (3, 1)}


def test_top_children_and_z_scores(spark):
    rows = spark.createDataFrame([("p", i, float(i % 7)) for i in range(40)], "g string, i int, m double")
    top = O.top_children(rows, ["g"], "m", 3, ["i"]).orderBy("Rank").collect()
    assert [r.i for r in top] == [6, 13, 20]
    z = [r.m_z for r in O.z_scores(rows.withColumn("c", F.lit(1.0)), ["m", "c"], "_z").select("m_z").collect()]
    assert np.mean(z) == pytest.approx(0, abs=1e-9) and np.std(z) == pytest.approx(1)


def _windows_over_one_partition(plan):
    """Windows whose input was gathered into a single task."""
    lines, found = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "Window [" in line:
            exchange = next((x for x in lines[i + 1:] if "Exchange" in x), "")
            found += [line] if "SinglePartition" in exchange else []
    return found


PLANNED = [
    "e02_surrogate_or_unknown", "e04_orphan_count", "f05_store_features", "k03_sales_prior_period", "l04_sales_and_prior_by_month",
    "l06_by_generic_label", "l08_product_drill", "l12_by_pharmacy", "l21_district_view", "n07_orphan_report",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_hold_at_scale(spark, sf, name):
    """With no size small enough to broadcast by itself, no pairwise join may appear."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = load()[0][name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan
    assert not _windows_over_one_partition(plan)
    # Python stays out of the row path.
    assert "PythonUDF" not in plan and "MapInPandas" not in plan and "ArrowEval" not in plan


def test_prior_period_reads_the_facts_once(spark, sf):
    plan = load()[0]["l04_sales_and_prior_by_month"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    amounts = [line for line in plan.splitlines() if "FileScan" in line and "l_extendedprice" in line]
    assert len(amounts) == 1


def test_rows_without_a_code_are_spread(spark):
    """Half the sales have no product code; every one gets the unknown member and none meet in one task."""
    sales = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("code"))
    dim = spark.range(40).select(F.col("id").alias("CNP"), (F.col("id") + 1).alias("SK"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keyed = J.surrogate(sales, "code", dim, "CNP", "SK", "FK")
        got = keyed.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all(r.FK == (-1 if r.code is None or r.code >= 40 else r.code + 1) for r in got)
    uncoded = [r.task for r in got if r.code is None]
    assert max(uncoded.count(t) for t in set(uncoded)) < len(uncoded) / 4


@pytest.mark.parametrize("hot_share", [0, 3])
def test_enrichment_spreads_a_hot_key(spark, hot_share):
    """A third of the rows on one key and a third without: the largest task gets no more than twice the median."""
    n, settings = 60_000, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    key = F.col("id") % 9973
    if hot_share:
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.col("id") % 9973)
    rows = spark.range(n).select(key.alias("k"), F.col("id").alias("v"))
    side = spark.range(9000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    want = sorted(map(str, rows.join(side, "k", "left").fillna("none", ["name"]).select("k", "v", "name").collect()))
    old = {c: spark.conf.get(c) for c in settings}
    try:
        for c, x in settings.items():
            spark.conf.set(c, x)
        got = J.enrich(rows, side, "k", {"name": "none"})
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
        assert sorted(map(str, got.collect())) == want and got.columns == ["k", "v", "name"]
    finally:
        for c, x in old.items():
            spark.conf.set(c, x)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[3]


def test_enrichment_with_many_rows_for_a_hot_key(spark):
    """What would not be small enough to broadcast is joined as any other."""
    rows = spark.range(50).select(F.lit(1).alias("k"), "id")
    side = spark.range(J.HOT_ROWS + 1).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    assert J.enrich(rows, side, "k").count() == 50 * (J.HOT_ROWS + 1)
    assert J.enrich(rows.limit(0), side, "k").count() == 0
