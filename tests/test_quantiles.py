"""Grouped quantiles and the outlier rule against plain sorting, also with a store that holds most rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.operators import quantiles as Q


def rows():
    rng = np.random.default_rng(11)
    hot = [("hot", float(v)) for v in np.round(rng.lognormal(3, 2, 20_000), 2)]
    same = [("same", 7.5)] * 3000
    two = [("two", float(v)) for v in rng.choice([1.0, 9.0], 501)]
    small = [(f"s{k}", float(v)) for k in range(40) for v in rng.integers(0, 50, 1 + k % 9)]
    return hot + same + two + small + [(None, 1.0), (None, 4.0), ("none", None), ("neg", -3.0), ("neg", -1e9), ("neg", 1e9)]


def want(probs):
    groups = {}
    for k, v in rows():
        if v is not None:
            groups.setdefault(k, []).append(v)
    return {k: [float(np.quantile(v, p)) for p in probs] for k, v in groups.items()}


@pytest.mark.parametrize("accuracy,most,parts", [(10_000, 1_000_000, 1024), (100, 1_000_000, 1024), (100, 5, 4), (50, 2, 64)])
def test_quantiles_are_exact(spark, accuracy, most, parts):
    """Coarse sketches leave wide brackets, which are cut down in rounds."""
    df = spark.createDataFrame(rows(), "store string, amount double").repartition(6)
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 1.0)
    got = Q.grouped_quantiles(df, ["store"], "amount", probs, accuracy=accuracy, most=most, parts=parts).collect()
    expected = want(probs)
    assert len(got) == len(expected)
    for r in got:
        assert [r[f"P{round(p * 100)}"] for p in probs] == pytest.approx(expected[r.store], rel=1e-12)


def test_outliers(spark):
    df = spark.createDataFrame(rows(), "store string, amount double")
    got = Q.without_outliers(df, ["store"], "amount", 3.0)
    kept = 0
    limits = {k: q[1] + 3 * (q[2] - q[0]) for k, q in want((0.25, 0.5, 0.75)).items()}
    for k, v in rows():
        kept += v is None or v <= round(limits[k], 6)
    assert got.count() == kept < len(rows()) and got.columns == ["store", "amount"]


def test_no_task_holds_a_hot_group(spark):
    """With nothing but one store, its rows still meet their bracket in many tasks."""
    df = spark.range(64_000, numPartitions=4).select(F.lit("hot").alias("store"), F.rand(3).alias("amount"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("false", "-1", "16"), strict=True):
            spark.conf.set(k, v)
        sizes = [r["count"] for r in Q.with_outlier_flag(df, ["store"], "amount", 1.0).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 8 and max(sizes) < 64_000 / 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty(spark):
    none = spark.createDataFrame([], "store string, amount double")
    assert Q.grouped_quantiles(none, ["store"], "amount").count() == 0
    assert Q.without_outliers(none, ["store"], "amount", 3.0).count() == 0
