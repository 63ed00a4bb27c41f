"""Segmentation model (M), load checks (N), load jobs (O) and file arrivals (P)."""

from __future__ import annotations

import contextlib
from dataclasses import replace

from pyspark.sql import functions as F

from salesmart.catalog import roles as R
from salesmart.catalog.registry import query
from salesmart.contracts import DIMENSIONS, conform
from salesmart.operators import grouping as A
from salesmart.operators import lookups as J
from salesmart.operators import quality as Q
from salesmart.operators import quantiles as O
from salesmart.operators.scalar import beside
from salesmart.plans import dimensions as B
from salesmart.plans import facts as S
from salesmart.plans import incremental as I
from salesmart.plans import jobs as W
from salesmart.plans import segmentation as P
from salesmart.plans.measures import LINKS
from salesmart.sources import delimited as C
from salesmart.sources import generators as G
from salesmart.sources import tables as T
from salesmart.streaming.arrivals import load_arrivals
from salesmart.workspace import run_dir, settle

# ---- segmentation ------------------------------------------------------------------------


def _features(spark, sf):
    return settle(R.features(spark, sf), "features")


@query("m01_feature_matrix", R.sql(
    "SELECT PharmacyID, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in P.FEATURES) + " FROM features", "features"))
def feature_matrix(spark, sf):
    rows = P.feature_matrix(R.features(spark, sf))
    return rows.select("PharmacyID", *(F.col(c).cast("double").alias(c) for c in P.FEATURES))


@query("m02_z_scores", R.sql(
    "SELECT PharmacyID, " + ", ".join(
        f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0), 5) AS {c}" for c in P.FEATURES
    ) + " FROM features", "features"))
def z_scores(spark, sf):
    """Population deviation; store counts are few enough that a constant feature can occur."""
    rows = P.scaled(_features(spark, sf))
    return rows.select("PharmacyID", *(F.round(f"{c}_z", 5).alias(c) for c in P.FEATURES))


@query("m03_entity_guard", "SELECT count(DISTINCT l_suppkey) AS Pharmacies, true AS TooManyClustersFail FROM lineitem")
def entity_guard(spark, sf):
    rows = _features(spark, sf)
    n = P.require_entities(rows, P.K)
    try:
        P.require_entities(rows, n + 1)
        failed = False
    except P.TooFewEntities:
        failed = True
    return rows.agg(F.count(F.lit(1)).alias("Pharmacies"), F.lit(failed).alias("TooManyClustersFail"))


def _gap(centres):
    """Squared distance of each store to its own centre, less that to the nearest other one."""
    distances = [
        sum(((F.col(f"{c}_z") - float(x)) ** 2 for c, x in zip(P.FEATURES, centre)), F.lit(0.0)) for centre in centres
    ]
    own = F.coalesce(*(F.when(F.col("ClusterID") == k, d) for k, d in enumerate(distances)))
    return own - F.least(*distances)


@query("m04_kmeans_restarts", """
SELECT count(DISTINCT l_suppkey) AS Pharmacies, CAST(3 AS BIGINT) AS Clusters, true AS EachNearestToItsCentre, true AS CostNotAboveTheRule
FROM lineitem""")
def kmeans_restarts(spark, sf):
    """What must hold of any good fit: stores lie nearest to their own centre, and no plain rule does better."""
    z = settle(P.scaled(R.clustered(spark, sf)).withColumnRenamed("ClusterID", "Rule"), "scaled")
    model = P.best_kmeans(z)
    found = P.assigned(z, model).withColumn("gap", _gap(model.points))
    ruled = z.groupBy("Rule").agg(*(F.var_pop(f"{c}_z").alias(c) for c in P.FEATURES), F.count(F.lit(1)).alias("n"))
    spread = sum((F.col(c) for c in P.FEATURES[1:]), F.col(P.FEATURES[0]))
    rule = ruled.agg(F.sum(F.col("n") * spread)).first()[0]
    return found.agg(
        F.count(F.lit(1)).alias("Pharmacies"), F.count_distinct("ClusterID").alias("Clusters"),
        (F.max("gap") <= 1e-9).alias("EachNearestToItsCentre"), F.lit(model.cost <= rule + 1e-4).alias("CostNotAboveTheRule"),
    )


_ZS = ", ".join(f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0) AS z{k}" for k, c in enumerate(P.FEATURES))
_SQUARE = " + ".join(f"z{k} * z{k}" for k in range(len(P.FEATURES)))
_SUMS = ", ".join(f"sum(z{k}) AS y{k}" for k in range(len(P.FEATURES)))
_DOT = " + ".join(f"z{k} * y{k}" for k in range(len(P.FEATURES)))


@query("m05_silhouette", R.sql(f"""
, z AS (SELECT PharmacyID, ClusterID, {_ZS} FROM clustered),
c AS (SELECT ClusterID AS other, count(*) AS n, sum({_SQUARE}) AS psi, {_SUMS} FROM z GROUP BY 1),
d AS (SELECT PharmacyID, ClusterID, other, n, {_SQUARE} AS sq, psi, {_DOT} AS dot FROM z CROSS JOIN c),
s AS (
  SELECT PharmacyID, max(CASE WHEN other = ClusterID THEN n END) AS n,
    max(CASE WHEN other = ClusterID THEN (n * sq + psi - 2 * dot) / nullif(n - 1, 0) END) AS a,
    min(CASE WHEN other <> ClusterID THEN sq + psi / n - 2 * dot / n END) AS b FROM d GROUP BY 1)
SELECT (SELECT count(*) FROM c) AS Clusters, round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS silhouette_sq FROM s""", "clustered"))
def silhouette(spark, sf):
    """Of the clusters by rule, so that SQL can follow."""
    clustered = P.scaled(R.clustered(spark, sf)).withColumn("ClusterID", F.col("ClusterID").cast("int"))
    return clustered.agg(F.count_distinct("ClusterID").alias("Clusters"), F.lit(round(P.silhouette_sq(clustered), 4)).alias("silhouette_sq"))


@query("m05_silhouette_euclidean", R.sql(f"""
, z AS MATERIALIZED (SELECT PharmacyID, ClusterID, {_ZS} FROM clustered),
d AS (
  SELECT x.PharmacyID, x.ClusterID, y.ClusterID AS other, sum(sqrt({' + '.join(f"(x.z{k} - y.z{k}) ** 2" for k in range(len(P.FEATURES)))})) AS t, count(*) AS n
  FROM z x JOIN z y ON x.PharmacyID <> y.PharmacyID GROUP BY 1, 2, 3),
s AS (
  SELECT PharmacyID, max(CASE WHEN other = ClusterID THEN t / n END) AS a, min(CASE WHEN other <> ClusterID THEN t / n END) AS b FROM d GROUP BY 1)
SELECT count(*) AS Pharmacies, (SELECT count(DISTINCT ClusterID) FROM z) AS Clusters,
  round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS Silhouette, CAST(0 AS DOUBLE) AS StandardError FROM s""", "clustered"))
def silhouette_euclidean(spark, sf):
    """Of the clusters by rule; exact, from the distances of all pairs of stores."""
    found = P.euclidean_silhouette(P.scaled(R.clustered(spark, sf)))
    return spark.range(1).select(
        F.lit(found.stores).cast("bigint").alias("Pharmacies"), F.lit(found.clusters).cast("bigint").alias("Clusters"),
        F.lit(round(found.value, 4)).alias("Silhouette"), F.lit(found.standard_error).alias("StandardError"),
    )


@query("m06_ranked_segments", R.sql("""
SELECT PharmacyID, SegmentRank, SegmentLabel, SegmentDescription FROM segments""", "segments"))
def ranked_segments(spark, sf):
    return R.segments(spark, sf).select("PharmacyID", "SegmentRank", "SegmentLabel", "SegmentDescription")


_SPREAD = " + ".join(f"CASE WHEN stddev_pop({c}) > 0 THEN 1 ELSE 0 END" for c in P.FEATURES)


@query("m07_principal_components", R.sql(f"""
SELECT count(*) AS Pharmacies, CAST({_SPREAD} AS DOUBLE) AS TotalVariance, true AS Uncorrelated, true AS SharesFit, true AS LargestFirst
FROM features""", "features"))
def principal_components(spark, sf):
    """What makes them principal components: no covariance, and shares that follow from the variances."""
    projected, explained = P.principal_components(P.scaled(_features(spark, sf)))
    total = sum((F.var_pop(f"{c}_z") for c in P.FEATURES[1:]), F.var_pop(f"{P.FEATURES[0]}_z"))
    one = projected.agg(
        F.count(F.lit(1)).alias("Pharmacies"), total.alias("total"), F.covar_pop("PCA1", "PCA2").alias("both"),
        F.var_pop("PCA1").alias("first"), F.var_pop("PCA2").alias("second"),
    )
    fits = [F.abs(F.col(c) / F.col("total") - e) < 1e-6 for c, e in zip(("first", "second"), explained)]
    return one.select(
        "Pharmacies", F.round("total", 6).alias("TotalVariance"), (F.abs("both") < 1e-6).alias("Uncorrelated"),
        (fits[0] & fits[1]).alias("SharesFit"), (F.col("first") >= F.col("second")).alias("LargestFirst"),
    )


# Output columns that only the model can give.
LEARNT = ("ClusterID", "SegmentRank", "SegmentLabel", "SegmentDescription", "PCA1", "PCA2", "ModelRunTimestamp")
_PLACES = {
    "PharmacyID": "f.PharmacyID", "PharmacyName": "coalesce(PharmacyName, 'Unknown pharmacy')", "LocationCode": "CAST(FK_Location AS VARCHAR)",
    "LocationName": "coalesce(Municipality, 'Unknown location')", "District": "coalesce(District, 'Unknown')", "Country": "coalesce(Country, 'Portugal')",
}


@query("m08_output_table", R.sql("SELECT " + ", ".join(
    f"{_PLACES.get(c, c)} AS {c}" for c in P.OUTPUT if c not in LEARNT) + """, CAST(3 AS BIGINT) AS Segments
FROM features f LEFT JOIN dpharmacy ON f.PharmacyID = SK_Pharmacy LEFT JOIN dlocation ON FK_Location = SK_Location""", "features", "dpharmacy", "dlocation"))
def output_table(spark, sf):
    """The columns that do not depend on the model, and how many segments the others name."""
    rows = P.segment(R.features(spark, sf)).segments
    named = rows.agg(F.count_distinct("SegmentRank", "SegmentLabel", "SegmentDescription", "ClusterID").alias("Segments"))
    return beside(rows.select(*(c for c in P.OUTPUT if c not in LEARNT)), named)


@query("m09_model_summary", """
SELECT * FROM (VALUES ('Algorithm', 'K-Means'), ('Number of clusters', '3'), ('Number of model features', '11'),
  ('Silhouette score', 'in range'), ('Silhouette standard error', 'in range'), ('PCA1', 'in range'), ('PCA2', 'in range'), ('Total', 'in range')) AS t(Metric, Value)
UNION ALL SELECT 'Number of pharmacies', CAST(count(DISTINCT l_suppkey) AS VARCHAR) FROM lineitem""")
def model_summary(spark, sf):
    """What was learnt is held against its range: a silhouette in [-1, 1], shares of variance in [0, 1]."""
    model = P.segment(R.features(spark, sf))
    shares = model.pca_summary.select(F.col("Component").alias("Metric"), F.round("ExplainedVarianceRatio", 4).cast("string").alias("Value"))
    learnt, value = F.col("Metric").isin("Silhouette score", "Silhouette standard error", "PCA1", "PCA2", "Total"), F.col("Value").try_cast("double")
    fits = value.between(F.when(F.col("Metric") == "Silhouette score", -1.0).otherwise(0.0), F.lit(1.0001))
    return model.model_summary.unionByName(shares).withColumn("Value", F.when(learnt & fits, "in range").otherwise(F.col("Value")))


@query("l19_segment_scatter", """
SELECT count(DISTINCT l_suppkey) AS Pharmacies, CAST(3 AS BIGINT) AS Labels, true AS Centred, true AS RanksBySales FROM lineitem""")
def segment_scatter(spark, sf):
    """The points of the scatter are centred, and the top segment sells most on average."""
    rows = P.for_warehouse(P.segment(R.features(spark, sf)).segments).select("SegmentLabel", "SegmentRank", "PCA1", "PCA2", "TotalSalesAmount")
    by = rows.groupBy("SegmentLabel", "SegmentRank").agg(
        F.count(F.lit(1)).alias("n"), F.sum("PCA1").alias("x"), F.sum("PCA2").alias("y"), F.avg("TotalSalesAmount").alias("mean")
    )
    return by.agg(
        F.sum("n").alias("Pharmacies"), F.count(F.lit(1)).alias("Labels"),
        ((F.abs(F.sum("x")) < 1e-6) & (F.abs(F.sum("y")) < 1e-6)).alias("Centred"),
        (F.max_by("mean", -F.col("SegmentRank")) >= F.min_by("mean", -F.col("SegmentRank"))).alias("RanksBySales"),
    )


@query("m04_cluster_assignment")
def cluster_assignment(spark, sf):
    """The stores and their clusters, as the best start leaves them."""
    z = settle(P.scaled(R.features(spark, sf)), "scaled")
    return P.assigned(z, P.best_kmeans(z)).select("PharmacyID", "ClusterID")


@query("m07_component_scores")
def component_scores(spark, sf):
    projected, _ = P.principal_components(P.scaled(_features(spark, sf)))
    return projected.select("PharmacyID", "PCA1", "PCA2")


@query("m08_whole_output_table")
def whole_output_table(spark, sf):
    """All 29 columns."""
    return P.segment(R.features(spark, sf)).segments


@query("m09_learnt_summary")
def learnt_summary(spark, sf):
    """The summary and the explained variance with the values learnt."""
    model = P.segment(R.features(spark, sf))
    shares = model.pca_summary.select(F.col("Component").alias("Metric"), F.round("ExplainedVarianceRatio", 4).cast("string").alias("Value"))
    return model.model_summary.unionByName(shares)


@query("l19_scatter_points")
def scatter_points(spark, sf):
    """The points of the scatter, one per store."""
    rows = P.for_warehouse(P.segment(R.features(spark, sf)).segments)
    return rows.select("PharmacyID", "PharmacyName", "SegmentLabel", "PCA1", "PCA2")


# ---- checks ------------------------------------------------------------------------------


def _dimensions(spark, sf):
    return {
        "DimDate": R.dim_date(spark, sf), "DimTime": B.build_time(spark), "DimProduct": R.dim_product(spark, sf),
        "DimLocation": R.dim_location(spark, sf), "DimPharmacy": R.dim_pharmacy(spark, sf),
        "DimOperator": R.dim_operator(spark, sf), "DimPOS": R.dim_pos(spark, sf),
    }


def _full_facts(spark, sf):
    rows = R.facts(spark, sf, place=True, operator=True)
    return conform(rows.withColumns({"CurrencyCode": F.lit("EUR"), "LoadDateTime": F.localtimestamp()}), "FactSales")


@query("n01_tables_empty", "SELECT " + ", ".join(f"CAST(0 AS BIGINT) AS {t}Rows" for t in ("FactSales", *DIMENSIONS)))
def tables_empty(spark, sf):
    """Load every table, clear it, and count what is left."""
    house = W.Warehouse(spark, run_dir(spark, "mart"))
    house.write("FactSales", _full_facts(spark, sf), "load")
    for name, df in _dimensions(spark, sf).items():
        house.write(name, df, "load")
    for name in ("FactSales", *DIMENSIONS):
        house.clear(name)
    counts = house.counts(("FactSales", *DIMENSIONS))
    Q.require_empty(counts)
    return counts


_DIM_SQL = {"DimDate": "ddate", "DimTime": "dtime", "DimProduct": "dproduct", "DimLocation": "dlocation",
            "DimPharmacy": "dpharmacy", "DimOperator": "doperator", "DimPOS": "dpos"}


@query("n02_dimensions_loaded", R.sql(
    "SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS {n}Rows" for n, t in _DIM_SQL.items()), *_DIM_SQL.values()))
def dimensions_loaded(spark, sf):
    counts = A.row_counts(_dimensions(spark, sf))
    Q.require_loaded(counts)
    return counts


@query("n03_fact_control_totals", R.sql("""
SELECT count(*) AS FactSalesRows, CAST(sum(Qty) AS BIGINT) AS TotalQuantity, CAST(sum(Amount) AS DOUBLE) AS TotalAmount,
  min(SourceSaleDateTime) AS FirstSaleDateTime, max(SourceSaleDateTime) AS LastSaleDateTime FROM built_fact""", "built_fact"))
def fact_control_totals(spark, sf):
    return Q.control_totals(S.build_facts(R.sales_feed(spark, sf), R.dim_product(spark, sf)))


_REPORT_SQL = {**_DIM_SQL, "FactSales": "fact", "PharmacySegmentation": "segments"}


@query("n04_row_count_report", R.sql(
    " UNION ALL ".join(
        f"SELECT 'Row Count' AS ValidationType, '{n}' AS TableName, count(*) AS ResultValue, 'Should be > 0' AS ExpectedResult FROM {t}"
        for n, t in _REPORT_SQL.items()), *_REPORT_SQL.values()))
def row_count_report(spark, sf):
    tables = {**_dimensions(spark, sf), "FactSales": _full_facts(spark, sf), "PharmacySegmentation": R.segments(spark, sf)}
    return Q.row_count_report(tables)


_NULLS = {"FK_Product": "l_discount = 0.1", "Qty": "l_tax = 0.08", "Amount": "l_returnflag = 'R' AND l_linestatus = 'F'"}


@query("n05_null_count_report", " UNION ALL ".join(
    f"SELECT 'FactSales Null Check' AS ValidationType, 'Missing {c}' AS CheckName, count(*) FILTER ({_NULLS.get(c, 'false')}) AS ResultValue, "
    f"'Should be 0' AS ExpectedResult FROM lineitem" for c in Q.FACT_CHECKED))
def null_count_report(spark, sf):
    """Some lines lose a column by attribute, so that the counts are not all zero."""
    lines = R.table(spark, sf, "lineitem")
    same = {"FK_Pharmacy": "l_suppkey", "FK_POS": "l_linenumber", "FK_Operator": "l_orderkey", "FK_Location": "l_suppkey",
            "FK_Date": "l_shipdate", "FK_Time": "l_orderkey", "FK_Product": "l_partkey", "Qty": "l_quantity", "Amount": "l_extendedprice"}
    return Q.null_report(
        lines.select(*(F.when(~F.expr(_NULLS.get(c, "false")), F.col(src)).alias(c) for c, src in same.items()))
    )


@query("n06_segmentation_report", R.sql("""
SELECT 'Notebook Output Check' AS ValidationType,
  unnest(['Segmentation rows', 'Distinct pharmacies segmented', 'Missing segment labels']) AS CheckName,
  unnest([count(*), count(DISTINCT PharmacyID), count(*) FILTER (SegmentLabel IS NULL)]) AS ResultValue,
  unnest(['Should be > 0', 'Should match number of pharmacies used in the model', 'Should be 0']) AS ExpectedResult FROM segments""", "segments"))
def segmentation_report(spark, sf):
    return Q.segmentation_report(R.segments(spark, sf))


def _orphan_sql(fk: str, relation: str, on: str) -> str:
    return (
        f"SELECT '{fk}' AS ForeignKey, count(*) FILTER (k IS NULL) AS OrphanRows, count(DISTINCT {fk}) FILTER (k IS NULL) AS OrphanKeys "
        f"FROM fact LEFT JOIN (SELECT {on} AS k FROM {relation}) ON {fk} = k"
    )


@query("n07_orphan_report", R.sql(" UNION ALL ".join((
    _orphan_sql("FK_Date", "ddate WHERE NOT IsWeekend", "SK_Date"), _orphan_sql("FK_Time", "dtime WHERE DayPeriod <> 'Night'", "SK_Time"),
    _orphan_sql("FK_Product", "dproduct WHERE Brand <> 'Brand#7'", "SK_Product"),
    _orphan_sql("FK_Pharmacy", "dpharmacy", "SK_Pharmacy"), _orphan_sql("FK_Location", "dlocation WHERE District <> 'ASIA'", "SK_Location"),
    _orphan_sql("FK_Operator", "doperator WHERE \"Role\" <> 'BUILDING'", "SK_Operator"), _orphan_sql("FK_POS", "dpos", "SK_POS"),
)), "fact", *_DIM_SQL.values()))
def orphan_report(spark, sf):
    """Several dimensions lack some members by attribute."""
    dims = _dimensions(spark, sf)
    gaps = {
        "DimDate": "NOT IsWeekend", "DimTime": "DayPeriod <> 'Night'", "DimProduct": "Brand <> 'Brand#7'",
        "DimLocation": "District <> 'ASIA'", "DimOperator": "Role <> 'BUILDING'",
    }
    links = {LINKS[n][0]: (df.filter(gaps.get(n, "true")), LINKS[n][1]) for n, df in dims.items()}
    return J.orphan_report(R.facts(spark, sf, place=True, operator=True), links)


@query("n08_segment_distribution", R.sql("SELECT SegmentLabel, count(*) AS NumberOfPharmacies FROM segments GROUP BY 1", "segments"))
def segment_distribution(spark, sf):
    return Q.distribution(R.segments(spark, sf), "SegmentLabel", "NumberOfPharmacies")


@query("n09_output_checks", R.sql("""
SELECT unnest(['One row per pharmacy', 'No missing PharmacyID', 'No missing SegmentLabel', 'No missing or unknown District', 'All shares between 0 and 1']) AS "Check",
  unnest([count(*) = count(DISTINCT PharmacyID), bool_and(PharmacyID IS NOT NULL), bool_and(SegmentLabel IS NOT NULL), true,
    bool_and(BrandedSalesShare BETWEEN 0 AND 1 AND GenericSalesShare BETWEEN 0 AND 1)]) AS Result FROM segments""", "segments"))
def output_checks(spark, sf):
    return Q.require_checks(Q.output_checks(R.segments(spark, sf)))


@query("n10_unknown_districts", R.sql("""
SELECT s_suppkey AS SK_Pharmacy, Municipality FROM supplier JOIN built_location ON s_nationkey = SK_Location WHERE District = 'Unknown'""", "built_location"))
def unknown_districts(spark, sf):
    """The stores whose place still has no district; the job stops on any."""
    places = B.build_location(R.location_feed(spark, sf), R.map_feed(spark, sf), R.MANUAL)
    lost = Q.unknown_districts(places)
    return R.dim_pharmacy(spark, sf).join(lost, F.col("FK_Location") == F.col("SK_Location")).select("SK_Pharmacy", "Municipality")


@query("n11_outlier_removed", """
SELECT l_suppkey AS FK_Pharmacy, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Amount FROM lineitem
WHERE l_orderkey <> (SELECT l_orderkey FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey DESC LIMIT 1) GROUP BY 1""")
def outlier_removed(spark, sf):
    path, facts = run_dir(spark, "facts"), R.facts(spark, sf)
    worst = facts.agg(F.max(F.struct("Amount", "PK_SaleID")).alias("w")).first().w.PK_SaleID
    T.replace(S.with_month(facts), path, [S.MONTH])
    kept = T.delete_where(spark, path, F.col("PK_SaleID") == worst, S.MONTH)
    return kept.groupBy("FK_Pharmacy").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("Amount"))


@query("n11_outliers_by_rule", """
WITH q AS (
  SELECT l_suppkey AS s, round(quantile_cont(a, 0.5) + 1.0 * (quantile_cont(a, 0.75) - quantile_cont(a, 0.25)), 6) AS OutlierLimit
  FROM (SELECT l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS a FROM lineitem) GROUP BY 1)
SELECT l_suppkey AS FK_Pharmacy, OutlierLimit, count(*) FILTER (l_extendedprice > OutlierLimit) AS Removed,
  count(*) FILTER (l_extendedprice <= OutlierLimit) AS Kept,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_extendedprice <= OutlierLimit), 0) AS DOUBLE) AS Amount
FROM lineitem JOIN q ON l_suppkey = s GROUP BY 1, 2""")
def outliers_by_rule(spark, sf):
    """Per store, the amounts above its median by more than its interquartile range, and what is left without them."""
    flagged = O.with_outlier_flag(R.facts(spark, sf), ["FK_Pharmacy"], "Amount", 1.0)
    kept = F.sum(F.when(~F.col("IsOutlier"), F.col("Amount"))).cast("double")
    return flagged.groupBy("FK_Pharmacy", "OutlierLimit").agg(
        F.count_if("IsOutlier").alias("Removed"), F.count_if(~F.col("IsOutlier")).alias("Kept"), F.coalesce(kept, F.lit(0.0)).alias("Amount")
    )


# ---- jobs --------------------------------------------------------------------------------


def feeds(spark, sf, sales=None):
    a, b = R.pharmacy_feeds(spark, sf)
    return W.Feeds(
        sales=R.sales_feed(spark, sf) if sales is None else sales, products=R.product_feed(spark, sf),
        pharmacies=a.unionByName(b), locations=R.location_feed(spark, sf), district_map=R.map_feed(spark, sf),
        operators=R.operator_feed(spark, sf), pos=R.pos_feed(spark, sf), manual=R.MANUAL,
        manual_by_key={**R.MANUAL_KEYS, "nation_15": "Aveiro"},
    )


_JOB_COUNTS = {
    "DimDate": "(SELECT max(CAST(l_shipdate AS DATE)) - min(CAST(l_shipdate AS DATE)) + 1 FROM lineitem)", "DimTime": "1440",
    "DimProduct": "(SELECT count(*) + 1 FROM part)", "DimLocation": "(SELECT count(*) FROM nation)",
    "DimPharmacy": "(SELECT count(*) FROM supplier)", "DimOperator": "(SELECT count(*) FROM customer)",
    "DimPOS": "(SELECT count(DISTINCT l_linenumber) FROM lineitem)", "FactSales": "(SELECT count(*) FROM built_fact)",
    "PharmacySegmentation": "(SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_tax <> 0.08 AND l_discount <> 0.1)",
}


@query("o01_full_refresh", R.sql(" UNION ALL ".join(
    f"SELECT 'Row Count' AS ValidationType, '{t}' AS TableName, CAST({n} AS BIGINT) AS ResultValue, 'Should be > 0' AS ExpectedResult"
    for t, n in _JOB_COUNTS.items()), "built_fact"))
def full_refresh(spark, sf):
    house = W.full_refresh(spark, feeds(spark, sf), run_dir(spark, "mart"))
    return W.final_report(house)["rows"]


@query("o02_incremental_load", R.sql("""
SELECT FK_Pharmacy, count(*) AS n, CAST(sum(Amount) AS DOUBLE) AS Amount, CAST(0 AS BIGINT) AS SecondRun FROM built_fact GROUP BY 1""", "built_fact"))
def incremental_load(spark, sf):
    """Load the sales up to an id, then offer all of them twice: the rest comes in once.

    Segments are no part of an increment, so the load before it leaves them out.
    """
    root, all_ = run_dir(spark, "mart"), feeds(spark, sf)
    number = F.col("Sale ID").try_cast("bigint")
    last = all_.sales.agg(F.max(number).alias("m")).first().m * 4 // 5
    house = W.full_refresh(spark, feeds(spark, sf, all_.sales.filter(number <= last)), root, R.bounds(spark, sf), segmented=None)
    W.incremental_load(spark, all_, root)
    again = W.incremental_load(spark, all_, root)
    return house.read("FactSales").groupBy("FK_Pharmacy").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("Amount"), F.lit(again).cast("bigint").alias("SecondRun")
    )


def _by_line(all_):
    """The feeds with a sale id for each line, from what tells the lines of an order apart."""
    line = F.xxhash64("Sale ID", "POS", "Datetime", "CNP", "Pharmacy", "Amount", "Qty")
    return replace(all_, sales=all_.sales.withColumn("Sale ID", F.shiftrightunsigned(line, 2).cast("string")))


def _sums_by_code(house):
    """Facts by product code and year, as the dimensions show them."""
    facts, products, days = house.read("FactSales"), house.read("DimProduct"), house.read("DimDate")
    return (
        facts.groupBy("FK_Product", "FK_Date").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("Amount"))
        .join(products.select("SK_Product", "CNP"), F.col("FK_Product") == F.col("SK_Product"))
        .join(days.select("SK_Date", "Year"), F.col("FK_Date") == F.col("SK_Date"))
        .groupBy("CNP", "Year").agg(F.sum("n").alias("n"), F.sum("Amount").alias("Amount"))
    )


@query("o02_incremental_with_dimensions", R.sql("""
SELECT coalesce(p_partkey, -1) AS CNP, "Year", CAST(count(*) AS BIGINT) AS n, CAST(sum(Amount) AS DOUBLE) AS Amount
FROM (
  SELECT l_orderkey AS o, CASE WHEN l_discount = 0.1 OR (l_partkey % 3 = 0 AND l_shipdate < TIMESTAMP '1997-01-01') THEN NULL ELSE l_partkey END AS k,
    CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS Amount FROM lineitem WHERE l_tax <> 0.08)
LEFT JOIN part ON k = p_partkey JOIN ddate ON FullDate = d GROUP BY 1, 2""", "ddate"))
def incremental_with_dimensions(spark, sf):
    """The first load knows two thirds of the products and the years before 1997; the second brings the rest.

    The new codes lie between the old ones and the new days after the old
    ones.  Sales of products that were unknown when they were loaded stay with
    the unknown member; all others must stay with their code and year.
    """
    root, all_ = run_dir(spark, "mart"), _by_line(feeds(spark, sf))
    early = F.col("Datetime").rlike("/199[0-6] ")
    code = F.regexp_extract("CNP", r"(\d+)", 1).cast("bigint")
    first = replace(all_, sales=all_.sales.filter(early), products=all_.products.filter(code % 3 != 0))
    house = W.full_refresh(spark, first, root, segmented=None)
    W.incremental_load(spark, replace(all_, sales=all_.sales.filter(~early)), root, composite=True)
    return _sums_by_code(house)


@query("o02_incremental_composite", R.sql("""
SELECT FK_Pharmacy, count(*) AS n, CAST(sum(Amount) AS DOUBLE) AS Amount FROM built_fact GROUP BY 1""", "built_fact"))
def incremental_composite(spark, sf):
    """Sales come in by date while their ids do not follow time: the mark of timestamp and id loses none of them."""
    root, all_ = run_dir(spark, "mart"), _by_line(feeds(spark, sf))
    early = F.col("Datetime").rlike("/199[0-6] ")
    house = W.full_refresh(spark, replace(all_, sales=all_.sales.filter(early)), root, segmented=None)
    W.incremental_load(spark, all_, root, composite=True)
    return house.read("FactSales").groupBy("FK_Pharmacy").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("Amount"))


@query("f05_features_after_increment", R.sql("""
SELECT *, date_diff('day', LastSaleDate, max(LastSaleDate) OVER ()) AS RecencyDays FROM (
  SELECT FK_Pharmacy AS PharmacyID, CAST(sum(Amount) AS DOUBLE) AS TotalSalesAmount, CAST(sum(Qty) AS BIGINT) AS TotalQuantity,
    count(*) AS NumberOfTransactions, count(DISTINCT FK_Product) AS ProductVariety,
    count(DISTINCT Manufacturer) AS ManufacturerVariety, count(DISTINCT Brand) AS BrandVariety,
    CAST(sum(CASE WHEN IsGeneric THEN 0 ELSE Amount END) AS DOUBLE) AS BrandedSalesAmount,
    CAST(sum(CASE WHEN IsGeneric THEN Amount ELSE 0 END) AS DOUBLE) AS GenericSalesAmount,
    count(DISTINCT FK_Date // 100) AS ActiveMonths,
    min(CAST(SourceSaleDateTime AS DATE)) AS FirstSaleDate, max(CAST(SourceSaleDateTime AS DATE)) AS LastSaleDate
  FROM built_fact JOIN built_product ON FK_Product = SK_Product
  WHERE FK_Product <> -1 AND Qty > 0 AND Amount >= 0 GROUP BY 1)""", "built_fact", "built_product"))
def features_after_increment(spark, sf):
    """Features of the sales before 1997, then of all: the second time only the later months are read."""
    root, all_ = run_dir(spark, "mart"), _by_line(feeds(spark, sf))
    early = F.col("Datetime").rlike("/199[0-6] ")
    house = W.full_refresh(spark, replace(all_, sales=all_.sales.filter(early)), root, segmented=None)
    W.current_features(house, all_)
    W.incremental_load(spark, replace(all_, sales=all_.sales.filter(~early)), root, composite=True)
    rows, _ = W.current_features(house, all_)
    days = {c: F.col(c).cast("date") for c in ("FirstSaleDate", "LastSaleDate")}
    return rows.withColumns(days).select(
        "PharmacyID", "TotalSalesAmount", "TotalQuantity", "NumberOfTransactions", "ProductVariety", "ManufacturerVariety",
        "BrandVariety", "BrandedSalesAmount", "GenericSalesAmount", "ActiveMonths", "FirstSaleDate", "LastSaleDate", "RecencyDays",
    )


@query("o03_advance_mark", """
SELECT 'Load_FactSales' AS ProcessName, l_shipdate AS LastSourceSaleDateTime, l_orderkey AS LastSaleID
FROM lineitem ORDER BY 2 DESC, 3 DESC LIMIT 1""")
def advance_mark(spark, sf):
    house, facts = W.Warehouse(spark, run_dir(spark, "mart")), _full_facts(spark, sf)
    T.replace(conform(G.first_watermark(spark, I.PROCESS), "Watermark"), house.path("Watermark"))
    # In two loads, the later sales first: the mark never goes back.
    late = F.year("SourceSaleDateTime") > 1995
    house.advance_mark(facts.filter(late))
    house.advance_mark(facts.filter(~late))
    return house.read("Watermark").select("ProcessName", "LastSourceSaleDateTime", "LastSaleID")


@query("o04_first_mark", """
SELECT 'Load_FactSales' AS ProcessName, TIMESTAMP '1900-01-01' AS LastSourceSaleDateTime, CAST(0 AS BIGINT) AS LastSaleID,
  count(*) AS RowsAbove FROM orders WHERE o_orderkey > 0""")
def first_mark(spark, sf):
    mark = G.first_watermark(spark, I.PROCESS).select("ProcessName", "LastSourceSaleDateTime", "LastSaleID")
    orders = beside(R.table(spark, sf, "orders").select("o_orderkey"), mark)
    return orders.filter(F.col("o_orderkey") > F.col("LastSaleID")).groupBy(*mark.columns).agg(F.count(F.lit(1)).alias("RowsAbove"))


@query("o05_run_log", """
SELECT 'load' AS PipelineName, s AS ActivityName, t AS TargetTable, n AS RowsInserted, CASE WHEN s = 'check empty' THEN 'Failed' ELSE 'Succeeded' END AS Status
FROM (
  SELECT 'write DimPharmacy' AS s, 'DimPharmacy' AS t, count(*) AS n FROM supplier
  UNION ALL SELECT 'write DimOperator', 'DimOperator', count(*) FROM customer
  UNION ALL SELECT 'write DimProduct', 'DimProduct', count(*) FROM part
  UNION ALL SELECT 'check loaded', NULL, NULL UNION ALL SELECT 'check empty', NULL, NULL)""")
def run_log(spark, sf):
    """A row for each write and check; the last check fails, as the tables are loaded."""
    house, tables = W.Warehouse(spark, run_dir(spark, "mart")), ("DimPharmacy", "DimOperator", "DimProduct")
    house.write("DimPharmacy", R.dim_pharmacy(spark, sf), "load")
    house.write("DimOperator", R.dim_operator(spark, sf), "load")
    house.write("DimProduct", R.dim_product(spark, sf), "load")
    with house.step("load", "check loaded"):
        Q.require_loaded(house.counts(tables))
    with contextlib.suppress(Q.CheckFailed), house.step("load", "check empty"):
        Q.require_empty(house.counts(tables))
    return house.read("LoadLog").select("PipelineName", "ActivityName", "TargetTable", "RowsInserted", "Status")


@query("o06_dim_pos", R.sql("SELECT * FROM dpos", "dpos"))
def dim_pos(spark, sf):
    return B.build_pos(R.pos_feed(spark, sf))


@query("o06_dim_operator", R.sql("SELECT * FROM doperator", "doperator"))
def dim_operator(spark, sf):
    return B.build_operator(R.operator_feed(spark, sf))


@query("o06_dim_location", R.sql("SELECT * FROM built_location", "built_location"))
def dim_location(spark, sf):
    return B.build_location(R.location_feed(spark, sf), R.map_feed(spark, sf), R.MANUAL)


@query("o06_dim_pharmacy", R.sql("SELECT * FROM dpharmacy", "dpharmacy"))
def dim_pharmacy(spark, sf):
    """A third file lists every store again under another name, which sorts first but comes last."""
    a, b = R.pharmacy_feeds(spark, sf)
    again = R.conflicting(a.unionByName(b), "Pharmacy ID", "Nome da farmácia")
    paths = [C.write_delimited(feed, run_dir(spark, "pharmacies")) for feed in (a, b, again)]
    return B.build_pharmacy(C.read_parts(spark, paths, width=3, encoding=C.UTF8, origin=True))


@query("o06_dim_product", R.sql("""
SELECT * FROM built_product UNION ALL SELECT -1, -1, 'Unknown Product', 'Unknown', 'Unknown', 'Unknown', false, 'Unknown'""", "built_product"))
def dim_product(spark, sf):
    return B.build_product(R.product_feed(spark, sf))


@query("o06_dim_date", R.sql("SELECT *, false AS IsHoliday FROM ddate", "ddate"))
def dim_date(spark, sf):
    """The test calendar ends before the first listed holiday."""
    return B.build_date(R.bounds(spark, sf))


@query("o06_dim_time", R.sql("""
SELECT dtime.*, coalesce(n, 0) AS Lines FROM dtime LEFT JOIN (SELECT FK_Time, count(*) AS n FROM fact GROUP BY 1) ON FK_Time = SK_Time""", "dtime", "fact"))
def dim_time(spark, sf):
    sold = R.facts(spark, sf).groupBy("FK_Time").agg(F.count(F.lit(1)).alias("Lines"))
    rows = B.build_time(spark).join(sold, F.col("SK_Time") == F.col("FK_Time"), "left").drop("FK_Time")
    return rows.withColumn("Lines", F.coalesce("Lines", F.lit(0)))


@query("o07_fact_builder", R.sql("SELECT * REPLACE (CAST(Amount AS DOUBLE) AS Amount) FROM built_fact", "built_fact"))
def fact_builder(spark, sf):
    dim = B.build_product(R.product_feed(spark, sf))
    return S.build_facts(R.sales_feed(spark, sf), dim).drop("LoadDateTime")


@query("o08_unknown_member", """
SELECT CASE WHEN l_discount = 0.1 OR p_brand = 'Brand#7' THEN 'Unknown Product' ELSE p_name END AS ProductName, count(*) AS n,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Amount
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_tax <> 0.08 GROUP BY 1""")
def unknown_member(spark, sf):
    """Sales without a code, or of a brand the master data lacks, show up under one member."""
    known = R.dim_product(spark, sf).filter("Brand <> 'Brand#7'")
    dim = G.unknown_product(spark).unionByName(known)
    facts = S.build_facts(R.sales_feed(spark, sf), dim).groupBy("FK_Product").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("Amount")
    )
    named = facts.join(dim.select("SK_Product", "ProductName"), F.col("FK_Product") == F.col("SK_Product"), "left")
    return named.groupBy("ProductName").agg(F.sum("n").alias("n"), F.sum("Amount").alias("Amount"))


@query("p01_file_arrivals", R.sql("""
SELECT FK_Pharmacy, count(*) AS n, CAST(sum(Amount) AS DOUBLE) AS Amount FROM fact GROUP BY 1""", "fact"))
def file_arrivals(spark, sf):
    """Three deliveries, the last of which repeats the first."""
    house, incoming = W.Warehouse(spark, run_dir(spark, "mart")), run_dir(spark, "incoming")
    house.clear("FactSales")
    staged = conform(_full_facts(spark, sf).withColumnRenamed("PK_SaleID", "SaleID"), "FactSales_IncrementalBatch")
    middle = staged.agg(F.max("SaleID").alias("m")).first().m // 2
    checkpoint = run_dir(spark, "arrivals")
    early, late = F.col("SaleID") <= middle, F.col("SaleID") > middle
    for part in (early, late, early):
        staged.filter(part).write.mode("append").parquet(incoming)
        load_arrivals(spark, incoming, house.root, checkpoint).awaitTermination()
    return house.read("FactSales").groupBy("FK_Pharmacy").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("Amount"))
