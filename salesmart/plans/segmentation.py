"""Store segments: features, k-means, labels, principal components."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from salesmart.functions import dates as D
from salesmart.functions import labels as L
from salesmart.functions import numbers as N
from salesmart.functions import text as X
from salesmart.operators.filters import analytical_valid, computed, filter_computed
from salesmart.operators.grouping import bit_of, dealt, first_row, long_form, word_of
from salesmart.operators.lookups import enrich
from salesmart.operators.ordering import sequential_key, z_scores
from salesmart.operators.scalar import beside
from salesmart.plans.silhouette import Silhouette, silhouette
from salesmart.plans.starts import Centres, best_of_starts
from salesmart.sources.delimited import ORIGIN
from salesmart.sources.generators import literal
from salesmart.sources.tables import mapped, with_defaults
from salesmart.workspace import settle

K = 3
RESTARTS = 20
SEED = 42

#: Rows of months, manufacturers, brands and sums that a store is taken to have when stores are dealt into tasks.
STORE_ROWS = 64

# Names of features, of profile and output columns, and texts for missing stores.
FEATURES = [
    "TotalSalesAmount", "TotalQuantity", "NumberOfTransactions", "AvgTransactionAmount", "ProductVariety",
    "ManufacturerVariety", "BrandVariety", "MonthlySalesIntensity", "BrandedSalesShare", "GenericSalesShare",
    "RecencyDays",
]
# Profile mean -> feature it averages.
PROFILE = {
    "AvgTotalSalesAmount": "TotalSalesAmount",
    "AvgTotalQuantity": "TotalQuantity",
    "AvgNumberOfTransactions": "NumberOfTransactions",
    "AvgTransactionAmount": "AvgTransactionAmount",
    "AvgMonthlySalesIntensity": "MonthlySalesIntensity",
    "AvgProductVariety": "ProductVariety",
    "AvgBrandedSalesShare": "BrandedSalesShare",
    "AvgGenericSalesShare": "GenericSalesShare",
    "AvgRecencyDays": "RecencyDays",
}
SUMMARY = {
    "AvgSalesAmount": "TotalSalesAmount",
    "AvgQuantity": "TotalQuantity",
    "AvgTransactions": "NumberOfTransactions",
    "AvgTransactionAmount": "AvgTransactionAmount",
    "AvgProductVariety": "ProductVariety",
    "AvgBrandedSalesShare": "BrandedSalesShare",
    "AvgGenericSalesShare": "GenericSalesShare",
    "AvgRecencyDays": "RecencyDays",
}
SCORED = ["AvgTotalSalesAmount", "AvgNumberOfTransactions", "AvgMonthlySalesIntensity", "AvgProductVariety"]

OUTPUT = [
    "PharmacyID", "PharmacyName", "LocationCode", "LocationName", "District", "Country", "TotalSalesAmount",
    "TotalQuantity", "NumberOfTransactions", "AvgTransactionAmount", "ProductVariety", "ManufacturerVariety",
    "BrandVariety", "MonthlySalesIntensity", "BrandedSalesAmount", "GenericSalesAmount", "BrandedSalesShare",
    "GenericSalesShare", "ActiveMonths", "RecencyDays", "FirstSaleDate", "LastSaleDate", "ClusterID",
    "SegmentRank", "SegmentLabel", "SegmentDescription", "PCA1", "PCA2", "ModelRunTimestamp",
]
WAREHOUSE_MAPPING = {
    **{c: c for c in OUTPUT if c not in (
        "BrandedSalesAmount", "GenericSalesAmount", "ActiveMonths", "FirstSaleDate", "LastSaleDate",
        "ModelRunTimestamp",
    )},
    "ModelRunTimestamp": "ModelRunDate",
}
MISSING_STORE = {
    "PharmacyName": "Unknown pharmacy", "LocationName": "Unknown location", "District": L.UNKNOWN,
    "Country": "Portugal",
}


class TooFewEntities(ValueError):
    """Fewer stores than clusters."""


# ---- preparation -------------------------------------------------------------------------


def prepare_products(feed: DataFrame) -> DataFrame:
    """One row per product code, with the segmentation's own generic rule."""
    code = N.product_code_text(F.col("CNP"))
    attributes = ("ProductName", "Manufacturer", "Brand", "ProductPresentation")
    shaped = feed.select(
        *(F.col(c) for c in ORIGIN if c in feed.columns),
        code.alias("CNP"), *(X.clean_text(F.col(c)).alias(c) for c in attributes),
        L.is_generic_word(F.col("GenericRaw")).alias("IsGeneric"),
        L.product_type(F.col("GenericRaw")).alias("ProductType"),
    ).filter(F.col("CNP").isNotNull())
    order = [c for c in shaped.columns if c != "CNP"]
    return first_row(shaped, ["CNP"], order).drop(*ORIGIN)


def prepare_pharmacies(feed: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per pharmacy with its corrected place."""
    shaped = feed.select(
        *(F.col(c) for c in ORIGIN if c in feed.columns),
        N.id_text(F.col("PharmacyID")).alias("PharmacyID"), X.clean_text(F.col("PharmacyName")).alias("PharmacyName"),
        N.id_text(F.col("LocationID")).alias("LocationCode"),
    ).filter(F.col("PharmacyID").isNotNull())
    order = [c for c in (*ORIGIN, "PharmacyName", "LocationCode") if c in shaped.columns]
    one = first_row(shaped, ["PharmacyID"], order).drop(*ORIGIN)
    places = locations.select("LocationCode", "LocationName", "District", "Country")
    return one.join(places, "LocationCode", "left")


def prepare_sales(feed: DataFrame) -> DataFrame:
    """Typed sales, not yet filtered."""
    return feed.select(*sale_columns())


def sale_columns(sale: str = "SaleID", store: str = "PharmacyID") -> list[Column]:
    """The segmentation's own reading of the raw sales columns."""
    return [
        N.id_text(F.col(f"`{sale}`")).alias("SaleID"), N.id_text(F.col(f"`{store}`")).alias("PharmacyID"),
        N.product_code_text(F.col("CNP")).alias("CNP"), D.parse_day_first(F.col("Datetime")).alias("Datetime"),
        N.comma_decimal(F.col("Qty")).alias("Qty"), N.comma_decimal(F.col("Amount")).alias("Amount"),
    ]


def valid_sales(sales: DataFrame) -> DataFrame:
    return filter_computed(sales, analytical_valid)


def quality_summary(sales: DataFrame) -> DataFrame:
    """Rows before and after the filter; sales shrink to one row per store and product first."""
    ok = F.col("ok")
    counted = computed(sales).groupBy("PharmacyID", "CNP", analytical_valid().alias("ok")).agg(F.count(F.lit(1)).alias("n"))

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    # The metric labels.
    one = counted.agg(
        rows(F.lit(True)).alias("Initial sales rows"),
        rows(ok).alias("Valid rows after analytical preprocessing"),
        rows(~ok).alias("Removed rows"),
        F.count_distinct(F.when(ok, F.col("PharmacyID"))).alias("Distinct pharmacies in sales"),
        F.count_distinct(F.when(ok, F.col("CNP"))).alias("Distinct products in sales"),
    )
    return long_form(one, {c: c for c in one.columns}, "Metric", "Value")


def enrich_sales(sales: DataFrame, products: DataFrame, pharmacies: DataFrame) -> DataFrame:
    """Product and store attributes beside each sale, with a default for what is missing; busy products and stores are no single tasks."""
    typed = enrich(sales, products, "CNP", {"IsGeneric": False, "ProductType": L.UNKNOWN})
    return enrich(typed, pharmacies, "PharmacyID", MISSING_STORE)


def coverage_summary(sales: DataFrame, products: DataFrame, pharmacies: DataFrame) -> DataFrame:
    """How many sales found their product, store and district.

    Only the join keys matter, so sales are counted per key pair before the joins.
    """
    pairs = sales.groupBy("CNP", "PharmacyID").agg(F.count(F.lit(1)).alias("n"))
    both = enrich_sales(pairs, products.select("CNP", "ProductName", "IsGeneric", "ProductType"), pharmacies)

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    # The metric labels.
    one = both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("Sales rows after enrichment"),
        rows(F.col("ProductName").isNull()).alias("Rows without product match"),
        rows(F.col("PharmacyName") == MISSING_STORE["PharmacyName"]).alias("Rows without pharmacy match"),
        rows(F.col("District") == L.UNKNOWN).alias("Rows with unknown district"),
    )
    return long_form(one, {c: c for c in one.columns}, "Metric", "Value")


# ---- features ----------------------------------------------------------------------------


def store_features(sales: DataFrame, products: DataFrame, pharmacies: DataFrame) -> DataFrame:
    """One row per pharmacy.

    Sales shrink to one row per pharmacy and product, to a few per pharmacy for
    the months, and to the pharmacies' sale ids; each grouping spreads a busy
    pharmacy over all tasks.
    """
    rows, stores = sales.agg(F.count(F.lit(1)), F.approx_count_distinct("PharmacyID")).first()
    return features_of(sale_lines(sales), sales.select("PharmacyID", "SaleID"), products, pharmacies, rows, rows, stores)


def sale_lines(sales: DataFrame, *carried: str) -> DataFrame:
    """Each sale under the names of ``monthly_sales``."""
    month = F.year("Datetime") * 100 + F.month("Datetime")
    return sales.select(
        "PharmacyID", "CNP", month.alias("month"), *carried, F.col("Amount").cast("decimal(18,2)").alias("amount"),
        F.col("Qty").cast("decimal(18,2)").alias("qty"), F.col("Datetime").alias("first"), F.col("Datetime").alias("last"),
    )


def monthly_sales(sales: DataFrame, *carried: str) -> DataFrame:
    """One row per pharmacy, product and month (and ``carried`` columns); the rows of parts of the sales add up."""
    return sale_lines(sales, *carried).groupBy("PharmacyID", "CNP", "month", *carried).agg(
        F.sum("amount").alias("amount"), F.sum("qty").alias("qty"), F.min("first").alias("first"), F.max("last").alias("last"),
    )


def distinct_sales(sales: DataFrame, *carried: str) -> DataFrame:
    """Each pharmacy's sale ids, once each."""
    return sales.select("PharmacyID", "SaleID", *carried).distinct()


def marked_products(products: DataFrame) -> DataFrame:
    """Products with numbers for manufacturer and brand, written once; ``once`` is true in one row of a code."""
    names = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("name")) for c in ("Manufacturer", "Brand")))
    listed = products.select(F.inline(names)).dropna().distinct().select(F.struct("kind", "name").alias("item"))
    numbered = sequential_key(listed, "item", "number").select("item.*", "number")
    marked = products.filter(F.col("CNP").isNotNull()).select("CNP", "Manufacturer", "Brand", "IsGeneric")
    for kind in ("Manufacturer", "Brand"):
        side = numbered.filter(F.col("kind") == kind).select(F.col("name").alias(kind), F.col("number").alias(f"{kind}Number"))
        marked = marked.join(side, kind, "left")
    once = F.row_number().over(Window.partitionBy("CNP").orderBy("CNP")) == 1
    return settle(marked.select("CNP", "IsGeneric", "ManufacturerNumber", "BrandNumber", once.alias("once")), "products")


def features_of(
    lines: DataFrame, bought: DataFrame, products: DataFrame, pharmacies: DataFrame, n_lines: int, n_bought: int, n_stores: int
) -> DataFrame:
    """One row per pharmacy, from ``sale_lines`` or ``monthly_sales``, and the sale ids, which may repeat; both with their rows.

    ``n_stores``, about the number of pharmacies, only sets the number of tasks.

    Pharmacy and product, and pharmacy and sale, hardly repeat where there are
    many of them, so both are grouped in tasks of a fixed number of rows.  The
    totals meet their products in such tasks too: products are hashed there and
    the totals pass by, so that no task sorts its part of the sales.  A product
    has at most one row per pharmacy by then.
    Distinct manufacturers, brands and months are bits of numbered words, which
    combine on the map side: a task holds some words per pharmacy instead of
    one entry per sale and distinct count.  These words are dealt by pharmacy,
    about 4,096 pharmacies to a task, and the pharmacies meet their number of
    sales and their place without a sort.
    """
    seen = lines.groupBy("PharmacyID", word_of(F.col("month")).alias("word")).agg(
        F.bit_or(bit_of(F.col("month"))).alias("bits"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    sold = dealt(lines.select("PharmacyID", "CNP", "amount", "qty"), n_lines, "PharmacyID", "CNP").groupBy("PharmacyID", "CNP").agg(
        F.sum("amount").alias("amount"), F.sum("qty").alias("qty")
    )
    once = dealt(bought, n_bought, "PharmacyID", "SaleID").distinct()
    generic = F.coalesce(F.col("IsGeneric"), F.lit(False))
    numbers = {"maker": F.col("ManufacturerNumber"), "brand": F.col("BrandNumber")}
    words = [f"{kind}_word" for kind in numbers]
    marked = marked_products(products).hint("shuffle_hash")
    shrunk = dealt(sold, n_lines, "CNP").join(marked, "CNP", "left").groupBy(
        "PharmacyID", *(word_of(c).alias(f"{kind}_word") for kind, c in numbers.items())
    ).agg(
        F.sum("amount").alias("amount"), F.sum("qty").alias("qty"),
        F.count_if(F.col("CNP").isNotNull() & F.coalesce(F.col("once"), F.lit(True))).alias("products"),
        F.sum(F.when(~generic, F.col("amount")).otherwise(F.lit(0))).alias("branded"),
        F.sum(F.when(generic, F.col("amount")).otherwise(F.lit(0))).alias("generic"),
        *(F.bit_or(bit_of(c)).alias(f"{kind}_bits") for kind, c in numbers.items()),
    )
    sums = [c for c in shrunk.columns if c not in ("PharmacyID", *words, *(f"{kind}_bits" for kind in numbers))]

    def piece(kind: str, *kept: str) -> Column:
        word, bits = (F.col(f"{kind}_{c}") if kind in numbers else F.lit(None).cast("bigint") for c in ("word", "bits"))
        measures = [F.when(F.lit(c in kept), F.col(c)).alias(c) for c in sums]
        return F.struct(F.lit(kind).alias("kind"), word.alias("word"), bits.alias("bits"), *measures)

    pieces = shrunk.select("PharmacyID", F.inline(F.array(piece("sums", *sums), *map(piece, numbers))))
    both = pieces.unionByName(seen.withColumns({"kind": F.lit("month"), "word": F.col("word").cast("bigint")}), allowMissingColumns=True)
    merged = dealt(both, STORE_ROWS * n_stores, "PharmacyID").groupBy("PharmacyID", "kind", "word").agg(
        F.bit_or("bits").alias("bits"), *(F.sum(c).alias(c) for c in sums), F.min("first").alias("first"), F.max("last").alias("last")
    )

    def distinct(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bit_count("bits"))), F.lit(0))

    stores = merged.groupBy("PharmacyID").agg(
        F.sum("amount").alias("TotalSalesAmount"), F.sum("qty").alias("TotalQuantity"), F.sum("products").alias("ProductVariety"),
        distinct("maker").alias("ManufacturerVariety"), distinct("brand").alias("BrandVariety"),
        F.sum("branded").alias("BrandedSalesAmount"), F.sum("generic").alias("GenericSalesAmount"),
        distinct("month").alias("ActiveMonths"), F.min("first").alias("FirstSaleDate"), F.max("last").alias("LastSaleDate"),
    )
    counted = once.groupBy("PharmacyID").agg(F.count("SaleID").alias("NumberOfTransactions"))
    places = pharmacies.select("PharmacyID", "PharmacyName", "LocationCode", "LocationName", "District", "Country")
    described = (
        stores.join(counted.hint("shuffle_hash"), "PharmacyID", "left")
        .join(places.hint("shuffle_hash"), "PharmacyID", "left")
        .fillna(MISSING_STORE)
    )
    return with_ratios(described, lines.agg(F.max("last").cast("date").alias("_last")))


def with_ratios(features: DataFrame, last_day: DataFrame | None = None) -> DataFrame:
    """Averages, shares and recency; a division by zero counts as 0.

    ``last_day`` is one row, read from the sales' date column alone where there are sales.
    """
    if last_day is None:
        last_day = features.agg(F.max("LastSaleDate").cast("date").alias("_last"))
    total = F.col("TotalSalesAmount")
    money = ("TotalSalesAmount", "BrandedSalesAmount", "GenericSalesAmount")
    return (
        beside(features, last_day)
        .withColumns(
            {
                "AvgTransactionAmount": N.ratio_or_zero(total, F.col("NumberOfTransactions")),
                "MonthlySalesIntensity": N.ratio_or_zero(total, F.col("ActiveMonths")),
                "BrandedSalesShare": N.ratio_or_zero(F.col("BrandedSalesAmount"), total),
                "GenericSalesShare": N.ratio_or_zero(F.col("GenericSalesAmount"), total),
                "RecencyDays": F.date_diff("_last", F.col("LastSaleDate").cast("date")).cast("bigint"),
            }
        )
        .withColumns({c: F.col(c).cast("double") for c in money} | {"TotalQuantity": F.col("TotalQuantity").cast("bigint")})
        .drop("_last")
    )


def feature_matrix(features: DataFrame) -> DataFrame:
    """Features without gaps, as a vector column."""
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features.fillna(0, subset=FEATURES))


def scaled(features: DataFrame) -> DataFrame:
    """z-scores of every feature, in columns of their own and as a vector."""
    scored = z_scores(features.fillna(0, subset=FEATURES), FEATURES, "_z")
    return VectorAssembler(inputCols=[f"{c}_z" for c in FEATURES], outputCol="z").transform(scored)


# ---- model -------------------------------------------------------------------------------


def require_entities(features: DataFrame, k: int) -> int:
    n = features.count()
    if n < k:
        raise TooFewEntities(f"{k} clusters asked of {n} pharmacies")
    return n


def best_kmeans(z: DataFrame, k: int = K, restarts: int = RESTARTS, seed: int = SEED) -> Centres:
    """The fit with the lowest within-cluster cost over several starts."""
    return best_of_starts(z, "PharmacyID", "z", k, restarts, seed)


def assigned(z: DataFrame, centres: Centres) -> DataFrame:
    """Each store's cluster, by plain expressions on its z-scores."""
    return centres.assign(z, [f"{c}_z" for c in FEATURES], "ClusterID")


def silhouette_sq(clustered: DataFrame) -> float:
    """Silhouette on squared distances, which is linear in the number of stores."""
    numbered = clustered.withColumn("ClusterID", F.col("ClusterID").cast("int"))
    return ClusteringEvaluator(predictionCol="ClusterID", featuresCol="z").evaluate(numbered)


def euclidean_silhouette(clustered: DataFrame) -> Silhouette:
    """Silhouette on distances, of all pairs of stores; it is exact, so its standard error is 0."""
    return silhouette(clustered, "PharmacyID", "z", "ClusterID")


def principal_components(z: DataFrame) -> tuple[DataFrame, list[float]]:
    """Two components; each sign makes its largest loading positive."""
    model = PCA(k=2, inputCol="z", outputCol="_pca").fit(z)
    out = z
    loadings = model.pc.toArray()
    for i in range(2):
        column = loadings[:, i]
        sign = 1.0 if abs(column.max()) >= abs(column.min()) else -1.0
        weighted = [F.col(f"{c}_z") * F.lit(float(w) * sign) for c, w in zip(FEATURES, column)]
        out = out.withColumn(f"PCA{i + 1}", sum(weighted[1:], weighted[0]))
    return out, [float(v) for v in model.explainedVariance]


def cluster_profile(clustered: DataFrame) -> DataFrame:
    means = [F.avg(F.col(c).cast("double")).alias(out) for out, c in PROFILE.items()]
    return clustered.groupBy("ClusterID").agg(F.count("PharmacyID").alias("NumberOfPharmacies"), *means)


def scored_profile(profile: DataFrame) -> DataFrame:
    """Mean of four standardised averages, over the k clusters."""
    scored = z_scores(profile, SCORED, "_z")
    total = sum((F.col(f"{c}_z") for c in SCORED[1:]), F.col(f"{SCORED[0]}_z"))
    return scored.withColumn("CommercialScore", total / len(SCORED)).drop(*(f"{c}_z" for c in SCORED))


def ranked_profile(scored: DataFrame) -> DataFrame:
    """Rank, label and description per cluster; there are only k rows to order."""
    rank = F.row_number().over(Window.orderBy(F.desc("CommercialScore"), "ClusterID")).cast("bigint")
    return scored.withColumn("SegmentRank", rank).withColumns(
        {
            "SegmentLabel": L.segment_label(F.col("SegmentRank")),
            "SegmentDescription": L.segment_description(F.col("SegmentRank")),
        }
    )


def labelled(clustered: DataFrame, ranked: DataFrame) -> DataFrame:
    names = ranked.select("ClusterID", "SegmentRank", "SegmentLabel", "SegmentDescription")
    return clustered.join(F.broadcast(names), "ClusterID", "left")


def segment_summary(segments: DataFrame) -> DataFrame:
    means = [F.avg(F.col(c).cast("double")).alias(out) for out, c in SUMMARY.items()]
    return segments.groupBy("SegmentLabel").agg(
        F.count_distinct("PharmacyID").alias("NumberOfPharmacies"), *means
    )


@dataclass(frozen=True)
class Segmentation:
    segments: DataFrame
    model_summary: DataFrame
    pca_summary: DataFrame
    cost: float


def segment(features: DataFrame, k: int = K, restarts: int = RESTARTS, seed: int = SEED) -> Segmentation:
    """Features to labelled segments.

    The feature table, one row per store, is written once: every restart then
    reads the same rows, and a lost executor costs a re-read, not the sales scan.
    """
    spark = features.sparkSession
    base = settle(features, "features")
    n = require_entities(base, k)
    z = scaled(base).persist()
    try:
        model = best_kmeans(z, k, restarts, seed)
        clustered = assigned(z, model)
        score = euclidean_silhouette(clustered) if n > k > 1 else None
        projected, explained = principal_components(clustered)
        ranked = ranked_profile(scored_profile(cluster_profile(clustered)))
        rows = labelled(projected, ranked).withColumns(
            {
                "FirstSaleDate": F.col("FirstSaleDate").cast("date"),
                "LastSaleDate": F.col("LastSaleDate").cast("date"),
                "ModelRunTimestamp": D.to_second(F.localtimestamp()),
            }
        )
        segments = settle(rows.select(*OUTPUT), "segments").orderBy("SegmentRank", F.desc("TotalSalesAmount"))
    finally:
        z.unpersist()
    summary = literal(
        spark,
        [
            ("Algorithm", "K-Means"), ("Number of clusters", str(k)), ("Number of pharmacies", str(n)),
            ("Number of model features", str(len(FEATURES))),
            ("Silhouette score", "Not available" if score is None else str(round(score.value, 4))),
            ("Silhouette standard error", "Not available" if score is None else str(round(score.standard_error, 4))),
        ],
        StructType([StructField("Metric", StringType()), StructField("Value", StringType())]),
    )
    pca = literal(
        spark,
        [("PCA1", explained[0]), ("PCA2", explained[1]), ("Total", sum(explained))],
        StructType([StructField("Component", StringType()), StructField("ExplainedVarianceRatio", DoubleType())]),
    )
    return Segmentation(segments, summary, pca, model.cost)


def for_export(segments: DataFrame) -> DataFrame:
    """Final types, with gaps filled."""
    return with_defaults(segments, keep=("LocationCode", "Country"))


def for_warehouse(segments: DataFrame) -> DataFrame:
    """The table's 24 columns; the run's timestamp is cut to its date."""
    return mapped(for_export(segments), WAREHOUSE_MAPPING, "PharmacySegmentation")
