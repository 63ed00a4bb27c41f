"""Load checks.  Each report costs one scan per table it looks at."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.grouping import long_form

# The reports' expected texts, and below the names of checks and columns.
SOME = "Should be > 0"
NONE = "Should be 0"
SAME = "Should match number of pharmacies used in the model"

FACT_CHECKED = (
    "FK_Date", "FK_Time", "FK_Product", "FK_Pharmacy", "FK_Location", "FK_Operator", "FK_POS", "Qty", "Amount",
)


class CheckFailed(ValueError):
    """A load check did not hold."""


def control_totals(facts: DataFrame, stamp: str = "SourceSaleDateTime") -> DataFrame:
    return facts.agg(
        F.count(F.lit(1)).alias("FactSalesRows"),
        F.sum(F.col("Qty").cast("bigint")).alias("TotalQuantity"),
        F.sum("Amount").alias("TotalAmount"),
        F.min(stamp).alias("FirstSaleDateTime"),
        F.max(stamp).alias("LastSaleDateTime"),
    )


def row_count_report(tables: dict[str, DataFrame]) -> DataFrame:
    counts = (
        df.agg(F.count(F.lit(1)).alias("ResultValue")).select(
            F.lit("Row Count").alias("ValidationType"), F.lit(name).alias("TableName"),
            "ResultValue", F.lit(SOME).alias("ExpectedResult"),
        )
        for name, df in tables.items()
    )
    return reduce(lambda a, b: a.unionByName(b), counts)


def null_report(facts: DataFrame, columns: tuple[str, ...] = FACT_CHECKED) -> DataFrame:
    """All null counts from one scan."""
    one = facts.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = long_form(one, {c: f"Missing {c}" for c in columns}, "CheckName", "ResultValue")
    return rows.select(
        F.lit("FactSales Null Check").alias("ValidationType"), "CheckName", "ResultValue",
        F.lit(NONE).alias("ExpectedResult"),
    )


def segmentation_report(segments: DataFrame) -> DataFrame:
    one = segments.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("PharmacyID").alias("stores"),
        F.count_if(F.col("SegmentLabel").isNull()).alias("unlabelled"),
    )
    labels = {
        "rows": "Segmentation rows", "stores": "Distinct pharmacies segmented", "unlabelled": "Missing segment labels",
    }
    expected = F.when(F.col("CheckName") == labels["rows"], SOME).when(
        F.col("CheckName") == labels["stores"], SAME
    ).otherwise(NONE)
    return long_form(one, labels, "CheckName", "ResultValue").select(
        F.lit("Notebook Output Check").alias("ValidationType"), "CheckName", "ResultValue",
        expected.alias("ExpectedResult"),
    )


def distribution(df: DataFrame, label: str, out: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), label)


def output_checks(segments: DataFrame) -> DataFrame:
    """Named truths about the segmentation output, from one pass."""

    def always(condition: Column) -> Column:
        return F.coalesce(F.bool_and(F.coalesce(condition, F.lit(False))), F.lit(True))

    one = segments.agg(
        (F.count_distinct("PharmacyID") + F.max(F.col("PharmacyID").isNull().cast("int")) == F.count(F.lit(1))).alias("a"),
        always(F.col("PharmacyID").isNotNull()).alias("b"),
        always(F.col("SegmentLabel").isNotNull()).alias("c"),
        always(F.col("District").isNotNull() & (F.col("District") != "Unknown")).alias("d"),
        always(F.col("BrandedSalesShare").between(0, 1) & F.col("GenericSalesShare").between(0, 1)).alias("e"),
    )
    return one.select(
        F.expr(
            "stack(5, 'One row per pharmacy', a, 'No missing PharmacyID', b, 'No missing SegmentLabel', c, "
            "'No missing or unknown District', d, 'All shares between 0 and 1', e) as (`Check`, Result)"
        )
    )


def require_checks(report: DataFrame) -> DataFrame:
    failed = [r["Check"] for r in report.filter(~F.col("Result")).collect()]
    if failed:
        raise CheckFailed(f"failed checks: {failed}")
    return report


def unknown_districts(locations: DataFrame) -> DataFrame:
    return locations.filter(F.col("District") == "Unknown")


def require_known_districts(locations: DataFrame) -> DataFrame:
    open_places = unknown_districts(locations).count()
    if open_places:
        raise CheckFailed(f"{open_places} locations have no district; extend the manual list")
    return locations


def require_empty(counts: DataFrame) -> None:
    _require(counts, lambda n: n == 0, "not empty")


def require_loaded(counts: DataFrame) -> None:
    _require(counts, lambda n: n > 0, "empty")


def _require(counts: DataFrame, ok, problem: str) -> None:
    bad = [name for name, n in counts.first().asDict().items() if not ok(n)]
    if bad:
        raise CheckFailed(f"{problem}: {bad}")
