"""Sales facts from the raw feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.contracts import conform
from salesmart.functions import dates as D
from salesmart.functions import numbers as N
from salesmart.functions import text as X
from salesmart.operators.filters import complete_computed
from salesmart.operators.lookups import surrogate

# Feed column names and the names they take here.
SALES_COLUMNS = {
    "Sale ID": "SaleID", "Datetime": "SourceSaleDateTimeText", "Pharmacy": "FK_Pharmacy", "POS": "FK_POS",
    "Localização": "FK_Location", "Currency": "CurrencyCode", "operator_id": "FK_Operator",
}
MONTH = "SaleMonth"
#: Columns of typed sales that facts are built from.
FACT_INPUT = (
    "SaleID", "SourceSaleDateTime", "CNP", "FK_Pharmacy", "FK_POS", "FK_Location", "FK_Operator", "Qty", "Amount", "CurrencyCode",
)


def typed_sales(feed: DataFrame) -> DataFrame:
    named = feed.withColumnsRenamed(SALES_COLUMNS)
    whole = ("SaleID", "FK_Pharmacy", "FK_POS", "FK_Location", "Qty", "FK_Operator")
    return named.withColumns(
        {
            **{c: N.to_int64(F.col(c)) for c in whole},
            "CNP": N.product_code(F.col("CNP")),
            "CurrencyCode": X.clean_text(F.col("CurrencyCode")),
            "Amount": N.to_decimal(F.col("Amount")),
            "SourceSaleDateTime": D.parse_sale_stamp(F.col("SourceSaleDateTimeText")),
        }
    )


def build_facts(feed: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Complete feed rows with date, time and product keys; unmatched products point to -1."""
    return keyed_facts(complete_computed(typed_sales(feed)), dim_product)


def keyed_facts(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Complete typed sales with their keys."""
    stamp = F.col("SourceSaleDateTime")
    rows = sales.withColumns(
        {"PK_SaleID": F.col("SaleID"), "FK_Date": D.date_key(stamp), "FK_Time": D.time_key(stamp)}
    )
    keyed = surrogate(rows, "CNP", dim_product, "CNP", "SK_Product", "FK_Product")
    return conform(keyed.withColumn("LoadDateTime", F.localtimestamp()), "FactSales")


def with_month(facts: DataFrame) -> DataFrame:
    """Storage partition of the fact table, yyyymm."""
    return facts.withColumn(MONTH, F.floor(F.col("FK_Date") / 100).cast("int"))
