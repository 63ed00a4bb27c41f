"""Column contracts of the mart's tables and the check applied before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "decimal(18,2)": T.DecimalType(18, 2), "string": T.StringType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _table(text: str) -> T.StructType:
    """``name type`` per line; a trailing ``?`` marks a nullable column."""
    fields = []
    for line in text.strip().splitlines():
        name, kind = line.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


# Column contracts; the names and types are fixed values.
_TEXTS = {
    "DimDate": """
        SK_Date int
        FullDate date
        Day smallint
        DayName string
        WeekNumber smallint
        Month smallint
        MonthName string
        Quarter smallint
        QuarterName string
        Year smallint
        IsWeekend boolean
        IsHoliday boolean
        YTDFlag boolean
    """,
    "DimTime": """
        SK_Time int
        Hour smallint
        Minute smallint
        TimeLabel string
        DayPeriod string
    """,
    "DimProduct": """
        SK_Product bigint
        CNP bigint
        ProductName string
        Manufacturer string?
        Brand string?
        ProductPresentation string?
        IsGeneric boolean
        GenericLabel string
    """,
    "DimLocation": """
        SK_Location bigint
        Municipality string
        District string?
        Country string
    """,
    "DimPharmacy": """
        SK_Pharmacy bigint
        PharmacyName string
        FK_Location bigint
    """,
    "DimOperator": """
        SK_Operator bigint
        FirstName string
        LastName string
        FullName string
        Email string?
        Gender string?
        Role string?
        Team int?
    """,
    "DimPOS": """
        SK_POS bigint
        POSName string
        POSEmail string?
    """,
    "FactSales": """
        PK_SaleID bigint
        FK_Date int
        FK_Time int
        FK_Product bigint
        FK_Pharmacy bigint
        FK_Location bigint
        FK_Operator bigint
        FK_POS bigint
        Qty int
        Amount decimal(18,2)
        CurrencyCode string?
        SourceSaleDateTime timestamp_ntz
        LoadDateTime timestamp_ntz
    """,
    "DateSlicer": """
        FullDate date
    """,
    "FactSales_IncrementalBatch": """
        SaleID bigint
        FK_Date int
        FK_Time int
        FK_Product bigint
        FK_Pharmacy bigint
        FK_Location bigint
        FK_Operator bigint
        FK_POS bigint
        Qty smallint
        Amount decimal(18,2)
        CurrencyCode string?
        SourceSaleDateTime timestamp_ntz
        LoadDateTime timestamp_ntz
    """,
    "PharmacySegmentation": """
        PharmacyID bigint
        PharmacyName string?
        LocationCode string?
        LocationName string?
        District string?
        Country string?
        TotalSalesAmount double?
        TotalQuantity bigint?
        NumberOfTransactions bigint?
        AvgTransactionAmount double?
        ProductVariety bigint?
        ManufacturerVariety bigint?
        BrandVariety bigint?
        MonthlySalesIntensity double?
        BrandedSalesShare double?
        GenericSalesShare double?
        RecencyDays bigint?
        ClusterID bigint?
        SegmentRank bigint?
        SegmentLabel string?
        SegmentDescription string?
        PCA1 double?
        PCA2 double?
        ModelRunDate date?
    """,
    "Watermark": """
        ProcessName string
        LastSourceSaleDateTime timestamp_ntz?
        LastSaleID bigint?
        LastSuccessfulRun timestamp_ntz?
        UpdatedAt timestamp_ntz
    """,
    "LoadLog": """
        PipelineRunID string
        PipelineName string
        ActivityName string?
        TargetTable string?
        RowsInserted bigint?
        RowsUpdated bigint?
        Status string
        ErrorMessage string?
        StartedAt timestamp_ntz
        FinishedAt timestamp_ntz?
    """,
}

CONTRACTS: dict[str, T.StructType] = {name: _table(text) for name, text in _TEXTS.items()}

DIMENSIONS = ("DimDate", "DimTime", "DimProduct", "DimLocation", "DimPharmacy", "DimOperator", "DimPOS")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Order and cast the columns to the contract; a missing column is an error."""
    schema = CONTRACTS[table]
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def guarded(df: DataFrame, table: str) -> DataFrame:
    """Conform, and fail the job on the first null in a column that must have a value."""
    schema = CONTRACTS[table]
    shaped = conform(df, table)
    return shaped.select(
        *(
            F.col(f.name)
            if f.nullable
            else F.coalesce(
                F.col(f.name),
                F.raise_error(F.lit(f"{table}.{f.name} must not be null")).cast(f.dataType),
            ).alias(f.name)
            for f in schema
        )
    )


def differences(df: DataFrame, table: str) -> list[str]:
    """Contract check on the schema alone: order, names and types."""
    want = [(f.name, f.dataType.simpleString()) for f in CONTRACTS[table]]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    found = [f"expected {w}, found {h}" for w, h in zip(want, have) if w != h]
    if len(want) != len(have):
        found.append(f"expected {len(want)} columns, found {len(have)}")
    return found
