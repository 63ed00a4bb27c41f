"""Store features kept as a state per storage month, so that only months that changed are read again.

For every month of the facts the state holds, in Parquet, what adds up over
months: amounts, quantities and first and last sale by store and product, and
the store's distinct sale ids.  Product and place attributes are joined when
features are asked for, so a corrected dimension needs no new state.

The index says for each month which run wrote its part and from which files:
their names and lengths are the month's signature, read from the folder listing
alone.  A month is read again if its signature differs, whether rows came, went
or were rewritten, and whatever happened to the job that changed them.  The
signature is taken before the rows are read, so rows that come in between cause
one more reading and are never lost.  Runs write into folders of their own; the
index is published by compare-and-set, so of two refreshes the later gets
``Conflict``.  Sale ids that occur in several months count once.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from salesmart.operators.filters import analytical_valid
from salesmart.plans import segmentation as S
from salesmart.plans.facts import MONTH
from salesmart.sources import tables as T
from salesmart.sources.generators import literal
from salesmart.workspace import files

#: Fixed value: the product key of facts whose product is not known.
UNKNOWN_PRODUCT = -1

INDEX = StructType(
    [StructField(MONTH, IntegerType()), StructField("signature", StringType()), StructField("run", StringType())]
)
PARTS = {"monthly": S.monthly_sales, "bought": S.distinct_sales}


def sales_of(facts: DataFrame) -> DataFrame:
    """Stored facts under the segmentation's names, as far as it may use them; the unknown product is none."""
    named = facts.select(
        F.col("PK_SaleID").alias("SaleID"), F.col("FK_Pharmacy").alias("PharmacyID"),
        F.when(F.col("FK_Product") != UNKNOWN_PRODUCT, F.col("FK_Product")).alias("CNP"),
        F.col("SourceSaleDateTime").alias("Datetime"), "Qty", "Amount", MONTH,
    )
    return named.filter(analytical_valid())


def months_on_disk(spark: SparkSession, path: str) -> dict[int, str]:
    """Each month folder's signature; one listing a month, no data file is opened."""
    fs, where = files(spark, path)
    found = {}
    for folder in fs.listStatus(where) if fs.exists(where) else ():
        key, _, month = folder.getPath().getName().partition("=")
        if key == MONTH:
            listing = spark.sparkContext._jvm.org.apache.commons.lang3.ArrayUtils.toString(fs.listStatus(folder.getPath()))
            entries = sorted(re.findall(r"path=[^;]*/([^/;_.][^/;]*); isDirectory=false; length=(\d+)", listing))
            if entries:
                found[int(month)] = hashlib.sha256(repr(entries).encode()).hexdigest()
    return found


@dataclass(frozen=True)
class FeatureState:
    """The state in the folder ``root``."""

    spark: SparkSession
    root: str

    def months(self) -> dict[int, tuple[str, str | None]]:
        """Month to its signature and run; a month without a sale that counts has no run."""
        where = f"{self.root}/index"
        rows = T.scan(self.spark, where, INDEX).collect() if T.exists(self.spark, where) else ()  # one row a month
        return {r[0]: (r[1], r[2]) for r in rows}

    def refresh(self, path: str, facts: DataFrame) -> list[int]:
        """Bring the state in line with the facts stored in ``path``; the months that were read for it."""
        index = f"{self.root}/index"
        expected, known, stored = T.latest_number(self.spark, index), self.months(), months_on_disk(self.spark, path)
        touched = sorted(m for m, signature in stored.items() if m not in known or known[m][0] != signature)
        if not touched and known.keys() == stored.keys():
            return []
        run = uuid.uuid4().hex
        if touched:
            sales = sales_of(facts.filter(F.col(MONTH).isin(touched)))
            for part, shrink in PARTS.items():
                # Rebalancing leaves a month in few files and splits a heavy one.
                rows = shrink(sales, MONTH).hint("rebalance", MONTH)
                rows.write.partitionBy(MONTH).parquet(f"{self.root}/{part}/run={run}")
        written = months_on_disk(self.spark, f"{self.root}/monthly/run={run}")
        runs = {m: known[m] for m in stored if m not in touched}
        runs |= {m: (stored[m], run if m in written else None) for m in touched}
        lines = [(m, *line) for m, line in sorted(runs.items())]
        T.replace(literal(self.spark, lines, INDEX).coalesce(1), index, expected=expected)
        self._drop_unused({r for _, r in (*known.values(), *runs.values())})
        return touched

    def _drop_unused(self, used: set[str | None]) -> None:
        """Runs that neither this index nor the one before names."""
        for part in PARTS:
            fs, where = files(self.spark, f"{self.root}/{part}")
            for folder in fs.listStatus(where) if fs.exists(where) else ():
                if folder.getPath().getName().removeprefix("run=") not in used:
                    fs.delete(folder.getPath(), True)

    def _part(self, part: str, schema: StructType) -> DataFrame:
        home = f"{self.root}/{part}"
        paths = [f"{home}/run={run}/{MONTH}={m}" for m, (_, run) in sorted(self.months().items()) if run]
        if not paths:
            return literal(self.spark, [], schema)
        return self.spark.read.schema(schema).option("basePath", home).parquet(*paths).select(*schema.names)

    def features(self, facts: DataFrame, products: DataFrame, pharmacies: DataFrame) -> DataFrame:
        """One row per store, as from all facts; of ``facts`` only the columns' types are used."""
        shapes = {part: shrink(sales_of(facts), MONTH).schema for part, shrink in PARTS.items()}
        monthly, bought = (self._part(part, shape).drop(MONTH) for part, shape in shapes.items())
        # A sale whose lines fall into several months is in the part of each.
        rows, stores = monthly.agg(F.count(F.lit(1)), F.approx_count_distinct("PharmacyID")).first()
        return S.features_of(monthly, bought, products, pharmacies, rows, bought.count(), stores)


def dimension_products(products: DataFrame) -> DataFrame:
    """The product dimension as the features want it, by its surrogate key."""
    return products.select(F.col("SK_Product").alias("CNP"), "Manufacturer", "Brand", "IsGeneric")
