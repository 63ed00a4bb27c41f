"""The seven dimensions and the slicer calendar, from raw text feeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.contracts import conform
from salesmart.functions import dates as D
from salesmart.functions import labels as L
from salesmart.functions import numbers as N
from salesmart.functions import text as X
from salesmart.operators.filters import complete_computed, keyed_and_named
from salesmart.operators.grouping import first_known, first_row, long_form, single_value
from salesmart.operators.lookups import unique_map
from salesmart.operators.ordering import sequential_key
from salesmart.sources import generators as G
from salesmart.sources.delimited import ORIGIN
from salesmart.workspace import settle

# File column names and the names they take here.
POS_COLUMNS = {"POS id": "SK_POS", "name": "POSName", "email": "POSEmail"}
OPERATOR_COLUMNS = {
    "Operator id": "SK_Operator", "first_name": "FirstName", "last_name": "LastName", "email": "Email",
    "gender": "Gender", "role": "Role", "team": "Team",
}
PHARMACY_COLUMNS = {"Pharmacy ID": "PharmacyID", "Nome da farmácia": "PharmacyName", "Localização": "LocationID"}
LOCATION_COLUMNS = ["LocationID", "Municipality", "District", "Country"]
PRODUCT_COLUMNS = ["CNP", "ProductName", "Manufacturer", "Brand", "ProductPresentation", "GenericRaw"]
MAP_DISTRICT, MAP_PLACE = "Distrito", "Concelho"
# Map columns in the order they are tried, with the label each match gets.
MAP_PRIORITY = {
    "Concelho": "municipality_mapping",
    "Freguesia": "parish_mapping",
    "Freguesia Final (Pós RATF)": "final_parish_mapping",
}


def build_pos(feed: DataFrame) -> DataFrame:
    named = feed.withColumnsRenamed(POS_COLUMNS)
    return conform(named.withColumn("SK_POS", N.to_int64(F.col("SK_POS"))), "DimPOS")


def build_operator(feed: DataFrame) -> DataFrame:
    named = feed.withColumnsRenamed(OPERATOR_COLUMNS)
    return conform(
        named.withColumns(
            {
                "SK_Operator": N.to_int64(F.col("SK_Operator")),
                "Team": N.to_int64(F.col("Team")).try_cast("int"),
                "FullName": X.full_name(F.col("FirstName"), F.col("LastName")),
            }
        ),
        "DimOperator",
    )


def district_map(feed: DataFrame) -> DataFrame:
    """Municipality to district where the map knows just one; matching is exact here."""
    return (
        feed.select(X.clean_text(F.col(MAP_DISTRICT)).alias("d"), X.clean_text(F.col(MAP_PLACE)).alias(MAP_PLACE))
        .groupBy(MAP_PLACE)
        .agg(single_value(F.col("d")).alias("DistrictFromMap"))
    )


def clean_locations(feed: DataFrame) -> DataFrame:
    typed = feed.withColumn("LocationID", N.to_int64(F.col("LocationID")))
    return keyed_and_named(typed, "LocationID", "Municipality").withColumns(
        {
            "Municipality": X.clean_text(F.col("Municipality")),
            "District": X.blank_to_null(F.col("District")),
            "Country": X.clean_text(F.col("Country")),
        }
    )


def build_location(feed: DataFrame, map_feed: DataFrame, manual: dict[str, str] | None = None) -> DataFrame:
    """District as given, else from the map, else by hand, else Unknown."""
    places = clean_locations(feed)
    looked_up = places.join(district_map(map_feed), F.col("Municipality") == F.col(MAP_PLACE), "left")
    district = L.settled_district(F.col("District"), F.col("DistrictFromMap"), F.col("Municipality"), manual)
    return conform(looked_up.withColumns({"District": district, "SK_Location": F.col("LocationID")}), "DimLocation")


def corrected_locations(
    feed: DataFrame, map_feed: DataFrame, manual: dict[str, str] | None = None, country: str = "Portugal"
) -> DataFrame:
    """District by the other priority, the maps first, and where each district came from."""
    places = feed.select(
        N.id_text(F.col("LocationID")).alias("LocationCode"),
        X.clean_text(F.col("Municipality")).alias("LocationName"),
        X.blank_to_null(F.col("District")).alias("DistrictOriginal"),
        X.clean_text(F.coalesce(F.col("Country"), F.lit(country))).alias("Country"),
    ).withColumn("place_key", X.match_key(F.col("LocationName")))
    found: list[tuple[Column, str]] = []
    for column, label in MAP_PRIORITY.items():
        if column not in map_feed.columns:
            continue
        out = f"by_{label}"
        lookup = unique_map(
            map_feed.select(F.col(f"`{column}`").alias("place_key"), F.col(MAP_DISTRICT).alias(out)),
            "place_key", out, fold=True,
        )
        places = places.join(lookup, "place_key", "left")
        found.append((F.col(out), label))
    by_hand = L.pick(F.col("place_key"), L.MANUAL_DISTRICTS_BY_KEY if manual is None else manual)
    found += [(by_hand, "manual_override"), (F.col("DistrictOriginal"), "original_locations")]
    source = F.coalesce(*(F.when(value.isNotNull(), F.lit(label)) for value, label in found), F.lit("unknown"))
    return places.select(
        "LocationCode", "LocationName", "place_key",
        X.clean_text(F.coalesce(*(value for value, _ in found), F.lit(L.UNKNOWN))).alias("District"),
        "Country", source.alias("DistrictCorrectionSource"),
    )


def correction_summary(locations: DataFrame) -> DataFrame:
    # The metric labels.
    source = F.col("DistrictCorrectionSource")
    one = locations.agg(
        F.count(F.lit(1)).alias("Locations in source"),
        F.count_if(source == "municipality_mapping").alias("Locations corrected from municipality mapping"),
        F.count_if(source == "parish_mapping").alias("Locations corrected from parish mapping"),
        F.count_if(source == "final_parish_mapping").alias("Locations corrected from final parish mapping"),
        F.count_if(source == "manual_override").alias("Locations corrected from manual override"),
        F.count_if(source == "original_locations").alias("Locations using original district"),
        F.count_if(F.col("District") == L.UNKNOWN).alias("Locations still unknown"),
    )
    return long_form(one, {c: c for c in one.columns}, "Metric", "Value")


def build_pharmacy(feed: DataFrame) -> DataFrame:
    """One row per pharmacy; of several, the first in file order is kept, else the first by name and location."""
    named = feed.withColumnsRenamed(PHARMACY_COLUMNS)
    typed = named.withColumns(
        {"PharmacyID": N.to_int64(F.col("PharmacyID")), "LocationID": N.to_int64(F.col("LocationID"))}
    )
    kept = keyed_and_named(typed, "PharmacyID", "PharmacyName")
    order = [c for c in (*ORIGIN, "PharmacyName", "LocationID") if c in kept.columns]
    one = first_row(kept, ["PharmacyID"], order)
    return conform(
        one.select(
            F.col("PharmacyID").alias("SK_Pharmacy"),
            X.clean_text(F.col("PharmacyName")).alias("PharmacyName"),
            F.col("LocationID").alias("FK_Location"),
        ),
        "DimPharmacy",
    )


def clean_products(feed: DataFrame) -> DataFrame:
    cleaned = feed.withColumns({c: X.clean_text(F.col(c)) for c in PRODUCT_COLUMNS})
    kept = cleaned.filter(X.has_text(F.col("CNP")) & X.has_text(F.col("ProductName")))
    coded = kept.withColumns(
        {"GenericLabel": L.generic_label(F.col("GenericRaw")), "CNP": N.product_code(F.col("CNP"))}
    )
    return complete_computed(coded, ("CNP",))


def grouped_products(cleaned: DataFrame) -> DataFrame:
    """One row per code; the code is made a number first, so ``123`` and ``123.0`` are one product."""
    order = F.struct(
        *(F.col(c) for c in ORIGIN if c in cleaned.columns),
        F.col("ProductName"), F.col("Manufacturer"), F.col("Brand"), F.col("ProductPresentation"),
    )
    known = ("ProductName", "Manufacturer", "Brand", "ProductPresentation")
    return cleaned.groupBy("CNP").agg(
        *(first_known(F.col(c), order).alias(c) for c in known),
        single_value(F.col("GenericLabel"), F.lit(L.UNKNOWN)).alias("GenericLabel"),
    )


def build_product(feed: DataFrame) -> DataFrame:
    products = grouped_products(clean_products(feed))
    keyed = sequential_key(products, "CNP", "SK_Product")
    return conform(G.unknown_product(feed.sparkSession).unionByName(_with_kind(keyed)), "DimProduct")


def _with_kind(products: DataFrame) -> DataFrame:
    return products.withColumn("IsGeneric", F.col("GenericLabel") == "Generic")


def refresh_product(stored: DataFrame, feed: DataFrame) -> DataFrame:
    """The stored dimension brought up to date by code.

    Stored products keep their keys, also those the feed no longer has, as
    facts point to them.  New codes get the numbers after the highest.
    """
    products = settle(_with_kind(grouped_products(clean_products(feed))), "products")
    attributes = [c for c in products.columns if c != "CNP"]
    named = products.select("CNP", F.struct(*attributes).alias("_new"))
    kept = stored.join(named, "CNP", "left").select(
        "CNP", "SK_Product",
        *(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in attributes),
    )
    start = (stored.agg(F.max("SK_Product")).first()[0] or 0) + 1
    fresh = sequential_key(products.join(stored.select("CNP"), "CNP", "left_anti"), "CNP", "SK_Product", max(start, 1))
    return conform(kept.unionByName(fresh.select(*kept.columns)), "DimProduct")


#: The longest calendar, so that one mistyped year cannot make one of millions of days.
MOST_DAYS = 100 * 366


def checked_bounds(bounds: DataFrame, most_days: int = MOST_DAYS) -> DataFrame:
    """The first and last day, or an error if they lie too far apart for a calendar."""
    days = F.date_diff("last_day", "first_day")
    problem = F.concat(F.lit("calendar from "), F.col("first_day"), F.lit(" to "), F.col("last_day"), F.lit(" is too long"))
    last = F.when(days > most_days, F.raise_error(problem).cast("date")).otherwise(F.col("last_day"))
    return bounds.select("first_day", last.alias("last_day"))


def wider_bounds(bounds: DataFrame, stored: DataFrame) -> DataFrame:
    """Bounds that cover both a batch and the stored calendar: a calendar only ever grows."""
    return bounds.unionByName(G.date_bounds(stored, F.col("FullDate"))).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )


def build_date(bounds: DataFrame, holidays: tuple[dt.date, ...] = G.HOLIDAYS) -> DataFrame:
    d = F.col("FullDate")
    return conform(
        G.every_day(checked_bounds(bounds)).select(
            D.date_key(d).alias("SK_Date"), d, F.dayofmonth(d).alias("Day"), D.day_name(d).alias("DayName"),
            D.week_number(d).alias("WeekNumber"), F.month(d).alias("Month"), D.month_name(d).alias("MonthName"),
            F.quarter(d).alias("Quarter"), D.quarter_name(d).alias("QuarterName"), F.year(d).alias("Year"),
            D.is_weekend(d).alias("IsWeekend"), G.is_holiday(d, holidays).alias("IsHoliday"),
            D.is_year_to_date(d, F.col("last_day")).alias("YTDFlag"),
        ),
        "DimDate",
    )


def build_time(spark: SparkSession) -> DataFrame:
    minute_of_day = F.col("minute_of_day")
    hour, minute = F.floor(minute_of_day / 60).cast("int"), (minute_of_day % 60).cast("int")
    return conform(
        G.every_minute(spark).select(
            D.minute_key(minute_of_day).alias("SK_Time"), hour.alias("Hour"), minute.alias("Minute"),
            D.time_label(hour, minute).alias("TimeLabel"), D.day_period(hour).alias("DayPeriod"),
        ),
        "DimTime",
    )


def build_slicer(dim_date: DataFrame) -> DataFrame:
    return conform(dim_date.select("FullDate").distinct(), "DateSlicer")
