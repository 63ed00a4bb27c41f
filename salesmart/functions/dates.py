"""Calendar and clock helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.text import clean_text, zero_padded


def _pieces(c: Column, delimiter: str) -> Column:
    return F.split(c, delimiter)


def _whole(c: Column) -> Column:
    return c.try_cast("int")


def parse_sale_stamp(c: Column) -> Column:
    """``d/M/yyyy H:m`` to a timestamp on the minute.

    Seconds are dropped, no time means midnight, and bad input gives null.
    """
    words = _pieces(clean_text(c), " ")
    date = _pieces(F.get(words, F.lit(0)), "/")
    time = _pieces(F.coalesce(F.get(words, F.lit(1)), F.lit("0:0")), ":")
    return F.call_function(
        "try_make_timestamp_ntz",
        *(_whole(F.get(date, F.lit(i))) for i in (2, 1, 0)),
        *(_whole(F.get(time, F.lit(i))) for i in (0, 1)),
        F.lit(0),
    )


def parse_day_first(c: Column) -> Column:
    """Day-first timestamp, with slashes or dashes, or year first when it has four digits."""
    words = _pieces(clean_text(F.translate(c.cast("string"), "-T", "/ ")), " ")
    date = _pieces(F.get(words, F.lit(0)), "/")
    time = _pieces(F.get(words, F.lit(1)), ":")
    year_first = F.length(F.get(date, F.lit(0))) == 4

    def clock(i: int) -> Column:
        return F.coalesce(F.get(time, F.lit(i)), F.lit("0"))

    return F.call_function(
        "try_make_timestamp_ntz",
        _whole(F.get(date, F.when(year_first, 0).otherwise(2))), _whole(F.get(date, F.lit(1))),
        _whole(F.get(date, F.when(year_first, 2).otherwise(0))),
        _whole(clock(0)), _whole(clock(1)), clock(2).try_cast("decimal(16,6)"),
    )


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_date(key: Column) -> Column:
    """The date behind a yyyymmdd key."""
    year = F.floor(key / 10000)
    month = F.floor(key / 100) % 100
    return F.make_date(year.cast("int"), month.cast("int"), (key % 100).cast("int"))


def time_key(ts: Column) -> Column:
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def minute_key(minute_of_day: Column) -> Column:
    return (F.floor(minute_of_day / 60) * 100 + minute_of_day % 60).cast("int")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def week_number(d: Column) -> Column:
    """Week of the year; week 1 holds 1 January and weeks start on Sunday."""
    first_weekday = F.dayofweek(F.trunc(d, "year"))
    return (F.floor((F.dayofyear(d) + first_weekday - 2) / 7) + 1).cast("int")


def quarter_name(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def day_of_year(d: Column) -> Column:
    return F.date_diff(d, F.trunc(d, "year")) + 1


def is_year_to_date(d: Column, last: Column) -> Column:
    return day_of_year(d) <= day_of_year(last)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def to_second(ts: Column) -> Column:
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def day_period(hour: Column) -> Column:
    return (
        F.when(hour < 6, "Night").when(hour < 12, "Morning").when(hour < 18, "Afternoon").otherwise("Evening")
    )


def time_label(hour: Column, minute: Column) -> Column:
    return F.concat(zero_padded(hour, 2), F.lit(":"), zero_padded(minute, 2))


def a_year_later(d: Column) -> Column:
    return F.add_months(d, 12)


def date_title(first: Column, last: Column) -> Column:
    return F.concat(
        F.lit("Total Sales Amount ("),
        F.date_format(first, "MM/yyyy"), F.lit(" - "), F.date_format(last, "MM/yyyy"),
        F.lit(")"),
    )
