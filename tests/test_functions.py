"""Edge cases of the column helpers, on hand-written rows."""

import datetime as dt
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.functions import dates as D
from salesmart.functions import labels as L
from salesmart.functions import numbers as N
from salesmart.functions import text as X
from salesmart.operators import grouping as A


def values(spark, function, inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


TEXT_CASES = [
    (X.clean_text, {" a b ": "a b", "\t x ": "x", "": "", None: None}),
    (X.match_key, {" São  João de Madeira ": "sao joao de madeira", "Alvaiázere": "alvaiazere", "Café": "cafe",
                   "ÇÃO": "cao", None: None}),
    (N.product_code, {"123": 123, " 123.0 ": 123, "123.9": 123, "": None, "abc": None, None: None}),
    (N.product_code_text, {"12.0": "12", "12.5": "12.5", "abc": "abc", " 7 ": "7", None: None}),
    (N.to_int64, {"1,234": 1234, "2.5": 2, "3.5": 4, "1e3": 1000, "x": None, "": None, "12345678901234567": 12345678901234567}),
    (N.to_decimal, {"1,234.50": Decimal("1234.50"), " 3 ": Decimal("3.00"), "n/a": None, None: None}),
    (N.comma_decimal, {"1,5": 1.5, "1,234.5": None, "2.25": 2.25, "NaN": None, "1d": None, "1e2": 100.0}),
    (N.id_text, {"12": "12", "12.0": "12", "12.5": None, "x": None, None: None}),
    (L.generic_label, {"y": "Generic", "s": "Generic", "n": "Branded", "?": "Unknown", None: "Unknown"}),
    (L.product_type, {"y": "Generic", "s": "Branded", "true": "Generic", None: "Branded"}),
    (D.parse_sale_stamp, {
        "5/3/2021 9:7": dt.datetime(2021, 3, 5, 9, 7), "05/03/2021 09:07:30": dt.datetime(2021, 3, 5, 9, 7),
        "5/3/2021": dt.datetime(2021, 3, 5), "31/2/2021 1:00": None, "bad": None, None: None, "5/3/2021 24:00": None,
    }),
    (D.parse_day_first, {
        "5/3/2021 9:7": dt.datetime(2021, 3, 5, 9, 7), "05-03-2021 09:07:30": dt.datetime(2021, 3, 5, 9, 7, 30),
        "2021-03-05T01:02:03": dt.datetime(2021, 3, 5, 1, 2, 3), "2021-03-05": dt.datetime(2021, 3, 5), "13/13/2021": None, "": None,
    }),
]


@pytest.mark.parametrize("function,cases", TEXT_CASES, ids=lambda c: getattr(c, "__name__", ""))
def test_text_cases(spark, function, cases):
    assert dict(zip(cases, values(spark, function, list(cases)))) == cases


def test_dates(spark):
    days = {"2021-01-01": 1, "2021-01-03": 2, "2022-12-31": 53, "2023-01-01": 1, "2020-02-29": 9}
    assert values(spark, lambda c: D.week_number(c.cast("date")), list(days)) == list(days.values())
    assert values(spark, lambda c: D.is_weekend(c.cast("date")), ["2021-01-02", "2021-01-03", "2021-01-04"]) == [True, True, False]
    assert values(spark, lambda c: D.a_year_later(c.cast("date")), ["2020-02-29", "2019-02-28"]) == [dt.date(2021, 2, 28), dt.date(2020, 2, 28)]
    assert values(spark, lambda c: D.key_date(D.date_key(c.cast("date"))), ["2020-02-29"]) == [dt.date(2020, 2, 29)]
    assert values(spark, D.day_period, [0, 5, 6, 11, 12, 17, 18, 23], "int") == ["Night"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2


def test_half_up(spark):
    assert values(spark, lambda c: N.half_up(c.cast("decimal(10,5)"), 4), ["1.00005", "-1.00005", "2.00004"]) == [
        Decimal("1.0001"), Decimal("-1.0001"), Decimal("2.0000")]


def test_growth(spark):
    pairs = spark.createDataFrame([(1, 5, None), (2, None, 5), (3, None, None), (4, 7, 5)], "i int, a int, b int")
    assert [r.g for r in pairs.orderBy("i").select(N.growth(F.col("a"), F.col("b")).alias("g")).collect()] == [5, -5, None, 2]


def test_single_value(spark):
    rows = spark.createDataFrame(
        [("a", "G"), ("a", "G"), ("b", "G"), ("b", "B"), ("c", None), ("c", "X"), ("d", None)], "k string, v string")
    plain = {r.k: r.v for r in rows.groupBy("k").agg(A.single_value(F.col("v")).alias("v")).collect()}
    assert plain == {"a": "G", "b": None, "c": None, "d": None}
    named = {r.k: r.v for r in rows.groupBy("k").agg(A.single_value(F.col("v"), F.lit("Unknown")).alias("v")).collect()}
    assert named["a"] == "G" and named["b"] == "Unknown"


def test_segment_labels(spark):
    assert values(spark, L.segment_label, [1, 2, 3, 4], "int") == [
        "High-value pharmacies", "Standard pharmacies", "Low-value pharmacies", "Additional segment 4"]


def test_match_key_over_the_whole_plane(spark):
    """Every assigned character of the Basic Multilingual Plane alone and inside a word; of others Python cannot know the case."""

    def by_definition(value):
        parts = unicodedata.normalize("NFKD", value.strip().lower())
        return " ".join("".join(p for p in parts if not unicodedata.combining(p)).split())

    chars = [chr(k) for k in range(0x10000) if unicodedata.category(chr(k)) not in ("Cn", "Cs")]
    values = [*chars, *(f"Ab{x}cD  e" for x in chars), "ﬁn ½ Ａｂ", "ΟΔΟΣ ΟΔΟΣ", "\U0001f642 é", "", "  ", "\x1c a \x1d\u3000b"]
    got = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string").select("k", X.match_key(F.col("v")).alias("m"))
    wrong = [(values[r.k], r.m) for r in got.collect() if r.m != by_definition(values[r.k])]
    assert not wrong, (len(wrong), wrong[:9])
    assert spark.range(1).select(X.match_key(F.lit(None).cast("string"))).first()[0] is None
