"""The raw feed's two readings come from one pass, in steps whose code is short enough to be compiled."""

import pytest

from salesmart.plans import jobs as W
from salesmart.plans import segmentation as S
from salesmart.plans.facts import FACT_INPUT, typed_sales

COLUMNS = ["Sale ID", "Datetime", "CNP", "Pharmacy", "POS", "Localização", "Currency", "Qty", "Amount", "operator_id"]


@pytest.fixture
def feed(spark):
    rows = [
        ("1,001", " 5/2/2021 9:30", "77.0", "4", "1", "9", " EUR", "2", "1,234.50", "8"),
        ("x", "2021-02-05 9:30", "a7", "4.5", "1.5", None, None, "1,5", "2,5", "8"),
        (None,) * len(COLUMNS),
    ]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))


def test_both_readings_are_those_of_their_own(feed):
    both = W.parsed_sales(feed)
    assert sorted(map(str, both.select(*FACT_INPUT).collect())) == sorted(map(str, typed_sales(feed).select(*FACT_INPUT).collect()))
    alone = feed.select(*S.sale_columns("Sale ID", "Pharmacy"))
    assert sorted(map(str, both.select(f"{W.ANALYSIS}.*").collect())) == sorted(map(str, alone.collect()))


def test_readings_are_separate_steps(feed, monkeypatch, capsys):
    monkeypatch.setattr(W, "settle", lambda df, purpose: df)
    W.parsed_sales(feed).explain()
    assert "Generate" in capsys.readouterr().out
