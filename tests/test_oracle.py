"""Every query with a SQL twin gives what DuckDB gives; the others give rows."""

import oracle_check
import pytest

from salesmart.catalog import load

QUERIES, ORACLE = load()


@pytest.fixture(scope="module")
def con(sf):
    return oracle_check.duck(sf)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_matches_sql(spark, sf, con, name):
    problem = oracle_check.compare(QUERIES[name](spark, sf), con, ORACLE[name])
    assert problem is None, f"{name}: {problem}"


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_inventory_section_is_there():
    assert {n[0] for n in QUERIES} == set("abcdefghijklmnop")
    assert set(ORACLE) <= set(QUERIES)


def test_one_star_join_has_all_links(spark, sf):
    links = {"Year", "DayPeriod", "Manufacturer", "PharmacyName", "District", "Role", "POSName", "SegmentLabel"}
    assert any(links <= set(build(spark, sf).columns) for name, build in QUERIES.items() if name.startswith("e09_"))
